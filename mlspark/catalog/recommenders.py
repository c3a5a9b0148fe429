"""Recommenders on the ratings derived from orders and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from mlspark.catalog import query
from mlspark.catalog.joined import ITEM_WEIGHTS, USER_SIMS, item_weights
from mlspark.operators import joint_factors as J
from mlspark.operators import joins
from mlspark.operators import recommend as P
from mlspark.operators.sampling import union_labeled
from mlspark.operators.windows import topn_per_group
from mlspark.plans.ordered import spread_hash, spread_hash_sql
from mlspark.plans.views import RATINGS, SPLIT, is_test, ratings, table, train_test
from mlspark.session import in_waves, waves_for, written

TOP = 30


def split(spark, sf):
    rows = written(ratings(spark, sf), "ratings")
    return rows.filter(~is_test()), rows.filter(is_test())


CF = USER_SIMS + """,
  cf AS (SELECT n.a AS user_id, t.item_id, sum(sim * rating) / sum(sim) AS score FROM near n JOIN train t ON t.user_id = n.b
         GROUP BY 1, 2 HAVING sum(sim) > 0),
  cfu AS (SELECT c.* FROM cf c WHERE NOT EXISTS (SELECT 1 FROM train s WHERE s.user_id = c.user_id AND s.item_id = c.item_id))"""


@query(
    "P1_cf_scores",
    "WITH " + CF + """ SELECT user_id, count(*) AS n_items, round(min(score), 6) AS lo, round(max(score), 6) AS hi, round(avg(score), 6) AS mean_score
    FROM cfu GROUP BY 1""",
)
def p1(spark, sf):
    train, _ = split(spark, sf)

    def summary(scores, wave):
        return scores.groupBy("user_id").agg(
            F.count(F.lit(1)).alias("n_items"),
            F.round(F.min("score"), 6).alias("lo"),
            F.round(F.max("score"), 6).alias("hi"),
            F.round(F.avg("score"), 6).alias("mean_score"),
        )

    return P.cf_scores(joins.user_similarity(train, 40), train, summary)


def ranked_sql(source, n, score="score"):
    return f"""SELECT user_id, item_id, round({score}, 6) AS score, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round({score}, 6) DESC, item_id) AS rank FROM {source}) WHERE rank <= {n}"""


@query(
    "P2_cf_topn",
    "WITH " + CF + """,
    every AS (SELECT u.user_id, i.item_id FROM (SELECT DISTINCT user_id FROM train) u CROSS JOIN (SELECT DISTINCT item_id FROM train) i
              WHERE NOT EXISTS (SELECT 1 FROM train s WHERE s.user_id = u.user_id AND s.item_id = i.item_id)),
    filled AS (SELECT e.user_id, e.item_id, coalesce(score, 0) AS score FROM every e LEFT JOIN cfu c ON e.user_id = c.user_id AND e.item_id = c.item_id) """
    + ranked_sql("filled", 40),
)
def p2(spark, sf):
    train, _ = split(spark, sf)
    return P.cf_topn(joins.user_similarity(train, 40), train, 40).withColumn("score", F.round("score", 6))


CB = ITEM_WEIGHTS + """,
  prof AS (SELECT user_id, term, sum(rating * w) AS num, sum(w) AS den FROM train t JOIN iw ON t.item_id = iw.item_id GROUP BY 1, 2),
  cb0 AS (SELECT p.user_id, iw.item_id, sum(num * w) / sum(den * w) AS score FROM prof p JOIN iw ON p.term = iw.term GROUP BY 1, 2 HAVING sum(den * w) > 0),
  cb AS (SELECT c.* FROM cb0 c WHERE NOT EXISTS (SELECT 1 FROM train s WHERE s.user_id = c.user_id AND s.item_id = c.item_id))"""


def content(spark, sf, train, then):
    """What ``then`` makes of the content lists of one wave of users."""
    weights = written(item_weights(spark, sf), "item-weights")
    classes = P.content_classes(train, weights)

    def step(wave):
        part = train.filter(wave.holds("user_id"))
        return then(P.content_lists(part, P.content_profiles(part, weights), weights, TOP, classes=classes))

    return in_waves(spark, waves_for(classes.size), step, "content")


@query("P3_content_scores", "WITH " + SPLIT + ", " + CB + " " + ranked_sql("cb", TOP))
def p3(spark, sf):
    train, _ = split(spark, sf)
    scores = content(spark, sf, train, lambda lists: P.content_scores(lists, TOP))
    return scores.withColumn("score", F.round("score", 6))


@query(
    "P3_content_ranges",
    "WITH " + SPLIT + ", " + CB + " SELECT user_id, CAST(count(*) AS BIGINT) AS n_items, round(min(score), 6) AS lo, round(max(score), 6) AS hi FROM cb GROUP BY 1",
)
def p3_ranges(spark, sf):
    train, _ = split(spark, sf)
    ranges = content(spark, sf, train, P.content_ranges)
    return ranges.withColumns({c: F.round(c, 6) for c in ("lo", "hi")})


HYBRID = CF + ", " + CB + """,
  cfn AS (SELECT user_id, item_id, (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w + 1e-9) AS s FROM cfu WINDOW w AS (PARTITION BY user_id)),
  cbn AS (SELECT user_id, item_id, (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w + 1e-9) AS s FROM cb WINDOW w AS (PARTITION BY user_id)),
  hy AS (SELECT a.user_id, a.item_id, 0.5 * a.s + 0.5 * b.s AS score FROM cfn a JOIN cbn b ON a.user_id = b.user_id AND a.item_id = b.item_id)"""


def all_models(spark, sf, train, then):
    """What ``then`` makes of the scores of the neighbours, the content lists and both models' blend of one wave of users."""
    weights = written(item_weights(spark, sf), "item-weights")
    # the neighbours' scores make a block of users large enough
    classes = P.content_classes(train, weights, widest=1)

    def step(cf, wave):
        cf = wave.keep(cf, "cf-scores")
        part = train.filter(wave.holds("user_id"))
        lists = P.content_lists(part, P.content_profiles(part, weights), weights, TOP, cf, classes=classes)
        lists = wave.keep(lists, "content-lists")
        return then(cf, lists, P.hybrid_scores(lists, cf))

    return P.cf_scores(joins.user_similarity(train, 40), train, step, P.SCORED, classes.size)


@query("P4_hybrid_scores", "WITH " + HYBRID + " " + ranked_sql("hy", TOP))
def p4(spark, sf):
    train, _ = split(spark, sf)
    best = all_models(spark, sf, train, lambda cf, lists, hybrid: P.rank_items(hybrid, TOP))
    return best.withColumn("score", F.round("score", 6))


def precision_sql(name, source):
    return f"""SELECT '{name}' AS model, round(avg(coalesce(hits, 0) / 30), 6) AS precision, count(*) AS n_users
      FROM (SELECT DISTINCT user_id FROM pos) u LEFT JOIN (
        SELECT r.user_id, count(*) AS hits FROM ({ranked_sql(source, TOP)}) r JOIN pos p ON p.user_id = r.user_id AND p.item_id = r.item_id GROUP BY 1) h
      ON u.user_id = h.user_id"""


@query(
    "P5_evaluate_recommenders",
    "WITH " + HYBRID + ", pos AS (SELECT user_id, item_id FROM test WHERE rating >= 4 AND user_id IN (SELECT user_id FROM train)) "
    + " UNION ALL ".join(precision_sql(n, s) for n, s in (("CF", "cfu"), ("CB", "cb"), ("Hybrid", "hy"))),
)
def p5(spark, sf):
    train, test = split(spark, sf)
    models = ("CF", "CB", "Hybrid")

    def best(cf, lists, hybrid):
        ranked = (P.rank_items(cf, TOP), P.content_scores(lists, TOP), P.rank_items(hybrid, TOP))
        return union_labeled({m: r.select("user_id", "item_id") for m, r in zip(models, ranked, strict=True)}, "model")

    rows = written(all_models(spark, sf, train, best), "best")
    ranked = {m: rows.filter(F.col("model") == m) for m in models}
    return P.evaluate_recommenders(ranked, test, train, TOP, 4).withColumn("precision", F.round("precision", 6))


@query(
    "P6_biases",
    "WITH " + SPLIT + """, ub AS (SELECT user_id, avg(rating) - (SELECT avg(rating) FROM train) AS user_bias FROM train GROUP BY 1),
    ib AS (SELECT item_id, avg(rating - user_bias) - (SELECT avg(rating) FROM train) AS item_bias FROM train t JOIN ub ON t.user_id = ub.user_id GROUP BY 1)
    SELECT t.user_id, t.item_id, t.rating, round((SELECT avg(rating) FROM train) + coalesce(user_bias, 0) + coalesce(item_bias, 0), 6) AS base
    FROM test t LEFT JOIN ub ON t.user_id = ub.user_id LEFT JOIN ib ON t.item_id = ib.item_id""",
)
def p6_biases(spark, sf):
    train, test = train_test(spark, sf)
    return P.baseline(test, *P.biases(train)).withColumn("base", F.round("base", 6))


FOLDS = 3  # folds at once


def pair_key():
    return F.col("user_id") * 1000003 + F.col("item_id")


@query("P6_mf_explicit")
def p6(spark, sf):
    rows = written(ratings(spark, sf), "ratings")
    return P.cross_validate_mf(rows, P.mf_explicit, pair_key(), 3, "FunkSVD", parallelism=FOLDS)


@query("P7_mf_nonnegative")
def p7(spark, sf):
    rows = written(ratings(spark, sf), "ratings")

    def predict(train, test):
        return P.predict_nonnegative(P.mf_nonnegative(train), train, test)

    return P.cross_validate_mf(rows, predict, pair_key(), 3, "NMF", parallelism=FOLDS)


@query("W11_factor_top_items")
def w11(spark, sf):
    model = P.mf_nonnegative(written(ratings(spark, sf), "ratings"))
    titles = table(spark, sf, "part").select(F.col("p_partkey").alias("item_id"), "p_name")
    return joins.attach_titles(P.factor_top_items(model, 10), titles, "item_id", "p_name")


@query("P7_user_profile")
def p7_profile(spark, sf):
    rows = written(ratings(spark, sf), "ratings")
    return P.user_profile(P.mf_nonnegative(rows), rows)


@query("P8_mf_implicit_blend")
def p8(spark, sf):
    train, test = split(spark, sf)
    return P.rating_errors(P.mf_implicit_blend(train, test)).withColumn("model", F.lit("SVD++"))


@query("P8_mf_implicit_joint")
def p8_joint(spark, sf):
    rows = written(ratings(spark, sf), "ratings")
    return P.cross_validate_mf(rows, J.mf_implicit_joint, pair_key(), 3, "SVD++", parallelism=FOLDS)


@query("P9_naive_svd")
def p9(spark, sf):
    train, test = split(spark, sf)
    return P.rating_errors(P.naive_svd(train, test, 20)).withColumn("model", F.lit("Naive SVD"))


THIN = spread_hash_sql("k", 42)


@query(
    "P10_sparse_sample",
    "WITH " + RATINGS + f""", keyed AS (SELECT *, user_id * 1000003 + item_id AS k FROM ratings)
    SELECT user_id, item_id, rating FROM (SELECT *, row_number() OVER (ORDER BY {THIN}, k) AS i, count(*) OVER () AS n FROM keyed)
    WHERE i <= floor(n * (1 - CAST(0.99 AS DOUBLE)) + 0.5)""",
)
def p10_sample(spark, sf):
    rows = written(ratings(spark, sf), "ratings")
    return P.sparse_variant(rows, pair_key(), 0.99, order=spread_hash("_k", 42))


@query("P10_sparse_comparison")
def p10(spark, sf):
    rows = written(ratings(spark, sf), "ratings")
    thin = written(P.sparse_variant(rows, pair_key(), 0.99), "sparse")
    results = {}
    for name, data in (("standard", rows), ("sparse", thin)):
        if not P.enough_rows(data):
            continue
        train, test = data.filter(~is_test()), data.filter(is_test())
        results[name] = union_labeled(
            {
                "FunkSVD": P.rating_errors(P.mf_explicit(train, test)),
                "SVD++": P.rating_errors(J.mf_implicit_joint(train, test)),
                "NMF": P.rating_errors(P.predict_nonnegative(P.mf_nonnegative(train), train, test)),
                "Naive SVD": P.rating_errors(P.naive_svd(train, test, 20)),
            },
            "model",
        )
    return union_labeled(results)
