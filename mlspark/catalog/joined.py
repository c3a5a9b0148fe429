"""Joins, neighbours and similarity on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from mlspark.catalog import query
from mlspark.operators import joins, sampling
from mlspark.operators.features import tfidf_l2
from mlspark.plans.ordered import spread_hash, spread_hash_sql
from mlspark.plans.views import DAILY, ITEM_TERMS, SPLIT, daily_sales, item_terms, table, train_test
from mlspark.session import written


@query(
    "J1_attach_titles",
    """SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN p_partkey % 10 <> 0 THEN p_name END, 'N/A') AS p_name
       FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
)
def j1(spark, sf):
    items = table(spark, sf, "part").filter("p_partkey % 10 <> 0").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.attach_titles(lines, items, "l_partkey", "p_name").drop("l_partkey")


@query("J2_join_features", "SELECT l.doc_id, quality, toxic, lang, n_chars FROM labels l JOIN documents d ON l.doc_id = d.doc_id")
def j2(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return joins.join_features(table(spark, sf, "labels"), docs, "doc_id")


@query(
    "J3_semi_known",
    "WITH " + SPLIT + " SELECT * FROM test WHERE user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train)",
)
def j3(spark, sf):
    train, test = train_test(spark, sf)
    return joins.semi_known(test, train, ["user_id", "item_id"])


@query(
    "J4_anti_seen",
    "WITH " + SPLIT + """ SELECT DISTINCT l_suppkey AS user_id, l_partkey AS item_id FROM lineitem
      WHERE NOT EXISTS (SELECT 1 FROM train WHERE user_id = l_suppkey AND item_id = l_partkey)""",
)
def j4(spark, sf):
    train, _ = train_test(spark, sf)
    wanted = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("user_id"), F.col("l_partkey").alias("item_id")).distinct()
    return joins.anti_seen(wanted, train, ["user_id", "item_id"])


@query(
    "J5_nearest_join",
    """WITH t AS (SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'),
            c AS (SELECT c_acctbal AS x, min(c_custkey) AS id FROM customer WHERE c_mktsegment <> 'BUILDING' GROUP BY 1),
            p AS (SELECT c_custkey, id, x, abs(c_acctbal - x) AS d FROM t JOIN c ON true)
       SELECT c_custkey, id AS matched_c_custkey, x AS matched_c_acctbal, round(d, 4) AS distance FROM (
         SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY d, id) AS rn FROM p) WHERE rn = 1""",
)
def j5(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    treated = customer.filter("c_mktsegment = 'BUILDING'")
    control = customer.filter("c_mktsegment <> 'BUILDING'")
    out = joins.nearest_join(treated, control, "c_acctbal", "c_custkey", "c_custkey")
    return out.withColumn("distance", F.round("distance", 4))


@query(
    "J6_nearest_date",
    "WITH " + DAILY + """ SELECT series_id, arg_min(day, {'d': abs(date_diff('day', DATE '1997-03-15', day)), 'day': day}) AS day,
      arg_min(value, {'d': abs(date_diff('day', DATE '1997-03-15', day)), 'day': day}) AS value
      FROM (SELECT * FROM daily_sales WHERE month(day) <> 3) GROUP BY 1""",
)
def j6(spark, sf):
    sales = daily_sales(spark, sf).filter(F.month("day") != 3)
    return joins.nearest_date(sales, ["series_id"], "day", "value", F.lit("1997-03-15").cast("date"))


PAIRS = """q AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
  d AS (SELECT a.vec_id AS query_id, b.vec_id AS base_id, round(list_distance(a.e, b.e), 6) AS dist FROM q a JOIN q b ON true)"""


@query(
    "J7_vector_topk",
    "WITH " + PAIRS + """ SELECT query_id, base_id, dist, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dist, base_id) AS rank FROM d WHERE query_id <> base_id) WHERE rank <= 10""",
)
def j7(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return joins.vector_topk(vectors, vectors, 10, exclude_self=True)


@query(
    "J7_vector_topk_cosine",
    """WITH q AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
       d AS (SELECT a.vec_id AS query_id, b.vec_id AS base_id, list_cosine_similarity(a.e, b.e) AS s FROM q a JOIN q b ON a.vec_id <> b.vec_id)
       SELECT query_id, base_id, round(s, 4) AS similarity, rank FROM (
         SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(sqrt(2 - 2 * least(s, 1)), 6), base_id) AS rank FROM d) WHERE rank <= 5""",
)
def j7_cosine(spark, sf):
    vectors = table(spark, sf, "embeddings")
    out = joins.vector_topk(vectors, vectors, 5, metric="cosine", exclude_self=True)
    return out.select("query_id", "base_id", F.round("similarity", 4).alias("similarity"), "rank")


@query("J8_vector_within", "WITH " + PAIRS + " SELECT query_id, base_id, dist FROM d WHERE dist <= 1.2 AND query_id <> base_id")
def j8(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return joins.vector_within(vectors, vectors, 1.2, exclude_self=True)


@query(
    "J9_annotate_events",
    "WITH " + DAILY + """, notes AS (SELECT CAST(o_orderdate AS DATE) AS day, CASE WHEN max(o_orderkey) % 2 = 0 THEN 'sharp drop' ELSE 'new high' END AS note
        FROM orders WHERE day(o_orderdate) = 1 GROUP BY 1),
      m AS (SELECT series_id, avg(value) AS mean FROM daily_sales GROUP BY 1)
      SELECT d.series_id, d.day, d.value, note, CASE WHEN contains(note, 'drop') THEN 'red' ELSE 'green' END AS color,
             round(d.value * CASE WHEN d.value < mean THEN CAST(1.2 AS DOUBLE) ELSE CAST(0.8 AS DOUBLE) END, 4) AS label_y
      FROM daily_sales d JOIN notes n ON d.day = n.day JOIN m ON m.series_id = d.series_id""",
)
def j9(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day"), "o_orderkey")
    notes = orders.filter(F.dayofmonth("day") == 1).groupBy("day").agg(
        F.when(F.max("o_orderkey") % 2 == 0, "sharp drop").otherwise("new high").alias("note")
    )
    out = joins.annotate_events(daily_sales(spark, sf), notes, ["series_id"], "day", "value", "note")
    return out.withColumn("label_y", F.round("label_y", 4))


USER_SIMS = SPLIT + """,
  un AS (SELECT user_id, sqrt(sum(CAST(rating AS DOUBLE) * rating)) AS norm FROM train GROUP BY 1),
  uw AS (SELECT t.user_id, item_id, rating / norm AS w FROM train t JOIN un ON t.user_id = un.user_id),
  usim AS (SELECT x.user_id AS a, y.user_id AS b, sum(x.w * y.w) AS sim FROM uw x JOIN uw y ON x.item_id = y.item_id AND x.user_id <> y.user_id GROUP BY 1, 2),
  near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(sim, 6) DESC, b) AS rank FROM usim) WHERE rank <= 40)"""


def neighbours(spark, sf, k=40):
    train, _ = train_test(spark, sf)
    return joins.user_similarity(written(train, "train"), k)


@query("J10_user_similarity", "WITH " + USER_SIMS + " SELECT a, b, round(sim, 4) AS sim, rank FROM near")
def j10(spark, sf):
    return neighbours(spark, sf).withColumn("sim", F.round("sim", 4))


ITEM_WEIGHTS = ITEM_TERMS + """,
  df AS (SELECT term, count(*) AS df FROM item_terms GROUP BY 1),
  raw AS (SELECT item_id, t.term, tf * (ln((1 + (SELECT count(*) FROM part)) / (1 + df)) + 1) AS v FROM item_terms t JOIN df ON t.term = df.term),
  iw AS (SELECT item_id, term, v / sqrt(sum(v * v) OVER (PARTITION BY item_id)) AS w FROM raw)"""


def item_weights(spark, sf):
    return tfidf_l2(item_terms(spark, sf), "item_id", "term", "tf")


@query(
    "J11_item_similarity",
    "WITH " + ITEM_WEIGHTS + """,
    s AS (SELECT x.item_id AS a, y.item_id AS b, sum(x.w * y.w) AS sim FROM iw x JOIN iw y ON x.term = y.term AND x.item_id <> y.item_id GROUP BY 1, 2)
    SELECT a, b, round(sim, 4) AS sim, rank FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(sim, 6) DESC, b) AS rank FROM s) WHERE rank <= 20""",
)
def j11(spark, sf):
    weights = written(item_weights(spark, sf), "item-weights")
    return joins.item_similarity(weights, 20).withColumn("sim", F.round("sim", 4))


@query(
    "J12_candidate_pairs",
    "WITH " + USER_SIMS + """, c AS (SELECT DISTINCT n.a AS user_id, t.item_id FROM near n JOIN train t ON t.user_id = n.b
       WHERE NOT EXISTS (SELECT 1 FROM train s WHERE s.user_id = n.a AND s.item_id = t.item_id))
    SELECT user_id, count(*) AS n_candidates, CAST(sum(item_id) AS BIGINT) AS item_sum FROM c GROUP BY 1""",
)
def j12(spark, sf):
    train, _ = train_test(spark, sf)

    def totals(reach, wave):
        pairs = reach.select("user_id", "item_id").distinct()
        return pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_candidates"), F.sum("item_id").alias("item_sum"))

    return joins.candidate_pairs(neighbours(spark, sf), train, then=totals)


@query(
    "S2_skip_first_topk",
    "WITH " + PAIRS + """ SELECT query_id, base_id, dist, rank - 1 AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dist, base_id) AS rank FROM d) WHERE rank BETWEEN 2 AND 6""",
)
def s2(spark, sf):
    vectors = table(spark, sf, "embeddings")
    near = joins.vector_topk(vectors, vectors, 6).drop("rank")
    return sampling.skip_first_topk(near, ["query_id"], "dist", 5, ["base_id"])


def all_dims(vector: str):
    """One number that every dimension takes part in, each with its own weight."""
    weighted = F.transform(vector, lambda x, i: x * (i + 1))
    return F.round(F.aggregate(weighted, F.lit(0.0), lambda a, b: a + b), 3).alias("all_dims")


@query(
    "S11_smote",
    "WITH " + PAIRS.replace("FROM embeddings)", "FROM embeddings WHERE label = 0)") + f""",
    near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dist, base_id) AS rank FROM d WHERE query_id <> base_id) WHERE rank <= 5),
    c AS (SELECT count(*) FILTER (label = 0) AS few, count(*) FILTER (label <> 0) - count(*) FILTER (label = 0) AS wanted FROM embeddings),
    m AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS pos FROM q),
    p AS (SELECT vec_id, unnest(range(1, CAST(wanted // few + CASE WHEN pos <= wanted % few THEN 1 ELSE 0 END AS BIGINT) + 1)) AS copy FROM m, c),
    r AS (SELECT vec_id, copy, {spread_hash_sql('vec_id * 1009 + copy', 1)} % 5 + 1 AS rank, ({spread_hash_sql('vec_id * 1009 + copy', 2)} % 1000) / CAST(1000 AS DOUBLE) AS gap FROM p)
    SELECT r.vec_id, r.copy, base_id AS neighbour, round(a.e[1] + (b.e[1] - a.e[1]) * gap, 6) AS v0, round(a.e[64] + (b.e[64] - a.e[64]) * gap, 6) AS v63,
      round(list_sum(list_transform(range(1, 65), lambda i: i * (a.e[i] + (b.e[i] - a.e[i]) * gap))), 3) AS all_dims
    FROM r JOIN near n ON n.query_id = r.vec_id AND n.rank = r.rank JOIN q a ON a.vec_id = r.vec_id JOIN q b ON b.vec_id = base_id""",
)
def s11(spark, sf):
    def draw(key, copy, salt):
        return spread_hash(key * 1009 + copy, salt)

    out = sampling.smote(table(spark, sf, "embeddings"), "label", 0, "vec_id", "embedding", 5, draw=draw)
    v = F.col("embedding")
    return out.select("vec_id", "copy", "neighbour", F.round(v[0], 6).alias("v0"), F.round(v[63], 6).alias("v63"), all_dims("embedding"))
