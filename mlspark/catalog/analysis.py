"""Causal effects, drift, anomaly detection, graph and batch scoring on the given tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mlspark.catalog import query
from mlspark.catalog.joined import all_dims
from mlspark.catalog.joined import PAIRS
from mlspark.catalog.ordered import COLLAPSED, EFFECT, rounded
from mlspark.operators import anomaly, causal, drift, graph
from mlspark.operators.batch import predict_batch
from mlspark.operators.kernel_boundary import kernel_boundary
from mlspark.plans.views import ERRORS, PLAYS, SCORED, TRIAL, event_values, plays, scored, table, trial
from mlspark.session import written

# ---- causal ----------------------------------------------------------------------------------------


@query("K1_naive_effect", "WITH " + TRIAL + " " + EFFECT)
def k1(spark, sf):
    return rounded(causal.naive_effect(trial(spark, sf), "treatment", "outcome"), 4, "mean_treated", "mean_control", "effect")


# one of the five segments is the base of the other four
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]


def covariates(spark, sf):
    flags = {s.lower(): (F.col("segment") == s).cast("int") for s in SEGMENTS}
    return trial(spark, sf).withColumn("balance", F.col("score") / 1000).withColumns(flags), ["balance", *flags]


@query("K2_propensity_scores")
def k2(spark, sf):
    rows, cols = covariates(spark, sf)
    return causal.propensity_scores(rows, cols, "treatment").select("row_id", "treatment", "propensity_score")


@query(
    "K3_psm_effect",
    "WITH " + TRIAL + """,
    t AS (SELECT DISTINCT score FROM trial WHERE treatment = 1),
    c AS (SELECT score AS x, min(row_id) AS id FROM trial WHERE treatment = 0 GROUP BY 1),
    m AS (SELECT score, arg_min(id, {'d': abs(score - x), 'id': id}) AS id FROM t CROSS JOIN c GROUP BY 1)
    SELECT round(avg(a.outcome - b.outcome), 4) AS effect, round(avg(a.outcome), 4) AS mean_treated, round(avg(b.outcome), 4) AS mean_matched, count(*) AS n_pairs
    FROM trial a JOIN m ON a.score = m.score JOIN trial b ON b.row_id = m.id WHERE a.treatment = 1""",
)
def k3(spark, sf):
    rows = written(trial(spark, sf), "trial")
    return rounded(causal.psm_effect(rows, "row_id", "treatment", "score", "outcome"), 4, "effect", "mean_treated", "mean_matched")


@query("K3_psm_effect_estimated")
def k3_full(spark, sf):
    rows, cols = covariates(spark, sf)
    scores = written(causal.propensity_scores(rows, cols, "treatment"), "propensity")
    return causal.psm_effect(scores, "row_id", "treatment", "propensity_score", "outcome")


# ---- drift ------------------------------------------------------------------------------------------


def halves(spark, sf):
    orders = table(spark, sf, "orders")
    before = F.col("o_orderdate") < F.lit("1998-07-01").cast("timestamp_ntz")
    return orders.filter(before), orders.filter(~before)


KS = """o AS (SELECT *, CAST(o_orderdate < TIMESTAMP '1998-07-01' AS INT) AS ref FROM orders),
  v AS (SELECT 'o_totalprice' AS "column", o_totalprice AS value, ref FROM o UNION ALL SELECT 'o_custkey', CAST(o_custkey AS DOUBLE), ref FROM o),
  c AS (SELECT "column", value, sum(ref) AS r, sum(1 - ref) AS u FROM v GROUP BY 1, 2),
  f AS (SELECT "column", sum(r) OVER w AS ur, sum(u) OVER w AS uu, sum(r) OVER p AS nr, sum(u) OVER p AS nu FROM c
        WINDOW w AS (PARTITION BY "column" ORDER BY value), p AS (PARTITION BY "column")),
  k0 AS (SELECT "column", max(abs(ur / nr - uu / nu)) AS statistic, any_value(CAST(nr AS DOUBLE)) AS nr, any_value(CAST(nu AS DOUBLE)) AS nu FROM f GROUP BY 1),
  k1 AS (SELECT *, sqrt(nr * nu / (nr + nu)) AS s FROM k0), k2 AS (SELECT *, (s + 0.12 + 0.11 / s) * statistic AS z FROM k1),
  ks AS (SELECT "column", 'ks' AS test, statistic, CASE WHEN z < 0.2 THEN 1.0 ELSE least(greatest(list_sum(list_transform(range(1, 101),
         lambda j: CASE WHEN j % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * j * j * z * z))), 0.0), 1.0) END AS p_value FROM k2)"""

CHI = """o2 AS (SELECT *, CAST(o_orderdate < TIMESTAMP '1998-07-01' AS INT) AS ref FROM orders),
  v2 AS (SELECT 'o_orderpriority' AS "column", o_orderpriority AS value, ref FROM o2 UNION ALL SELECT 'o_orderstatus', o_orderstatus, ref FROM o2),
  c2 AS (SELECT "column", value, CAST(sum(ref) AS DOUBLE) AS r, CAST(sum(1 - ref) AS DOUBLE) AS u FROM v2 GROUP BY 1, 2),
  t2 AS (SELECT *, sum(r) OVER p AS nr, sum(u) OVER p AS nu FROM c2 WINDOW p AS (PARTITION BY "column")),
  e2 AS (SELECT *, (r + u) / (nr + nu) AS share FROM t2),
  s2 AS (SELECT "column", sum((r - share * nr) * (r - share * nr) / (share * nr) + (u - share * nu) * (u - share * nu) / (share * nu)) AS statistic FROM e2 GROUP BY 1),
  chi AS (SELECT "column", 'chi2' AS test, statistic, exp(-statistic / 2) * CASE WHEN "column" = 'o_orderpriority' THEN 1 + statistic / 2 ELSE 1 END AS p_value FROM s2)"""

SHOWN = """SELECT "column", test, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value"""


@query("D1_ks_drift", "WITH " + KS + " " + SHOWN + " FROM ks")
def d1(spark, sf):
    return rounded(drift.ks_drift(*halves(spark, sf), ["o_totalprice", "o_custkey"]), 6, "statistic", "p_value")


@query("D2_chi2_drift", "WITH " + CHI + " " + SHOWN + " FROM chi")
def d2(spark, sf):
    return rounded(drift.chi2_drift(*halves(spark, sf), ["o_orderpriority", "o_orderstatus"]), 6, "statistic", "p_value")


@query(
    "D3_drift_report",
    "WITH " + KS + ", " + CHI + ", r AS (SELECT *, p_value < 0.05 AS drifted FROM (SELECT * FROM ks UNION ALL SELECT * FROM chi)) "
    + SHOWN + """, drifted FROM r UNION ALL SELECT '(dataset)', 'share', round(avg(CAST(drifted AS INT)), 6), NULL, avg(CAST(drifted AS INT)) >= 0.5 FROM r""",
)
def d3(spark, sf):
    report = drift.drift_report(*halves(spark, sf), ["o_totalprice", "o_custkey"], ["o_orderpriority", "o_orderstatus"])
    return rounded(report, 6, "statistic", "p_value")


# ---- anomalies ----------------------------------------------------------------------------------------

RULES = ((5, 4000), (10, 16000), (15, 25000))


@query(
    "N1_rule_detector",
    "WITH " + PLAYS + """ SELECT order_id, line_id, concat_ws(',', CASE WHEN playtime < 5 AND score > 4000 THEN 'under_5' END,
      CASE WHEN playtime < 10 AND score > 16000 THEN 'under_10' END, CASE WHEN playtime < 15 AND score > 25000 THEN 'under_15' END,
      CASE WHEN score > 95000 THEN 'over_limit' END, CASE WHEN playtime = 0 AND score <> 0 THEN 'unplayed' END) AS fired FROM plays
    WHERE (playtime < 5 AND score > 4000) OR (playtime < 10 AND score > 16000) OR (playtime < 15 AND score > 25000) OR score > 95000""",
)
def n1(spark, sf):
    flagged = anomaly.rule_detector(plays(spark, sf), "score", "playtime", RULES, 95000)
    return flagged.filter("anomaly_prediction = -1").select("order_id", "line_id", F.array_join("fired_rules", ",").alias("fired"))


@query("N2_isolation_forest")
def n2(spark, sf):
    rows = plays(spark, sf).withColumn("key", F.col("order_id") * 10 + F.col("line_id")).withColumn("pace", F.col("score") / F.col("playtime"))
    out = anomaly.isolation_forest(rows, "key", ["score", "playtime", "pace"], 0.03)
    return out.filter("anomaly = 1").select("order_id", "line_id", "score", "playtime")


NEAR = "n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dist, base_id) AS rank FROM d"


@query(
    "N3_lof",
    "WITH " + PAIRS + """, lab AS (SELECT vec_id, label FROM embeddings),
    b AS (SELECT d.* FROM d JOIN lab ON base_id = vec_id AND label < 7),
    tr AS (SELECT * FROM (SELECT b.*, row_number() OVER (PARTITION BY query_id ORDER BY dist, base_id) AS rank FROM b JOIN lab ON query_id = vec_id AND label < 7
           WHERE query_id <> base_id) WHERE rank <= 10),
    kd AS (SELECT query_id AS base_id, max(dist) AS k_dist FROM tr GROUP BY 1),
    lrd AS (SELECT query_id AS base_id, 1 / (avg(greatest(dist, k_dist)) + 1e-10) AS lrd FROM tr JOIN kd USING (base_id) GROUP BY 1),
    f AS (SELECT query_id, avg(lrd) / (1 / (avg(greatest(dist, k_dist)) + 1e-10)) AS lof FROM tr JOIN kd USING (base_id) JOIN lrd USING (base_id) GROUP BY 1),
    te AS (SELECT * FROM (SELECT b.*, row_number() OVER (PARTITION BY query_id ORDER BY dist, base_id) AS rank FROM b JOIN lab ON query_id = vec_id AND label >= 7) WHERE rank <= 10),
    g AS (SELECT query_id, avg(lrd) / (1 / (avg(greatest(dist, k_dist)) + 1e-10)) AS lof FROM te JOIN kd USING (base_id) JOIN lrd USING (base_id) GROUP BY 1)
    SELECT query_id AS vec_id, round(lof, 4) AS lof, CAST(lof > (SELECT quantile_cont(lof, 0.95) FROM f) AS INT) AS anomaly FROM g""",
)
def n3(spark, sf):
    vectors = table(spark, sf, "embeddings")
    out = anomaly.lof(vectors.filter("label < 7"), vectors.filter("label >= 7"), 10, "vec_id", "embedding", 0.05)
    return out.withColumn("lof", F.round("lof", 4))


@query(
    "N4_one_class_boundary",
    """WITH x AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity AS a, l_extendedprice AS b FROM lineitem),
       m AS (SELECT avg(a) AS ma, avg(b) AS mb, var_pop(a) AS vaa, var_pop(b) AS vbb, covar_pop(a, b) AS vab FROM x WHERE l_returnflag = 'N'),
       s AS (SELECT x.*, ((a - ma) * (a - ma) * vbb - 2 * (a - ma) * (b - mb) * vab + (b - mb) * (b - mb) * vaa) / (vaa * vbb - vab * vab) AS distance FROM x, m)
       SELECT l_orderkey, l_linenumber, round(distance, 4) AS distance FROM s
       WHERE distance > (SELECT quantile_cont(distance, 0.95) FROM s WHERE l_returnflag = 'N')""",
)
def n4(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_extendedprice")
    out = anomaly.one_class_boundary(lines, F.col("l_returnflag") == "N", ["l_quantity", "l_extendedprice"], 0.05)
    return out.filter("anomaly = 1").select("l_orderkey", "l_linenumber", F.round("distance", 4).alias("distance"))


@query("N4_kernel_boundary")
def n4_kernel(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_extendedprice")
    out = kernel_boundary(lines, F.col("l_returnflag") == "N", ["l_quantity", "l_extendedprice"], 0.05)
    return out.filter("anomaly = 1").select("l_orderkey", "l_linenumber", F.round("score", 4).alias("score"))


@query("N5_detector_votes")
def n5_detectors(spark, sf):
    # labels 7 and up are the novel ones; a fifth of the others is kept from fitting
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding", (F.col("label") >= 7).cast("int").alias("label"))
    known = (F.col("label") == 0) & (F.col("vec_id") % 5 != 0)
    tested = rows.filter(~known)
    near = anomaly.lof(rows.filter(known), tested, 10, "vec_id", "embedding", 0.05).select("vec_id", F.col("anomaly").alias("lof"))
    names = [f"e{i}" for i in range(len(rows.first()["embedding"]))]
    wide = written(rows.select("vec_id", "label", *[F.col("embedding")[i].alias(c) for i, c in enumerate(names)]), "wide")
    edge = kernel_boundary(wide, known, names, 0.05).select("vec_id", F.col("anomaly").alias("edge"))
    tree = anomaly.isolation_forest(wide, "vec_id", names, 0.05).select("vec_id", F.col("anomaly").alias("tree"))
    flags = tested.select("vec_id", "label").join(near, "vec_id").join(edge, "vec_id").join(tree, "vec_id")
    return anomaly.vote_ensemble(written(flags, "flags"), ["lof", "edge", "tree"], "label")


@query(
    "N5_vote_ensemble",
    "WITH " + SCORED + """, v AS (SELECT label, CAST(score >= 0.05 AS INT) + CAST(quality = 0 AS INT) + CAST(doc_id % 7 = 0 AS INT) AS votes FROM scored),
    p AS (SELECT t AS threshold, label, CAST(votes >= t AS INT) AS pr FROM v, (SELECT unnest([1, 2, 3]) AS t)),
    c AS (SELECT threshold, CAST(sum(CAST(label = 1 AND pr = 1 AS INT)) AS BIGINT) AS tp, sum(pr) AS pp, CAST(sum(label) AS BIGINT) AS support FROM p GROUP BY 1)
    SELECT threshold, round(CASE WHEN pp = 0 THEN 0 ELSE tp / pp END, 6) AS precision, round(tp / support, 6) AS recall, round(2 * tp / (pp + support), 6) AS f1, support FROM c""",
)
def n5(spark, sf):
    rows = scored(spark, sf).select(
        "label",
        (F.col("score") >= 0.05).cast("int").alias("by_score"),
        (F.col("quality") == 0).cast("int").alias("by_quality"),
        (F.col("doc_id") % 7 == 0).cast("int").alias("by_id"),
    )
    report = anomaly.vote_ensemble(rows, ["by_score", "by_quality", "by_id"], "label")
    return rounded(report.filter("class = '1'").drop("class"), 6, "precision", "recall", "f1")


def normal_events(spark, sf):
    return table(spark, sf, "events").select("user_id", "event_id", "value", (F.col("event_type") != "error").alias("usual"))


@query("N6_reconstruction_error")
def n6(spark, sf):
    return anomaly.reconstruction_error(normal_events(spark, sf), ["user_id"], "event_id", "value", F.col("usual"), 3, 1)


@query(
    "N7_detect_from_errors",
    "WITH " + ERRORS + """, cut AS (SELECT user_id, quantile_cont(value, 0.9) AS t FROM events GROUP BY 1),
    cand AS (SELECT e.user_id, idx - 1 + 1 AS idx FROM errors e JOIN cut ON cut.user_id = e.user_id WHERE value > t)""" + COLLAPSED,
)
def n7(spark, sf):
    return anomaly.detect_from_errors(event_values(spark, sf), ["user_id"], "event_id", "value", 90, 3)


@query("N6_detect_rebuild_anomalies")
def n6_detect(spark, sf):
    errors = anomaly.reconstruction_error(normal_events(spark, sf), ["user_id"], "event_id", "value", F.col("usual"), 3, 1)
    return anomaly.detect_from_errors(written(errors, "errors"), ["user_id"], "event_id", "error", 90, 3)


# ---- graph and batch scoring ---------------------------------------------------------------------------


def citation_graph(spark, sf):
    vectors = table(spark, sf, "embeddings")
    edges = written(graph.both_ways(graph.knn_graph(vectors, 5)), "knn-edges")
    place = F.col("vec_id") % 10
    vertices = vectors.select(
        F.col("vec_id").alias("id"),
        F.col("embedding").alias("features"),
        "label",
        F.when(place < 6, "train").when(place < 8, "val").otherwise("test").alias("split"),
    )
    return vertices, edges


@query(
    "G1_propagate",
    "WITH " + PAIRS + """,
    near AS (SELECT query_id AS src, base_id AS dst FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dist, base_id) AS rank FROM d WHERE query_id <> base_id) WHERE rank <= 5),
    e AS (SELECT DISTINCT src, dst FROM (SELECT src, dst FROM near UNION ALL SELECT dst, src FROM near) UNION ALL SELECT vec_id, vec_id FROM embeddings),
    deg AS (SELECT dst AS id, count(*) AS c FROM e GROUP BY 1),
    w AS (SELECT src, dst, 1 / sqrt(a.c * b.c) AS w FROM e JOIN deg a ON a.id = src JOIN deg b ON b.id = dst)
    SELECT dst AS id, round(sum(w * q.e[1]), 6) AS h0, round(sum(w * q.e[64]), 6) AS h63,
      round(sum(w * list_sum(list_transform(range(1, 65), lambda i: i * q.e[i]))), 3) AS all_dims FROM w JOIN q ON q.vec_id = src GROUP BY 1""",
)
def g1(spark, sf):
    vertices, edges = citation_graph(spark, sf)
    out = graph.propagate(vertices, edges, 1)
    return out.select("id", F.round(F.col("features")[0], 6).alias("h0"), F.round(F.col("features")[63], 6).alias("h63"), all_dims("features"))


@query("G1_propagate_two_hops")
def g1_two(spark, sf):
    vertices, edges = citation_graph(spark, sf)
    return graph.propagate(vertices, edges, 2)


@query("G2_classify_nodes")
def g2(spark, sf):
    return graph.classify_nodes(*citation_graph(spark, sf))


def linear_model():
    weights = np.linspace(-1, 1, 64)

    def predict(vectors: np.ndarray) -> np.ndarray:
        return vectors @ weights

    return predict


@query(
    "B1_predict_batch",
    """SELECT vec_id, round(list_sum(list_transform(range(1, 65), lambda i: CAST(embedding[i] AS DOUBLE) * (-1 + 2 * (i - 1) / 63))), 5) AS prediction FROM embeddings""",
)
def b1(spark, sf):
    vectors = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    out = predict_batch(vectors, linear_model, ["embedding"], input_shapes=[[64]], kind=T.DoubleType())
    return out.select("vec_id", F.round("prediction", 5).alias("prediction"))
