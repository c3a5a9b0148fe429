"""Window operators, aggregates, metrics and sampling on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from mlspark.catalog import query
from mlspark.functions.text import tokenize
from mlspark.operators import metrics, sampling, windows
from mlspark.plans.ordered import row_index, spread_hash, spread_hash_sql
from mlspark.plans.views import (
    DAILY, ERRORS, MONTHLY, PLAYS, SCORED, TRIAL, daily_sales, event_values, monthly_sales, plays, scored, table, trial,
)

SERIES = ["series_id"]


def rounded(df, digits=4, *cols):
    return df.withColumns({c: F.round(c, digits) for c in cols})


@query(
    "X7_financial_metrics",
    "WITH " + DAILY + """,
    a AS (SELECT *, value / lag(value) OVER w - 1 AS r,
                 CASE WHEN count(value) OVER w25 = 25 THEN avg(value) OVER w25 END AS m25,
                 CASE WHEN count(value) OVER w75 = 75 THEN avg(value) OVER w75 END AS m75
          FROM daily_sales WINDOW w AS (PARTITION BY series_id ORDER BY day),
               w25 AS (PARTITION BY series_id ORDER BY day ROWS BETWEEN 24 PRECEDING AND CURRENT ROW),
               w75 AS (PARTITION BY series_id ORDER BY day ROWS BETWEEN 74 PRECEDING AND CURRENT ROW))
    SELECT series_id, day, value, round(m25, 4) AS ma_25, round(m75, 4) AS ma_75, round(r, 6) AS daily_return,
           round(CASE WHEN count(r) OVER w30 = 30 THEN stddev_samp(r) OVER w30 END * sqrt(365), 4) AS volatility
    FROM a WINDOW w30 AS (PARTITION BY series_id ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
)
def x7(spark, sf):
    out = windows.financial_metrics(daily_sales(spark, sf), SERIES, "day", "value", calendar=True)
    return rounded(rounded(out, 4, "ma_25", "ma_75", "volatility"), 6, "daily_return")


@query(
    "W1_moving_average",
    "WITH " + DAILY + """
    SELECT series_id, day, round(CASE WHEN count(value) OVER w = 25 THEN avg(value) OVER w END, 4) AS moving_average
    FROM daily_sales WINDOW w AS (PARTITION BY series_id ORDER BY day ROWS BETWEEN 24 PRECEDING AND CURRENT ROW)""",
)
def w1(spark, sf):
    out = windows.moving_average(daily_sales(spark, sf), SERIES, "day", "value", 25, calendar=True)
    return rounded(out, 4, "moving_average").drop("value")


@query(
    "W2_pct_change",
    """SELECT event_id, user_id, round(v / lag(v) OVER (PARTITION BY user_id ORDER BY event_id) - 1, 6) AS daily_return
       FROM (SELECT *, value + 1 AS v FROM events)""",
)
def w2(spark, sf):
    events = event_values(spark, sf).select("event_id", "user_id", (F.col("value") + 1).alias("v"))
    return rounded(windows.pct_change(events, ["user_id"], "event_id", "v"), 6, "daily_return").drop("v")


@query(
    "W3_annualized_volatility",
    "WITH " + DAILY + """,
    r AS (SELECT *, value / lag(value) OVER (PARTITION BY series_id ORDER BY day) - 1 AS r FROM daily_sales)
    SELECT series_id, day, round(CASE WHEN count(r) OVER w = 30 THEN stddev_samp(r) OVER w END * sqrt(365), 4) AS volatility
    FROM r WINDOW w AS (PARTITION BY series_id ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
)
def w3(spark, sf):
    returns = windows.pct_change(daily_sales(spark, sf), SERIES, "day", "value", calendar=True)
    out = windows.annualized_volatility(returns, SERIES, "day", "daily_return", calendar=True)
    return rounded(out, 4, "volatility").select("series_id", "day", "volatility")


@query(
    "W4_smooth_valid",
    """SELECT * FROM (SELECT event_id, user_id, round(CASE WHEN count(value) OVER w = 10 THEN avg(value) OVER w END, 6) AS smoothed
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)) WHERE smoothed IS NOT NULL""",
)
def w4(spark, sf):
    out = windows.smooth_valid(event_values(spark, sf), ["user_id"], "event_id", "value", 10)
    return rounded(out, 6, "smoothed").select("event_id", "user_id", "smoothed")


@query(
    "W4_last_mean",
    """SELECT user_id, round(avg(value), 6) AS last_mean, count(*) AS n_rows FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn <= 10 GROUP BY 1""",
)
def w4_last(spark, sf):
    return rounded(windows.last_mean(event_values(spark, sf), ["user_id"], "event_id", "value", 10), 6, "last_mean")


@query(
    "W5_boost_flag",
    """SELECT event_id, user_id, coalesce((v > 0 AND m <= 0) OR (m > 0 AND v / m >= 1.2), false) AS boost FROM (
         SELECT event_id, user_id, v, CASE WHEN count(v) OVER w = 5 THEN avg(v) OVER w END AS m FROM (SELECT *, value - 20 AS v FROM events)
         WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))""",
)
def w5(spark, sf):
    events = event_values(spark, sf).select("event_id", "user_id", (F.col("value") - 20).alias("v"))
    return windows.boost_flag(events, ["user_id"], "event_id", "v", 5, 1.2).drop("v")


@query(
    "W6_sequences",
    """SELECT event_id, user_id, win AS "window" FROM (
         SELECT event_id, user_id, list(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS win
         FROM events) WHERE len(win) = 3""",
)
def w6(spark, sf):
    out = windows.sequences(event_values(spark, sf), ["user_id"], "event_id", "value", 3)
    return out.select("event_id", "user_id", "window")


@query(
    "W7_supervised_windows",
    "WITH " + DAILY + """
    SELECT series_id, day, win AS "window", target, target_order FROM (
      SELECT series_id, day, list(value) OVER (PARTITION BY series_id ORDER BY day ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS win,
             lead(value, 5) OVER (PARTITION BY series_id ORDER BY day) AS target,
             lead(day, 5) OVER (PARTITION BY series_id ORDER BY day) AS target_order FROM daily_sales) WHERE target IS NOT NULL""",
)
def w7(spark, sf):
    return windows.supervised_windows(daily_sales(spark, sf), SERIES, "day", "value", 5, calendar=True).drop("value")


@query(
    "W8_chronological_split",
    """SELECT event_id, user_id, idx, CASE WHEN idx <= t THEN 'train' ELSE 'test' END AS part, idx > t - 5 AS test_input FROM (
         SELECT event_id, user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS idx,
                floor(count(*) OVER (PARTITION BY user_id) * CAST(0.8 AS DOUBLE)) AS t FROM events)""",
)
def w8(spark, sf):
    events = event_values(spark, sf).select("event_id", "user_id")
    return windows.chronological_split(events, ["user_id"], "event_id", 0.2, step=5)


COLLAPSED = """,
    c AS (SELECT *, sum(CASE WHEN idx - p > 2 OR p IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY idx) AS g
          FROM (SELECT *, lag(idx) OVER (PARTITION BY user_id ORDER BY idx) AS p FROM cand)),
    l AS (SELECT user_id, list(idx ORDER BY idx) AS xs FROM c GROUP BY user_id, g)
    SELECT user_id, xs[len(xs) // 2 + 1] AS idx, CAST(len(xs) AS BIGINT) AS run_size FROM l"""


@query("W9_collapse_adjacent", "WITH " + ERRORS + ", cand AS (SELECT user_id, idx FROM errors WHERE value > 30)" + COLLAPSED)
def w9(spark, sf):
    indexed = row_index(event_values(spark, sf), ["user_id"], "event_id", out="idx")
    candidates = indexed.filter(F.col("value") > 30).select("user_id", "idx")
    return windows.collapse_adjacent(candidates, ["user_id"], "idx", 2)


@query(
    "W10_topn_per_group",
    """SELECT * FROM (SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rank FROM lineitem) WHERE rank <= 10""",
)
def w10(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    return windows.topn_per_group(lines, ["l_suppkey"], "l_extendedprice", 10, ["l_orderkey", "l_linenumber"])


@query(
    "W12_gap_segments",
    """WITH e AS (SELECT user_id, event_id, epoch_us(ts) // 1000 AS ms FROM events),
       f AS (SELECT *, coalesce(ms - lag(ms) OVER w >= 21600000, true) AS b, coalesce(lead(ms) OVER w - ms >= 21600000, false) AS z
             FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ms, event_id)),
       g AS (SELECT *, CAST(sum(CAST(b AS INT)) OVER (PARTITION BY user_id ORDER BY ms, event_id) AS BIGINT) AS segment FROM f)
       SELECT user_id, segment, min(ms) - CASE WHEN segment > 1 THEN 600000 ELSE 0 END AS start_ms,
              max(ms) + CASE WHEN bool_or(z) THEN 600000 ELSE 0 END AS end_ms, count(*) AS n_events FROM g GROUP BY user_id, segment""",
)
def w12(spark, sf):
    events = event_values(spark, sf).select("user_id", "event_id", "ts")
    return windows.gap_segments(events, ["user_id"], "ts", 21_600_000, 600_000, ["event_id"])


@query(
    "W13_trend_commentary",
    "WITH " + MONTHLY + """,
    s AS (SELECT series_id, month, value / 1000000 - 20 AS v FROM monthly_sales),
    n AS (SELECT series_id, max(month) AS nm, max_by(v, month) AS nv FROM s GROUP BY 1),
    p AS (SELECT n.series_id, nm, nv, arg_min({'m': month, 'v': s.v}, {'d': abs(date_diff('day', CAST(nm - INTERVAL 2 YEAR AS DATE), month)), 'm': month}) AS past
          FROM s JOIN n ON s.series_id = n.series_id GROUP BY 1, 2, 3)
    SELECT series_id, nm AS latest_month, past.m AS past_month,
      printf('最新のトレンドは「%s」を示しています。', CASE WHEN nv > 0.001 THEN '明確な増加傾向' WHEN nv < -0.001 THEN '明確な減少傾向' ELSE 'ほぼ横ばい' END)
      || chr(10) || printf('  - 最新(%s)の上昇ペース: %.4f ppm/月', strftime(nm, '%Y年%m月'), nv) || chr(10) ||
      CASE WHEN abs(past.v) < 1e-6 THEN '2年前のトレンドがほぼゼロのため、加速/減速の評価はスキップします。' ELSE
        printf('2年前と比較して、%s。', CASE WHEN nv > past.v THEN 'ペースは加速しています' WHEN nv < past.v THEN 'ペースは減速しています' ELSE 'ペースはほぼ同じです' END)
        || chr(10) || printf('  - 2年前(%s)の上昇ペース: %.4f ppm/月', strftime(past.m, '%Y年%m月'), past.v)
        || chr(10) || printf('  - 上昇ペースは約 %.2f 倍に変化しました。', nv / past.v) END AS commentary FROM p""",
)
def w13(spark, sf):
    slopes = monthly_sales(spark, sf).withColumn("value", F.col("value") / 1000000 - 20)
    return windows.trend_commentary(slopes, SERIES, "month", "value", 2)


@query(
    "A1_describe_table",
    """SELECT count(*) AS n_rows, count(DISTINCT l_partkey) AS n_distinct_l_partkey, count(DISTINCT l_suppkey) AS n_distinct_l_suppkey,
              count(CASE WHEN l_linenumber > 3 THEN l_tax END) AS n_tax FROM lineitem""",
)
def a1(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("tax", F.when(F.col("l_linenumber") > 3, F.col("l_tax")))
    return metrics.describe_table(lines, ["l_partkey", "l_suppkey"], ["tax"])


@query("A1_class_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def a1_classes(spark, sf):
    return metrics.class_counts(table(spark, sf, "events"), "event_type")


EFFECT = """SELECT round(avg(outcome) FILTER (treatment = 1), 4) AS mean_treated, round(avg(outcome) FILTER (treatment = 0), 4) AS mean_control,
       round(avg(outcome) FILTER (treatment = 1) - avg(outcome) FILTER (treatment = 0), 4) AS effect FROM trial"""


@query("A2_group_effect", "WITH " + TRIAL + " " + EFFECT)
def a2(spark, sf):
    return rounded(metrics.group_effect(trial(spark, sf), "treatment", "outcome"), 4, "mean_treated", "mean_control", "effect")


@query(
    "A3_regression_metrics",
    """WITH p AS (SELECT l_returnflag, l_extendedprice / 1000 AS y, l_quantity * 1.9 AS f FROM lineitem)
       SELECT l_returnflag, round(avg(abs(y - f)), 6) AS mae, round(avg((y - f) * (y - f)), 6) AS mse, round(sqrt(avg((y - f) * (y - f))), 6) AS rmse,
              round(1 - sum((y - f) * (y - f)) / (var_pop(y) * count(*)), 6) AS r2, round(avg(CASE WHEN y <> 0 THEN abs((y - f) / y) END) * 100, 4) AS mape,
              count(CASE WHEN y = 0 THEN 1 END) AS n_zero_actual, count(*) AS n FROM p GROUP BY 1""",
)
def a3(spark, sf):
    pairs = table(spark, sf, "lineitem").select(
        "l_returnflag", (F.col("l_extendedprice") / 1000).alias("y"), (F.col("l_quantity") * 1.9).alias("f")
    )
    out = metrics.regression_metrics(pairs, "y", "f", ["l_returnflag"])
    return rounded(rounded(out, 6, "mae", "mse", "rmse", "r2"), 4, "mape")


def predictions(spark, sf):
    return scored(spark, sf).withColumn("prediction", (F.col("score") >= 0.1).cast("int"))


PREDICTIONS = SCORED + ", pred AS (SELECT *, CAST(score >= 0.1 AS INT) AS prediction FROM scored)"

REPORT = """,
    k AS (SELECT class, sum(s) AS s, sum(p) AS p, sum(tp) AS tp FROM (
            SELECT CAST(label AS VARCHAR) AS class, 1 AS s, 0 AS p, CAST(label = prediction AS INT) AS tp FROM pred
            UNION ALL SELECT CAST(prediction AS VARCHAR), 0, 1, 0 FROM pred) GROUP BY 1),
    r AS (SELECT class, CASE WHEN p = 0 THEN 0 ELSE tp / p END AS precision, CASE WHEN s = 0 THEN 0 ELSE tp / s END AS recall,
                 CASE WHEN s + p = 0 THEN 0 ELSE 2 * tp / (s + p) END AS f1, CAST(s AS BIGINT) AS support, tp FROM k)
    SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM r
    UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM r
    UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM r
    UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
                     round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM r"""


@query("A4_classification_report", "WITH " + PREDICTIONS + REPORT)
def a4(spark, sf):
    return rounded(metrics.classification_report(predictions(spark, sf), "label", "prediction"), 6, "precision", "recall", "f1")


@query("A5_confusion_matrix", "WITH " + PREDICTIONS + " SELECT label, prediction, count(*) AS n FROM pred GROUP BY 1, 2")
def a5(spark, sf):
    return metrics.confusion_matrix(predictions(spark, sf), "label", "prediction")


@query("A5_accuracy", "WITH " + PREDICTIONS + " SELECT avg(CAST(label = prediction AS INT)) AS accuracy FROM pred")
def a5_accuracy(spark, sf):
    return metrics.accuracy(predictions(spark, sf), "label", "prediction")


CURVE = SCORED + """,
    s AS (SELECT score, sum(label) AS p, count(*) AS n FROM scored GROUP BY 1),
    c AS (SELECT score, p, n, sum(p) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS fl, (SELECT sum(label) FROM scored) AS pos FROM s),
    curve AS (SELECT score AS threshold, tp / fl AS precision, tp / pos AS recall,
              CASE WHEN fl - n = 0 THEN 1.0 ELSE (tp - p) / (fl - n) END AS precision_before, (tp - p) / pos AS recall_before FROM c)"""


@query(
    "A6_pr_curve",
    "WITH " + CURVE + """ SELECT threshold, round(precision, 6) AS precision, round(recall, 6) AS recall,
    round(CAST(precision_before AS DOUBLE), 6) AS precision_before, round(recall_before, 6) AS recall_before FROM curve""",
)
def a6(spark, sf):
    out = metrics.pr_curve(scored(spark, sf), "label", "score")
    return rounded(out, 6, "precision", "recall", "precision_before", "recall_before")


@query("A6_pr_auc", "WITH " + CURVE + " SELECT round(sum((recall - recall_before) * (precision + precision_before) / 2), 6) AS pr_auc FROM curve")
def a6_auc(spark, sf):
    return rounded(metrics.pr_auc(scored(spark, sf), "label", "score"), 6, "pr_auc")


@query(
    "A7_precision_at_n",
    """WITH recs AS (SELECT l_suppkey AS user_id, l_partkey AS item_id FROM (
         SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rn FROM lineitem) WHERE rn <= 10),
       pos AS (SELECT DISTINCT l_suppkey AS user_id, l_partkey AS item_id FROM lineitem WHERE l_quantity >= 45),
       h AS (SELECT r.user_id, count(*) AS hits FROM recs r WHERE EXISTS (SELECT 1 FROM pos p WHERE p.user_id = r.user_id AND p.item_id = r.item_id) GROUP BY 1)
       SELECT round(avg(coalesce(hits, 0) / 10), 6) AS precision, count(*) AS n_users
       FROM (SELECT DISTINCT user_id FROM pos) u LEFT JOIN h ON u.user_id = h.user_id""",
)
def a7(spark, sf):
    lines = table(spark, sf, "lineitem").withColumnsRenamed({"l_suppkey": "user_id", "l_partkey": "item_id"})
    best = windows.topn_per_group(lines, ["user_id"], "l_extendedprice", 10, ["l_orderkey", "l_linenumber"])
    return rounded(metrics.precision_at_n(best, lines.filter("l_quantity >= 45"), 10), 6, "precision")


@query("A8_quantile_threshold", "SELECT user_id, round(quantile_cont(value, 0.9), 6) AS threshold FROM events GROUP BY 1")
def a8(spark, sf):
    return rounded(metrics.quantile_threshold(event_values(spark, sf), "value", 0.9, ["user_id"]), 6, "threshold")


@query(
    "A9_best_by",
    """WITH m AS (SELECT l_returnflag, l_shipmonth, max(l_extendedprice) AS v FROM (SELECT *, month(l_shipdate) AS l_shipmonth FROM lineitem) GROUP BY 1, 2)
       SELECT l_returnflag, arg_max(l_shipmonth, v) AS best, max(v) AS best_value FROM m GROUP BY 1""",
)
def a9(spark, sf):
    by_month = table(spark, sf, "lineitem").groupBy("l_returnflag", F.month("l_shipdate").cast("long").alias("l_shipmonth")).agg(
        F.max("l_extendedprice").alias("v")
    )
    return metrics.best_by(by_month, "l_shipmonth", "v", by=["l_returnflag"])


@query(
    "A10_top_terms",
    r"""WITH w AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM (
               SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), lambda x: length(x) >= 2) AS words FROM documents)),
            c AS (SELECT doc_id, words[i] AS term, count(*) AS tf, CAST(min(i) - 1 AS INT) AS first_at FROM w GROUP BY 1, 2)
       SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tf DESC, first_at) AS rank FROM c) WHERE rank <= 5""",
)
def a10(spark, sf):
    tokens = table(spark, sf, "documents").select("doc_id", tokenize("text").alias("tokens"))
    return metrics.top_terms(tokens, "doc_id", "tokens", 5)


@query(
    "A11_minmax_normalize",
    """SELECT event_id, user_id, round((value - min(value) OVER w) / (max(value) OVER w - min(value) OVER w + 1e-9), 6) AS norm
       FROM events WINDOW w AS (PARTITION BY user_id)""",
)
def a11(spark, sf):
    events = event_values(spark, sf).select("event_id", "user_id", "value")
    return rounded(metrics.minmax_normalize(events, ["user_id"], "value", "norm"), 6, "norm").drop("value")


@query(
    "A12_weighted_mean_score",
    """SELECT l_suppkey, round(sum(l_discount * l_quantity) / sum(l_discount), 6) AS score FROM lineitem
       GROUP BY 1 HAVING sum(l_discount) > 0""",
)
def a12(spark, sf):
    lines = table(spark, sf, "lineitem")
    return rounded(metrics.weighted_mean_score(lines, ["l_suppkey"], "l_discount", "l_quantity"), 6, "score")


@query(
    "A13_mean_efficiency_filter",
    "WITH " + PLAYS + """, e AS (SELECT *, score / CASE WHEN playtime = 0 THEN 1 ELSE playtime END AS efficiency FROM plays)
    SELECT order_id, line_id FROM e WHERE playtime < 15 AND efficiency > (SELECT avg(efficiency) FROM e) AND score > 20000""",
)
def a13(spark, sf):
    rows = plays(spark, sf).withColumn("efficiency", F.col("score") / F.when(F.col("playtime") == 0, 1).otherwise(F.col("playtime")))
    return metrics.mean_efficiency_filter(rows, F.col("playtime") < 15, "efficiency", "score", 20000).select("order_id", "line_id")


@query(
    "A14_fold_average",
    """WITH f AS (SELECT o_orderpriority AS model, o_orderkey % 5 AS fold, avg(o_totalprice) AS rmse FROM orders GROUP BY 1, 2)
       SELECT model, round(avg(rmse), 4) AS rmse_mean, round(stddev_pop(rmse), 4) AS rmse_std FROM f GROUP BY 1""",
)
def a14(spark, sf):
    folds = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("model"), (F.col("o_orderkey") % 5).alias("fold")).agg(
        F.avg("o_totalprice").alias("rmse")
    )
    return rounded(metrics.fold_average(folds, ["model"], ["rmse"]), 4, "rmse_mean", "rmse_std")


@query(
    "S1_top_k",
    """SELECT o_orderkey, o_totalprice - 250000 AS coefficient FROM orders ORDER BY abs(o_totalprice - 250000) DESC, o_orderkey LIMIT 10""",
)
def s1(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") - 250000).alias("coefficient"))
    return sampling.top_k(rows, "coefficient", 10, ["o_orderkey"], absolute=True)


@query(
    "S3_union_labeled",
    """SELECT 'standard' AS dataset, l_returnflag AS model, count(*) AS n, NULL AS best FROM lineitem GROUP BY 2
       UNION ALL SELECT 'sparse', l_linestatus, NULL, max(l_quantity) FROM lineitem WHERE l_orderkey % 100 = 0 GROUP BY 2""",
)
def s3(spark, sf):
    lines = table(spark, sf, "lineitem")
    full = lines.groupBy(F.col("l_returnflag").alias("model")).agg(F.count(F.lit(1)).alias("n"))
    thin = lines.filter("l_orderkey % 100 = 0").groupBy(F.col("l_linestatus").alias("model")).agg(F.max("l_quantity").alias("best"))
    return sampling.union_labeled({"standard": full, "sparse": thin})


@query(
    "S4_intersect_keys",
    """SELECT l_suppkey, l_partkey FROM lineitem WHERE l_returnflag = 'A' INTERSECT SELECT l_suppkey, l_partkey FROM lineitem WHERE l_returnflag = 'R'""",
)
def s4(spark, sf):
    lines = table(spark, sf, "lineitem")
    return sampling.intersect_keys(lines.filter("l_returnflag = 'A'"), lines.filter("l_returnflag = 'R'"), ["l_suppkey", "l_partkey"])


@query(
    "S5_merge_detections",
    "WITH " + PLAYS + """ SELECT order_id, line_id, CASE WHEN score > 95000 OR (playtime < 5 AND score > 9000) THEN 'anomaly' ELSE 'normal' END AS verdict FROM plays""",
)
def s5(spark, sf):
    rows = plays(spark, sf).select(
        "order_id", "line_id", (F.col("score") > 95000).cast("int").alias("by_rule"),
        ((F.col("playtime") < 5) & (F.col("score") > 9000)).cast("int").alias("by_model"),
    )
    return sampling.merge_detections(rows, ["by_rule", "by_model"]).select("order_id", "line_id", "verdict")


@query("S6_distinct_sorted_sources", "SELECT lang, string_agg(source, chr(10) ORDER BY source) AS sources FROM (SELECT DISTINCT lang, source FROM documents) GROUP BY 1")
def s6(spark, sf):
    return sampling.distinct_sorted_sources(table(spark, sf, "documents"), ["lang"], "source")


HASHED = spread_hash_sql("doc_id", 42)


@query(
    "S7_split_random",
    f"""SELECT doc_id, toxic, CASE WHEN i <= floor(n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS part FROM (
         SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY {HASHED}, doc_id) AS i, count(*) OVER (PARTITION BY toxic) AS n FROM labels)""",
)
def s7(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    return sampling.split_random(labels, "doc_id", 0.2, "toxic", order=spread_hash("doc_id", 42))


@query("S8_kfold", f"SELECT doc_id, CAST({HASHED} % 5 AS INT) AS fold FROM documents")
def s8(spark, sf):
    return sampling.kfold(table(spark, sf, "documents").select("doc_id"), "doc_id", 5, order=spread_hash("doc_id", 42))


@query(
    "S9_sample_fraction",
    f"""SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY {spread_hash_sql('o_orderkey', 7)}, o_orderkey) AS i,
        count(*) OVER () AS n FROM orders) WHERE i <= floor(n * CAST(0.01 AS DOUBLE) + 0.5)""",
)
def s9(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    return sampling.sample_fraction(orders, "o_orderkey", 0.01, order=spread_hash("o_orderkey", 7))


@query("S9_shuffle_take", f"SELECT doc_id, lang FROM documents ORDER BY {HASHED}, doc_id LIMIT 100")
def s9_take(spark, sf):
    return sampling.shuffle_take(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 100, order=spread_hash("doc_id", 42))


@query(
    "S10_undersample",
    f"""SELECT doc_id, toxic FROM (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY {HASHED}, doc_id) AS i FROM labels)
        WHERE i <= (SELECT min(n) FROM (SELECT count(*) AS n FROM labels GROUP BY toxic))""",
)
def s10(spark, sf):
    return sampling.undersample(table(spark, sf, "labels").select("doc_id", "toxic"), "toxic", "doc_id", order=spread_hash("doc_id", 42))
