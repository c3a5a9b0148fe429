"""Streaming jobs fed with the events table, split into files, and run until the input is used up."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from mlspark.catalog import query
from mlspark.operators.models import ColumnPipeline
from mlspark.plans.views import table
from mlspark.session import scratch_path, written
from mlspark.streaming import drift, jobs, segments


def feed_folder(spark, sf, files=4):
    """Events as files in time order, then one event far in the future that closes the last windows."""
    path = scratch_path(spark, "feed")
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    events.repartitionByRange(files, "ts").write.parquet(path)
    return path, events.schema


def closing_event(spark, path, schema):
    late = spark.range(1).select(
        F.lit(-1).cast("long").alias("event_id"), F.lit("2030-01-01").cast("timestamp_ntz").alias("ts"), F.lit(-1).cast("long").alias("user_id"),
        F.lit("close").alias("event_type"), F.lit(0.0).alias("value"), F.lit("{}").alias("props"),
    )
    late.select(*[F.col(f.name).cast(f.dataType) for f in schema]).write.mode("append").parquet(path)


def finish(stream):
    stream.awaitTermination()
    return stream


def run_to_end(spark, path, schema, start):
    """Two runs over the same checkpoint: the events, then the closing event that lets windows end."""
    finish(start(jobs.read_feed(spark, path, schema)))
    closing_event(spark, path, schema)
    finish(start(jobs.read_feed(spark, path, schema)))


@query(
    "T1_stream_score_log",
    """WITH s AS (SELECT avg(value) AS m, stddev_pop(value) AS d FROM events)
       SELECT event_id, user_id, round((value - m) / d, 6) AS score, CAST((value - m) / d > 1 AS INT) AS prediction FROM events, s""",
)
def t1(spark, sf):
    path, schema = feed_folder(spark, sf)
    model = ColumnPipeline(numeric=["value"]).fit(table(spark, sf, "events"))
    log = scratch_path(spark, "score-log")

    def score(feed):
        rows = model.transform(feed).withColumnRenamed("num_value", "score")
        return rows.select("event_id", "user_id", "score", (F.col("score") > 1).cast("int").alias("prediction"))

    finish(jobs.stream_score_log(jobs.read_feed(spark, path, schema, 1), score, log, scratch_path(spark, "progress")))
    out = spark.read.schema("event_id long, user_id long, score double, prediction int").parquet(log)
    return out.withColumn("score", F.round("score", 6))


EDGES = [2.0, 5.0, 10.0, 20.0, 40.0]

BINNED = """b AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS start, CAST(value >= 2 AS INT) + CAST(value >= 5 AS INT) + CAST(value >= 10 AS INT)
    + CAST(value >= 20 AS INT) + CAST(value >= 40 AS INT) AS bin FROM events)"""


@query("T2_stream_drift", "WITH " + BINNED + " SELECT start, bin, count(*) AS n FROM b GROUP BY 1, 2")
def t2(spark, sf):
    path, schema = feed_folder(spark, sf)
    out, progress = scratch_path(spark, "bins"), scratch_path(spark, "progress")
    run_to_end(spark, path, schema, lambda feed: jobs.stream_drift(feed, "value", EDGES, out, progress, "1 day", "1 hour"))
    bins = spark.read.schema("start timestamp, bin int, n long").parquet(out)
    return bins.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("T2_score_windows")
def t2_scores(spark, sf):
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    edges, shares = jobs.reference_profile(events.filter(F.col("ts") < "2024-01-08"), "value", 10)
    return jobs.score_windows(jobs.window_bins(events.filter(F.col("ts") >= "2024-01-08"), "value", edges, "1 day"), shares)


WEEK = "2024-01-08"


def drift_inputs(spark, sf):
    """Reference counts of the first week, and the later events as files."""
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    reference = written(drift.reference_counts(events.filter(F.col("ts") < WEEK), {"value": EDGES}, ["event_type"]), "drift-reference")
    path, schema = feed_folder(spark, sf)
    return reference, path, schema


@query(
    "T2_drift_verdicts",
    "WITH " + BINNED + """,
    v AS (SELECT start, 'value' AS col, CAST(bin AS VARCHAR) AS val FROM b UNION ALL
          SELECT CAST(date_trunc('day', ts) AS TIMESTAMP), 'event_type', event_type FROM events),
    r AS (SELECT col, val, count(*) AS ref FROM v WHERE start < TIMESTAMP '2024-01-08' GROUP BY 1, 2),
    w AS (SELECT start, col, val, count(*) AS cur FROM v WHERE start >= TIMESTAMP '2024-01-08' GROUP BY 1, 2, 3),
    vals AS (SELECT DISTINCT col, val FROM v),
    d AS (SELECT DISTINCT start, col FROM w),
    g AS (SELECT d.start, d.col, vals.val, coalesce(ref, 0) AS ref, coalesce(cur, 0) AS cur FROM d JOIN vals ON vals.col = d.col
          LEFT JOIN r ON r.col = d.col AND r.val = vals.val LEFT JOIN w ON w.start = d.start AND w.col = d.col AND w.val = vals.val),
    t AS (SELECT *, CAST(sum(ref) OVER (PARTITION BY start, col) AS DOUBLE) AS nr, CAST(sum(cur) OVER (PARTITION BY start, col) AS DOUBLE) AS nc,
            sum(ref) OVER (PARTITION BY start, col ORDER BY val) AS ur, sum(cur) OVER (PARTITION BY start, col ORDER BY val) AS uc FROM g)
    SELECT start, col AS "column", CASE WHEN col = 'value' THEN 'ks' ELSE 'chi2' END AS test, CAST(max(nc) AS BIGINT) AS n_cur,
      round(CASE WHEN col = 'value' THEN max(abs(ur / nr - uc / nc))
        ELSE sum(CASE WHEN ref + cur > 0 THEN pow(ref - (ref + cur) / (nr + nc) * nr, 2) / ((ref + cur) / (nr + nc) * nr)
                      + pow(cur - (ref + cur) / (nr + nc) * nc, 2) / ((ref + cur) / (nr + nc) * nc) ELSE 0 END) END, 6) AS statistic
    FROM t GROUP BY start, col""",
)
def t2_verdicts(spark, sf):
    """Figures per day and column; verdicts and the share row are held against the batch report in the tests."""
    rows = live_verdicts(spark, sf)
    figures = rows.filter(F.col("test") != "share").select("start", "column", "test", "n_cur", F.round("statistic", 6).alias("statistic"))
    return figures.withColumn("start", F.col("start").cast("timestamp_ntz"))


def live_verdicts(spark, sf):
    reference, path, schema = drift_inputs(spark, sf)
    out, progress = scratch_path(spark, "verdicts"), scratch_path(spark, "progress")

    def start(feed):
        return drift.stream_verdicts(feed.filter(F.col("ts") >= WEEK), reference, {"value": EDGES}, ["event_type"], out, progress)

    run_to_end(spark, path, schema, start)
    return drift.read_verdicts(spark, out)


@query("T2_drifted_windows")
def t2_drifted(spark, sf):
    """Verdicts with their p-values, the share of drifted columns per day included."""
    return live_verdicts(spark, sf).withColumns({c: F.round(c, 6) for c in ("statistic", "p_value")})


@query(
    "T3_stream_sessions",
    """WITH e AS (SELECT user_id, event_id, ts, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) >= INTERVAL 2 HOUR, true) AS b FROM events),
       s AS (SELECT *, sum(CAST(b AS INT)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM e)
       SELECT user_id, min(ts) AS start, max(ts) AS last_ts, count(*) AS n FROM s GROUP BY user_id, g""",
)
def t3(spark, sf):
    path, schema = feed_folder(spark, sf)
    out, progress = scratch_path(spark, "sessions"), scratch_path(spark, "progress")
    run_to_end(spark, path, schema, lambda feed: jobs.stream_sessions(feed, "user_id", "2 hours", out, progress, "3 hours"))
    rows = spark.read.schema("user_id long, start timestamp, last_ts timestamp, n long").parquet(out)
    return rows.withColumns({c: F.col(c).cast(T.TimestampNTZType()) for c in ("start", "last_ts")})


@query(
    "T3_stream_segments",
    """WITH e AS (SELECT user_id, event_id, epoch_us(ts) // 1000 AS ms, ts FROM events WHERE ts IS NOT NULL),
       f AS (SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) >= INTERVAL 6 HOUR, true) AS b FROM e),
       g AS (SELECT *, CAST(sum(CAST(b AS INT)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS segment FROM f)
       SELECT user_id, segment, min(ms) - CASE WHEN segment > 1 THEN 600000 ELSE 0 END AS start_ms, max(ms) + 600000 AS end_ms, count(*) AS n_events
       FROM g GROUP BY user_id, segment""",
)
def t3_segments(spark, sf):
    path, schema = feed_folder(spark, sf)
    out, progress = scratch_path(spark, "segments"), scratch_path(spark, "progress")
    run_to_end(spark, path, schema, lambda feed: segments.stream_segments(feed, "user_id", out, progress, 21_600_000, 600_000, "3 hours"))
    return spark.read.schema("user_id long, segment long, start_ms long, end_ms long, n_events long").parquet(out)


@query(
    "T4_stream_rules",
    """SELECT event_id, concat_ws(',', CASE WHEN value > 40 THEN 'large' END, CASE WHEN event_type = 'error' AND value > 10 THEN 'costly_error' END,
              CASE WHEN contains(props, '7') THEN 'labelled' END) AS fired FROM events WHERE value > 40 OR (event_type = 'error' AND value > 10) OR contains(props, '7')""",
)
def t4(spark, sf):
    path, schema = feed_folder(spark, sf)
    out = scratch_path(spark, "hits")
    rules = {
        "large": F.col("value") > 40,
        "costly_error": (F.col("event_type") == "error") & (F.col("value") > 10),
        "labelled": F.contains(F.col("props"), F.lit("7")),
    }
    finish(jobs.stream_rules(jobs.read_feed(spark, path, schema, 2), rules, out, scratch_path(spark, "progress")))
    hits = spark.read.schema("event_id long, fired_rules array<string>").parquet(out)
    return hits.select("event_id", F.array_join("fired_rules", ",").alias("fired"))
