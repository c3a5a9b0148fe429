"""Streaming jobs: same rows as the batch form; a late row is dropped after the watermark."""

import pytest
from pyspark.sql import functions as F

from mlspark.session import scratch_path
from mlspark.streaming import jobs

SCHEMA = "id long, ts timestamp, value double"


def put(spark, path, rows):
    df = spark.createDataFrame([(i, t, v) for i, t, v in rows], "id long, t string, value double")
    df.select("id", F.to_timestamp("t").alias("ts"), "value").coalesce(1).write.mode("append").parquet(path)


def test_late_row_is_dropped(spark):
    path, out, progress = (scratch_path(spark, n) for n in ("in", "out", "progress"))

    def run():
        jobs.stream_drift(jobs.read_feed(spark, path, SCHEMA), "value", [1.0], out, progress, "1 day", "1 hour").awaitTermination()

    put(spark, path, [(1, "2024-01-01 05:00:00", 0.5), (2, "2024-01-01 23:00:00", 2.0)])
    run()
    put(spark, path, [(3, "2024-01-03 00:00:00", 0.1)])
    run()
    put(spark, path, [(4, "2024-01-01 06:00:00", 9.0), (5, "2024-01-09 00:00:00", 0.0)])
    run()
    got = {(str(r["start"])[:10], r["bin"]): r["n"] for r in spark.read.parquet(out).collect()}
    assert got == {("2024-01-01", 0): 1, ("2024-01-01", 1): 1, ("2024-01-03", 0): 1}


def test_profile_of_same_data_shows_no_drift(spark):
    df = spark.range(2000).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60).alias("ts"), F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double").alias("value")
    )
    edges, shares = jobs.reference_profile(df, "value", 5)
    assert sum(shares) == pytest.approx(1)
    scores = jobs.score_windows(jobs.window_bins(df, "value", edges, "1 day"), shares).collect()
    assert all(r["ks_binned"] < 0.1 and r["p_value"] > 0.01 for r in scores)


def test_score_log_is_not_repeated_after_restart(spark):
    path, log, progress = (scratch_path(spark, n) for n in ("in", "log", "progress"))
    put(spark, path, [(1, "2024-01-01 00:00:00", 1.0), (2, "2024-01-01 00:00:01", 2.0)])
    for _ in range(2):
        feed = jobs.read_feed(spark, path, SCHEMA)
        jobs.stream_score_log(feed, lambda d: d.withColumn("p", F.col("value") * 2), log, progress).awaitTermination()
    assert sorted(r["p"] for r in spark.read.parquet(log).collect()) == [2.0, 4.0]
