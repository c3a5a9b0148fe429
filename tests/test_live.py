"""Live drift verdicts and gap segments: same rows as the batch forms, restarts, late rows, missing values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mlspark.operators.drift import drift_report
from mlspark.operators.windows import gap_segments
from mlspark.session import scratch_path
from mlspark.streaming import drift, jobs, segments

FEED = "ts timestamp, v double, kind string"
EDGES = {"v": [1.0, 2.0, 3.0]}


def rows_of(spark, day, n, shift, kinds):
    rows = [(f"{day} {i % 20:02d}:{i % 60:02d}:00", ((i * 7) % 40) / 10 + shift, kinds[i % len(kinds)]) for i in range(n)]
    rows += [(f"{day} 01:00:00", None, None), (f"{day} 02:00:00", float("nan"), kinds[0])]
    df = spark.createDataFrame(rows, "t string, v double, kind string")
    return df.select(F.to_timestamp("t").alias("ts"), "v", "kind")


def put(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def test_live_verdicts_equal_the_batch_report(spark):
    path, out, progress = (scratch_path(spark, n) for n in ("in", "out", "progress"))
    base = rows_of(spark, "2024-01-01", 300, 0.0, ["a", "a", "b", "c"])
    days = {
        "2024-01-02": rows_of(spark, "2024-01-02", 200, 0.0, ["a", "a", "b", "c"]),
        "2024-01-03": rows_of(spark, "2024-01-03", 150, 1.5, ["a", "d", "d", "e"]),
        "2024-01-04": rows_of(spark, "2024-01-04", 90, 0.0, ["b"]),
    }
    reference = drift.reference_counts(base, EDGES, ["kind"])

    def run():
        feed = jobs.read_feed(spark, path, FEED)
        drift.stream_verdicts(feed, reference, EDGES, ["kind"], out, progress).awaitTermination()

    for rows in days.values():
        put(rows, path)
        run()
    put(rows_of(spark, "2024-02-01", 1, 0.0, ["a"]), path)
    run()
    put(rows_of(spark, "2024-01-02", 50, 0.0, ["z"]), path)
    run()  # late rows change nothing
    got = {(str(r["start"])[:10], r["column"]): r for r in drift.read_verdicts(spark, out).collect()}
    assert len(got) == drift.read_verdicts(spark, out).count() == 9
    binned = lambda d: d.withColumn("v", F.when(~F.isnan("v"), jobs.bin_of(F.col("v"), EDGES["v"])))
    for day, rows in days.items():
        for want in drift_report(binned(base), binned(rows), ["v"], ["kind"]).collect():
            row = got[day, want["column"]]
            assert row["drifted"] == want["drifted"] and row["statistic"] == pytest.approx(want["statistic"], abs=1e-9)
            if want["p_value"] is not None:
                assert row["p_value"] == pytest.approx(want["p_value"], abs=1e-9)
    assert not got["2024-01-02", "(dataset)"]["drifted"] and got["2024-01-03", "(dataset)"]["drifted"]


def test_a_batch_that_runs_again_replaces_its_rows(spark):
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    base = rows_of(spark, "2024-01-01", 60, 0.0, ["a", "b"])
    reference = drift.reference_counts(base, EDGES, ["kind"])
    put(rows_of(spark, "2024-01-02", 60, 0.0, ["a", "b"]), path)
    put(rows_of(spark, "2024-02-01", 1, 0.0, ["a"]), path)
    for _ in range(2):  # progress is lost, rows are not: the same batch number writes the same folder
        feed = jobs.read_feed(spark, path, FEED)
        drift.stream_verdicts(feed, reference, EDGES, ["kind"], out, scratch_path(spark, "progress")).awaitTermination()
    got = drift.read_verdicts(spark, out).groupBy("start", "column").count().collect()
    assert len(got) == 3 and all(r["count"] == 1 for r in got)


def test_empty_window_tables_give_no_verdict(spark):
    base = rows_of(spark, "2024-01-01", 60, 0.0, ["a", "b"])
    reference = drift.reference_counts(base, EDGES, ["kind"])
    counts = drift.window_counts(base.filter("1 = 0"), EDGES, ["kind"], "1 day")
    assert drift.drift_verdicts(counts, reference).count() == 0
    unknown = drift.window_counts(base, EDGES, ["kind"], "1 day")
    assert drift.drift_verdicts(unknown, reference.filter("1 = 0")).count() == 0


def test_live_segments_equal_the_batch_segments(spark):
    path, out, progress = (scratch_path(spark, n) for n in ("in", "out", "progress"))
    schema = "k string, id long, ts timestamp"
    parts = [
        [("a", 1, 0), ("a", 2, 30), ("a", 3, 100), ("b", 4, 10), (None, 5, 20)],
        [("a", 6, 129), ("a", 7, 4000), ("b", 8, 4001), ("b", 9, 4061), ("b", 10, 4100), (None, 11, 4020)],
        [("a", 12, 90000), ("b", 13, 90000), (None, 14, 90000)],
    ]

    def frame(rows):
        return spark.createDataFrame(rows, "k string, id long, s long").select("k", "id", F.timestamp_seconds(F.col("s") + 1704067200).alias("ts"))

    def run():
        feed = jobs.read_feed(spark, path, schema)
        segments.stream_segments(feed, "k", out, progress, 60_000, 5_000, "10 seconds").awaitTermination()

    for rows in parts:
        put(frame(rows), path)
        run()
    put(frame([("a", 15, 50)]), path)
    run()  # a late row changes nothing
    columns = ["k", "segment", "start_ms", "end_ms", "n_events"]
    got = {tuple(r) for r in spark.read.parquet(out).select(columns).collect()}
    # the last event of each key only ends what came before it
    whole = gap_segments(frame([r for rows in parts for r in rows]), ["k"], "ts", 60_000, 5_000, ["id"])
    want = {tuple(r) for r in whole.filter(F.col("start_ms") < (1704067200 + 80000) * 1000).select(columns).collect()}
    assert got == want and len(got) == spark.read.parquet(out).count() == 8


def test_stretches_merge_in_any_order():
    rng = np.random.default_rng(4)
    for _ in range(200):
        ms = rng.integers(0, 400, rng.integers(0, 30)).astype(np.int64)
        want = []
        for t in np.sort(ms).tolist():
            if want and t - want[-1][1] < 10:
                want[-1] = [want[-1][0], t, want[-1][2] + 1]
            else:
                want.append([t, t, 1])
        state = tuple(np.array([], dtype=np.int64) for _ in range(3))
        for part in np.array_split(ms, 3):
            fresh = segments.merge(part, part, np.ones(len(part), dtype=np.int64), 10)
            state = segments.merge(*(np.concatenate(p) for p in zip(state, fresh)), 10)
        assert [list(r) for r in zip(*(s.tolist() for s in state))] == want
