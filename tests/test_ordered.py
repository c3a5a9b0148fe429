"""Bucketed order operators against plain pandas, with one hot key and different bucket counts."""

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from mlspark.operators import joins, metrics, sampling, windows
from mlspark.plans import ordered


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(7)
    key = np.where(rng.random(900) < 0.5, 0, rng.integers(1, 6, 900))
    return pd.DataFrame({"k": key, "id": np.arange(900), "v": np.round(rng.normal(0, 3, 900), 1)})


@pytest.mark.parametrize("buckets", [1, 4, 16])
def test_row_index(spark, rows, buckets):
    got = ordered.row_index(spark.createDataFrame(rows), ["k"], "v", ["id"], buckets=buckets).toPandas()
    want = rows.sort_values(["v", "id"]).assign(idx=lambda d: d.groupby("k").cumcount() + 1)
    assert dict(zip(got.id, got.idx)) == dict(zip(want.id, want.idx))


@pytest.mark.parametrize("buckets", [1, 4, 16])
def test_running_sums_descending_with_missing_order(spark, rows, buckets):
    data = rows.assign(v=rows.v.where(rows.id % 50 != 0, None))
    df = spark.createDataFrame(data).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    got = ordered.running_sums(df, ["k"], "v", {"s": F.col("id")}, ["id"], descending=True, buckets=buckets).toPandas()
    want = data.sort_values(["v", "id"], ascending=[False, True], na_position="last").assign(s=lambda d: d.groupby("k").id.cumsum())
    assert dict(zip(got.id, got.s)) == dict(zip(want.id, want.s))


def test_hot_order_value_is_split_by_its_ties(spark):
    rng = np.random.default_rng(3)
    data = pd.DataFrame({"k": 0, "id": rng.permutation(2000), "v": np.where(rng.random(2000) < 0.6, 5.0, rng.normal(5, 3, 2000))})
    df = spark.createDataFrame(data).withColumn("_by", F.col("v"))
    cuts = ordered.quantile_cuts(df, "_by", 16)
    split = ordered.split_hot_values(ordered.assign_buckets(df, "_by", sorted(set(cuts))), cuts, "id", 16)
    assert split.groupBy("_bucket").count().agg(F.max("count")).first()[0] < 400
    got = ordered.row_index(df.drop("_by"), ["k"], "v", ["id"], buckets=16).toPandas()
    want = data.sort_values(["v", "id"]).assign(idx=range(1, 2001))
    assert dict(zip(got.id, got.idx)) == dict(zip(want.id, want.idx))


@pytest.mark.parametrize("size", [3, 7, 1000])
def test_halo_blocks_give_whole_windows(spark, rows, size):
    from pyspark.sql import Window as W

    indexed = ordered.row_index(spark.createDataFrame(rows), ["k"], "id")
    blocks = ordered.halo_blocks(indexed, ["k"], "idx", before=2, after=2, size=size)
    w = ordered.block_window(["k"], "idx").rowsBetween(-2, 2)
    got = ordered.owned(blocks.withColumn("l", F.collect_list("v").over(w))).toPandas()
    want = indexed.withColumn("l", F.collect_list("v").over(W.partitionBy("k").orderBy("idx").rowsBetween(-2, 2))).toPandas()
    assert len(got) == len(rows)
    assert {r.id: list(r.l) for r in got.itertuples()} == {r.id: list(r.l) for r in want.itertuples()}


def test_position_sums_in_small_blocks(spark, rows):
    indexed = ordered.row_index(spark.createDataFrame(rows), ["k"], "id")
    got = ordered.position_sums(indexed, ["k"], "idx", {"s": F.col("v")}, size=5).toPandas()
    want = rows.assign(s=rows.groupby("k").v.cumsum())
    merged = got.merge(want, on="id")
    assert np.allclose(merged.s_x, merged.s_y)


def test_quantile_threshold_is_numpy_percentile(spark, rows):
    df = spark.createDataFrame(rows)
    for p in (0.0, 0.37, 0.9, 1.0):
        got = metrics.quantile_threshold(df, "v", p).first()[0]
        assert got == pytest.approx(np.percentile(rows.v, p * 100))
    by_key = {r["k"]: r["threshold"] for r in metrics.quantile_threshold(df, "v", 0.9, ["k"]).collect()}
    for k, part in rows.groupby("k"):
        assert by_key[k] == pytest.approx(np.percentile(part.v, 90))


def test_collapse_adjacent_keeps_middle(spark):
    df = spark.createDataFrame([(1, i) for i in (3, 4, 6, 10, 13, 14, 15, 16)], "k int, idx long")
    got = {(r["idx"], r["run_size"]) for r in windows.collapse_adjacent(df, ["k"], "idx", 2).collect()}
    assert got == {(4, 3), (10, 1), (15, 4)}


@pytest.mark.parametrize("buckets", [1, 4, 16])
def test_nearest_join_with_ties(spark, buckets):
    rng = np.random.default_rng(3)
    left = pd.DataFrame({"a": np.arange(200), "x": np.round(rng.random(200), 2)})
    right = pd.DataFrame({"b": np.arange(80), "x": np.round(rng.random(80) ** 2, 2)})
    got = joins.nearest_join(spark.createDataFrame(left), spark.createDataFrame(right), "x", "a", "b", buckets).toPandas()
    assert len(got) == 200
    for row in got.itertuples():
        d = (right.x - left.x[row.a]).abs().round(9)
        assert d[row.matched_b] == pytest.approx(d.min(), abs=1e-9)
        exact = (right.x - left.x[row.a]).abs()
        assert row.matched_b == right.b[exact == exact.min()].min()


def test_split_ratio_and_undersample(spark):
    df = spark.range(1000).withColumn("c", (F.col("id") % 20 == 0).cast("int"))
    parts = sampling.split_random(df, "id", 0.2, "c").groupBy("c", "part").count().toPandas()
    assert {(r.c, r.part): r["count"] for _, r in parts.iterrows()} == {(0, "train"): 760, (0, "test"): 190, (1, "train"): 40, (1, "test"): 10}
    even = sampling.undersample(df, "c", "id").groupBy("c").count().toPandas()
    assert set(even["count"]) == {50}
    assert sampling.sample_fraction(df, "id", 0.013).count() == 13


def test_financial_metrics_same_with_blocks_and_plain(spark):
    rng = np.random.default_rng(1)
    data = pd.DataFrame({"s": "a", "t": np.arange(300), "v": 100 + rng.normal(0, 1, 300).cumsum()})
    df = spark.createDataFrame(data)
    plain = windows.financial_metrics(df, ["s"], "t", "v", calendar=True).orderBy("t").toPandas()
    blocks = windows.financial_metrics(df, ["s"], "t", "v").orderBy("t").toPandas()
    assert plain.volatility.isna().sum() == 30 and plain.ma_25.isna().sum() == 24
    for c in ("ma_25", "ma_75", "daily_return", "volatility"):
        assert np.allclose(plain[c], blocks[c], equal_nan=True)


@pytest.mark.parametrize("name", ["N7_detect_from_errors", "W9_collapse_adjacent", "W12_gap_segments"])
def test_positions_are_not_found_anew(spark, sf, name):
    import __spark_entry__ as entry

    plan = entry.queries()[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 3, plan
