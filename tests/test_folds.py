"""Cross-validation of recommenders: folds at once, sums per key."""

import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from mlspark.operators import joint_factors as J
from mlspark.operators import recommend as P

RATED = [(u, i, 1 + (u * i) % 5) for u in range(20) for i in range(15) if (u + i) % 3]


def frame(spark):
    return spark.createDataFrame(RATED, "user_id long, item_id long, rating int")


def test_folds_run_at_once_with_the_same_figures(spark):
    meet = threading.Barrier(3, timeout=60)

    def predict(train, test):
        return test.withColumn("prediction", train.select(F.avg("rating")).scalar())

    def waiting(train, test):
        meet.wait()  # raises unless three folds are under way
        return predict(train, test)

    key = F.col("user_id") * 1000 + F.col("item_id")
    alone = P.cross_validate_mf(frame(spark), predict, key, 3).first()
    together = P.cross_validate_mf(frame(spark), waiting, key, 3, parallelism=3).first()
    assert together.asDict() == pytest.approx(alone.asDict())
    assert together["n"] == len(RATED)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_sums_per_key_over_batches_and_buckets(spark, kind):
    rows = spark.range(25_000).select(
        (F.col("id") % 7).cast(kind).alias("k"), (F.col("id") % 3).alias("b"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v")
    )
    found = {r["k"]: r["v"] for r in J.key_sums(rows, "k", "b", "v").collect()}
    ids = np.arange(25_000)
    to = int if kind == "long" else str
    assert found == {to(k): [float(ids[ids % 7 == k].sum()), float((ids % 7 == k).sum())] for k in range(7)}
    assert J.key_sums(rows.filter("k > 90"), "k", "b", "v").count() == 0


def test_blend_cuts_the_lineage_of_both_fits_every_few_rounds(spark, monkeypatch):
    fits, fit = [], P._als

    def noted(*args, **kw):
        fits.append(kw.get("checkpointInterval", 10))
        return fit(*args, **kw)

    monkeypatch.setattr(P, "_als", noted)
    key = F.col("user_id") * 1000 + F.col("item_id")
    train, test = frame(spark).filter(key % 5 != 0), frame(spark).filter(key % 5 == 0)
    assert P.mf_implicit_blend(train, test, 2, 3).count() == test.count()
    # factors shipped in the rounds since the last checkpoint stay on disk, ten rounds of them unless told otherwise
    assert fits == [P.ROUNDS_KEPT] * 2 and P.ROUNDS_KEPT <= 2


def test_large_fits_keep_one_round_in_bounded_blocks_and_run_alone(spark, monkeypatch):
    made, busy, most = [], [], []
    fit = P.ALS

    def noted(**kw):
        made.append(kw)
        return fit(**kw)

    monkeypatch.setattr(P, "ALS", noted)
    key = F.col("user_id") * 1000 + F.col("item_id")
    rows = frame(spark)
    n = rows.count()

    def predict(train, test):
        busy.append(1)
        most.append(len(busy))
        found = P.mf_explicit(train, test, 2, 3)
        found.count()
        busy.pop()
        return found

    small = P.cross_validate_mf(rows, predict, key, 3, parallelism=3).first()
    assert {(m["numUserBlocks"], m["numItemBlocks"], m["checkpointInterval"]) for m in made} == {(10, 10, P.ROUNDS_KEPT)}
    assert P.mf_nonnegative(rows, 2, 3).rank == 2 and made[-1]["checkpointInterval"] == P.ROUNDS_KEPT
    made.clear(), most.clear()
    monkeypatch.setattr(P, "MANY", n // 2)
    large = P.cross_validate_mf(rows, predict, key, 3, parallelism=3).first()
    assert most == [1, 1, 1] and {m["checkpointInterval"] for m in made} == {1}
    assert large.asDict() == pytest.approx(small.asDict())
    monkeypatch.setattr(P, "BLOCK_RATINGS", n // 15)
    P.mf_nonnegative(rows, 2, 2)
    assert made[-1]["numUserBlocks"] == made[-1]["numItemBlocks"] >= 15
