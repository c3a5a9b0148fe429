"""Ranking, set operations and repeatable sampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mlspark.plans.neighbours import vector_topk
from mlspark.plans.ordered import null_safe_join, row_index
from mlspark.session import written


def row_hash(keys: Sequence[str], seed: int = 0) -> Column:
    return F.xxhash64(*keys, F.lit(seed))


def top_k(df: DataFrame, col: str, k: int, tie: Sequence[str], absolute: bool = False) -> DataFrame:
    """Largest k rows of the table; every partition keeps k rows, the driver side merges them."""
    by = F.abs(col) if absolute else F.col(col)
    return df.orderBy(by.desc(), *tie).limit(k)


def skip_first_topk(df: DataFrame, keys: Sequence[str], distance: str, k: int, tie: Sequence[str]) -> DataFrame:
    """Ranks 2 .. k+1 per group: the nearest row is dropped by its place, whoever it is."""
    w = W.partitionBy(*keys).orderBy(distance, *tie)
    ranked = df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k + 1)
    return ranked.filter(F.col("rank") > 1).withColumn("rank", (F.col("rank") - 1).cast("long"))


def union_labeled(tables: Mapping[str, DataFrame], label: str = "dataset") -> DataFrame:
    """Stack tables with their name; columns a table lacks become NULL."""
    named = [df.withColumn(label, F.lit(name)) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def intersect_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.select(*keys).intersect(right.select(*keys))


def merge_detections(df: DataFrame, detectors: Sequence[str]) -> DataFrame:
    """``anomaly`` when any detector flags the row; the rest is normal."""
    hit = reduce(lambda a, b: a | b, [F.coalesce(F.col(d) == 1, F.lit(False)) for d in detectors])
    return df.withColumn("verdict", F.when(hit, "anomaly").otherwise("normal"))


def distinct_sorted_sources(df: DataFrame, keys: Sequence[str], source: str, sep: str = "\n") -> DataFrame:
    """Distinct citations per group, sorted and joined; duplicates go before the list is built."""
    unique = df.select(*keys, source).distinct()
    return unique.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(source)), sep).alias("sources"))


def ranked_in_class(df: DataFrame, strata: Sequence[str], order: Column, key: str) -> DataFrame:
    """Position of each row in its class in hash order, and the class size."""
    indexed = row_index(df.withColumn("_h", order), strata, "_h", [key], out="_idx").drop("_h")
    sizes = df.groupBy(*strata).agg(F.count(F.lit(1)).alias("_n"))
    if not strata:
        return indexed.withColumn("_n", sizes.scalar())
    return null_safe_join(indexed, sizes, strata)


def split_random(
    df: DataFrame, key: str, ratio: float = 0.2, stratify: str | None = None, seed: int = 42, order: Column | None = None
) -> DataFrame:
    """Exact and repeatable train/test split, class by class when ``stratify`` is given; adds ``part``."""
    by = order if order is not None else row_hash([key], seed)
    ranked = ranked_in_class(df, [stratify] if stratify else [], by, key)
    train = F.floor(F.col("_n") * F.lit(1 - ratio))
    return ranked.withColumn("part", F.when(F.col("_idx") <= train, "train").otherwise("test")).drop("_idx", "_n")


def kfold(df: DataFrame, key: str, n: int = 5, seed: int = 42, order: Column | None = None) -> DataFrame:
    """Fold number per row from a hash of the key; all folds live in one table."""
    by = order if order is not None else row_hash([key], seed)
    return df.withColumn("fold", F.pmod(by, F.lit(n)).cast("int"))


def sample_fraction(df: DataFrame, key: str, fraction: float, seed: int = 42, order: Column | None = None) -> DataFrame:
    """Exactly round-half-up(n * fraction) rows, the ones with the smallest hashes."""
    by = order if order is not None else row_hash([key], seed)
    ranked = ranked_in_class(df, [], by, key)
    return ranked.filter(F.col("_idx") <= F.floor(F.col("_n") * F.lit(fraction) + 0.5)).drop("_idx", "_n")


def shuffle_take(df: DataFrame, key: str, n: int, seed: int = 42, order: Column | None = None) -> DataFrame:
    """The first n rows of a repeatable shuffle."""
    by = order if order is not None else row_hash([key], seed)
    return df.orderBy(by, key).limit(n)


def undersample(df: DataFrame, label: str, key: str, seed: int = 42, order: Column | None = None) -> DataFrame:
    """Every class cut to the size of the smallest one."""
    by = order if order is not None else row_hash([key], seed)
    smallest = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).select(F.min("n")).scalar()
    return ranked_in_class(df, [label], by, key).filter(F.col("_idx") <= smallest).drop("_idx", "_n")


def smote(
    df: DataFrame, label: str, minority, key: str, vector: str, k: int = 5, seed: int = 42, draw=None, pivots: int | None = None
) -> DataFrame:
    """Synthetic minority rows until both sides are equal: (key, copy, neighbour, vector).

    Every minority row gets the same number of copies (the first ones one more); a copy lies between the
    row and one of its k nearest minority rows.  ``draw(key, copy, salt)`` gives a repeatable BIGINT.
    """
    pick = draw or (lambda i, c, salt: F.xxhash64(i, c, F.lit(seed + salt)))
    small = written(df.filter(F.col(label) == minority).select(key, F.col(vector).cast("array<double>").alias(vector)), "minority")
    near = vector_topk(small, small, k, key, key, vector, exclude_self=True, pivots=pivots)
    sizes = df.agg(
        F.count(F.when(F.col(label) == minority, 1)).alias("few"), F.count(F.when(F.col(label) != minority, 1)).alias("many")
    ).first()
    few, wanted = sizes["few"], max(0, sizes["many"] - sizes["few"])
    if few < 2 or wanted == 0:
        return small.select(key, F.lit(0).cast("long").alias("copy"), F.col(key).alias("neighbour"), vector).limit(0)
    copies = F.lit(wanted // few) + F.when(F.col("_at") <= wanted % few, 1).otherwise(0)
    planned = (
        row_index(small, [], key, out="_at")
        .withColumn("_copies", copies.cast("long"))
        .filter("_copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
        .withColumn("rank", F.pmod(pick(F.col(key), F.col("copy"), 1), F.lit(min(k, few - 1))).cast("long") + 1)
        .withColumn("_gap", F.pmod(pick(F.col(key), F.col("copy"), 2), F.lit(1000)) / F.lit(1000.0))
    )
    chosen = planned.join(near.select(F.col("query_id").alias(key), "rank", F.col("base_id").alias("neighbour")), [key, "rank"])
    both = chosen.join(small.select(F.col(key).alias("neighbour"), F.col(vector).alias("_other")), "neighbour")
    return both.select(key, "copy", "neighbour", F.zip_with(vector, "_other", lambda a, b: a + (b - a) * F.col("_gap")).alias(vector))
