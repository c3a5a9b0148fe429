"""Ordered computations that never put a whole table, or one hot key, into a single task.

A plain ``Window.partitionBy(key).orderBy(x)`` sorts a key inside one task.  When one key may hold a
third of all rows, that task becomes the job.  The helpers here cut the *order value* into quantile
buckets over the whole table, so a (key, bucket) group holds at most about 1/buckets of all rows
whatever the key distribution is, and stitch the buckets together with a table of bucket totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mlspark.session import partitions

ORDERED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def as_number(df: DataFrame, col: str) -> Column:
    """A double that orders like the column (numbers, dates, timestamps)."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(col).cast("timestamp")).cast("double")
    return F.col(col).cast("double")


def quantile_cuts(df: DataFrame, col: str, buckets: int | None = None) -> list[float]:
    """Quantiles at equal steps: a sketch per partition merged by a tree.  There is one bucket per shuffle
    partition, so a session sized for its data has buckets sized for its tasks."""
    n = buckets or partitions(df.sparkSession)
    return sorted(df.approxQuantile(col, [i / n for i in range(1, n)], 0.25 / n)) if n > 1 else []


def quantile_edges(df: DataFrame, col: str, buckets: int | None = None) -> list[float]:
    """Distinct inner bucket edges."""
    return sorted(set(quantile_cuts(df, col, buckets)))


def assign_buckets(df: DataFrame, col: str, edges: Sequence[float], out: str = "_bucket") -> DataFrame:
    """Binary search of ``col`` in the edges; equal values share a bucket, missing ones take the last."""
    if not edges:
        return df.withColumn(out, F.lit(0))
    splits = [float("-inf"), *edges, float("inf")]
    found = Bucketizer(splits=splits, inputCol=col, outputCol=out, handleInvalid="keep").transform(df)
    return found.withColumn(out, F.coalesce(F.col(out).cast("int"), F.lit(len(edges) + 1)))


def split_hot_values(df: DataFrame, cuts: Sequence[float], tie: str, buckets: int | None) -> DataFrame:
    """Cut buckets that begin with a very frequent order value by the first tie column.

    A value that fills more than one quantile step shows up twice among the cuts and is the lower edge
    of its bucket, so its rows come first there: they are spread by the tie column's own quantiles, and
    the bucket's other rows follow.
    """
    hot = sorted({a for a, b in zip(cuts, cuts[1:]) if a == b})
    if not hot:
        return df
    staged = df.withColumn("_tie", as_number(df, tie))
    edges = quantile_edges(staged, "_tie", buckets)
    staged = assign_buckets(staged, "_tie", edges, "_sub")
    place = F.when(F.col("_by").isin(hot), F.col("_sub")).otherwise(F.lit(len(edges) + 2))
    return staged.withColumn("_bucket", F.col("_bucket") * (len(edges) + 3) + place).drop("_tie", "_sub")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that also matches NULL keys, keeping the left key columns."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[F.col(c) for c in right.columns if c not in keys],
    )
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    sums: dict[str, Column],
    ties: Sequence[str] = (),
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Cumulative sums in the order of ``by`` (then ``ties``) inside each key.

    Two levels: a window inside (key, bucket), plus the totals of earlier buckets, whose table has at
    most ``buckets`` rows per key.
    """
    number = as_number(df, by)
    staged = df.withColumn("_by", -number if descending else number)
    for name, value in sums.items():
        staged = staged.withColumn(f"_v_{name}", value)
    cuts = quantile_cuts(staged, "_by", buckets)
    bucketed = assign_buckets(staged, "_by", sorted(set(cuts)))
    if ties and isinstance(df.schema[ties[0]].dataType, ORDERED):
        bucketed = split_hot_values(bucketed, cuts, ties[0], buckets)

    # a missing order value sorts last, after every bucket
    order = [F.col("_by").asc_nulls_last(), *ties]
    return bucketed_sums(bucketed, keys, "_bucket", order, list(sums), df.columns)


def bucketed_sums(
    df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[Column | str], names: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """Running totals of the ``_v_<name>`` columns inside (key, bucket), plus the totals of earlier buckets."""
    inside = W.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    local = df.select("*", *[F.sum(f"_v_{n}").over(inside).alias(f"_s_{n}") for n in names])
    totals = df.groupBy(*keys, bucket).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in names])
    before = W.partitionBy(*keys).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, bucket, *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in names]
    )
    joined = null_safe_join(local, offsets, [*keys, bucket])
    return joined.select(*keep, *[(F.col(f"_s_{n}") + F.col(f"_o_{n}")).alias(n) for n in names])


def position_sums(
    df: DataFrame, keys: Sequence[str], pos: str, sums: dict[str, Column], size: int = 65536
) -> DataFrame:
    """Running totals for a table that already has 1-based positions: blocks of positions are the buckets."""
    staged = df.withColumn("_bucket", F.floor((F.col(pos) - 1) / size).cast("long"))
    for name, value in sums.items():
        staged = staged.withColumn(f"_v_{name}", value)
    return bucketed_sums(staged, keys, "_bucket", [pos], list(sums), df.columns)


def row_index(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    ties: Sequence[str] = (),
    out: str = "idx",
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """1-based position of each row inside its key, as BIGINT, without one task per key."""
    return running_sums(df, keys, by, {out: F.lit(1).cast("long")}, ties, descending, buckets)


BLOCK = "_block"
OWN = "_own"


def halo_blocks(
    df: DataFrame, keys: Sequence[str], idx: str, before: int = 0, after: int = 0, size: int = 65536
) -> DataFrame:
    """Cut each key into blocks of ``size`` consecutive positions, each with copies of its neighbours.

    A block holds the ``before`` rows ahead of it and the ``after`` rows behind it as extra rows with
    ``_own`` = false.  A window over (key, block) with a frame no wider than that gives, on the rows
    with ``_own`` = true, exactly what a window over the whole key would give.
    """
    size = max(size, before + 1, after + 1)
    pos = F.pmod(F.col(idx) - 1, F.lit(size))
    block = F.floor((F.col(idx) - 1) / size)

    def place(number: Column, own: bool) -> Column:
        return F.struct(number.cast("long").alias("b"), F.lit(own).alias("own"))

    spots = [F.array(place(block, True))]
    if before:
        spots.append(F.when(pos >= size - before, F.array(place(block + 1, False))).otherwise(F.array()))
    if after:
        spots.append(F.when((pos < after) & (block > 0), F.array(place(block - 1, False))).otherwise(F.array()))
    placed = df.withColumn("_spot", F.explode(F.concat(*spots) if len(spots) > 1 else spots[0]))
    return placed.select(*df.columns, F.col("_spot.b").alias(BLOCK), F.col("_spot.own").alias(OWN))


def block_window(keys: Sequence[str], idx: str) -> W:
    return W.partitionBy(*keys, BLOCK).orderBy(idx)


def owned(df: DataFrame) -> DataFrame:
    return df.filter(F.col(OWN)).drop(OWN, BLOCK)


def spread_hash(key: str | Column, seed: int = 0) -> Column:
    """Repeatable 0..1000002 hash in plain BIGINT arithmetic, so that any SQL engine gives the same."""
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.pmod(k.cast("long"), F.lit(2147483647)) * F.lit(48271) + F.lit(seed * 7919 + 12345), F.lit(1000003))


def spread_hash_sql(key: str, seed: int = 0) -> str:
    """The same hash as SQL text, for non-negative keys."""
    return f"(((CAST({key} AS BIGINT) % 2147483647) * 48271 + {seed * 7919 + 12345}) % 1000003)"
