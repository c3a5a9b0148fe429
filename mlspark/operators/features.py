"""Feature preparation: fit on one table, apply to any."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mlspark.operators.clean import categories, category_index, one_hot_sparse


def fit_standard(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column, one row to the driver."""
    row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def standard(col: str, params: tuple[float, float]) -> Column:
    """z-score; a constant column is divided by 1."""
    mean, std = params
    return (F.col(col) - F.lit(mean)) / F.lit(std if std else 1.0)


def standard_scale(df: DataFrame, cols: Sequence[str], fitted: Mapping | None = None) -> DataFrame:
    params = fitted or fit_standard(df, cols)
    return df.withColumns({c: standard(c, params[c]) for c in cols})


def fit_minmax(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    row = df.agg(*[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols]).first()
    return {c: (row[f"lo_{c}"], row[f"hi_{c}"]) for c in cols}


def minmax(col: str, params: tuple[float, float], to: tuple[float, float] = (0.0, 1.0)) -> Column:
    low, high = params
    span = (high - low) or 1.0
    return (F.col(col) - F.lit(low)) / F.lit(span) * (to[1] - to[0]) + to[0]


def minmax_scale(df: DataFrame, cols: Sequence[str], to: tuple[float, float] = (0.0, 1.0), fit_on: DataFrame | None = None) -> DataFrame:
    """Scale to a range learned from ``fit_on`` (for example normal rows only)."""
    params = fit_minmax(fit_on if fit_on is not None else df, cols)
    return df.withColumns({c: minmax(c, params[c], to) for c in cols})


def one_hot_ignore_unknown(col: str, known: Sequence) -> Column:
    """Indicator array over the fitted categories; an unseen or missing one gives all zero."""
    return F.array(*[F.coalesce((F.col(col) == v).cast("double"), F.lit(0.0)) for v in known])


def ordinal_encode(col: str, order: Sequence, unknown: int = -1) -> Column:
    """Position in the given order, ``unknown`` for anything else."""
    place = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(col)) - 1
    return F.coalesce(F.when(place < 0, F.lit(unknown)).otherwise(place), F.lit(unknown)).cast("int")


def fit_one_hot(df: DataFrame, cols: Sequence[str]) -> dict[str, list]:
    return categories(df, cols)


def one_hot_known(df: DataFrame, col: str, fit_on: DataFrame, out: str, sparse: bool = False) -> DataFrame:
    """Adds the indicators of the categories of ``fit_on``: an array, or with ``sparse`` a sparse vector."""
    if sparse:
        return one_hot_sparse(df, col, category_index(fit_on, col), out)
    return df.withColumn(out, one_hot_ignore_unknown(col, fit_one_hot(fit_on, [col])[col]))


def interactions(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """All products of two different columns; the originals stay, no constant."""
    return df.withColumns({f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in combinations(cols, 2)})


def tfidf_l2(bag: DataFrame, key: str, term: str, tf: str, n_rows: Column | None = None) -> DataFrame:
    """tf * (ln((1 + n) / (1 + df)) + 1), rows scaled to length 1: (key, term, weight).

    Document frequencies are one partial aggregate; the join on the term is skew-safe because the
    frequency side holds each term once.  Rows go to their key once more, where their length is taken; those without
    a key have no weight.
    """
    total = n_rows if n_rows is not None else bag.select(F.countDistinct(key)).scalar()
    frequency = bag.groupBy(term).agg(F.count(F.lit(1)).alias("_df"))
    raw = bag.join(frequency, term).select(
        key, term, (F.col(tf) * (F.log((F.lit(1) + total) / (F.col("_df") + 1)) + 1)).alias("_raw")
    )
    length = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(W.partitionBy(key)))
    return raw.filter(F.col(key).isNotNull()).select(key, term, (F.col("_raw") / length).alias("weight"))


def filter_vocabulary(bag: DataFrame, key: str, term: str, no_below: int = 5, no_above: float = 0.5) -> DataFrame:
    """Terms in at least ``no_below`` documents and at most the share ``no_above``: (term, df)."""
    total = bag.select(F.countDistinct(key)).scalar()
    frequency = bag.groupBy(term).agg(F.count(F.lit(1)).alias("df"))
    return frequency.filter((F.col("df") >= no_below) & (F.col("df") <= total * F.lit(no_above)))
