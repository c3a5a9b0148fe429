"""Reshaping between long and wide tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_matrix(df: DataFrame, index: str, columns: str, value: str, values: Sequence) -> DataFrame:
    """Long to wide with explicit column values; duplicates are averaged, absent cells are NULL."""
    return df.groupBy(index).pivot(columns, list(values)).agg(F.avg(value))


def metrics_table(
    metrics: DataFrame, row: str, column: str, value: str, rows: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """One line per ``row`` and one column per ``column``, in the given order."""
    wide = metrics.filter(F.col(row).isin(list(rows))).groupBy(row).pivot(column, list(columns)).agg(F.max(value))
    place = F.array_position(F.array(*[F.lit(r) for r in rows]), F.col(row))
    return wide.orderBy(place)


def bag_of_words(df: DataFrame, key: str, tokens: str) -> DataFrame:
    """(key, term, tf) from a token array."""
    return df.select(key, F.explode(tokens).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
