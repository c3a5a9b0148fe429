"""Distribution drift between a reference table and a current table."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mlspark.plans.ordered import running_sums

ALPHA = 0.05


def _long(df: DataFrame, cols: Sequence[str], kind: str, side: int) -> DataFrame:
    """(column, value, ref, cur): one row per value, counted before it is shuffled further."""
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in cols])
    rows = df.select(F.inline(entries)).filter(F.col("value").isNotNull())
    counted = rows.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("long")
    return counted.select("column", "value", *((F.col("n").alias("ref"), zero.alias("cur")) if side == 0 else (zero.alias("ref"), F.col("n").alias("cur"))))


def _counts(reference: DataFrame, current: DataFrame, cols: Sequence[str], kind: str) -> DataFrame:
    both = _long(reference, cols, kind, 0).unionByName(_long(current, cols, kind, 1))
    return both.groupBy("column", "value").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))


def ks_p_value(statistic: Column, n_ref: Column, n_cur: Column) -> Column:
    """Asymptotic two-sample p-value (Kolmogorov series)."""
    size = F.sqrt(n_ref * n_cur / (n_ref + n_cur))
    scaled = (size + 0.12 + F.lit(0.11) / size) * statistic
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(100)), lambda j: F.when(j % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * j * j * scaled * scaled)
    )
    total = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
    return F.when(scaled < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))


def ks_drift(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic per numeric column, from running counts in value buckets."""
    counts = _counts(reference, current, cols, "double")
    running = running_sums(counts, ["column"], "value", {"upto_ref": F.col("ref"), "upto_cur": F.col("cur")})
    totals = counts.groupBy("column").agg(F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"))
    gap = F.abs(F.col("upto_ref") / F.col("n_ref") - F.col("upto_cur") / F.col("n_cur"))
    stat = running.join(totals, "column").groupBy("column", "n_ref", "n_cur").agg(F.max(gap).alias("statistic"))
    return stat.select(
        "column", F.lit("ks").alias("test"), "statistic", ks_p_value(F.col("statistic"), F.col("n_ref"), F.col("n_cur")).alias("p_value")
    )


def gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function, by series or continued fraction."""
    if x <= 0:
        return 1.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-15:
            n += 1
            term *= x / n
            total += term
        return 1.0 - total * scale
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or tiny)
        c = b + an / c or tiny
        step = d * c
        h *= step
        if abs(step - 1) < 1e-15:
            break
    return scale * h


@F.pandas_udf(T.DoubleType())
def chi2_p_value(statistic: pd.Series, freedom: pd.Series) -> pd.Series:
    return pd.Series([gamma_upper(f / 2, s / 2) if f > 0 else 1.0 for s, f in zip(statistic, freedom)])


def chi2_drift(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Chi-square statistic of the category x table contingency per column."""
    counts = _counts(reference, current, cols, "string")
    totals = counts.groupBy("column").agg(F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"))
    both = F.col("ref") + F.col("cur")
    share = both / (F.col("n_ref") + F.col("n_cur"))
    cell = (F.col("ref") - share * F.col("n_ref")) ** 2 / (share * F.col("n_ref")) + (F.col("cur") - share * F.col("n_cur")) ** 2 / (
        share * F.col("n_cur")
    )
    stat = counts.join(totals, "column").groupBy("column").agg(
        F.sum(cell).alias("statistic"), (F.count(F.lit(1)) - 1).alias("freedom")
    )
    # one row per column; only its p-value runs in Python
    return stat.select("column", F.lit("chi2").alias("test"), "statistic", chi2_p_value("statistic", "freedom").alias("p_value"))


def drift_report(
    reference: DataFrame, current: DataFrame, numeric: Sequence[str], categorical: Sequence[str], share: float = 0.5, alpha: float = ALPHA
) -> DataFrame:
    """One row per column with its drift flag, and a ``(dataset)`` row with the share of drifted columns."""
    rows = ks_drift(reference, current, numeric).unionByName(chi2_drift(reference, current, categorical))
    flagged = rows.withColumn("drifted", F.col("p_value") < alpha)
    drifted = F.avg(F.col("drifted").cast("int"))
    dataset = flagged.agg(
        F.lit("(dataset)").alias("column"),
        F.lit("share").alias("test"),
        drifted.alias("statistic"),
        F.lit(None).cast("double").alias("p_value"),
        (drifted >= share).alias("drifted"),
    )
    return flagged.unionByName(dataset)
