"""Live drift: the figures and verdicts of the drift report for every closed window of a feed.

The reference is a table of counts (column, value, ref); numbers are counted per bin.  Only closed windows
leave the stream, as counts per value, so a window's figures are final when they are written.  The batch
number names the folder of its rows, and a batch that runs again overwrites them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mlspark.operators.drift import ALPHA, chi2_p_value, ks_p_value
from mlspark.session import written
from mlspark.streaming.jobs import ONCE, Trigger, bin_of

VERDICT = "start timestamp, column string, test string, n_cur long, statistic double, p_value double, drifted boolean"


def values(numeric: Mapping[str, Sequence[float]], categorical: Sequence[str]) -> Column:
    """Array of (column, bin, value): bin numbers of numbers, the values of categories; missing values are left out."""
    none = F.lit(None)
    binned = [
        F.when(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")), F.struct(F.lit(c).alias("column"), bin_of(F.col(c), edges).alias("bin"), none.cast("string").alias("value")))
        for c, edges in numeric.items()
    ]
    named = [
        F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("column"), none.cast("int").alias("bin"), F.col(c).cast("string").alias("value"))) for c in categorical
    ]
    return F.array_compact(F.array(*binned, *named))


def reference_counts(df: DataFrame, numeric: Mapping[str, Sequence[float]], categorical: Sequence[str]) -> DataFrame:
    """(column, bin, value, ref): rows of the reference per bin and per category."""
    return df.select(F.inline(values(numeric, categorical))).groupBy("column", "bin", "value").agg(F.count(F.lit(1)).alias("ref"))


def window_counts(df: DataFrame, numeric: Mapping[str, Sequence[float]], categorical: Sequence[str], width: str) -> DataFrame:
    """(start, column, bin, value, cur) per tumbling window of ``ts``; tables and streams with a watermark."""
    rows = df.select("ts", F.inline(values(numeric, categorical)))
    counted = rows.groupBy(F.window("ts", width).alias("w"), "column", "bin", "value").agg(F.count(F.lit(1)).alias("cur"))
    return counted.select(F.col("w.start").alias("start"), "column", "bin", "value", "cur")


def ks_windows(current: DataFrame, reference: DataFrame) -> DataFrame:
    """Kolmogorov-Smirnov figures over bins.  A window and column hold one row per bin, so the running sums are short."""
    totals = current.groupBy("start", "column").agg(F.sum("cur").alias("n_cur"))
    known = reference.groupBy("column").agg(F.sum("ref").alias("n_ref"))
    base = totals.join(known, "column").join(reference.select("column", "bin", "ref"), "column")
    zero = F.lit(0).cast("long")
    cells = base.select("start", "column", "n_cur", "n_ref", "bin", "ref", zero.alias("cur")).unionByName(
        current.join(totals, ["start", "column"]).join(known, "column").select("start", "column", "n_cur", "n_ref", "bin", zero.alias("ref"), "cur")
    )
    per_bin = cells.groupBy("start", "column", "n_cur", "n_ref", "bin").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    upto = W.partitionBy("start", "column").orderBy("bin")
    gap = F.abs(F.sum("ref").over(upto) / F.col("n_ref") - F.sum("cur").over(upto) / F.col("n_cur"))
    found = per_bin.withColumn("gap", gap).groupBy("start", "column", "n_cur", "n_ref").agg(F.max("gap").alias("statistic"))
    return found.select("start", "column", F.lit("ks").alias("test"), "n_cur", "statistic", ks_p_value(F.col("statistic"), F.col("n_ref"), F.col("n_cur")).alias("p_value"))


def chi2_windows(current: DataFrame, reference: DataFrame) -> DataFrame:
    """Chi-square figures of the category counts of window and reference.

    A category that the window lacks adds ref * n_cur / n_ref to the statistic, so the categories of the
    reference are met only by the window's own ones and summed for the rest.
    """
    known = reference.groupBy("column").agg(F.sum("ref").alias("n_ref"), F.count(F.lit(1)).alias("k_ref"))
    totals = current.groupBy("start", "column").agg(F.sum("cur").alias("n_cur")).join(known, "column")
    met = current.join(reference.select("column", "value", "ref"), ["column", "value"], "left").join(totals, ["start", "column"])
    ref = F.coalesce("ref", F.lit(0))
    share = (ref + F.col("cur")) / (F.col("n_ref") + F.col("n_cur"))
    cell = (ref - share * F.col("n_ref")) ** 2 / (share * F.col("n_ref")) + (F.col("cur") - share * F.col("n_cur")) ** 2 / (share * F.col("n_cur"))
    sums = met.groupBy("start", "column", "n_cur", "n_ref", "k_ref").agg(
        F.sum(cell).alias("cells"), F.sum(ref).alias("seen"), F.sum(F.col("ref").isNull().cast("int")).alias("fresh")
    )
    statistic = F.col("cells") + (F.col("n_ref") - F.col("seen")) * F.col("n_cur") / F.col("n_ref")
    freedom = F.col("k_ref") + F.col("fresh") - 1
    found = sums.select("start", "column", F.lit("chi2").alias("test"), "n_cur", statistic.alias("statistic"), freedom.cast("double").alias("freedom"))
    return found.select("start", "column", "test", "n_cur", "statistic", chi2_p_value("statistic", "freedom").alias("p_value"))


def drift_verdicts(current: DataFrame, reference: DataFrame, share: float = 0.5, alpha: float = ALPHA) -> DataFrame:
    """One row per window and column, and per window a ``(dataset)`` row with the share of drifted columns.

    ``current`` is the output of ``window_counts``, ``reference`` that of ``reference_counts``.  Columns
    without a reference have no row.
    """
    numbers, names = F.col("bin").isNotNull(), F.col("bin").isNull()
    ks = ks_windows(current.filter(numbers), reference.filter(numbers))
    chi2 = chi2_windows(current.filter(names), reference.filter(names))
    flagged = ks.unionByName(chi2).withColumn("drifted", F.col("p_value") < alpha)
    drifted = F.avg(F.col("drifted").cast("int"))
    dataset = flagged.groupBy("start").agg(
        F.lit("(dataset)").alias("column"), F.lit("share").alias("test"), F.max("n_cur").alias("n_cur"), drifted.alias("statistic"),
        F.lit(None).cast("double").alias("p_value"), (drifted >= share).alias("drifted"),
    )
    return flagged.unionByName(dataset)


def stream_verdicts(
    feed: DataFrame,
    reference: DataFrame,
    numeric: Mapping[str, Sequence[float]],
    categorical: Sequence[str],
    out: str,
    checkpoint: str,
    width: str = "1 day",
    late: str = "1 hour",
    share: float = 0.5,
    alpha: float = ALPHA,
    trigger: Trigger = ONCE,
) -> StreamingQuery:
    """Writes the verdicts of closed windows below ``out``, one folder per batch.

    All counts of a window close in one batch, so no window is split.  A batch that is run again after a
    failure writes the same folder anew: every window is there once.  Rows later than the watermark are dropped.
    """
    counted = window_counts(feed.withWatermark("ts", late), numeric, categorical, width)

    def write(closed: DataFrame, number: int) -> None:
        kept = written(closed, "closed-windows")
        drift_verdicts(kept, reference, share, alpha).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return counted.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append").trigger(**trigger).start()


def read_verdicts(spark, out: str) -> DataFrame:
    """All verdicts written so far."""
    return spark.read.schema(VERDICT + ", batch long").parquet(out).drop("batch")
