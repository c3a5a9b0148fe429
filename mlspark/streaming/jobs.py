"""Streaming forms of the log, drift, session and rule jobs.

Every job reads a folder of parquet files as a stream, keeps its progress in a checkpoint folder below
the shared folder, and can be stopped and started again without losing or repeating rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mlspark.operators.clean import rule_flags
from mlspark.operators.drift import chi2_p_value

Trigger = Mapping[str, object]
ONCE: Trigger = {"availableNow": True}


def read_feed(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """Folder of parquet files as a stream; ``ts`` gets a zone, which watermarks need."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    feed = reader.parquet(path)
    return feed.withColumn("ts", F.col("ts").cast("timestamp")) if "ts" in feed.columns else feed


def stream_score_log(feed: DataFrame, score: Transformer | Callable[[DataFrame], DataFrame], log: str, checkpoint: str, trigger: Trigger = ONCE) -> StreamingQuery:
    """Scores every arriving row and appends it to a parquet log, each row exactly once."""
    scored = score.transform(feed) if isinstance(score, Transformer) else score(feed)
    return scored.writeStream.format("parquet").option("path", log).option("checkpointLocation", checkpoint).outputMode("append").trigger(**trigger).start()


# ---- drift over windows -----------------------------------------------------------------------------------


def reference_profile(df: DataFrame, col: str, bins: int = 10) -> tuple[list[float], list[float]]:
    """Bin edges at the reference quantiles and the share of reference rows per bin; 2 * bins numbers."""
    edges = sorted(set(df.approxQuantile(col, [i / bins for i in range(1, bins)], 0.001)))
    rows = df.groupBy(bin_of(F.col(col), edges).alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {r["bin"]: r["n"] for r in rows}
    total = sum(counts.values()) or 1
    return edges, [counts.get(i, 0) / total for i in range(len(edges) + 1)]


def bin_of(value: Column, edges: Sequence[float]) -> Column:
    """Number of edges at or below the value."""
    return sum(((value >= e).cast("int") for e in edges), F.lit(0))


def window_bins(df: DataFrame, col: str, edges: Sequence[float], width: str) -> DataFrame:
    """(start, bin, n) per tumbling window; works on tables and on streams with a watermark."""
    counted = df.groupBy(F.window("ts", width).alias("w"), bin_of(F.col(col), edges).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").alias("start"), "bin", "n")


def score_windows(bins: DataFrame, shares: Sequence[float]) -> DataFrame:
    """Per window: rows, largest gap of the cumulative shares, chi-square statistic and p-value."""
    counts = [F.coalesce(F.sum(F.when(F.col("bin") == i, F.col("n"))), F.lit(0)).cast("double").alias(f"c{i}") for i in range(len(shares))]
    wide = bins.groupBy("start").agg(F.sum("n").alias("n"), *counts)
    gaps, seen, expected_seen = [], F.lit(0.0), 0.0
    for i, share in enumerate(shares):
        seen, expected_seen = seen + F.col(f"c{i}"), expected_seen + share
        gaps.append(F.abs(seen / F.col("n") - F.lit(expected_seen)))
    cells = [(F.col(f"c{i}") - F.col("n") * F.lit(s)) ** 2 / (F.col("n") * F.lit(s)) for i, s in enumerate(shares) if s > 0]
    chi = sum(cells, F.lit(0.0))
    free = F.lit(float(len(cells) - 1))
    return wide.select("start", "n", F.greatest(*gaps).alias("ks_binned"), chi.alias("chi2")).withColumn("p_value", chi2_p_value("chi2", free))


def stream_drift(
    feed: DataFrame, col: str, edges: Sequence[float], out: str, checkpoint: str, width: str = "1 day", late: str = "1 hour", trigger: Trigger = ONCE
) -> StreamingQuery:
    """Bin counts of closed windows as a parquet table; rows later than the watermark are dropped.

    State is one counter per window and bin.  ``score_windows`` turns the table into drift figures.
    """
    counted = window_bins(feed.withWatermark("ts", late), col, edges, width)
    return counted.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(**trigger).start()


# ---- sessions, rules --------------------------------------------------------------------------------------------


def sessions(df: DataFrame, key: str, gap: str) -> DataFrame:
    """(key, start, end, n): stretches of activity without a pause of ``gap``; tables and streams alike."""
    grouped = df.groupBy(key, F.session_window("ts", gap).alias("s")).agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts"))
    return grouped.select(key, F.col("s.start").alias("start"), "last_ts", "n")


def stream_sessions(feed: DataFrame, key: str, gap: str, out: str, checkpoint: str, late: str = "1 hour", trigger: Trigger = ONCE) -> StreamingQuery:
    found = sessions(feed.withWatermark("ts", late), key, gap)
    return found.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(**trigger).start()


def stream_rules(feed: DataFrame, rules: Mapping[str, Column], out: str, checkpoint: str, trigger: Trigger = ONCE) -> StreamingQuery:
    """Rows for which a rule holds, with the names of the rules; no state."""
    hits = rule_flags(feed, rules, tag=None).filter(F.size("fired_rules") > 0)
    return hits.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(**trigger).start()
