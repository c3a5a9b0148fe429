"""Ordered operators on many series at once.

``calendar=True`` says that a series holds at most one row per calendar step (day, month), so a plain
window is bounded by the calendar.  Otherwise the series is cut into blocks with halo rows, and no
task depends on the length of one series.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mlspark.plans.ordered import block_window, halo_blocks, null_safe_join, owned, position_sums, row_index
from mlspark.session import written

Build = Callable[[W], dict[str, Column]]


def over_series(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    build: Build,
    before: int = 0,
    after: int = 0,
    ties: Sequence[str] = (),
    calendar: bool = False,
    position: str | None = None,
) -> DataFrame:
    """Add window columns whose frames reach at most ``before`` rows back and ``after`` rows ahead.

    ``position`` names a 1-based row number inside the key when the table already has one.
    """
    if calendar:
        return df.withColumns(build(W.partitionBy(*keys).orderBy(order, *ties)))
    if position is None:
        indexed, idx = row_index(df, keys, order, ties, out="_pos"), "_pos"
    else:
        indexed, idx = df, position
    blocks = halo_blocks(indexed, keys, idx, before, after)
    out = owned(blocks.withColumns(build(block_window(keys, idx))))
    return out if position else out.drop("_pos")


def mean_of_last(value: str, n: int, w: W) -> Column:
    """Trailing mean of n rows, missing until n non-missing values are there."""
    frame = w.rowsBetween(1 - n, 0)
    return F.when(F.count(value).over(frame) == n, F.avg(value).over(frame))


def moving_average(df, keys, order, value, n: int, out: str = "moving_average", **kw) -> DataFrame:
    return over_series(df, keys, order, lambda w: {out: mean_of_last(value, n, w)}, before=n - 1, **kw)


def pct_change(df, keys, order, value, out: str = "daily_return", **kw) -> DataFrame:
    return over_series(df, keys, order, lambda w: {out: F.col(value) / F.lag(value).over(w) - 1}, before=1, **kw)


def rolling_std(value: str, n: int, w: W) -> Column:
    frame = w.rowsBetween(1 - n, 0)
    return F.when(F.count(value).over(frame) == n, F.stddev_samp(value).over(frame))


def annualized_volatility(df, keys, order, returns, n: int = 30, days: int = 365, out: str = "volatility", **kw) -> DataFrame:
    return over_series(
        df, keys, order, lambda w: {out: rolling_std(returns, n, w) * F.sqrt(F.lit(float(days)))}, before=n - 1, **kw
    )


def financial_metrics(df, keys, order, value, short: int = 25, long: int = 75, vol: int = 30, **kw) -> DataFrame:
    """Two moving averages, daily return and annualised volatility over one ordering of the data."""

    def first(w: W) -> dict[str, Column]:
        return {
            f"ma_{short}": mean_of_last(value, short, w),
            f"ma_{long}": mean_of_last(value, long, w),
            "daily_return": F.col(value) / F.lag(value).over(w) - 1,
        }

    if kw.get("calendar"):
        base = over_series(df, keys, order, first, **kw)
        return annualized_volatility(base, keys, order, "daily_return", vol, **kw)
    indexed = row_index(df, keys, order, kw.pop("ties", ()), out="_pos")
    blocks = halo_blocks(indexed, keys, "_pos", before=max(long, vol) + 1)
    w = block_window(keys, "_pos")
    blocks = blocks.withColumns(first(w))
    return owned(blocks.withColumn("volatility", rolling_std("daily_return", vol, w) * F.sqrt(F.lit(365.0)))).drop("_pos")


def smooth_valid(df, keys, order, value, n: int, out: str = "smoothed", **kw) -> DataFrame:
    """Moving average on full windows only."""
    return moving_average(df, keys, order, value, n, out, **kw).filter(F.col(out).isNotNull())


def last_mean(df: DataFrame, keys: Sequence[str], order: str, value: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """Mean of the last n rows of each series; the rank limit trims every partition before the shuffle."""
    latest = W.partitionBy(*keys).orderBy(F.desc(order), *[F.desc(t) for t in ties])
    kept = df.withColumn("_rn", F.row_number().over(latest)).filter(F.col("_rn") <= n)
    return kept.groupBy(*keys).agg(F.avg(value).alias("last_mean"), F.count(F.lit(1)).alias("n_rows"))


def boost_flag(df, keys, order, value, n: int, threshold: float, out: str = "boost", **kw) -> DataFrame:
    """Whether a value stands out against its trailing mean; never before n rows are there."""

    def build(w: W) -> dict[str, Column]:
        mean = mean_of_last(value, n, w)
        v = F.col(value)
        stands_out = ((v > 0) & (mean <= 0)) | ((mean > 0) & (v / mean >= threshold))
        return {out: F.coalesce(stands_out, F.lit(False))}

    return over_series(df, keys, order, build, before=n - 1, **kw)


def sequences(df, keys, order, value, length: int, out: str = "window", **kw) -> DataFrame:
    """All sliding windows of ``length`` values, each on the row where it starts."""

    def build(w: W) -> dict[str, Column]:
        return {out: F.collect_list(value).over(w.rowsBetween(0, length - 1))}

    return over_series(df, keys, order, build, after=length - 1, **kw).filter(F.size(out) == length)


def supervised_windows(df, keys, order, value, step: int, out: str = "window", target: str = "target", **kw) -> DataFrame:
    """Windows of ``step`` values with the value that follows as the target."""

    def build(w: W) -> dict[str, Column]:
        return {
            out: F.collect_list(value).over(w.rowsBetween(0, step - 1)),
            target: F.lead(value, step).over(w),
            "target_order": F.lead(order, step).over(w),
        }

    return over_series(df, keys, order, build, after=step, **kw).filter(F.col(target).isNotNull())


def chronological_split(
    df: DataFrame, keys: Sequence[str], order: str, ratio: float = 0.2, step: int = 0, ties: Sequence[str] = (), calendar: bool = False
) -> DataFrame:
    """``part`` is train for the first int(n(1-ratio)) rows, else test; ``test_input`` marks the rows that
    test windows read: the test part and the ``step`` rows before it."""
    if calendar:
        indexed = df.withColumn("idx", F.row_number().over(W.partitionBy(*keys).orderBy(order, *ties)).cast("long"))
    else:
        indexed = row_index(df, keys, order, ties, out="idx")
    sizes = df.groupBy(*keys).agg(F.floor(F.count(F.lit(1)) * F.lit(1 - ratio)).cast("long").alias("_train"))
    placed = null_safe_join(indexed, sizes, keys)
    return placed.select(
        *indexed.columns,
        F.when(F.col("idx") <= F.col("_train"), "train").otherwise("test").alias("part"),
        (F.col("idx") > F.col("_train") - step).alias("test_input"),
    )


def islands(df: DataFrame, keys: Sequence[str], order: str, starts: Callable[[Column, Column], Column], ties: Sequence[str] = ()) -> DataFrame:
    """Number runs of rows: ``starts(previous, current)`` says where a new run begins.

    Adds ``starts_run``, ``run_no`` (from 1) and ``pos`` (row position in the key).
    """

    def build(w: W) -> dict[str, Column]:
        previous = F.lag(order).over(w)
        return {"starts_run": previous.isNull() | starts(previous, F.col(order))}

    # positions are found once; what follows reads them from the written table
    indexed = written(row_index(df, keys, order, ties, out="pos"), "positions")
    marked = over_series(indexed, keys, order, build, before=1, position="pos")
    return position_sums(marked, keys, "pos", {"run_no": F.col("starts_run").cast("long")})


def collapse_adjacent(df: DataFrame, keys: Sequence[str], idx: str, max_gap: int = 2) -> DataFrame:
    """One row per run of candidates whose indices lie at most ``max_gap`` apart: element len // 2 of the run.

    The middle is found by position, so a run of any length is never gathered.
    """
    runs = written(islands(df, keys, idx, lambda a, b: b - a > max_gap), "runs")
    middle = runs.groupBy(*keys, "run_no").agg(
        (F.min("pos") + F.floor(F.count(F.lit(1)) / 2)).cast("long").alias("pos"), F.count(F.lit(1)).alias("run_size")
    )
    return null_safe_join(runs.select(*keys, idx, "pos"), middle, [*keys, "pos"]).select(*keys, idx, "run_size")


def topn_per_group(df: DataFrame, keys: Sequence[str], score: str, n: int, tie: Sequence[str], out: str = "rank") -> DataFrame:
    """Best n rows per group; each partition drops all but n rows per group before the shuffle."""
    w = W.partitionBy(*keys).orderBy(F.desc(score), *tie)
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= n).withColumn(out, F.col(out).cast("long"))


def gap_segments(
    df: DataFrame, keys: Sequence[str], ts: str, gap_ms: int = 1000, pad_ms: int = 500, ties: Sequence[str] = ()
) -> DataFrame:
    """Split a timeline where nothing happens for ``gap_ms``; inner edges keep ``pad_ms`` of silence.

    Segments are numbered from 1; a timeline without a long gap is one segment.
    """
    ms = df.withColumn("_ms", F.unix_millis(F.col(ts).cast("timestamp")))

    def build(w: W) -> dict[str, Column]:
        return {
            "_new": F.coalesce(F.col("_ms") - F.lag("_ms").over(w) >= gap_ms, F.lit(True)),
            "_last": F.coalesce(F.lead("_ms").over(w) - F.col("_ms") >= gap_ms, F.lit(False)),
        }

    indexed = written(row_index(ms, keys, "_ms", ties, out="_pos"), "positions")
    marked = over_series(indexed, keys, "_ms", build, before=1, after=1, position="_pos")
    numbered = position_sums(marked, keys, "_pos", {"segment": F.col("_new").cast("long")})
    return numbered.groupBy(*keys, "segment").agg(
        (F.min("_ms") - F.when(F.col("segment") > 1, pad_ms).otherwise(0)).alias("start_ms"),
        (F.max("_ms") + F.when(F.bool_or("_last"), pad_ms).otherwise(0)).alias("end_ms"),
        F.count(F.lit(1)).alias("n_events"),
    )


# fixed values: sentences of the trend commentary
TREND_RISING = "明確な増加傾向"
TREND_FALLING = "明確な減少傾向"
TREND_FLAT = "ほぼ横ばい"
PACE_UP = "ペースは加速しています"
PACE_DOWN = "ペースは減速しています"
PACE_SAME = "ペースはほぼ同じです"
LINE_DIRECTION = "最新のトレンドは「%s」を示しています。"
LINE_LATEST = "  - 最新(%s)の上昇ペース: %.4f ppm/月"
LINE_SKIPPED = "%d年前のトレンドがほぼゼロのため、加速/減速の評価はスキップします。"
LINE_COMPARED = "%d年前と比較して、%s。"
LINE_PAST = "  - %d年前(%s)の上昇ペース: %.4f ppm/月"
LINE_RATIO = "  - 上昇ペースは約 %.2f 倍に変化しました。"
MONTH_FORMAT = "yyyy年MM月"


def trend_commentary(df: DataFrame, keys: Sequence[str], ts: str, slope: str, years: int) -> DataFrame:
    """Text per series: direction of the latest slope, and its pace against the nearest value years ago."""
    point = F.struct(F.col(ts).alias("ts"), F.col(slope).alias("v"))
    latest = df.groupBy(*keys).agg(F.max_by(point, ts).alias("now"))
    aim = F.add_months(F.col("now.ts"), -12 * years)
    past = (
        null_safe_join(df, latest, keys)
        .groupBy(*keys, "now")
        .agg(F.min_by(point, F.struct(F.abs(F.datediff(ts, aim)), F.col(ts))).alias("past"))
    )
    now, was = F.col("now.v"), F.col("past.v")
    direction = F.when(now > 0.001, TREND_RISING).when(now < -0.001, TREND_FALLING).otherwise(TREND_FLAT)
    pace = F.when(now > was, PACE_UP).when(now < was, PACE_DOWN).otherwise(PACE_SAME)
    month_now, month_past = F.date_format("now.ts", MONTH_FORMAT), F.date_format("past.ts", MONTH_FORMAT)
    compared = F.concat_ws(
        "\n",
        F.format_string(LINE_COMPARED, F.lit(years), pace),
        F.format_string(LINE_PAST, F.lit(years), month_past, was),
        F.format_string(LINE_RATIO, now / was),
    )
    skipped = F.format_string(LINE_SKIPPED, F.lit(years))
    return past.select(
        *keys,
        F.col("now.ts").alias("latest_month"),
        F.col("past.ts").alias("past_month"),
        F.concat_ws(
            "\n",
            F.format_string(LINE_DIRECTION, direction),
            F.format_string(LINE_LATEST, month_now, now),
            F.when(F.abs(was) < 1e-6, skipped).otherwise(compared),
        ).alias("commentary"),
    )
