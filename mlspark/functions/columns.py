"""Column expressions that stay inside generated code: lookups, bins, flags, formats, labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_column(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_numeric(col: str | Column, kind: str = "double") -> Column:
    """Text that is not a number becomes NULL; NaN does too, so that it never enters an aggregate."""
    number = F.trim(to_column(col)).try_cast(kind)
    return F.when(~F.isnan(number), number) if kind in ("double", "float") else number


def map_values(col: str | Column, values: Mapping) -> Column:
    """Dictionary lookup; keys that are not listed give NULL."""
    c = to_column(col)
    items = list(values.items())
    out = F.when(c == items[0][0], items[0][1])
    for key, value in items[1:]:
        out = out.when(c == key, value)
    return out


def all_equal_flag(cols: Sequence[str | Column], value) -> Column:
    """1 when every listed column equals ``value``, else 0 (also when one is missing)."""
    return reduce(lambda a, b: a & b, [to_column(c).eqNullSafe(F.lit(value)) for c in cols]).cast("int")


def cut(col: str | Column, bins: Sequence[float], labels: Sequence[str]) -> Column:
    """Half-open bins ``[lo, hi)``; values outside all bins, the last edge included, give NULL."""
    c = to_column(col)
    out = None
    for lo, hi, label in zip(bins[:-1], bins[1:], labels, strict=True):
        inside = (c >= lo) & (c < hi)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def safe_ratio(a: str | Column, b: str | Column) -> Column:
    """a / b with a zero divisor replaced by 1."""
    divisor = to_column(b)
    return to_column(a) / F.when(divisor == 0, 1).otherwise(divisor)


def epoch_ms_to_date(col: str | Column) -> Column:
    return F.timestamp_millis(to_column(col)).cast("date")


def year_month_to_date(year: str | Column, month: str | Column) -> Column:
    return F.make_date(to_column(year), to_column(month), F.lit(1))


def clip_lower(col: str | Column, low: float = 0) -> Column:
    c = to_column(col)
    return F.when(c < low, F.lit(low)).otherwise(c)


def srt_timestamp(seconds: str | Column) -> Column:
    """``HH:MM:SS,mmm`` with the milliseconds truncated."""
    s = to_column(seconds)
    whole = F.floor(s).cast("long")
    millis = F.floor((s - whole) * 1000).cast("long")
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(whole / 3600), F.floor(whole % 3600 / 60), whole % 60, millis)


def truncate_at_words(col: str | Column, words: Sequence[str]) -> Column:
    """Cut at the first occurrence of each word in turn, trimming after a cut only."""
    out = to_column(col)
    for word in words:
        out = F.when(F.contains(out, F.lit(word)), F.trim(F.substring_index(out, word, 1))).otherwise(out)
    return out


def after_marker(col: str | Column, marker: str) -> Column:
    """Text behind the last marker, trimmed; the whole text when the marker is absent."""
    return F.trim(F.substring_index(to_column(col), marker, -1))


def any_label_contains(labels: str | Column, part: str) -> Column:
    """True when any predicted label contains ``part``; an empty or missing list gives False."""
    return F.coalesce(F.exists(to_column(labels), lambda x: F.contains(x["label"], F.lit(part))), F.lit(False))


def argmax(scores: str | Column) -> Column:
    """0-based position of the largest score, the first one on ties."""
    s = to_column(scores)
    return (F.array_position(s, F.array_max(s)) - 1).cast("int")


def argmax_label(scores: str | Column, labels: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), argmax(scores) + 1)


def inverse_minmax(col: str | Column, low: Column, high: Column, to: tuple[float, float] = (0.0, 1.0)) -> Column:
    """Undo a min-max scaling onto ``to``."""
    return (to_column(col) - to[0]) / (to[1] - to[0]) * (high - low) + low


def flag_names(flags: Sequence[str | tuple[str, Column]], sep: str = " ") -> Column:
    """Names of the 0/1 flags that are set, joined by ``sep``."""
    pairs = [(f, F.col(f)) if isinstance(f, str) else f for f in flags]
    return F.array_join(F.array(*[F.when(c == 1, F.lit(n)) for n, c in pairs]), sep)
