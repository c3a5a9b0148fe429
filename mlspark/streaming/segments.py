"""Live gap segments: padded, numbered stretches of activity per key, written when they have ended."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from mlspark.streaming.jobs import ONCE, Trigger

STATE = "ended long, first array<long>, last array<long>, n array<long>"


def merge(first: np.ndarray, last: np.ndarray, n: np.ndarray, gap_ms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches joined wherever less than ``gap_ms`` lies between them, in order of time."""
    if not len(first):
        return first, last, n
    order = np.argsort(first, kind="stable")
    first, upto, n = first[order], np.maximum.accumulate(last[order]), n[order]
    starts = np.flatnonzero(np.concatenate([[True], first[1:] - upto[:-1] >= gap_ms]))
    ends = np.append(starts[1:], len(first)) - 1
    return first[starts], upto[ends], np.add.reduceat(n, starts)


def numbered_segments(df: DataFrame, key: str, gap_ms: int = 1000, pad_ms: int = 500) -> DataFrame:
    """(key, segment, start_ms, end_ms, n_events) of a stream with a watermark on ``ts``.

    A segment ends when the watermark is ``gap_ms`` past its last event, so silence follows each one and
    each end keeps ``pad_ms`` of it; starts keep it from the second segment on.  Segments of a key end in
    the order of time, also when events arrive out of order within the watermark.  The state of a key is the
    number of ended segments and its open stretches, about one per ``gap_ms`` of the watermark's delay; events
    are read in batches and never kept.  Events without a time take no part; a missing key is a key.
    """
    rows = df.filter(F.col("ts").isNotNull()).select(key, "ts", F.unix_millis("ts").alias("ms"))
    out = T.StructType([T.StructField(key, df.schema[key].dataType)] + [T.StructField(c, T.LongType()) for c in ("segment", "start_ms", "end_ms", "n_events")])

    def number(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ended, *kept = state.get if state.exists else (0, [], [], [])
        stretches = tuple(np.array(k, dtype=np.int64) for k in kept)
        if not state.hasTimedOut:
            for part in parts:
                ms = part["ms"].to_numpy(dtype=np.int64)
                fresh = merge(ms, ms, np.ones(len(ms), dtype=np.int64), gap_ms)
                stretches = merge(*(np.concatenate(pair) for pair in zip(stretches, fresh)), gap_ms)
        over = stretches[1] + gap_ms <= state.getCurrentWatermarkMs()
        first, last, n = (s[over] for s in stretches)
        waiting = [s[~over].tolist() for s in stretches]
        state.update((ended + len(first), *waiting))
        if waiting[1]:
            state.setTimeoutTimestamp(waiting[1][0] + gap_ms)
        places = np.arange(ended + 1, ended + 1 + len(first))
        yield pd.DataFrame(
            {
                key: pd.Series([group[0]] * len(first), dtype=object),
                "segment": places,
                "start_ms": first - np.where(places > 1, pad_ms, 0),
                "end_ms": last + pad_ms,
                "n_events": n,
            }
        )

    return rows.groupBy(key).applyInPandasWithState(number, out, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def stream_segments(
    feed: DataFrame, key: str, out: str, checkpoint: str, gap_ms: int = 1000, pad_ms: int = 500, late: str = "1 hour", trigger: Trigger = ONCE
) -> StreamingQuery:
    """Appends ended segments to a parquet table; rows later than the watermark are dropped."""
    found = numbered_segments(feed.withWatermark("ts", late), key, gap_ms, pad_ms)
    return found.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(**trigger).start()
