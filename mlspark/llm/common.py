"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mlspark.session import ship

SAMPLE = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("text", pa.string())])
# bytes of text handled at once inside a task; a longer single text is handled alone
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_map(
    df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str | T.StructType
) -> DataFrame:
    """``mapInArrow`` with batches cut to ``SLICE_BYTES``, so that long texts never pile up in a worker."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield from fn(part)

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges of at most ``SLICE_BYTES`` of text each, never less than one row."""
    sizes = np.zeros(batch.num_rows, dtype=np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
            sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(sizes) - sizes) // SLICE_BYTES
    starts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [batch.num_rows]])
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


class Words:
    """White-space words of a slice of texts: codes into a dictionary, and where each text's words start."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray, lower: bool = False) -> None:
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        column = pc.fill_null(texts.cast(pa.large_string()), "")
        lists = pc.ascii_split_whitespace(pc.utf8_lower(column) if lower else column)
        flat, bounds = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        # white space at either end of a text leaves an empty word there
        filled = pc.greater(pc.binary_length(flat), 0)
        kept = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
        self.starts = kept[bounds].astype(np.int64)
        encoded = flat.filter(filled).dictionary_encode()
        self.codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.dictionary = encoded.dictionary
        self.counts = np.diff(self.starts)

    def owners(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def letters(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the dictionary words one after the other, and where each word starts."""
        offsets = np.frombuffer(self.dictionary.buffers()[1], dtype=np.int64)[self.dictionary.offset :][: len(self.dictionary) + 1]
        raw = self.dictionary.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None and raw.size else np.empty(0, np.uint8)
        return data, offsets - offsets[0]

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each dictionary word."""
        data, offsets = self.letters()
        return span_hashes(data, offsets)


def span_hashes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each non-empty byte range ``offsets[i]`` to ``offsets[i + 1]``."""
    if len(offsets) < 2:
        return np.empty(0, np.uint64)
    sizes = np.diff(offsets)
    powers = np.cumprod(np.full(int(sizes.max()) + 1, 0x9E3779B97F4A7C15, dtype=np.uint64))
    at = np.arange(len(data)) - np.repeat(offsets[:-1], sizes)
    terms = mix(data.astype(np.uint64) + np.uint64(1)) * powers[at]
    return mix(np.add.reduceat(terms, offsets[:-1]))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def crc_remainder(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n: the fold of a row."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, modulus: int, held: int, per_class: int) -> DataFrame:
    """At most ``per_class`` labelled texts of each class for fitting: (doc_id, label, text).

    Rows of the held-out fold, missing labels and labels other than 0 and 1 take no part.  The choice
    is by hash of the id, so it does not depend on partitions.  One label per document: the smallest.
    """
    known = (
        labels.select(F.col("doc_id").alias("doc_id"), F.col(column).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & (crc_remainder("doc_id", modulus) != held))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .withColumn("spread", F.xxhash64("doc_id"))
    )
    chosen = None
    for value in (0, 1):
        part = known.filter(F.col("label") == value).orderBy("spread", "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return found.select("doc_id", "label", F.coalesce("text", F.lit("")).alias("text")).limit(4 * per_class)


def fit_in_task(sample: DataFrame, fit: Callable[[list[int], pa.ChunkedArray], object]) -> object:
    """Fits a model on a bounded sample (doc_id, label, text) in one task, so that no text reaches the driver.

    Rows are put in the order of their ids first.  None if the sample is empty.
    """
    ship(sample.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches) or [pa.RecordBatch.from_pylist([], schema=SAMPLE)])
        rows = rows.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        model = fit(rows.column("label").to_pylist(), rows.column("text")) if rows.num_rows else None
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    row = sample.repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(row["model"]) if row else None
