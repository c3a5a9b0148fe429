"""Quality rules: base counts and a hashed n-gram log-likelihood ratio (operator 5).

Every text is described by its runs of ``GRAM`` bytes, hashed into ``BUCKETS`` buckets.  The raw corpus
multinomial counts all documents, the trusted one all documents labelled as good.  A document's score
is the mean over its n-grams of log(trusted / raw), in fixed point, so it does not depend on how rows
are batched; it is kept if it passes the base rules and the score reaches ``THRESHOLD``.

Defined cases: a missing or empty text has no words and fails the base rules; equal rows are judged
alike; without trusted documents every score is 0 and the base rules decide; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mlspark.llm.common import Words, arrow_map, slices
from mlspark.session import ship

BITS = 16
BUCKETS = 1 << BITS
GRAM = 4
THRESHOLD = -0.4
SMOOTHING = 20.0
UNIT = 1 << 20
MIN_WORDS = 50
SYMBOLS = "[#*$%&|<>]"
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of all documents labelled as good, each once."""
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).filter((F.col("quality") == 1) & F.col("doc_id").isNotNull())
    return good.select(F.col("doc_id").alias("_trusted_id"))


def gram_buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the run of ``GRAM`` bytes that starts at each byte, -1 where the text ends sooner, and text bounds."""
    column = pc.fill_null(texts, "").cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset :][: len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[bounds[0] : bounds[-1]] if raw is not None else np.empty(0, np.uint8)
    bounds = bounds - bounds[0]
    padded = np.concatenate([data, np.zeros(GRAM, np.uint8)]).astype(np.uint32)
    runs = np.zeros(len(data), np.uint32)
    for k in range(GRAM):
        runs |= padded[k : k + len(data)] << np.uint32(8 * k)
    buckets = ((runs * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int64)
    for k in range(1, GRAM):
        late = bounds[1:] - k
        buckets[late[late >= bounds[:-1]]] = -1
    return buckets, bounds


def bucket_counts(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """(bucket, raw, trusted): n-grams of all documents and of the trusted ones, summed per task first.

    The ids are hashed per partition at every size, so texts are dealt out once and never sorted.
    """
    ship(docs.sparkSession)
    marked = docs.select("doc_id", "text").join(trusted.hint("shuffle_hash"), F.col("doc_id") == F.col("_trusted_id"), "left")
    marked = marked.select("text", F.col("_trusted_id").isNotNull().alias("good"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in slices(batch):
                buckets, bounds = gram_buckets(part.column("text"))
                flags = part.column("good").to_numpy(zero_copy_only=False).astype(bool)
                raw += np.bincount(buckets + 1, minlength=BUCKETS + 1)[1:]
                inside = np.repeat(flags, np.diff(bounds))
                good += np.bincount(buckets[inside] + 1, minlength=BUCKETS + 1)[1:]
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(good[used])], ["bucket", "raw", "trusted"])

    partial = marked.mapInArrow(count, "bucket long, raw long, trusted long")
    return partial.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """log(trusted / raw) of each bucket in fixed point; collects at most ``BUCKETS`` rows.

    Both shares get ``SMOOTHING`` n-grams per bucket, and never less than one trusted n-gram stands for,
    so rare buckets say little, however few documents are labelled: buckets that the trusted texts miss
    by chance are made up for by those they meet by chance, to within -0.2 on average.
    """
    raw, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in counts.collect():
        raw[row["bucket"]], good[row["bucket"]] = row["raw"], row["trusted"]
    if not good.sum():
        return np.zeros(BUCKETS, np.int64)
    ratio = raw.sum() / good.sum()
    smoothing = max(SMOOTHING, ratio)
    return np.rint(np.log((good * ratio + smoothing) / (raw + smoothing)) * UNIT).astype(np.int64)


def repeated_words(codes: np.ndarray) -> int:
    """Words inside three-word windows that occur twice or more in the text."""
    if len(codes) < 4:
        return 0
    if codes.max() < 1 << 21:
        windows = (codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:]
    else:
        pairs = np.unique((codes[:-1] << 32) | codes[1:], return_inverse=True)[1]
        windows = (pairs[:-1] << 32) | codes[2:]
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    again = np.isin(windows, twice)
    inside = np.zeros(len(codes), bool)
    for shift in range(3):
        inside[shift : len(again) + shift] |= again
    return int(inside.sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def base_counts(texts: pa.Array, words: Words) -> list[np.ndarray]:
    """The columns of ``BASE``."""
    column = pc.fill_null(texts, "")
    n_words = words.counts
    chars = pc.utf8_length(pc.replace_substring_regex(column, r"[ \t-\r]+", "")).to_numpy(zero_copy_only=False)
    symbols = pc.count_substring_regex(column, SYMBOLS).to_numpy(zero_copy_only=False)
    lines = np.array([repeated_lines(t) for t in column.to_pylist()], dtype=np.int64)
    bounds = zip(words.starts[:-1], words.starts[1:], strict=True)
    repeats = np.array([repeated_words(words.codes[a:b]) for a, b in bounds], dtype=np.int64)
    failed = (n_words < MIN_WORDS) | (100 * repeats > 50 * n_words)
    return [n_words, chars.astype(np.int64), symbols.astype(np.int64), lines, repeats, failed]


def mean_ratios(texts: pa.Array, ratios: np.ndarray) -> np.ndarray:
    """Mean log ratio over the n-grams of each text; 0 for a text without any."""
    buckets, bounds = gram_buckets(texts)
    totals = np.concatenate([[0], np.cumsum(np.where(buckets < 0, 0, ratios[buckets]))])
    return np.diff(totals[bounds]) / np.maximum(np.diff(bounds) - GRAM + 1, 1) / UNIT


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Base counts, score and verdict of every document."""
    ratios = log_ratios(bucket_counts(docs, trusted_ids(labels)))
    names = ["doc_id", *(part.split()[0] for part in BASE.split(", ")), "kept", "score"]

    def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        base = base_counts(batch.column("text"), Words(batch.column("text")))
        mean = mean_ratios(batch.column("text"), ratios)
        kept = ~base[-1] & (mean >= threshold)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, base), pa.array(kept), pa.array(mean)], names)

    return arrow_map(docs.select("doc_id", "text"), score, f"doc_id long, {BASE}, kept boolean, score double")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that pass, with all their columns."""
    ratios = log_ratios(bucket_counts(docs, trusted_ids(labels)))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        failed = base_counts(batch.column("text"), Words(batch.column("text")))[-1]
        yield batch.filter(pa.array(~failed & (mean_ratios(batch.column("text"), ratios) >= threshold)))

    return arrow_map(docs, run, docs.schema)
