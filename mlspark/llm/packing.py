"""Packing: shortest-pack-first over the length histogram (operator 7).

Documents become token ids plus one separator, cut at multiples of the sequence length.  Only the
histogram of piece lengths, at most ``SEQUENCE`` numbers, reaches the driver.  There, lengths are
placed longest first, each into the open packing pattern with the most space left, and a pattern
carries a count, so the work does not depend on how many documents there are.  Pieces get a rank
inside their length on the executors, and the rank says which pattern copy and slot a piece takes.

Defined cases: a missing or empty text is the separator alone; equal rows are packed as often as they
occur; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mlspark.llm.common import arrow_map
from mlspark.session import partitions, written

SEQUENCE = 1024
SEPARATOR = 0
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


@lru_cache(maxsize=2)
def encoder(ranks_file: str):
    """The byte-level vocabulary as an encoder; its ids equal those of the JSON file of the same vocabulary."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(ranks_file), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)}
    )


def encode(text: str | None, ranks_file: str) -> np.ndarray:
    """Token ids of a text, its special strings read as special tokens, followed by the separator."""
    ids = encoder(ranks_file).encode(text or "", allowed_special="all")
    ids.append(SEPARATOR)
    return np.array(ids, dtype="<u4")


def token_pieces(
    docs: DataFrame, sequence: int = SEQUENCE, ranks_file: str = "byte_bpe_50k.tiktoken", with_ids: bool = False
) -> DataFrame:
    """Pieces of at most ``sequence`` ids per document, with their checksum and, if asked for, the ids."""
    schema = PIECES + (", ids array<int>" if with_ids else "")

    def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text")), strict=True):
            ids = encode(text, ranks_file)
            for start in range(0, len(ids), sequence):
                part = ids[start : start + sequence]
                row = (doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids))
                rows.append((*row, part.astype(np.int32)) if with_ids else row)
        columns = list(zip(*rows, strict=True))
        arrays = [pa.array(c, pa.int64()) for c in columns[:5]]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        if with_ids:
            arrays.append(pa.array(list(columns[5]), pa.list_(pa.int32())))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(arrays, names)

    return arrow_map(docs.select("doc_id", "text"), pieces, schema)


def packing_patterns(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, list[int]]]:
    """(count, lengths) of each packing pattern, placing lengths longest first into the shortest pack.

    Open patterns are kept by the space they have left.  A length with n pieces goes to the patterns
    with the most space; a pattern with more copies than pieces left is split in two.  Every length
    adds at most three patterns, so there are at most 3 * sequence of them.
    """
    open_by_space: dict[int, list[tuple[int, tuple]]] = {}
    spaces = np.zeros(sequence + 1, dtype=bool)

    def add(space: int, count: int, chain: tuple) -> None:
        open_by_space.setdefault(space, []).append((count, chain))
        spaces[space] = True

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            fitting = np.flatnonzero(spaces[length:])
            if not len(fitting):
                # a new pack takes this length until it is full, then the next one opens
                per_pack = sequence // length
                full, rest = divmod(left, per_pack)
                for count, items in ((full, per_pack), (1 if rest else 0, rest)):
                    if count:
                        chain = None
                        for _ in range(items):
                            chain = (length, chain)
                        add(sequence - items * length, count, chain)
                break
            space = int(fitting[-1]) + length
            count, chain = open_by_space[space].pop()
            if not open_by_space[space]:
                spaces[space] = False
            if count > left:
                add(space, count - left, chain)
            used = min(count, left)
            add(space - length, used, (length, chain))
            left -= used

    out = []
    for space in sorted(open_by_space):
        for count, chain in open_by_space[space]:
            lengths = []
            while chain is not None:
                lengths.append(chain[0])
                chain = chain[1]
            out.append((count, lengths[::-1]))
    return out


def slot_table(patterns: list[tuple[int, list[int]]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: the first rank of each slot, ascending, and that rank's sequence and offset."""
    slots: dict[int, list[tuple[int, int, int]]] = {}
    next_rank: dict[int, int] = {}
    sequence_id = 0
    for count, lengths in patterns:
        offset = 0
        for length in lengths:
            rank = next_rank.get(length, 0)
            slots.setdefault(length, []).append((rank, sequence_id, offset))
            next_rank[length] = rank + count
            offset += length
        sequence_id += count
    return {length: tuple(np.array(c, dtype=np.int64) for c in zip(*rows, strict=True)) for length, rows in slots.items()}


def ranked(salted: DataFrame) -> DataFrame:
    """0-based rank of each piece inside its length, without one task per length.

    A length is dealt over salts; ranks inside a salt are shifted by the counts of the salts before it.
    """
    inside = W.partitionBy("length", "_salt").orderBy("doc_id", "start", "ids_crc32")
    before = W.partitionBy("length").orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    counts = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    shifts = counts.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    local = salted.withColumn("_local", F.row_number().over(inside) - 1)
    return local.join(shifts, ["length", "_salt"]).withColumn("_rank", F.col("_local") + F.col("_shift")).drop("_salt", "_local", "_shift")


def pack(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces of at most ``sequence`` ids each."""
    # repeated rows have equal ids, so the row's number takes part in the salt, fixed by writing it
    salts = 8 * partitions(pieces.sparkSession)
    salt = F.pmod(F.xxhash64("doc_id", "start", F.monotonically_increasing_id()), F.lit(salts))
    pieces = written(pieces.withColumn("_salt", salt), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = slot_table(packing_patterns(histogram, sequence))

    def place(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lengths = batch.column("length").to_numpy()
        ranks = batch.column("_rank").to_numpy()
        ids, offsets = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
        for length in np.unique(lengths):
            rows = np.flatnonzero(lengths == length)
            firsts, sequences, starts = slots[int(length)]
            at = np.searchsorted(firsts, ranks[rows], side="right") - 1
            ids[rows] = sequences[at] + ranks[rows] - firsts[at]
            offsets[rows] = starts[at]
        kept = [n for n in batch.schema.names if n != "_rank"]
        arrays = [batch.column(n) for n in kept] + [pa.array(ids), pa.array(offsets)]
        yield pa.RecordBatch.from_arrays(arrays, [*kept, "sequence_id", "offset"])

    numbered = ranked(pieces)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema if f.name != "_rank")
    return arrow_map(numbered, place, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place in the sequences."""
    packed = pack(token_pieces(docs, sequence, with_ids=with_ids), sequence)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return packed.select(*columns, *(["ids"] if with_ids else []))
