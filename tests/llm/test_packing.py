"""Packing: exact ids, gapless sequences, patterns against the histogram."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from mlspark.llm import packing as P

TEXTS = ["", None, "Hello  world\n\n  again", "<|endoftext|> it's 12,345 ünï  \t end ", "a" * 5000, " ".join(f"word{i}" for i in range(3000)), "x"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_equal_the_json_vocabulary(tokenizer):
    rng = random.Random(0)
    alphabet = ["the ", "a", " ", "  ", "\n", "\t", "é", "漢", "12", "'s", "'", "!!", "<|endoftext|>", " ", "​", "😀", "Q"]
    texts = [t or "" for t in TEXTS] + ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(300)]
    for text in texts:
        assert P.encode(text, "byte_bpe_50k.tiktoken").tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 0], repr(text)


def test_documents_come_back_from_their_sequences(spark, tokenizer):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)] + [(6, "x", "clash")], "doc_id long, text string, length string")
    rows = P.pack_documents(docs, 256, with_ids=True).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r["length"] == len(r["ids"]) <= 256
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        pieces[r["doc_id"]].append((r["start"], r["ids"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, text in enumerate(TEXTS):
        ids = [t for _, part in sorted(pieces[i]) for t in part]
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert ids == (want * 2 if i == 6 else want)  # the repeated row is packed twice
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 256


def test_patterns_use_every_piece_once():
    rng = random.Random(1)
    for _ in range(30):
        histogram = {rng.randint(1, 64): rng.randint(1, 1000) for _ in range(rng.randint(1, 30))}
        patterns = P.packing_patterns(histogram, 64)
        used = defaultdict(int)
        for count, lengths in patterns:
            assert count > 0 and sum(lengths) <= 64 and lengths == sorted(lengths, reverse=True)
            for length in lengths:
                used[length] += count
        assert used == histogram and len(patterns) <= 192
    assert P.packing_patterns({5: 3, 3: 3}, 8) == [(3, [5, 3])]
    assert P.packing_patterns({3: 200}, 64) == [(9, [3] * 21), (1, [3] * 11)]


def test_one_length_for_a_third_of_all_rows(spark):
    docs = spark.range(0, 600).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'same text' ELSE repeat('w ', CAST(id % 50 AS INT)) END AS text")
    rows = P.pack_documents(docs, 64).collect()
    slots = {(r["sequence_id"], r["offset"]) for r in rows}
    assert len(rows) == len(slots) == 600
    tokens = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) * 64 < tokens * 1.05


def test_empty_table(spark):
    assert P.pack_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []
