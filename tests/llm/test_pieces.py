"""SentencePiece: N best against all segmentations, exact round trips."""

import random
import zlib

import numpy as np
import pytest

from mlspark.llm import pieces as Q

MODEL = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def pieces():
    return Q.model(MODEL)


def every_segmentation(pieces, text, n):
    if not text:
        return [(0.0, ())]
    marked = Q.MARK + text.replace(" ", Q.MARK)
    ends, out = pieces.lattice(marked)[0], []

    def walk(place, score, back):
        if not place:
            out.append((-score, back))
            return
        for i, value, ids in ends[place]:
            walk(i, score + value, back + ids[::-1])

    walk(len(marked), 0.0, ())
    return [(-s, back[::-1]) for s, back in sorted(out)[:n]]


def test_equal_to_all_segmentations(pieces):
    rng = random.Random(0)
    for t in range(250):
        text = "".join(rng.choices("aaabeinst  .\nhé漢▁", k=rng.randint(0, 13)))
        if t % 5 == 0:
            text = text[:4] * 3
        for n in (1, 5):
            got = [(s, tuple(ids.tolist())) for s, ids in pieces.n_best(text, n)]
            assert got == every_segmentation(pieces, text, n), repr(text)


def test_long_segments_agree_in_score(pieces, monkeypatch):
    rng = random.Random(1)
    for _ in range(30):
        s = "".join(rng.choices("aeinst", k=12))
        ends, best = pieces.lattice(s)
        assert [p[0] for p in Q.search_long(ends, best, 6)] == [p[0] for p in Q.search_short(ends, best, 6)]
    long = "tion" * 5000
    (score, ids), second = pieces.n_best(long, 2)
    assert pieces.decode(ids.tolist()) == long and second[0] <= score


def test_first_is_the_viterbi_path(pieces):
    text = "The quick brown fox jumps over the lazy dog."
    marked = Q.MARK + text.replace(" ", Q.MARK)
    assert pieces.n_best(text, 1)[0][0] == pieces.lattice(marked)[1][-1]


def test_decoding_equals_the_library(pieces):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))
    for text in ("Hello  world", " lead and trail ", "é漢😀\n\t", "x"):
        for _, ids in pieces.n_best(text, 3):
            assert library.decode(ids.tolist()) == text == pieces.decode(ids.tolist())
        assert pieces.decode(library.encode(text)) == text


def test_query_rows_and_round_trip(spark):
    texts = [None, "", "a", "two  words", "line\nbreak", "a ▁ mark", "w " * 3000, "two  words"]
    docs = spark.createDataFrame([(i % 7, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, rank string")
    encoded = Q.encode(docs, 3, with_ids=True)
    rows = encoded.collect()
    assert all(r["round_trip"] for r in rows)
    assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["n_pieces"] == len(r["ids"]) for r in rows)
    for i in (0, 1):
        assert [(r["rank"], r["score"], r["n_pieces"]) for r in rows if r["doc_id"] == i and r["rank"] == 1][0][1:] == (0.0, 0) or i == 0
    by_text = {}
    for r in rows:
        by_text.setdefault(r["doc_id"], []).append(r["score"])
    assert all(s == sorted(s, reverse=True) for i, s in by_text.items() if i)
    decoded = {(r["doc_id"], r["text"]) for r in Q.decode(encoded).collect()}
    assert decoded == {(i % 7, (t or "").replace(Q.MARK, " ")) for i, t in enumerate(texts)}
    assert Q.encode(docs.limit(0)).collect() == []
    assert Q.decode(spark.createDataFrame([(1, 1, None)], "doc_id long, rank int, ids array<int>")).first()["text"] is None
