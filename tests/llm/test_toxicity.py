"""Toxicity: gradients, held-out accuracy on planted words, every window scored."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from mlspark.llm import toxicity as T
from mlspark.llm.common import Words

BAD = ["zorgath", "mulkrin", "vexplod"]


def prose(rng, n):
    return [
        "".join(rng.choices(["an", "the", "ti", "on", "er", "in", "re", "st"], k=rng.randint(1, 4))) for _ in range(n)
    ]


def planted(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words, toxic = prose(rng, rng.randint(5, 150)), int(i % 3 == 0)
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", "a", "est", "."]))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_gradients():
    rng = np.random.default_rng(1)
    words = Words(pa.array(["Aa bb cc dd ee", "bb cc fffff ggg"]), lower=True)
    lexicon = T.Lexicon.of(words)
    p = {k: v.astype(np.float64) for k, v in T.initial(rng).items()}
    p["word_odds"], p["gram_odds"] = (rng.standard_normal(1 << T.ODDS_BITS) for _ in range(2))
    codes = T.window_codes(words, *T.windows(words.counts))
    y = np.array([1.0, 0.0])

    def loss(q):
        z = T.forward(q, lexicon.inputs(q), codes)
        return float(np.sum(np.log1p(np.exp(z)) - y * z))

    logit, cache = T.forward(p, lexicon.inputs(p), codes, keep=True)
    gradient = T.backward(p, lexicon, codes, cache, T.sigmoid(logit) - y)
    assert set(gradient) == {k for k in p if not k.endswith("odds")}
    for name, g in gradient.items():
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        values = []
        for step in (1e-3, -1e-3):
            moved = p[name].copy()
            moved[at] += step
            values.append(loss(p | {name: moved}))
        assert g[at] == pytest.approx((values[0] - values[1]) / 2e-3, rel=1e-2, abs=1e-5), name


def test_windows_cover_every_word_and_overlap():
    counts = np.array([0, 1, T.WINDOW, T.WINDOW + 1, 1000])
    owner, start, length = T.windows(counts)
    for i, n in enumerate(counts):
        mine = [(a, a + m) for o, a, m in zip(owner, start, length) if o == i]
        assert {w for a, b in mine for w in range(a, b)} == set(range(n))
        assert all(b > c for (_, b), (c, _) in zip(mine, mine[1:]))


@pytest.fixture(scope="module")
def model():
    rows = [(y, t) for i, t, y in planted(0, 900) if zlib.crc32(str(i).encode()) % 4 != 2]
    return T.train([y for y, _ in rows], pa.array([t for _, t in rows]))


def test_held_out_accuracy(spark, model):
    rows = planted(1, 400)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(1000, None, "x"), (1001, "", "x"), (1002, " ", "x")], "doc_id long, text string, score string")
    out = {r["doc_id"]: r for r in T.apply(docs, model).collect()}
    hits = np.mean([out[i]["predicted"] == y for i, _, y in rows])
    assert hits > 0.95
    assert all(out[i]["score"] == 0.0 and out[i]["predicted"] == 0 for i in (1000, 1001, 1002))
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in out.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out.values())


def test_late_word_in_a_long_text_counts(spark, model):
    rng = random.Random(5)
    clean = prose(rng, 20_000)
    docs = spark.createDataFrame([(1, " ".join(clean)), (2, " ".join([*clean, BAD[0]])), (2, " ".join([*clean, BAD[0]]))], "doc_id long, text string")
    scores = [(r["doc_id"], r["predicted"], r["score"]) for r in T.apply(docs, model).collect()]
    assert {(i, p) for i, p, _ in scores} == {(1, 0), (2, 1)}
    assert len({s for i, _, s in scores if i == 2}) == 1


def test_without_both_classes(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, toxic int")
    assert {r["score"] for r in T.score(docs, labels).collect()} == {0.0}
    assert T.score(docs.limit(0), labels).collect() == []
    assert T.keep_clean(docs, labels).count() == 2
