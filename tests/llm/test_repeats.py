"""Periodic runs: the grammar against plain search, the query's digests against plain Python."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from mlspark.llm import repeats as R

GAPS = "[^\x20\x09-\x0d]+"


def smallest_period(words):
    border, k = [0] * len(words), 0
    for i in range(1, len(words)):
        while k and words[i] != words[k]:
            k = border[k - 1]
        k += words[i] == words[k]
        border[i] = k
    return len(words) - border[-1]


def plain_runs(words, shortest=24, times=3):
    """Every maximal stretch of every period, kept when that period is its smallest."""
    out, n = set(), len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(shortest, times * q) and smallest_period(words[i : j + q]) == q:
                out.add((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    words = re.findall(GAPS, text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    return (
        len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest(),
    )


def sequences(rng, many):
    """Few words, planted powers with partial periods, runs within runs, neighbours that overlap."""
    for _ in range(many):
        out = []
        while len(out) < rng.randint(1, 250):
            unit = [rng.randrange(rng.choice([2, 3, 30])) for _ in range(rng.randint(1, 14))]
            inner = unit * rng.randint(1, 6) + unit[: rng.randrange(len(unit))]
            out += rng.choice([unit, inner, (inner + [99]) * rng.randint(1, 4), [rng.randrange(50) for _ in range(9)]])
        yield out


@pytest.mark.parametrize("shortest,times", [(24, 3), (6, 3), (3, 3), (12, 4)])
def test_runs_equal_plain_search(shortest, times):
    rng = random.Random(shortest)
    for _ in range(12):
        texts = list(sequences(rng, rng.randint(1, 12))) + [[]]
        rng.shuffle(texts)
        starts = np.cumsum([0, *map(len, texts)])
        rows = R.find_runs(np.array([w for t in texts for w in t], dtype=np.int64), starts, shortest, times)
        got = [[] for _ in texts]
        for s, e, q in rows.T.tolist():
            t = int(np.searchsorted(starts, s, side="right")) - 1
            got[t].append((s - int(starts[t]), e - s, q))
        assert got == [plain_runs(t, shortest, times) for t in texts]


def test_the_grammar_rebuilds_its_sequence():
    rng = random.Random(4)
    codes = np.array([rng.randrange(4) for _ in range(3000)], dtype=np.int64)
    segment = np.sort(np.array([rng.randrange(7) for _ in codes]))
    g = R.Grammar(codes, segment)
    words = np.unique(codes)

    def spell(x):
        return [int(words[x])] if x < g.terminals else spell(g.left[x]) + spell(g.right[x])

    assert [w for r in g.roots for w in spell(r)] == codes.tolist()
    for x in range(g.terminals, len(g.size)):
        assert spell(x) == codes[g.at[x] : g.at[x] + g.size[x]].tolist()


def test_long_powers_take_few_rounds():
    unit = list(range(4000))
    g = R.Grammar(np.array(unit * 25, dtype=np.int64), np.zeros(100_000, dtype=np.int64))
    assert len(g.rounds) < 80
    same = np.zeros(1_000_000, dtype=np.int64)
    assert R.find_runs(same, np.array([0, len(same)])).T.tolist() == [[0, 1_000_000, 1]]


def cases():
    rng = random.Random(1)
    words = ["a", "b", "été", "漢字", "x y", "line", "😀", "\x1c"]
    out = [None, "", " \n\t ", "one", "a " * 23, "a " * 24, ("a b " * 12).strip(), "a b " * 11 + "a", "\x0b\x0c".join(["q"] * 30)]
    out += ["\n".join(["the same line again"] * 9), " ".join(f"w{i % 500}" for i in range(1600)), " ".join(f"w{i}" for i in range(3000))]
    for s in sequences(rng, 150):
        out.append(rng.choice([" ", "\n", "  "]).join(words[x % len(words)] for x in s))
    return list(enumerate(out)) + [(7, "a b " * 30), (None, "z " * 40)]


def test_query_equals_plain_python(spark):
    rows = [(i, t, "kept out", [1]) for i, t in cases()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, collapsed string, runs array<int>")
    found = [tuple(r) for r in R.report(R.find(R.plant(docs))).collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(found, key=key) == sorted(((i, *expected(i, t)) for i, t, *_ in rows), key=key)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 and bool(t) for i, t in cases()) > 5


def test_two_periods_are_refused():
    with pytest.raises(ValueError):
        R.find_runs(np.zeros(9, dtype=np.int64), np.array([0, 9]), 4, 2)


def test_empty_table(spark):
    out = R.report(R.find(R.plant(spark.createDataFrame([], "doc_id long, text string"))))
    assert out.collect() == []
    assert [f"{n} {t}" for n, t in out.dtypes][:3] == ["doc_id bigint", "n_runs bigint", "start bigint"]
