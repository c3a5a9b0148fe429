"""Spelling variants: the trie frontier against all pairs, the whole query against plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mlspark.llm import variants as V


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def plain_pairs(words):
    return sorted((a, b) for a in words for b in words if one_edit(a, b))


def expected(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode()) if doc_id is not None else 1
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    form, near = {}, {}
    for w in n:
        near[w] = [x for x in n if one_edit(w, x)]
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = []
    for w in sorted(n):
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def random_words(rng, many, letters, longest=14):
    words = set()
    while len(words) < many:
        w = "".join(rng.choices(letters, k=rng.randint(7, longest)))
        words.add(w)
        for _ in range(rng.randint(0, 3)):
            i, c = rng.randrange(len(w)), rng.choice(letters)
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :], w + c])
            if len(w) >= 7:
                words.add(w)
    return sorted(words)


@pytest.mark.parametrize("letters,many", [("ab", 150), ("abcé", 300), ("abcdefghijklmnopqrstuvwxyzàÿ", 300)])
def test_near_words_equal_all_pairs(spark, letters, many):
    words = random_words(random.Random(many), many, letters)
    got = V.near(spark.createDataFrame([(w,) for w in words], "word string")).collect()
    assert sorted((r["word"], r["near"]) for r in got) == plain_pairs(words)


def test_prefixes_runs_of_one_letter_and_long_words(spark):
    long = "".join(random.Random(3).choices("abcdefgh", k=20_000))
    words = ["a" * k for k in range(7, 16)] + ["a" * 9 + "b", "b" + "a" * 9, long, long[1:], long[:-1], long + "x", long[:9000] + "z" + long[9001:], "q" * 7]
    got = V.near(spark.createDataFrame([(w,) for w in words], "word string")).collect()
    assert sorted((r["word"], r["near"]) for r in got) == plain_pairs(words)


def test_other_lengths(spark):
    words = sorted({"".join(w) for n in (2, 3, 4) for w in __import__("itertools").product("abc", repeat=n)})
    got = V.near(spark.createDataFrame([(w,) for w in words], "word string"), 2).collect()
    assert sorted((r["word"], r["near"]) for r in got) == plain_pairs(words)


@settings(max_examples=200, deadline=None)
@given(st.text("ab", max_size=6), st.text("ab", max_size=6))
def test_the_plain_rule_is_one_edit(a, b):
    edits = {a[:i] + a[i + 1 :] for i in range(len(a))} | {a[:i] + c + a[i + k :] for i in range(len(a) + 1) for k in (0, 1) for c in "ab"}
    assert one_edit(a, b) == (b in edits and a != b)


def documents():
    rng = random.Random(8)
    base = ["character", "Straßenbahn", "ÉLÉPHANT", "éléphant", "spelling", "spellings", "variant×s", "grouping", "Kilometer"]
    rows = [(None, "character spelling " * 3), (1, None), (2, ""), (3, "short words only 12345678"), (4, "a" * 3000 + " " + "a" * 3000 + " " + "a" * 3001 + " " + "a" * 3001)]
    for i in range(5, 160):
        words = rng.choices(base, weights=[400, 40, 20, 20, 60, 6, 9, 5, 3], k=40)
        for j in range(len(words)):
            if rng.random() < 0.04:
                w = words[j]
                k = rng.randrange(len(w))
                words[j] = rng.choice([w[:k] + w[k + 1 :], w[:k] + "e" + w[k:], w[:k] + "x" + w[k + 1 :]])
        rows.append((i, rng.choice([" ", "-", "1"]).join(words)))
    return rows + rows[:20] + [(201, "Chainword " * 260 + "chainwords " * 24 + "chainwordst " * 2)]


def test_query_equals_plain_python(spark):
    rows = documents()
    docs = spark.createDataFrame([(i, t, "kept out", 5) for i, t in rows], "doc_id long, text string, word string, n int")
    out = V.group(V.counts(V.perturbed(V.occurrences(docs))))
    got = sorted(tuple(r) for r in out.select("word", "form", "root", "n", "n_near", "form_n").collect())
    want = expected(rows)
    assert got == want
    assert any(w[2] != (w[1] or w[0]) for w in want) and sum(w[1] is not None for w in want) > 9


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert V.group(V.counts(V.perturbed(V.occurrences(docs)))).collect() == []
    assert V.near(spark.createDataFrame([], "word string")).collect() == []
