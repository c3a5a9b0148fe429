"""Near duplicates: unbiased signatures, classes against all pairs, hot groups."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from mlspark.llm import near_dedup as N
from mlspark.llm.common import Words


def bags(text):
    words = (text or "").split()
    return Counter(zip(*[words[k:] for k in range(5)])) if len(words) >= 5 else Counter([tuple(words)])


def similarity(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def classes_of(rows):
    """Smallest id of each connected class, from all pairs."""
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [(i, bags(t)) for i, t in rows]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1 :]:
            if similarity(a, b) >= 0.8 - 1e-12 and find(i) != find(j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i, _ in rows}


@pytest.mark.parametrize("most", [1, 3, 20])
def test_slots_agree_like_the_weighted_jaccard(most):
    rng = np.random.default_rng(most)
    errors = []
    for _ in range(120):
        values = rng.integers(1, 2**63, 100, dtype=np.uint64)
        a = rng.integers(0, most + 1, 100)
        b = np.where(rng.random(100) < 0.6, a, rng.integers(0, most + 1, 100))
        value = np.concatenate([values[a > 0], values[b > 0]])
        owner = np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()])
        s = N.signatures(value, owner, np.concatenate([a[a > 0], b[b > 0]]), 2)
        errors.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.016 and np.std(errors) < 0.06


def test_signature_does_not_depend_on_the_batch():
    texts = ["a b c d e f a b c d e f g", "x y", "", "q " * 500, " ".join(map(str, range(300)))]

    def signed(some):
        return N.signatures(*N.weights(*N.shingles(Words(pa.array(some)))), len(some))

    together = signed(texts)
    for i, text in enumerate(texts):
        assert (signed([text])[0] == together[i]).all()
    assert not together[2].any()


def test_overlap_is_the_multiset_jaccard():
    rng = random.Random(0)
    for _ in range(50):
        a, b = (" ".join(rng.choices("abc", k=rng.randint(1, 40))) for _ in range(2))
        value, owner, count = N.weights(*N.shingles(Words(pa.array([a, b]))))
        got = N.overlap(*[(value[owner == k], count[owner == k]) for k in (0, 1)])
        assert got == pytest.approx(similarity(bags(a), bags(b)))


def edited(rng, words, n):
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"e{rng.randrange(10**6)}"
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    rows, texts = [], []
    for _ in range(25):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(30, 200))]
        texts.append(base)
        for _ in range(rng.randint(0, 5)):
            texts.append(edited(rng, base, rng.randint(0, len(base) // 12)))
    # a star: copies near the middle and often not near each other
    middle = [f"m{i}" for i in range(400)]
    texts += [middle] + [edited(rng, middle, rng.randint(6, 9)) for _ in range(60)]
    # a chain: each text near the next one only
    chain = [f"c{i}" for i in range(200)]
    for k in range(12):
        texts.append(chain[k * 15 :] + [f"d{i}" for i in range(k * 15)])
    texts += [["short"], ["short"], ["two", "words"], ["a"] * 300, ["a"] * 330]
    order = list(range(len(texts)))
    rng.shuffle(order)
    for i, k in enumerate(order):
        rows.append((i, " ".join(texts[k])))
    return rows


def test_classes_equal_those_of_all_pairs(spark, corpus):
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in corpus], "doc_id long, text string, key string, n int")
    got = N.groups(docs).collect()
    want = classes_of(corpus)
    assert {r["doc_id"]: r["class_id"] for r in got} == want
    sizes = Counter(want.values())
    assert all(r["class_size"] == sizes[r["class_id"]] for r in got)


def test_one_row_of_each_class_stays(spark, corpus):
    rows = [*corpus, corpus[0], corpus[0], (1000, None), (1001, ""), (1002, "  "), (None, "only here and nowhere else at all"), (None, corpus[3][1])]
    docs = spark.createDataFrame([(i, t, f"s{i}") for i, t in rows], "doc_id long, text string, source string")
    kept = [(r["doc_id"], r["source"]) for r in N.deduplicate(docs).collect()]
    want = set(classes_of(corpus).values()) | {1000, None}
    assert len(kept) == len(set(kept)) and {i for i, _ in kept} == want
    assert all(s == f"s{i}" for i, s in kept)


def test_a_third_of_all_rows_in_one_group(spark):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(edited(rng, base, i % 3))) for i in range(200)]
    rows += [(200 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(60))) for i in range(400)]
    got = {r["doc_id"]: r["class_id"] for r in N.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == 0 for i in range(200)) and all(got[i] == i for i in range(200, 600))


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert N.groups(none).collect() == [] and N.deduplicate(none).collect() == []
