"""Nearest neighbours: exact at factor one, recall below it, copies and odd vectors."""

import numpy as np
import pytest

from mlspark.llm import neighbours as V


def brute(rows, every, k):
    rows = {i: np.array(v, float) for i, v in rows}
    ids = np.array(sorted(rows))
    out = {}
    for q in ids[ids % every == 0]:
        scores = [(-float(V.cosine(rows[q][None], rows[i][None])[0]), int(i)) for i in ids if i != q]
        out[int(q)] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else list(map(float, v)) if None not in v else list(v), 3) for i, v in rows], "vec_id long, embedding array<double>, score int")


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def vectors(n, seed=0, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    return [(i, centres[rng.integers(12)] + 0.4 * rng.normal(size=dim)) for i in range(n)]


def same(got, want):
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-15)


def test_factor_one_is_exact(spark):
    rows = vectors(700)
    same(found(V.nearest(table(spark, rows), 10, 5, shard=150)), brute(rows, 10, 5))


def test_copies_ties_and_odd_rows(spark):
    rows = vectors(120, 1)
    copy = rows[7][1]
    rows += [(200 + i, copy) for i in range(150)]
    odd = [(500, None), (510, [0.0] * 16), (520, [float("nan")] * 16), (530, [None] * 16), (540, [1.0, 2.0]), (550, []), (560, [float("inf")] * 16), (None, copy)]
    got = found(V.nearest(table(spark, rows + odd + [rows[0], rows[0]]), 10, 5, shard=60))
    same(got, brute(rows, 10, 5))
    assert [i for i, _ in got[200]] == [7, 201, 202, 203, 204]


def test_scaled_copies_tie_and_the_smaller_ids_win(spark):
    rng = np.random.default_rng(8)
    for trial in range(3):
        one = rng.normal(size=16)
        rows = [(i, list(one * 2.0 ** int(s))) for i, s in enumerate(rng.permutation(30))]
        rows += [(100 + i, list(v)) for i, v in enumerate(rng.normal(size=(40, 16)))]
        got = found(V.nearest(table(spark, rows), 10, 5))
        assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[20]] == [0, 1, 2, 3, 4]


def test_fewer_candidates_than_asked_for(spark):
    rows = vectors(3, 2)
    assert {q: len(x) for q, x in found(V.nearest(table(spark, rows), 1, 5)).items()} == {0: 2, 1: 2, 2: 2}
    assert found(V.nearest(table(spark, rows[:1]), 1, 5)) == {}
    assert V.nearest(table(spark, rows).limit(0)).collect() == []


def test_relaxed_factor_prunes_and_keeps_most():
    rng = np.random.default_rng(3)
    base = V.unit(np.repeat(rng.normal(size=(40, 8)), 50, axis=0) + 0.1 * rng.normal(size=(2000, 8)))
    queries = base[::20]
    tree, seen = V.Tree(base), []
    plain = V.distances
    results = {}
    for factor in (1.0, 0.5):
        calls = []
        V.distances = lambda a, b: calls.append(len(a) * len(b)) or plain(a, b)  # noqa: B023
        try:
            results[factor] = tree.search(queries, 5, factor)[1]
        finally:
            V.distances = plain
        seen.append(sum(calls))
    exact = np.argsort(plain(queries, base), axis=1, kind="stable")[:, :5]
    assert all(set(a) == set(b) for a, b in zip(results[1.0], exact))
    recall = np.mean([len(set(a) & set(b)) / 5 for a, b in zip(results[0.5], exact)])
    assert recall >= 0.9 and seen[1] < seen[0] < len(queries) * len(base)


def test_extreme_lengths():
    x = np.array([[1e200, 2e200], [1e-200, 2e-200], [3.0, 4.0]])
    assert V.cosine(x, x) == pytest.approx([1, 1, 1])


def test_copies_of_a_side_are_not_broadcast(spark):
    """Neither side's copies, one for each part of the other, pass through the driver, and parts stop growing in number."""
    rows = vectors(300, 3)
    got = V.nearest(table(spark, rows), 10, 5, shard=40)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan
    same(found(got), brute(rows, 10, 5))
    assert V.side_rows(4096, 50_000, V.VALUES, 64) == 4096
    assert -(-600_000 // V.side_rows(4096, 600_000, V.VALUES, 64)) <= V.PARTS
    assert V.side_rows(4096, 10**9, V.VALUES, 64) * 64 <= V.VALUES
