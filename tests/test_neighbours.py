"""Exact neighbour search against brute force, with many pivots, small chunks and popular dimensions."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from mlspark.operators import joins, recommend, sampling
from mlspark.plans import neighbours


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    # a third of all rows are copies of one point
    data = np.concatenate([rng.normal(0, 1, (200, 4)), np.tile(rng.normal(0, 1, 4), (100, 1))]).round(2)
    return data, spark.createDataFrame(pd.DataFrame({"vec_id": range(300), "embedding": list(map(list, data))}))


def brute(data, k):
    d = np.sqrt(((data[:, None] - data[None]) ** 2).sum(-1)).round(6)
    np.fill_diagonal(d, np.inf)
    return {i: list(np.lexsort((np.arange(len(data)), d[i]))[:k]) for i in range(len(data))}, d


@pytest.mark.parametrize("pivots,chunk", [(1, 4096), (12, 40), (5, 17)])
def test_topk(vectors, pivots, chunk):
    data, df = vectors
    got = neighbours.vector_topk(df, df, 6, exclude_self=True, pivots=pivots, chunk=chunk).orderBy("query_id", "rank").toPandas()
    want, _ = brute(data, 6)
    assert {q: list(part.base_id) for q, part in got.groupby("query_id")} == want


def test_within(vectors):
    data, df = vectors
    got = neighbours.vector_within(df, df, 0.8, exclude_self=True, pivots=9, chunk=50).toPandas()
    _, d = brute(data, 1)
    assert set(zip(got.query_id, got.base_id)) == set(zip(*np.nonzero(d <= 0.8)))


def test_cosine_of_zero_vector_is_zero(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = neighbours.vector_topk(df, df, 2, metric="cosine", exclude_self=True).toPandas()
    sims = {(r.query_id, r.base_id): r.similarity for r in got.itertuples()}
    assert sims[(1, 2)] == pytest.approx(0) and sims[(2, 3)] == pytest.approx(2 ** -0.5)


@pytest.mark.parametrize("chunk", [4096, 13, 3])
def test_sparse_topk(spark, chunk):
    rng = np.random.default_rng(2)
    dense = (rng.random((60, 25)) < 0.15) * rng.integers(1, 6, (60, 25))
    dense[:, 0] = rng.integers(1, 6, 60)  # every row holds dimension 0
    dense[40:50] = dense[40]
    entries = pd.DataFrame([(i, j, int(v)) for (i, j), v in np.ndenumerate(dense) if v], columns=["u", "i", "r"])
    rows = neighbours.unit_rows(spark.createDataFrame(entries), "u", "i", "r")
    got = neighbours.sparse_topk(rows, 7, chunk).orderBy("a", "rank").toPandas()
    unit = dense / np.linalg.norm(dense, axis=1, keepdims=True)
    sims = unit @ unit.T
    np.fill_diagonal(sims, -1)
    for i in range(60):
        want = np.lexsort((np.arange(60), -sims[i].round(6)))[:7]
        assert list(got[got.a == i].b) == list(want)
        assert np.allclose(got[got.a == i].sim, sims[i][want])


def test_popular_dimensions_make_no_rows(spark):
    """Every row holds every dimension: what is shuffled is bounded by classes x blocks x (k + 1)."""
    rng = np.random.default_rng(3)
    dense = rng.integers(1, 9, (90, 6))
    dense[30:60] = dense[30]  # a third of all rows are copies
    entries = pd.DataFrame([(f"r{i:02d}", f"d{j}", int(v)) for (i, j), v in np.ndenumerate(dense)], columns=["u", "i", "r"])
    rows = neighbours.unit_rows(spark.createDataFrame(entries), "u", "i", "r")
    got = neighbours.sparse_topk(rows, 3, 16).toPandas()
    unit = dense / np.linalg.norm(dense, axis=1, keepdims=True)
    sims = unit @ unit.T
    np.fill_diagonal(sims, -1)
    for i in range(90):
        want = np.lexsort((np.arange(90), -sims[i].round(6)))[:3]
        assert list(got[got.a == f"r{i:02d}"].sort_values("rank").b) == [f"r{j:02d}" for j in want]
    packed = [[{"label": str(i), "ids": [i], "vec": [{"dim": j, "weight": 0.5} for j in range(4)]} for i in range(s, s + 20)] for s in (0, 20)]
    kind = pa.struct([("label", pa.string()), ("ids", pa.list_(pa.int64())), ("vec", pa.list_(pa.struct([("dim", pa.int64()), ("weight", pa.float64())])))])
    out = list(neighbours.block_lists(*[pa.array(p, kind) for p in packed], 3, False))
    assert sum(b.num_rows for b in out) == 2 * 20 * 4


def test_smote_balances_between_neighbours(spark):
    rng = np.random.default_rng(9)
    data = pd.DataFrame({"id": range(200), "y": [1] * 12 + [0] * 188, "x": list(map(list, rng.normal(0, 1, (200, 3))))})
    df = spark.createDataFrame(data)
    made = sampling.smote(df, "y", 1, "id", "x", 5).toPandas()
    assert len(made) == 188 - 12
    for r in made.itertuples():
        a, b = np.array(data.x[r.id]), np.array(data.x[r.neighbour])
        t = np.linalg.norm(np.array(r.x) - a) / np.linalg.norm(b - a)
        assert 0 <= t < 1 and np.allclose(a + (b - a) * t, r.x)


def test_base_rows_go_only_to_blocks_that_visit_their_cell(spark):
    rng = np.random.default_rng(1)
    centres = np.array([[0.0, 0], [100, 0], [0, 100], [100, 100]])
    base = pd.DataFrame({"vec_id": range(400), "embedding": [list(centres[i % 4] + rng.normal(0, 0.1, 2)) for i in range(400)]})
    queries = base[base.vec_id % 4 == 0]
    left, right = neighbours._sides(spark.createDataFrame(queries), spark.createDataFrame(base), "vec_id", "vec_id", "embedding", "l2")
    cells, _ = neighbours.fit_cells(right, 40, 10)
    visits = left.select(F.explode(neighbours.cells_to_visit(cells, 3, None)("query_vec")).alias("cell")).distinct().collect()
    near = sum(int(cells.count[r["cell"]]) for r in visits)
    assert 100 <= near <= 130  # the three other clusters are never copied


@pytest.mark.parametrize("postings,posting", [(1 << 21, 1 << 16), (40, 5)])
def test_rare_dimensions_are_met_by_dimension(spark, monkeypatch, postings, posting):
    """Rows that share few dimensions: no pairs of blocks, the same lists as by brute force, copies and cuts included."""
    rng = np.random.default_rng(2)
    dense = (rng.random((200, 300)) < 0.01) * rng.integers(1, 6, (200, 300))
    dense[:, 0] = (np.arange(200) % 40 == 0) * 3
    dense[40:60] = dense[40]
    entries = pd.DataFrame([(i, j, int(v)) for (i, j), v in np.ndenumerate(dense) if v], columns=["u", "i", "r"])
    rows = neighbours.unit_rows(spark.createDataFrame(entries), "u", "i", "r")
    monkeypatch.setattr(neighbours, "POSTINGS", postings)
    monkeypatch.setattr(neighbours, "POSTING", posting)
    monkeypatch.setattr(neighbours, "_by_blocks", None)
    got = neighbours.sparse_topk(rows, 7, 10).orderBy("a", "rank").toPandas()
    unit = dense / np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-9)
    sims = unit @ unit.T
    np.fill_diagonal(sims, -1)
    for i in range(200):
        order = np.lexsort((np.arange(200), -sims[i].round(6)))[:7]
        want = [j for j in order if sims[i][j] > 0]
        assert list(got[got.a == i].b) == want
        assert np.allclose(got[got.a == i].sim, sims[i][want])


def test_pairs_of_users_and_items_are_not_shuffled(spark):
    """Neighbours' items are opened after the last shuffle: it moves one row per pair of users."""
    train = spark.createDataFrame([(u, i, 1 + (u + i) % 5) for u in range(8) for i in range(u, u + 6)], "user_id long, item_id long, rating int")
    near = spark.createDataFrame([(a, b, 1.0 / (1 + abs(a - b))) for a in range(8) for b in range(8) if a != b], "a long, b long, sim double")
    pairs = joins.candidate_pairs(near, train)
    scores = recommend.cf_scores(near, train)
    for df in (pairs.select("user_id", "item_id").distinct(), scores):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        executed = df._jdf.queryExecution().executedPlan().toString()
        assert executed.index("Generate") < executed.index("Exchange") and "Generate" in plan
    mine = {u: set(range(u, u + 6)) for u in range(8)}
    reach = {(u, i, 1 / (1 + abs(u - b)), 1 + (b + i) % 5) for u in range(8) for b in range(8) if b != u for i in mine[b] - mine[u]}
    assert {tuple(r) for r in pairs.select("user_id", "item_id", "sim", "rating").collect()} == reach
    for r in scores.collect():
        part = [(s, v) for u, i, s, v in reach if (u, i) == (r.user_id, r.item_id)]
        every = [(1 / (1 + abs(r.user_id - b)), 1 + (b + r.item_id) % 5) for b in range(8) if b != r.user_id and r.item_id in mine[b]]
        assert set(part) == set(every)
        assert r.score == pytest.approx(sum(s * v for s, v in every) / sum(s for s, _ in every))
    assert scores.count() == len({(u, i) for u, i, _, _ in reach})


def test_copies_of_a_query_do_not_grow_with_the_cells(spark, vectors):
    """Many small cells: they are visited in groups, each side has about as many parts as ``PARTS``, and results stay exact."""
    data, df = vectors
    cells = neighbours.Cells(np.zeros((400, 2)), np.zeros(400), np.full(400, 10))
    bins, first, last = cells.groups(10)
    assert len(bins) == 400 and bins.max() < 2 * neighbours.PARTS and (first <= last).all() and (np.diff(bins) >= 0).all()
    assert np.bincount(bins).max() * 10 <= neighbours.wide(4000, 10) <= 10 * neighbours.WIDEST
    got = neighbours.vector_topk(df, df, 6, exclude_self=True, pivots=60, chunk=2).orderBy("query_id", "rank").toPandas()
    want, d = brute(data, 6)
    assert {q: list(part.base_id) for q, part in got.groupby("query_id")} == want
    near = neighbours.vector_within(df, df, 0.8, exclude_self=True, pivots=60, chunk=2).toPandas()
    assert set(zip(near.query_id, near.base_id)) == set(zip(*np.nonzero(d <= 0.8)))
