"""Queries on neighbours' ratings against plain Python, on rows of their own."""

import os
import time
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from mlspark import catalog, session
from mlspark.operators import joins
from mlspark.plans import neighbours

catalog.load_all()


@pytest.fixture(scope="module")
def sales(spark, tmp_path_factory):
    """Folder with parts, orders and lineitem, one line an order, and the training ratings they make."""
    folder = str(tmp_path_factory.mktemp("sales"))
    rng = np.random.default_rng(8)
    pairs = [(u, i) for u in range(1, 41) for i in sorted(rng.choice(np.arange(1, 61), 9, replace=False).tolist())]
    rows = [(key, u, i, float(rng.integers(1, 51))) for key, (u, i) in enumerate(pairs)]
    orders = spark.createDataFrame([r[:2] for r in rows], "o_orderkey long, o_custkey long")
    lines = spark.createDataFrame([(r[0], r[2], r[3]) for r in rows], "l_orderkey long, l_partkey long, l_quantity double")
    orders.write.parquet(f"{folder}/orders.parquet")
    lines.write.parquet(f"{folder}/lineitem.parquet")
    words = ("red", "green", "small", "steel", "copper")
    parts = [(i, f"{words[i % 5]} {words[i * 7 % 4]}", words[i % 3], f"b{i % 4}") for i in range(1, 61)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_type string, p_brand string").write.parquet(f"{folder}/part.parquet")
    train = defaultdict(dict)
    for _, u, i, quantity in rows:
        if (u * 31 + i * 17) % 5:
            train[u][i] = int(np.ceil(quantity / 10))
    return folder, train


def similar(train, k):
    """The k most similar users of every user."""
    norm = {u: np.sqrt(sum(r * r for r in own.values())) for u, own in train.items()}
    out = {}
    for a, own in train.items():
        sims = [(sum(own[i] * r for i, r in train[b].items() if i in own) / norm[a] / norm[b], b) for b in train if b != a]
        out[a] = sorted(((s, b) for s, b in sims if s > 0), key=lambda x: (-round(x[0], 6), x[1]))[:k]
    return out


def scores(train, near):
    """Weighted mean rating of the neighbours, by user and item not rated."""
    out = {}
    for a, rows in near.items():
        top, low = defaultdict(float), defaultdict(float)
        for sim, b in rows:
            for i, r in train[b].items():
                if i not in train[a]:
                    top[i] += sim * r
                    low[i] += sim
        out[a] = {i: top[i] / low[i] for i in top}
    return out


def test_lists_take_all_neighbours(spark, sales):
    """A list is made of the ratings of 40 neighbours, as those of the other neighbour queries, not of one."""
    folder, train = sales
    found = catalog.QUERIES["P2_cf_topn"](spark, folder).orderBy("user_id", "rank").collect()
    every = {i for own in train.values() for i in own}
    for u, known in scores(train, similar(train, 40)).items():
        filled = {i: known.get(i, 0.0) for i in every if i not in train[u]}
        want = sorted(filled, key=lambda i: (-round(filled[i], 6), i))[:40]
        mine = [r for r in found if r.user_id == u]
        assert [r.item_id for r in mine] == want
        assert [r.score for r in mine] == pytest.approx([filled[i] for i in want], abs=1e-5)
    assert "rank <= 1)" not in catalog.SQL["P2_cf_topn"]


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle")}


def test_a_wave_leaves_no_shuffle_files(spark):
    """What a wave shuffled is gone when a later one runs; every key is in one wave."""
    rows = spark.range(2000).selectExpr("if(id % 50 = 0, null, id % 97) as k", "id")
    left, names = [], []

    def step(wave):
        names.append(shuffle_files(spark))
        return rows.filter(wave.holds("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))

    got = session.in_waves(spark, 5, step)
    for _ in range(100):
        left = shuffle_files(spark) - names[0]
        if not left:
            break
        time.sleep(0.1)
    assert len(names) == 5 and not left
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, rows.groupBy("k").count().collect()), key=str)
    assert spark.conf.get(session.FREED) == "false"


def test_similar_rows_in_waves(spark, monkeypatch):
    """Blocks that go by dimension in several waves find what all pairs find."""
    rng = np.random.default_rng(6)
    rows = [(u, int(i), int(rng.integers(1, 6))) for u in range(90) for i in rng.choice(300, 5, replace=False)]
    train = defaultdict(dict)
    for u, i, r in rows:
        train[u][i] = r
    units = neighbours.unit_rows(spark.createDataFrame(rows, "u long, i long, r int"), "u", "i", "r")
    monkeypatch.setattr(session, "WAVE", 4000)
    seen, real = [], neighbours.in_waves
    monkeypatch.setattr(neighbours, "in_waves", lambda s, waves, *rest: seen.append(waves) or real(s, waves, *rest))
    found = neighbours.sparse_topk(units, 6, 8).orderBy("a", "rank").collect()
    assert seen and seen[0] > 2
    for a, near in similar(train, 6).items():
        assert [r.b for r in found if r.a == a] == [b for _, b in near]
        assert [r.sim for r in found if r.a == a] == pytest.approx([s for s, _ in near])


@pytest.mark.parametrize("name", ["J12_candidate_pairs", "P1_cf_scores", "P2_cf_topn"])
def test_ratings_of_neighbours_in_waves(spark, sales, monkeypatch, name):
    """The lists of all pairs of users never travel at once, and no row changes."""
    folder, train = sales
    monkeypatch.setattr(session, "WAVE", 20_000)
    seen, real = [], joins.in_waves
    monkeypatch.setattr(joins, "in_waves", lambda s, waves, *rest: seen.append(waves) or real(s, waves, *rest))
    found = {tuple(r) for r in catalog.QUERIES[name](spark, folder).collect()}
    assert seen and seen[0] > 2
    known = scores(train, similar(train, 40))
    if name == "J12_candidate_pairs":
        assert found == {(u, len(own), sum(own)) for u, own in known.items()}
    elif name == "P1_cf_scores":
        assert {(r[0], r[1]) for r in found} == {(u, len(own)) for u, own in known.items()}
        for u, _, low, high, mean in found:
            own = known[u].values()
            assert (low, high, mean) == pytest.approx((min(own), max(own), sum(own) / len(own)), abs=1e-5)
    else:
        monkeypatch.undo()
        assert found == {tuple(r) for r in catalog.QUERIES[name](spark, folder).collect()}


@pytest.mark.parametrize("name", ["P3_content_scores", "P3_content_ranges", "P4_hybrid_scores", "P5_evaluate_recommenders"])
def test_both_models_in_waves(spark, sales, monkeypatch, name):
    """Neither profiles nor pairs of users and items are on disk for all users at once, and no row changes."""
    folder, _ = sales
    one = {tuple(r) for r in catalog.QUERIES[name](spark, folder).collect()}
    made, kept = [], set()

    class Spy(session.Wave):
        def __init__(self, *rest):
            super().__init__(*rest)
            made.append(self)

        def keep(self, df, name):
            kept.update(p for w in made[:-1] for p in w.kept if os.path.exists(p))
            return super().keep(df, name)

    monkeypatch.setattr(session, "Wave", Spy)
    monkeypatch.setattr(session, "WAVE", 200_000 if name[:2] in ("P4", "P5") else 10_000)
    assert {tuple(r) for r in catalog.QUERIES[name](spark, folder).collect()} == one
    assert len(one) and len([w for w in made if w.waves > 2]) > 2
    if name[:2] in ("P4", "P5"):
        assert sum(len(w.kept) for w in made) > 4 and not kept
