"""Content scores against brute force: items with equal terms, classes in pieces, several blocks on both sides."""

import numpy as np
import pytest

from mlspark.operators import recommend


@pytest.mark.parametrize("user_block,item_block,piece", [(4096, 65536, 1 << 16), (5, 4, 3)])
def test_equal_items_are_scored_once(spark, monkeypatch, user_block, item_block, piece):
    monkeypatch.setattr(recommend, "CLASS", piece)
    monkeypatch.setattr(recommend, "USERS", 3)
    monkeypatch.setattr(recommend, "CLASSES", 2)
    rng = np.random.default_rng(4)
    kinds = (rng.random((9, 12)) < 0.4) * rng.random((9, 12))
    kinds[:, 0] += 0.1
    matrix = kinds[rng.integers(0, 9, 60)]
    matrix[59] = matrix[59] * 0 + np.eye(12)[11]
    weights = spark.createDataFrame([(i, f"t{j}", float(v)) for (i, j), v in np.ndenumerate(matrix) if v], "item_id long, term string, weight double")
    rated = {u: rng.choice(60, rng.integers(1, 20), replace=False) for u in range(17)}
    rows = [(u, int(i), int(rng.integers(1, 6))) for u, items in rated.items() for i in items]
    train = spark.createDataFrame(rows, "user_id long, item_id long, rating int")
    cf = spark.createDataFrame([(u, i, u + i / 100) for u in range(0, 17, 2) for i in range(0, 60, 3)], "user_id long, item_id long, score double")
    lists = recommend.content_lists(train, recommend.content_profiles(train, weights), weights, 6, cf, user_block, item_block)
    found = recommend.content_lists(train, recommend.content_profiles(train, weights), weights, 6, None, user_block, item_block)
    assert {type(f.dataType) for f in lists.schema} == {type(f.dataType) for f in found.schema}
    classes, _ = recommend.item_classes(weights)
    assert classes.count() < 60 or piece < 10
    ranges = {r.user_id: (r.n_items, r.lo, r.hi) for r in recommend.content_ranges(found).collect()}
    best = recommend.content_scores(lists, 6).orderBy("user_id", "rank").collect()
    pairs = {(r.user_id, i): (c, s) for r in lists.collect() for i, c, s in zip(r.pair_items, r.pair_cf, r.pair_scores)}
    expected_pairs = {}
    for u in range(17):
        num = sum(v * matrix[i] for w, i, v in rows if w == u)
        den = sum(matrix[i] for w, i, v in rows if w == u)
        below = matrix @ den
        real = [i for i in range(60) if below[i] > 0 and i not in rated[u]]
        score = {i: (matrix[i] @ num) / below[i] for i in real}
        assert ranges[u] == pytest.approx((len(real), min(score.values()), max(score.values())))
        want = sorted(real, key=lambda i: (-round(score[i], 6), i))[:6]
        mine = [r for r in best if r.user_id == u]
        assert [r.item_id for r in mine] == want
        assert [r.score for r in mine] == pytest.approx([score[i] for i in want])
        if u % 2 == 0:
            expected_pairs |= {(u, i): (u + i / 100, score[i]) for i in real if i % 3 == 0}
    assert pairs.keys() == expected_pairs.keys()
    assert all(pairs[p] == pytest.approx(expected_pairs[p]) for p in pairs)
