"""Feature values on small frames, and planted ground truth for the model-based operators."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from mlspark.functions import columns as C
from mlspark.operators import anomaly, causal, drift, models, recommend, text, timeseries, tuning
from mlspark.session import scratch_path, written

EDUCATION = ["High School", "Bachelor", "Master", "PhD"]


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(25.0, "Tokyo", "Bachelor", 500), (30.0, "Osaka", "Master", 600), (None, "Nagoya", None, 750), (45.0, None, "PhD", 1000)],
        "age double, city string, education string, income int",
    )


def test_column_pipeline_shape_and_scale(people):
    prep = models.ColumnPipeline(numeric=["age", "income"], nominal=["city"], ordinal={"education": EDUCATION})
    out = np.array([list(r[0]) for r in prep.fit(people).transform(people).select(vector_to_array("features")).collect()])
    assert out.shape == (4, 6) and not np.isnan(out).any()
    assert np.allclose(out[:, :2].mean(0), 0) and np.allclose(out[:, :2].std(0), 1)


def test_unseen_categories_and_saved_pipeline(spark, people):
    prep = models.ColumnPipeline(numeric=["age"], nominal=["city"], ordinal={"education": EDUCATION})
    path = scratch_path(spark, "prep")
    prep.fit(people).write().overwrite().save(path)
    from mlspark.sources.files import load_model

    new = spark.createDataFrame([(30.0, "Kobe", "None")], "age double, city string, education string")
    row = list(load_model(path).transform(new).select(vector_to_array("features")).first()[0])
    assert row[1:4] == [0, 0, 0] and row[4] == -1


def test_bins_and_numbers(spark):
    df = spark.createDataFrame([(0, "1.5"), (12, " "), (71, "NaN"), (72, "x")], "m int, t string")
    out = df.select(C.cut("m", [0, 12, 36, 60, 72], list("abcd")), C.to_numeric("t")).collect()
    assert [r[0] for r in out] == ["a", "b", "d", None] and [r[1] for r in out] == [1.5, None, None, None]


def test_planted_treatment_effect(spark):
    rng = np.random.default_rng(0)
    n = 1000
    age, visits = rng.integers(20, 61, n), rng.integers(1, 31, n)
    p = 1 / (1 + np.exp(-(0.1 * (visits - 15))))
    t = (rng.random(n) < p).astype(int)
    y = 50 + 3 * visits + 20 * t + rng.normal(0, 2, n)
    df = spark.createDataFrame(pd.DataFrame({"id": range(n), "age": age, "visits": visits, "t": t, "y": y}))
    naive = causal.naive_effect(df, "t", "y").first()["effect"]
    scored = written(causal.propensity_scores(df, ["age", "visits"], "t"))
    matched = causal.psm_effect(scored, "id", "t", "propensity_score", "y").first()["effect"]
    assert naive > 28 and abs(matched - 20) < 4


def test_planted_drift(spark):
    rng = np.random.default_rng(4)
    ref = pd.DataFrame({"tenure": rng.integers(1, 73, 1000).astype(float), "contract": rng.choice(["a", "b", "c"], 1000)})
    cur = pd.DataFrame({"tenure": rng.integers(1, 12, 1000).astype(float), "contract": ["a"] * 1000})
    a, b = spark.createDataFrame(ref), spark.createDataFrame(cur)
    rows = {r["column"]: r["drifted"] for r in drift.drift_report(a, b, ["tenure"], ["contract"]).collect()}
    assert rows == {"tenure": True, "contract": True, "(dataset)": True}
    half = F.monotonically_increasing_id() % 2
    same = {r["column"]: r["drifted"] for r in drift.drift_report(a.filter(half == 0), a.filter(half == 1), ["tenure"], ["contract"]).collect()}
    assert not any(same.values())


def test_gamma_upper():
    assert drift.gamma_upper(1, 2) == pytest.approx(math.exp(-2))
    assert drift.gamma_upper(2, 3) == pytest.approx(math.exp(-3) * 4)
    assert drift.gamma_upper(0.5, 0.02) == pytest.approx(math.erfc(math.sqrt(0.02)))


@pytest.fixture(scope="module")
def outliers(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(0, 1, (970, 2)), rng.normal(9, 0.5, (30, 2)) * rng.choice([-1, 1], (30, 2))])
    return spark.createDataFrame(pd.DataFrame({"id": range(1000), "a": x[:, 0], "b": x[:, 1], "bad": [0] * 970 + [1] * 30}))


def test_isolation_forest_finds_planted_rows(outliers):
    out = anomaly.isolation_forest(outliers, "id", ["a", "b"], 0.03)
    found = out.filter("anomaly = 1").agg(F.count("*"), F.sum("bad")).first()
    assert found[0] <= 30 and found[1] >= 25


def test_boundary_and_lof_find_planted_rows(outliers):
    edge = anomaly.one_class_boundary(outliers, F.col("bad") == 0, ["a", "b"], 0.02)
    assert edge.filter("bad = 1 AND anomaly = 1").count() == 30
    v = outliers.withColumn("v", F.array("a", "b"))
    near = anomaly.lof(v.filter("bad = 0"), v.filter("bad = 1"), 10, "id", "v", 0.02)
    assert near.filter("anomaly = 1").count() >= 25


def test_rebuild_error_of_planted_points(spark):
    rng = np.random.default_rng(6)
    t = np.linspace(0, 100, 1000)
    bad = np.zeros(1000, dtype=int)
    bad[rng.choice(1000, 50, replace=False)] = 1
    y = np.sin(t) + rng.normal(0, 0.1, 1000) + bad * rng.choice([-4, 4], 1000)
    df = spark.createDataFrame(pd.DataFrame({"s": 0, "t": range(1000), "v": y, "bad": bad}))
    errors = written(anomaly.reconstruction_error(df, ["s"], "t", "v", F.col("bad") == 0, 3, 1))
    hits = anomaly.detect_from_errors(errors, ["s"], "t", "error", 90, 3).toPandas()
    near = [bad[max(0, i - 2):i + 3].any() for i in hits.idx]
    assert len(near) > 10 and np.mean(near) > 0.8


def seasonal(spark, amplitude):
    rng = np.random.default_rng(11)
    t = np.arange(120)
    y = np.linspace(100, 160, 120) + amplitude * np.sin(2 * np.pi * t / 12) + rng.normal(0, 2, 120)
    months = pd.date_range("2015-01-01", periods=120, freq="MS").date
    return spark.createDataFrame(pd.DataFrame({"s": "x", "m": months, "v": y}))


def test_seasonal_model_wins_on_seasonal_series(spark):
    for amplitude, factor in ((20, 0.7), (0, 1.6)):
        df = written(seasonal(spark, amplitude))
        plain = timeseries.rolling_forecast(df, "s", "m", "v")
        table, best = timeseries.compare_forecasts([plain, timeseries.seasonal_rolling_forecast(df, "s", "m", "v")], "s")
        rmse = {r["model"]: r["rmse"] for r in table.collect()}
        assert rmse["SARIMA"] < rmse["ARIMA"] * factor
        assert plain.count() == 24


def test_structural_parts(spark):
    out = timeseries.structural_decompose(seasonal(spark, 20), "s", "m", "v").orderBy("m").toPandas()
    want = 20 * np.sin(2 * np.pi * np.arange(120) / 12)
    assert np.corrcoef(out.seasonal, want)[0, 1] > 0.98
    assert out.slope.mean() == pytest.approx(60 / 119, abs=0.15)
    assert (out.level_lo <= out.level).all() and (out.level <= out.level_hi).all()


def test_unit_root(spark):
    rng = np.random.default_rng(12)
    noise = rng.normal(0, 1, 400)
    data = pd.DataFrame({"s": ["walk"] * 400 + ["noise"] * 400, "t": list(range(400)) * 2, "v": np.concatenate([noise.cumsum(), noise])})
    df = spark.createDataFrame(data)
    for test in (timeseries.unit_root_test, timeseries.augmented_unit_root_test):
        assert {r["s"]: r["stationary"] for r in test(df, "s", "t", "v").collect()} == {"walk": False, "noise": True}


def test_shapley_adds_up(spark):
    rng = np.random.default_rng(13)
    x = rng.normal(0, 1, (60, 3))
    df = spark.createDataFrame(pd.DataFrame({"id": range(60), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": x[:, 0] * 3 + x[:, 1] * x[:, 2]}))
    cols = ["a", "b", "c"]
    assemble = VectorAssembler(inputCols=cols, outputCol="features")
    model = GBTRegressor(labelCol="y", maxIter=5, seed=1).fit(assemble.transform(df))
    zero = dict.fromkeys(cols, 0.0)

    def predict(d):
        return model.transform(assemble.transform(d))

    parts = models.shapley_contributions(df, "id", cols, zero, predict).groupBy("id").agg(F.sum("contribution").alias("total"))
    base = predict(spark.createDataFrame([(0.0, 0.0, 0.0)], "a double, b double, c double")).first()["prediction"]
    both = parts.join(predict(df), "id").toPandas()
    assert np.allclose(both.total, both.prediction - base)


def test_shapley_of_repeated_keys_is_their_mean_and_rows_are_shuffled_once(spark):
    """Sums of a product by hand, for the order that the seed gives; a key that comes twice has the mean of its rows."""
    df = spark.createDataFrame([(1, 2.0, 3.0), (1, 4.0, 5.0), (2, 6.0, 7.0), (None, 1.0, 1.0)], "id int, a double, b double")
    parts = models.shapley_contributions(df, "id", ["a", "b"], {"a": 1.0, "b": 1.0}, lambda d: d.withColumn("prediction", F.col("a") * F.col("b")), orders=1)
    assert parts._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    got = {(r["id"], r["feature"]): r["contribution"] for r in parts.collect()}
    first = random.Random(42).sample(["a", "b"], 2)[0]
    by_hand = {1: [(2.0, 3.0), (4.0, 5.0)], 2: [(6.0, 7.0)], None: [(1.0, 1.0)]}
    want = {}
    for i, rows in by_hand.items():
        alone = {"a": [a - 1 for a, _ in rows], "b": [b - 1 for _, b in rows]}
        for c, other in (("a", "b"), ("b", "a")):
            rest = [a * b - 1 - x for (a, b), x in zip(rows, alone[first])]
            want[i, c] = float(np.mean(alone[c] if c == first else rest))
    assert got == want


def test_gate(spark):
    rng = np.random.default_rng(14)
    x = rng.normal(0, 1, 300)
    df = spark.createDataFrame(pd.DataFrame({"id": range(300), "x": x, "y": (x > 0).astype(int)}))
    easy = models.train_pipeline(df, "id", ["x"], "y", scratch_path(spark, "gate"), trees=10, depth=3)
    assert easy.first()["promoted"]
    noise = df.withColumn("x", F.rand(3))
    hard = models.train_pipeline(noise, "id", ["x"], "y", scratch_path(spark, "gate"), trees=10, depth=3)
    assert not hard.first()["promoted"]
    with pytest.raises(ValueError):
        models.train_pipeline(df, "id", ["missing"], "y", scratch_path(spark, "gate"))


def test_low_recall_is_penalised():
    assert tuning.trial_score(0.05, 0.4) == pytest.approx(-0.95) and tuning.trial_score(0.5, 0.4) == 0.4


def test_naive_svd_matches_numpy(spark):
    rng = np.random.default_rng(15)
    full = rng.integers(1, 6, (25, 18)).astype(float)
    mask = rng.random((25, 18)) < 0.5
    rows = pd.DataFrame([(u, i, full[u, i], bool(mask[u, i])) for u in range(25) for i in range(18)], columns=["user_id", "item_id", "rating", "known"])
    df = spark.createDataFrame(rows)
    got = recommend.naive_svd(df.filter("known").drop("known"), df.filter("NOT known").drop("known"), k=3, iterations=12).toPandas()
    filled = np.where(mask, full, full[mask].mean())
    u, s, v = np.linalg.svd(filled, full_matrices=False)
    want = (u[:, :3] * s[:3]) @ v[:3]
    assert np.abs(got.prediction - [want[a, b] for a, b in zip(got.user_id, got.item_id)]).max() < 0.1
    # without a number of iterations it ends by itself, near enough; one direction is settled at once
    for k, size in ((3, 0.2), (1, 0.05)):
        got = recommend.naive_svd(df.filter("known").drop("known"), df.filter("NOT known").drop("known"), k=k, settled=1e-3).toPandas()
        want = (u[:, :k] * s[:k]) @ v[:k]
        off = got.prediction - [want[a, b] for a, b in zip(got.user_id, got.item_id)]
        assert np.sqrt((off**2).mean()) < size


def test_sentence_packing_and_summary(spark):
    words = " ".join(["w"] * 99)
    df = spark.createDataFrame([(1, ". ".join([words] * 5) + ". "), (2, " ".join(["x"] * 400) + ". short one.")], "id long, t string")
    packed = text.pack_sentences(df, "id", "t", mark=".").orderBy("id", "chunk_no").toPandas()
    assert list(packed.n_tokens) == [297, 198, 400, 2]
    made = text.extractive_summary(df, "id", "t", mark=".").toPandas()
    assert set(made.route) == {"long"} and (made.n_tokens > 0).all()


def test_argmax_first_on_ties(spark):
    df = spark.createDataFrame([([0.2, 0.9, 0.9],)], "s array<double>")
    assert df.select(C.argmax_label("s", ["a", "b", "c"])).first()[0] == "b"


def test_a_column_of_5000_categories_is_encoded(spark):
    from mlspark.operators import clean, features

    rows = [(i, f"v{i % 5000:04d}") for i in range(6000)] + [(6000, None)]
    df = spark.createDataFrame(rows, "id long, c string")
    for first in (0, 1):
        out = {r["id"]: r["c_onehot"] for r in clean.one_hot(df, ["c"], drop_first=bool(first), sparse=True).collect()}
        assert len(out) == 6001 and all(v.size == 5000 - first for v in out.values())
        assert all(list(out[i].indices) == [i % 5000 - first] for i in range(6000) if i % 5000 >= first)
        assert out[6000].numNonzeros() == 0 and (not first or out[0].numNonzeros() == 0)
    seen = df.filter("id >= 1000 AND id < 5000")
    known = {r["id"]: r["x"] for r in features.one_hot_known(df, "c", seen, "x", sparse=True).collect()}
    assert known[999].numNonzeros() == known[6000].numNonzeros() == 0 and list(known[1000].indices) == [0] and known[0].size == 4000
    model = models.ColumnPipeline(nominal=["c"], sparse=True).fit(seen)
    wide = {r["id"]: r["features"] for r in model.transform(df).collect()}
    assert wide[4321].size == 4000 and list(wide[4321].indices) == [3321] and wide[999].numNonzeros() == 0
    assert list(wide[6000].indices) == [0]


def test_the_form_of_an_encoding_is_a_parameter(spark):
    """1,001 categories in either form; two categories have the same types."""
    from mlspark.operators import clean, features

    for n in (2, 1001):
        df = spark.createDataFrame([(i, f"v{i:04d}") for i in range(n)], "id long, c string")
        dense, wide = clean.one_hot(df, ["c"]), clean.one_hot(df, ["c"], sparse=True)
        assert len(dense.columns) == n + 1 and wide.columns == ["id", "c_onehot"]
        assert {r["id"]: list(r["c_onehot"].indices) for r in wide.collect()} == {i: [i] for i in range(n)}
        last = dense.filter(F.col("id") == n - 1).first()
        assert last[f"c_v{n - 1:04d}"] == 1 and sum(last[1:]) == 1
        for sparse, kind in ((False, "array<double>"), (True, "vector")):
            assert dict(features.one_hot_known(df, "c", df, "x", sparse).dtypes)["x"] == kind
            out = models.ColumnPipeline(nominal=["c"], sparse=sparse).fit(df).transform(df).collect()
            assert all(r["features"].size == n and r["features"].toArray().argmax() == r["id"] for r in out)


def test_naive_svd_sums_vectors_in_spark_columns(spark):
    rows = [(u, i, 1 + (u * i) % 5) for u in range(30) for i in range(20) if (u + i) % 3]
    ratings = spark.createDataFrame(rows, "user_id long, item_id long, rating int")
    rest = ratings.select("user_id", "item_id", F.col("rating").cast("double").alias("r"))
    vectors = spark.createDataFrame([(i, float(i), 1.0) for i in range(20)], "item_id long, v0 double, v1 double")
    found = recommend._project(rest, 0.5, vectors, "item_id", "user_id", 2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "transform(" not in plan and "Python" not in plan
    got = {r["user_id"]: (r["v0"], r["v1"]) for r in found.collect()}
    for u in range(30):
        own = [(i, r) for v, i, r in rows if v == u]
        assert got[u] == pytest.approx((sum(i * r for i, r in own) + 0.5 * 190, sum(r for _, r in own) + 10.0))
