"""Reports over mixed number types, and series that are too short for a model."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mlspark.operators import models as M
from mlspark.operators import timeseries as S
from mlspark.operators import tuning as U
from mlspark.operators.metrics import classification_report


def test_integer_label_and_double_prediction_are_one_class(spark):
    rows = spark.createDataFrame([(1, 1.0), (1, 0.0), (0, 0.0), (0, 0.0), (1, 1.0)], "label int, prediction double")
    report = {r["class"]: r for r in classification_report(rows, "label", "prediction").collect()}
    assert set(report) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert report["1"]["precision"] == 1.0
    assert report["1"]["recall"] == pytest.approx(2 / 3)
    assert report["1"]["f1"] == pytest.approx(0.8)
    assert report["accuracy"]["f1"] == pytest.approx(0.8)


class Fixed:
    def fit(self, _):
        return self

    def transform(self, df):
        return df.withColumn("prediction", F.col("guess").cast("double"))


def test_tuner_figures_stay_between_0_and_1(spark):
    rows = spark.createDataFrame([(1, 1), (1, 1), (0, 1), (0, 0)], "label int, guess int")
    best, log = U.tune(rows, rows, lambda _: Fixed(), [{"a": 1}], "label")
    row = log.first()
    assert (row["precision"], row["recall"], row["f1"]) == pytest.approx((2 / 3, 1.0, 0.8))
    assert best == {"a": 1}
    assert M.gate_value(classification_report(Fixed().transform(rows), "label", "prediction"), "1") == pytest.approx(0.8)


def monthly(spark, sizes):
    rng = np.random.default_rng(0)
    frames = []
    for name, n in sizes.items():
        at = pd.date_range("2015-01-01", periods=n, freq="MS")
        season = 20 * np.sin(2 * np.pi * np.arange(n) / 12)
        frames.append(pd.DataFrame({"s": name, "t": at, "v": 100 + np.arange(n) * 0.5 + season + rng.normal(0, 1, n)}))
    return spark.createDataFrame(pd.concat(frames))


def test_no_series_is_lost_and_no_lag_left_out(spark):
    sizes = {"a": 1, "b": 10, "c": 30, "d": 60, "e": 120}
    df = monthly(spark, sizes)
    out = S.seasonal_rolling_forecast(df, "s", "t", "v").toPandas()
    assert set(out.s) == set(sizes)
    short = out[out.s.isin(["a", "b", "c"])]
    assert short.forecast.isna().all() and (short.reason == S.TOO_SHORT).all()
    fitted = out[out.s.isin(["d", "e"])]
    assert fitted.forecast.notna().all() and fitted.reason.isna().all()
    late = fitted[fitted.s == "e"]
    assert np.sqrt(((late.actual - late.forecast) ** 2).mean()) < 4

    table, best = S.compare_forecasts([S.rolling_forecast(df, "s", "t", "v"), S.seasonal_rolling_forecast(df, "s", "t", "v")], "s")
    assert table.count() == 2 * len(sizes)
    assert {r["s"]: r["best"] for r in best.collect()}["e"] == "SARIMA"

    parts = S.structural_decompose(df, "s", "t", "v").toPandas()
    assert parts.groupby("s").size().to_dict() == sizes
    assert parts[parts.s == "b"].level.isna().all() and parts[parts.s == "e"].level.notna().all()


def test_multiplied_lags():
    assert S._products(1, 1, 12) == [1, 12, 13]
    assert S._products(2, 0, 12) == [1, 2]
    assert S._products(0, 1, 12) == [12]


def test_unit_root_keeps_the_lags_asked_for(spark):
    out = {r["s"]: r for r in S.augmented_unit_root_test(monthly(spark, {"a": 8, "b": 60}), "s", "t", "v", lags=6).collect()}
    assert (out["a"]["lags"], out["a"]["statistic"], out["a"]["reason"]) == (6, None, S.TOO_SHORT)
    assert out["b"]["lags"] == 6 and out["b"]["n"] == 53 and out["b"]["reason"] is None
