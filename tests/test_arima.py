"""Seasonal ARMA likelihood: against the joint normal density, and estimates on simulated series."""

import numpy as np
import pandas as pd
import pytest

from mlspark.operators import timeseries as S
from mlspark.plans import arima as A


def autocovariances(ar, ma, n):
    """From a long moving-average expansion."""
    psi = np.zeros(4000)
    for j in range(len(psi)):
        psi[j] = (1.0 if j == 0 else ma[j - 1] if j <= len(ma) else 0.0) + sum(ar[i] * psi[j - i - 1] for i in range(min(len(ar), j)))
    return np.array([psi[: len(psi) - k] @ psi[k:] for k in range(n)])


@pytest.mark.parametrize(
    "order,seasonal", [((1, 0, 1), (0, 0, 0, 1)), ((2, 0, 0), (0, 0, 0, 1)), ((0, 0, 2), (0, 0, 0, 1)), ((1, 0, 1), (1, 0, 1, 4)), ((0, 0, 0), (0, 0, 0, 1))]
)
def test_likelihood_is_the_normal_density(order, seasonal):
    rng = np.random.default_rng(1)
    shape = A.Shape(order, seasonal)
    ar, ma = shape.polynomials(rng.normal(0, 0.5, shape.parameters))
    w = rng.normal(0, 1, 40)
    g = autocovariances(ar, ma, 40)
    cov = g[np.abs(np.arange(40)[:, None] - np.arange(40))]
    variance = w @ np.linalg.solve(cov, w) / 40
    want = -0.5 * (40 * np.log(2 * np.pi * variance) + np.linalg.slogdet(cov)[1] + 40)
    assert A.log_likelihood(w, ar, ma) == pytest.approx(want, abs=1e-6)


def simulate(rng, ar, ma, n):
    e = rng.normal(0, 1, n + 300)
    w = np.zeros(n + 300)
    for t in range(len(w)):
        w[t] = e[t] + sum(c * w[t - i - 1] for i, c in enumerate(ar) if t > i) + sum(c * e[t - i - 1] for i, c in enumerate(ma) if t > i)
    return w[300:]


def test_coefficients_lie_within_their_standard_errors():
    n, phi, theta = 600, 0.7, 0.4
    # asymptotic variances of an ARMA(1,1)
    common = (1 + phi * theta) ** 2 / (n * (phi + theta) ** 2)
    errors = np.sqrt([common * (1 - phi**2), common * (1 - theta**2)])
    far = 0
    for seed in range(6):
        y = simulate(np.random.default_rng(seed), [phi], [theta], n)
        shape = A.Shape((1, 0, 1), (0, 0, 0, 1))
        x, _, _, _ = A.fit(y + 5, shape)
        ar, ma = shape.polynomials(x)
        far += int((np.abs([ar[0] - phi, ma[0] - theta] / errors) > 2.6).any())
    assert far <= 1


def test_fit_is_at_least_as_good_as_a_grid():
    y = simulate(np.random.default_rng(9), [0.5], [-0.3], 150)
    shape = A.Shape((1, 0, 1), (0, 0, 0, 1))
    _, best, n, _ = A.fit(y, shape)
    grid = [A.log_likelihood(y - y.mean(), np.array([a]), np.array([b])) for a in np.linspace(-0.9, 0.9, 13) for b in np.linspace(-0.9, 0.9, 13)]
    assert n == 150 and best >= max(grid) - 1e-6


def test_difference_and_forecast_of_a_line():
    shape = A.Shape((0, 1, 0), (0, 1, 0, 4))
    assert shape.difference().tolist() == [1, -1, 0, 0, -1, 1]
    y = np.arange(30.0) + np.tile([0, 3, 1, 7], 8)[:30]
    assert A.fit(y, shape)[3] == pytest.approx(30 + 1)


def test_rows_equal_single_fits(spark):
    y = simulate(np.random.default_rng(3), [0.6], [], 60).cumsum()
    df = spark.createDataFrame(pd.DataFrame({"s": None, "t": range(60), "v": y}), "s string, t long, v double")
    out = S.rolling_forecast(df, "s", "t", "v").orderBy("t").toPandas()
    shape = A.Shape((1, 1, 1), S.NO_SEASON)
    assert list(out.t) == list(range(48, 60))
    for r in out.itertuples():
        _, best, n, forecast = A.fit(y[: r.t], shape)
        assert r.forecast == pytest.approx(forecast, abs=0.05) and r.aic == pytest.approx(6 - 2 * best, abs=0.05)
        assert r.bic - r.aic == pytest.approx(3 * np.log(n) - 6)


def test_flat_series(spark):
    df = spark.createDataFrame(pd.DataFrame({"s": "a", "t": range(40), "v": 7.0}))
    assert S.rolling_forecast(df, "s", "t", "v").toPandas().forecast.tolist() == [7.0] * 8
