"""Structural model: likelihood against the joint normal density, slopes, estimates on simulated series."""

import numpy as np
import pandas as pd
import pytest

from mlspark.operators import timeseries as S
from mlspark.plans.structural import Structure


def simulate(rng, model, variances, n):
    state = rng.normal(0, 1, model.size)
    y = np.empty(n)
    for i in range(n):
        y[i] = model.seen @ state + rng.normal(0, np.sqrt(variances[3]))
        state = model.step @ state
        state[:3] += rng.normal(0, 1, 3) * np.sqrt(variances[:3])
    return y


def restricted(model, y, variances):
    """Density of the later values given the first ones under a flat start, from the whole covariance matrix."""
    n, m = len(y), model.size
    powers = [np.linalg.matrix_power(model.step, i) for i in range(n)]
    x = np.array([model.seen @ p for p in powers])
    cov = np.eye(n) * variances[3]
    for k in range(3):
        felt = np.array([[model.seen @ powers[i - 1 - j][:, k] if i > j else 0.0 for j in range(n)] for i in range(n)])
        cov += variances[k] * felt @ felt.T
    inverse = np.linalg.inv(cov)
    inner = x.T @ inverse @ x
    beta = np.linalg.solve(inner, x.T @ inverse @ y)
    rest = y - x @ beta
    dets = np.linalg.slogdet(cov)[1] + np.linalg.slogdet(inner)[1]
    return -0.5 * ((n - m) * np.log(2 * np.pi) + dets + rest @ inverse @ rest) + np.linalg.slogdet(x[:m])[1]


@pytest.mark.parametrize("period", [2, 4, 12])
def test_likelihood_and_slope(period):
    model = Structure(period)
    variances = np.array([0.3, 0.02, 0.1, 0.7])
    y = simulate(np.random.default_rng(period), model, variances, 40)
    value, slope = model.likelihood(y, variances)
    assert value == pytest.approx(restricted(model, y, variances), abs=1e-6)
    for k, e in enumerate(np.eye(4)):
        h = 1e-5 * variances[k]
        numeric = (model.likelihood(y, variances + h * e)[0] - model.likelihood(y, variances - h * e)[0]) / (2 * h)
        assert slope[k] == pytest.approx(numeric, rel=1e-4, abs=1e-4)


@pytest.mark.parametrize("variances", [[0.3, 0.02, 0.1, 0.7], [1e-9, 1e-10, 0.1, 0.7], [0.2, 1e-10, 1e-9, 1e-9]])
def test_parts_are_the_conditional_means(variances):
    model, variances = Structure(4), np.array(variances)
    n, m = 30, 5
    y = simulate(np.random.default_rng(1), model, np.array([0.3, 0.02, 0.1, 0.7]), n)
    # unknowns: the first state and all noises; the noises have a prior, the first state has none
    powers = [np.linalg.matrix_power(model.step, i) for i in range(n)]
    states = [np.column_stack([p, *[np.column_stack([powers[i - 1 - j][:, k] if i > j else np.zeros(m) for j in range(n)]) for k in range(3)]]) for i, p in enumerate(powers)]
    x, free = np.array([powers[i].T @ model.seen for i in range(n)]), np.array([model.seen @ s for s in states])[:, m:]
    prior = np.repeat(variances[:3], n)
    inverse = np.linalg.inv((free * prior) @ free.T + np.eye(n) * variances[3])
    cov = np.linalg.inv(x.T @ inverse @ x)
    first = cov @ x.T @ inverse @ y
    gain = prior[:, None] * (free.T @ inverse)
    mean = np.concatenate([first, gain @ (y - x @ first)])
    cross = -cov @ x.T @ gain.T
    noises = np.diag(prior) - gain @ (free * prior) + gain @ x @ cov @ x.T @ gain.T
    whole = np.block([[cov, cross], [cross.T, noises]])
    _, out, var = model.parts(y, variances)
    for i, s in enumerate(states):
        assert out[i] == pytest.approx((s @ mean)[:3], abs=1e-5)
        assert var[i] == pytest.approx(np.diag(s @ whole @ s.T)[:3], abs=1e-5)


def test_fit_is_at_least_as_good_as_the_grid_and_the_truth():
    model = Structure(4)
    truth = np.array([0.5, 1e-4, 0.05, 1.0])
    for seed in range(4):
        y = simulate(np.random.default_rng(seed), model, truth, 120)
        found, best = model.fit(y)
        scale = np.var(y)
        assert best == pytest.approx(model.likelihood(y, found)[0], abs=1e-6)
        for v in [truth, *[g * scale for g in model.grid()]]:
            assert best >= model.likelihood(y, v)[0] - 1e-3


def test_variances_are_recovered():
    model = Structure(4)
    truth = np.array([0.5, 0.01, 0.2, 1.0])
    found = np.array([model.fit(simulate(np.random.default_rng(seed), model, truth, 400))[0] for seed in range(8)])
    middle = np.median(found, axis=0)
    assert (middle > truth / 1.6).all() and (middle < truth * 1.6).all()


def test_parts_add_up_and_short_series_keep_their_rows(spark):
    months = pd.date_range("2015-01-01", periods=72, freq="MS")
    season = np.tile([3.0, -1.0, -2.0, 0.0], 18)
    rng = np.random.default_rng(5)
    y = np.arange(72) * 0.5 + season + rng.normal(0, 0.2, 72)
    rows = [("long", m.date(), float(v)) for m, v in zip(months, y)] + [("short", m.date(), 1.0) for m in months[:6]]
    rows += [("flat", m.date(), 7.0) for m in months[:30]] + [(None, m.date(), float(v)) for m, v in zip(months, y)]
    df = spark.createDataFrame(rows, "s string, ts date, v double")
    out = S.structural_decompose(df, "s", "ts", "v", 4).toPandas()
    assert len(out) == len(rows)
    long = out[out.s == "long"].sort_values("ts")
    assert np.abs(long.level + long.seasonal - y).max() < 1.0
    assert abs(long.slope.iloc[20:].mean() - 0.5) < 0.05
    assert np.abs(long.seasonal.to_numpy()[8:] - season[8:]).max() < 0.5
    assert (long.level_lo <= long.level).all() and (long.level <= long.level_hi).all()
    assert out[out.s == "short"].level.isna().all()
    flat = out[out.s == "flat"]
    assert np.abs(flat.level - 7).max() < 1e-3
    figures = S.structural_variances(df, "s", "ts", "v", 4).toPandas().set_index("s")
    assert len(figures) == 4 and figures.loc["short", "reason"] == S.TOO_SHORT and figures.loc["short", "n"] == 6
    assert figures.loc["long", "irregular_variance"] < 0.2
    assert S.structural_variances(df.limit(0), "s", "ts", "v", 4).count() == 0
