"""Structural model of one series: level, slope, seasonal part and irregular part, four noise variances.

The start is diffuse: nothing is assumed of the first state.  As many values as the state has entries fix it, and
the likelihood is that of all later values given those, in closed form and without a large start variance.
"""

from __future__ import annotations

from itertools import product

import numpy as np

from mlspark.plans.arima import maximise

NOISES = ("level", "slope", "seasonal", "irregular")
LOW, HIGH = -28.0, 9.0  # log variances, in units of the series' own variance
STARTS = 3  # ascents, from the best points of a small grid


class Structure:
    """Transition of level, slope and period - 1 seasonal states; level, slope and season take noise."""

    def __init__(self, period: int):
        m = self.size = period + 1
        t = self.step = np.zeros((m, m))
        t[0, 0] = t[0, 1] = t[1, 1] = 1.0
        t[2, 2:] = -1.0
        t[np.arange(3, m), np.arange(2, m - 1)] = 1.0
        z = self.seen = np.zeros(m)
        z[0] = z[2] = 1.0
        # the first m values are values @ state + felt @ noises, noises being m of each kind in turn; with them the
        # state at any time is known but for the noises
        reached, values, felt = np.eye(m), [], []
        noises = np.zeros((m, 4 * m))
        for i in range(m):
            values.append(z @ reached)
            felt.append(z @ noises)
            felt[-1][3 * m + i] = 1.0
            reached, noises = t @ reached, t @ noises
            noises[range(3), [k * m + i for k in range(3)]] += 1.0
        self.back = np.linalg.inv(np.array(values))
        self.unknown = -self.back @ np.array(felt)  # of the first state
        self.carry = reached @ self.back
        self.left = noises + reached @ self.unknown  # of the state after the first m values
        self.spreads = [g @ g.T for g in np.split(self.left, 4, axis=1)]

    def ahead(self, y: np.ndarray, variances: np.ndarray):
        """Filter over the values after the first ``size``: forecast, error's variance, gain, state, covariance."""
        t, z, m = self.step, self.seen, self.size
        q, h = np.diag([*variances[:3], *np.zeros(m - 3)]), variances[3]
        state = self.carry @ y[:m]
        cov = sum(v * g for v, g in zip(variances, self.spreads, strict=True))
        for value in y[m:]:
            forecast, size = z @ state, z @ cov @ z + h
            gain = t @ (cov @ z) / size
            yield forecast, size, gain, state, cov
            state = t @ state + gain * (value - forecast)
            cov = t @ cov @ t.T - np.outer(gain, gain) * size + q
            cov = (cov + cov.T) / 2

    def likelihood(self, y: np.ndarray, variances: np.ndarray) -> tuple[float, np.ndarray]:
        """Log likelihood of the values after the first ``size`` given those, and its slope in the variances."""
        t, z, m = self.step, self.seen, self.size
        passed = [(value - f, size, gain) for value, (f, size, gain, _, _) in zip(y[m:], self.ahead(y, variances))]
        total = -0.5 * sum(np.log(2 * np.pi * size) + error * error / size for error, size, _ in passed)
        slope, r, big, both = np.zeros(4), np.zeros(m), np.zeros((m, m)), np.outer(z, z)
        for error, size, gain in reversed(passed):
            slope[:3] += 0.5 * (r[:3] ** 2 - np.diag(big)[:3])
            slope[3] += 0.5 * ((error / size - gain @ r) ** 2 - 1 / size - gain @ big @ gain)
            left = t - np.outer(gain, z)
            r = z * (error / size) + left.T @ r
            big = both / size + left.T @ big @ left
        slope += [0.5 * (r @ g @ r - np.sum(big * g)) for g in self.spreads]
        return float(total), slope

    def grid(self) -> list[np.ndarray]:
        return [np.array(v) for v in product((1e-3, 0.1), (1e-6, 1e-3), (1e-6, 1e-2), (0.05, 0.5))]

    def fit(self, y: np.ndarray) -> tuple[np.ndarray, float]:
        """Variances of greatest likelihood and that likelihood; never below the grid's best."""
        centre, scale = float(y.mean()), float(np.std(y)) or 1.0
        u = (y - centre) / scale

        def value(x: np.ndarray) -> float:
            return self.likelihood(u, np.exp(np.clip(x, LOW, HIGH)))[0]

        def slope(x: np.ndarray) -> np.ndarray:
            variances = np.exp(np.clip(x, LOW, HIGH))
            return np.where((x > LOW) & (x < HIGH), variances * self.likelihood(u, variances)[1], 0.0)

        points = sorted((np.log(v) for v in self.grid()), key=value, reverse=True)[:STARTS]
        x, best = max((maximise(value, p, slope) for p in points), key=lambda found: found[1])
        return np.exp(np.clip(x, LOW, HIGH)) * scale**2, best - (len(y) - self.size) * np.log(scale)

    def parts(self, y: np.ndarray, variances: np.ndarray):
        """One-step fits, missing for the first ``size`` values, and mean and variance of level, slope and season
        given all values (fixed-interval smoother)."""
        centre, scale = float(y.mean()), float(np.std(y)) or 1.0
        u, v = (y - centre) / scale, variances / scale**2
        t, z, m, n = self.step, self.seen, self.size, len(y)
        passed = list(self.ahead(u, v))
        fitted = np.array([np.nan] * m + [f for f, *_ in passed])
        r, big = np.zeros(m), np.zeros((m, m))
        out, var = np.zeros((n, 3)), np.zeros((n, 3))
        for i in range(n - 1, m - 1, -1):
            forecast, size, gain, state, cov = passed[i - m]
            left = t - np.outer(gain, z)
            r = z * (u[i] - forecast) / size + left.T @ r
            big = np.outer(z, z) / size + left.T @ big @ left
            out[i] = (state + cov @ r)[:3]
            var[i] = np.diag(cov - cov @ big @ cov)[:3]
        # the later values tell of the first noises by way of the state at time m
        spread = np.repeat(v, m)
        told = spread[:, None] * self.left.T
        middle, rows, tells = self.back @ u[:m], self.unknown, told @ r
        for i in range(m):
            out[i] = (middle + rows @ tells)[:3]
            near = rows[:3]
            var[i] = (near**2) @ spread - np.sum((near @ told @ big) * (near @ told), axis=1)
            middle, rows = t @ middle, t @ rows
            rows[range(3), [k * m + i for k in range(3)]] += 1.0
        out = out * scale
        out[:, 0] += centre
        return fitted * scale + centre, out, np.maximum(var, 0.0) * scale**2
