"""Likelihood of one differenced series under a seasonal ARMA model, and its maximum.

The state-space form has the first value that is to come on top.  The filter starts at the stationary
covariance and keeps its gain once the covariance stands still.  The innovation variance is concentrated out.
Every polynomial is parametrised by partial autocorrelations, so each step of the optimiser is stationary and
invertible.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np

STANDS = 1e-12  # relative change of the prediction variance from which on the gain is kept
GAIN = 1e-7  # smallest improvement of the log likelihood that is worth another step
STEPS = 60
EDGE = 0.999  # largest partial autocorrelation


def from_partial(x: np.ndarray) -> np.ndarray:
    """Coefficients of a stationary autoregression from free numbers (partial autocorrelations are their tanh)."""
    out = np.empty(0)
    for r in EDGE * np.tanh(x):
        out = np.append(out - r * out[::-1], r)
    return out


def expand(short: np.ndarray, seasonal: np.ndarray, period: int) -> np.ndarray:
    """c in 1 - c1 B - c2 B^2 ... = (1 - short)(1 - seasonal at multiples of the period)."""
    a = np.concatenate([[1.0], -short])
    b = np.zeros(len(seasonal) * period + 1)
    b[0], b[period :: period] = 1.0, -seasonal
    return -np.convolve(a, b)[1:]


@dataclass(frozen=True)
class Shape:
    """Orders of a seasonal ARIMA model."""

    order: tuple[int, int, int]
    seasonal: tuple[int, int, int, int]

    @property
    def sizes(self) -> list[int]:
        return [self.order[0], self.order[2], self.seasonal[0], self.seasonal[2]]

    @property
    def mean(self) -> bool:
        """Whether a mean is estimated: only without differences."""
        return self.order[1] + self.seasonal[1] == 0

    @property
    def parameters(self) -> int:
        return sum(self.sizes) + int(self.mean)

    def polynomials(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Autoregressive and moving-average coefficients, w = ar . w_before + e + ma . e_before."""
        p, q, sp, sq = np.split(x[: sum(self.sizes)], np.cumsum(self.sizes)[:-1])
        s = self.seasonal[3]
        return expand(from_partial(p), from_partial(sp), s), -expand(from_partial(q), from_partial(sq), s)

    def difference(self) -> np.ndarray:
        """Coefficients of the differencing polynomial, constant term first."""
        out = np.ones(1)
        for step, times in ((1, self.order[1]), (self.seasonal[3], self.seasonal[1])):
            for _ in range(times):
                out = np.convolve(out, np.concatenate([[1.0], np.zeros(step - 1), [-1.0]]))
        return out


def kalman(w: np.ndarray, ar: np.ndarray, ma: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One-step errors, their variances in units of the innovation variance, and the forecast of the next value."""
    r = max(len(ar), len(ma) + 1, 1)
    phi, load = np.zeros(r), np.zeros(r)
    phi[: len(ar)], load[0], load[1 : len(ma) + 1] = ar, 1.0, ma
    step = np.zeros((r, r))
    step[:, 0] = phi
    step[np.arange(r - 1), np.arange(1, r)] = 1.0
    noise = np.outer(load, load)
    cov, power = noise.copy(), step.copy()
    for _ in range(60):  # the sum of step^k noise step'^k, twice as many terms each time
        more = power @ cov @ power.T
        cov, power = cov + more, power @ power
        if np.abs(more).max() <= 1e-13 * np.abs(cov).max():
            break
    state, errors, sizes = np.zeros(r), np.empty(len(w)), np.empty(len(w))
    still, gain, size = False, np.zeros(r), 1.0
    for t, value in enumerate(w):
        if not still:
            before, size = size, cov[0, 0]
            gain = step @ cov[:, 0] / size
            moved = step @ cov @ step.T + noise - np.outer(gain, gain) * size
            still = t > 0 and abs(size - before) <= STANDS * size and np.abs(moved - cov).max() <= STANDS * size
            cov = moved
        errors[t], sizes[t] = value - state[0], size
        state = step @ state + gain * errors[t]
    return errors, sizes, float(state[0])


def log_likelihood(w: np.ndarray, ar: np.ndarray, ma: np.ndarray) -> float:
    """Gaussian log likelihood at the best innovation variance."""
    errors, sizes, _ = kalman(w, ar, ma)
    n = len(w)
    variance = max(float(np.mean(errors * errors / sizes)), 1e-300)
    return -0.5 * (n * np.log(2 * np.pi * variance) + float(np.log(sizes).sum()) + n)


def maximise(value, x: np.ndarray, slope=None) -> tuple[np.ndarray, float]:
    """Quasi-Newton ascent with step halving; without ``slope`` the gradient is numeric."""

    def numeric(at: np.ndarray) -> np.ndarray:
        h = 1e-5
        return np.array([(value(at + h * e) - value(at - h * e)) / (2 * h) for e in np.eye(len(at))])

    slope = slope or numeric
    best, now = value(x), x
    if not len(x):
        return x, best
    inverse, g = np.eye(len(x)) * 0.01, slope(x)
    for _ in range(STEPS):
        move = inverse @ g
        if move @ g <= 0:
            inverse, move = np.eye(len(x)) * 0.01, 0.01 * g
        move *= min(1.0, 2.0 / max(np.abs(move).max(), 1e-12))
        for _ in range(20):
            there = value(now + move)
            if there > best:
                break
            move = move / 2
        else:
            break
        gained, now, best = there - best, now + move, there
        after = slope(now)
        change = g - after
        g = after
        if (along := move @ change) > 1e-12:
            eye = np.eye(len(x)) - np.outer(move, change) / along
            inverse = eye @ inverse @ eye.T + np.outer(move, move) / along
        if gained < GAIN:
            break
    return now, best


def fit(y: np.ndarray, shape: Shape, start: np.ndarray | None = None) -> tuple[np.ndarray, float, float, float]:
    """Parameters, log likelihood, number of differenced values and one-step forecast of ``y``'s next value.

    Without ``start`` the ascent begins at the best of a small grid of signs.
    """
    c = shape.difference()
    w = np.convolve(y, c, "valid")
    centre = float(w.mean()) if shape.mean else 0.0
    unit = max(float(np.sqrt(np.mean((w - centre) ** 2))), 1e-12)
    scaled = (w - centre) / unit

    def value(x: np.ndarray) -> float:
        shift = x[-1] if shape.mean else 0.0
        return log_likelihood(scaled - shift, *shape.polynomials(x))

    if start is None:
        firsts = np.cumsum([0, *shape.sizes[:-1]])
        choices = [(-0.4, 0.4) if size else (0.0,) for size in shape.sizes]
        grid = []
        for signs in product(*choices):
            x = np.zeros(shape.parameters)
            for at, size, sign in zip(firsts, shape.sizes, signs, strict=True):
                if size:
                    x[at] = sign
            grid.append(x)
        start = max(grid, key=value)
    x, best = maximise(value, start)
    shift = x[-1] if shape.mean else 0.0
    ahead = kalman(scaled - shift, *shape.polynomials(x))[2]
    past = y[-1 : -len(c) : -1] if len(c) > 1 else np.empty(0)
    forecast = (ahead + shift) * unit + centre - float(c[1:] @ past)
    return x, best - len(w) * np.log(unit), len(w), forecast
