"""Fits of many series at once: every function takes a matrix with one series per row (all of one length) and advances all of them
together, one NumPy step per time point or iteration.

Each returns (yhat, lower, upper) of shape (series, horizon), or None if the length is too short for the method; a row that is not
finite counts as not fitted.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

Z80 = 1.28  # fixed value: two-sided 80% band half-width in standard deviations
CHANGEPOINTS = 25
CHANGE_RANGE = 0.8  # share of the history that may hold changepoints
CHANGE_PRIOR = 0.05  # scale of the Laplace prior of a slope change
SIMULATIONS = 300
STEPS = 5000

#: smoothing constants tried: level, trend, season
GRID = np.array([(a, b, g) for a in (0.1, 0.3, 0.5, 0.8) for b in (0.01, 0.1, 0.3) for g in (0.05, 0.2, 0.5)])


def holt_winters(y: np.ndarray, horizon: int, season: int):
    """Additive trend and season, smoothing constants by grid search on squared error; needs two seasons."""
    n, m = y.shape[1], season
    if n < 2 * m:
        return None
    out = [_holt_winters(part, horizon, m) for part in np.array_split(y, -(-y.size * len(GRID) // 4_000_000))]
    return tuple(np.vstack(c) for c in zip(*out, strict=True))


def _holt_winters(y: np.ndarray, horizon: int, m: int):
    rows, n = y.shape
    a, b, g = GRID.T
    first, second = y[:, :m].mean(axis=1)[:, None], y[:, m:2 * m].mean(axis=1)[:, None]
    level = np.repeat(first, len(GRID), axis=1)
    trend = np.repeat((second - first) / m, len(GRID), axis=1)
    terms = [np.repeat((y[:, t:t + 1] - first), len(GRID), axis=1) for t in range(m)]  # a ring of the last m seasonal terms
    error = np.zeros_like(level)
    for t in range(n):
        before = terms[t % m]
        error += (level + trend + before - y[:, t:t + 1]) ** 2
        now = a * (y[:, t:t + 1] - before) + (1 - a) * (level + trend)
        trend = b * (now - level) + (1 - b) * trend
        level = now
        terms[t % m] = g * (y[:, t:t + 1] - level) + (1 - g) * before
    best = error.argmin(axis=1)[:, None]
    pick = lambda x: np.take_along_axis(x, best, axis=1)
    h = np.arange(1, horizon + 1)
    yhat = pick(level) + h * pick(trend) + np.hstack([pick(terms[(n + i - 1) % m]) for i in h])
    half = Z80 * np.sqrt(pick(error) / n)
    return yhat, yhat - half, yhat + half


def _waves(t: np.ndarray, periods: list[tuple[float, int]]) -> list[np.ndarray]:
    return [f(2 * np.pi * j * t / p) for p, k in periods for j in range(1, k + 1) for f in (np.sin, np.cos)]


def _link(bounds):
    """(to the fitted scale, back) of a value between two bounds: log odds; the identity without bounds."""
    if not bounds:
        return (lambda y: y), (lambda v: v)
    low, span = bounds[0], bounds[1] - bounds[0]

    def odds(y):
        p = np.clip((y - low) / span, 0.005, 0.995)
        return np.log(p / (1 - p))
    return odds, lambda v: low + span / (1 + np.exp(-v))


def fourier(y: np.ndarray, horizon: int, season: int, bounds=None, weekly: bool = False, order: int = 6):
    """Linear trend and Fourier seasonality by least squares; needs two seasons, ``weekly`` (harmonics of seven seasons) fourteen."""
    n = y.shape[1]
    periods = [(float(season), min(order, (season - 1) // 2))]  # higher harmonics repeat lower ones on a grid of ``season`` points
    if weekly:
        periods.append((7.0 * season, 3))
    if n < (14 if weekly else 2) * season or n <= 2 + 2 * sum(k for _, k in periods):
        return None
    to, back = _link(bounds)
    design = lambda t: np.column_stack([np.ones_like(t), t / n, *_waves(t, periods)])
    x, target = design(np.arange(n, dtype=float)), to(y)
    coef = np.linalg.lstsq(x, target.T, rcond=None)[0]
    half = Z80 * np.sqrt(np.mean((target - (x @ coef).T) ** 2, axis=1, keepdims=True))
    mean = (design(np.arange(n, n + horizon, dtype=float)) @ coef).T
    return back(mean), back(mean - half), back(mean + half)


def linear(y: np.ndarray, horizon: int, season: int = 1, bounds=None):
    """Least-squares line with a constant band; needs two points."""
    n = y.shape[1]
    if n < 2:
        return None
    t = np.arange(n) - (n - 1) / 2
    slope = (y * t).sum(axis=1, keepdims=True) / (t * t).sum()
    line = lambda x: y.mean(axis=1, keepdims=True) + slope * x
    half = Z80 * np.sqrt(np.mean((y - line(t)) ** 2, axis=1, keepdims=True))
    yhat = line(np.arange(n, n + horizon) - (n - 1) / 2)
    return yhat, yhat - half, yhat + half


@dataclass
class Trend:
    """Piecewise-linear trends (time in units of the history) of all series, and the season's coefficients."""

    base: np.ndarray      # (unpenalised coefficients, series): level, slope, and additive season
    change: np.ndarray    # (changepoints, series): change of slope
    at: np.ndarray        # changepoints in [0, 1]
    noise: np.ndarray     # (series,) standard deviation on the fitted scale

    def line(self, t: np.ndarray) -> np.ndarray:
        return (self.base[0][:, None] + self.base[1][:, None] * t + self.change.T @ np.maximum(t - self.at[:, None], 0))


def _lasso(gram: np.ndarray, cross: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """Minimise c'Gc/2 - c'x + penalty * |c|_1 for every column x of ``cross`` by alternating directions: one shared inverse,
    all coordinates and series in each step.  Columns are brought to unit length first."""
    size = np.sqrt(np.maximum(np.diag(gram), 1e-300))
    usable = np.diag(gram) > 1e-12
    g = gram / np.outer(size, size) * np.outer(usable, usable)
    x, limit = cross / size[:, None] * usable[:, None], penalty / size[:, None]
    values, vectors = np.linalg.eigh(g)
    rho = np.sqrt(max(values[-1], 1e-12) * max(values[0], 1e-6))  # between the curvatures
    inverse = (vectors / (values + rho)) @ vectors.T
    result, open_ = np.zeros_like(x), np.arange(x.shape[1])
    z, u = np.zeros_like(x), np.zeros_like(x)
    for step in range(STEPS):
        c = inverse @ (x + rho * (z - u))
        c = 1.6 * c - 0.6 * z
        before = z
        z = np.sign(c + u) * np.maximum(np.abs(c + u) - limit / rho, 0)
        u = u + c - z
        if step % 20 == 19:
            done = np.maximum(np.abs(c - z), np.abs(z - before)).max(axis=0) < 1e-9
            if done.any():  # a series stops by its own change, whatever others are fitted with it
                result[:, open_[done]] = z[:, done]
                open_, x, limit, z, u = open_[~done], x[:, ~done], limit[:, ~done], z[:, ~done], u[:, ~done]
                if not len(open_):
                    break
    result[:, open_] = z
    return result / size[:, None]


def piecewise_trend(target: np.ndarray, waves: list[np.ndarray], prior: float, n_changes: int) -> Trend:
    """L1-penalised slope changes, everything else unpenalised, for all series (rows of ``target``).

    The unpenalised columns (level, slope, season) are projected out, so the search runs over the changes alone; it solves
    ``|y - fit|^2 / 2 + noise^2 / prior * sum |change|`` with y in units of its range.
    """
    rows, n = target.shape
    t = np.linspace(0, 1, n)
    count = min(n_changes, n // 4)
    at = t[np.linspace(0, CHANGE_RANGE * (n - 1), count + 1).round().astype(int)[1:]] if count else np.zeros(0)
    base = np.column_stack([np.ones(n), t, *waves])
    q = np.linalg.qr(base)[0]
    apart = lambda x: x - q @ (q.T @ x)
    size = np.maximum(np.abs(target).max(axis=1), 1e-12)
    y = (target / size[:, None]).T
    hinge = np.maximum(t[:, None] - at, 0)
    x, r = apart(hinge), apart(y)
    change = np.zeros((len(at), rows))
    if len(at):
        gram, cross = x.T @ x, x.T @ r
        free = np.linalg.lstsq(np.column_stack([base, hinge]), y, rcond=None)[0]
        left = y - np.column_stack([base, hinge]) @ free
        penalty = (left ** 2).sum(axis=0) / max(1, n - base.shape[1] - len(at)) / prior
        change = _lasso(gram, cross, penalty)
    coef = np.linalg.lstsq(base, y - hinge @ change, rcond=None)[0]
    noise = np.sqrt(np.mean((y - hinge @ change - base @ coef) ** 2, axis=0))
    return Trend(coef * size, change * size, at, noise * size)


def _spread(fit: Trend, n: int, horizon: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit draws shared by all series: paths of trends whose slope changes as often as in the history (by a Laplace
    amount of scale 1), and white noise; shape (draws, horizon)."""
    rng = np.random.default_rng(seed)
    rate = min(1.0, len(fit.at) / max(n - 1, 1))
    jump = rng.laplace(size=(SIMULATIONS, horizon)) * (rng.random((SIMULATIONS, horizon)) < rate)
    return np.cumsum(np.cumsum(jump, axis=1), axis=1) / max(n - 1, 1), rng.normal(size=(SIMULATIONS, horizon))


def trend(y: np.ndarray, horizon: int, season: int, bounds=None, multiplicative: bool = False, order: int = 3, prior: float = CHANGE_PRIOR,
          n_changes: int = CHANGEPOINTS, seed: int = 11):
    """Piecewise-linear (with bounds: logistic) trend, additive or multiplicative Fourier season, 80% band from simulated trends.

    Needs two seasons.  With a multiplicative season trend and season are fitted in turn: y = g * (1 + s).
    """
    n = y.shape[1]
    periods = [(float(season), min(order, (season - 1) // 2))]
    if n < max(2 * season, 8):
        return None
    to, back = _link(bounds)
    past, future = np.arange(n, dtype=float), np.arange(n, n + horizon, dtype=float)
    waves, ahead = _waves(past, periods), _waves(future, periods)
    t = future / max(n - 1, 1)
    if not multiplicative or not waves:
        fit = piecewise_trend(to(y), waves, prior, n_changes)
        mean = fit.line(t) + (np.array(ahead).T @ fit.base[2:]).T if waves else fit.line(t)
        paths, white = _spread(fit, n, horizon, seed)
        lift = np.abs(fit.change).mean(axis=0) if len(fit.at) else np.zeros(len(y))
        low, high = np.quantile(lift[:, None, None] * paths + fit.noise[:, None, None] * white, [0.1, 0.9], axis=1)
        return back(mean), back(mean + low), back(mean + high)
    x, wave = np.column_stack(waves), np.column_stack(ahead)
    share = np.zeros_like(y)
    for _ in range(4):
        fit = piecewise_trend(to(y / (1 + share)), [], prior, n_changes)
        g = back(fit.line(np.linspace(0, 1, n)))
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(np.abs(g) > 1e-9, y / g - 1, 0.0)
        coef = np.linalg.lstsq(x, ratio.T, rcond=None)[0]
        share = np.maximum((x @ coef).T, -0.9)
    later = 1 + np.maximum((wave @ coef).T, -0.9)
    noise = np.sqrt(np.mean((y - g * (1 + share)) ** 2, axis=1))
    paths, white = _spread(fit, n, horizon, seed)
    lift = np.abs(fit.change).mean(axis=0) if len(fit.at) else np.zeros(len(y))
    line = fit.line(t)
    draws = back(line[:, None, :] + lift[:, None, None] * paths) * later[:, None, :] + noise[:, None, None] * white
    low, high = np.quantile(draws, [0.1, 0.9], axis=1)
    mean = back(line) * later
    return mean, np.minimum(low, mean), np.maximum(high, mean)


def naive(y: np.ndarray, horizon: int, season: int = 1, bounds=None):
    last = np.repeat(y[:, -1:], horizon, axis=1)
    return last, last, last


def fit_matrix(y: np.ndarray, methods: tuple[str, ...], horizon: int, season: int, bounds=None):
    """(yhat, lower, upper, model per row): each row by the first method that fits it; the model is None where none does."""
    tag = "_logistic" if bounds else ""
    known = {"fourier": (fourier, {"bounds": bounds}, f"fourier{tag}"), "fourier_weekly": (fourier, {"bounds": bounds, "weekly": True}, f"fourier_weekly{tag}"),
             "trend": (trend, {"bounds": bounds}, f"trend{tag}"),
             "trend_multiplicative": (trend, {"bounds": bounds, "multiplicative": True}, f"trend_multiplicative{tag}"),
             "hw": (holt_winters, {}, "holt_winters"), "linear": (linear, {}, "linear"), "naive": (naive, {}, "naive_last")}
    out = np.full((3, len(y), horizon), np.nan)
    names = np.full(len(y), None, dtype=object)
    for m in methods:
        run, options, name = known[m]
        open_ = np.flatnonzero(names == None)  # noqa: E711
        if not len(open_):
            break
        found = run(y[open_], horizon, season, **options)
        if found is None:
            continue
        good = np.isfinite(found[0]).all(axis=1)
        for i in range(3):
            out[i, open_[good]] = found[i][good]
        names[open_[good]] = name
    if bounds:
        out = np.clip(out, *bounds)
    return (*out, names)
