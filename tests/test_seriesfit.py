"""Fits of many series at once equal fits of one series at a time, and find what was planted."""

import numpy as np
import pytest

from cellgrid.operators import seriesfit as SF


def plain_holt_winters(y, m, horizon):
    """One series, one parameter set after the other."""
    best = None
    for a, b, g in SF.GRID:
        level, slope, sea = y[:m].mean(), (y[m:2 * m].mean() - y[:m].mean()) / m, list(y[:m] - y[:m].mean())
        errors = []
        for t in range(len(y)):
            errors.append(level + slope + sea[t] - y[t])
            now = a * (y[t] - sea[t]) + (1 - a) * (level + slope)
            slope = b * (now - level) + (1 - b) * slope
            level = now
            sea.append(g * (y[t] - level) + (1 - g) * sea[t])
        sse = float(np.sum(np.square(errors)))
        if best is None or sse < best[0]:
            best = sse, np.array([level + h * slope + sea[len(y) + (h - 1) % m] for h in range(1, horizon + 1)])
    return best[1], np.sqrt(best[0] / len(y))


def many(rows, n, seed=0):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    return 50 + rng.normal(0, 0.2, (rows, 1)) * t + 8 * np.sin(2 * np.pi * t / 7 + rng.random((rows, 1))) + rng.normal(0, 1.5, (rows, n))


@pytest.mark.parametrize("n", [14, 27, 61])
def test_holt_winters_equals_one_at_a_time(n):
    y = many(9, n)
    yhat, low, high = SF.holt_winters(y, 10, 7)
    for i, row in enumerate(y):
        want, rmse = plain_holt_winters(row, 7, 10)
        assert yhat[i] == pytest.approx(want, abs=1e-9) and high[i] - low[i] == pytest.approx(2 * SF.Z80 * rmse, abs=1e-9)


def test_fourier_and_linear_equal_least_squares_per_series():
    y, t = many(5, 40), np.arange(40.0)
    waves = lambda t: np.column_stack([np.ones_like(t), t, *[f(2 * np.pi * j * t / 7) for j in (1, 2, 3) for f in (np.sin, np.cos)]])
    for i, row in enumerate(y):
        coef = np.linalg.lstsq(waves(t), row, rcond=None)[0]
        assert SF.fourier(y, 6, 7)[0][i] == pytest.approx(waves(np.arange(40.0, 46)) @ coef, abs=1e-8)
        slope, level = np.polyfit(t, row, 1)
        assert SF.linear(y, 6)[0][i] == pytest.approx(level + slope * np.arange(40, 46), abs=1e-8)


def test_trend_without_changepoints_is_least_squares():
    y = many(4, 50, 2)
    assert SF.trend(y, 9, 7, n_changes=0)[0] == pytest.approx(SF.fourier(y, 9, 7, order=3)[0], abs=1e-8)
    assert SF.trend(y, 9, 7, prior=1e-12)[0] == pytest.approx(SF.fourier(y, 9, 7, order=3)[0], abs=1e-6)


def test_penalised_fit_is_the_optimum():
    """Subgradient conditions of the penalised problem: exact for the zero changes, equality for the others."""
    rng = np.random.default_rng(5)
    y = np.cumsum(rng.normal(0, 1, (6, 80)), axis=1) + 20
    fit = SF.piecewise_trend(y, [], SF.CHANGE_PRIOR, 12)
    t = np.linspace(0, 1, 80)
    size = np.abs(y).max(axis=1)
    hinge = np.maximum(t[:, None] - fit.at, 0)
    full = np.column_stack([np.ones(80), t, hinge])
    for i in range(6):
        target = y[i] / size[i]
        rest = target - full @ np.linalg.lstsq(full, target, rcond=None)[0]
        penalty = (rest ** 2).sum() / (80 - 2 - len(fit.at)) / SF.CHANGE_PRIOR
        gradient = hinge.T @ ((y[i] - fit.line(t)[i]) / size[i])
        change = fit.change[:, i] / size[i]
        assert np.all(np.abs(gradient) <= penalty * (1 + 1e-3))
        assert gradient[change != 0] == pytest.approx(penalty * np.sign(change[change != 0]), rel=1e-3)


def test_planted_slope_change_is_found_and_continued():
    t = np.arange(120)
    rng = np.random.default_rng(1)
    y = np.vstack([30 + 0.05 * t + np.where(t > 60, s * (t - 60), 0) + 2 * np.sin(2 * np.pi * t / 7) + rng.normal(0, 0.3, 120) for s in (0.5, -0.4)])
    fit = SF.piecewise_trend(y, SF._waves(t.astype(float), [(7.0, 3)]), SF.CHANGE_PRIOR, SF.CHANGEPOINTS)
    for i, s in enumerate((0.5, -0.4)):
        near = np.abs(fit.at * 119 - 60) < 15
        assert fit.change[near, i].sum() / 119 == pytest.approx(s, abs=0.15) and np.abs(fit.change[~near, i]).sum() < 0.3 * np.abs(fit.change[:, i]).sum()
    yhat, low, high = SF.trend(y, 14, 7)
    ahead = np.arange(120, 134)
    truth = np.vstack([30 + 0.05 * ahead + s * (ahead - 60) + 2 * np.sin(2 * np.pi * ahead / 7) for s in (0.5, -0.4)])
    assert np.abs(yhat - truth).max() < 4 and np.all(low <= yhat) and np.all(yhat <= high)
    assert np.abs(SF.linear(y, 14)[0] - truth).max() > 8
    assert np.all(np.diff(high - low, axis=1)[:, -1] > -1) and (high - low)[:, -1].min() > (high - low)[:, 0].min()


def test_multiplicative_season_grows_with_the_trend():
    t = np.arange(98.0)
    wave = lambda t: 1 + 0.3 * np.sin(2 * np.pi * t / 7)
    rng = np.random.default_rng(3)
    y = ((20 + 0.8 * t) * wave(t))[None, :] + rng.normal(0, 0.4, (3, 98))
    ahead = np.arange(98.0, 112)
    truth = (20 + 0.8 * ahead) * wave(ahead)
    assert np.abs(SF.trend(y, 14, 7, multiplicative=True)[0] - truth).max() < 3
    assert np.abs(SF.trend(y, 14, 7)[0] - truth).max() > 6
    bounded = SF.trend(np.clip(y, 0, 150), 14, 7, bounds=(0.0, 150.0), multiplicative=True)
    assert np.all(np.isfinite(bounded[0])) and np.abs(bounded[0] - truth).max() < 15


def test_backtest_beats_the_last_value_and_the_band_covers():
    y = many(60, 90, 7)
    known, later = y[:, :-7], y[:, -7:]
    yhat, low, high = SF.trend(known, 7, 7)
    error = lambda p: np.abs(p - later).mean()
    assert error(yhat) < 0.5 * error(SF.naive(known, 7)[0])
    assert 0.65 < ((later >= low) & (later <= high)).mean() < 0.95


def test_short_series_fall_through_and_rows_are_judged_one_by_one():
    y = many(3, 9)
    y[1, 4] = np.nan
    *_, model = SF.fit_matrix(y, ("fourier", "trend", "hw", "linear"), 3, 7)
    assert list(model) == ["linear", None, "linear"]
    assert SF.fourier(many(1, 90), 4, 7, weekly=True) is None and SF.fourier(many(1, 98), 4, 7, weekly=True)[0].shape == (1, 4)
    assert list(SF.fit_matrix(many(2, 30), ("trend", "naive"), 3, 7, (0.0, 100.0))[3]) == ["trend_logistic"] * 2


def test_a_trend_does_not_depend_on_the_series_fitted_with_it():
    y = np.vstack([many(3, 90, 4), 1000 * np.random.default_rng(6).random((5, 90))])
    together, alone = SF.trend(y, 6, 7), [SF.trend(y[i:i + 1], 6, 7) for i in range(len(y))]
    for i, one in enumerate(alone):
        for a, b in zip(together, one, strict=True):
            assert a[i] == pytest.approx(b[0], rel=1e-11)
