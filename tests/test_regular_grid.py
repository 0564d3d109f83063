import math
from datetime import date, datetime

import numpy as np

from tidemark.operators.regular_grid import CHOICES, held_out, regular_grid, ssa_chosen, ssa_converged, ssa_fill


def plain_ssa(y, window, rank, tol, most):
    """One series at a time, with numpy's own singular values."""
    y = np.array(y, float)
    gap = np.isnan(y)
    n, mean = len(y), np.nanmean(y)
    y = y - mean
    x = y.copy()
    x[gap] = np.interp(np.flatnonzero(gap), np.flatnonzero(~gap), y[~gap])
    lags = min(window, n // 2)
    for _ in range(most):
        h = np.array([x[i : i + n - lags + 1] for i in range(lags)])
        u, s, v = np.linalg.svd(h, full_matrices=False)
        low = (u[:, :rank] * s[:rank]) @ v[:rank]
        back = np.array([np.mean([low[i, t - i] for i in range(lags) if 0 <= t - i < n - lags + 1]) for t in range(n)])
        moved = np.abs(back - x)[gap].max() / abs(mean)
        x[gap] = back[gap]
        if moved <= tol:
            break
    return x + mean


def test_same_as_plain_singular_values():
    rng = np.random.default_rng(0)
    t = np.arange(120)
    y = np.array([50 + 5 * np.sin(t / 9) + rng.normal(0, 0.1, 120) for _ in range(5)])
    y[rng.random(y.shape) < 0.2] = np.nan
    got = ssa_fill(y, 20, 3)
    for a, b in zip(got, y):
        assert np.allclose(a, plain_ssa(b, 20, 3, 1e-5, 60), rtol=1e-6)
        assert (a[~np.isnan(b)] == b[~np.isnan(b)]).all()


def test_a_wave_comes_back_through_a_gap():
    t = np.arange(200)
    true = 100 + 3 * np.sin(2 * np.pi * t / 25)
    y = true.copy()
    y[80:100] = np.nan
    flat = np.interp(t[80:100], [79, 100], true[[79, 100]])
    err = np.abs(ssa_fill(y[None], 50, 3, 1e-7, 400)[0][80:100] - true[80:100]).max()
    assert err < 0.3 * np.abs(flat - true[80:100]).max()


def test_slow_series_are_iterated_to_the_end():
    rng = np.random.default_rng(3)
    y = 100 + np.cumsum(rng.normal(0, 0.3, (20, 210)), axis=1)
    y[rng.random(y.shape) < 0.3] = np.nan
    y[::2, 90:120] = np.nan
    got, rests = ssa_converged(y)
    early, at_60 = ssa_converged(y, most=60)
    assert rests.all() and 0 < at_60.sum() < len(y)
    assert (ssa_fill(y) == got).all()
    for i in range(len(y)):
        plain = plain_ssa(y[i], 24, 3, 1e-5, 5000)
        assert np.allclose(got[i], plain, rtol=1e-6)
        assert at_60[i] == np.allclose(early[i], plain, rtol=1e-9)


def test_windows_are_chosen_by_values_held_out():
    rng = np.random.default_rng(7)
    t = np.arange(390)
    wave = 100 + 5 * np.sin(2 * np.pi * t / 30 + rng.uniform(0, 6, (8, 1)))
    walk = 100 + np.cumsum(rng.normal(0, 0.1, (8, 390)), axis=1)
    true = np.concatenate([wave, walk])
    y = np.where(rng.random(true.shape) < 0.15, np.nan, true)
    y[:, 200:206] = np.nan
    got, rests, lags = ssa_chosen(y)
    flat = np.array([np.interp(t, t[~np.isnan(r)], r[~np.isnan(r)]) for r in y])
    gap = np.isnan(y)
    err = lambda x, rows: np.abs(x - true)[rows][gap[rows]].mean()
    assert rests.all() and (got[~gap] == true[~gap]).all()
    assert err(got, slice(0, 8)) < 0.2 * err(flat, slice(0, 8)) and err(got, slice(8, 16)) < 1.05 * err(flat, slice(8, 16))
    assert set(lags[:8].tolist()) <= {6, 24} and np.median(lags[8:]) == 2


def test_values_held_out():
    y = np.full((3, 100), np.nan)
    y[0], y[1, 50] = 1.0, 1.0
    m = held_out(y)
    assert 3 <= m[0].sum() <= 20 and not m[0, 0] and not m[0, -1] and not m[1:].any()
    out, rests, _ = ssa_chosen(y)
    assert (out[1] == 1).all() and np.isnan(out[2]).all() and rests.all()
    assert ssa_chosen(np.full((0, 5), np.nan))[0].shape == (0, 5) and len(CHOICES) > 1


def test_series_stopped_early_are_reported(spark):
    day = (date(2020, 1, 2), ts(14, 30), ts(14, 50))
    bars = [("A", ts(14, 30 + i), 10.0 + i % 7, 1, "") for i in range(20) if i not in (5, 6, 12)] + [("B", ts(14, 30 + i), 10.0, 1, "") for i in range(20)]
    b, s = spark.createDataFrame(bars, BAR), spark.createDataFrame([day], SESSION)
    args = (b, s, "symbol", "window_start", "close_price", "session_date", "open_utc", "close_utc")
    told = lambda **kw: {(r.source, r.converged) for r in regular_grid(*args, **kw).collect()}
    assert told(most=1) == {("A", False), ("B", True)} and told() == {("A", True), ("B", True)}


def test_degenerate_series():
    nan, inf = math.nan, math.inf
    assert np.isnan(ssa_fill([[nan] * 9])).all()
    assert (ssa_fill([[nan] * 4 + [7] + [nan] * 4]) == 7).all()
    assert ssa_fill([[1, nan, 3]]).tolist() == [[1, 2, 3]]
    out = ssa_fill([[1.0, 1, nan, 1, inf, 1, 1, 1, 1, 1]])[0]
    assert out[4] == inf and abs(out[2] - 1) < 1e-6
    assert ssa_fill(np.full((1, 1), nan)).shape == (1, 1)


def ts(h, m, s=0):
    return datetime(2020, 1, 2, h, m, s)


BAR = "symbol string, window_start timestamp_ntz, close_price double, loaded int, `window` string"
SESSION = "session_date date, open_utc timestamp_ntz, close_utc timestamp_ntz"


def grid(spark, bars, sessions):
    b, s = spark.createDataFrame(bars, BAR), spark.createDataFrame(sessions, SESSION)
    from pyspark.sql import functions as F

    out = regular_grid(b, s, "symbol", "window_start", "close_price", "session_date", "open_utc", "close_utc", tie=F.col("loaded"))
    return sorted(((r.source, r.session, r.period_start, r.value, r.filled) for r in out.collect()), key=repr)


def test_grid_rules(spark):
    day = (date(2020, 1, 2), ts(14, 30), ts(14, 35))
    bars = [
        ("A", ts(14, 30), 10.0, 1, ""), ("A", ts(14, 30, 20), 11.0, 1, ""), ("A", ts(14, 30, 20), 12.0, 2, ""),  # the last one counts
        ("A", ts(14, 32), math.nan, 1, ""), ("A", ts(14, 33), 0.0, 1, ""), ("A", ts(14, 34, 59), 14.0, 1, ""),
        ("A", ts(14, 35), 99.0, 1, ""), ("A", ts(14, 29, 59), 99.0, 1, ""),  # outside
        ("B", ts(14, 31), None, 1, ""), (None, ts(14, 31), 5.0, 1, ""), ("C", None, 5.0, 1, ""), ("D", ts(9, 0), 5.0, 1, ""),
    ]
    out = grid(spark, bars, [day])
    a = [(r[2].minute, r[3] if not r[4] else None, r[4]) for r in out if r[0] == "A"]
    assert a == [(30, 12.0, False), (31, None, True), (32, None, True), (33, None, True), (34, 14.0, False)]
    assert all(r[3] is None and r[4] for r in out if r[0] == "B") and sum(r[0] == "B" for r in out) == 5
    assert [r[3] for r in out if r[0] is None] == [5.0] * 5
    assert {r[0] for r in out} == {"A", "B", None}


def test_sessions_over_midnight_and_empty_tables(spark):
    night = (date(2020, 1, 2), datetime(2020, 1, 2, 23, 58), datetime(2020, 1, 3, 0, 2))
    out = grid(spark, [("A", datetime(2020, 1, 3, 0, 1), 3.0, 1, "")], [night])
    assert [(r[2], r[3]) for r in out] == [(datetime(2020, 1, 2, 23, 58), 3.0), (datetime(2020, 1, 2, 23, 59), 3.0), (datetime(2020, 1, 3), 3.0), (datetime(2020, 1, 3, 0, 1), 3.0)]
    assert grid(spark, [], [night]) == [] and grid(spark, [("A", ts(14, 0), 1.0, 1, "")], []) == []
