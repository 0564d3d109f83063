"""Irregular readings onto a regular grid: iterative singular-spectrum imputation.

Readings are put into the periods of their session, one value per period, and a session's periods become one series:
its length is bounded by the session, not by the data, so a hot source has many series, not a long one. The series are
spread over hash buckets and filled in Arrow batches, series of one length together:

1. gaps get straight lines between their neighbours as a first guess, and the series is centred;
2. the Hankel trajectory matrix of each series (``window`` lags) is truncated to its ``rank`` greatest singular vectors;
3. averaging over the anti-diagonals gives a smooth series, which replaces the missing entries, and only those;
4. steps 2 and 3 are repeated until no missing entry moves by more than ``tol`` of the series' scale. Each series is iterated
   until its own movement is that small, however many rounds it takes; ``most`` is a far safety stop, and a series that
   reaches it is reported as not ``converged``.

Window and rank are chosen for each series from ``CHOICES`` by masked validation: a tenth of its values is held out and
filled with each choice, and the smallest window within 25 % of the least error is taken (about two standard errors of some
35 values). Prices that wander get two lags, of which one vector is kept, which comes to straight lines; series with a
rhythm get windows that hold it.

Filled periods are marked. Defined results: a reading is usable if it isn't null, isn't NaN and is above ``floor``; of
several usable readings in a period the last one counts (ties: ``tie``, then the greater value); readings outside every
session belong to no grid; a source and session with no usable reading at all keeps its periods, marked, with a null
value; with one usable value that value fills the series; series too short for a window of two get straight lines;
an infinite reading is kept, without guiding others;
a null source is a source of its own; empty tables give empty results; columns not named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import c, from_micros, micros
from tidemark.session import partitions

#: Rounds of a series at most: far beyond what series need (under 200 at sf0.1), so that a series that doesn't settle can't hold a task for good.
MOST = 10_000
#: Windows and ranks tried on each series, from the smallest window on; the share of values held out for it, and the error another window must save.
CHOICES = ((2, 1), (6, 2), (24, 4))
HELD_OUT, WORTH = 0.1, 0.25


def ssa_fill(y: np.ndarray, window: int = 24, rank: int = 3, tol: float = 1e-5, most: int = MOST) -> np.ndarray:
    """y, series by row with NaN where missing, filled. Rows without any value stay NaN."""
    return ssa_converged(y, window, rank, tol, most)[0]


def ssa_converged(y: np.ndarray, window: int = 24, rank: int = 3, tol: float = 1e-5, most: int = MOST) -> tuple[np.ndarray, np.ndarray]:
    """ssa_fill's result, and whether each series came to rest; one that needs no rounds has."""
    given = np.array(y, float)
    y = np.where(np.isinf(given), np.nan, given)  # kept as read, but no guide for the others
    m, n = y.shape
    missing = np.isnan(y)
    some = ~missing.all(axis=1)
    mean = np.zeros((m, 1))
    mean[some, 0] = np.nanmean(y[some], axis=1)
    scale = np.maximum(np.abs(mean[:, 0]), 1e-12)
    y = y - mean
    x = y.copy()
    at = np.arange(n)
    for i in np.flatnonzero(some & missing.any(axis=1)):
        x[i, missing[i]] = np.interp(at[missing[i]], at[~missing[i]], y[i, ~missing[i]])
    rests = np.ones(m, bool)
    lags = min(window, n // 2)
    todo = np.flatnonzero(some & missing.any(axis=1) & ((~missing).sum(axis=1) > 1))
    whole = lambda: np.where(missing & ~np.isinf(given), x + mean, given)
    if lags < 2 or not len(todo):
        return whole(), rests
    rests[todo] = False
    rank, cols = min(rank, lags - 1), n - lags + 1
    scale = scale[todo]
    weight = np.minimum(np.minimum(at + 1, n - at), min(lags, cols)).astype(float)
    for _ in range(most):
        cur = x[todo]
        hankel = np.lib.stride_tricks.sliding_window_view(cur, cols, axis=1)  # series x lags x cols
        _, vectors = np.linalg.eigh(hankel @ hankel.transpose(0, 2, 1))
        top = vectors[:, :, -rank:]
        parts = top.transpose(0, 2, 1) @ hankel  # series x rank x cols
        low = top @ parts
        smooth = np.zeros_like(cur)
        for k in range(lags):
            smooth[:, k : k + cols] += low[:, k]
        smooth /= weight
        gap = missing[todo]
        moved = np.where(gap, np.abs(smooth - cur), 0).max(axis=1) / scale
        cur = np.where(gap, smooth, cur)
        x[todo] = cur
        stay = ~(moved <= tol)
        rests[todo[~stay]] = True
        todo, scale = todo[stay], scale[stay]
        if not len(todo):
            break
    return whole(), rests


def held_out(y: np.ndarray, share: float = HELD_OUT) -> np.ndarray:
    """A fixed choice of about that share of each series' finite values, never its first or last."""
    known = np.isfinite(y)
    draw = (np.arange(y.shape[1], dtype=np.uint64) * np.uint64(2654435761) % np.uint64(1 << 32)) / (1 << 32) < share
    ends = np.zeros_like(known)
    has = known.any(axis=1)
    rows = np.arange(len(y))
    ends[rows[has], known[has].argmax(axis=1)] = True
    ends[rows[has], y.shape[1] - 1 - known[has][:, ::-1].argmax(axis=1)] = True
    return known & draw & ~ends


def ssa_chosen(y: np.ndarray, choices: tuple[tuple[int, int], ...] = CHOICES, tol: float = 1e-5, most: int = MOST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """y filled with the window and rank that masked validation chooses for each series; whether it came to rest; the window."""
    y = np.array(y, float)
    gaps = np.flatnonzero(np.isnan(y).any(axis=1))
    pick = np.zeros(len(y), int)
    if len(choices) > 1 and len(gaps):
        part = y[gaps]
        mask = held_out(part)
        shown, n = np.where(mask, np.nan, part), np.maximum(mask.sum(axis=1), 1)
        errors = np.array([np.abs(np.where(mask, ssa_converged(shown, w, r, tol, most)[0] - np.where(mask, part, 0), 0)).sum(axis=1) / n for w, r in choices])
        errors = np.where(np.isnan(errors), np.inf, errors)
        pick[gaps] = (errors <= errors.min(axis=0) * (1 + WORTH)).argmax(axis=0)
    out, rests = y.copy(), np.ones(len(y), bool)
    for k in np.unique(pick[gaps]):
        own = gaps[pick[gaps] == k]
        out[own], rests[own] = ssa_converged(y[own], *choices[k], tol, most)
    return out, rests, np.array([w for w, _ in choices])[pick]


def _fill(choices: tuple[tuple[int, int], ...], tol: float, most: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            values, filled, converged, windows = [None] * len(b), [None] * len(b), np.ones(len(b), bool), np.zeros(len(b), np.int32)
            sizes = b["n"].to_numpy()
            for n in np.unique(sizes):
                rows = np.flatnonzero(sizes == n)
                for some in np.array_split(rows, max(1, len(rows) // 64)):  # so much at once as stays in the caches
                    y = np.full((len(some), n), np.nan)
                    for j, r in enumerate(some):
                        at = b["at"].iat[r]
                        if at is not None and len(at):
                            y[j, at] = b["v"].iat[r]
                    done, converged[some], windows[some] = ssa_chosen(y, choices, tol, most)
                    for j, r in enumerate(some):
                        values[r] = [None if np.isnan(z) else float(z) for z in done[j]]
                        filled[r] = np.isnan(y[j])
            yield b[["source", "session", "open"]].assign(values=values, filled=filled, converged=converged, lags=windows)

    return run


def regular_grid(
    readings: DataFrame, sessions: DataFrame, source: str, time: str, value: str, session: str, opens: str, closes: str,
    period_s: int = 60, floor: float = 0.0, tie: Column | None = None, choices: tuple[tuple[int, int], ...] = CHOICES, tol: float = 1e-5, most: int = MOST,
) -> DataFrame:
    """One row per source, session with at least one reading, and period: source, session, period_start, value, filled; of the series, converged and lags (its window)."""
    step = period_s * 1_000_000
    day = 86_400_000_000
    s = sessions.select(c(session).alias("session"), micros(c(opens)).alias("open"), micros(c(closes)).alias("close"))
    # readings meet sessions by calendar day, then by time; a session lies on few days
    s = s.withColumn("day", F.explode(F.sequence(F.floor(F.col("open") / day), F.floor((F.col("close") - 1) / day))))
    v = c(value).cast("double")
    usable = F.coalesce(v.isNotNull() & ~F.isnan(v) & (v > floor), F.lit(False))
    r = readings.select(
        c(source).alias("source"), micros(c(time)).alias("t"), F.when(usable, v).alias("v"), (tie if tie is not None else F.lit(0)).alias("tie")
    ).withColumn("day", F.floor(F.col("t") / day))
    placed = r.join(s, "day").filter("t >= open and t < close").withColumn("at", F.floor((F.col("t") - F.col("open")) / step).cast("int"))
    per_period = placed.groupBy("source", "session", "open", "close", "at").agg(
        F.max(F.when(F.col("v").isNotNull(), F.struct("t", "tie", "v"))).alias("last")
    )
    # at most one entry per period of the session
    series = (
        per_period.groupBy("source", "session", "open", "close")
        .agg(F.array_sort(F.collect_list(F.when(F.col("last").isNotNull(), F.struct("at", F.col("last.v").alias("v"))))).alias("have"))
        .select(
            "source", F.col("session").cast("string").alias("session"), "open", F.ceil((F.col("close") - F.col("open")) / step).cast("int").alias("n"),
            F.col("have.at").alias("at"), F.col("have.v").alias("v"),
        )
        .repartition(partitions(readings), "source", "session")  # filling a series costs far more than moving it
    )
    kind = readings.schema[source].dataType.simpleString()
    filled = series.mapInPandas(
        _fill(choices, tol, most), f"source {kind}, session string, open bigint, values array<double>, filled array<boolean>, converged boolean, lags int"
    )
    cells = filled.select("source", "session", "open", "converged", "lags", F.posexplode(F.arrays_zip("values", "filled")).alias("i", "cell"))
    return cells.select(
        "source", "session", from_micros(F.col("open") + F.col("i").cast("bigint") * F.lit(step)).alias("period_start"), F.col("cell.values").alias("value"), F.col("cell.filled").alias("filled"), "converged", "lags"
    )
