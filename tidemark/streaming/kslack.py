"""K-slack reordering on a live stream: the rule of ``tidemark.operators.kslack`` with state.

The clock is the greatest arrival time seen by the batches before, less ``reorder_s`` seconds by which arrivals of different
batches may be out of order. It is the stream's watermark, but no event is ever dropped by it: the rows carry a watermark
column of their own that is never behind, so every event reaches the buffers and is kept, or counted.

One state holds the buffers of a key for the periods of a block of time (``block_s``), so there are few states even for short
periods, and a hot key has as many as blocks. What comes out, by ``stage``:
- ``provisional``: once per period, when the clock passes its end by the grace, by a time-out, whether or not another event
  comes: of the events that arrived by then;
- ``amended``: a period whose provisional values are out gets events; of all its events so far;
- ``final``: when the clock passes the period's end by the slack, by a time-out: the buffer is released in order of event time;
- ``rejected``: events that arrived beyond the slack, by their own arrival time: their number;
- ``missed``: events that arrived within the slack, but reach the stream when the final values are out, being more than
  ``reorder_s`` behind other arrivals: their number. They change no value, and are told apart from rejected ones.

Defined results: as in ``tidemark.operators.kslack``, but that copies of an event are known only while its period is held.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions.columns import c, micros

#: An event in a buffer. A null sequence or value is held as -1 or NaN; events that don't count are held for their copies' sake.
BUFFER = np.dtype([("t", "i8"), ("seq", "i8"), ("arrival", "i8"), ("v", "f8"), ("ok", "i1")])
OUT = "key string, period bigint, stage string, n bigint, n_amended bigint, n_rejected bigint, n_missed bigint, open double, close double, mean double"
NAMES = [x.split()[0] for x in OUT.split(", ")]
NEVER = (1 << 62) - 1
#: What Spark marks a watermark column by, on a column that is never late.
MARK = {"spark.watermarkDelayMs": 0}


def _values(b: np.ndarray, period: np.ndarray, end: np.ndarray, grace: int, stage: str) -> list[pd.DataFrame]:
    """A row per period of the events that count."""
    on = b["ok"] == 1
    b, period, end = b[on], period[on], end[on]
    if not len(b):
        return []
    o = np.lexsort((b["seq"], b["t"]))
    b, period, end = b[o], period[o], end[o]
    first = np.flatnonzero(np.r_[True, period[1:] != period[:-1]])
    n = np.diff(np.r_[first, len(b)])
    late = np.add.reduceat((b["arrival"] > end + grace).astype(np.int64), first)
    return [pd.DataFrame({"period": period[first], "stage": stage, "n": n, "n_amended": late, "open": b["v"][first], "close": b["v"][first + n - 1], "mean": np.add.reduceat(b["v"], first) / n})]


def _counts(period: np.ndarray, stage: str, name: str) -> list[pd.DataFrame]:
    which, n = np.unique(period, return_counts=True)
    return [pd.DataFrame({"period": which, "stage": stage, name: n})] if len(which) else []


def advance(held: np.ndarray, told: np.ndarray, new: np.ndarray, clock: int, length: int, slack: int, grace: int) -> tuple[np.ndarray, np.ndarray, list[pd.DataFrame], int | None]:
    """A state's buffer and the periods whose provisional values are out, after new events and at that clock; the rows that come out; the next time to look."""
    starts = lambda b: b["t"] - np.mod(b["t"], length)
    out: list[pd.DataFrame] = []
    if len(new):
        # copies of held events are no events
        known = np.isin(new[["t", "seq"]].astype([("t", "i8"), ("seq", "i8")]), held[["t", "seq"]].astype([("t", "i8"), ("seq", "i8")]))
        end = starts(new) + length
        late, over = new["arrival"] > end + slack, clock >= end + slack
        out += _counts(starts(new)[late & ~known & (new["ok"] == 1)], "rejected", "n_rejected")
        out += _counts(starts(new)[~late & over & (new["ok"] == 1)], "missed", "n_missed")
        fresh = new[~late & ~over]
        both = np.concatenate([held, fresh])
        # the first to arrive counts
        o = np.lexsort((np.nan_to_num(both["v"], nan=-np.inf), both["ok"], both["arrival"], both["seq"], both["t"]))
        both = both[o]
        one = np.r_[True, (both["t"][1:] != both["t"][:-1]) | (both["seq"][1:] != both["seq"][:-1])] if len(both) else np.zeros(0, bool)
        held = both[one]
        touched = np.unique(starts(fresh))
    else:
        touched = np.zeros(0, np.int64)
    period = starts(held)
    end = period + length
    due = (clock >= end + grace) & ~np.isin(period, told)
    in_time = due & (held["arrival"] <= end + grace)
    out += _values(held[in_time], period[in_time], end[in_time], grace, "provisional")
    again = np.isin(period, touched) & (np.isin(period, told) | due) & (clock < end + slack)
    # periods that only in-time events came to have nothing to amend
    late_too = np.unique(period[(held["arrival"] > end + grace) & (held["ok"] == 1)])
    again &= np.isin(period, told) | np.isin(period, late_too)
    out += _values(held[again], period[again], end[again], grace, "amended")
    told = np.union1d(told, period[due])
    done = clock >= end + slack
    out += _values(held[done], period[done], end[done], grace, "final")
    held, period = held[~done], period[~done]
    told = told[np.isin(told, period)]
    if not len(held):
        return held, told, out, None
    end = period + length
    return held, told, out, int(np.where(np.isin(period, told), end + slack, end + grace).min())


def kslack_stream(
    df: DataFrame, key: str, event_time: str, arrival: str, sequence: str, value: str | Column, valid: Column | None = None,
    slack_s: int = 3600, grace_s: int = 120, period_s: int = 60, reorder_s: int = 0, block_s: int = 3600,
) -> DataFrame:
    """Rows of stage provisional, amended, final, rejected and missed as they come about; update mode."""
    length, slack, grace, block = (x * 1_000_000 for x in (period_s, slack_s, grace_s, max(block_s - block_s % period_s, period_s)))
    t = micros(c(event_time))
    v = c(value) if isinstance(value, str) else value
    rows = df.withColumns({"__v": v.cast("double"), "__ok": F.coalesce(valid, F.lit(False)) if valid is not None else F.lit(True)})
    rows = rows.withColumn("__arrival", c(arrival).cast("timestamp")).withWatermark("__arrival", f"{reorder_s} seconds")
    rows = rows.filter(t.isNotNull()).select(
        c(key).cast("string").alias("key"), (t - F.pmod(t, F.lit(block))).alias("block"), t.alias("t"), F.coalesce(c(sequence).cast("bigint"), F.lit(-1)).alias("seq"),
        F.coalesce(micros(F.col("__arrival")), F.lit(NEVER)).alias("arrival"), F.col("__v").alias("v"), F.col("__ok").cast("tinyint").alias("ok"),
        F.lit("2262-01-01 00:00:00").cast("timestamp").alias("never_late", metadata=MARK),
    )

    def step(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, told = (np.frombuffer(x, kind) for x, kind in zip(state.get, (BUFFER, np.int64))) if state.exists else (np.empty(0, BUFFER), np.empty(0, np.int64))
        new = np.empty(0, BUFFER)
        if not state.hasTimedOut:
            p = pd.concat([x[list(BUFFER.names)] for x in parts])
            new = np.empty(len(p), BUFFER)
            for x in BUFFER.names:
                new[x] = p[x].to_numpy()
        now = state.getCurrentWatermarkMs()
        held, told, out, due = advance(held, told, new, now * 1000, length, slack, grace)
        if due is None:
            if state.exists:
                state.remove()
        else:
            state.update((held.tobytes(), told.astype(np.int64).tobytes()))
            state.setTimeoutTimestamp(max(-(-due // 1000), now + 1))
        if out:
            rows = pd.concat(out, ignore_index=True).reindex(columns=NAMES)
            rows["key"] = k[0]
            yield rows.fillna({x: 0 for x in NAMES if x[0] == "n"})

    return rows.groupBy("key", "block").applyInPandasWithState(step, OUT, "buffer binary, told binary", "update", GroupStateTimeout.EventTimeTimeout)
