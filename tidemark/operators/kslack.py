"""Late and out-of-order events: K-slack reordering of a recorded stream.

Every period (a minute, say) has a buffer. An event waits in the buffer of its period until the clock, that is the arrival
time, has passed the period's end by the lateness bound ``slack_s``. Then the buffer is released: its events leave it in
order of event time for the final, order-sensitive aggregation. ``grace_s`` after the period's end the aggregates of what
the buffer holds by then are published as provisional. So an event
- that arrives within the grace is in the provisional and in the final values,
- that arrives later but within the bound amends the provisional values,
- that arrives beyond the bound is rejected: it is counted, and changes no value.

The operator replays a recorded stream, whose arrival times say where the clock stood, so all buffers are worked on at
once: events are deduplicated, put in the order of release by range partitions of (key, period, time, sequence), and
aggregated in one ordered pass over each partition (Arrow batches). A batch gives one piece per period it touches; pieces
of one period, in order, are merged, with the term across each joint. Range bounds are taken from the whole sort key, so
neither a hot key nor a hot period makes a large partition. ``tidemark.streaming.kslack`` runs the same rule on a live stream.

Defined results: of rows with one (key, event time, sequence) the first to arrive counts (ties: the least values); rows
that ``valid`` doesn't hold for, or with a null event time, belong to no period; a null arrival time counts as beyond the
bound; a null key is a key of its own; an empty table gives an empty result. Columns not named are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import c, micros
from tidemark.session import partitions

NEVER = (1 << 63) - 1
VARIANTS = ("prov", "final")


def _schema(n: int, ranged: list[int], ordered: list[int]) -> list[tuple[str, str]]:
    out = [("key", "string"), ("period", "bigint"), ("ord", "bigint"), ("n_amended", "bigint"), ("n_rejected", "bigint")]
    for v in VARIANTS:
        out += [(f"{v}_n", "bigint"), (f"{v}_t0", "bigint"), (f"{v}_t1", "bigint")]
        out += [(f"{v}_sum{i}", "double") for i in range(n)]
        out += [(f"{v}_{s}{i}", "double") for i in ranged for s in ("min", "max")]
        out += [(f"{v}_{s}{i}", "double") for i in ordered for s in ("open", "close", "area")]
    return out


def _released(n: int, ranged: list[int], ordered: list[int], slack: int, grace: int, length: int):
    """Maps sorted events to pieces: one for each run of (key, period) in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            key, period, t, arrival, ord_ = b.column(0), *(b.column(i).to_numpy() for i in (1, 2, 3, 4))
            code = key.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            new = np.r_[True, (code[1:] != code[:-1]) | (period[1:] != period[:-1])]
            starts, piece = np.flatnonzero(new), np.cumsum(new) - 1
            m = [b.column(5 + i).to_numpy(zero_copy_only=False).astype(float) for i in range(n)]
            end = period + length
            in_time, kept = arrival <= end + grace, arrival <= end + slack
            out: dict[str, np.ndarray | pa.Array] = {"key": key.take(pa.array(starts)), "period": period[starts], "ord": ord_[starts]}
            out["n_amended"] = np.add.reduceat((kept & ~in_time).astype(np.int64), starts)
            out["n_rejected"] = np.add.reduceat((~kept).astype(np.int64), starts)
            for v, mask in zip(VARIANTS, (in_time, kept)):
                at = np.flatnonzero(mask)
                p = piece[at]
                first = np.flatnonzero(np.r_[True, p[1:] != p[:-1]]) if len(p) else np.array([], int)
                last = np.r_[first[1:], len(p)] - 1 if len(p) else first
                have = p[first]
                empty = np.ones(len(starts), bool)
                empty[have] = False

                def put(x: np.ndarray, kind, have=have, empty=empty) -> pa.Array:
                    full = np.zeros(len(empty), kind)
                    full[have] = x
                    return pa.array(full, mask=empty)

                tt = t[at]
                count = np.zeros(len(starts), np.int64)
                count[have] = last - first + 1
                out[f"{v}_n"] = count
                out[f"{v}_t0"], out[f"{v}_t1"] = put(tt[first], np.int64), put(tt[last], np.int64)
                for i in range(n):
                    x = m[i][at]
                    out[f"{v}_sum{i}"] = put(np.add.reduceat(x, first) if len(p) else x, float)
                for i in ranged:
                    x = m[i][at]
                    out[f"{v}_min{i}"] = put(np.minimum.reduceat(x, first) if len(p) else x, float)
                    out[f"{v}_max{i}"] = put(np.maximum.reduceat(x, first) if len(p) else x, float)
                for i in ordered:
                    x = m[i][at]
                    area = np.r_[x[:-1] * np.diff(tt), 0.0] if len(p) else x
                    area[last] = 0.0  # the step to the next event of another piece is added when pieces are merged
                    out[f"{v}_open{i}"], out[f"{v}_close{i}"] = put(x[first], float), put(x[last], float)
                    out[f"{v}_area{i}"] = put(np.add.reduceat(area, first) if len(p) else area, float)
            names = [k for k, _ in _schema(n, ranged, ordered)]
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in (out[k] for k in names)], names=names)

    return run


def _joint(close: str) -> Callable[[Column, Column], Column]:
    """The area between the last event of a piece and the first of the next."""
    return lambda a, b: a[close] * (b["t0"] - a["t1"])


def kslack(
    df: DataFrame, key: str, event_time: str, arrival: str, sequence: str, measures: dict[str, Column], valid: Column,
    ranged: tuple[str, ...] = (), ordered: tuple[str, ...] = (), slack_s: int = 3600, grace_s: int = 120, period_s: int = 60, inputs: tuple[str, ...] | None = None,
) -> DataFrame:
    """Provisional and final aggregates per (key, period), with the events that amended or were rejected.

    inputs: the columns of df that the measures are made of. If given, these are moved, and measures worked out where events
    are in order; else the measures are moved.

    Columns: key, period (microseconds), n_amended, n_rejected, and for v in prov, final: v_n; v_avg_x of every measure;
    v_min_x, v_max_x of the ranged; v_open_x, v_close_x and v_twa_x, the average weighted by the time until the next
    event or the period's end, of the ordered ones.
    """
    names = list(measures)
    n, length = len(names), period_s * 1_000_000
    r_at, o_at = [names.index(x) for x in ranged], [names.index(x) for x in ordered]
    event = df.withColumn("__valid", F.coalesce(valid, F.lit(False)))
    if inputs is None:
        event = event.withColumns({f"__m{i}": m.cast("double") for i, m in enumerate(measures.values())})
        moved, measured = [f"__m{i}" for i in range(n)], [F.col(f"__m{i}") for i in range(n)]
    else:
        moved, measured = list(inputs), [m.cast("double").alias(f"__m{i}") for i, m in enumerate(measures.values())]
    event = event.select(
        c(key).alias("__key"), micros(c(event_time)).alias("__t"), c(sequence).alias("__seq"),
        F.coalesce(micros(c(arrival)), F.lit(NEVER)).alias("__arrival"), "__valid", *map(c, moved),
    )
    # combined before the exchange, so a row repeated any number of times stays small
    first = (
        event.filter("__t is not null")
        .groupBy("__key", "__t", "__seq")
        .agg(F.min(F.struct("__arrival", "__valid", *map(c, moved))).alias("__e"))
        .filter("__e.__valid")
        .withColumn("__period", F.col("__t") - F.pmod("__t", F.lit(length)))
    )
    by = ["__key", "__period", "__t", "__seq"]
    released = (
        first.select(*by, "__e.__arrival", *(F.col("__e").getField(x).alias(x) for x in moved))
        .repartitionByRange(partitions(df), *by)
        .sortWithinPartitions(*by)
        .select("__key", "__period", "__t", "__arrival", F.monotonically_increasing_id().alias("__ord"), *map(c, moved))
        .select("__key", "__period", "__t", "__arrival", "__ord", *measured)
    )
    schema = _schema(n, r_at, o_at)
    pieces = released.mapInArrow(
        _released(n, r_at, o_at, slack_s * 1_000_000, grace_s * 1_000_000, length), ", ".join(f"{k} {t}" for k, t in schema)
    )
    aggs = [F.sum("n_amended").alias("n_amended"), F.sum("n_rejected").alias("n_rejected")]
    for v in VARIANTS:
        has = F.col(f"{v}_n") > 0
        aggs += [F.sum(f"{v}_n").alias(f"{v}_n"), F.min(f"{v}_t0").alias(f"{v}_t0"), F.max(f"{v}_t1").alias(f"{v}_t1")]
        aggs += [F.sum(f"{v}_sum{i}").alias(f"{v}_sum{i}") for i in range(n)]
        aggs += [f(f"{v}_{s}{i}").alias(f"{v}_{s}{i}") for i in r_at for s, f in (("min", F.min), ("max", F.max))]
        for i in o_at:
            aggs += [
                F.min_by(f"{v}_open{i}", F.when(has, F.col("ord"))).alias(f"{v}_open{i}"),
                F.max_by(f"{v}_close{i}", F.when(has, F.col("ord"))).alias(f"{v}_close{i}"),
                F.sum(f"{v}_area{i}").alias(f"{v}_area{i}"),
            ]
        # at most one entry per Arrow batch that the period reaches into
        ends = F.struct("ord", F.col(f"{v}_t0").alias("t0"), F.col(f"{v}_t1").alias("t1"), *(F.col(f"{v}_close{i}").alias(f"c{i}") for i in o_at))
        aggs.append(F.array_sort(F.collect_list(F.when(has, ends))).alias(f"{v}_ends"))
    merged = pieces.groupBy("key", "period").agg(*aggs)
    out = [F.col("key"), F.col("period"), F.col("n_amended"), F.col("n_rejected")]
    for v in VARIANTS:
        ends, size = F.col(f"{v}_ends"), F.size(f"{v}_ends")
        out.append(F.col(f"{v}_n"))
        out += [F.try_divide(F.col(f"{v}_sum{i}"), F.col(f"{v}_n")).alias(f"{v}_avg_{x}") for i, x in enumerate(names)]
        out += [F.col(f"{v}_{s}{i}").alias(f"{v}_{s}_{names[i]}") for i in r_at for s in ("min", "max")]
        for i in o_at:
            head, tail = (F.slice(ends, k, F.greatest(size - 1, F.lit(0))) for k in (1, 2))
            steps = F.zip_with(head, tail, _joint(f"c{i}"))
            area = F.col(f"{v}_area{i}") + F.aggregate(steps, F.lit(0.0), lambda s, x: s + x)
            stop = F.col("period") + length
            area = area + F.col(f"{v}_close{i}") * (stop - F.col(f"{v}_t1"))
            out += [F.col(f"{v}_{s}{i}").alias(f"{v}_{s}_{names[i]}") for s in ("open", "close")]
            out.append(F.try_divide(area, stop - F.col(f"{v}_t0")).alias(f"{v}_twa_{names[i]}"))
    return merged.select(*out).withColumnRenamed("key", key if key.lower() != "period" else "key")
