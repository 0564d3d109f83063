"""Mixing sources to target weights: Pfair scheduling of blocks.

The texts of a source, each exact text once, stand in a fixed random order and are repeated, pass after pass, at most as
often as its cap allows. This stream of tokens is cut into blocks. A source of weight w must get its i-th block (from 0)
into the slots between its release floor(i / w) and its deadline ceil((i + 1) / w); filling each slot with the released
block of the earliest deadline meets all deadlines, so at any point of the mix every source is less than one block away
from its share (and a text longer than a block is never cut, so a block may run over by the text it starts last).

Weights are exact fractions of the targets, never rounded, so a source doesn't drift from its target however long the mix.
They make the schedule periodic: it is worked out once for a period of at most ``FRAME`` slots (98 slots for shares of whole
per cent over 0.98; at most 10,000 for shares of up to four decimals that add up to at most 1), and the slot of any block
follows by arithmetic. A schedule of a longer period is worked out slot by slot as far as the mix goes, in one task that
holds one block of each source and sends the slots on as it goes: where the next block goes depends on all before it, so
that takes time in proportion to the number of blocks, some millions a minute, but no more memory than a few do.
Running sums of sizes are made in two steps, over hash buckets and inside them, so a source holding a
third of all texts is summed by many tasks.

The total is the largest for which every source can give its share within its cap, unless a smaller one is asked for; if a
larger one is asked for, short sources give all they have and the report shows it. A text is taken if more than half of
it lies within the quota, so the shares reached are off by half a text at most.

Defined results: sources compare after trimming and lower-casing; a source without texts gets nothing and the others share
its weight in proportion (the report shows both); texts of sources without a target, or without a source, are not used;
a text that occurs under several ids or sources is used under the least id among sources with a target, so that no text is
used more often than that source's cap; texts without tokens take part and have no size; empty tables give an empty mix.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import c
from tidemark.llm.tokens import normal_source
from tidemark.session import staged

#: Slots of the longest period that is kept as a table.
FRAME = 10_000
#: Texts of a hash bucket inside which running sums are made by one task.
BUCKET_ROWS = 50_000
#: Rows up to which a table made here (of sources, of a period's slots) is broadcast; beyond, it is joined as any other.
SMALL_ROWS = FRAME


def exact(x: float | Fraction) -> Fraction:
    """The weight a double stands for: the fraction of small numbers that reads as it, or else its decimals."""
    if isinstance(x, Fraction):
        return x
    near = Fraction(x).limit_denominator(FRAME)
    return near if float(near) == x else Fraction(repr(float(x)))


def proportions(shares: dict[str, float | Fraction]) -> dict[str, int]:
    """The shares above 0 as whole numbers without a common divisor, in order of source; their sum is the period."""
    weights = {s: exact(w) for s, w in sorted(shares.items()) if w > 0}
    whole = math.lcm(*(w.denominator for w in weights.values()))
    parts = {s: int(w * whole) for s, w in weights.items()}
    part = math.gcd(*parts.values()) if parts else 1
    return {s: n // part for s, n in parts.items()}


def slots(parts: dict[str, int]) -> Iterator[tuple[str, int, int]]:
    """(source, block, slot) for slot 0, 1, 2 and so on without end, by earliest deadline first."""
    h = sum(parts.values())
    waiting = [(0, -(-h // n), -n, s, 0) for s, n in parts.items()]
    heapq.heapify(waiting)
    ready: list = []
    for t in itertools.count():
        while waiting and waiting[0][0] <= t:
            heapq.heappush(ready, heapq.heappop(waiting)[1:])
        deadline, n, s, i = heapq.heappop(ready)
        if deadline <= t:
            raise AssertionError("a deadline was missed")
        yield s, i, t
        heapq.heappush(waiting, (max((i + 1) * h // -n, t + 1), -(-(i + 2) * h // -n), n, s, i + 1))


def period(shares: dict[str, float | Fraction]) -> dict[str, list[int]]:
    """For each source the slots of its blocks within one period."""
    parts = proportions(shares)
    out: dict[str, list[int]] = {s: [] for s in parts}
    for s, _, t in itertools.islice(slots(parts), sum(parts.values())):
        out[s].append(t)
    return out


def _scheduled(parts: dict[str, int], stop: int):
    """The slots before stop as rows of (source, i, slot), whatever comes in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                every = itertools.islice(slots(parts), stop)
                while rows := list(itertools.islice(every, FRAME)):
                    cols = [pa.array([r[j] for r in rows], kind) for j, kind in enumerate((pa.string(), pa.int64(), pa.int64()))]
                    yield pa.RecordBatch.from_arrays(cols, names=["source", "i", "slot"])

    return run


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= SMALL_ROWS else df


def mix(docs: DataFrame, targets: DataFrame, total_tokens: int | None = None, block_tokens: int = 2048, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """The mix and its report. docs: doc_id, text_key (equal for equal texts), source, n_tokens; targets: source, target_share, max_repeats.

    The mix, to be read by (slot, start_token): doc_id, source, repeat_no, slot, start_token, n_tokens.
    """
    spark = docs.sparkSession
    # one row per source of the mix, written by hand
    given = targets.groupBy(normal_source(c("source")).alias("s")).agg(F.collect_list(c("target_share").cast("double")), F.min("max_repeats")).collect()
    goals = {r[0]: (sum(map(exact, r[1]), Fraction(0)), r[2]) for r in given if r[0] is not None}
    once = (
        docs.withColumn("source", normal_source(c("source"))).filter(F.col("source").isin(list(goals)))
        .groupBy("text_key").agg(F.min(F.struct("doc_id", "source", "n_tokens")).alias("d")).select("d.*")
        .withColumn("h", F.xxhash64(F.lit(seed), "doc_id"))
    )
    once = staged(once, "texts")
    sizes = {r["source"]: (r["n"], r["t"]) for r in once.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("t")).collect()}
    have = {s: goals[s][0] for s, (_, t) in sizes.items() if t and goals[s][0] > 0 and goals[s][1] > 0}
    weight = {s: w / sum(have.values()) for s, w in have.items()}
    most = min((sizes[s][1] * goals[s][1] / float(w) for s, w in weight.items()), default=0)
    total = most if total_tokens is None else total_tokens
    rows = []
    for s, (share, cap) in sorted(goals.items()):
        n, t = sizes.get(s, (0, 0))
        quota = min(float(weight.get(s, 0.0)) * total, float(t * cap))
        rows.append((s, float(share), float(weight.get(s, 0.0)), int(cap), int(n), int(t), quota, math.ceil(quota / t) if t else 0))
    plan = spark.createDataFrame(rows, "source string, target_share double, weight double, max_repeats int, n_texts bigint, source_tokens bigint, quota double, passes int")
    parts = proportions(have)
    length = sum(parts.values())
    if length <= FRAME:
        cycle = [(s, i, t, len(x)) for s, x in period(have).items() for i, t in enumerate(x)]
        schedule = _small(spark.createDataFrame(cycle, "source string, i bigint, slot_in_period bigint, per_period bigint"), length)
    else:
        # the last block's deadline ends the mix
        stop = max(-(-(math.floor(r[6] / block_tokens) + 1) * length // parts[r[0]]) for r in rows if r[0] in parts)
        schedule = spark.range(0, 1, 1, 1).mapInArrow(_scheduled(parts, stop), "source string, i bigint, slot bigint")

    buckets = max(1, math.ceil(max((n for n, _ in sizes.values()), default=0) / BUCKET_ROWS))
    put = once.withColumn("bucket", F.floor((F.shiftrightunsigned("h", 8) / (1 << 56)) * buckets))
    sums = put.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("s"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = staged(sums.select("source", "bucket", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("offset")), "offsets")
    inside = Window.partitionBy("source", "bucket").orderBy(F.shiftrightunsigned("h", 8), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = put.withColumn("within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(sums, ["source", "bucket"])
    placed = placed.join(_small(plan.select("source", "source_tokens", "quota", "passes"), len(rows)), "source")
    # passes <= max_repeats
    used = (
        placed.filter("passes > 0").withColumn("repeat_no", F.explode(F.sequence(F.lit(1), F.col("passes"))))
        .withColumn("start_token", F.col("offset") + F.col("within") + (F.col("repeat_no") - 1) * F.col("source_tokens"))
        .filter("start_token + n_tokens div 2 < quota").withColumn("block", F.floor(F.col("start_token") / block_tokens))
    )
    if length <= FRAME:
        per = spark.createDataFrame(list(parts.items()), "source string, per_period bigint")
        timed = used.join(_small(per, len(parts)), "source").withColumn("i", F.pmod("block", "per_period")).drop("per_period")
        slot = F.floor(F.col("block") / F.col("per_period")) * length + F.col("slot_in_period")
    else:
        timed, slot = used.withColumn("i", F.col("block")), F.col("slot")
    timed = timed.join(schedule, ["source", "i"])
    out = timed.select("doc_id", "source", F.col("repeat_no").cast("int").alias("repeat_no"), slot.alias("slot"), "start_token", "n_tokens")
    got = out.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n_used"), F.max("repeat_no").alias("repeats"))
    whole = Window.partitionBy()  # a row per source
    report = plan.join(got, "source", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0).cast("bigint")))
    report = report.select(
        "source", "target_share", F.col("weight").alias("share_among_present"), F.try_divide("tokens", F.sum("tokens").over(whole)).alias("actual_share"),
        "tokens", F.coalesce("n_used", F.lit(0)).alias("n_used"), F.coalesce("repeats", F.lit(0)).alias("repeats"), "max_repeats", "n_texts", "source_tokens",
    )
    return out, report
