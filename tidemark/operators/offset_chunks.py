"""Per-key results without imbalance: exact offset chunking.

1. The rows are put in order of (key, order columns) over range partitions. The bounds come from the whole sort key, so
   a hot key covers as many partitions as its share of rows asks for. The partitions are written to the shared folder,
   each row with its partition and its place in it.
2. Rows are counted per (partition, key), and a prefix sum over the partitions gives, for each of them, how many rows
   of the key lie in earlier partitions. That table has one row per key and one more per partition boundary inside a key.
3. Offset plus place is the row's exact number within its key; number div ``chunk_rows`` is its chunk. No chunk is
   larger than ``chunk_rows``, whatever the skew.
4. Each (key, chunk) is processed by itself, by window and hash aggregation, and gives one state: mergeable sums, and
   the chunk's first and last row.
5. The states of a key, in chunk order, are merged: sums add up, and what depends on two neighbouring rows gets the
   term across each boundary from the last row of one chunk and the first of the next. States are fewer than rows by
   the factor ``chunk_rows``.

Defined results: a null key is a key of its own; rows with a null order column come first; ties in all order columns
are put in order of the remaining columns' hash, so the results depend on the rows only, except among exact copies,
which are alike; a null value takes part in counts of rows but not in sums or comparisons; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import c
from tidemark.session import partitions, staged

#: Rows of a chunk: small enough for one task's sort buffer, large enough that states are few.
CHUNK_ROWS = 50_000


def number_rows(df: DataFrame, keys: list[str], order: list[str], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """df (its columns renamed k0.., o0.., v0.. by position) with ``number``, from 0 within each key, and ``chunk``."""
    rest = [x for x in df.columns if x not in keys and x not in order]
    ks, os, vs = ([f"{p}{i}" for i in range(len(xs))] for p, xs in (("k", keys), ("o", order), ("v", rest)))
    flat = df.select(*(c(x).alias(y) for x, y in zip([*keys, *order, *rest], [*ks, *os, *vs])))
    tie = F.xxhash64(*os, *vs) if os or vs else F.lit(0).cast("bigint")
    # exact copies of one row may outgrow a partition: the place in the input parts them
    flat = flat.withColumn("tie", tie).withColumn("place", F.monotonically_increasing_id())
    by = [*ks, *os, "tie", "place"]
    put = (
        flat.repartitionByRange(partitions(df), *by)
        .sortWithinPartitions(*by)
        .drop("tie", "place")
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("pid", F.shiftright("at", 33).cast("int"))
        .withColumn("at", F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
    )
    put = staged(put, "ordered")
    counts = put.groupBy("pid", *ks).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("start"))
    earlier = Window.partitionBy(*ks).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per (partition, key); written, so that the planner sees its size and broadcasts it only if it is small
    offsets = staged(
        counts.select("pid", *(F.col(k).alias(f"j{k}") for k in ks), (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("start")).alias("shift")),
        "offsets",
    ).withColumnRenamed("pid", "jpid")
    on = F.col("pid") == F.col("jpid")
    for k in ks:
        on = on & F.col(k).eqNullSafe(F.col(f"j{k}"))
    number = F.col("at") + F.col("shift")
    return put.join(offsets, on).select(*ks, *os, *vs, number.alias("number"), F.floor(number / chunk_rows).alias("chunk"))


def balanced_results(df: DataFrame, keys: list[str], order: list[str], value: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Per key of df: rows, and of value, in order: sum, least, greatest, first, last, rises, falls and the longest step of order[0].

    rises and falls count the rows whose value is above or below that of the row just before; order[0] must be a bigint
    (say, microseconds); longest_step is its greatest distance between neighbouring rows.
    """
    order = [*order, value] if value not in order else order  # rows alike in all of these may change places: nothing shows it
    rows = number_rows(df.select(*map(c, dict.fromkeys([*keys, *order]))), keys, order, chunk_rows)
    ks = [f"k{i}" for i in range(len(keys))]
    v = f"o{order.index(value)}"

    def neighbours(ahead: Column, prev: Column, t: Column, prev_t: Column) -> dict[str, Column]:
        return {"rises": F.when(ahead > prev, 1).otherwise(0), "falls": F.when(ahead < prev, 1).otherwise(0), "step": t - prev_t}

    inside = Window.partitionBy(*ks, "chunk").orderBy("number")
    near = neighbours(F.col(v), F.lag(v).over(inside), F.col("o0"), F.lag("o0").over(inside))
    edge = lambda f: f(F.struct(F.col(v).alias("v"), F.col("o0").alias("t")), F.col("number"))
    states = (
        rows.withColumns(near)
        .groupBy(*ks, "chunk")
        .agg(
            F.count(F.lit(1)).alias("n"), F.sum(v).alias("sum"), F.min(v).alias("least"), F.max(v).alias("greatest"),
            F.sum("rises").alias("rises"), F.sum("falls").alias("falls"), F.max("step").alias("step"),
            edge(F.min_by).alias("head"), edge(F.max_by).alias("tail"),
        )
    )
    across = Window.partitionBy(*ks).orderBy("chunk")
    before = F.lag("tail").over(across)
    joint = neighbours(F.col("head.v"), before["v"], F.col("head.t"), before["t"])
    merged = states.withColumns({f"b_{k}": x for k, x in joint.items()}).groupBy(*ks)
    out = merged.agg(
        F.sum("n").alias("n_rows"), F.sum("sum").alias("total"), F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        F.min_by("head.v", "chunk").alias("first_value"), F.max_by("tail.v", "chunk").alias("last_value"),
        F.sum(F.col("rises") + F.col("b_rises")).alias("rises"), F.sum(F.col("falls") + F.col("b_falls")).alias("falls"),
        F.max(F.greatest("step", "b_step")).alias("longest_step"), F.count(F.lit(1)).alias("n_chunks"),
    )
    taken = [x for x in out.columns if x not in ks]
    names = [x + "_" if x in taken else x for x in keys]
    return out.select(*(F.col(k).alias(x) for k, x in zip(ks, names)), *taken)
