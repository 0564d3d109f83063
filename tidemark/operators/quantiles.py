"""Exact percentiles per group, of any number of rows.

Equal values are counted before anything is moved; the counts are put in order of (group, value) over range partitions, so a
group of many values is ranked by many tasks, and prefix sums over the partitions give each value its ranks. Nothing holds
all values of a group.

Defined results: nulls and NaN have no rank; a group without any value gives no row; a null key is a key of its own; the
percentile at p lies at rank p * (n - 1), between two neighbours in proportion.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import c
from tidemark.session import partitions, staged


def ranked_counts(flat: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of keys, v and n, unique in (keys, v), with ``upto``, the rows of the group up to and with v, and ``total``, all of the group."""
    by = [*keys, "v"]
    put = flat.repartitionByRange(partitions(flat), *by).sortWithinPartitions(*by).withColumn("pid", F.spark_partition_id())
    put = staged(put, "ranked")
    each = Window.partitionBy(*keys)  # as many rows as partitions that hold the group
    earlier = each.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    sums = put.groupBy("pid", *keys).agg(F.sum("n").alias("s"))
    sums = sums.select(F.col("pid").alias("jpid"), *(F.col(k).alias(f"j{k}") for k in keys), F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("offset"), F.sum("s").over(each).alias("total"))
    on = F.col("pid") == F.col("jpid")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"j{k}"))
    inside = Window.partitionBy("pid", *keys).orderBy("v")
    return put.withColumn("within", F.sum("n").over(inside)).join(sums, on).select(*by, "n", (F.col("offset") + F.col("within")).alias("upto"), "total")


def exact_percentiles(df: DataFrame, keys: list[str], value: str, ps: dict[str, float]) -> DataFrame:
    """keys, and for each name in ps the percentile of value."""
    ks = [f"k{i}" for i in range(len(keys))]
    flat = df.select(*(c(x).alias(k) for x, k in zip(keys, ks)), c(value).cast("double").alias("v")).filter("v is not null and not isnan(v)")
    r = ranked_counts(flat.groupBy(*ks, "v").agg(F.count(F.lit(1)).alias("n")), ks)
    rank = lambda p, up: F.ceil(p * (F.col("total") - 1)) if up else F.floor(p * (F.col("total") - 1))
    at = [F.min(F.when(F.col("upto") > rank(F.lit(p), up), F.col("v"))).alias(f"q{i}{'hi' if up else 'lo'}") for i, p in enumerate(ps.values()) for up in (False, True)]
    out = r.groupBy(*ks).agg(F.max("total").alias("total"), *at)
    share = lambda p: p * (F.col("total") - 1) - F.floor(p * (F.col("total") - 1))
    cols = [(F.col(f"q{i}lo") + (F.col(f"q{i}hi") - F.col(f"q{i}lo")) * share(F.lit(p))).alias(x) for i, (x, p) in enumerate(ps.items())]
    return out.select(*(F.col(k).alias(x) for k, x in zip(ks, keys)), *cols)


def with_percentiles(totals: DataFrame, df: DataFrame, keys: list[str], value: str, ps: dict[str, float]) -> DataFrame:
    """totals, a row per group of df, with its percentiles; null keys match."""
    q = exact_percentiles(df, keys, value, ps)
    q = q.select(*(c(k).alias(f"__{k}") for k in keys), *ps)
    on = F.lit(True)
    for k in keys:
        on = on & c(k).eqNullSafe(F.col(f"`__{k}`"))
    return totals.join(q, on, "left").drop(*(f"__{k}" for k in keys))
