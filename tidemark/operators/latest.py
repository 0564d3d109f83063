"""The latest row of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import c


def keep_latest(df: DataFrame, keys: list[str], order: str = "kafka_offset") -> DataFrame:
    """One row per key: the greatest order column, ties going to the greatest other columns in table order.

    One aggregation that combines before the exchange; no window over all rows of a key.
    """
    rest = [x for x in df.columns if x not in keys and x != order]
    best = df.groupBy(*map(c, keys)).agg(F.max(F.struct(*map(c, [order, *rest]))).alias("__m"))
    return best.select(*map(c, keys), *(F.col("__m").getField(x).alias(x) for x in [order, *rest])).select(*map(c, df.columns))


def top_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key, the first by order; for a total order given as columns to be maximised."""
    named = [o.alias(f"o{i}") for i, o in enumerate(order)]
    best = df.groupBy(*map(c, keys)).agg(F.max_by(F.struct(*map(c, df.columns)), F.struct(*named)).alias("__m"))
    return best.select("__m.*")
