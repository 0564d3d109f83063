"""Percentiles of very large numeric columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.quantiles import ranked_counts
from tidemark.operators.tail_sketch import merge_sketches, percentiles, sketches
from tidemark.session import staged
from tidemark.sources.tables import table

PERCENTILES = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 0.999]


def values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """metric, grp, session_date, v of the three columns."""
    parts = [
        table(spark, sf_dir, t).select(F.lit(f"{t}.{v}").alias("metric"), F.col(g).alias("grp"), F.col(d).cast("date").alias("session_date"), F.col(v).cast("double").alias("v"))
        for t, g, d, v in (
            ("silver_trades", "symbol", "trade_date", "trade_size"),
            ("silver_quotes", "symbol", "quote_date", "bid_price"),
            ("pipeline_batch_metrics", "layer", "started_at", "duration_ms"),
        )
    ]
    return reduce(DataFrame.unionAll, parts)


def day_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """metric, grp, session_date, sketch."""
    return sketches(values(spark, sf_dir), ["metric", "grp", "session_date"], "v")


def p7_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles per group and day, and, of the days' sketches combined, per group over all days (session_date 'all')."""
    days = staged(day_sketches(spark, sf_dir), "sketches")
    every = merge_sketches(days, ["metric", "grp"])
    text = lambda df, d: percentiles(df, PERCENTILES).select("metric", "grp", d.alias("session_date"), "n", "p", "value", "rank_bound")
    return text(days, F.col("session_date").cast("string")).unionAll(text(every, F.lit("all")))


def _within(spark: SparkSession, sf_dir: str, keys: list[str]) -> DataFrame:
    """keys, p and whether the rank of the percentile found lies within its bound, by exact ranks of all values.

    A percentile is one of the values, so it finds its ranks by equality, and no group is worked on by one task.
    """
    days = staged(day_sketches(spark, sf_dir), "sketches")
    found = percentiles(days if "session_date" in keys else merge_sketches(days, keys), PERCENTILES)
    found = staged(found.select(*(F.col(k).alias(f"f{i}") for i, k in enumerate(keys)), F.col("n").alias("fn"), "p", "value", "rank_bound"), "percentiles")
    flat = values(spark, sf_dir).filter("v is not null and not isnan(v)").groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("n"))
    ranks = ranked_counts(flat, keys)
    on = F.col("v") == F.col("value")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"f{i}"))
    share, slack = F.col("p") * F.col("total"), F.col("rank_bound") * F.col("total") + 1
    held = (F.col("fn") == F.col("total")) & (F.col("upto") - F.col("n") <= share + slack) & (F.col("upto") >= share - slack)
    return found.join(ranks, on, "left").select(*(F.col(f"f{i}").alias(k) for i, k in enumerate(keys)), "p", F.coalesce(held, F.lit(False)).alias("within"))


def p7_within_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The percentiles of all days, from the days' sketches combined, against exact ranks."""
    return _within(spark, sf_dir, ["metric", "grp"])


def p7_days_within_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The percentiles of each day against exact ranks."""
    return _within(spark, sf_dir, ["metric", "grp", "session_date"]).withColumn("session_date", F.col("session_date").cast("string"))


QUERIES = {f.__name__: f for f in (p7_percentiles, p7_within_bound, p7_days_within_bound)}

#: p7_percentiles has none: sketches aren't SQL (its rows are held against exact ranks by the other two; tests: brute force).
_GROUPS = """
        WITH v AS (SELECT 'silver_trades.trade_size' AS metric, symbol AS grp, trade_date AS session_date FROM silver_trades WHERE trade_size IS NOT NULL
          UNION ALL SELECT 'silver_quotes.bid_price', symbol, quote_date FROM silver_quotes WHERE bid_price IS NOT NULL AND NOT isnan(bid_price)
          UNION ALL SELECT 'pipeline_batch_metrics.duration_ms', layer, CAST(started_at AS DATE) FROM pipeline_batch_metrics WHERE duration_ms IS NOT NULL)"""

SQL = {
    "p7_within_bound": f"""{_GROUPS}
        SELECT metric, grp, p, TRUE AS within FROM (SELECT DISTINCT metric, grp FROM v), (SELECT unnest({PERCENTILES}) AS p)""",
    "p7_days_within_bound": f"""{_GROUPS}
        SELECT metric, grp, CAST(session_date AS VARCHAR) AS session_date, p, TRUE AS within FROM (SELECT DISTINCT metric, grp, session_date FROM v), (SELECT unnest({PERCENTILES}) AS p)""",
}
