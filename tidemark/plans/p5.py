"""Differences between two copies of data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.reconcile import differing, field_differences, latest
from tidemark.session import staged
from tidemark.sources.tables import table

KEYS = ["symbol", "price_date"]
FIELDS = ["composite_figi", "open_price", "high_price", "low_price", "close_price", "volume", "vwap"]


def _copies(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The latest rows of both copies, keyed by the trimmed, upper-case symbol and the date."""
    out = []
    for name, date, version in (("gold_daily_rollup", "event_date", "updated_at"), ("batch_daily_prices", "price_date", "loaded_at")):
        df = table(spark, sf_dir, name).select(F.upper(F.trim("symbol")).alias("symbol"), F.col(date).alias("price_date"), *FIELDS, F.col(version).alias("version"))
        out.append(latest(df, KEYS, ["version"]).drop("version"))
    return out[0], out[1]


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows missing on a side, fields that differ, and roll-up rows with a bar of another FIGI."""
    rollup, batch = (staged(x, "copy") for x in _copies(spark, sf_dir))
    prices = field_differences(differing(rollup, batch, KEYS, FIELDS), KEYS, FIELDS, missing=("missing_in_rollup", "missing_in_batch"))
    bars = (
        table(spark, sf_dir, "gold_minute_bars").filter("composite_figi is not null")
        .select(F.upper(F.trim("symbol")).alias("symbol"), F.col("event_date").alias("price_date"), "composite_figi").distinct()
    )
    # bars cover few of the roll-up's days: only keys on both sides are compared, so that the copies are alike but for what is wrong
    bars = staged(bars.join(rollup.select(*KEYS), KEYS, "left_semi"), "bars")
    covered = staged(rollup.select(*KEYS, "composite_figi").join(bars.select(*KEYS).distinct(), KEYS, "left_semi"), "covered")
    figi = differing(covered, bars, KEYS, ["composite_figi"]).filter("side = 1").select(*KEYS).distinct().withColumn("finding", F.lit("bar_figi"))
    return prices.unionByName(figi).select("symbol", F.col("price_date").cast("string").alias("price_date"), "finding")


QUERIES = {"p5_found": p5_found}

_SIDES = ", ".join(
    f"""{alias} AS (SELECT upper(trim(symbol)) AS symbol, {date} AS price_date, {", ".join(FIELDS)} FROM {name}
      QUALIFY row_number() OVER (PARTITION BY upper(trim(symbol)), {date} ORDER BY {version} DESC NULLS LAST) = 1)"""
    for alias, name, date, version in (("r", "gold_daily_rollup", "event_date", "updated_at"), ("b", "batch_daily_prices", "price_date", "loaded_at"))
)
_FIELDS_SQL = " UNION ALL ".join(
    f"SELECT r.symbol, r.price_date, '{x}' AS finding FROM r JOIN b USING (symbol, price_date) WHERE "
    + (f"r.{x} IS DISTINCT FROM b.{x}" if x == "composite_figi" else f"(r.{x} IS NULL) <> (b.{x} IS NULL) OR abs(r.{x} - b.{x}) > 0.0001")
    for x in FIELDS
)

SQL = {
    "p5_found": f"""
        WITH {_SIDES}, f AS ({_FIELDS_SQL}
          UNION ALL SELECT symbol, price_date, 'missing_in_batch' FROM r ANTI JOIN b USING (symbol, price_date)
          UNION ALL SELECT symbol, price_date, 'missing_in_rollup' FROM b ANTI JOIN r USING (symbol, price_date)
          UNION ALL SELECT DISTINCT r.symbol, r.price_date, 'bar_figi' FROM r JOIN gold_minute_bars m
            ON upper(trim(m.symbol)) = r.symbol AND m.event_date = r.price_date
            WHERE m.composite_figi IS NOT NULL AND m.composite_figi IS DISTINCT FROM r.composite_figi)
        SELECT symbol, CAST(price_date AS VARCHAR) AS price_date, finding FROM f""",
}
