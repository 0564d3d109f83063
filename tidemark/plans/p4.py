"""A few keys holding most records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import micros
from tidemark.operators.offset_chunks import balanced_results
from tidemark.sources.tables import table

#: A symbol is hot if it holds more than this share of a table's rows on one date.
HOT_SHARE = 0.05


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of both tables, per date and symbol, in order of event time."""
    parts = []
    for name, day, price in (("silver_quotes", "quote_date", "bid_price"), ("silver_trades", "trade_date", "trade_price")):
        rows = table(spark, sf_dir, name).select(
            F.lit(name).alias("table_name"), F.col(day).alias("session_date"), "symbol",
            micros(F.col("sip_timestamp")).alias("t"), "sequence_number", F.col(price).alias("price"),
        )
        parts.append(rows)
    return balanced_results(reduce(DataFrame.unionAll, parts), ["table_name", "session_date", "symbol"], ["t", "sequence_number"], "price")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols with more than 5 % of the rows of a table on one date."""
    day = Window.partitionBy("table_name", "session_date")
    return (
        _results(spark, sf_dir)
        .withColumn("share", F.col("n_rows") / F.sum("n_rows").over(day))
        .filter(F.col("share") > HOT_SHARE)
        .select("table_name", F.col("session_date").cast("string").alias("session_date"), "symbol")
    )


def p4_symbol_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, first and last price, rises, falls and longest pause per table, date and symbol; copies count as delivered."""
    return _results(spark, sf_dir).select(
        "table_name", F.col("session_date").cast("string").alias("session_date"), "symbol", "n_rows",
        F.round(F.col("total") + 1e-5, 2).alias("total"), "least", "greatest", "first_value", "last_value", "rises", "falls", "longest_step",
    )


QUERIES = {f.__name__: f for f in (p4_found, p4_symbol_results)}

_ROWS = """
    SELECT 'silver_quotes' AS table_name, CAST(quote_date AS VARCHAR) AS session_date, symbol,
      epoch_us(sip_timestamp) AS t, sequence_number AS s, bid_price AS p FROM silver_quotes
    UNION ALL
    SELECT 'silver_trades', CAST(trade_date AS VARCHAR), symbol, epoch_us(sip_timestamp), sequence_number, trade_price FROM silver_trades"""

SQL = {
    "p4_found": f"""
        WITH r AS ({_ROWS}), n AS (SELECT table_name, session_date, symbol, count(*) AS n FROM r GROUP BY ALL)
        SELECT table_name, session_date, symbol FROM n
        QUALIFY n > {HOT_SHARE} * sum(n) OVER (PARTITION BY table_name, session_date)""",
    "p4_symbol_results": f"""
        WITH r AS ({_ROWS}), o AS (
          SELECT *, lag(p) OVER w AS q, t - lag(t) OVER w AS step, row_number() OVER w AS i FROM r
          WINDOW w AS (PARTITION BY table_name, session_date, symbol ORDER BY t NULLS FIRST, s NULLS FIRST, p NULLS FIRST))
        SELECT table_name, session_date, symbol, count(*) AS n_rows, round(sum(p) + 1e-5, 2) AS total, min(p) AS least, max(p) AS greatest,
          arg_min_null(p, i) AS first_value, arg_max_null(p, i) AS last_value,
          CAST(count(*) FILTER (p > q) AS BIGINT) AS rises, CAST(count(*) FILTER (p < q) AS BIGINT) AS falls, max(step) AS longest_step
        FROM o GROUP BY ALL""",
}
