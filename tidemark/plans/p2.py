"""Irregular readings onto a regular grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import micros, stamp
from tidemark.operators.regular_grid import CHOICES, regular_grid
from tidemark.session import staged
from tidemark.sources.tables import table


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars, sessions = table(spark, sf_dir, "gold_minute_bars"), table(spark, sf_dir, "trading_sessions")
    tie = micros(F.col("silver_timestamp"))
    return regular_grid(bars, sessions, "symbol", "window_start", "close_price", "session_date", "open_utc", "close_utc", tie=tie)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minutes without a usable close: those the grid has filled or marked."""
    return _grid(spark, sf_dir).filter("filled").select(F.col("source").alias("symbol"), stamp(F.col("period_start")).alias("window_start"))


def p2_minute_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One close per symbol, session and minute; filled ones are marked, and so are series whose filling didn't converge."""
    return _grid(spark, sf_dir).select(
        F.col("source").alias("symbol"), F.col("session").alias("session_date"), stamp(F.col("period_start")).alias("window_start"),
        F.col("value").alias("close_price"), "filled", "converged",
    )


def p2_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every minute of the series: the given close as it stands in the result, or null, and whether the result has a number there; a series without one has none."""
    out = _grid(spark, sf_dir)
    v = F.col("value")
    return out.select(
        F.col("source").alias("symbol"), stamp(F.col("period_start")).alias("window_start"), F.when(~F.col("filled"), v).alias("given"),
        (v.isNotNull() & ~F.isnan(v)).alias("has_value"), "converged",
    )


#: The share of minutes whose closes p2_error holds out, by a hash that SQL has too.
HELD = 0.05


def p2_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closes held out and filled: how many, the mean relative error of straight lines, and whether that of the operator is at most a tenth greater."""
    bars, sessions = table(spark, sf_dir, "gold_minute_bars"), table(spark, sf_dir, "trading_sessions")
    minute = F.date_trunc("minute", "window_start").cast("timestamp_ntz")
    draw = F.conv(F.substring(F.md5(F.concat_ws("|", "symbol", stamp(minute))), 1, 6), 16, 10).cast("double") / (1 << 24)
    shown = bars.withColumn("close_price", F.when(~(draw < HELD), F.col("close_price")))
    tie = micros(F.col("silver_timestamp"))
    args = ("symbol", "window_start", "close_price", "session_date", "open_utc", "close_utc")
    whole, part = (staged(regular_grid(x, sessions, *args, tie=tie, choices=ch), "grid") for x, ch in ((bars, ((2, 1),)), (shown, CHOICES)))
    truth = whole.filter("not filled").select("source", "session", "period_start", F.col("value").alias("actual"))
    both = part.join(truth, ["source", "session", "period_start"], "left").withColumn("given", F.when(~F.col("filled"), F.col("value")))
    # a session's minutes at most
    w = Window.partitionBy("source", "session").orderBy("period_start")
    at = micros(F.col("period_start"))
    have = F.when(F.col("given").isNotNull(), F.struct(at.alias("t"), F.col("given").alias("v")))
    both = both.withColumns({"p": F.last(have, ignorenulls=True).over(w), "q": F.first(have, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))})
    line = F.col("p.v") + (F.col("q.v") - F.col("p.v")) * (at - F.col("p.t")) / (F.col("q.t") - F.col("p.t"))
    held = both.filter("filled and actual is not null and p is not null and q is not null")
    err = lambda x: F.avg(F.abs(x - F.col("actual")) / F.col("actual"))
    out = held.agg(F.count(F.lit(1)).alias("n_held"), err(line).alias("l"), err(F.col("value")).alias("s"))
    return out.select("n_held", F.round("l", 8).alias("line_error"), (F.col("s") <= F.col("l") * 1.1).alias("no_worse"))


QUERIES = {f.__name__: f for f in (p2_found, p2_minute_series, p2_kept, p2_error)}

#: The minutes of all series, and the last usable close of each minute that has one.
_GRID = """
        b AS (SELECT b.symbol, b.silver_timestamp, b.window_start, s.open_utc, s.close_utc, b.close_price, date_diff('minute', s.open_utc, date_trunc('minute', b.window_start)) AS i
          FROM gold_minute_bars b JOIN trading_sessions s ON b.window_start >= s.open_utc AND b.window_start < s.close_utc),
        g AS (SELECT DISTINCT symbol, open_utc, close_utc FROM b),
        m AS (SELECT symbol, open_utc, unnest(range(0, CAST(date_diff('minute', open_utc, close_utc) AS BIGINT))) AS i FROM g),
        v AS (SELECT symbol, open_utc, i, close_price AS given FROM b WHERE close_price > 0 AND NOT isnan(close_price)
          QUALIFY row_number() OVER (PARTITION BY symbol, open_utc, i ORDER BY window_start DESC, silver_timestamp DESC NULLS LAST, close_price DESC) = 1),
        y AS (SELECT m.*, m.open_utc + to_minutes(m.i) AS w, given FROM m LEFT JOIN v ON m.symbol IS NOT DISTINCT FROM v.symbol AND m.open_utc = v.open_utc AND m.i = v.i)"""

#: p2_minute_series has none: SQL has no singular vectors (p2_kept and p2_error hold its rows against SQL; tests: brute force).
SQL = {
    "p2_found": """
        WITH b AS (
          SELECT b.symbol, s.open_utc, s.close_utc, b.close_price, date_diff('minute', s.open_utc, b.window_start) AS i
          FROM gold_minute_bars b JOIN trading_sessions s ON b.window_start >= s.open_utc AND b.window_start < s.close_utc),
        g AS (SELECT DISTINCT symbol, open_utc, close_utc FROM b),
        m AS (SELECT symbol, open_utc, unnest(range(0, CAST(date_diff('minute', open_utc, close_utc) AS BIGINT))) AS i FROM g)
        SELECT m.symbol, strftime(m.open_utc + to_minutes(m.i), '%Y-%m-%d %H:%M:%S') AS window_start
        FROM m WHERE (m.symbol, m.open_utc, m.i) NOT IN (
          SELECT symbol, open_utc, i FROM b WHERE close_price > 0 AND NOT isnan(close_price) AND symbol IS NOT NULL)""",
    "p2_kept": f"""
        WITH {_GRID}
        SELECT symbol, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, given, count(given) OVER (PARTITION BY symbol, open_utc) > 0 AS has_value, TRUE AS converged FROM y""",
    "p2_error": f"""
        WITH {_GRID},
        d AS (SELECT *, CASE WHEN CAST('0x' || substr(md5(concat_ws('|', symbol, strftime(w, '%Y-%m-%d %H:%M:%S'))), 1, 6) AS BIGINT) / 16777216.0 < {HELD} THEN NULL ELSE given END AS shown FROM y),
        n AS (SELECT *, max(CASE WHEN shown IS NOT NULL THEN i END) OVER o AS pi, min(CASE WHEN shown IS NOT NULL THEN i END) OVER (PARTITION BY symbol, open_utc ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS qi
          FROM d WINDOW o AS (PARTITION BY symbol, open_utc ORDER BY i)),
        e AS (SELECT n.given AS t, p.shown + (q.shown - p.shown) * (n.i - n.pi) / (n.qi - n.pi) AS l FROM n
          JOIN d p ON p.symbol IS NOT DISTINCT FROM n.symbol AND p.open_utc = n.open_utc AND p.i = n.pi JOIN d q ON q.symbol IS NOT DISTINCT FROM n.symbol AND q.open_utc = n.open_utc AND q.i = n.qi
          WHERE n.given IS NOT NULL AND n.shown IS NULL)
        SELECT count(*) AS n_held, round(avg(abs(l - t) / t), 8) AS line_error, TRUE AS no_worse FROM e""",
}
