"""Every operator of the library over the test tables, with the SQL that checks it.

Floating-point results are rounded on both sides, dates and times are text, so that only values are compared.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import plain
from tidemark.operators import analytics as A
from tidemark.operators import bars as B
from tidemark.operators import ingest as I
from tidemark.operators.latest import keep_latest, top_per_key
from tidemark.operators.offset_chunks import number_rows
from tidemark.operators.quantiles import exact_percentiles, with_percentiles
from tidemark.operators.upsert import KeyedTable, merged
from tidemark.plans import market as M
from tidemark.session import scratch, staged
from tidemark.sources.catalog import create_tables, create_views, drop_database, load_table
from tidemark.sources.dimensions import on_date
from tidemark.sources.envelopes import read_envelopes, subscriptions, write_envelopes
from tidemark.sources.spillover import gaps, publish_or_spill, replay
from tidemark.sources.tables import table
from tidemark.streaming.medallion import BAR_KEYS, QUOTE_KEYS, TRADE_KEYS, bars_stream, daily_stream, log_stream, quote_stats_stream, quotes_stream, served_stream, trades_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Keeps rounding off exact halves, on which two engines' last bits decide.
NUDGE = 1e-9


def query(sql: str | None, *doubles: str, digits: int = 6, times: tuple[str, ...] = ()) -> Callable:
    """Registers a query and its SQL; doubles are rounded and times, and whole numbers that may be null, made text on both sides."""

    def put(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(spark, sf_dir)
            rounded = {x: F.round(F.col(x) + NUDGE, digits) + 0.0 for x in doubles}
            return plain(df.withColumns(rounded) if rounded else df, *times)

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = run
        if sql:
            change = [f"round({x} + {NUDGE}, {digits}) + 0.0 AS {x}" for x in doubles] + [f"CAST({x} AS VARCHAR) AS {x}" for x in times]
            head, _, body = sql.rpartition("=>")
            SQL[f.__name__] = f"{'WITH ' + head if head else ''} SELECT * {'REPLACE (' + ', '.join(change) + ')' if change else ''} FROM ({body})"
        return run

    return put


# ingest

_VALID = "CASE WHEN json_valid(raw_payload) THEN raw_payload END"


def _get(field: str, kind: str = "VARCHAR") -> str:
    return f"try_cast(json_extract_string({_VALID}, '$.{field}') AS {kind})"


def _time(field: str) -> str:
    x = _get(field, "BIGINT")
    return f"CASE WHEN {x} > 1000000000000000 THEN make_timestamp({x} // 1000) ELSE make_timestamp({x} * 1000) END"


@query(f"SELECT kafka_topic, kafka_partition, kafka_offset, raw_payload, json_extract_string({_VALID}, '$.ev') AS event_type FROM bronze")
def bronze_enrich(spark, sf):
    b = table(spark, sf, "bronze")
    kafka = b.select(F.col("raw_payload").cast("binary").alias("value"), F.col("kafka_topic").alias("topic"), F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"), F.col("kafka_timestamp").alias("timestamp"))
    return I.enrich_bronze(kafka).select("kafka_topic", "kafka_partition", "kafka_offset", "raw_payload", "event_type")


_BAR = f"""SELECT {_get("sym")} AS symbol, {_get("ev")} AS event_type, {_get("o", "DOUBLE")} AS open_price, {_get("h", "DOUBLE")} AS high_price, {_get("l", "DOUBLE")} AS low_price,
  {_get("c", "DOUBLE")} AS close_price, {_get("v", "BIGINT")} AS volume, {_get("vw", "DOUBLE")} AS vwap, {_get("n", "INT")} AS trade_count, {_time("s")} AS window_start, {_time("e")} AS window_end,
  kafka_topic, kafka_partition, kafka_offset FROM bronze WHERE kafka_topic = 'market.aggregates'"""
_BARS = f"parsed AS ({_BAR}), pbars AS (SELECT *, CAST(window_start AS DATE) AS event_date FROM parsed WHERE event_type = 'AM' AND symbol <> '' AND window_start IS NOT NULL)"


@query(f"{_BARS} => SELECT p.*, m.composite_figi FROM pbars p LEFT JOIN security_master m USING (symbol)", times=("window_start", "window_end", "event_date"))
def parse_minute_bars(spark, sf):
    return I.with_figi(I.parse_bars(table(spark, sf, "bronze")), table(spark, sf, "security_master"))


@query(
    f"""SELECT * FROM (SELECT {_get("sym")} AS symbol, {_get("i")} AS trade_id, {_get("p", "DOUBLE")} AS trade_price, {_get("s", "INT")} AS trade_size, {_get("q", "BIGINT")} AS sequence_number,
    {_time("t")} AS sip_timestamp, kafka_partition, kafka_offset FROM bronze WHERE kafka_topic = 'market.trades') WHERE symbol <> '' AND trade_id IS NOT NULL""",
    times=("sip_timestamp",),
)
def parse_trades(spark, sf):
    return I.parse_trades(table(spark, sf, "bronze")).select("symbol", "trade_id", "trade_price", "trade_size", "sequence_number", "sip_timestamp", "kafka_partition", "kafka_offset")


@query(
    f"""SELECT * FROM (SELECT {_get("sym")} AS symbol, {_get("bp", "DOUBLE")} AS bid_price, {_get("bs", "INT")} AS bid_size, {_get("ap", "DOUBLE")} AS ask_price, {_get("as", "INT")} AS ask_size,
    {_time("t")} AS sip_timestamp, {_get("q", "BIGINT")} AS sequence_number, kafka_partition, kafka_offset FROM bronze WHERE kafka_topic = 'market.quotes')
    WHERE symbol <> '' AND sip_timestamp IS NOT NULL AND bid_price IS NOT NULL AND ask_price IS NOT NULL""",
    times=("sip_timestamp",),
)
def parse_quotes(spark, sf):
    return I.parse_quotes(table(spark, sf, "bronze")).select("symbol", "bid_price", "bid_size", "ask_price", "ask_size", "sip_timestamp", "sequence_number", "kafka_partition", "kafka_offset")


@query(
    f"""SELECT CASE ev WHEN 'AM' THEN 'market.aggregates' WHEN 'A' THEN 'market.aggregates' WHEN 'T' THEN 'market.trades' WHEN 'Q' THEN 'market.quotes' END AS topic, sym AS key, count(*) AS n
    FROM (SELECT {_get("ev")} AS ev, {_get("sym")} AS sym FROM bronze) WHERE ev IN ('AM', 'A', 'T', 'Q') AND sym <> '' GROUP BY ALL"""
)
def route_events(spark, sf):
    return I.route(table(spark, sf, "bronze")).groupBy("topic", "key").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT t.symbol, m.composite_figi, count(*) AS n FROM silver_trades t LEFT JOIN security_master m USING (symbol) GROUP BY ALL")
def figi_enrich_left(spark, sf):
    return I.with_figi(table(spark, sf, "silver_trades").drop("composite_figi"), table(spark, sf, "security_master")).groupBy("symbol", "composite_figi").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT symbol FROM silver_quotes ANTI JOIN security_master USING (symbol)")
def missing_symbols(spark, sf):
    return I.missing_symbols(table(spark, sf, "silver_quotes"), table(spark, sf, "security_master"))


@query(
    """SELECT symbol, sip_timestamp, sequence_number, kafka_offset, bid_price, ask_price FROM silver_quotes
    QUALIFY row_number() OVER (PARTITION BY symbol, sip_timestamp, sequence_number ORDER BY kafka_offset DESC NULLS LAST, bid_price DESC NULLS LAST, ask_price DESC NULLS LAST) = 1""",
    times=("sip_timestamp",),
)
def dedup_keep_latest(spark, sf):
    df = table(spark, sf, "silver_quotes").select("symbol", "sip_timestamp", "sequence_number", "kafka_offset", "bid_price", "ask_price")
    return keep_latest(df, ["symbol", "sip_timestamp", "sequence_number"])


# serving tables

_DAY = ("event_date", "first_bar_start", "last_bar_start", "volume", "total_trades")


@query(f"{M.DOMAIN.daily} => SELECT * FROM daily", "vwap", times=_DAY)
def daily_ohlcv(spark, sf):
    return B.daily_bars(M.minute_bars(spark, sf))


@query(f"{M.EVENTS.daily} => SELECT * FROM daily", "vwap", times=_DAY)
def daily_ohlcv_of_hours(spark, sf):
    return B.daily_bars(M.hour_bars(spark, sf))


_QS = ("avg_bid_price", "avg_ask_price", "avg_spread_dollars", "avg_spread_bps", "min_spread_bps", "max_spread_bps", "avg_mid_price", "avg_bid_size", "avg_ask_size", "order_imbalance")
_GOOD = M.GOOD_QUOTE


@query(f"{M.QSTATS_SELECT} FROM silver_quotes WHERE {_GOOD} GROUP BY 1, 2, 3, 4", *_QS, times=("window_start", "quote_date"))
def quote_stats_minute(spark, sf):
    return B.quote_stats(table(spark, sf, "silver_quotes"))


@query(f"{M.HOUR_BARS} => {M.DAILY_SELECT} FROM bars WHERE event_date IN (SELECT event_date FROM bars WHERE symbol = 'purchase' AND high_price > 200) GROUP BY composite_figi, symbol, event_date", "vwap", times=_DAY)
def affected_date_recompute(spark, sf):
    bars = M.hour_bars(spark, sf)
    return B.daily_bars(B.affected_dates(bars, bars.filter("symbol = 'purchase' and high_price > 200"), "event_date"))


@query(
    f"""{M.QSTATS_SELECT} FROM silver_quotes WHERE {_GOOD} AND (quote_date, date_trunc('minute', sip_timestamp)) IN (
      SELECT (quote_date, date_trunc('minute', sip_timestamp)) FROM silver_quotes WHERE epoch_us(bronze_ingest_timestamp) - epoch_us(sip_timestamp) > 600000000) GROUP BY 1, 2, 3, 4""",
    *_QS, times=("window_start", "quote_date"),
)
def affected_window_recompute(spark, sf):
    q = table(spark, sf, "silver_quotes")
    late = q.filter(F.unix_micros(F.col("bronze_ingest_timestamp").cast("timestamp")) - F.unix_micros(F.col("sip_timestamp").cast("timestamp")) > 600_000_000)
    return B.quote_stats(B.affected_minutes(q, late, "sip_timestamp", "quote_date"))


@query(f"{M.DOMAIN.closes} => SELECT * FROM closes", times=("event_date", "session_last_bar"))
def session_close(spark, sf):
    return B.session_close(M.minute_bars(spark, sf))


@query(
    """SELECT coalesce(s.event_id, t.event_id) AS event_id, coalesce(s.value, t.value) AS value FROM events t
    FULL JOIN (SELECT CASE WHEN event_type = 'purchase' THEN -event_id - 1 ELSE event_id END AS event_id, value + 1 AS value FROM events WHERE event_type IN ('purchase', 'click')) s ON t.event_id = s.event_id""", "value"
)
def merge_upsert(spark, sf):
    """All events; of two kinds there are newer copies, one kind's under new identifiers."""
    e = table(spark, sf, "events").select("event_id", "value", "event_type")
    fresh = F.when(F.col("event_type") == "purchase", -F.col("event_id") - 1).otherwise(F.col("event_id"))
    changed = e.filter(F.col("event_type").isin("purchase", "click")).select(fresh.alias("event_id"), (F.col("value") + 1).alias("value"))
    return merged(e.drop("event_type"), changed, ["event_id"])


@query(
    """SELECT trade_date, version, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM (
      SELECT event_id, CAST(ts AS DATE) AS trade_date, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS version FROM events) GROUP BY ALL""",
    times=("trade_date",),
)
def keyed_table_upsert(spark, sf):
    """A table written by two batches, the second of which replaces the events of one kind."""
    e = table(spark, sf, "events").select("event_id", F.to_date("ts").alias("trade_date"), F.lit(0).alias("version"), "event_type")
    t = KeyedTable(spark, scratch(spark, "keyed"), ["event_id"], "trade_date", "version")
    t.upsert(e, 0)
    t.upsert(e.filter("event_type = 'purchase'").withColumn("version", F.lit(1)), 1)
    return t.read().groupBy("trade_date", "version").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


# returns, risk, flow

_RET = ("bar_range", "bar_range_pct", "log_return", "simple_return", "vwap", "prev_close")
_BAR_TIMES = ("event_date", "window_start", "window_end", "silver_timestamp")


@query(f"{M.DOMAIN.returns} => SELECT * REPLACE (round(dollar_volume + 1e-9, 2) AS dollar_volume) FROM returns", *_RET, digits=5, times=(*_BAR_TIMES, "volume", "trade_count"))
def minute_returns(spark, sf):
    return A.minute_returns(M.minute_bars(spark, sf)).withColumn("dollar_volume", F.round(F.col("dollar_volume") + NUDGE, 2))


def _daily_returns(bars):
    return A.daily_returns(B.daily_bars(bars), B.session_close(bars)).filter("composite_figi is not null")


_DRET = ("vwap", "log_return", "simple_return", "intraday_range")


@query(f"{M.DOMAIN.dreturns} => SELECT * REPLACE (round(dollar_volume) AS dollar_volume) FROM dreturns WHERE composite_figi IS NOT NULL", *_DRET, digits=4, times=_DAY)
def daily_returns(spark, sf):
    return _daily_returns(M.minute_bars(spark, sf)).withColumn("dollar_volume", F.round("dollar_volume"))


@query(f"{M.FLOW} => SELECT trade_id, symbol, direction, notional, is_block FROM flow", "notional", digits=4)
def trade_flow(spark, sf):
    return A.trade_flow(M.trades(spark, sf).select("symbol", "sip_timestamp", "trade_id", "trade_price", "trade_size")).select("trade_id", "symbol", "direction", "notional", "is_block")


def _stats(bars):
    return A.daily_stats(A.minute_returns(bars), _daily_returns(bars))


_STATS = ("realized_vol", "total_dollar_volume", "avg_bar_range", "max_bar_range", "avg_vwap_deviation", "garman_klass_vol", "avg_volume_20", "avg_dollar_volume_20", "avg_vol_20", "volume_zscore", "daily_log_return", "daily_simple_return", "intraday_range")
_STATS_TIMES = ("event_date", "session_open", "session_end", "total_volume", "total_trades")


#: Averages of amounts often lie on exact halves of a digit, too large for NUDGE to move.
_PUSH = 0.00037
_STATS_SQL = f"=> SELECT * REPLACE (round(avg_dollar_volume_20 + {_PUSH}, 2) AS avg_dollar_volume_20) FROM stats"


def _pushed(df):
    return df.withColumn("avg_dollar_volume_20", F.round(F.col("avg_dollar_volume_20") + _PUSH, 2))


@query(f"{M.DOMAIN.stats} {_STATS_SQL}", *_STATS, digits=3, times=_STATS_TIMES)
def daily_stats(spark, sf):
    return _pushed(_stats(M.minute_bars(spark, sf)))


@query(f"{M.EVENTS.stats} {_STATS_SQL}", *_STATS, digits=3, times=_STATS_TIMES)
def daily_stats_of_hours(spark, sf):
    return _pushed(_stats(M.hour_bars(spark, sf)))


_UNUSUAL = ("daily_simple_return", "total_dollar_volume", "realized_vol", "intraday_range", "volume_zscore", "vol_zscore", "return_vol_ratio", "range_zscore", "avg_volume_20", "avg_vol_20")


@query(f"{M.DOMAIN.unusual} => SELECT * FROM unusual", *_UNUSUAL, digits=3, times=("event_date", "total_volume"))
def unusual_activity(spark, sf):
    return A.unusual_activity(_stats(M.minute_bars(spark, sf)))


@query(f"{M.EVENTS.unusual} => SELECT * FROM unusual", *_UNUSUAL, digits=3, times=("event_date", "total_volume"))
def unusual_activity_of_hours(spark, sf):
    return A.unusual_activity(_stats(M.hour_bars(spark, sf)))


@query(
    f"""{M.EVENTS.dreturns}, j AS (SELECT a.symbol, a.event_date, a.log_return AS x, b.log_return AS m FROM dreturns a JOIN dreturns b ON a.event_date = b.event_date AND b.symbol = '{M.BENCHMARK}'
      WHERE a.log_return IS NOT NULL AND b.log_return IS NOT NULL AND a.composite_figi IS NOT NULL),
    k AS (SELECT symbol, event_date, count(*) OVER w AS n, avg(x) OVER w AS ax, avg(m) OVER w AS am, avg(x * m) OVER w AS axm, avg(m * m) OVER w AS amm,
      CASE WHEN count(*) OVER w > 1 THEN stddev_samp(x) OVER w END AS sx, CASE WHEN count(*) OVER w > 1 THEN stddev_samp(m) OVER w END AS sm
      FROM j WINDOW w AS (PARTITION BY symbol ORDER BY event_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
    => SELECT symbol, event_date, n AS window_size, sx * sqrt(252) * 100 AS volatility, ax * 252 / nullif(sx * sqrt(252), 0) AS sharpe, (axm - ax * am) / nullif(amm - am * am, 0) AS beta,
      (ax - (axm - ax * am) / nullif(amm - am * am, 0) * am) * 252 AS alpha, (axm - ax * am) / nullif(sx * sm, 0) AS correlation FROM k WHERE n >= 10""",
    "volatility", "sharpe", "beta", "alpha", "correlation", digits=5, times=("event_date",),
)
def rolling_risk(spark, sf):
    return A.rolling_risk(_daily_returns(M.hour_bars(spark, sf)), M.BENCHMARK)


_CORR = f"""{M.EVENTS.dreturns}, r AS (SELECT symbol, event_date, log_return FROM dreturns WHERE log_return IS NOT NULL AND composite_figi IS NOT NULL),
  r20 AS (SELECT * FROM r WHERE event_date IN (SELECT DISTINCT event_date FROM r ORDER BY event_date DESC LIMIT 20)),
  cm AS (SELECT a.symbol AS symbol_a, b.symbol AS symbol_b, round(corr(a.log_return, b.log_return), 4) AS correlation, count(*) AS common_days
    FROM r20 a JOIN r20 b ON a.event_date = b.event_date AND a.symbol <= b.symbol GROUP BY ALL HAVING count(*) >= 10)"""


@query(f"{_CORR} => SELECT * FROM cm")
def correlation_matrix(spark, sf):
    return A.correlation_matrix(_daily_returns(M.hour_bars(spark, sf)))


_SYMBOLS = ("click", "error", "purchase", "view")
_ONE = "coalesce(max(correlation) FILTER (symbol_b = '{0}'), 1.0)"


@query(
    f"""{_CORR}, both_ AS (SELECT symbol_a, symbol_b, correlation FROM cm UNION SELECT symbol_b, symbol_a, correlation FROM cm)
    => SELECT symbol_a, {", ".join(f"{_ONE.format(x)} AS {x}" for x in _SYMBOLS)}, ({" + ".join(_ONE.format(x) for x in _SYMBOLS)}) / 4 AS mean_correlation FROM both_ GROUP BY symbol_a""",
    "mean_correlation",
)
def corr_pivot(spark, sf):
    """The triangle made whole and spread to a square."""
    return A.correlation_square(A.correlation_matrix(_daily_returns(M.hour_bars(spark, sf))))


_BUCKET = "CAST(extract(hour FROM {0}) * 100 + floor(extract(minute FROM {0}) / 30) * 30 AS INT)"


@query(
    f"""{M.DOMAIN.returns}, g AS (SELECT symbol, composite_figi, {_BUCKET.format("window_start")} AS bucket, avg(volume) AS avg_volume, sum(volume) / count(DISTINCT event_date) AS avg_daily_volume,
      avg(abs(log_return)) AS avg_abs_return, CASE WHEN count(*) > 1 THEN stddev_samp(log_return) END AS return_stddev, count(*) AS n_bars FROM returns WHERE log_return IS NOT NULL GROUP BY ALL)
    => SELECT *, avg_volume / nullif(avg(avg_volume) OVER (PARTITION BY symbol), 0) AS relative_volume FROM g""",
    "avg_volume", "avg_daily_volume", "avg_abs_return", "return_stddev", "relative_volume", digits=5,
)
def volume_profile(spark, sf):
    return A.volume_profile(A.minute_returns(M.minute_bars(spark, sf)))


_SPREAD = {"avg_spread_bps": "avg_spread_bps", "avg_min_spread_bps": "min_spread_bps", "avg_max_spread_bps": "max_spread_bps", "avg_quotes": "quote_count", "avg_imbalance": "order_imbalance", "avg_bid_size": "avg_bid_size", "avg_ask_size": "avg_ask_size"}


@query(
    f"""{M.FLOW}, q AS (SELECT symbol, composite_figi, {_BUCKET.format("window_start")} AS bucket, count(DISTINCT quote_date) AS days, {", ".join(f"avg({y}) AS {x}" for x, y in _SPREAD.items())} FROM gold_quote_stats GROUP BY ALL),
      t0 AS (SELECT symbol, {_BUCKET.format("sip_timestamp")} AS bucket, trade_date, count(*) AS n, sum(notional) AS value, avg(trade_size) AS size, count(*) FILTER (direction = 'BUY') * 100.0 / count(*) AS buys FROM flow GROUP BY ALL),
      t AS (SELECT symbol, bucket, avg(n) AS avg_trades, avg(value) AS avg_notional, avg(size) AS avg_trade_size, avg(buys) AS avg_buy_pct FROM t0 GROUP BY ALL)
    => SELECT q.*, avg_trades, avg_notional, avg_trade_size, avg_buy_pct, avg_spread_bps / nullif(avg(avg_spread_bps) OVER (PARTITION BY q.symbol), 0) AS relative_spread FROM q LEFT JOIN t USING (symbol, bucket)""",
    *_SPREAD, "avg_trades", "avg_notional", "avg_trade_size", "avg_buy_pct", "relative_spread", digits=3,
)
def spread_profile(spark, sf):
    return A.spread_profile(table(spark, sf, "gold_quote_stats"), A.trade_flow(M.flow_trades(spark, sf)))


@query(
    f"""{M.FLOW}, {M.QSTATS},
    t AS (SELECT composite_figi, symbol, trade_date, count(*) AS trades, CAST(sum(trade_size) AS BIGINT) AS volume, sum(notional) AS notional, avg(trade_size) AS avg_size,
      quantile_cont(trade_size, 0.5) AS median_size, CAST(sum(CASE WHEN direction = 'BUY' THEN trade_size ELSE 0 END) AS BIGINT) AS buy_volume,
      CAST(sum(CASE WHEN direction = 'SELL' THEN trade_size ELSE 0 END) AS BIGINT) AS sell_volume, coalesce(sum(notional) FILTER (direction = 'BUY'), 0) * 100 / nullif(sum(notional), 0) AS buy_pct,
      coalesce(sum(notional) FILTER (direction = 'SELL'), 0) * 100 / nullif(sum(notional), 0) AS sell_pct, sum(CASE direction WHEN 'BUY' THEN notional ELSE -notional END) / nullif(sum(notional), 0) AS imbalance,
      count(*) FILTER (is_block) AS blocks, sum(notional) FILTER (is_block) AS block_notional, min(trade_price) AS low, max(trade_price) AS high, min(sip_timestamp) AS first_trade, max(sip_timestamp) AS last_trade FROM flow GROUP BY ALL),
    q AS (SELECT composite_figi, quote_date AS trade_date, avg(avg_spread_bps) AS spread_bps, min(min_spread_bps) AS tightest_bps, max(max_spread_bps) AS widest_bps,
      CAST(sum(quote_count) AS BIGINT) AS quotes, avg(avg_spread_dollars) AS spread_dollars, avg(avg_mid_price) AS mid_price, avg(order_imbalance) AS quote_imbalance FROM qs GROUP BY ALL)
    => SELECT t.*, spread_bps, tightest_bps, widest_bps, quotes, spread_dollars, mid_price, quote_imbalance, CASE WHEN quotes > 0 THEN quotes / trades END AS quotes_per_trade
      FROM t LEFT JOIN q ON t.composite_figi = q.composite_figi AND t.trade_date = q.trade_date""",
    "notional", "avg_size", "median_size", "buy_pct", "sell_pct", "imbalance", "block_notional", "spread_bps", "tightest_bps", "widest_bps", "spread_dollars", "mid_price", "quote_imbalance", "quotes_per_trade", digits=2,
    times=("trade_date", "first_trade", "last_trade", "quotes"),
)
def microstructure_daily(spark, sf):
    """Dates of symbols without quotes stay."""
    return A.microstructure_daily(A.trade_flow(M.flow_trades(spark, sf)), B.quote_stats(table(spark, sf, "silver_quotes")))


@query(
    f"""{M.FLOW}, g AS (SELECT composite_figi, symbol, trade_date, CASE WHEN is_block THEN 'BLOCK' WHEN trade_size < 100 THEN 'ODD' ELSE 'ROUND' END AS size_class, count(*) AS trades,
      CAST(sum(trade_size) AS BIGINT) AS volume, sum(notional) AS notional, avg(trade_size) AS avg_size, avg(notional) AS avg_notional FROM flow GROUP BY ALL)
    => SELECT *, trades * 100.0 / nullif(sum(trades) OVER d, 0) AS trade_pct, volume * 100.0 / nullif(sum(volume) OVER d, 0) AS volume_pct, notional * 100.0 / nullif(sum(notional) OVER d, 0) AS notional_pct FROM g
      WINDOW d AS (PARTITION BY composite_figi, symbol, trade_date)""",
    "notional", "avg_size", "avg_notional", "trade_pct", "volume_pct", "notional_pct", digits=2, times=("trade_date",),
)
def trade_size_distribution(spark, sf):
    return A.size_distribution(A.trade_flow(M.flow_trades(spark, sf)))


# reconciliation and fundamentals

#: The first date that reconciliation looks at.
FIRST = "2010-01-05"
_SIDE = """{0} AS (SELECT upper(trim(symbol)) AS symbol, {1} AS price_date, {2} AS v, composite_figi, {3} FROM {4}
    QUALIFY row_number() OVER (PARTITION BY upper(trim(symbol)), {1} ORDER BY {2} DESC NULLS LAST, composite_figi DESC NULLS LAST, {5}) = 1)"""
_PRICES = ("open_price", "high_price", "low_price", "close_price", "volume", "vwap")
_ROLLUP = (*_PRICES, "last_bar_start")


def _side_sql(alias: str, name: str, day: str, version: str, columns: tuple[str, ...]) -> str:
    return _SIDE.format(alias, day, version, ", ".join(columns), name, ", ".join(f"{x} DESC NULLS LAST" for x in columns))


_LATEST = f"""{M.DOMAIN.closes}, {_side_sql("r", "gold_daily_rollup", "event_date", "updated_at", _ROLLUP)}, {_side_sql("b", "batch_daily_prices", "price_date", "loaded_at", _PRICES)},
  aligned AS (SELECT coalesce(r.symbol, b.symbol) AS symbol, coalesce(r.price_date, b.price_date) AS price_date, {", ".join(f"r.{x} AS {x}_a" for x in _PRICES if x != "close_price")}, coalesce(c.session_close, r.close_price) AS close_price_a,
    {", ".join(f"b.{x} AS {x}_b" for x in _PRICES)}, r.last_bar_start, CASE WHEN r.symbol IS NULL THEN 'MISSING_A' WHEN b.symbol IS NULL THEN 'MISSING_B'
      WHEN r.last_bar_start < CAST(r.price_date AS TIMESTAMP) + INTERVAL 1185 MINUTE THEN 'PARTIAL' ELSE 'FULL' END AS coverage
    FROM r LEFT JOIN closes c ON r.composite_figi = c.composite_figi AND r.price_date = c.event_date FULL JOIN b ON r.symbol = b.symbol AND r.price_date = b.price_date
    WHERE coalesce(r.price_date, b.price_date) >= DATE '{FIRST}')"""


def _latest_side(spark, sf, name, day, version, columns):
    df = table(spark, sf, name).select(F.upper(F.trim("symbol")).alias("symbol"), F.col(day).alias("price_date"), F.col(version).alias("v"), "composite_figi", *columns)
    return keep_latest(df, ["symbol", "price_date"], "v").drop("v")


def _aligned(spark, sf, first=FIRST, last_minute=1185):
    """Both copies of the daily prices side by side, from the first date on; the streamed close is the session's where there is one.

    PARTIAL: the last bar starts more than a quarter of an hour before 20:00.
    """
    closes = B.session_close(M.minute_bars(spark, sf)).select("composite_figi", F.col("event_date").alias("price_date"), "session_close")
    a = _latest_side(spark, sf, "gold_daily_rollup", "event_date", "updated_at", _ROLLUP).join(closes, ["composite_figi", "price_date"], "left")
    a = a.withColumn("close_price", F.coalesce("session_close", "close_price")).select("symbol", "price_date", "last_bar_start", F.lit(1).alias("in_a"), *(F.col(x).alias(f"{x}_a") for x in _PRICES))
    b = _latest_side(spark, sf, "batch_daily_prices", "price_date", "loaded_at", _PRICES).select("symbol", "price_date", F.lit(1).alias("in_b"), *(F.col(x).alias(f"{x}_b") for x in _PRICES))
    both = a.join(b, ["symbol", "price_date"], "full_outer").filter(F.col("price_date") >= F.lit(first).cast("date"))
    cut = F.timestamp_micros((F.unix_date("price_date") * 1440 + last_minute).cast("bigint") * 60_000_000).cast("timestamp_ntz")
    kind = F.when(F.col("in_a").isNull(), "MISSING_A").when(F.col("in_b").isNull(), "MISSING_B").when(F.col("last_bar_start") < cut, "PARTIAL").otherwise("FULL")
    return both.withColumn("coverage", kind).drop("in_a", "in_b")


_ALIGNED_D = tuple(f"{x}_{s}" for x in _PRICES for s in "ab" if x != "volume")


@query(f"{_LATEST} => SELECT * FROM aligned", *_ALIGNED_D, times=("price_date", "last_bar_start", "volume_a", "volume_b"))
def recon_aligned(spark, sf):
    return _aligned(spark, sf)


_DELTAS = ("close_price", "vwap", "volume")


@query(
    f"""{_LATEST}, d AS (SELECT symbol, price_date, coverage, {", ".join(f"CAST({x}_a - {x}_b AS DOUBLE) AS {x}_delta, ({x}_a - {x}_b) * 100.0 / nullif({x}_b, 0) AS {x}_pct" for x in _DELTAS)} FROM aligned)
    => SELECT *, CASE WHEN coverage <> 'FULL' THEN coverage WHEN abs(close_price_pct) > 0.5 AND abs(vwap_pct) > 1 THEN 'CLOSE_AND_VWAP' WHEN abs(close_price_pct) > 0.5 THEN 'CLOSE'
      WHEN abs(vwap_pct) > 1 THEN 'VWAP' ELSE 'OK' END AS status FROM d""",
    *(f"{x}_{k}" for x in _DELTAS for k in ("delta", "pct")), digits=4, times=("price_date",),
)
def recon_daily_delta(spark, sf):
    gap = lambda x: F.col(f"{x}_a") - F.col(f"{x}_b")
    d = _aligned(spark, sf).select("symbol", "price_date", "coverage", *(y for x in _DELTAS for y in (gap(x).cast("double").alias(f"{x}_delta"), B.ratio(gap(x) * 100.0, F.col(f"{x}_b")).alias(f"{x}_pct"))))
    off, voff = F.abs("close_price_pct") > 0.5, F.abs("vwap_pct") > 1
    return d.withColumn("status", F.when(F.col("coverage") != "FULL", F.col("coverage")).when(off & voff, "CLOSE_AND_VWAP").when(off, "CLOSE").when(voff, "VWAP").otherwise("OK"))


@query(
    f"""{M.DOMAIN.dreturns}, {_side_sql("b0", "batch_daily_prices", "price_date", "loaded_at", _PRICES)},
      a AS (SELECT composite_figi, symbol, event_date AS price_date, close AS close_a, simple_return AS return_a FROM dreturns WHERE simple_return IS NOT NULL AND composite_figi IS NOT NULL),
      b AS (SELECT * FROM (SELECT composite_figi, symbol, price_date, close_price AS close_b, CASE WHEN lag(close_price) OVER w > 0 THEN close_price / lag(close_price) OVER w - 1 END AS return_b FROM b0
        WINDOW w AS (PARTITION BY symbol ORDER BY price_date)) WHERE composite_figi IS NOT NULL)
    => SELECT coalesce(a.composite_figi, b.composite_figi) AS composite_figi, coalesce(a.symbol, b.symbol) AS symbol, coalesce(a.price_date, b.price_date) AS price_date, close_a, return_a, close_b, return_b,
      (return_a - return_b) * 10000 AS gap_bps, CASE WHEN a.composite_figi IS NULL THEN 'MISSING_A' WHEN b.composite_figi IS NULL THEN 'MISSING_B' WHEN abs(return_a - return_b) > 0.005 THEN 'MISMATCH' ELSE 'OK' END AS status
      FROM a FULL JOIN b ON a.composite_figi = b.composite_figi AND a.price_date = b.price_date WHERE coalesce(a.price_date, b.price_date) >= DATE '{FIRST}'""",
    "close_a", "close_b", "return_a", "return_b", "gap_bps", digits=4, times=("price_date",),
)
def recon_returns_delta(spark, sf):
    """Two tables of returns that know nothing of each other: out of the bars, and out of the batch prices."""
    a = _daily_returns(M.minute_bars(spark, sf)).filter("simple_return is not null").select("composite_figi", "symbol", F.col("event_date").alias("price_date"), F.col("close").alias("close_a"), F.col("simple_return").alias("return_a"))
    before = F.lag("close_price").over(Window.partitionBy("symbol").orderBy("price_date"))
    b = _latest_side(spark, sf, "batch_daily_prices", "price_date", "loaded_at", _PRICES).withColumn("p", before)
    b = b.select("composite_figi", F.col("symbol").alias("symbol_b"), "price_date", F.col("close_price").alias("close_b"), F.when(F.col("p") > 0, F.col("close_price") / F.col("p") - 1).alias("return_b")).filter("composite_figi is not null")
    both = a.withColumn("in_a", F.lit(1)).join(b.withColumn("in_b", F.lit(1)), ["composite_figi", "price_date"], "full_outer").filter(F.col("price_date") >= F.lit(FIRST).cast("date"))
    gap = F.col("return_a") - F.col("return_b")
    status = F.when(F.col("in_a").isNull(), "MISSING_A").when(F.col("in_b").isNull(), "MISSING_B").when(F.abs(gap) > 0.005, "MISMATCH").otherwise("OK")
    return both.select("composite_figi", F.coalesce("symbol", "symbol_b").alias("symbol"), "price_date", "close_a", "return_a", "close_b", "return_b", (gap * 10000).alias("gap_bps"), status.alias("status"))


_BASE = ("close_price", "vwap", "volume")
_PRICED = f"""base AS (SELECT * FROM (SELECT composite_figi, symbol, price_date AS base_date, {", ".join(f"{x} AS base_{x}" for x in _BASE)}, row_number() OVER (PARTITION BY composite_figi ORDER BY price_date DESC, loaded_at DESC, symbol DESC, close_price DESC NULLS LAST,
      vwap DESC NULLS LAST, volume DESC NULLS LAST) AS i FROM batch_daily_prices WHERE composite_figi IS NOT NULL) WHERE i = 1),
  live AS (SELECT * FROM (SELECT composite_figi, event_date AS live_date, close_price AS live_close, volume AS live_volume, bar_count AS live_bars, row_number() OVER (PARTITION BY composite_figi ORDER BY event_date DESC, updated_at DESC, close_price DESC NULLS LAST,
      volume DESC NULLS LAST, bar_count DESC NULLS LAST) AS i FROM gold_daily_rollup WHERE composite_figi IS NOT NULL AND event_date < DATE '2010-01-08') WHERE i = 1),
  priced AS (SELECT b.* EXCLUDE (i), live_date, live_close, live_volume, live_bars, live_close / nullif(base_close_price, 0) AS price_scale FROM base b LEFT JOIN live l ON b.composite_figi = l.composite_figi)"""


def _priced(spark, sf):
    """What is known of a company as of some day, brought to the latest streamed close. The streamed side ends before the batch side, so that some prices are stale."""
    def newest(name, day, version, more, cols):
        df = table(spark, sf, name).filter("composite_figi is not null")
        return top_per_key(df, ["composite_figi"], *map(F.col, (day, version, *more))).select(*cols)

    base = newest("batch_daily_prices", "price_date", "loaded_at", ("symbol", *_BASE), ["composite_figi", "symbol", F.col("price_date").alias("base_date"), *(F.col(x).alias(f"base_{x}") for x in _BASE)])
    live = table(spark, sf, "gold_daily_rollup").filter("composite_figi is not null and event_date < date'2010-01-08'")
    live = top_per_key(live, ["composite_figi"], *map(F.col, ("event_date", "updated_at", "close_price", "volume", "bar_count")))
    live = live.select("composite_figi", F.col("event_date").alias("live_date"), F.col("close_price").alias("live_close"), F.col("volume").alias("live_volume"), F.col("bar_count").alias("live_bars"))
    return base.join(live, "composite_figi", "left").withColumn("price_scale", B.ratio(F.col("live_close"), F.col("base_close_price")))


_PRICED_TEXT = ("base_volume", "live_volume", "live_bars")


@query(f"{_PRICED} => SELECT * FROM priced", "price_scale", times=("base_date", "live_date", *_PRICED_TEXT))
def live_priced(spark, sf):
    return _priced(spark, sf)


@query(
    f"""{_PRICED} => SELECT composite_figi, symbol, base_date, live_date, base_vwap * coalesce(price_scale, 1) AS live_vwap, base_volume * coalesce(price_scale, 1) AS live_size, (live_close - base_close_price) * 100 / nullif(base_close_price, 0) AS close_delta_pct,
      CASE WHEN live_close IS NULL THEN 'MISSING' WHEN live_date < base_date THEN 'STALE' ELSE 'OK' END AS pricing_status FROM priced""",
    "live_vwap", "live_size", "close_delta_pct", digits=3, times=("base_date", "live_date"),
)
def valuation_live(spark, sf):
    scale = F.coalesce("price_scale", F.lit(1.0))
    status = F.when(F.col("live_close").isNull(), "MISSING").when(F.col("live_date") < F.col("base_date"), "STALE").otherwise("OK")
    change = B.ratio((F.col("live_close") - F.col("base_close_price")) * 100, F.col("base_close_price"))
    return _priced(spark, sf).select("composite_figi", "symbol", "base_date", "live_date", (F.col("base_vwap") * scale).alias("live_vwap"), (F.col("base_volume") * scale).alias("live_size"), change.alias("close_delta_pct"), status.alias("pricing_status"))


@query("SELECT s_suppkey, s_acctbal, n_name, r_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def factor_scores_enriched(spark, sf):
    s, n, r = (table(spark, sf, x) for x in ("supplier", "nation", "region"))
    return s.join(n, s.s_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left").select("s_suppkey", "s_acctbal", "n_name", "r_name")


@query(
    """paid AS (SELECT o_custkey, o_orderdate, sum(o_totalprice) AS cash FROM orders GROUP BY ALL), last AS (SELECT o_custkey, max(o_orderdate) AS latest FROM paid GROUP BY ALL)
    => SELECT p.o_custkey, o_orderdate, cash, c_mktsegment, CASE WHEN o_orderdate = latest THEN cash * 100 / nullif(abs(c_acctbal), 0) END AS live_yield
      FROM paid p LEFT JOIN last l ON p.o_custkey = l.o_custkey LEFT JOIN customer c ON p.o_custkey = c_custkey""",
    "cash", "live_yield", digits=3, times=("o_orderdate",),
)
def dividend_yield_live(spark, sf):
    paid = table(spark, sf, "orders").groupBy("o_custkey", "o_orderdate").agg(F.sum("o_totalprice").alias("cash"))
    latest = paid.groupBy("o_custkey").agg(F.max("o_orderdate").alias("latest"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_acctbal")
    rows = paid.join(latest, "o_custkey", "left").join(c, "o_custkey", "left")
    return rows.select("o_custkey", "o_orderdate", "cash", "c_mktsegment", F.when(F.col("o_orderdate") == F.col("latest"), B.ratio(F.col("cash") * 100, F.abs("c_acctbal"))).alias("live_yield"))


# health and quality

_LAG = "epoch_us(date_trunc('second', silver_timestamp)) // 1000000 - epoch_us(date_trunc('second', window_start)) // 1000000 AS lag"


@query(
    f"""g AS (SELECT event_date, count(*) AS bars, count(DISTINCT symbol) AS symbols, count(DISTINCT symbol) * 391 AS expected_bars, avg(lag) AS avg_lag, max(lag) AS max_lag,
      least(100.0, count(*) * 100.0 / (count(DISTINCT symbol) * 391)) AS coverage_pct, CAST(sum(volume) AS BIGINT) AS total_volume, CAST(sum(trade_count) AS BIGINT) AS total_trades, sum(close_price * volume) AS total_notional,
      min(window_start) AS first_bar, max(window_start) AS last_bar, max(silver_timestamp) AS last_load, quantile_cont(lag, 0.5) AS p50_lag, quantile_cont(lag, 0.95) AS p95_lag, quantile_cont(lag, 0.99) AS p99_lag,
      {M.minutes("min(window_start)", "max(window_start)")} AS session_minutes FROM (SELECT * REPLACE (CASE WHEN NOT isnan(close_price) THEN close_price END AS close_price), {_LAG} FROM gold_minute_bars WHERE {M.IN_SESSION}) GROUP BY event_date)
    => SELECT *, CASE WHEN p50_lag > 120 THEN 'batch' ELSE 'streaming' END AS mode, CASE WHEN session_minutes > 0 THEN bars / session_minutes END AS bars_per_minute FROM g""",
    "avg_lag", "p50_lag", "p95_lag", "p99_lag", "coverage_pct", "total_notional", "bars_per_minute", digits=2, times=("event_date", "first_bar", "last_bar", "last_load", "total_volume", "total_trades"),
)
def pipeline_health(spark, sf):
    x = F.col("close_price")
    return A.pipeline_health(table(spark, sf, "gold_minute_bars").withColumn("close_price", F.when(~F.isnan(x), x)))


_CHECKS = {
    "bad_close": "close_price IS NULL OR close_price <= 0", "bad_volume": "volume IS NULL OR volume < 0", "high_below_low": "high_price < low_price", "close_outside": "close_price > high_price OR close_price < low_price",
    "open_outside": "open_price > high_price OR open_price < low_price", "bad_vwap": "vwap IS NULL OR vwap <= 0",
}


@query(
    f"""g AS (SELECT composite_figi, symbol, event_date, count(*) AS bars, {", ".join(f"count(*) FILTER ({x}) AS {k}" for k, x in _CHECKS.items())}, avg(lag) AS avg_lag, max(lag) AS max_lag,
      min(window_start) AS first_bar, max(window_start) AS last_bar FROM (SELECT *, {_LAG} FROM gold_minute_bars) GROUP BY ALL),
    f AS (SELECT *, {" + ".join(_CHECKS)} AS failed, {M.minutes("first_bar", "last_bar")} + 1 AS expected_bars FROM g),
    v AS (SELECT *, least(100.0, round(bars * 100.0 / expected_bars, 2)) AS completeness_pct, least(100.0, round(bars * 100.0 / 391, 2)) AS session_coverage_pct, round((bars - (failed - bad_vwap)) * 100.0 / bars, 2) AS validity_pct FROM f)
    => SELECT *, (completeness_pct + validity_pct) / 2 AS score FROM v""",
    "avg_lag", "score", digits=3, times=("event_date", "first_bar", "last_bar"),
)
def data_quality(spark, sf):
    return A.bar_quality(table(spark, sf, "gold_minute_bars"))


#: What has come through of the log in gap_check, so that there are gaps to be found: messages of a known kind.
_CAME = "event_type IS NOT NULL"


@query(
    f"""SELECT kafka_topic, kafka_partition, kafka_offset, kafka_offset - prev AS jump FROM (SELECT *, lag(kafka_offset) OVER (PARTITION BY kafka_topic, kafka_partition ORDER BY kafka_offset) AS prev
      FROM (SELECT DISTINCT kafka_topic, kafka_partition, kafka_offset FROM bronze WHERE {_CAME})) WHERE kafka_offset - prev > 1"""
)
def gap_check(spark, sf):
    """Offsets before which some are missing, in a log that has lost messages."""
    d = table(spark, sf, "bronze").filter(_CAME).select("kafka_topic", "kafka_partition", "kafka_offset").distinct()
    w = Window.partitionBy("kafka_topic", "kafka_partition").orderBy("kafka_offset")
    return d.withColumn("jump", F.col("kafka_offset") - F.lag("kafka_offset").over(w)).filter("jump > 1")


@query(
    """SELECT 'trades' AS what, symbol AS k1, trade_id AS k2, count(*) AS copies FROM silver_trades GROUP BY ALL HAVING count(*) > 1
    UNION ALL SELECT 'metrics', layer, CAST(batch_id AS VARCHAR), count(*) FROM pipeline_batch_metrics GROUP BY ALL HAVING count(*) > 1"""
)
def duplicate_check(spark, sf):
    """Both checks in one result."""
    out = None
    for what, name, k1, k2 in (("trades", "silver_trades", "symbol", "trade_id"), ("metrics", "pipeline_batch_metrics", "layer", "batch_id")):
        df = table(spark, sf, name).groupBy(F.lit(what).alias("what"), F.col(k1).alias("k1"), F.col(k2).cast("string").alias("k2")).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
        out = df if out is None else out.unionByName(df)
    return out


@query("SELECT kafka_topic, kafka_partition, count(*) AS n, min(kafka_offset) AS least, max(kafka_offset) AS greatest, max(kafka_offset) - min(kafka_offset) + 1 - count(*) AS gap FROM bronze GROUP BY ALL")
def partition_stats(spark, sf):
    o = F.col("kafka_offset")
    return table(spark, sf, "bronze").groupBy("kafka_topic", "kafka_partition").agg(F.count(F.lit(1)).alias("n"), F.min(o).alias("least"), F.max(o).alias("greatest"), (F.max(o) - F.min(o) + 1 - F.count(F.lit(1))).alias("gap"))


@query("SELECT count(*) AS crossed, count(*) * 100.0 / (SELECT count(*) FROM silver_quotes) AS pct FROM silver_quotes WHERE ask_price <= bid_price", "pct")
def crossed_pct(spark, sf):
    bad = F.count(F.when(F.col("ask_price") <= F.col("bid_price"), 1))
    return table(spark, sf, "silver_quotes").agg(bad.alias("crossed"), (bad * 100.0 / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("pct"))


@query("SELECT symbol, count(*) AS minutes, CAST(sum(quote_count) AS BIGINT) AS quotes FROM gold_quote_stats WHERE quote_date = (SELECT max(quote_date) FROM gold_quote_stats) GROUP BY ALL")
def latest_date_spread(spark, sf):
    q = table(spark, sf, "gold_quote_stats")
    last = q.agg(F.max("quote_date").alias("quote_date"))  # one row
    return q.join(last, "quote_date", "left_semi").groupBy("symbol").agg(F.count(F.lit(1)).alias("minutes"), F.sum("quote_count").alias("quotes"))


@query(
    """SELECT trade_date, count(*) AS n, count(DISTINCT symbol) AS symbols, count(*) FILTER (composite_figi IS NULL) AS no_figi, min(sip_timestamp) AS first, max(sip_timestamp) AS last,
      CAST(sum(trade_size) AS BIGINT) AS size FROM silver_trades GROUP BY ALL""",
    times=("trade_date", "first", "last"),
)
def daily_monitor(spark, sf):
    return table(spark, sf, "silver_trades").groupBy("trade_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("symbol").alias("symbols"), F.count(F.when(F.col("composite_figi").isNull(), 1)).alias("no_figi"),
        F.min("sip_timestamp").alias("first"), F.max("sip_timestamp").alias("last"), F.sum("trade_size").alias("size"),
    )


@query("SELECT layer, status, count(*) AS n, CAST(sum(rows_in) AS BIGINT) AS rows_in, avg(duration_ms) AS avg_ms, quantile_cont(duration_ms, 0.5) AS median_ms, max(duration_ms) AS max_ms FROM pipeline_batch_metrics GROUP BY ALL", "avg_ms", "median_ms", digits=4)
def status_counts(spark, sf):
    d, m = F.col("duration_ms"), table(spark, sf, "pipeline_batch_metrics")
    out = m.groupBy("layer", "status").agg(F.count(F.lit(1)).alias("n"), F.sum("rows_in").alias("rows_in"), F.avg(d).alias("avg_ms"), F.max(d).alias("max_ms"))
    return with_percentiles(out, m, ["layer", "status"], "duration_ms", {"median_ms": 0.5})


@query(
    """SELECT event_date, bad_pct, bad_pct <= 5 AS passes FROM (SELECT event_date, count(*) FILTER (close_price IS NULL OR close_price <= 0 OR isnan(close_price)) * 100.0 / count(*) AS bad_pct FROM gold_minute_bars GROUP BY ALL)""",
    "bad_pct", times=("event_date",),
)
def quality_gate(spark, sf):
    x = F.col("close_price")
    bad = F.count(F.when(x.isNull() | (x <= 0) | F.isnan(x), 1)) * 100.0 / F.count(F.lit(1))
    return table(spark, sf, "gold_minute_bars").groupBy("event_date").agg(bad.alias("bad_pct")).withColumn("passes", F.col("bad_pct") <= 5)


# top-k, distributions, sets

_TOP = "SELECT {1} AS side, symbol, event_date, log_return FROM (SELECT * FROM dreturns WHERE log_return IS NOT NULL AND composite_figi IS NOT NULL ORDER BY log_return {0}, symbol, event_date LIMIT 10)"


@query(f"{M.EVENTS.dreturns} => {_TOP.format('DESC', chr(39) + 'up' + chr(39))} UNION ALL {_TOP.format('ASC', chr(39) + 'down' + chr(39))}", "log_return", times=("event_date",))
def topk_movers(spark, sf):
    """The ten greatest and the ten least returns."""
    r = _daily_returns(M.hour_bars(spark, sf)).filter("log_return is not null and composite_figi is not null").select("symbol", "event_date", "log_return")
    up = r.orderBy(F.desc("log_return"), "symbol", "event_date").limit(10).withColumn("side", F.lit("up"))
    return up.unionByName(r.orderBy("log_return", "symbol", "event_date").limit(10).withColumn("side", F.lit("down")))


@query("SELECT c_mktsegment, count(*) AS n, sum(o_totalprice) AS total, avg(o_totalprice) AS mean, quantile_cont(o_totalprice, 0.5) AS median FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL", "total", "mean", "median", digits=2)
def sector_rollup(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    p = F.col("o_totalprice")
    rows = o.join(c, o.o_custkey == c.c_custkey).select("c_mktsegment", "o_totalprice")
    out = rows.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.sum(p).alias("total"), F.avg(p).alias("mean"))
    return with_percentiles(out, rows, ["c_mktsegment"], "o_totalprice", {"median": 0.5})


@query("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def value_counts(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CAST(least(19, floor(log2(trade_size + 1))) AS INT) AS bin, count(*) AS n FROM silver_trades WHERE trade_size >= 0 GROUP BY ALL")
def histogram_bins(spark, sf):
    b = F.least(F.lit(19), F.floor(F.log2(F.col("trade_size") + 1))).cast("int")
    return table(spark, sf, "silver_trades").filter("trade_size >= 0").groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query(
    """r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders), b AS (SELECT CAST(least(20, floor((o_totalprice - lo) / (hi - lo) * 20) + 1) AS INT) AS bin FROM orders, r)
    => SELECT bin, count(*) AS n FROM b GROUP BY bin"""
)
def histogram_equal(spark, sf):
    """Twenty bins of one width over the range of the values, which is worked out first."""
    o = table(spark, sf, "orders").select("o_totalprice")
    lo, hi = o.agg(F.min("o_totalprice"), F.max("o_totalprice")).first()
    b = F.least(F.lit(20), F.floor((F.col("o_totalprice") - F.lit(lo)) / (F.lit(hi) - F.lit(lo)) * 20) + 1).cast("int")
    return o.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_date AS d FROM gold_daily_rollup UNION SELECT price_date FROM batch_daily_prices", times=("d",))
def union_dates(spark, sf):
    return table(spark, sf, "gold_daily_rollup").select(F.col("event_date").alias("d")).union(table(spark, sf, "batch_daily_prices").select("price_date")).distinct()


@query(
    """SELECT channel, symbol, channel || '.' || symbol AS param FROM (SELECT DISTINCT symbol FROM gold_minute_bars), (SELECT unnest(['AM', 'T', 'Q']) AS channel)
    WHERE channel <> 'Q' OR symbol IN (SELECT symbol FROM (SELECT DISTINCT symbol FROM gold_minute_bars ORDER BY symbol LIMIT 3))"""
)
def subscription_cross(spark, sf):
    symbols = table(spark, sf, "gold_minute_bars").select("symbol").distinct()
    few = [r[0] for r in symbols.orderBy("symbol").limit(3).collect()]
    return subscriptions(["AM", "T", "Q"], symbols, {"Q": few})


@query(f"SELECT {_get('ev')} AS ev, count(*) AS n FROM bronze WHERE {_get('ev')} IS NOT NULL AND {_get('sym')} <> '' GROUP BY ALL")
def envelope_files(spark, sf):
    """Messages written as newline-delimited JSON envelopes and read again."""
    path = scratch(spark, "envelopes")
    write_envelopes(I.route(table(spark, sf, "bronze")).select("topic", "key", F.col("raw_payload").alias("value"), F.lit(None).cast("string").alias("trace_id")), path)
    return read_envelopes(spark, path).groupBy(F.get_json_object("value", "$.ev").alias("ev")).agg(F.count(F.lit(1)).alias("n"))


_STREAMED = f"""{_BARS}, once AS (SELECT p.*, m.composite_figi FROM pbars p LEFT JOIN security_master m USING (symbol)
    QUALIFY row_number() OVER (PARTITION BY symbol, window_start ORDER BY kafka_offset DESC, open_price DESC NULLS LAST) = 1)
  => {M.DAILY_SELECT} FROM once WHERE composite_figi IS NOT NULL GROUP BY composite_figi, symbol, event_date"""


@query(_STREAMED, "vwap", times=_DAY)
def stream_medallion(spark, sf):
    """Three chained streaming queries over files: log, typed bars, daily roll-ups."""
    at = scratch(spark, "stream")
    schema, master = _streamed(spark, sf, at)
    bars = KeyedTable(spark, f"{at}/bars", BAR_KEYS, "event_date", ordered=True)
    bars_stream(spark, f"{at}/bronze", schema, master, bars, f"{at}/c1").awaitTermination()
    changes = spark.read.parquet(f"{bars.path}_changes").schema
    daily = KeyedTable(spark, f"{at}/daily", ["composite_figi", "event_date"], "event_date", "version")
    daily_stream(spark, bars, changes, daily, f"{at}/c2").awaitTermination()
    return daily.read().drop("version")


def _streamed(spark, sf, at):
    """The log as a stream would leave it: two deliveries, the first with what came first."""
    src = table(spark, sf, "bronze")
    src.repartitionByRange(2, "ingest_timestamp").write.parquet(f"{at}/landing")
    log_stream(spark, f"{at}/landing", src.schema, f"{at}/bronze", f"{at}/c0").awaitTermination()
    return src.schema, table(spark, sf, "security_master")


def _changes(spark, t):
    return spark.read.parquet(f"{t.path}_changes").schema


_ONCE = "QUALIFY row_number() OVER (PARTITION BY {0} ORDER BY kafka_offset DESC NULLS LAST, {1}) = 1"
_TRADE = f"""SELECT {_get("sym")} AS symbol, {_get("i")} AS trade_id, {_get("p", "DOUBLE")} AS trade_price, {_get("s", "INT")} AS trade_size, {_get("x", "INT")} AS exchange_id, {_get("z", "INT")} AS tape,
  {_time("t")} AS sip_timestamp, {_time("y")} AS exchange_timestamp, {_get("q", "BIGINT")} AS sequence_number, kafka_topic, kafka_partition, kafka_offset, CAST({_time("t")} AS DATE) AS trade_date FROM bronze WHERE kafka_topic = 'market.trades'"""
_TRADE_TIE = ", ".join(f"{x} DESC NULLS LAST" for x in "trade_price trade_size exchange_id tape sip_timestamp exchange_timestamp sequence_number kafka_topic kafka_partition trade_date".split())


@query(
    f"""parsed AS ({_TRADE}), once AS (SELECT p.*, m.composite_figi FROM parsed p LEFT JOIN security_master m USING (symbol) WHERE symbol <> '' AND trade_id IS NOT NULL {_ONCE.format("symbol, trade_id", _TRADE_TIE)})
    => SELECT symbol, trade_id, composite_figi, trade_price, CAST(trade_size AS VARCHAR) AS trade_size, sip_timestamp, kafka_offset, trade_date FROM once WHERE composite_figi IS NOT NULL AND trade_date IS NOT NULL""",
    times=("sip_timestamp", "trade_date"),
)
def stream_trades(spark, sf):
    """Log to typed trades to served trades, as three chained streams."""
    at = scratch(spark, "stream-trades")
    schema, master = _streamed(spark, sf, at)
    trades = KeyedTable(spark, f"{at}/trades", TRADE_KEYS, "trade_date", ordered=True)
    trades_stream(spark, f"{at}/bronze", schema, master, trades, f"{at}/c1", files=4).awaitTermination()
    served = KeyedTable(spark, f"{at}/served", ["composite_figi", "trade_id"], "trade_date", "version")
    columns = ["composite_figi", "symbol", "trade_id", "trade_price", "trade_size", "sip_timestamp", "kafka_offset", "trade_date"]
    served_stream(spark, trades, _changes(spark, trades), served, f"{at}/c2", columns).awaitTermination()
    return served.read().filter("trade_date is not null").select(*(F.col(x).cast("string") if x == "trade_size" else F.col(x) for x in columns))


_QUOTE = f"""SELECT {_get("sym")} AS symbol, {_get("bp", "DOUBLE")} AS bid_price, {_get("bs", "INT")} AS bid_size, {_get("bx", "INT")} AS bid_exchange_id, {_get("ap", "DOUBLE")} AS ask_price, {_get("as", "INT")} AS ask_size,
  {_get("ax", "INT")} AS ask_exchange_id, {_time("t")} AS sip_timestamp, {_time("y")} AS exchange_timestamp, {_get("q", "BIGINT")} AS sequence_number, {_get("z", "INT")} AS tape, kafka_topic, kafka_partition, kafka_offset,
  CAST({_time("t")} AS DATE) AS quote_date FROM bronze WHERE kafka_topic = 'market.quotes'"""
_QUOTE_TIE = ", ".join(f"{x} DESC NULLS LAST" for x in "bid_price bid_size bid_exchange_id ask_price ask_size ask_exchange_id exchange_timestamp tape kafka_topic kafka_partition quote_date".split())


@query(
    f"""parsed AS ({_QUOTE}), once AS (SELECT p.*, m.composite_figi FROM parsed p LEFT JOIN security_master m USING (symbol)
      WHERE symbol <> '' AND sip_timestamp IS NOT NULL AND bid_price IS NOT NULL AND ask_price IS NOT NULL AND sequence_number IS NOT NULL {_ONCE.format("symbol, sip_timestamp, sequence_number", _QUOTE_TIE)})
    => {M.QSTATS_SELECT} FROM once WHERE composite_figi IS NOT NULL AND {_GOOD} GROUP BY 1, 2, 3, 4""",
    *_QS, times=("window_start", "quote_date"),
)
def stream_quotes(spark, sf):
    """Log to typed quotes to the statistics of the minutes that a batch touches, as three chained streams."""
    at = scratch(spark, "stream-quotes")
    schema, master = _streamed(spark, sf, at)
    quotes = KeyedTable(spark, f"{at}/quotes", QUOTE_KEYS, "quote_date", ordered=True)
    quotes_stream(spark, f"{at}/bronze", schema, master, quotes, f"{at}/c1", files=4).awaitTermination()
    stats = KeyedTable(spark, f"{at}/stats", ["composite_figi", "window_start"], "quote_date", "version")
    quote_stats_stream(spark, quotes, _changes(spark, quotes), stats, f"{at}/c2").awaitTermination()
    return stats.read().drop("version")


# catalog, spilled messages, presentation

_STG = "composite_figi, symbol, event_date AS price_date, open_price, high_price, low_price, close_price, volume, vwap, total_trades, bar_count, first_bar_start, last_bar_start, updated_at AS streaming_updated_at"


@query(f"SELECT {_STG} FROM gold_daily_rollup WHERE event_date >= DATE '{FIRST}'", times=("price_date", "first_bar_start", "last_bar_start", "streaming_updated_at", "volume", "total_trades", "bar_count"))
def catalog_views(spark, sf):
    """Tables and views are made, twice, a table is loaded, twice, and read through its view."""
    at = scratch(spark, "catalog")
    db = "tidemark_" + at.rpartition("-")[2]
    for _ in range(2):
        create_tables(spark, db, at)
        create_views(spark, db, FIRST)
        load_table(spark, db, "gold_daily_rollup", table(spark, sf, "gold_daily_rollup"))
    out = staged(spark.table(f"{db}.stg_daily_rollup"), "view")
    drop_database(spark, db)
    return out


@query(
    f"""SELECT {_get('ev')} AS ev, count(*) AS published, count(*) FILTER ({_get('ev')} = 'T') AS spilled_first FROM bronze WHERE {_get('ev')} IN ('AM', 'A', 'T', 'Q') AND {_get('sym')} <> '' GROUP BY ALL"""
)
def spill_and_replay(spark, sf):
    """Trades can't be published at first, are spilled, and are published by a replay, once."""
    at = scratch(spark, "spill")
    routed = I.route(table(spark, sf, "bronze")).select("topic", "key", F.col("raw_payload").alias("value"), F.lit(None).cast("string").alias("trace_id"))

    def publish(df):
        df.write.mode("append").parquet(f"{at}/published")

    def fails(df):
        raise OSError("the broker is away")

    publish_or_spill(routed.filter("topic <> 'market.trades'"), publish, f"{at}/spill")
    publish_or_spill(routed.filter("topic = 'market.trades'"), fails, f"{at}/spill")
    waiting = gaps(spark, f"{at}/spill").agg(F.sum("rows").alias("waiting"))
    n = replay(spark, f"{at}/spill", publish) + replay(spark, f"{at}/spill", publish)
    kind = F.get_json_object("value", "$.ev")
    out = spark.read.parquet(f"{at}/published").groupBy(kind.alias("ev")).agg(F.count(F.lit(1)).alias("published"))
    told = F.when((F.col("ev") == "T") & (F.col("waiting") == n), F.lit(n)).otherwise(0).cast("bigint")
    return out.withColumn("one", F.lit(1)).join(waiting.withColumn("one", F.lit(1)), "one").select("ev", "published", told.alias("spilled_first"))


@query("SELECT composite_figi, symbol, price_date, close_price, CAST(volume AS VARCHAR) AS volume FROM batch_daily_prices WHERE price_date = DATE '2010-01-05' AND symbol IN (SELECT symbol FROM security_master) AND composite_figi IS NOT NULL", times=("price_date",))
def prices_of_a_date(spark, sf):
    """One date's prices of the members whose identity is known."""
    members = [r[0] for r in table(spark, sf, "security_master").select("symbol").collect()]  # a fixed table
    out = on_date(table(spark, sf, "batch_daily_prices"), "price_date", date(2010, 1, 5), "symbol", members, "composite_figi")
    return out.select("composite_figi", "symbol", "price_date", "close_price", F.col("volume").cast("string").alias("volume"))


@query("SELECT CAST(row_number() OVER (ORDER BY price_date, symbol, loaded_at, close_price NULLS FIRST, volume NULLS FIRST) AS BIGINT) AS place, symbol, price_date FROM batch_daily_prices", times=("price_date",))
def back_fill_in_order(spark, sf):
    """All dates, in order of date: range partitions, numbered by the rows before each, so that no task sorts the whole."""
    df = table(spark, sf, "batch_daily_prices").select("symbol", "price_date", "loaded_at", "close_price", "volume")
    rows = number_rows(df.withColumn("whole", F.lit(0)), ["whole"], ["price_date", "symbol", "loaded_at", "close_price", "volume"])
    return rows.select((F.col("number") + 1).alias("place"), F.col("o1").alias("symbol"), F.col("o0").alias("price_date"))


@query(
    f"{M.DOMAIN.unusual} => SELECT symbol, event_date, volume_zscore, activity FROM unusual WHERE is_unusual ORDER BY event_date DESC, volume_zscore DESC NULLS LAST, symbol, composite_figi NULLS FIRST LIMIT 100",
    "volume_zscore", digits=3, times=("event_date",),
)
def top_unusual(spark, sf):
    """The hundred latest and greatest."""
    u = A.unusual_activity(_stats(M.minute_bars(spark, sf))).filter("is_unusual")
    return u.orderBy(F.desc("event_date"), F.desc_nulls_last("volume_zscore"), "symbol", "composite_figi").limit(100).select("symbol", "event_date", "volume_zscore", "activity")


_NEWEST = "kafka_topic, kafka_partition, kafka_offset, ingest_timestamp"


@query(f"SELECT {_NEWEST} FROM (SELECT DISTINCT {_NEWEST} FROM bronze) ORDER BY ingest_timestamp DESC NULLS LAST, kafka_topic, kafka_partition, kafka_offset LIMIT 20", times=("ingest_timestamp",))
def newest_messages(spark, sf):
    b = table(spark, sf, "bronze").select(*_NEWEST.split(", ")).distinct()
    return b.orderBy(F.desc_nulls_last("ingest_timestamp"), "kafka_topic", "kafka_partition", "kafka_offset").limit(20)


@query(
    f"""{M.DOMAIN.dreturns}, r AS (SELECT * FROM dreturns WHERE log_return IS NOT NULL AND composite_figi IS NOT NULL)
    => SELECT count(*) AS n, count(*) FILTER (log_return > 0) AS up, count(*) FILTER (log_return < 0) AS down, avg(log_return) AS mean, max(log_return) AS greatest, min(log_return) AS least, quantile_cont(log_return, 0.5) AS median FROM r""",
    "mean", "greatest", "least", "median",
)
def return_figures(spark, sf):
    """Over all symbols and dates."""
    r, x = _daily_returns(M.minute_bars(spark, sf)).filter("log_return is not null"), F.col("log_return")
    out = r.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(x > 0, 1)).alias("up"), F.count(F.when(x < 0, 1)).alias("down"), F.avg(x).alias("mean"), F.max(x).alias("greatest"), F.min(x).alias("least"))
    mid = exact_percentiles(r.select(F.lit(1).alias("one"), "log_return"), ["one"], "log_return", {"median": 0.5})
    return out.withColumn("one", F.lit(1)).join(mid, "one", "left").drop("one")


@query("SELECT symbol, sum(notional) AS notional, count(*) AS trades FROM (SELECT symbol, trade_price * trade_size AS notional FROM silver_trades) GROUP BY symbol ORDER BY notional DESC NULLS LAST, symbol LIMIT 15", "notional", digits=0)
def largest_symbols(spark, sf):
    """Fifteen symbols by value traded, as delivered."""
    t = table(spark, sf, "silver_trades").groupBy("symbol").agg(F.sum(F.col("trade_price") * F.col("trade_size")).alias("notional"), F.count(F.lit(1)).alias("trades"))
    return t.orderBy(F.desc_nulls_last("notional"), "symbol").limit(15)


@query("SELECT symbol, bid_price FROM silver_quotes LIMIT 0")
def empty_result(spark, sf):
    """No rows, but their columns."""
    return table(spark, sf, "silver_quotes").select("symbol", "bid_price").limit(0)
