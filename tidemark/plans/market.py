"""Views of the test tables as ticks, bars and quotes, each as a DataFrame and as SQL.

Bars, trades and quotes come from the tables of the domain; for operators that look back over weeks there are hour bars made
of ``events``, which cover more dates.
"""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.bars import ratio
from tidemark.operators.latest import keep_latest
from tidemark.sources.tables import table

BENCHMARK = "view"


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"), F.when(F.col("event_type") != "signup", F.concat(F.lit("FIGI_"), "event_type")).alias("composite_figi"),
        F.col("event_id").alias("trade_id"), F.col("value").alias("trade_price"), (k * k).alias("trade_size"), k.alias("k"),
        F.col("ts").alias("sip_timestamp"), F.to_date("ts").alias("trade_date"),
    )


def hour_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, size = F.col("trade_price"), F.col("trade_size")
    return (
        ticks(spark, sf_dir)
        .groupBy("symbol", "composite_figi", F.col("trade_date").alias("event_date"), F.date_trunc("hour", "sip_timestamp").cast("timestamp_ntz").alias("window_start"))
        .agg(
            F.min_by(price, "sip_timestamp").alias("open_price"), F.max(price).alias("high_price"), F.min(price).alias("low_price"), F.max_by(price, "sip_timestamp").alias("close_price"),
            F.sum(size).cast("bigint").alias("volume"), ratio(F.sum(price * size), F.sum(size)).alias("vwap"), F.count(F.lit(1)).cast("int").alias("trade_count"),
        )
    )


def minute_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gold_minute_bars: of bars with one symbol and start, that of the last load; a close that is no number is null."""
    df = keep_latest(table(spark, sf_dir, "gold_minute_bars"), ["symbol", "window_start"], "silver_timestamp")
    return df.withColumn("close_price", F.when(~F.isnan("close_price"), F.col("close_price")))


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """silver_trades: of copies of a trade, the one with the greatest offset."""
    return keep_latest(table(spark, sf_dir, "silver_trades"), ["symbol", "trade_id"])


def flow_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of trades that models of trade flow use."""
    return trades(spark, sf_dir).select("composite_figi", "symbol", "trade_id", "trade_price", "trade_size", "sip_timestamp", "trade_date")


def last_of(name: str, keys: str, order: str, rest: str, where: str = "") -> str:
    """SQL of keep_latest: rest are the other columns in the table's order."""
    by = ", ".join(f"{x} DESC NULLS LAST" for x in [order, *rest.split()])
    return f"SELECT * FROM {name} {where} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {by}) = 1"


IN_SESSION = "strftime(timezone('America/New_York', timezone('UTC', window_start)), '%H:%M:%S') BETWEEN '09:30:00' AND '16:00:00'"

TICKS = """ticks AS (SELECT event_type AS symbol, CASE WHEN event_type <> 'signup' THEN 'FIGI_' || event_type END AS composite_figi, event_id AS trade_id,
  value AS trade_price, CAST(json_extract_string(props, '$.k') AS INT) AS k, CAST(json_extract_string(props, '$.k') AS INT) * CAST(json_extract_string(props, '$.k') AS INT) AS trade_size,
  ts AS sip_timestamp, CAST(ts AS DATE) AS trade_date FROM events)"""
HOUR_BARS = f"""{TICKS}, bars AS (SELECT symbol, composite_figi, trade_date AS event_date, date_trunc('hour', sip_timestamp) AS window_start, arg_min(trade_price, sip_timestamp) AS open_price,
  max(trade_price) AS high_price, min(trade_price) AS low_price, arg_max(trade_price, sip_timestamp) AS close_price, CAST(sum(trade_size) AS BIGINT) AS volume,
  sum(trade_price * trade_size) / nullif(sum(trade_size), 0) AS vwap, CAST(count(*) AS INT) AS trade_count FROM ticks GROUP BY ALL)"""
MINUTE_BARS = f"""bars AS (SELECT * REPLACE (CASE WHEN isnan(close_price) THEN NULL ELSE close_price END AS close_price) FROM (
  {last_of("gold_minute_bars", "symbol, window_start", "silver_timestamp", "composite_figi event_type window_end event_date open_price high_price low_price close_price volume vwap trade_count")}))"""
TRADES = f"""trades AS ({last_of("silver_trades", "symbol, trade_id", "kafka_offset", "composite_figi trade_price trade_size exchange_id tape sip_timestamp exchange_timestamp sequence_number trade_date kafka_topic kafka_partition bronze_ingest_timestamp silver_timestamp")})"""

DAILY_SELECT = """SELECT composite_figi, symbol, event_date, arg_min_null(open_price, window_start) AS open_price, max(high_price) AS high_price, min(low_price) AS low_price,
  arg_max_null(close_price, window_start) AS close_price, CAST(sum(volume) AS BIGINT) AS volume, sum(vwap * volume) / nullif(sum(volume), 0) AS vwap,
  CAST(sum(trade_count) AS BIGINT) AS total_trades, count(*) AS bar_count, min(window_start) AS first_bar_start, max(window_start) AS last_bar_start"""
_MINUTES = "(epoch(date_trunc('minute', {1})) - epoch(date_trunc('minute', {0}))) // 60"
_W20 = "w AS (PARTITION BY symbol ORDER BY event_date, composite_figi NULLS FIRST ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"


def minutes(a: str, b: str) -> str:
    return f"CAST({_MINUTES.format(a, b)} AS BIGINT)"


def dev(x: str) -> str:
    return f"nullif(CASE WHEN count({x}) OVER w > 1 THEN stddev_samp({x}) OVER w END, 0)"


def zscore(x: str) -> str:
    return f"CASE WHEN avg({x}) OVER w > 0 THEN ({x} - avg({x}) OVER w) / {dev(x)} END"


def chain(bars: str) -> SimpleNamespace:
    """WITH lists that end with the table named, over a list that ends with bars."""
    daily = f"{bars}, daily AS ({DAILY_SELECT} FROM bars GROUP BY composite_figi, symbol, event_date)"
    closes = f"""{daily}, closes AS (SELECT composite_figi, event_date, last.symbol AS symbol, last.close_price AS session_close, last.window_start AS session_last_bar FROM (
      SELECT composite_figi, event_date, arg_max({{'symbol': symbol, 'close_price': close_price, 'window_start': window_start}}, {{'w': window_start, 's': symbol}}) AS last
      FROM bars WHERE {IN_SESSION} GROUP BY composite_figi, event_date))"""
    returns = f"""{closes}, lagged AS (SELECT *, lag(close_price) OVER (PARTITION BY symbol, event_date ORDER BY window_start) AS p FROM bars),
      returns AS (SELECT *, close_price * volume AS dollar_volume, high_price - low_price AS bar_range, CASE WHEN high_price > 0 THEN (high_price - low_price) / high_price * 100 END AS bar_range_pct,
        CASE WHEN close_price > 0 AND prev_close > 0 THEN ln(close_price / prev_close) END AS log_return, close_price / prev_close - 1 AS simple_return
        FROM (SELECT * EXCLUDE (p), CASE WHEN p > 0 THEN p END AS prev_close FROM lagged))"""
    dreturns = f"""{returns}, closed AS (SELECT d.*, coalesce(c.session_close, d.close_price) AS close FROM daily d LEFT JOIN closes c ON d.composite_figi = c.composite_figi AND d.event_date = c.event_date),
      prevd AS (SELECT *, lag(close) OVER (PARTITION BY composite_figi ORDER BY event_date, symbol NULLS FIRST) AS p FROM closed),
      dreturns AS (SELECT composite_figi, symbol, event_date, open_price, high_price, low_price, close, volume, vwap, total_trades, bar_count, first_bar_start, last_bar_start, close * volume AS dollar_volume,
        CASE WHEN close > 0 AND p > 0 THEN ln(close / p) END AS log_return, CASE WHEN p > 0 THEN close / p - 1 END AS simple_return, (high_price - low_price) / nullif(open_price, 0) AS intraday_range FROM prevd)"""
    stats = f"""{dreturns}, perday AS (SELECT symbol, composite_figi, event_date, count(*) AS bar_count, count(log_return) AS return_count,
        CASE WHEN count(log_return) > 1 THEN sqrt(sum(log_return * log_return) * 252 * 390) * 100 END AS realized_vol, CAST(sum(volume) AS BIGINT) AS total_volume, sum(dollar_volume) AS total_dollar_volume,
        CAST(sum(trade_count) AS BIGINT) AS total_trades, avg(bar_range_pct) AS avg_bar_range, max(bar_range_pct) AS max_bar_range, avg(abs(close_price - vwap) / nullif(vwap, 0)) * 100 AS avg_vwap_deviation,
        min(window_start) AS session_open, max(window_start) AS session_end FROM returns GROUP BY ALL),
      joined AS (SELECT p.*, d.open_price, d.high_price, d.low_price, d.close AS close_price, d.log_return AS daily_log_return, d.simple_return AS daily_simple_return, d.intraday_range,
        CASE WHEN d.high_price > 0 AND d.low_price > 0 AND d.close > 0 AND d.open_price > 0
          THEN 0.5 * ln(d.high_price / d.low_price) * ln(d.high_price / d.low_price) - (2 * ln(2.0) - 1) * ln(d.close / d.open_price) * ln(d.close / d.open_price) END AS gk
        FROM perday p LEFT JOIN dreturns d ON p.composite_figi = d.composite_figi AND p.symbol = d.symbol AND p.event_date = d.event_date),
      stats AS (SELECT * EXCLUDE (gk), {minutes("session_open", "session_end")} AS session_minutes, CASE WHEN gk >= 0 THEN sqrt(gk * 252) * 100 END AS garman_klass_vol, avg(total_volume) OVER w AS avg_volume_20,
        avg(total_dollar_volume) OVER w AS avg_dollar_volume_20, avg(realized_vol) OVER w AS avg_vol_20, {zscore("total_volume")} AS volume_zscore FROM joined WINDOW {_W20})"""
    flags = ("volume_zscore", "vol_zscore", "return_vol_ratio", "range_zscore")
    unusual = f"""{stats}, z AS (SELECT *, CASE WHEN avg_vol_20 > 0 THEN (realized_vol - avg_vol_20) / {dev("realized_vol")} END AS vol_zscore, {zscore("intraday_range")} AS range_zscore,
        CASE WHEN avg_vol_20 > 0 THEN abs(daily_log_return) / (avg_vol_20 / 100 / sqrt(252)) END AS return_vol_ratio FROM stats WHERE bar_count >= 10 WINDOW {_W20}),
      f AS (SELECT *, {", ".join(f"coalesce({x} > 2, FALSE) AS {y}" for x, y in zip(flags, ("v", "s", "m", "r")))} FROM z),
      unusual AS (SELECT composite_figi, symbol, event_date, close_price, daily_simple_return, total_volume, total_dollar_volume, realized_vol, intraday_range, bar_count, {", ".join(flags)},
        v AS is_volume_spike, s AS is_volatility_spike, m AS is_large_move, r AS is_range_expansion, v OR s OR m OR r AS is_unusual,
        CASE WHEN v AND s THEN 'VOLUME_AND_VOLATILITY' WHEN m AND v THEN 'MOVE_WITH_VOLUME' WHEN m THEN 'MOVE' WHEN v THEN 'VOLUME' WHEN s THEN 'VOLATILITY' WHEN r THEN 'RANGE' ELSE 'NORMAL' END AS activity,
        avg_volume_20, avg_vol_20 FROM f)"""
    return SimpleNamespace(bars=bars, daily=daily, closes=closes, returns=returns, dreturns=dreturns, stats=stats, unusual=unusual)


EVENTS, DOMAIN = chain(HOUR_BARS), chain(MINUTE_BARS)

FLOW = f"""{TRADES}, flow0 AS (SELECT *, CASE WHEN trade_price > lag(trade_price) OVER w THEN 'BUY' WHEN trade_price < lag(trade_price) OVER w THEN 'SELL' END AS tick
    FROM trades WINDOW w AS (PARTITION BY symbol ORDER BY sip_timestamp NULLS FIRST, trade_id NULLS FIRST)),
  flow AS (SELECT * EXCLUDE (tick), coalesce(last_value(tick IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY sip_timestamp NULLS FIRST, trade_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'BUY') AS direction,
    trade_price * trade_size AS notional, coalesce(trade_size >= 10000 OR trade_price * trade_size >= 500000, FALSE) AS is_block FROM flow0)"""
GOOD_QUOTE = "ask_price > bid_price AND bid_price > 0"
QSTATS_SELECT = """SELECT composite_figi, symbol, date_trunc('minute', sip_timestamp) AS window_start, quote_date, count(*) AS quote_count, avg(bid_price) AS avg_bid_price, avg(ask_price) AS avg_ask_price,
  avg(ask_price - bid_price) AS avg_spread_dollars, avg((ask_price - bid_price) / ((bid_price + ask_price) / 2) * 10000) AS avg_spread_bps,
  min((ask_price - bid_price) / ((bid_price + ask_price) / 2) * 10000) AS min_spread_bps, max((ask_price - bid_price) / ((bid_price + ask_price) / 2) * 10000) AS max_spread_bps,
  avg((bid_price + ask_price) / 2) AS avg_mid_price, avg(bid_size) AS avg_bid_size, avg(ask_size) AS avg_ask_size, CAST(sum(bid_size) AS BIGINT) AS bid_size_total,
  CAST(sum(ask_size) AS BIGINT) AS ask_size_total, (sum(bid_size) - sum(ask_size)) / nullif(sum(bid_size) + sum(ask_size), 0) AS order_imbalance"""
QSTATS = f"qs AS ({QSTATS_SELECT} FROM silver_quotes WHERE {GOOD_QUOTE} GROUP BY 1, 2, 3, 4)"
