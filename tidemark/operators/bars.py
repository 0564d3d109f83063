"""Bars, quote statistics, and recomputation of what a batch touches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return a / F.nullif(b, F.lit(0))


#: What quote_measures reads.
QUOTE_INPUTS = ("bid_price", "ask_price", "bid_size", "ask_size")
#: A quote that counts: neither locked nor crossed, with a bid.
GOOD_QUOTE = "ask_price > bid_price and bid_price > 0"


def quote_measures() -> dict[str, Column]:
    """What a single quote says: both sides, the spread in money and in ten-thousandths of the mid price, and the sizes offered."""
    bid, ask = F.col("bid_price"), F.col("ask_price")
    mid, spread = (bid + ask) / 2, ask - bid
    return {"bid": bid, "ask": ask, "spread": spread, "mid": mid, "bps": ratio(spread, mid) * 10_000, "bid_size": F.col("bid_size"), "ask_size": F.col("ask_size")}


#: Columns of a minute's quote statistics: the measure, and how a minute's values are summed up.
QUOTE_STATS = {
    "avg_bid_price": ("bid", F.avg), "avg_ask_price": ("ask", F.avg), "avg_spread_dollars": ("spread", F.avg), "avg_mid_price": ("mid", F.avg),
    "avg_spread_bps": ("bps", F.avg), "min_spread_bps": ("bps", F.min), "max_spread_bps": ("bps", F.max),
    "avg_bid_size": ("bid_size", F.avg), "avg_ask_size": ("ask_size", F.avg), "bid_size_total": ("bid_size", F.sum), "ask_size_total": ("ask_size", F.sum),
}


def daily_bars(bars: DataFrame, keys: tuple[str, ...] = ("composite_figi", "symbol", "event_date")) -> DataFrame:
    """One bar per key out of its shorter ones: its ends are the ends of the first and last of them, its extremes theirs, its
    volume and trades their totals, its price their average by volume (null without volume)."""
    start, shares = F.col("window_start"), F.col("volume")
    ends = {"open_price": F.min_by("open_price", start), "close_price": F.max_by("close_price", start), "first_bar_start": F.min(start), "last_bar_start": F.max(start)}
    extremes = {"high_price": F.max("high_price"), "low_price": F.min("low_price")}
    totals = {"volume": F.sum(shares), "total_trades": F.sum("trade_count"), "bar_count": F.count(F.lit(1))}
    money = {"vwap": ratio(F.sum(shares * F.col("vwap")), F.sum(shares))}
    aggs = ends | extremes | {k: x.cast("bigint") for k, x in totals.items()} | money
    order = ("open_price", "high_price", "low_price", "close_price", "volume", "vwap", "total_trades", "bar_count", "first_bar_start", "last_bar_start")
    return bars.groupBy(*keys).agg(*(aggs[x].alias(x) for x in order))


def quote_stats(quotes: DataFrame) -> DataFrame:
    """``QUOTE_STATS`` of the quotes that count, per FIGI, symbol and minute, with their number and the lean of the sizes towards the bid."""
    minute = F.date_trunc("minute", "sip_timestamp").cast("timestamp_ntz").alias("window_start")
    each = quotes.filter(GOOD_QUOTE).select("composite_figi", "symbol", minute, "quote_date", *(x.alias(k) for k, x in quote_measures().items()))
    whole = {k: f(x).cast("bigint") if f is F.sum else f(x) for k, (x, f) in QUOTE_STATS.items()}
    out = each.groupBy("composite_figi", "symbol", "window_start", "quote_date").agg(F.count(F.lit(1)).alias("quote_count"), *(x.alias(k) for k, x in whole.items()))
    bids, asks = F.col("bid_size_total"), F.col("ask_size_total")
    return out.withColumn("order_imbalance", ratio(bids - asks, bids + asks))


def affected_dates(snapshot: DataFrame, changed: DataFrame, date: str) -> DataFrame:
    """The rows of the snapshot on dates that a batch touches, for recomputation. On a table partitioned by date the semi
    join prunes partitions at run time."""
    return snapshot.join(changed.select(date).distinct(), date, "left_semi")


def affected_minutes(snapshot: DataFrame, changed: DataFrame, time: str, date: str) -> DataFrame:
    """The rows of the snapshot in minutes that a batch touches. The dates are joined on the raw column, so that partitions
    and row groups can be skipped before the minute is worked out."""
    minutes = changed.select(F.col(date), F.date_trunc("minute", time).alias("__w")).distinct()
    rows = affected_dates(snapshot, changed, date).withColumn("__w", F.date_trunc("minute", time))
    return rows.join(minutes, [date, "__w"], "left_semi").drop("__w")


def in_session(time: Column) -> Column:
    """Whether a UTC wall-clock time lies in the regular session of New York, 09:30:00 to 16:00:00, ends included."""
    local = F.date_format(F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), time), "HH:mm:ss")
    return local.between("09:30:00", "16:00:00")


def session_close(bars: DataFrame) -> DataFrame:
    """The last bar of the regular session per FIGI and date."""
    last = F.max_by(F.struct("symbol", "close_price", "window_start"), F.struct("window_start", "symbol")).alias("m")
    rows = bars.filter(in_session(F.col("window_start"))).groupBy("composite_figi", "event_date").agg(last)
    return rows.select("composite_figi", "event_date", "m.symbol", F.col("m.close_price").alias("session_close"), F.col("m.window_start").alias("session_last_bar"))
