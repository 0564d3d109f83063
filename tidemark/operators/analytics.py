"""Returns, volatility, risk, profiles, trade flow and quality scores over bars, trades and quote statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.bars import in_session, ratio
from tidemark.operators.offset_chunks import CHUNK_ROWS, number_rows
from tidemark.operators.quantiles import with_percentiles

YEAR, SESSION_MINUTES, LOOK_BACK = 252, 390, 20


def log_ratio(a: Column, b: Column) -> Column:
    return F.when((a > 0) & (b > 0), F.ln(a / b))


def percent(a: Column, b: Column, digits: int = 2) -> Column:
    return F.round(ratio(a * 100.0, b), digits)


def last_rows(*more: str):
    """The row's symbol over its last 20 dates."""
    return Window.partitionBy("symbol").orderBy("event_date", *more).rowsBetween(1 - LOOK_BACK, 0)


def zscore(x: str, w) -> Column:
    """Against the average of the frame, if that is above 0, in its sample deviations; null with one row."""
    dev = F.when(F.count(x).over(w) > 1, F.stddev_samp(x).over(w))
    return F.when(F.avg(x).over(w) > 0, (F.col(x) - F.avg(x).over(w)) / F.nullif(dev, F.lit(0.0)))


def minute_returns(bars: DataFrame) -> DataFrame:
    """Against the symbol's bar before on the same date. A symbol's date is a window of its own."""
    before = F.lag("close_price").over(Window.partitionBy("symbol", "event_date").orderBy("window_start"))
    span = F.col("high_price") - F.col("low_price")
    out = bars.withColumn("prev_close", F.when(before > 0, before))
    return out.withColumns({
        "dollar_volume": F.col("close_price") * F.col("volume"), "bar_range": span, "bar_range_pct": F.when(F.col("high_price") > 0, span / F.col("high_price") * 100),
        "log_return": log_ratio(F.col("close_price"), F.col("prev_close")), "simple_return": F.col("close_price") / F.col("prev_close") - 1,
    })


def daily_returns(daily: DataFrame, closes: DataFrame) -> DataFrame:
    """Per FIGI and date: the session's close, or the day's where there is none, against the date before."""
    rows = daily.join(closes.select("composite_figi", "event_date", "session_close"), ["composite_figi", "event_date"], "left")
    rows = rows.withColumn("close", F.coalesce("session_close", "close_price"))
    before = F.lag("close").over(Window.partitionBy("composite_figi").orderBy("event_date", "symbol"))
    return rows.withColumn("prev", F.when(before > 0, before)).select(
        "composite_figi", "symbol", "event_date", "open_price", "high_price", "low_price", "close", "volume", "vwap", "total_trades", "bar_count", "first_bar_start", "last_bar_start",
        (F.col("close") * F.col("volume")).alias("dollar_volume"), log_ratio(F.col("close"), F.col("prev")).alias("log_return"), (F.col("close") / F.col("prev") - 1).alias("simple_return"),
        ratio(F.col("high_price") - F.col("low_price"), F.col("open_price")).alias("intraday_range"),
    )


def trade_flow(trades: DataFrame, block_size: int = 10_000, block_value: float = 500_000.0, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The tick rule: a trade above the one before is a buy, below it a sell, at it what the last of these was; the first is a buy.

    A symbol's trades are worked on in chunks of equal size; each chunk takes over the last price and the last direction of
    those before it, so a symbol with most of the trades makes no task longer than others.
    """
    order = ["sip_timestamp", "trade_id"]
    rest = [x for x in trades.columns if x not in ["symbol", *order]]
    rows = number_rows(trades, ["symbol"], order, chunk_rows)
    price = f"v{rest.index('trade_price')}"
    inside = Window.partitionBy("k0", "chunk").orderBy("number")

    def tick(now: Column, prev: Column) -> Column:
        return F.when(now > prev, "BUY").when(now < prev, "SELL")

    rows = rows.withColumn("tick", tick(F.col(price), F.lag(price).over(inside)))
    edge = lambda f, x: f(F.struct(F.col(x).alias("x")), "number")["x"]
    states = rows.groupBy("k0", "chunk").agg(edge(F.min_by, price).alias("first"), edge(F.max_by, price).alias("last"), F.max_by("tick", F.when(F.col("tick").isNotNull(), F.col("number"))).alias("inner"))
    across = Window.partitionBy("k0").orderBy("chunk")  # as many rows as chunks
    states = states.withColumn("prev", F.lag("last").over(across)).withColumn("opening", tick(F.col("first"), F.col("prev")))
    states = states.withColumn("final", F.coalesce("inner", "opening"))
    states = states.select(F.col("k0").alias("j0"), F.col("chunk").alias("jc"), "opening", F.last("final", ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    rows = rows.join(states, F.col("k0").eqNullSafe(F.col("j0")) & (F.col("chunk") == F.col("jc")))
    so_far = F.last("tick", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("direction", F.coalesce(so_far, "opening", "carried", F.lit("BUY")))
    at = {"symbol": "k0", "sip_timestamp": "o0", "trade_id": "o1"} | {x: f"v{i}" for i, x in enumerate(rest)}
    value = F.col("trade_price") * F.col("trade_size")
    out = rows.select(*(F.col(at[x]).alias(x) for x in trades.columns), "direction").withColumn("notional", value)
    return out.withColumn("is_block", F.coalesce((F.col("trade_size") >= block_size) | (value >= block_value), F.lit(False)))


def minutes_between(a: Column, b: Column) -> Column:
    """Boundaries of minutes crossed from a to b."""
    return ((F.unix_timestamp(F.date_trunc("minute", b)) - F.unix_timestamp(F.date_trunc("minute", a))) / 60).cast("bigint")


def daily_stats(returns: DataFrame, daily: DataFrame) -> DataFrame:
    """Per symbol, FIGI and date: what the minutes add up to, the date's own returns (``daily_returns``), realised and range-based
    volatility, and averages over the symbol's last 20 rows."""
    r, start = F.col("log_return"), F.col("window_start")
    per_day = returns.groupBy("symbol", "composite_figi", "event_date").agg(
        F.count(F.lit(1)).alias("bar_count"), F.count(r).alias("return_count"), F.when(F.count(r) > 1, F.sqrt(F.sum(r * r) * YEAR * SESSION_MINUTES) * 100).alias("realized_vol"),
        F.sum("volume").cast("bigint").alias("total_volume"), F.sum("dollar_volume").alias("total_dollar_volume"), F.sum("trade_count").cast("bigint").alias("total_trades"),
        F.avg("bar_range_pct").alias("avg_bar_range"), F.max("bar_range_pct").alias("max_bar_range"),
        (F.avg(ratio(F.abs(F.col("close_price") - F.col("vwap")), F.col("vwap"))) * 100).alias("avg_vwap_deviation"), F.min(start).alias("session_open"), F.max(start).alias("session_end"),
    )
    d = daily.select("composite_figi", "symbol", "event_date", "open_price", "high_price", "low_price", F.col("close").alias("close_price"), F.col("log_return").alias("daily_log_return"), F.col("simple_return").alias("daily_simple_return"), "intraday_range")
    rows = per_day.join(d, ["composite_figi", "symbol", "event_date"], "left")
    hl, co = log_ratio(F.col("high_price"), F.col("low_price")), log_ratio(F.col("close_price"), F.col("open_price"))
    gk = 0.5 * hl * hl - (2 * F.lit(0.6931471805599453) - 1) * co * co
    w = last_rows("composite_figi")
    return rows.withColumns({
        "session_minutes": minutes_between(F.col("session_open"), F.col("session_end")), "garman_klass_vol": F.when(gk >= 0, F.sqrt(gk * YEAR) * 100),
        "avg_volume_20": F.avg("total_volume").over(w), "avg_dollar_volume_20": F.avg("total_dollar_volume").over(w), "avg_vol_20": F.avg("realized_vol").over(w), "volume_zscore": zscore("total_volume", w),
    })


def unusual_activity(stats: DataFrame, limit: float = 2.0, min_bars: int = 10) -> DataFrame:
    """Days beyond limit standard deviations of the last 20 rows in volume, volatility or range, or whose return is more than
    limit daily volatilities. Days of few bars are left out before the frames are taken, so they count in none."""
    w = last_rows("composite_figi")
    daily_vol = F.col("avg_vol_20") / 100 / F.sqrt(F.lit(YEAR))
    # the volatility's average is that of all days, as in the statistics
    dev = F.nullif(F.when(F.count("realized_vol").over(w) > 1, F.stddev_samp("realized_vol").over(w)), F.lit(0.0))
    rows = stats.filter(F.col("bar_count") >= min_bars).withColumns({
        "vol_zscore": F.when(F.col("avg_vol_20") > 0, (F.col("realized_vol") - F.col("avg_vol_20")) / dev), "range_zscore": zscore("intraday_range", w),
        "return_vol_ratio": F.when(F.col("avg_vol_20") > 0, F.abs("daily_log_return") / daily_vol),
    })
    tests = {"is_volume_spike": "volume_zscore", "is_volatility_spike": "vol_zscore", "is_large_move": "return_vol_ratio", "is_range_expansion": "range_zscore"}
    rows = rows.withColumns({k: F.coalesce(F.col(x) > limit, F.lit(False)) for k, x in tests.items()})
    volume, vol, move, span = map(F.col, tests)
    kinds = [(volume & vol, "VOLUME_AND_VOLATILITY"), (move & volume, "MOVE_WITH_VOLUME"), (move, "MOVE"), (volume, "VOLUME"), (vol, "VOLATILITY"), (span, "RANGE")]
    kind = F.when(*kinds[0])
    for cond, name in kinds[1:]:
        kind = kind.when(cond, name)
    return rows.select(
        "composite_figi", "symbol", "event_date", "close_price", "daily_simple_return", "total_volume", "total_dollar_volume", "realized_vol", "intraday_range", "bar_count",
        *tests.values(), *tests, (volume | vol | move | span).alias("is_unusual"), kind.otherwise("NORMAL").alias("activity"), "avg_volume_20", "avg_vol_20",
    )


def rolling_risk(returns: DataFrame, benchmark: str, min_rows: int = 10) -> DataFrame:
    """Against a benchmark symbol over the last 20 common dates. Correlation divides the population covariance by sample
    deviations, so it is (n - 1) / n of the usual one."""
    r = returns.filter("log_return is not null").select("symbol", "composite_figi", "event_date", F.col("log_return").alias("x"))
    b = r.filter(F.col("symbol") == benchmark).select("event_date", F.col("x").alias("m"))
    w = Window.partitionBy("symbol").orderBy("event_date").rowsBetween(1 - LOOK_BACK, 0)
    j = r.join(b, "event_date").withColumn("xm", F.col("x") * F.col("m")).withColumn("mm", F.col("m") * F.col("m"))
    j = j.select("symbol", "composite_figi", "event_date", "x", "m", F.count(F.lit(1)).over(w).alias("n"), *(F.avg(k).over(w).alias(f"a_{k}") for k in ("x", "m", "xm", "mm")), *(F.stddev_samp(k).over(w).alias(f"s_{k}") for k in ("x", "m")))
    cov, var = F.col("a_xm") - F.col("a_x") * F.col("a_m"), F.col("a_mm") - F.col("a_m") * F.col("a_m")
    beta = ratio(cov, var)
    return j.filter(F.col("n") >= min_rows).select(
        "symbol", "event_date", F.col("n").alias("window_size"), (F.col("s_x") * F.sqrt(F.lit(YEAR)) * 100).alias("volatility"),
        ratio(F.col("a_x") * YEAR, F.col("s_x") * F.sqrt(F.lit(YEAR))).alias("sharpe"), beta.alias("beta"),
        ((F.col("a_x") - beta * F.col("a_m")) * YEAR).alias("alpha"), ratio(cov, F.col("s_x") * F.col("s_m")).alias("correlation"),
    )


def correlation_matrix(returns: DataFrame, dates: int = 20, min_rows: int = 10) -> DataFrame:
    """Pairwise correlation over the latest dates: a hash join on the date, each pair once. As many rows enter as symbols
    times dates, whatever the history."""
    r = returns.filter("log_return is not null").select("symbol", "event_date", "log_return")
    last = r.select("event_date").distinct().orderBy(F.desc("event_date")).limit(dates)
    r = r.join(last, "event_date", "left_semi")
    a, b = r.alias("a"), r.alias("b")
    pairs = a.join(b, (F.col("a.event_date") == F.col("b.event_date")) & (F.col("a.symbol") <= F.col("b.symbol")))
    out = pairs.groupBy(F.col("a.symbol").alias("symbol_a"), F.col("b.symbol").alias("symbol_b")).agg(
        F.round(F.corr("a.log_return", "b.log_return"), 4).alias("correlation"), F.count(F.lit(1)).alias("common_days")
    )
    return out.filter(F.col("common_days") >= min_rows)


def correlation_square(m: DataFrame) -> DataFrame:
    """The matrix with a row and a column for each symbol, ones where nothing is known, and each row's mean; the most correlated first.

    As many columns as symbols: for the few that are looked at together.
    """
    both = m.select("symbol_a", "symbol_b", "correlation")
    both = both.unionByName(both.select(F.col("symbol_b").alias("symbol_a"), F.col("symbol_a").alias("symbol_b"), "correlation")).dropDuplicates(["symbol_a", "symbol_b"])
    wide = both.groupBy("symbol_a").pivot("symbol_b").agg(F.first("correlation")).fillna(1.0)
    others = [x for x in wide.columns if x != "symbol_a"]
    mean = sum((F.col(f"`{x}`") for x in others), F.lit(0.0)) / max(1, len(others))
    return wide.withColumn("mean_correlation", mean).orderBy(F.desc("mean_correlation"), "symbol_a")


def half_hour(time: str) -> Column:
    """hour * 100 + 0 or 30, in UTC."""
    return (F.hour(time) * 100 + F.floor(F.minute(time) / 30) * 30).cast("int")


def volume_profile(returns: DataFrame) -> DataFrame:
    rows = returns.filter("log_return is not null").withColumn("bucket", half_hour("window_start"))
    g = rows.groupBy("symbol", "composite_figi", "bucket").agg(
        F.avg("volume").alias("avg_volume"), ratio(F.sum("volume"), F.count_distinct("event_date")).alias("avg_daily_volume"),
        F.avg(F.abs("log_return")).alias("avg_abs_return"), F.when(F.count(F.lit(1)) > 1, F.stddev_samp("log_return")).alias("return_stddev"), F.count(F.lit(1)).alias("n_bars"),
    )
    return g.withColumn("relative_volume", ratio(F.col("avg_volume"), F.avg("avg_volume").over(Window.partitionBy("symbol"))))


def spread_profile(stats: DataFrame, flow: DataFrame) -> DataFrame:
    """Quotes and trades by half hour: trades per date first, then over the dates."""
    avg = lambda **names: [F.avg(x).alias(y) for y, x in names.items()]
    q = stats.withColumn("bucket", half_hour("window_start")).groupBy("symbol", "composite_figi", "bucket").agg(
        F.count_distinct("quote_date").alias("days"),
        *avg(avg_spread_bps="avg_spread_bps", avg_min_spread_bps="min_spread_bps", avg_max_spread_bps="max_spread_bps", avg_quotes="quote_count", avg_imbalance="order_imbalance", avg_bid_size="avg_bid_size", avg_ask_size="avg_ask_size"),
    )
    t = flow.withColumn("bucket", half_hour("sip_timestamp")).groupBy("symbol", "bucket", "trade_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("notional").alias("value"), F.avg("trade_size").alias("size"), (F.count(F.when(F.col("direction") == "BUY", 1)) * 100.0 / F.count(F.lit(1))).alias("buys"),
    )
    t = t.groupBy("symbol", "bucket").agg(*avg(avg_trades="n", avg_notional="value", avg_trade_size="size", avg_buy_pct="buys"))
    return q.join(t, ["symbol", "bucket"], "left").withColumn("relative_spread", ratio(F.col("avg_spread_bps"), F.avg("avg_spread_bps").over(Window.partitionBy("symbol"))))


def microstructure_daily(flow: DataFrame, stats: DataFrame) -> DataFrame:
    """Per FIGI, symbol and date: trades, by side and size, beside the date's quotes of the FIGI; dates without quotes stay, with nulls."""
    size, value = F.col("trade_size"), F.col("notional")
    side = lambda x, s: F.sum(F.when(F.col("direction") == s, x).otherwise(0))
    keys = ["composite_figi", "symbol", "trade_date"]
    bought, sold = side(value, "BUY"), side(value, "SELL")
    t = flow.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trades"), F.sum(size).cast("bigint").alias("volume"), F.sum(value).alias("notional"), F.avg(size).alias("avg_size"),
        side(size, "BUY").cast("bigint").alias("buy_volume"), side(size, "SELL").cast("bigint").alias("sell_volume"), percent(bought, F.sum(value)).alias("buy_pct"), percent(sold, F.sum(value)).alias("sell_pct"),
        ratio(bought - sold, F.sum(value)).alias("imbalance"), F.count(F.when(F.col("is_block"), 1)).alias("blocks"), F.sum(F.when(F.col("is_block"), value)).alias("block_notional"),
        F.min("trade_price").alias("low"), F.max("trade_price").alias("high"), F.min("sip_timestamp").alias("first_trade"), F.max("sip_timestamp").alias("last_trade"),
    )
    t = with_percentiles(t, flow, keys, "trade_size", {"median_size": 0.5})
    q = stats.groupBy("composite_figi", F.col("quote_date").alias("trade_date")).agg(
        F.avg("avg_spread_bps").alias("spread_bps"), F.min("min_spread_bps").alias("tightest_bps"), F.max("max_spread_bps").alias("widest_bps"), F.sum("quote_count").cast("bigint").alias("quotes"),
        F.avg("avg_spread_dollars").alias("spread_dollars"), F.avg("avg_mid_price").alias("mid_price"), F.avg("order_imbalance").alias("quote_imbalance"),
    )
    return t.join(q, ["composite_figi", "trade_date"], "left").withColumn("quotes_per_trade", F.when(F.col("quotes") > 0, F.col("quotes") / F.col("trades")))


def size_class(size: Column, block: Column, odd: int = 100) -> Column:
    return F.when(block, "BLOCK").when(size < odd, "ODD").otherwise("ROUND")


def size_distribution(flow: DataFrame) -> DataFrame:
    """Trades by size class, and the class's share of its day's trades, shares and value."""
    day = ["composite_figi", "symbol", "trade_date"]
    g = flow.groupBy(*day, size_class(F.col("trade_size"), F.col("is_block")).alias("size_class")).agg(
        F.count(F.lit(1)).alias("trades"), F.sum("trade_size").cast("bigint").alias("volume"), F.sum("notional").alias("notional"), F.avg("trade_size").alias("avg_size"), F.avg("notional").alias("avg_notional"),
    )
    w = Window.partitionBy(*day)  # three rows
    return g.withColumns({y: percent(F.col(x), F.sum(x).over(w)) for x, y in (("trades", "trade_pct"), ("volume", "volume_pct"), ("notional", "notional_pct"))})


def seconds_between(a: str, b: str) -> Column:
    """Boundaries of seconds crossed from a to b."""
    return F.unix_timestamp(F.date_trunc("second", b)) - F.unix_timestamp(F.date_trunc("second", a))


def pipeline_health(bars: DataFrame, live_s: int = 120) -> DataFrame:
    """Lag from the start of a bar's window to its load, totals and coverage, per date of the regular session."""
    rows = bars.filter(in_session(F.col("window_start"))).withColumn("lag", seconds_between("window_start", "silver_timestamp"))
    n, symbols = F.count(F.lit(1)), F.count_distinct("symbol")
    out = rows.groupBy("event_date").agg(
        n.alias("bars"), symbols.alias("symbols"), (symbols * (SESSION_MINUTES + 1)).alias("expected_bars"), F.avg("lag").alias("avg_lag"), F.max("lag").alias("max_lag"),
        F.least(F.lit(100.0), percent(n, symbols * (SESSION_MINUTES + 1))).alias("coverage_pct"), F.sum("volume").cast("bigint").alias("total_volume"), F.sum("trade_count").cast("bigint").alias("total_trades"),
        F.sum(F.col("close_price") * F.col("volume")).alias("total_notional"), F.min("window_start").alias("first_bar"), F.max("window_start").alias("last_bar"), F.max("silver_timestamp").alias("last_load"),
    )
    out = with_percentiles(out, rows, ["event_date"], "lag", {"p50_lag": 0.5, "p95_lag": 0.95, "p99_lag": 0.99})
    out = out.withColumn("session_minutes", minutes_between(F.col("first_bar"), F.col("last_bar")))
    return out.withColumns({
        "mode": F.when(F.col("p50_lag") > live_s, "batch").otherwise("streaming"), "bars_per_minute": F.when(F.col("session_minutes") > 0, F.round(F.col("bars") / F.col("session_minutes"), 2)),
    })


def bar_quality(bars: DataFrame) -> DataFrame:
    """Failed checks per symbol, FIGI and date, and a score of validity and of completeness between the first and last bar, half
    each. Coverage of the whole session and the lag of loads are told, but don't count."""
    o, h, l, c = (F.col(x) for x in ("open_price", "high_price", "low_price", "close_price"))
    none = lambda x, bad: F.col(x).isNull() | bad
    checks = {
        "bad_close": none("close_price", c <= 0), "bad_volume": none("volume", F.col("volume") < 0), "high_below_low": h < l, "close_outside": (c > h) | (c < l),
        "open_outside": (o > h) | (o < l), "bad_vwap": none("vwap", F.col("vwap") <= 0),
    }
    n = F.count(F.lit(1))
    g = bars.withColumn("lag", seconds_between("window_start", "silver_timestamp")).groupBy("composite_figi", "symbol", "event_date").agg(
        n.alias("bars"), *(F.count(F.when(x, 1)).alias(k) for k, x in checks.items()), F.avg("lag").alias("avg_lag"), F.max("lag").alias("max_lag"),
        F.min("window_start").alias("first_bar"), F.max("window_start").alias("last_bar"),
    )
    bad = sum((F.col(x) for x in checks), F.lit(0).cast("bigint"))
    g = g.withColumns({"failed": bad, "expected_bars": minutes_between(F.col("first_bar"), F.col("last_bar")) + 1})
    cap = lambda x: F.least(F.lit(100.0), x)
    g = g.withColumns({
        "completeness_pct": cap(percent(F.col("bars"), F.col("expected_bars"))), "session_coverage_pct": cap(percent(F.col("bars"), F.lit(SESSION_MINUTES + 1))),
        # a missing average price fails a bar, but doesn't make it invalid
        "validity_pct": percent(F.col("bars") - (F.col("failed") - F.col("bad_vwap")), F.col("bars")),
    })
    return g.withColumn("score", (F.col("completeness_pct") + F.col("validity_pct")) / 2)
