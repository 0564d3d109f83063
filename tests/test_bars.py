import math
import random
from datetime import date, datetime

import numpy as np
import pytest

from tidemark.operators import analytics as A
from tidemark.operators import bars as B
from tidemark.operators.quantiles import exact_percentiles
from tidemark.operators.latest import keep_latest, top_per_key

SCHEMA = "composite_figi string, symbol string, event_date date, window_start timestamp_ntz, open_price double, high_price double, low_price double, close_price double, volume bigint, vwap double, trade_count int"
DAY = date(2024, 3, 14)


def made(spark):
    """Three bars of one symbol, out of order, and one of another."""
    rows = [("FX", "XYZ", 47, 20.5, 23.0, 20.0, 22.0, 300, 21.5, 7), ("FX", "XYZ", 45, 18.0, 19.0, 17.25, 18.5, 100, 18.0, 4), ("FX", "XYZ", 46, 18.5, 21.0, 18.25, 20.5, 600, 19.5, 9), ("FQ", "QQ", 45, 7.0, 7.0, 7.0, 7.0, 1, 7.0, 1)]
    return spark.createDataFrame([(f, s, DAY, datetime(2024, 3, 14, 15, m), *x) for f, s, m, *x in rows], SCHEMA)


def test_daily_bars(spark):
    out = {r.symbol: r for r in B.daily_bars(made(spark)).collect()}
    x = out["XYZ"]
    assert set(out) == {"XYZ", "QQ"} and (x.open_price, x.high_price, x.low_price, x.close_price) == (18.0, 23.0, 17.25, 22.0)
    assert (x.volume, x.total_trades, x.bar_count) == (1000, 20, 3) and x.vwap == pytest.approx(19.95)  # 6450 + 1800 + 11700 over 1000
    assert (x.first_bar_start.minute, x.last_bar_start.minute) == (45, 47)


def test_no_volume_has_no_vwap(spark):
    df = made(spark).selectExpr("* except (volume)", "cast(0 as bigint) volume")
    assert {r.vwap for r in B.daily_bars(df).collect()} == {None}
    assert B.daily_bars(df.limit(0)).count() == 0


def test_session_close_follows_summer_time(spark):
    rows = [("F", "A", date(2026, 5, 26), datetime(2026, 5, 26, h, m), 1.0, 1.0, 1.0, c, 1, 1.0, 1) for h, m, c in ((13, 29, 1.0), (13, 30, 2.0), (20, 0, 3.0), (20, 1, 4.0))]
    rows += [("F", "A", date(2026, 1, 5), datetime(2026, 1, 5, h, m), 1.0, 1.0, 1.0, c, 1, 1.0, 1) for h, m, c in ((20, 30, 5.0), (21, 0, 6.0), (21, 1, 7.0))]
    assert {r.event_date: r.session_close for r in B.session_close(spark.createDataFrame(rows, SCHEMA)).collect()} == {date(2026, 5, 26): 3.0, date(2026, 1, 5): 6.0}


def test_minute_returns_stay_within_a_date(spark):
    rows = [("F", "A", d, datetime(2026, 5, d.day, 14, m), 1.0, 1.0, 1.0, c, 1, 1.0, 1) for d, m, c in ((date(2026, 5, 1), 0, 100.0), (date(2026, 5, 1), 1, 110.0), (date(2026, 5, 2), 0, 99.0), (date(2026, 5, 2), 1, 0.0), (date(2026, 5, 2), 2, 5.0))]
    out = sorted((r.window_start, r.log_return, r.simple_return) for r in A.minute_returns(spark.createDataFrame(rows, SCHEMA)).collect())
    assert [x[1] for x in out] == [None, pytest.approx(math.log(1.1)), None, None, None]


def test_tick_rule(spark):
    rows = [("A", str(i), p, s, datetime(2026, 5, 1, 14, 0, i)) for i, (p, s) in enumerate([(10.0, 1), (10.0, 1), (11.0, 1), (11.0, 1), (9.0, 20000), (9.0, 1), (60000.0, 9)])]
    df = spark.createDataFrame(rows, "symbol string, trade_id string, trade_price double, trade_size int, sip_timestamp timestamp_ntz")
    out = sorted((r.sip_timestamp, r.direction, r.is_block) for r in A.trade_flow(df).collect())
    assert [x[1] for x in out] == ["BUY", "BUY", "BUY", "BUY", "SELL", "SELL", "BUY"] and [x[2] for x in out] == [False] * 4 + [True, False, True]


@pytest.mark.parametrize("chunk", [1, 3, 7, 1000])
def test_tick_rule_over_chunks(spark, chunk):
    r = random.Random(chunk)
    rows = [(r.choice(["H"] * 6 + ["A", None]), i, r.choice([1.0, 2.0, 2.0, 3.0, None]), 1, datetime(2026, 5, 1, 14, 0, r.randrange(20))) for i in range(200)]
    df = spark.createDataFrame(rows, "symbol string, trade_id int, trade_price double, trade_size int, sip_timestamp timestamp_ntz").repartition(5)
    want = {}
    for s in ("H", "A", None):
        last, direction = None, None
        for x in sorted((x for x in rows if x[0] == s), key=lambda x: (x[4], x[1])):
            if last is not None and x[2] is not None and x[2] != last:
                direction = "BUY" if x[2] > last else "SELL"
            want[x[1]] = direction or "BUY"
            last = x[2]
    out = A.trade_flow(df, chunk_rows=chunk)
    assert out.columns == [*df.columns, "direction", "notional", "is_block"]
    assert {x.trade_id: x.direction for x in out.collect()} == want


def test_exact_percentiles(spark):
    r = random.Random(3)
    rows = [(r.choice(["H"] * 8 + ["A", None]), r.choice([None, float("nan"), 5.0, r.uniform(0, 100)])) for _ in range(3000)] + [("none", None), ("one", 4.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    ps = {"lo": 0.0, "q": 0.25, "mid": 0.5, "p99": 0.99, "hi": 1.0}
    got = {x.g: tuple(x)[1:] for x in exact_percentiles(df, ["g"], "v", ps).collect()}
    for g in ("H", "A", None, "one"):
        v = [x for k, x in rows if k == g and x is not None and x == x]
        assert got.pop(g) == pytest.approx(tuple(np.quantile(v, list(ps.values()))))
    assert not got and exact_percentiles(df.limit(0), ["g"], "v", ps).count() == 0


def test_days_of_few_bars_enter_no_frame(spark):
    day = lambda d: date(2026, 1, d)
    rows = [("F", "A", day(d), 10.0, 0.01, 5, 100 + d % 3, 1.0, 20.0 + d % 2, 0.02, 3 if d == 10 else 20) for d in range(1, 21)]
    names = ["composite_figi", "symbol", "event_date", "close_price", "daily_log_return", "x", "total_volume", "total_dollar_volume", "realized_vol", "intraday_range", "bar_count"]
    df = spark.createDataFrame(rows, names).selectExpr("*", "20.5D avg_vol_20", "if(event_date = '2026-01-20', 3.0D, 0.1D) volume_zscore", "100D avg_volume_20", "0.1D daily_simple_return")
    out = {x.event_date: x for x in A.unusual_activity(df).collect()}
    assert day(10) not in out and len(out) == 19
    assert out[day(20)].is_volume_spike and out[day(20)].activity == "VOLUME" and out[day(5)].activity == "NORMAL"
    assert out[day(5)].return_vol_ratio == pytest.approx(0.01 / (0.205 / math.sqrt(252)))


def test_a_session_of_bars_is_scored(spark):
    t = lambda m: datetime(2026, 5, 26, 14, m)
    rows = [("F", "A", DAY, t(0), t(1), 1.0, 2.0, 0.5, 1.5, 10, 1.0, 1), ("F", "A", DAY, t(1), t(2), 1.0, 0.5, 2.0, 1.5, None, None, 1), ("F", "A", DAY, t(3), t(4), 1.0, 2.0, 0.5, None, -1, 1.0, 1)]
    df = spark.createDataFrame(rows, SCHEMA.replace("window_start timestamp_ntz", "window_start timestamp_ntz, silver_timestamp timestamp_ntz"))
    r = A.bar_quality(df).collect()[0]
    assert (r.bars, r.bad_close, r.bad_volume, r.high_below_low, r.close_outside, r.open_outside, r.bad_vwap, r.failed) == (3, 1, 2, 1, 1, 1, 1, 7)
    assert (r.expected_bars, r.completeness_pct, r.max_lag) == (4, 75.0, 60)
    h = A.pipeline_health(df).collect()[0]
    assert (h.bars, h.total_volume, h.session_minutes, h.p50_lag, h.mode) == (3, 9, 3, 60.0, "streaming")


def test_quote_stats_leave_out_locked_and_crossed(spark):
    t = datetime(2026, 5, 1, 14, 0, 5)
    rows = [("F", "A", t, t.date(), b, a, 1, 3) for b, a in ((10.0, 10.1), (10.0, 10.0), (10.1, 10.0), (0.0, 1.0), (None, 1.0), (10.0, 10.3))]
    df = spark.createDataFrame(rows, "composite_figi string, symbol string, sip_timestamp timestamp_ntz, quote_date date, bid_price double, ask_price double, bid_size int, ask_size int")
    r = B.quote_stats(df).collect()[0]
    assert r.quote_count == 2 and r.avg_spread_dollars == pytest.approx(0.2) and r.order_imbalance == pytest.approx(-0.5) and r.window_start == datetime(2026, 5, 1, 14, 0)
    late = df.filter("ask_price > 10.2")
    assert B.affected_minutes(df, late, "sip_timestamp", "quote_date").count() == 6


def test_benchmark_against_itself(spark):
    rows = [(s, "F" + s, date(2026, 1, d), math.sin(d * (1 if s == "M" else 2))) for s in "MA" for d in range(1, 26)]
    df = spark.createDataFrame(rows, "symbol string, composite_figi string, event_date date, log_return double")
    out = [r for r in A.rolling_risk(df, "M").collect() if r.symbol == "M" and r.window_size == 20]
    assert all(r.beta == pytest.approx(1) and r.correlation == pytest.approx(0.95) for r in out) and out
    m = {(r.symbol_a, r.symbol_b): (r.correlation, r.common_days) for r in A.correlation_matrix(df).collect()}
    assert m["A", "A"] == (1.0, 20) and set(m) == {("A", "A"), ("A", "M"), ("M", "M")}


def test_latest_rows(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), (None, 1, "n"), ("b", None, "q")], "k string, kafka_offset int, v string")
    want = [("a", 2, "z"), ("b", None, "q"), (None, 1, "n")]
    assert sorted(map(tuple, keep_latest(df, ["k"]).collect()), key=lambda x: (x[0] is None, x[0])) == want
    assert sorted(map(tuple, top_per_key(df, ["k"], df.kafka_offset, df.v).collect()), key=lambda x: (x[0] is None, x[0])) == want
