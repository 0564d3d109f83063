import json
import random
import shutil
from datetime import datetime

import pytest

from tidemark.operators.upsert import KeyedTable, merge_condition
from tidemark.sources.envelopes import read_envelopes, read_symbols, subscriptions, write_envelopes
from tidemark.streaming.medallion import BAR_KEYS, QUOTE_KEYS, TRADE_KEYS, bars_stream, daily_stream, log_stream, quote_stats_stream, quotes_stream, served_stream, trades_stream
from tidemark.streaming.metrics import track
from tidemark.streaming.triggers import triggered

SCHEMA = "k string, day int, kafka_offset bigint, v string"


def test_upsert_touches_only_its_partitions(spark, tmp_path):
    t = KeyedTable(spark, f"file://{tmp_path}/t", ["k"], "day")
    t.upsert(spark.createDataFrame([("a", 1, 1, "x"), ("b", 2, 1, "x"), (None, 1, 1, "no")], SCHEMA), 0)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "t" / "day=2").iterdir()}
    t.upsert(spark.createDataFrame([("a", 1, 2, "y"), ("a", 1, 3, "z"), ("c", 1, 1, "x")], SCHEMA), 1)
    t.upsert(spark.createDataFrame([], SCHEMA), 2)
    assert sorted((r.k, r.day, r.v) for r in t.read().collect()) == [("a", 1, "z"), ("b", 2, "x"), ("c", 1, "x")]
    assert {f: f.stat().st_mtime_ns for f in (tmp_path / "t" / "day=2").iterdir()} == before
    log = sorted((r.batch_id, r.k, r._change_type) for r in spark.read.parquet(f"{t.path}_changes").collect())
    assert log == [(0, "a", "insert"), (0, "b", "insert"), (1, "a", "update_postimage"), (1, "c", "insert")]
    assert spark.read.parquet(f"{t.path}_refused").count() == 1


@pytest.mark.parametrize(("ordered", "want"), [(False, "old"), (True, "new")])
def test_older_rows_in_later_batches(spark, tmp_path, ordered, want):
    t = KeyedTable(spark, f"file://{tmp_path}/t", ["k"], "day", ordered=ordered)
    t.upsert(spark.createDataFrame([("a", 1, 9, "new")], SCHEMA), 0)
    for _ in range(2):  # again, as after a failure
        t.upsert(spark.createDataFrame([("a", 1, 3, "old")], SCHEMA), 1)
    assert [r.v for r in t.read().collect()] == [want]


def test_the_log_holds_what_the_table_took(spark, tmp_path):
    t = KeyedTable(spark, f"file://{tmp_path}/t", ["k"], "day", ordered=True)
    t.upsert(spark.createDataFrame([("a", 1, 9, "new"), ("b", 1, 1, "x")], SCHEMA), 0)
    t.upsert(spark.createDataFrame([("a", 1, 3, "old"), ("b", 1, 2, "y"), ("c", 1, 1, "z")], SCHEMA), 1)
    log = sorted((r.k, r.v, r._change_type) for r in spark.read.parquet(f"{t.path}_changes").filter("batch_id = 1").collect())
    assert log == [("b", "y", "update_postimage"), ("c", "z", "insert")]


@pytest.mark.parametrize("lose", [False, True])
def test_stopped_between_staging_and_swap(spark, tmp_path, monkeypatch, lose):
    rows = [(f"k{i}", i % 3, 1, "x") for i in range(30)]
    more = [("k1", 1, 2, "y"), ("new", 2, 1, "z")]
    at = f"file://{tmp_path}/t"
    t = KeyedTable(spark, at, ["k"], "day")
    t.upsert(spark.createDataFrame(rows, SCHEMA), 0)

    def stop(self, staging):
        if lose:  # amid the swap: the old partition is gone, the new one isn't there
            shutil.rmtree(tmp_path / "t" / "day=1")
        raise OSError("killed")

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_swap", stop)
        with pytest.raises(OSError):
            t.upsert(spark.createDataFrame(more, SCHEMA), 1)
    again = KeyedTable(spark, at, ["k"], "day")
    again.upsert(spark.createDataFrame(more, SCHEMA), 1)
    want = {**{r[0]: r[3] for r in rows}, "k1": "y", "new": "z"}
    assert {r.k: r.v for r in again.read().collect()} == want and again.read().count() == 31
    assert again.recover() is None


def quote(sym, minute, second, bid, seq, offset):
    t = 1609770720000 + minute * 60000 + second * 1000
    body = {"ev": "Q", "sym": sym, "bp": bid, "bs": 2, "ap": bid + 0.5, "as": 1, "t": t, "y": t, "q": seq, "z": 1, "bx": 1, "ax": 2}
    return ("market.quotes", 0, offset, json.dumps(body), datetime(2024, 5, 23), datetime(2024, 5, 23).date())


def trade(sym, minute, i, price, offset):
    t = 1609770720000 + minute * 60000
    return ("market.trades", 0, offset, json.dumps({"ev": "T", "sym": sym, "i": str(i), "p": price, "s": 5, "x": 1, "t": t, "y": t, "q": i, "z": 1}), datetime(2024, 5, 23), datetime(2024, 5, 23).date())


def test_trades_and_quotes_however_split_and_stopped(spark, tmp_path, monkeypatch):
    r = random.Random(2)
    msgs = [quote(r.choice("ABX"), r.randrange(4), r.randrange(60), 1.0 + i, i % 3, i) for i in range(80)] + [trade(r.choice("ABX"), r.randrange(3000), r.randrange(30), float(i), i) for i in range(80)]
    msgs += r.sample(msgs, 30)
    schema = "kafka_topic string, kafka_partition int, kafka_offset bigint, raw_payload string, ingest_timestamp timestamp, ingest_date date"
    master = spark.createDataFrame([("A", "FA"), ("B", "FB")], "symbol string, composite_figi string")
    results = []
    for name, parts in (("one", 1), ("many", 3)):
        at = f"file://{tmp_path}/{name}"
        r.shuffle(msgs)
        for i in range(parts):
            spark.createDataFrame(msgs[i::parts], schema).coalesce(1).write.mode("append").parquet(f"{at}/in")
        bronze = spark.read.parquet(f"{at}/in").schema
        quotes = KeyedTable(spark, f"{at}/quotes", QUOTE_KEYS, "quote_date", ordered=True)
        trades = KeyedTable(spark, f"{at}/trades", TRADE_KEYS, "trade_date", ordered=True)
        stats = KeyedTable(spark, f"{at}/stats", ["composite_figi", "window_start"], "quote_date", "version")
        served = KeyedTable(spark, f"{at}/served", ["composite_figi", "trade_id"], "trade_date", "version")
        run = lambda start: start().awaitTermination()
        steps = [
            lambda: quotes_stream(spark, f"{at}/in", bronze, master, quotes, f"{at}/c1", files=1),
            lambda: trades_stream(spark, f"{at}/in", bronze, master, trades, f"{at}/c2", files=1),
            lambda: quote_stats_stream(spark, quotes, spark.read.parquet(f"{quotes.path}_changes").schema, stats, f"{at}/c3", 1),
            lambda: served_stream(spark, trades, spark.read.parquet(f"{trades.path}_changes").schema, served, f"{at}/c4", files=1),
        ]
        for step in steps:
            if parts > 1:  # each stream is killed at its first swap and started again
                with monkeypatch.context() as m:
                    m.setattr(KeyedTable, "_swap", lambda self, staging: (_ for _ in ()).throw(OSError("killed")))
                    with pytest.raises(Exception, match="killed"):
                        run(step)
            run(step)
        results.append([sorted(map(str, x.read().drop("version").collect())) for x in (quotes, trades, stats, served)])
    assert results[0] == results[1] and all(results[0])
    best = {}
    for m in msgs:
        if m[0] == "market.trades":
            b = json.loads(m[3])
            best[b["sym"], b["i"]] = max(best.get((b["sym"], b["i"]), (-1, 0)), (m[2], b["p"]))
    got = {(x.symbol, x.trade_id): x.trade_price for x in served.read().collect()}
    assert got == {k: v[1] for k, v in best.items() if k[0] != "X"}


def message(sym, minute, close, offset):
    s = 1716480000000 + minute * 60000
    body = {"ev": "AM", "sym": sym, "o": close, "h": close + 1, "l": close - 1, "c": close, "v": 10, "vw": close, "n": 1, "s": s, "e": s + 60000}
    return ("market.aggregates", 0, offset, json.dumps(body), datetime(2024, 5, 23), datetime(2024, 5, 23).date())


def test_any_split_of_messages_gives_one_result(spark, tmp_path):
    r = random.Random(1)
    msgs = [message(r.choice(["A", "B", "C"]), r.randrange(3000), float(i), i) for i in range(150)]
    msgs += r.sample(msgs, 40) + [("market.aggregates", 0, 999, "garbage", datetime(2024, 5, 23), datetime(2024, 5, 23).date())]
    schema = "kafka_topic string, kafka_partition int, kafka_offset bigint, raw_payload string, ingest_timestamp timestamp, ingest_date date"
    master = spark.createDataFrame([("A", "FA"), ("B", "FB")], "symbol string, composite_figi string")
    results = []
    for name, parts in (("one", 1), ("many", 4)):
        at = f"file://{tmp_path}/{name}"
        r.shuffle(msgs)
        for i in range(parts):
            spark.createDataFrame(msgs[i::parts], schema).coalesce(1).write.mode("append").parquet(f"{at}/in")
        df = spark.read.parquet(f"{at}/in")
        log_stream(spark, f"{at}/in", df.schema, f"{at}/bronze", f"{at}/c0", 1).awaitTermination()
        bars = KeyedTable(spark, f"{at}/bars", BAR_KEYS, "event_date", ordered=True)
        bars_stream(spark, f"{at}/bronze", df.schema, master, bars, f"{at}/c1", f"{at}/metrics", 1).awaitTermination()
        daily = KeyedTable(spark, f"{at}/daily", ["composite_figi", "event_date"], "event_date", "version")
        daily_stream(spark, bars, spark.read.parquet(f"{bars.path}_changes").schema, daily, f"{at}/c2", 1).awaitTermination()
        results.append(sorted(map(str, daily.read().drop("version").collect())))
        assert spark.read.parquet(f"{at}/metrics").filter("status = 'success'").count() == parts
    assert results[0] == results[1] and len(results[0]) == 6


def test_metrics_of_a_failure(spark, tmp_path):
    path = f"file://{tmp_path}/m"
    with pytest.raises(ValueError), track(spark, path, "bronze", 3):
        raise ValueError("x" * 900)
    r = spark.read.parquet(path).collect()[0]
    assert (r.layer, r.batch_id, r.status, len(r.error_message)) == ("bronze", 3, "error", 500)


def test_envelopes_and_symbols(spark, tmp_path):
    path = f"file://{tmp_path}/e"
    df = spark.createDataFrame([("t", "k", '{"a":"\\n"}', None), ("t", None, "", "id")], "topic string, key string, value string, trace_id string")
    write_envelopes(df, path)
    (tmp_path / "e" / "blank.json").write_text("\n\n")
    (tmp_path / "e" / "done.json.replayed").write_text('{"topic":"t"}')
    assert sorted((r.value, r.trace_id) for r in read_envelopes(spark, path).collect()) == [("", "id"), ('{"a":"\\n"}', "")]
    (tmp_path / "s.txt").write_text("aapl\n\n msft \nAAPL\n")
    symbols = read_symbols(spark, f"file://{tmp_path}/s.txt")
    out = sorted(r.param for r in subscriptions(["AM", "Q"], symbols, {"Q": ["MSFT"]}).collect())
    assert out == ["AM.AAPL", "AM.MSFT", "Q.MSFT"]


def test_merge_condition(spark):
    assert merge_condition(["k", "day"], "day") == "t.`day` = s.`day` AND t.`k` = s.`k`" and merge_condition(["a`b"]) == "t.`a``b` = s.`a``b`"
    spark.range(3).createOrReplaceTempView("t_merge")
    assert spark.sql(f"select 1 from t_merge t join t_merge s on {merge_condition(['id'])}").count() == 3


def test_no_such_trigger():
    with pytest.raises(ValueError):
        triggered(None, "hourly")
