from datetime import date, datetime

import pytest

from tidemark.operators import ingest as I

SCHEMA = "kafka_topic string, kafka_partition int, kafka_offset bigint, raw_payload string"
BAR = '{"ev":"AM","sym":"%s","o":42.25,"h":43.5,"l":41.75,"c":43.0,"v":8642,"vw":42.6,"n":31,"s":1609770720000,"e":1609770780000}'


def bronze(spark, *payloads, topic="market.aggregates"):
    return spark.createDataFrame([(topic, 0, i, p) for i, p in enumerate(payloads)], SCHEMA)


def test_bar(spark):
    r = I.parse_bars(bronze(spark, BAR % "KX")).collect()[0]
    assert (r.symbol, r.open_price, r.high_price, r.low_price, r.close_price, r.vwap) == ("KX", 42.25, 43.5, 41.75, 43.0, 42.6)
    assert (r.volume, r.trade_count, r.event_date) == (8642, 31, date(2021, 1, 4))
    assert (r.window_start, r.window_end) == (datetime(2021, 1, 4, 14, 32), datetime(2021, 1, 4, 14, 33))


def test_unreadable_bars_give_no_rows(spark):
    bad = ["not even json", "", None, BAR % "", '{"ev":"AM","o":1.0}', '{"ev":"AM","sym":"A"}', (BAR % "A")[:60], '{"ev":"A","sym":"A","s":1609770720000}']
    assert I.parse_bars(bronze(spark, *bad)).count() == 0
    assert I.parse_bars(bronze(spark, BAR % "A", topic="market.trades")).count() == 0


@pytest.mark.parametrize("t", [1262615400022825000, 1262615400022])
def test_epochs_in_ns_and_ms(spark, t):
    r = I.parse_trades(bronze(spark, '{"ev":"T","sym":"A","i":"7","p":1.5,"s":3,"t":%d,"q":9}' % t, topic="market.trades")).collect()[0]
    assert r.sip_timestamp == datetime(2010, 1, 4, 14, 30, 0, 22825 if t > 10**15 else 22000) and r.trade_size == 3 and r.trade_id == "7"


def test_wrong_type_makes_the_field_null(spark):
    r = I.parse_trades(bronze(spark, '{"ev":"T","sym":"A","i":"7","s":1.5,"t":1262615400022}', topic="market.trades")).collect()[0]
    assert r.trade_size is None and r.trade_price is None


def test_quotes_need_both_prices(spark):
    q = '{"ev":"Q","sym":"A","bp":%s,"ap":2.0,"as":4,"t":1262615400022,"q":1}'
    rows = I.parse_quotes(bronze(spark, q % "1.0", q % "null", topic="market.quotes")).collect()
    assert len(rows) == 1 and rows[0].ask_size == 4


def test_unknown_symbols_keep_their_rows(spark):
    master = spark.createDataFrame([("KX", "F1"), ("ZZ", "F2")], "symbol string, composite_figi string")
    df = I.with_figi(I.parse_bars(bronze(spark, BAR % "KX", BAR % "NEW", BAR % "ZZ")), master)
    assert {r.symbol: r.composite_figi for r in df.collect()} == {"KX": "F1", "NEW": None, "ZZ": "F2"}
    assert [r.symbol for r in I.missing_symbols(df, master).collect()] == ["NEW"]


def test_routes(spark):
    kinds = ["AM", "A", "T", "Q", "status", "X"]
    out = I.route(bronze(spark, *(f'{{"ev":"{k}","sym":"S"}}' for k in kinds), '{"ev":"T","sym":""}', '{"ev":"T"}', "garbage")).collect()
    assert [(r.key, r.topic) for r in out] == [("S", "market.aggregates")] * 2 + [("S", "market.trades"), ("S", "market.quotes")]


def test_log_keeps_garbage(spark):
    kafka = spark.createDataFrame([(None, b"not even json", "t", 1, 42, datetime(2020, 1, 1)), (None, b'{"ev":"AM"}', "t", 1, 43, datetime(2020, 1, 1))], "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp")
    assert [(r.kafka_offset, r.event_type) for r in I.enrich_bronze(kafka).collect()] == [(42, None), (43, "AM")]
