from datetime import date, datetime

import pytest

from tidemark.operators.ingest import parse_bars
from tidemark.plans import market
from tidemark.sources.tables import table
from tidemark.plans.build import MODELS, build, order
from tidemark.operators.bars import quote_stats
from tidemark.sources import catalog, kafka, sinks, spillover
from tidemark.sources.dimensions import current, on_date, view
from tidemark.sources.synthetic import bar_messages
from pyspark.sql import functions as F


def test_loads(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    df = spark.sql("select id, date '2020-01-01' + cast(id % 3 as int) d, timestamp '2020-01-01 05:00:00' at from range(10)")
    assert sinks.load(df.limit(0), path) == 0
    assert sinks.load(df, path) == 10 and sinks.load(df, path) == 10
    got = spark.read.parquet(path)
    assert got.columns == ["ID", "D", "AT"] and got.count() == 10 and got.first().AT == datetime(2020, 1, 1, 5) and dict(got.dtypes)["AT"] == "timestamp_ntz"
    sinks.load(df, path, "append")
    r = sinks.parity(df, spark.read.parquet(path)).first()
    assert (r.source_rows, r.sink_rows, r.matches) == (10, 20, False)


def test_a_load_that_fails_leaves_the_table(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    df = spark.range(10)
    sinks.load(df, path)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        sinks.load(df.selectExpr("1 div (id - 5) id"), path)
    assert spark.read.parquet(path).count() == 10
    sinks.replace(spark.read.parquet(path).filter("ID < 3"), path)  # out of itself
    assert spark.read.parquet(path).count() == 3 and sorted(x.name for x in tmp_path.iterdir()) == ["t"]
    assert 0 < len(sinks.dry_run(spark.range(1000), 10)) < 300 and len(sinks.dry_run(spark.range(7), 1)) == 7


def test_tables_are_synced_at_a_beat(spark, tmp_path):
    n = iter(range(1, 9))
    got = sinks.sync({"a": lambda: spark.range(next(n)), "big": lambda: spark.range(9)}, f"file://{tmp_path}/s", 0.01, 3, ("big",))
    assert got == [{"a": 1}, {"a": 2}, {"a": 3}] and spark.read.parquet(f"{tmp_path}/s/a").count() == 3


def test_spilled_messages(spark, tmp_path):
    folder, sent = f"file://{tmp_path}/s", []
    row = lambda *v: spark.createDataFrame([("t", "k", x, None) for x in v], "topic string, key string, value string, trace_id string")

    def publish(df):
        sent.extend(sorted(r.value for r in df.collect()))

    def fails(df):
        raise OSError("away")

    assert spillover.pending(spark, folder) == [] and spillover.replay(spark, folder, publish) == 0 and spillover.gaps(spark, folder).count() == 0
    assert spillover.publish_or_spill(row("a"), publish, folder)
    for day, v in ((2, "c"), (1, "b")):
        assert not spillover.publish_or_spill(row(v), fails, folder, datetime(2020, 1, day))
    files = spillover.pending(spark, folder)
    assert sorted({x.rsplit("/", 2)[1] for x in files}) == ["2020-01-01", "2020-01-02"] and files == sorted(files)
    with pytest.raises(OSError):
        spillover.replay(spark, folder, fails)
    assert spillover.pending(spark, folder) == files
    assert spillover.replay(spark, folder, publish) == 2 and spillover.replay(spark, folder, publish) == 0
    assert sent == ["a", "b", "c"] and [(r.reason, r.rows) for r in spillover.gaps(spark, folder).collect()] == [("away", 1)] * 2


def test_tables_and_views(spark, tmp_path):
    catalog.drop_database(spark, "t_cat")
    try:
        for _ in range(2):
            catalog.create_tables(spark, "t_cat", f"file://{tmp_path}/c")
            catalog.create_views(spark, "t_cat", "2010-01-05")
        sf = "/root/testdata/sf0.001"
        for name in ("bronze", "silver_trades", "silver_quotes", "gold_minute_bars", "gold_daily_rollup", "gold_quote_stats", "batch_daily_prices", "pipeline_batch_metrics"):
            df = table(spark, sf, name)
            catalog.load_table(spark, "t_cat", name, df)
            assert spark.table(f"t_cat.{name}").count() == df.count(), name
        v = spark.table("t_cat.stg_daily_prices")
        assert "batch_loaded_at" in v.columns and v.count() > 0
        readers = {x: lambda x=x: table(spark, sf, x) for x in ("bronze", "gold_daily_rollup")}
        assert catalog.load_tables(spark, "t_cat", readers, ["gold_daily_rollup"]) == {"gold_daily_rollup": table(spark, sf, "gold_daily_rollup").count()}
        with pytest.raises(KeyError):
            catalog.load_tables(spark, "t_cat", readers, ["nothing"])
        assert dict(catalog.plain_numbers(spark.sql("select 1.5 a, 'x' b")).dtypes) == {"a": "double", "b": "string"}
        assert catalog.name_of("bronze") == "tidemark_dev.bronze" and catalog.name_of("x", "prod", {"prod": "p"}) == "p.x"
    finally:
        catalog.drop_database(spark, "t_cat")


def test_dates_are_replaced_alone_and_idempotently(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    df = spark.sql("select id, date '2020-01-01' + cast(id % 3 as int) d from range(9)")
    sinks.replace_dates(df, path, "d")
    for _ in range(2):
        sinks.replace_dates(df.filter("d = date '2020-01-02'").withColumn("id", F.col("id") + 100), path, "d")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 2, 3, 5, 6, 8, 101, 104, 107]
    sinks.replace(df.limit(2), path + "2")
    sinks.append(df.limit(1), path + "2")
    assert spark.read.parquet(path + "2").count() == 3


def test_dimensions(spark):
    d = spark.sql("select * from values ('A', 'F1', date '2019-01-01', null), ('A', 'F0', date '2018-01-01', date '2019-01-01'), ('A', 'F1', date '2020-01-01', null), ('B', 'F2', null, null) t(symbol, figi, valid_from, valid_to)")
    assert sorted(map(tuple, current(d, "symbol").collect())) == [("A", "F1"), ("B", "F2")]
    assert [r.figi for r in current(d, "symbol", ["B"]).collect()] == ["F2"]
    p = spark.sql("select * from values ('A', date '2020-01-02', 'F'), ('B', date '2020-01-02', null), ('C', date '2020-01-02', 'F'), ('A', date '2020-01-03', 'F') t(s, d, f)")
    assert [r.s for r in on_date(p, "d", date(2020, 1, 2), "s", ["A", "B"], "f").collect()] == ["A"]
    assert [tuple(r) for r in view(p, {"s": "symbol", "d": "price_date"}, "d", date(2020, 1, 3)).collect()] == [("A", date(2020, 1, 3))]


def test_synthetic_messages(spark):
    a, b = (bar_messages(spark, ["A", "B"], 50, 0.3, 0.2, seed=4).repartition(n).orderBy("seq", "payload").collect() for n in (1, 5))
    assert a == b and 110 < len(a) < 160 and {r.delay_s for r in a} == {0, 600}
    bronze = spark.createDataFrame([("market.aggregates", 0, i, r.payload) for i, r in enumerate(a)], "kafka_topic string, kafka_partition int, kafka_offset bigint, raw_payload string")
    assert parse_bars(bronze).select("symbol", "window_start").distinct().count() == 100


def test_broker_options():
    o = kafka.read_options("h:1", "market\\..*", "me", 'a"b')
    assert o["subscribePattern"] == "market\\..*" and o["failOnDataLoss"] == "false" and o["startingOffsets"] == "latest"
    assert o["kafka.sasl.jaas.config"] == 'org.apache.kafka.common.security.plain.PlainLoginModule required username="me" password="a\\"b";'
    assert "kafka.sasl.mechanism" not in kafka.read_options("h:1", "x")


def test_models_are_built_in_order(spark, tmp_path):
    assert order(["unusual_activity"])[-1] == "unusual_activity" and set(order(["unusual_activity"])) == {"daily", "closes", "daily_returns", "minute_returns", "daily_stats", "unusual_activity"}
    sf = "/root/testdata/sf0.001"
    sources = {"bars": market.minute_bars(spark, sf), "trades": market.trades(spark, sf), "quote_stats": quote_stats(table(spark, sf, "silver_quotes"))}
    out = build(spark, sources, f"file://{tmp_path}/m")
    assert set(out) == set(MODELS) and all(df.count() for x, df in out.items() if x != "correlation_matrix")
    with pytest.raises(KeyError):
        build(spark, {}, f"file://{tmp_path}/m", ["daily"])
