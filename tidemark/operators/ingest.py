"""From raw messages to typed rows: the append-only log, its parsers, routing and identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The payload schemas of the three channels, and the topic of each kind of event.
BAR_PAYLOAD = "ev string, sym string, o double, h double, l double, c double, v bigint, vw double, n int, s bigint, e bigint"
TRADE_PAYLOAD = "ev string, sym string, x int, i string, z int, p double, s int, t bigint, y bigint, q bigint"
QUOTE_PAYLOAD = "ev string, sym string, bx int, bp double, bs int, ax int, ap double, `as` int, t bigint, y bigint, q bigint, z int"
TOPICS = {"AM": "market.aggregates", "A": "market.aggregates", "T": "market.trades", "Q": "market.quotes"}
LINEAGE = ["kafka_topic", "kafka_partition", "kafka_offset"]


def whole_json(payload: str | Column, field: str) -> Column:
    """A text field of a payload, null unless the payload is one whole JSON object: a truncated text may still have fields at its start."""
    return F.from_json(payload, f"{field} string")[field]


def enrich_bronze(records: DataFrame) -> DataFrame:
    """Log rows from broker records (key, value, topic, partition, offset, timestamp): nothing is dropped, only the kind is read.

    A payload that isn't whole JSON has no kind.
    """
    return records.select(
        F.col("topic").alias("kafka_topic"), F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"), F.col("value").cast("string").alias("raw_payload"),
        F.current_timestamp().alias("ingest_timestamp"), whole_json(F.col("value").cast("string"), "ev").alias("event_type"),
        F.to_date(F.current_timestamp()).alias("ingest_date"),
    )


def epoch(col: Column) -> Column:
    """Milliseconds or nanoseconds since 1970, told apart by size, as a wall-clock timestamp; exact to the microsecond."""
    return F.when(col > 10**15, F.timestamp_micros(F.call_function("div", col, F.lit(1000)))).otherwise(F.timestamp_millis(col)).cast("timestamp_ntz")


def _parsed(bronze: DataFrame, topic: str, schema: str) -> DataFrame:
    # the topic first: the same letter means different things in different channels
    return bronze.filter(F.col("kafka_topic") == topic).withColumn("j", F.from_json("raw_payload", schema))


def parse_bars(bronze: DataFrame, event: str = "AM") -> DataFrame:
    """Minute bars; payloads that can't be read, or lack symbol or start, give none."""
    rows = _parsed(bronze, TOPICS["AM"], BAR_PAYLOAD)
    names = {"o": "open_price", "h": "high_price", "l": "low_price", "c": "close_price", "v": "volume", "vw": "vwap", "n": "trade_count"}
    out = rows.select(
        F.col("j.sym").alias("symbol"), F.col("j.ev").alias("event_type"), *(F.col(f"j.{k}").alias(v) for k, v in names.items()),
        epoch(F.col("j.s")).alias("window_start"), epoch(F.col("j.e")).alias("window_end"), *LINEAGE,
    )
    return out.withColumn("event_date", F.to_date("window_start")).filter((F.col("event_type") == event) & (F.col("symbol") != "") & F.col("window_start").isNotNull())


def parse_trades(bronze: DataFrame) -> DataFrame:
    rows = _parsed(bronze, TOPICS["T"], TRADE_PAYLOAD)
    out = rows.select(
        F.col("j.sym").alias("symbol"), F.col("j.i").alias("trade_id"), F.col("j.p").alias("trade_price"), F.col("j.s").alias("trade_size"),
        F.col("j.x").alias("exchange_id"), F.col("j.z").alias("tape"), epoch(F.col("j.t")).alias("sip_timestamp"),
        epoch(F.col("j.y")).alias("exchange_timestamp"), F.col("j.q").alias("sequence_number"), *LINEAGE,
    )
    return out.withColumn("trade_date", F.to_date("sip_timestamp")).filter((F.col("symbol") != "") & F.col("trade_id").isNotNull())


def parse_quotes(bronze: DataFrame) -> DataFrame:
    rows = _parsed(bronze, TOPICS["Q"], QUOTE_PAYLOAD)
    out = rows.select(
        F.col("j.sym").alias("symbol"), F.col("j.bp").alias("bid_price"), F.col("j.bs").alias("bid_size"), F.col("j.bx").alias("bid_exchange_id"),
        F.col("j.ap").alias("ask_price"), F.col("j.as").alias("ask_size"), F.col("j.ax").alias("ask_exchange_id"),
        epoch(F.col("j.t")).alias("sip_timestamp"), epoch(F.col("j.y")).alias("exchange_timestamp"), F.col("j.q").alias("sequence_number"),
        F.col("j.z").alias("tape"), *LINEAGE,
    )
    whole = (F.col("symbol") != "") & F.col("sip_timestamp").isNotNull() & F.col("bid_price").isNotNull() & F.col("ask_price").isNotNull()
    return out.withColumn("quote_date", F.to_date("sip_timestamp")).filter(whole)


def route(events: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """topic and key of each message by its kind; status messages, unknown kinds, messages without a symbol and texts that aren't whole JSON have no route."""
    kind, symbol = whole_json(payload, "ev"), whole_json(payload, "sym")
    topic = F.create_map(*(F.lit(x) for kv in TOPICS.items() for x in kv))[kind]
    return events.withColumn("topic", topic).withColumn("key", symbol).filter(F.col("topic").isNotNull() & (F.col("key") != ""))


def with_figi(df: DataFrame, master: DataFrame) -> DataFrame:
    """df with composite_figi of its symbol, null if unknown; no row is lost. master must be unique on symbol.

    The planner broadcasts master if its size allows.
    """
    return df.join(master.select("symbol", "composite_figi"), "symbol", "left")


def missing_symbols(df: DataFrame, master: DataFrame) -> DataFrame:
    return df.select("symbol").filter("symbol is not null").distinct().join(master.select("symbol"), "symbol", "left_anti")
