"""Files of messages to log, typed tables and serving tables, as streaming queries.

Each layer has its own checkpoint. Late and repeated messages are made good by recomputation: a batch's changes say which
dates it touches, and those dates are aggregated again from the whole typed table. So the end result doesn't depend on
how messages were split into batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.operators.bars import affected_dates, affected_minutes, daily_bars, quote_stats
from tidemark.operators.ingest import parse_bars, parse_quotes, parse_trades, with_figi
from tidemark.operators.latest import keep_latest
from tidemark.operators.upsert import KeyedTable
from tidemark.streaming.metrics import track
from tidemark.streaming.triggers import triggered

#: Keys of the typed tables.
BAR_KEYS, TRADE_KEYS, QUOTE_KEYS = ["symbol", "window_start"], ["symbol", "trade_id"], ["symbol", "sip_timestamp", "sequence_number"]


def log_stream(spark: SparkSession, source: str, schema: StructType, out: str, checkpoint: str, files: int | None = None, mode: str = "availableNow") -> StreamingQuery:
    """Append-only copy of arriving files."""
    reader = spark.readStream.schema(schema)
    reader = reader.option("maxFilesPerTrigger", files) if files else reader
    writer = reader.parquet(source).writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint)
    return triggered(writer.partitionBy("ingest_date", "kafka_topic"), mode).start()


def _batches(spark: SparkSession, source: str, schema: StructType, batch, checkpoint: str, files: int | None, mode: str) -> StreamingQuery:
    reader = spark.readStream.schema(schema)
    reader = reader.option("maxFilesPerTrigger", files) if files else reader
    return triggered(reader.parquet(source).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint), mode).start()


def typed_stream(spark: SparkSession, bronze: str, schema: StructType, parse: Callable[[DataFrame], DataFrame], master: DataFrame, table: KeyedTable, checkpoint: str, metrics: str | None = None, layer: str = "silver", files: int | None = None, mode: str = "availableNow") -> StreamingQuery:
    """Log to typed rows of one channel, with their FIGI, upserted by the table's keys."""

    def batch(df: DataFrame, batch_id: int) -> None:
        with track(spark, metrics, layer, batch_id) as m:
            m.rows_in = df.count() if metrics else None
            table.upsert(with_figi(parse(df), master), batch_id)

    return _batches(spark, bronze, schema, batch, checkpoint, files, mode)


def bars_stream(spark: SparkSession, bronze: str, schema: StructType, master: DataFrame, table: KeyedTable, checkpoint: str, metrics: str | None = None, files: int | None = None, mode: str = "availableNow") -> StreamingQuery:
    """Log to typed minute bars, upserted by (symbol, window_start)."""
    return typed_stream(spark, bronze, schema, parse_bars, master, table, checkpoint, metrics, "silver_am", files, mode)


def trades_stream(spark: SparkSession, bronze: str, schema: StructType, master: DataFrame, table: KeyedTable, checkpoint: str, metrics: str | None = None, files: int | None = None, mode: str = "availableNow") -> StreamingQuery:
    """Log to typed trades, upserted by (symbol, trade_id)."""
    return typed_stream(spark, bronze, schema, parse_trades, master, table, checkpoint, metrics, "silver_trades", files, mode)


def quotes_stream(spark: SparkSession, bronze: str, schema: StructType, master: DataFrame, table: KeyedTable, checkpoint: str, metrics: str | None = None, files: int | None = None, mode: str = "availableNow") -> StreamingQuery:
    """Log to typed quotes, upserted by (symbol, sip_timestamp, sequence_number)."""
    return typed_stream(spark, bronze, schema, parse_quotes, master, table, checkpoint, metrics, "silver_quotes", files, mode)


def changes_stream(spark: SparkSession, table: KeyedTable, schema: StructType, apply: Callable[[DataFrame], DataFrame], out: KeyedTable, checkpoint: str, metrics: str | None = None, layer: str = "gold", files: int | None = None, mode: str = "availableNow", first_version: int = 0) -> StreamingQuery:
    """A table's changes of version first_version or later, one per key and batch, made into rows of out by apply."""

    def batch(df: DataFrame, batch_id: int) -> None:
        with track(spark, metrics, layer, batch_id) as m:
            changed = df.filter(F.col("_change_type").isin("insert", "update_postimage") & (F.col("_commit_version") >= first_version))
            changed = keep_latest(changed, table.keys, "_commit_version").filter("composite_figi is not null").persist()
            try:
                m.rows_in = changed.count()
                if m.rows_in:
                    out.upsert(apply(changed).withColumn("version", F.lit(batch_id).cast("bigint")), batch_id)
            finally:
                changed.unpersist()

    return _batches(spark, f"{table.path}_changes", schema, batch, checkpoint, files, mode)


def daily_stream(spark: SparkSession, bars: KeyedTable, schema: StructType, out: KeyedTable, checkpoint: str, files: int | None = None, mode: str = "availableNow", metrics: str | None = None, first_version: int = 0) -> StreamingQuery:
    """Changes of the bars to daily roll-ups of the dates they touch, from all known bars of those dates."""
    days = lambda changed: daily_bars(affected_dates(bars.read(), changed, "event_date").filter("composite_figi is not null"))
    return changes_stream(spark, bars, schema, days, out, checkpoint, metrics, "gold_daily", files, mode, first_version)


def served_stream(spark: SparkSession, table: KeyedTable, schema: StructType, out: KeyedTable, checkpoint: str, columns: list[str] | None = None, files: int | None = None, mode: str = "availableNow", metrics: str | None = None, first_version: int = 0) -> StreamingQuery:
    """Changes of a typed table into a serving table of the same rows, those of known FIGI."""
    rows = lambda changed: changed.select(*columns) if columns else changed.drop("_change_type", "_commit_version", "batch_id")
    return changes_stream(spark, table, schema, rows, out, checkpoint, metrics, "gold_rows", files, mode, first_version)


def quote_stats_stream(spark: SparkSession, quotes: KeyedTable, schema: StructType, out: KeyedTable, checkpoint: str, files: int | None = None, mode: str = "availableNow", metrics: str | None = None, first_version: int = 0) -> StreamingQuery:
    """Changes of the quotes to statistics of the minutes they touch, from all known quotes of those minutes."""
    stats = lambda changed: quote_stats(affected_minutes(quotes.read(), changed, "sip_timestamp", "quote_date").filter("composite_figi is not null"))
    return changes_stream(spark, quotes, schema, stats, out, checkpoint, metrics, "gold_quotes", files, mode, first_version)
