"""Messages delivered more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import plain
from tidemark.operators.sorted_runs import delivered, exactly_once
from tidemark.sources.tables import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers found on two or more rows."""
    trades = table(spark, sf_dir, "silver_trades").select("symbol", "trade_id", "kafka_offset", "bronze_ingest_timestamp")
    bronze = table(spark, sf_dir, "bronze").select("kafka_topic", "kafka_partition", "kafka_offset", "ingest_timestamp")
    t = exactly_once(trades, ["symbol", "trade_id"], ["kafka_offset", "bronze_ingest_timestamp"], "bronze_ingest_timestamp")
    b = exactly_once(bronze, ["kafka_topic", "kafka_partition", "kafka_offset"], ["ingest_timestamp"], "ingest_timestamp")
    return (
        t.filter("n_copies > 1")
        .select(F.lit("silver_trades").alias("table_name"), F.col("symbol").alias("source_key"), F.col("trade_id").alias("message_id"))
        .unionAll(
            b.filter("n_copies > 1").select(
                F.lit("bronze").alias("table_name"),
                F.concat_ws("/", "kafka_topic", F.col("kafka_partition").cast("string")).alias("source_key"),
                F.col("kafka_offset").cast("string").alias("message_id"),
            )
        )
    )


def p1_trades_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """silver_trades with one whole row per (symbol, trade_id): the copy with the greatest offset."""
    df = table(spark, sf_dir, "silver_trades")
    store = delivered(df, ["symbol", "trade_id"], ["kafka_offset", "bronze_ingest_timestamp"], "bronze_ingest_timestamp")
    store.rewrite()
    store.upsert(df.limit(0), "b0")  # a batch that comes again after the rewrite
    return plain(store.compact(), "exchange_id")


def p1_bronze_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bronze with one whole row per (topic, partition, offset): the copy ingested last."""
    df = table(spark, sf_dir, "bronze")
    return plain(exactly_once(df, ["kafka_topic", "kafka_partition", "kafka_offset"], ["ingest_timestamp"], "ingest_timestamp"))


QUERIES = {f.__name__: f for f in (p1_found, p1_trades_once, p1_bronze_once)}

SQL = {
    "p1_found": """
        SELECT 'silver_trades' AS table_name, symbol AS source_key, trade_id AS message_id
        FROM silver_trades WHERE symbol IS NOT NULL AND trade_id IS NOT NULL GROUP BY symbol, trade_id HAVING count(*) > 1
        UNION ALL
        SELECT 'bronze', kafka_topic || '/' || CAST(kafka_partition AS VARCHAR), CAST(kafka_offset AS VARCHAR)
        FROM bronze WHERE kafka_topic IS NOT NULL AND kafka_partition IS NOT NULL AND kafka_offset IS NOT NULL
        GROUP BY kafka_topic, kafka_partition, kafka_offset HAVING count(*) > 1""",
    "p1_trades_once": """
        SELECT * EXCLUDE (rn) REPLACE (CAST(sip_timestamp AS VARCHAR) AS sip_timestamp, CAST(trade_date AS VARCHAR) AS trade_date, CAST(exchange_id AS VARCHAR) AS exchange_id,
          CAST(exchange_timestamp AS VARCHAR) AS exchange_timestamp, CAST(silver_timestamp AS VARCHAR) AS silver_timestamp,
          CAST(bronze_ingest_timestamp AS VARCHAR) AS bronze_ingest_timestamp) FROM (
          SELECT *, count(*) OVER (PARTITION BY symbol, trade_id) AS n_copies,
            row_number() OVER (PARTITION BY symbol, trade_id ORDER BY kafka_offset DESC NULLS LAST,
              bronze_ingest_timestamp DESC NULLS LAST, composite_figi DESC NULLS LAST, trade_price DESC NULLS LAST,
              trade_size DESC NULLS LAST, exchange_id DESC NULLS LAST, tape DESC NULLS LAST, sip_timestamp DESC NULLS LAST,
              exchange_timestamp DESC NULLS LAST, sequence_number DESC NULLS LAST, trade_date DESC NULLS LAST,
              kafka_topic DESC NULLS LAST, kafka_partition DESC NULLS LAST, silver_timestamp DESC NULLS LAST) AS rn
          FROM silver_trades) WHERE rn = 1""",
    "p1_bronze_once": """
        SELECT * EXCLUDE (rn) REPLACE (CAST(ingest_timestamp AS VARCHAR) AS ingest_timestamp,
          CAST(kafka_timestamp AS VARCHAR) AS kafka_timestamp, CAST(ingest_date AS VARCHAR) AS ingest_date) FROM (
          SELECT *, count(*) OVER (PARTITION BY kafka_topic, kafka_partition, kafka_offset) AS n_copies,
            row_number() OVER (PARTITION BY kafka_topic, kafka_partition, kafka_offset
              ORDER BY ingest_timestamp DESC NULLS LAST, kafka_timestamp DESC NULLS LAST, raw_payload DESC NULLS LAST,
              event_type DESC NULLS LAST, ingest_date DESC NULLS LAST) AS rn
          FROM bronze) WHERE rn = 1""",
}
