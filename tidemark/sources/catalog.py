"""Tables of the pipeline and views that rename their columns, made where they don't exist yet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.columns import c

_LINEAGE = "kafka_topic string, kafka_partition int, kafka_offset bigint"
_LOADED = "bronze_ingest_timestamp timestamp, silver_timestamp timestamp"
_OHLC = "open_price double, high_price double, low_price double, close_price double, volume bigint, vwap double"
_QUOTE = "bid_price double, bid_size int, bid_exchange_id int, ask_price double, ask_size int, ask_exchange_id int"
_TRADE = "composite_figi string, symbol string, trade_id string, trade_price double, trade_size int, exchange_id int, tape int, sip_timestamp timestamp, exchange_timestamp timestamp, sequence_number bigint, trade_date date"
_STATS = (
    "avg_bid_price double, avg_ask_price double, avg_spread_dollars double, avg_spread_bps double, min_spread_bps double, max_spread_bps double, avg_mid_price double, "
    "avg_bid_size double, avg_ask_size double, bid_size_total bigint, ask_size_total bigint, order_imbalance double"
)
_BAR = f"composite_figi string, symbol string, event_type string, window_start timestamp, window_end timestamp, event_date date, {_OHLC}, trade_count int"

#: The columns of each table, and those it is partitioned by.
TABLES: dict[str, tuple[str, tuple[str, ...]]] = {
    "bronze": (f"{_LINEAGE}, kafka_timestamp timestamp, raw_payload string, ingest_timestamp timestamp, event_type string, ingest_date date", ("ingest_date", "kafka_topic")),
    "silver_bars": (f"{_BAR}, {_LINEAGE}, {_LOADED}", ("event_date",)),
    "silver_trades": (f"{_TRADE}, {_LINEAGE}, {_LOADED}", ("trade_date",)),
    "silver_quotes": (f"composite_figi string, symbol string, {_QUOTE}, sip_timestamp timestamp, exchange_timestamp timestamp, sequence_number bigint, tape int, quote_date date, {_LINEAGE}, {_LOADED}", ("quote_date",)),
    "gold_minute_bars": (f"{_BAR}, silver_timestamp timestamp", ("event_date",)),
    "gold_daily_rollup": (f"composite_figi string, symbol string, event_date date, {_OHLC}, total_trades bigint, bar_count bigint, first_bar_start timestamp, last_bar_start timestamp, updated_at timestamp", ("event_date",)),
    "gold_trades": (f"{_TRADE}, silver_timestamp timestamp", ("trade_date",)),
    "gold_quote_stats": (f"composite_figi string, symbol string, window_start timestamp, quote_date date, quote_count bigint, {_STATS}, updated_at timestamp", ("quote_date",)),
    "batch_daily_prices": (f"composite_figi string, symbol string, price_date date, {_OHLC}, source string, loaded_at timestamp", ("price_date",)),
    "pipeline_batch_metrics": ("layer string, batch_id int, rows_in bigint, rows_out bigint, duration_ms bigint, started_at timestamp, completed_at timestamp, status string, error_message string", ("layer",)),
}

#: Views: the table, its columns as the view names them, and its date, by which only sessions from the first one on are seen.
VIEWS: dict[str, tuple[str, dict[str, str], str | None]] = {
    "stg_daily_rollup": ("gold_daily_rollup", {"event_date": "price_date", "updated_at": "streaming_updated_at"}, "event_date"),
    "stg_minute_bars": ("gold_minute_bars", {}, "event_date"),
    "stg_quote_stats": ("gold_quote_stats", {"updated_at": "streaming_updated_at"}, "quote_date"),
    "stg_trades": ("gold_trades", {}, "trade_date"),
    "stg_daily_prices": ("batch_daily_prices", {"source": "batch_source", "loaded_at": "batch_loaded_at"}, None),
    "stg_batch_metrics": ("pipeline_batch_metrics", {}, None),
}


def name_of(table: str, environment: str = "dev", names: dict[str, str] | None = None) -> str:
    """The table's full name in an environment: names gives its database, by default one of the environment's name."""
    return f"{(names or {}).get(environment, f'tidemark_{environment}')}.{table}"


def create_tables(spark: SparkSession, database: str, location: str, tables: dict[str, tuple[str, tuple[str, ...]]] = TABLES) -> None:
    """The database and its tables, as parquet under location; those that exist stay as they are. Times are wall-clock times."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}/_database'")
    for name, (columns, parts) in tables.items():
        columns = columns.replace(" timestamp", " timestamp_ntz")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet PARTITIONED BY ({', '.join(parts)}) LOCATION '{location}/{name}'")


def create_views(spark: SparkSession, database: str, first: str | None = None, views: dict[str, tuple[str, dict[str, str], str | None]] = VIEWS) -> None:
    """The views over the database's tables, replaced if they exist. The filter is on the partition column, so that it prunes."""
    for name, (table, renamed, day) in views.items():
        columns = ", ".join(f"{x} AS {renamed[x]}" if x in renamed else x for x in spark.table(f"{database}.{table}").columns)
        where = f" WHERE {day} >= DATE '{first}'" if first and day else ""
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT {columns} FROM {database}.{table}{where}")


def load_table(spark: SparkSession, database: str, name: str, df: DataFrame) -> None:
    """df into a table, by name; the partitions it has are replaced."""
    order = spark.table(f"{database}.{name}").columns
    df.select(*order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(f"{database}.{name}")


def load_tables(spark: SparkSession, database: str, readers: dict[str, Callable[[], DataFrame]], names: list[str] | None = None) -> dict[str, int]:
    """Tables from their readers, all or those named, each with its rows. A name without a reader is an error before anything is loaded."""
    unknown = set(names or []) - set(readers)
    if unknown:
        raise KeyError(f"no reader for {', '.join(sorted(unknown))}")
    out = {}
    for name in names or readers:
        load_table(spark, database, name, readers[name]())
        out[name] = spark.table(f"{database}.{name}").count()
    return out


def plain_numbers(df: DataFrame) -> DataFrame:
    """df with its decimals as doubles, for what computes with floating-point numbers."""
    return df.withColumns({n: c(n).cast("double") for n, k in df.dtypes if k.startswith("decimal")})


def drop_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
