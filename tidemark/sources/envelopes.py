"""Envelopes as newline-delimited JSON, symbol lists, and the product of channels and symbols."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENVELOPE = "topic string, key string, value string, trace_id string"


def write_envelopes(df: DataFrame, path: str) -> None:
    """One JSON object a line."""
    df.select("topic", "key", "value", F.coalesce("trace_id", F.lit("")).alias("trace_id")).write.mode("append").json(path)


def read_envelopes(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """All files under path of that pattern; blank lines give nothing, files renamed after a replay don't match."""
    return spark.read.schema(ENVELOPE).option("pathGlobFilter", pattern).option("ignoreMissingFiles", "true").json(path).filter("topic is not null")


def read_symbols(spark: SparkSession, path: str) -> DataFrame:
    """Symbols of a text file, one a line, upper-cased; blank lines are left out."""
    return spark.read.text(path).select(F.upper(F.trim("value")).alias("symbol")).filter("symbol <> ''").distinct()


def subscriptions(channels: list[str], symbols: DataFrame, only: dict[str, list[str]] | None = None) -> DataFrame:
    """Every channel with every symbol, or, for the channels in only, with those; an explode, not a join."""
    out = symbols.select(F.explode(F.array(*map(F.lit, channels))).alias("channel"), "symbol")
    for channel, own in (only or {}).items():
        out = out.filter((F.col("channel") != channel) | F.col("symbol").isin(own))
    return out.withColumn("param", F.concat_ws(".", "channel", "symbol"))
