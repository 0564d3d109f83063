"""Broker streams. The connector is a jar that must be on the class path; files of the same columns serve as well."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from tidemark.streaming.triggers import triggered

#: Columns of a broker record.
RECORD = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"


def jaas(user: str, password: str) -> str:
    quote = lambda s: s.replace("\\", "\\\\").replace('"', '\\"')
    return f'org.apache.kafka.common.security.plain.PlainLoginModule required username="{quote(user)}" password="{quote(password)}";'


def read_options(servers: str, pattern: str, user: str | None = None, password: str = "", start: str = "latest") -> dict[str, str]:
    """Topics by pattern; data that has left the broker fails nothing; with a user, over SASL_SSL."""
    out = {"kafka.bootstrap.servers": servers, "subscribePattern": pattern, "startingOffsets": start, "failOnDataLoss": "false"}
    if user is not None:
        out |= {"kafka.security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "PLAIN", "kafka.sasl.jaas.config": jaas(user, password)}
    return out


def read_stream(spark: SparkSession, **kw: str) -> DataFrame:
    return spark.readStream.format("kafka").options(**read_options(**kw)).load()


def read_files(spark: SparkSession, path: str, files: int | None = None) -> DataFrame:
    """Records kept as parquet files, as a stream."""
    reader = spark.readStream.schema(RECORD)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(path)


def write_stream(envelopes: DataFrame, servers: str, checkpoint: str, mode: str = "processingTime") -> DataStreamWriter:
    """Envelopes to their topics: all replicas acknowledge, no duplicates from retries, compressed."""
    out = envelopes.select("topic", "key", "value").writeStream.format("kafka").option("checkpointLocation", checkpoint)
    for k, v in {"bootstrap.servers": servers, "acks": "all", "enable.idempotence": "true", "compression.type": "lz4", "linger.ms": "50"}.items():
        out = out.option(f"kafka.{k}", v)
    return triggered(out, mode)
