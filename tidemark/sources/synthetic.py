"""Made-up bar messages, with given shares of repeated and late ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def bar_messages(spark: SparkSession, symbols: list[str], minutes: int, repeat_rate: float = 0.0, late_rate: float = 0.0, seed: int = 0, start_ms: int = 1716480000000) -> DataFrame:
    """seq, delay_s and payload of one message per symbol and minute; repeated ones come twice, late ones ten minutes after.

    The same seed gives the same messages, however many partitions make them.
    """
    n = len(symbols)
    draw = lambda what: (F.pmod(F.xxhash64(F.lit(seed), F.lit(what), "id"), F.lit(1_000_000)) / 1_000_000)
    ids = spark.range(n * minutes)
    s = F.lit(start_ms) + F.floor(F.col("id") / n) * 60_000
    price = F.round(100 + draw("price") * 10, 2)
    payload = F.to_json(F.struct(
        F.lit("AM").alias("ev"), F.element_at(F.array(*map(F.lit, symbols)), (F.col("id") % n + 1).cast("int")).alias("sym"), price.alias("o"), (price + 1).alias("h"),
        (price - 1).alias("l"), price.alias("c"), F.floor(draw("v") * 10_000).alias("v"), price.alias("vw"), F.lit(10).alias("n"), s.alias("s"), (s + 60_000).alias("e"),
    ))
    copies = F.sequence(F.lit(1), F.when(draw("repeat") < repeat_rate, 2).otherwise(1))
    delay = F.when(draw("late") < late_rate, 600).otherwise(0)
    out = ids.select(F.col("id").alias("seq"), delay.alias("delay_s"), payload.alias("payload"), copies.alias("copies"))
    return out.withColumn("copies", F.explode("copies")).drop("copies")
