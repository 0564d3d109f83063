"""Late and out-of-order events."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import from_micros, micros, stamp
from tidemark.operators.bars import GOOD_QUOTE, QUOTE_INPUTS, quote_measures
from tidemark.operators.kslack import kslack
from tidemark.session import scratch
from tidemark.sources.tables import table
from tidemark.streaming.kslack import kslack_stream

#: Seconds after a minute's end at which its provisional values are published, and until which late quotes are taken.
GRACE_S, SLACK_S = 120, 3600

#: Keeps rounding off exact halves, on which two engines' last bits decide.
NUDGE = 1e-7


def quote_minutes(quotes: DataFrame) -> DataFrame:
    """Provisional and final statistics per symbol and minute; locked, crossed and zero-bid quotes are left out."""
    return kslack(
        quotes, "symbol", "sip_timestamp", "bronze_ingest_timestamp", "sequence_number", quote_measures(), F.expr(GOOD_QUOTE),
        ranged=("bps",), ordered=("mid", "spread"), slack_s=SLACK_S, grace_s=GRACE_S, inputs=QUOTE_INPUTS,
    )


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minutes amended by quotes that came after publication, and minutes for which quotes came after the cut-off."""
    out = quote_minutes(table(spark, sf_dir, "silver_quotes"))
    which = F.array_compact(F.array(F.when(F.col("n_amended") > 0, F.lit("amended")), F.when(F.col("n_rejected") > 0, F.lit("rejected"))))
    return out.select("symbol", stamp(from_micros(F.col("period"))).alias("window_start"), F.explode(which).alias("outcome"))


def p3_quote_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics themselves."""
    out = quote_minutes(table(spark, sf_dir, "silver_quotes"))
    numbers = [k for k, t in out.dtypes if t == "double"]
    return out.select(
        "symbol", stamp(from_micros(F.col("period"))).alias("window_start"), "n_amended", "n_rejected", "prov_n", "final_n",
        *(F.round(F.col(k) + NUDGE, 4).alias(k) for k in numbers),
    )


#: Deliveries in which p3_stream feeds the quotes to its stream.
DELIVERIES = 6


def p3_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mid prices per symbol and minute out of the live buffer, which is fed the quotes in order of arrival and stopped after every delivery.

    A delivery is worked through and committed before the next is written, so all of the buffers' state passes through the checkpoint.
    """
    at = scratch(spark, "p3-stream")
    q = table(spark, sf_dir, "silver_quotes").select("symbol", "sip_timestamp", "bronze_ingest_timestamp", "sequence_number", "bid_price", "ask_price")
    arrived = micros(F.col("bronze_ingest_timestamp"))
    lo, hi, last = q.agg(F.min(arrived), F.max(arrived), F.max("bronze_ingest_timestamp")).first()
    place = F.least(F.floor((arrived - lo) * DELIVERIES / F.lit((hi or 0) - (lo or 0) + 1)), F.lit(DELIVERIES - 1)) if hi is not None else F.lit(0)
    q.withColumn("delivery", F.coalesce(place, F.lit(0)).cast("int")).write.partitionBy("delivery").parquet(f"{at}/all")
    whole = spark.read.parquet(f"{at}/all")
    def run(rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{at}/in")
        stream = spark.readStream.schema(q.schema).parquet(f"{at}/in")
        out = kslack_stream(stream, "symbol", "sip_timestamp", "bronze_ingest_timestamp", "sequence_number", quote_measures()["mid"], F.expr(GOOD_QUOTE), SLACK_S, GRACE_S)
        put = lambda df, i: df.write.mode("overwrite").parquet(f"{at}/out/batch={i}")
        out.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()

    for i in range(DELIVERIES):
        run(whole.filter(F.col("delivery") == i).drop("delivery"))
    far = last + timedelta(days=2) if last else None
    for i in range(2 if far else 0):  # beats of the clock, after which every buffer is released
        run(spark.createDataFrame([(None, far, far + timedelta(hours=i), 0, None, None)], q.schema))
    out = spark.read.option("basePath", f"{at}/out").schema("key string, period bigint, stage string, n bigint, n_amended bigint, n_missed bigint, open double, close double, mean double").parquet(f"{at}/out")
    now = F.col("stage") == "final"
    got = out.groupBy("key", "period").agg(
        F.max(F.when(F.col("stage") == "provisional", F.col("n"))).alias("prov_n"), F.max(F.when(now, F.struct("n", "n_amended", "open", "close", "mean"))).alias("f"), F.sum("n_missed").alias("n_missed"),
    ).filter("f is not null")
    rounded = lambda x: F.round(x + NUDGE, 4)
    return got.select(
        F.col("key").alias("symbol"), stamp(from_micros(F.col("period"))).alias("window_start"), F.col("f.n_amended").alias("n_amended"), "n_missed", F.coalesce("prov_n", F.lit(0)).alias("prov_n"),
        F.col("f.n").alias("final_n"), rounded(F.col("f.open")).alias("final_open_mid"), rounded(F.col("f.close")).alias("final_close_mid"), rounded(F.col("f.mean")).alias("final_avg_mid"),
    )


QUERIES = {f.__name__: f for f in (p3_found, p3_quote_minutes, p3_stream)}

_FIRST = """
    SELECT symbol, sip_timestamp, sequence_number, bid_price AS bid, ask_price AS ask, bid_size, ask_size, bronze_ingest_timestamp AS arrived,
      date_trunc('minute', sip_timestamp) AS w
    FROM silver_quotes WHERE sip_timestamp IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY symbol, sip_timestamp, sequence_number ORDER BY bronze_ingest_timestamp NULLS LAST) = 1"""

_MEASURES = ("bid", "ask", "spread", "mid", "bps", "bid_size", "ask_size")


def _variant(v: str, most: int) -> str:
    """The aggregates over the events with at most that delay, in microseconds."""
    cols = [f"count(*) AS {v}_n", *(f"round(avg({m}) + {NUDGE}, 4) AS {v}_avg_{m}" for m in _MEASURES)]
    cols += [f"round({f}(bps) + {NUDGE}, 4) AS {v}_{f}_bps" for f in ("min", "max")]
    for m in ("mid", "spread"):
        cols += [f"round(arg_min({m}, i) + {NUDGE}, 4) AS {v}_open_{m}", f"round(arg_max({m}, i) + {NUDGE}, 4) AS {v}_close_{m}"]
        cols.append(f"round(sum({m} * (coalesce(later, stop) - t)) / (any_value(stop) - min(t)) + {NUDGE}, 4) AS {v}_twa_{m}")
    return f"""
        SELECT symbol, w, {", ".join(cols)} FROM (
          SELECT *, epoch_us(sip_timestamp) AS t, epoch_us(w) + 60000000 AS stop, row_number() OVER o AS i, lead(epoch_us(sip_timestamp)) OVER o AS later
          FROM v WHERE delay <= {most} WINDOW o AS (PARTITION BY symbol, w ORDER BY sip_timestamp, sequence_number)) GROUP BY symbol, w"""


SQL = {
    "p3_found": f"""
        WITH f AS ({_FIRST}), v AS (SELECT *, epoch_us(arrived) - epoch_us(w) - 60000000 AS delay FROM f WHERE ask > bid AND bid > 0)
        SELECT DISTINCT symbol, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start,
          CASE WHEN delay <= 3600000000 THEN 'amended' ELSE 'rejected' END AS outcome
        FROM v WHERE delay > 120000000 OR delay IS NULL""",
    "p3_quote_minutes": f"""
        WITH f AS ({_FIRST}),
        v AS (SELECT symbol, w, sip_timestamp, sequence_number, bid, ask, bid_size, ask_size, ask - bid AS spread, (ask + bid) / 2 AS mid,
          (ask - bid) / ((ask + bid) / 2) * 10000 AS bps, coalesce(epoch_us(arrived) - epoch_us(w) - 60000000, 9223372036854775807) AS delay
          FROM f WHERE ask > bid AND bid > 0),
        base AS (SELECT symbol, w, count(*) FILTER (delay > 120000000 AND delay <= 3600000000) AS n_amended, count(*) FILTER (delay > 3600000000) AS n_rejected
          FROM v GROUP BY ALL),
        prov AS ({_variant("prov", 120_000_000)}), final AS ({_variant("final", 3_600_000_000)})
        SELECT base.symbol, strftime(base.w, '%Y-%m-%d %H:%M:%S') AS window_start, n_amended, n_rejected,
          coalesce(prov_n, 0) AS prov_n, coalesce(final_n, 0) AS final_n, prov.* EXCLUDE (symbol, w, prov_n), final.* EXCLUDE (symbol, w, final_n)
        FROM base LEFT JOIN prov ON base.symbol IS NOT DISTINCT FROM prov.symbol AND base.w = prov.w
          LEFT JOIN final ON base.symbol IS NOT DISTINCT FROM final.symbol AND base.w = final.w""",
}
SQL["p3_stream"] = f"""
    SELECT symbol, window_start, n_amended, CAST(0 AS BIGINT) AS n_missed, prov_n, final_n, final_open_mid, final_close_mid, final_avg_mid FROM ({SQL["p3_quote_minutes"]}) WHERE final_n > 0"""
