"""Loads into tables: whole, appended, by date, in bulk, by row."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import c

#: Rows of one bulk file at most.
PART_ROWS = 1_000_000
#: Rows from which a load goes in bulk.
BULK_ROWS = 50_000


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def swap(spark: SparkSession, fresh: str, path: str) -> None:
    """The folder fresh in place of path, by renames: at any time the old rows or the new ones are whole, under path or path_before."""
    fs, new = _at(spark, fresh)
    old, before = (_at(spark, x)[1] for x in (path, f"{path}_before"))
    if fs.exists(old):
        fs.delete(before, True)
        fs.rename(old, before)
    fs.rename(new, old)
    fs.delete(before, True)


def replace(df: DataFrame, path: str) -> None:
    """The whole table: written beside it, then swapped in. df may read the table it replaces."""
    fresh = f"{path}_fresh"
    df.write.mode("overwrite").parquet(fresh)
    swap(df.sparkSession, fresh, path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_dates(df: DataFrame, path: str, date: str) -> None:
    """Only the dates that df has; the same load twice changes nothing. A date's rows are gathered into as many files as their size asks for."""
    df.hint("rebalance", c(date)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date).parquet(path)


def without_zones(df: DataFrame) -> DataFrame:
    """Instants as wall-clock times in UTC."""
    return df.withColumns({n: F.convert_timezone(F.current_timezone(), F.lit("UTC"), c(n).cast("timestamp_ntz")) for n, k in df.dtypes if k == "timestamp"})


def bulk(df: DataFrame, path: str) -> None:
    """Upper-case names, in files of a useful size and a million rows at most; readers match columns by name."""
    df = without_zones(df)
    df.toDF(*(x.upper() for x in df.columns)).hint("rebalance").write.option("maxRecordsPerFile", PART_ROWS).mode("append").parquet(path)


def load(df: DataFrame, path: str, mode: str = "replace", threshold: int = BULK_ROWS, jdbc: dict[str, str] | None = None) -> int:
    """Loads df and says how many rows it had: by row over JDBC below the threshold, if there is a connection; else in bulk.

    df is worked out once, beside the table; nothing is touched if it is empty.
    """
    spark, fresh = df.sparkSession, f"{path}_load"
    _at(spark, fresh)[0].delete(_at(spark, fresh)[1], True)
    bulk(df, fresh)
    ready = spark.read.parquet(fresh)
    rows = ready.count()
    try:
        if rows and jdbc and rows < threshold:
            ready.write.format("jdbc").options(**jdbc).option("truncate", "true").mode("overwrite" if mode == "replace" else "append").save()
        elif rows and mode == "replace":
            swap(spark, fresh, path)
        elif rows:
            append(ready, path)
    finally:
        _at(spark, fresh)[0].delete(_at(spark, fresh)[1], True)
    return rows


def sync(tables: dict[str, Callable[[], DataFrame]], folder: str, every_s: float = 60.0, rounds: int | None = 1, skip: tuple[str, ...] = ()) -> list[dict[str, int]]:
    """Loads small tables whole, again and again at a steady beat (a round that takes longer is followed at once), and says how many rows each had in each round."""
    out = []
    while rounds is None or len(out) < rounds:
        began = time.monotonic()
        out.append({name: load(make(), f"{folder}/{name}") for name, make in tables.items() if name not in skip})
        if rounds is None or len(out) < rounds:
            time.sleep(max(0.0, every_s - (time.monotonic() - began)))
    return out


def dry_run(df: DataFrame, every: int = 100) -> list[str]:
    """Instead of a load: one row in every so many, as text, and nothing else happens."""
    some = df.withColumn("__n", F.pmod(F.xxhash64(*map(c, df.columns)), F.lit(every))).filter("__n = 0").drop("__n")
    return [r[0] for r in some.select(F.to_json(F.struct("*"))).limit(1000).collect()]


def parity(source: DataFrame, sink: DataFrame) -> DataFrame:
    """source_rows, sink_rows, matches."""
    one = lambda df, n: df.agg(F.count(F.lit(1)).alias(n)).withColumn("one", F.lit(1))
    both = one(source, "source_rows").join(one(sink, "sink_rows"), "one").drop("one")
    return both.withColumn("matches", F.col("source_rows") == F.col("sink_rows"))
