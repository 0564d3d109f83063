"""Messages that can't be published now: kept in files by day, with a log of the gaps, and published later.

A spill folder has one folder per UTC date of the spilling, of newline-delimited JSON envelopes. Replaying publishes whole
days in order and renames their files to ``*.replayed``, which readers pass over; files that were written meanwhile wait
for the next replay. A replay that fails has renamed nothing of the day it failed in, so messages may be published twice
but are never lost. Defined results: nothing to spill writes nothing; a folder that isn't there has no files.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.envelopes import ENVELOPE, write_envelopes

DONE = ".replayed"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def spill(envelopes: DataFrame, folder: str, now: datetime | None = None) -> str:
    """The envelopes into the folder of the day, which is returned."""
    day = (now or datetime.now(timezone.utc)).strftime("%Y-%m-%d")
    write_envelopes(envelopes, f"{folder}/{day}")
    return day


def log_gap(spark: SparkSession, folder: str, reason: str, rows: int, now: datetime | None = None) -> None:
    """One line in the log of gaps."""
    line = json.dumps({"at": (now or datetime.now(timezone.utc)).isoformat(), "reason": reason[:500], "rows": rows})
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(f"{folder}/gaps")


def gaps(spark: SparkSession, folder: str) -> DataFrame:
    fs, p = _fs(spark, f"{folder}/gaps")
    schema = "at string, reason string, rows bigint"
    return spark.read.schema(schema).json(f"{folder}/gaps") if fs.exists(p) else spark.createDataFrame([], schema)


def pending(spark: SparkSession, folder: str) -> list[str]:
    """Files that wait to be replayed, by day and name."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    days = [x.getPath() for x in fs.listStatus(p) if x.isDirectory() and x.getPath().getName() != "gaps"]
    files = [f.getPath().toString() for d in days for f in fs.listStatus(d)]
    return sorted(x for x in files if x.endswith(".json"))


def publish_or_spill(envelopes: DataFrame, publish: Callable[[DataFrame], None], folder: str, now: datetime | None = None) -> bool:
    """Publishes the envelopes, or, if that fails, spills them all and logs the gap; says whether they were published."""
    try:
        publish(envelopes)
        return True
    except Exception as e:
        spill(envelopes, folder, now)
        log_gap(envelopes.sparkSession, folder, str(e), envelopes.count(), now)
        return False


def replay(spark: SparkSession, folder: str, publish: Callable[[DataFrame], None]) -> int:
    """Publishes what is pending, day by day, and says how many envelopes that was."""
    files, n = pending(spark, folder), 0
    for day in sorted({x.rsplit("/", 2)[1] for x in files}):
        own = [x for x in files if x.rsplit("/", 2)[1] == day]
        df = spark.read.schema(ENVELOPE).json(own).filter("topic is not null")
        rows = df.agg(F.count(F.lit(1))).first()[0]
        publish(df)
        for x in own:
            fs, p = _fs(spark, x)
            fs.rename(p, _fs(spark, x + DONE)[1])
        n += rows
    return n
