"""One row of figures per batch."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import SparkSession

SCHEMA = "layer string, batch_id int, rows_in bigint, rows_out bigint, duration_ms bigint, started_at timestamp, completed_at timestamp, status string, error_message string"


@dataclass
class Batch:
    rows_in: int | None = None
    rows_out: int | None = None


@contextmanager
def track(spark: SparkSession, path: str | None, layer: str, batch_id: int) -> Iterator[Batch]:
    """Appends a row to the table at path, if there is one; an error is recorded in up to 500 characters and raised again."""
    m, began, start = Batch(), time.monotonic(), datetime.now(timezone.utc)
    status, error = "success", None
    try:
        yield m
    except Exception as e:
        status, error = "error", str(e)[:500]
        raise
    finally:
        if path:
            row = (layer, batch_id, m.rows_in, m.rows_out, int((time.monotonic() - began) * 1000), start, datetime.now(timezone.utc), status, error)
            spark.createDataFrame([row], SCHEMA).write.mode("append").parquet(path)
