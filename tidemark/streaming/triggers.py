"""How often a streaming query runs."""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter


def triggered(writer: DataStreamWriter, mode: str = "availableNow", interval: str = "1 second") -> DataStreamWriter:
    """availableNow or once: all there is, then stop; processingTime: every interval."""
    if mode in ("availableNow", "once"):
        return writer.trigger(availableNow=True)
    if mode == "processingTime":
        return writer.trigger(processingTime=interval)
    raise ValueError(f"no such trigger: {mode}")
