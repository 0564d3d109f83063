"""Naming helpers: columns of any name, and names that clash with nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def c(name: str) -> Column:
    """The top-level column of that exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(df: DataFrame, name: str) -> str:
    """name, with as many underscores after it as keep it apart from df's columns."""
    taken = {x.lower() for x in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def micros(col: Column) -> Column:
    """Microseconds since 1970 of a timestamp without zone (read as UTC) or with one."""
    return F.unix_micros(col.cast("timestamp"))


def from_micros(col: Column) -> Column:
    """The timestamp without zone, in UTC."""
    return F.timestamp_micros(col).cast("timestamp_ntz")


def stamp(col: Column) -> Column:
    """yyyy-MM-dd HH:mm:ss, whole seconds."""
    return F.date_format(col.cast("timestamp"), "yyyy-MM-dd HH:mm:ss")


def plain(df: DataFrame, *also: str) -> DataFrame:
    """df with its dates and timestamps, and the columns also, as text: for comparing engines whose types differ."""
    text = ("date", "timestamp", "timestamp_ntz")
    return df.select(*(c(n).cast("string").alias(n) if k in text or n in also else c(n) for n, k in df.dtypes))
