"""Dimensions with history, renamed views, and dated extracts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import c


def current(dimension: DataFrame, key: str, members: list[str] | None = None, valid_to: str = "valid_to") -> DataFrame:
    """The rows valid now, of the members if given, without repeats or the dates of validity."""
    out = dimension.filter(c(valid_to).isNull())
    out = out.filter(c(key).isin(members)) if members is not None else out
    return out.drop(*(x for x in out.columns if x.lower() in (valid_to, "valid_from"))).distinct()


def view(df: DataFrame, names: dict[str, str], day: str | None = None, first: date | None = None) -> DataFrame:
    """The columns named, renamed, from the first date on. The filter stays on the raw column, for pruning."""
    df = df.filter(c(day) >= F.lit(first)) if day and first else df
    return df.select(*(c(k).alias(v) for k, v in names.items()))


def on_date(df: DataFrame, day: str, when: date, key: str, members: list[str], known: str) -> DataFrame:
    """One date's rows of the members whose identity is known."""
    return df.filter((c(day) == F.lit(when)) & c(key).isin(members) & c(known).isNotNull())
