"""Named models, what each is made of, and building them as views or tables in that order."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import analytics as A
from tidemark.operators import bars as B


@dataclass(frozen=True)
class Model:
    make: Callable[..., DataFrame]
    needs: tuple[str, ...]
    table: bool = False


def _known(df: DataFrame) -> DataFrame:
    return df.filter("composite_figi is not null")


#: Sources: bars, trades, quote_stats.
MODELS = {
    "daily": Model(B.daily_bars, ("bars",)),
    "closes": Model(B.session_close, ("bars",)),
    "minute_returns": Model(A.minute_returns, ("bars",)),
    "daily_returns": Model(lambda d, c: _known(A.daily_returns(d, c)), ("daily", "closes")),
    "trade_flow": Model(A.trade_flow, ("trades",)),
    "daily_stats": Model(A.daily_stats, ("minute_returns", "daily_returns"), True),
    "unusual_activity": Model(A.unusual_activity, ("daily_stats",), True),
    "correlation_matrix": Model(A.correlation_matrix, ("daily_returns",), True),
    "volume_profile": Model(A.volume_profile, ("minute_returns",), True),
    "microstructure_daily": Model(A.microstructure_daily, ("trade_flow", "quote_stats"), True),
    "spread_profile": Model(A.spread_profile, ("quote_stats", "trade_flow"), True),
    "pipeline_health": Model(A.pipeline_health, ("bars",), True),
    "data_quality": Model(A.bar_quality, ("bars",), True),
    "trade_size_distribution": Model(A.size_distribution, ("trade_flow",), True),
}


def order(names: list[str] | None = None, models: dict[str, Model] = MODELS) -> list[str]:
    """The models asked for and all they need, each after what it needs."""
    todo, graph = list(names or models), {}
    while todo:
        x = todo.pop()
        if x in models and x not in graph:
            graph[x] = models[x].needs
            todo += models[x].needs
    return [x for x in TopologicalSorter(graph).static_order() if x in models]


def build(spark: SparkSession, sources: dict[str, DataFrame], out: str, names: list[str] | None = None, models: dict[str, Model] = MODELS) -> dict[str, DataFrame]:
    """Views stay lazy, so that the planner sees through them; tables are written under out and read again."""
    made = dict(sources)
    for x in order(names, models):
        m = models[x]
        df = m.make(*(made[y] for y in m.needs))
        if m.table:
            df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{out}/{x}")
            df = spark.read.schema(df.schema).parquet(f"{out}/{x}")
        made[x] = df
    return {x: made[x] for x in order(names, models)}
