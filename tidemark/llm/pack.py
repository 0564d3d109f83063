"""Filling fixed-capacity containers: sum-of-squares packing.

N(g) is the number of open containers with g tokens of room left. Each item goes where the sum of N(g)**2 over all gaps
0 < g < capacity becomes smallest: into an open container whose gap has many like it, away from gaps that are already
frequent, so that open containers keep a variety of gaps and later items find one that fits. Equal sums go to the tighter
container. Items come largest first; the small ones at the end fill what is left.

The corpus is packed in blocks, each by one task: containers never span blocks. A block holds about ``bins`` containers
and at most about ``rows`` items, so its size doesn't follow the corpus, and what its last open containers waste is a
small share of it; containers less than ``full`` full are opened again at the end of a block and their items packed best fit.

Defined results: an item above the capacity is cut into full containers and one last part, nothing else is cut; an item
of size 0 (empty or null text) takes no room and goes with the block's first container; every row is an item of its own,
repeated rows included; an empty table gives no containers.
"""

from __future__ import annotations

import bisect
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import staged


def sum_of_squares(sizes: np.ndarray, capacity: int, full: float = 0.98) -> np.ndarray:
    """The container of each item, 0 < size <= capacity, in the order given."""
    n = np.zeros(capacity + 1, np.int64)  # open containers by gap; n[0] and n[capacity] stay 0
    at: list[list[int]] = [[] for _ in range(capacity + 1)]
    out = np.empty(len(sizes), np.int64)
    used = 0
    big = np.iinfo(np.int64).max
    for i, s in enumerate(sizes.tolist()):
        here, then = n[s:], n[: capacity - s + 1]  # an open gap, and what it becomes
        change = np.where(here > 0, then - here, big)  # half the change of the sum, less one, but for a gap that closes
        g, best = -1, 2 * int(n[capacity - s]) + 1 if s < capacity else 0  # a new container
        j = int(change.argmin())
        if change[j] < big:
            cost = 2 * int(change[j]) + 2
            if here[0] > 0 and 1 - 2 * int(here[0]) <= cost:
                j, cost = 0, 1 - 2 * int(here[0])
            if cost <= best:
                g = s + j
        if g < 0:
            k, room = used, capacity
            used += 1
        else:
            k, room = at[g].pop(), g
            n[g] -= 1
        out[i] = k
        if room > s:
            at[room - s].append(k)
            n[room - s] += 1
    return _tightened(sizes, out, used, capacity, full)


def _tightened(sizes: np.ndarray, out: np.ndarray, used: int, capacity: int, full: float) -> np.ndarray:
    """Containers less than full are emptied and their items put, largest first, where they fit best."""
    load = np.bincount(out, weights=sizes, minlength=used)
    loose = load < full * capacity
    items = np.flatnonzero(loose[out])
    items = items[np.argsort(-sizes[items], kind="stable")]
    open_: list[tuple[int, int]] = []  # (gap, container), in order
    out, fresh = out.copy(), np.flatnonzero(loose).tolist()[::-1]
    for i in items.tolist():
        s = int(sizes[i])
        j = bisect.bisect_left(open_, (s, -1))
        gap, k = open_.pop(j) if j < len(open_) else (capacity, fresh.pop() if fresh else _new(out))
        out[i] = k
        if gap > s:
            bisect.insort(open_, (gap - s, k))
    return np.unique(out, return_inverse=True)[1]


def _new(out: np.ndarray) -> int:
    return int(out.max()) + 1


def pack(items: DataFrame, specs: list[tuple[str, int]], bins: int = 4096, rows: int = 100_000, full: float = 0.98) -> DataFrame:
    """items (item, n_tokens) into containers of each (name, capacity): one row per item, or per part of an item that is cut.

    Columns: container_name, container_id, item, part (from 0), parts, tokens.
    """
    numbered = staged(items.select("item", "n_tokens").withColumn("u", F.xxhash64(F.monotonically_increasing_id())), "items")
    count, total = numbered.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    for name, capacity in specs:
        if capacity < 1:
            raise ValueError(f"container {name} has no capacity")
    into = [
        F.struct(F.lit(name).alias("container_name"), F.lit(cap).cast("bigint").alias("cap"), F.lit(max(1, math.ceil(total / (cap * bins)), math.ceil(count / rows))).cast("bigint").alias("blocks"))
        for name, cap in specs
    ]
    kind = dict(numbered.dtypes)["item"]
    out = f"container_name string, container_id string, item {kind}, part int, parts int, tokens bigint"

    def block(key: tuple, t: pa.Table) -> pa.Table:
        name, number = key[0].as_py(), key[1].as_py()
        cap = t.column("cap")[0].as_py()
        sizes, u = t.column("n_tokens").to_numpy(), t.column("u").to_numpy()
        parts = np.maximum(1, -(-sizes // cap))
        row = np.repeat(np.arange(len(sizes)), parts)
        part = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
        size = np.minimum(cap, sizes[row] - part * cap)
        order = np.lexsort((part, u[row], -size))
        order = order[size[order] > 0]
        bin_ = np.zeros(len(row), np.int64)
        if len(order):
            bin_[order] = sum_of_squares(size[order], cap, full)
        return pa.table({
            "container_name": pa.array([name] * len(row), pa.string()), "container_id": pa.array([f"{name}-{number}-{x}" for x in bin_.tolist()], pa.string()),
            "item": t.column("item").take(pa.array(row)), "part": pa.array(part, pa.int32()), "parts": pa.array(parts[row], pa.int32()), "tokens": pa.array(size, pa.int64()),
        })

    # as many rows as specs, for each item; a block is bounded by bins and rows
    spread = numbered.select("item", "n_tokens", "u", F.explode(F.array(*into)).alias("s")).select(
        "item", "n_tokens", "u", "s.container_name", "s.cap", F.pmod("u", F.col("s.blocks")).alias("block")
    )
    return spread.groupBy("container_name", "block").applyInArrow(block, out)
