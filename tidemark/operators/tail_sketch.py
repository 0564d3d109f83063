"""Percentiles of very large numeric columns: relative-rank compactors.

A sketch is a ladder of buffers; an item on level h stands for 2**h values. When a buffer is full, part of its lower end is
sorted and every other item of it moves one level up, the rest is dropped; how much of the buffer takes part follows the
count of earlier compactions (as many sections as that count has trailing ones, and one), and the upper half never does. So
the greatest values are kept exactly or nearly so, and the error of a rank is proportional to its distance from the top:
for the value at rank r of n, with section size k, one standard deviation is about ``0.1306 / k * (n - r)`` positions. A group has
two such sketches, one of its values and one of their negatives, and a percentile is read from the one that protects its
tail, so the error is proportional to the distance from the nearer end, whichever that is. The
reported bound is ``DEVIATIONS`` of them, so that it holds over very many groups at once. Sections grow in number and shrink in size as a buffer sees more compactions.

Sketches merge level by level, in any grouping, under the same bound, so those of input partitions make those of days, and
those of days make that of all days. Values reach a sketch before any exchange; only sketches are shuffled, and a hot
group costs no more than any other: each input partition sends one sketch of it. Where very many partitions send one,
they are merged in two rounds.

Defined results: nulls and NaN have no rank and are left out of n; a group without any value gives no row; infinite values
rank at the ends; a null key is a key of its own; with fewer than 6 * k values in a group all percentiles are exact, and the
one at p is the least value at or below which lie p * n values or more; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import c

SECTION = 32
SECTIONS = 3
#: Standard deviation of a rank, over k and over the distance from the top.
SPREAD = (0.0512 / SECTIONS) ** 0.5
#: Standard deviations in the reported bound.
DEVIATIONS = 5
MASK = (1 << 64) - 1
#: Groups held at once by a task; beyond, their sketches so far are sent on and begun anew, to be merged later.
GROUPS = 20_000


class TailSketch:
    """The greatest values protected, in float64."""

    def __init__(self, k: int = SECTION, seed: int = 0):
        self.k, self.n, self.coins = k, 0, (seed * 2862933555777941757 + 3037000493) & MASK
        self.items: list[np.ndarray] = [np.empty(0)]
        self.shape: list[list[float]] = [[k, SECTIONS, 0]]  # by level: section size, sections, compactions

    def _coin(self) -> int:
        self.coins = (self.coins * 6364136223846793005 + 1442695040888963407) & MASK
        return self.coins >> 63

    def _room(self, h: int) -> int:
        size, sections, _ = self.shape[h]
        return 2 * _even(size) * int(sections)

    def update(self, values: np.ndarray) -> None:
        # in parts, so that a long run meets the buffers as single values would
        part = max(4 * self._room(0), 1)
        for i in range(0, len(values), part):
            x = values[i : i + part]
            self.n += len(x)
            self.items[0] = np.concatenate([self.items[0], x])
            self._compress()

    def merge(self, other: TailSketch) -> None:
        self.n += other.n
        while len(self.items) < len(other.items):
            self._level()
        for h, x in enumerate(other.items):
            self.items[h] = np.concatenate([self.items[h], x])
            a, b = self.shape[h], other.shape[h]
            self.shape[h] = [min(a[0], b[0]), max(a[1], b[1]), int(a[2]) | int(b[2])]
        self._compress()

    def _level(self) -> None:
        self.items.append(np.empty(0))
        self.shape.append([self.k, SECTIONS, 0])

    def _compress(self) -> None:
        h = 0
        while h < len(self.items):
            while len(self.items[h]) >= self._room(h):
                size, sections, count = self.shape[h]
                count = int(count)
                ones = ((count + 1) & -(count + 1)).bit_length() - 1  # trailing ones of count
                take = min(ones + 1, int(sections))
                keep = self._room(h) // 2 + (int(sections) - take) * _even(size)
                x = np.sort(self.items[h])
                part = len(x) - keep
                part -= part % 2
                if h + 1 == len(self.items):
                    self._level()
                coin = self._coin()
                self.items[h + 1] = np.concatenate([self.items[h + 1], x[coin:part:2]])
                self.items[h] = x[part:]
                count += 1
                if count >= 1 << (int(sections) - 1) and _even(size / 2**0.5) >= 4:
                    size, sections, count = size / 2**0.5, sections * 2, 0
                self.shape[h] = [size, sections, count]
            h += 1

    def quantiles(self, ps: list[float]) -> list[float]:
        return self._read(lambda total: [np.ceil(p * total) if p > 0 else 1 for p in ps])

    def mirrored(self, ps: list[float]) -> list[float]:
        """Of a sketch of negatives, the quantiles of the values."""
        return [-x for x in self._read(lambda total: [total - (np.ceil(p * total) if p > 0 else 1) + 1 for p in ps])]

    def _read(self, ranks: Callable[[int], list[float]]) -> list[float]:
        x = np.concatenate(self.items)
        w = np.concatenate([np.full(len(v), 1 << h, np.int64) for h, v in enumerate(self.items)])
        o = np.argsort(x, kind="stable")
        up = np.cumsum(w[o])
        # what compaction left odd is a few weights more or less than n
        x = x[o]
        return [float(x[min(np.searchsorted(up, r), len(x) - 1)]) for r in ranks(up[-1])]

    def pack(self) -> bytes:
        head = [float(self.k), float(self.n), float(len(self.items))]
        for x, s in zip(self.items, self.shape):
            head += [float(len(x)), *map(float, s)]
        return np.concatenate([np.array(head), *self.items]).tobytes()

    @classmethod
    def unpack(cls, raw: bytes) -> TailSketch:
        a = np.frombuffer(raw, np.float64)
        s = cls(int(a[0]), zlib.crc32(raw))
        s.n, levels = int(a[1]), int(a[2])
        head = a[3 : 3 + 4 * levels].reshape(levels, 4)
        s.shape = [[x[1], x[2], int(x[3])] for x in head.tolist()]
        cuts = np.cumsum(head[:, 0].astype(int))
        s.items = [x.copy() for x in np.split(a[3 + 4 * levels :], cuts[:-1])]
        return s


class TwoTails:
    """A sketch of values and one of their negatives: both tails are protected."""

    def __init__(self, k: int = SECTION, seed: int = 0):
        self.up, self.down = TailSketch(k, seed), TailSketch(k, seed + 1)

    @property
    def n(self) -> int:
        return self.up.n

    @property
    def exact(self) -> bool:
        return len(self.up.items) == 1

    def update(self, values: np.ndarray) -> None:
        self.up.update(values)
        self.down.update(-values)

    def merge(self, other: TwoTails) -> None:
        self.up.merge(other.up)
        self.down.merge(other.down)

    def quantiles(self, ps: list[float]) -> list[float]:
        high, low = self.up.quantiles(ps), self.down.mirrored(ps)
        return [a if p >= 0.5 or self.exact else b for p, a, b in zip(ps, high, low)]

    def pack(self) -> bytes:
        a = self.up.pack()
        return len(a).to_bytes(8, "little") + a + self.down.pack()

    @classmethod
    def unpack(cls, raw: bytes) -> TwoTails:
        out, n = cls.__new__(cls), int.from_bytes(raw[:8], "little")
        out.up, out.down = TailSketch.unpack(raw[8 : 8 + n]), TailSketch.unpack(raw[8 + n :])
        return out


def _even(x: float) -> int:
    return max(4, 2 * round(x / 2))


def rank_bound(k: int, p: float) -> float:
    """The bound of the rank at p in a sketch of values, as a share of n."""
    return DEVIATIONS * SPREAD / k * (1 - p)


def nearer_bound(k: int, p: float) -> float:
    """The bound of the rank at p where both tails are protected."""
    return rank_bound(k, max(p, 1 - p))


def _build(k: int, n_keys: int, rows: int = 1 << 18):
    """Rows of keys and a value to one sketch per group of the partition."""
    names = [f"k{i}" for i in range(n_keys)]

    def flush(parts: list[pa.RecordBatch], made: dict) -> None:
        t = pa.Table.from_batches(parts)
        v = t.column("v").to_numpy(zero_copy_only=False)
        groups = t.select(names).to_pandas().groupby(names, sort=False, dropna=False).ngroup().to_numpy() if names else np.zeros(len(v), int)
        o = np.argsort(groups, kind="stable")
        firsts = np.flatnonzero(np.r_[True, np.diff(groups[o]) != 0])
        heads = t.select(names).take(pa.array(o[firsts])) if names else None
        keys = zip(*(x.to_pylist() for x in heads.columns)) if names else [()]
        for key, x in zip(keys, np.split(v[o], firsts[1:])):
            if key not in made:
                made[key] = TwoTails(k, zlib.crc32(repr((key, len(x), float(x[0]))).encode()))
            made[key].update(x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, parts, held, schema = {}, [], 0, None

        def sent() -> Iterator[pa.RecordBatch]:
            done = list(made.items())
            made.clear()
            for i in range(0, len(done), 256):
                some = done[i : i + 256]
                cols = [pa.array([x[0][j] for x in some], schema.field(f"k{j}").type) for j in range(n_keys)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array([x[1].pack() for x in some], pa.binary())], names=[*names, "sketch"])

        for b in batches:
            if b.num_rows:
                parts.append(b)
                held += b.num_rows
                schema = b.schema
            if held >= rows:
                flush(parts, made)
                parts, held = [], 0
                if len(made) > GROUPS:
                    yield from sent()
        if held:
            flush(parts, made)
        yield from sent()

    return run


def _merge(n_keys: int):
    """Sketches in order of their keys to one for each."""
    names = [f"k{i}" for i in range(n_keys)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now, schema, out = None, None, None, []

        def emit(some: list) -> pa.RecordBatch:
            cols = [pa.array([x[0][j] for x in some], schema.field(f"k{j}").type) for j in range(n_keys)]
            return pa.RecordBatch.from_arrays([*cols, pa.array([x[1] for x in some], pa.binary())], names=[*names, "sketch"])

        for b in batches:
            schema = b.schema
            keys = list(zip(*(b.column(j).to_pylist() for j in range(n_keys)))) if n_keys else [()] * b.num_rows
            for k, raw in zip(keys, b.column(n_keys).to_pylist()):
                if now is not None and k == key:
                    if isinstance(now, bytes):
                        now = TwoTails.unpack(now)
                    now.merge(TwoTails.unpack(raw))
                    continue
                if now is not None:
                    out.append((key, now if isinstance(now, bytes) else now.pack()))
                key, now = k, raw
                if len(out) >= 256:
                    yield emit(out)
                    out = []
        if now is not None:
            out.append((key, now if isinstance(now, bytes) else now.pack()))
        if out:
            yield emit(out)

    return run


def _schema(df: DataFrame, keys: list[str]) -> str:
    kinds = dict(df.dtypes)
    return ", ".join([*(f"k{i} {kinds[x]}" for i, x in enumerate(keys)), "sketch binary"])


def sketches(df: DataFrame, keys: list[str], value: str, k: int = SECTION, fan_in: int = 512) -> DataFrame:
    """One row per group: its keys and ``sketch``."""
    v = c(value).cast("double")
    flat = df.select(*(c(x).alias(f"k{i}") for i, x in enumerate(keys)), v.alias("v")).filter("v is not null and not isnan(v)")
    parts = flat.mapInArrow(_build(k, len(keys)), _schema(df, keys))
    salted = parts.withColumn("salt", F.floor(F.spark_partition_id() / fan_in).cast("int"))
    by = [f"k{i}" for i in range(len(keys))]
    once = _merged(salted.select(*by, F.col("salt").alias(f"k{len(keys)}"), "sketch"), len(keys) + 1)
    return _named(_merged(once.drop(f"k{len(keys)}"), len(keys)), keys)


def _merged(df: DataFrame, n: int) -> DataFrame:
    by = [f"k{i}" for i in range(n)]
    kinds = dict(df.dtypes)
    put = df.repartition(*by).sortWithinPartitions(*by) if by else df.repartition(1)
    return put.mapInArrow(_merge(n), ", ".join([*(f"{x} {kinds[x]}" for x in by), "sketch binary"]))


def _named(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*(F.col(f"k{i}").alias(x) for i, x in enumerate(keys)), "sketch")


def merge_sketches(df: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of, say, days to those of keys: one row per group of keys."""
    flat = df.select(*(c(x).alias(f"k{i}") for i, x in enumerate(keys)), "sketch")
    return _named(_merged(flat, len(keys)), keys)


def percentiles(df: DataFrame, ps: list[float], k: int = SECTION) -> DataFrame:
    """Rows of ``sketches``, each with n and, per percentile, p, value and rank_bound (a share of n)."""
    made = ("n", "p", "value", "rank_bound")
    df = df.select(*(c(x).alias(x + "_" if x in made else x) for x in df.columns))
    keys = [x for x in df.columns if x != "sketch"]
    kinds = dict(df.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s = [TwoTails.unpack(x) for x in b["sketch"]]
            exact = [x.exact for x in s]
            out = b.drop(columns="sketch")
            out["n"] = [x.n for x in s]
            out["p"] = [ps] * len(b)
            out["value"] = [x.quantiles(ps) for x in s]
            out["rank_bound"] = [[0.0 if e else nearer_bound(k, p) for p in ps] for e in exact]
            yield out

    by = [*(f"`{x}` {kinds[x]}" for x in keys), "n bigint", "p array<double>", "value array<double>", "rank_bound array<double>"]
    wide = df.mapInPandas(run, ", ".join(by))
    return wide.select(*map(c, keys), "n", F.explode(F.arrays_zip("p", "value", "rank_bound")).alias("q")).select(*map(c, keys), "n", "q.*")
