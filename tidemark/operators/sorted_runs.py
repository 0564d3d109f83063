"""Exactly one copy of each message: idempotent upsert into hash-bucketed, sorted storage.

A store is a folder in the shared file system. Each upserted batch becomes one run: a file per hash bucket, sorted by the
hash of the identifier. Compaction merges the runs of a bucket by that order, with one Arrow batch of each in memory: equal
identifiers meet at the head of the merge and collapse to one. Nothing is sorted or exchanged again, so rows move once, in
the upsert. ``rewrite`` makes the merged rows the store's new generation, in more buckets if they have outgrown the old.

A manifest says which folders count. A batch upserted again replaces its own run, so retries change nothing; a batch that
a rewrite has already folded into the generation is left out when it comes again. Folders have names of their own, so a
batch may be called anything, and files of failed or repeated tasks are never read.

A copy repeated very often costs no more than any other: copies collapse inside each input partition before the
exchange (partial aggregation), so a bucket never receives more than one row of an identifier per input task and run.

Defined results:
- the kept copy is the one with the greatest ``order`` columns (nulls lowest), ties going to the greatest remaining
  columns in table order, so it doesn't depend on row order or batches;
- a row with a null in a key column can't be identified: every such row is kept, with one copy counted;
- an empty table gives an empty result; empty strings are identifiers like any other;
- extra columns are carried along; the count is ``n_copies``, followed by underscores if that name is taken.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tidemark.functions.columns import c, free_name, micros
from tidemark.session import input_bytes, scratch, width
from tidemark.streaming.triggers import triggered

#: Size of a bucket that a store is made for, and rows of one at which a rewrite splits it.
BUCKET_BYTES, BUCKET_ROWS = 256 << 20, 4_000_000
#: An Arrow batch of a run in a merge: rows and bytes at most.
BATCH_ROWS, BATCH_BYTES = 32_768, 8 << 20
#: Arrival times are dealt to batches by spans of this length.
SPAN_S = 3600


def filesystem(url: str) -> tuple[pafs.FileSystem, str]:
    """What a Python task opens a folder of the shared file system with, and its path there."""
    if url.startswith(("file:", "/")):
        return pafs.LocalFileSystem(), "/" + url.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(url.replace("s3a://", "s3://", 1))


def _stream(fs: pafs.FileSystem, path: str, schema: pa.Schema) -> Iterator[pa.Table]:
    """The rows of a sorted file in small tables."""
    with fs.open_input_file(path) as f:
        p = pq.ParquetFile(f, coerce_int96_timestamp_unit="us")
        size = sum(p.metadata.row_group(i).total_byte_size for i in range(p.metadata.num_row_groups))
        rows = max(16, min(BATCH_ROWS, int(BATCH_BYTES * max(1, p.metadata.num_rows) / max(1, size))))
        for b in p.iter_batches(rows):
            yield pa.table([b.column(x.name).cast(x.type) for x in schema], schema=schema)


def _comparable(col: pa.Array) -> list[pa.Array]:
    """Columns that sort as Spark's values do: nulls lowest, NaN greatest."""
    if pa.types.is_floating(col.type):
        nan = pc.is_nan(col)
        return [nan, pc.if_else(nan, 0.0, col)]
    if pa.types.is_nested(col.type):
        keys = [_rank(x) for x in col.to_pylist()]
        at = {k: i for i, k in enumerate(sorted(set(keys)))}
        return [pa.array([at[k] for k in keys], pa.int64())]
    return [col]


def _rank(x: object) -> tuple:
    if x is None:
        return (0,)
    if isinstance(x, dict):
        return (1, *(_rank(v) for v in x.values()))
    if isinstance(x, list | tuple):
        return (1, *map(_rank, x))
    return (2,) if x != x else (1, x)


def _same(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Whether identifiers are equal, place by place; nulls equal nulls, and NaN equals NaN."""
    if pa.types.is_nested(a.type):
        return np.array([_rank(x) == _rank(y) for x, y in zip(a.to_pylist(), b.to_pylist())], bool)
    same = pc.fill_null(pc.equal(a, b), False).to_numpy(zero_copy_only=False) | (pc.is_null(a).to_numpy(zero_copy_only=False) & pc.is_null(b).to_numpy(zero_copy_only=False))
    if pa.types.is_floating(a.type):
        same |= (pc.is_null(a, nan_is_null=True).to_numpy(zero_copy_only=False) & ~pc.is_null(a).to_numpy(zero_copy_only=False)) & (
            pc.is_null(b, nan_is_null=True).to_numpy(zero_copy_only=False) & ~pc.is_null(b).to_numpy(zero_copy_only=False)
        )
    return same


def collapse(parts: list[pa.Table], by: list[str], ranked: list[str]) -> pa.Table:
    """Sorted pieces that hold all rows of their hashes, merged: one row per identifier, the greatest, with n added up."""
    t = pa.concat_tables(parts).combine_chunks()
    h = t.column("h").to_numpy()
    o = np.argsort(h, kind="stable") if len(parts) > 1 else np.arange(len(h))  # merges the pieces, which are sorted
    new = np.r_[True, h[o][1:] != h[o][:-1]]
    if new.all():
        return t.take(pa.array(o)) if len(parts) > 1 else t
    again = np.flatnonzero(~new)
    same = np.ones(len(again), bool)
    for x in by:
        col = t.column(x).combine_chunks()
        same &= _same(col.take(pa.array(o[again - 1])), col.take(pa.array(o[again])))
    if not same.all():  # different identifiers of one hash
        group = np.cumsum(new) - 1
        for g in np.unique(group[again[~same]]):
            at = np.flatnonzero(group == g)
            names = [repr([_rank(t.column(x)[int(r)].as_py()) for x in by]) for r in o[at]]
            p = np.argsort(np.array(names, object), kind="stable")
            o[at] = o[at][p]
            names = [names[i] for i in p]
            new[at] = [True] + [a != b for a, b in zip(names, names[1:])]
    starts = np.flatnonzero(new)
    sizes = np.diff(np.r_[starts, len(o)])
    best = o[starts]
    many = np.flatnonzero(sizes > 1)
    if len(many):
        rows = o[np.isin(np.cumsum(new) - 1, many)]
        group = np.repeat(np.arange(len(many)), sizes[many])
        sub = t.select(ranked).take(pa.array(rows))
        cols = [pa.array(group), *(y for x in ranked for y in _comparable(sub.column(x).combine_chunks()))]
        names = [f"s{i}" for i in range(len(cols))]
        p = pc.sort_indices(pa.table(cols, names=names), [(x, "ascending") for x in names], null_placement="at_start").to_numpy()
        best[many] = rows[p[np.flatnonzero(np.r_[np.diff(group[p]) != 0, True])]]
    n = np.add.reduceat(t.column("n").to_numpy()[o], starts)
    out = t.take(pa.array(best))
    return out.set_column(out.schema.get_field_index("n"), "n", pa.array(n, pa.int64()))


def merge_sorted(streams: list[Iterator[pa.Table]], by: list[str], ranked: list[str]) -> Iterator[pa.Table]:
    """Streams of tables, each sorted by h, merged into one that is sorted by h, with one row per identifier."""
    held: list[pa.Table | None] = [None] * len(streams)
    live = set(range(len(streams)))

    def more(i: int) -> None:
        x = next(streams[i], None)
        if x is None:
            live.discard(i)
        elif x.num_rows:
            held[i] = x if held[i] is None else pa.concat_tables([held[i], x]).combine_chunks()

    while True:
        for i in list(live):
            while i in live and held[i] is None:
                more(i)
        # up to the least of the last hashes all rows are there
        ends = {i: held[i].column("h")[-1].as_py() for i in live}
        end = min(ends.values(), default=None)
        parts = []
        for i, t in enumerate(held):
            if t is None:
                continue
            cut = t.num_rows if end is None else int(np.searchsorted(t.column("h").to_numpy(), end, "left"))
            if cut:
                parts.append(t.slice(0, cut))
                held[i] = t.slice(cut) if cut < t.num_rows else None
        if parts:
            yield collapse(parts, by, ranked)
        elif live:
            for i in [i for i in live if ends[i] == end]:
                more(i)
        else:
            return


class SortedRunStore:
    """Keyed storage of rows like ``like``; ``keys`` identify a message, ``order`` decides which copy stays."""

    def __init__(self, like: DataFrame, keys: list[str], order: list[str], n_buckets: int | None = None, path: str | None = None):
        self.spark: SparkSession = like.sparkSession
        self.keys, self.order, self.schema = keys, order, like.schema
        w = width(self.spark)
        # a multiple of a shuffle's partitions, so that a bucket is written by one task
        self.n_buckets = n_buckets or w * (1 << max(0, math.ceil(math.log2(max(1, input_bytes(like)) / (w * BUCKET_BYTES)))))
        self.path = path or scratch(self.spark, "runs")
        self.runs: dict[str, str] = {}  # folders of batches by their names
        self.base: str | None = None  # the generation's folder
        self.folded: set[str] = set()  # batches that the generation holds
        self.version = 0
        self._names(like)

    def _names(self, like: DataFrame) -> None:
        """Inside the store, columns go by position, so that no name of the input can clash."""
        self.columns = like.columns
        self.rest = [x for x in self.columns if x not in self.keys and x not in self.order]
        self.count_name = free_name(like, "n_copies")
        # apart is empty for identified rows and different for each of the others, which therefore spread over all buckets
        self.by = [*(f"k{i}" for i in range(len(self.keys))), "apart"]
        kinds = {f.name: f.dataType for f in self.schema}
        fields = [StructField("h", LongType()), StructField("p", IntegerType())]
        fields += [StructField(f"k{i}", kinds[x]) for i, x in enumerate(self.keys)] + [StructField("apart", StringType())]
        fields += [StructField(f"c{i}", kinds[x]) for i, x in enumerate([*self.order, *self.rest])] + [StructField("n", LongType())]
        self.inner = StructType(fields)
        self.ranked = [f.name for f in fields if f.name[0] == "c"]

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> SortedRunStore:
        """The store in that folder as of its last manifest."""
        fs, p = filesystem(path)
        last = max((x.path for x in fs.get_file_info(pafs.FileSelector(f"{p}/_manifests", allow_not_found=True)) if x.base_name.endswith(".json")), default=None)
        if last is None:
            raise FileNotFoundError(f"no store in {path}")
        with fs.open_input_stream(last) as f:
            m = json.loads(f.read())
        out = cls(spark.createDataFrame([], StructType.fromJson(m["schema"])), m["keys"], m["order"], m["n_buckets"], path)
        out.runs, out.base, out.folded, out.version = m["runs"], m["base"], set(m["folded"]), m["version"]
        return out

    def _commit(self) -> None:
        """What the store holds from now on: one new file, put in place by a rename."""
        self.version += 1
        fs, p = filesystem(self.path)
        fs.create_dir(f"{p}/_manifests", recursive=True)
        state = {"schema": self.schema.jsonValue(), "keys": self.keys, "order": self.order, "n_buckets": self.n_buckets, "runs": self.runs, "base": self.base, "folded": sorted(self.folded), "version": self.version}
        at = f"{p}/_manifests/{self.version:012d}"
        with fs.open_output_stream(f"{at}.part") as f:
            f.write(json.dumps(state).encode())
        fs.move(f"{at}.part", f"{at}.json")

    def _delete(self, folders: list[str]) -> None:
        for x in folders:
            fs, p = filesystem(x)
            if fs.get_file_info(p).type != pafs.FileType.NotFound:
                fs.delete_dir(p)

    def upsert(self, df: DataFrame, batch_id: str) -> None:
        """Write df as the run of batch_id, in place of any earlier run of that name."""
        self.upsert_batches(df, [batch_id], F.lit(0))

    def upsert_batches(self, df: DataFrame, names: list[str], which: Column) -> None:
        """Write df as the runs of several batches in one pass; which: the place in names of a row's batch."""
        if all(x in self.folded for x in names):
            return
        new = [i for i, x in enumerate(names) if x not in self.folded]
        ids = [c(x).alias(f"k{i}") for i, x in enumerate(self.keys)]
        payload = [c(x).alias(f"c{i}") for i, x in enumerate([*self.order, *self.rest])]
        known = reduce(lambda a, b: a & b, [c(x).isNotNull() for x in self.keys])
        batch = which.cast("int")
        rows = df.withColumn(run := free_name(df, "__run"), batch).filter(c(run).isin(new))
        name = F.element_at(F.array(*map(F.lit, names)), c(run) + 1)
        apart = F.when(known, "").otherwise(F.concat_ws("-", name, F.monotonically_increasing_id().cast("string")))
        kept = F.struct(*payload) if payload else F.struct(F.lit(0).alias("none"))
        rows = rows.select(*ids, apart.alias("apart"), kept.alias("kept"), c(run).alias("run"))
        # one exchange for all batches: as many values per identifier as batches
        aggs = [f(F.when(F.col("run") == i, x)).alias(f"{y}{i}") for i in new for f, x, y in ((F.max, F.col("kept"), "m"), (F.count, F.lit(1), "n"))]
        own = F.array(*(F.struct(F.lit(i).alias("run"), F.col(f"m{i}").alias("kept"), F.col(f"n{i}").alias("n")) for i in new))
        long = rows.groupBy(*self.by).agg(*aggs).select(*self.by, F.explode(own).alias("r")).filter("r.n > 0")
        # p is what the exchange went by
        flat = long.select(
            F.xxhash64(*self.by).alias("h"), F.hash(*self.by).alias("p"), *self.by, *(F.col(f"r.kept.{x}").alias(x) for x in self.ranked), F.col("r.n").alias("n"), "r.run",
        ).withColumn("bucket", F.pmod("p", F.lit(self.n_buckets)))
        at = f"{self.path}/{uuid.uuid4().hex}"
        flat.sortWithinPartitions("run", "bucket", "h").write.partitionBy("run", "bucket").parquet(at)
        old = [self.runs[names[i]] for i in new if names[i] in self.runs]
        self.runs |= {names[i]: f"{at}/run={i}" for i in new}
        self._commit()
        self._delete(old)

    def _merger(self):
        """For a bucket: its merged rows."""
        folders, by, ranked, schema = [*([self.base] if self.base else []), *self.runs.values()], self.by, self.ranked, to_arrow_schema(self.inner)

        def merged(bucket: int) -> Iterator[pa.Table]:
            streams = []
            for x in folders:
                fs, p = filesystem(x)
                found = fs.get_file_info(pafs.FileSelector(f"{p}/bucket={bucket}", allow_not_found=True))
                streams += [_stream(fs, f.path, schema) for f in found if f.base_name.endswith(".parquet") and f.base_name[0] not in "._"]
            return merge_sorted(streams, by, ranked)

        return merged

    def compact(self) -> DataFrame:
        """All runs merged: one row per identifier, with the number of copies delivered."""
        merged = self._merger()
        out = [f for f in self.inner if f.name not in ("h", "p", "apart")]
        names = [f.name for f in out]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for bucket in b.column(0).to_pylist():
                    for t in merged(bucket):
                        yield from t.select(names).combine_chunks().to_batches()

        rows = self.spark.range(0, self.n_buckets, 1, self.n_buckets).mapInArrow(run, StructType(out))
        at = {x: f"c{i}" for i, x in enumerate([*self.order, *self.rest])} | {x: f"k{i}" for i, x in enumerate(self.keys)}
        return rows.select(*(F.col(at[x]).alias(x) for x in self.columns), F.col("n").alias(self.count_name))

    def rewrite(self, bucket_rows: int = BUCKET_ROWS) -> None:
        """Compact in place: the merged rows become the store's generation, in twice as many buckets, or more, if they are too large."""
        merged, n, path = self._merger(), self.n_buckets, f"{self.path}/{uuid.uuid4().hex}"

        def run(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
            fs, p = filesystem(path)
            for b in batches:
                for bucket in b.column(0).to_pylist():
                    rows, writers = 0, {}
                    for t in merged(bucket):
                        rows += t.num_rows
                        into = np.mod(t.column("p").to_numpy().astype(np.int64), n * parts)
                        for x in np.unique(into).tolist():
                            if x not in writers:
                                fs.create_dir(f"{p}/bucket={x}", recursive=True)
                                part = f"{p}/bucket={x}/_{uuid.uuid4().hex}"
                                writers[x] = (part, pq.ParquetWriter(part, t.schema, filesystem=fs, compression="snappy"))
                            writers[x][1].write_table(t.filter(pa.array(into == x)))
                    for x, (part, writer) in writers.items():
                        writer.close()
                        fs.move(part, f"{p}/bucket={x}/merged.parquet")  # the same rows whichever attempt comes last
                    yield pa.RecordBatch.from_arrays([pa.array([rows], pa.int64())], names=["rows"])

        total = sum(r["n"] for r in self._sizes())
        parts = 1 << max(0, math.ceil(math.log2(max(1, total) / (n * bucket_rows))))
        self.spark.range(0, n, 1, n).mapInArrow(lambda bs: run(bs, parts), "rows bigint").agg(F.sum("rows")).first()
        old = [*([self.base] if self.base else []), *self.runs.values()]
        self.folded |= set(self.runs)
        self.base, self.runs, self.n_buckets = path, {}, n * parts
        self._commit()
        self._delete(old)

    def _sizes(self) -> list:
        """Rows of the store's files, from their footers: at least as many as identifiers."""
        folders = [*([self.base] if self.base else []), *self.runs.values()]
        found = [x for x in folders if filesystem(x)[0].get_file_info(filesystem(x)[1]).type != pafs.FileType.NotFound]
        return [self.spark.read.option("recursiveFileLookup", "true").schema(self.inner).parquet(*found).agg(F.count(F.lit(1)).alias("n")).first()] if found else []

    def drop(self) -> None:
        """Delete the store."""
        self._delete([self.path])


def upsert_stream(df: DataFrame, store: SortedRunStore, checkpoint: str, mode: str = "availableNow") -> StreamingQuery:
    """A stream of deliveries into a store: a run per micro-batch, replaced if the micro-batch is repeated after a failure."""
    writer = df.writeStream.foreachBatch(lambda b, i: store.upsert(b, f"s{i}")).option("checkpointLocation", checkpoint)
    return triggered(writer, mode).start()


def batch_of(arrival: Column, n: int) -> Column:
    """The batch, of n, in which a row with that arrival time is delivered: spans of an hour, dealt in turn. No time: the first."""
    return F.coalesce(F.pmod(F.floor(micros(arrival) / (SPAN_S * 1_000_000)), F.lit(n)), F.lit(0)).cast("int")


def delivered(df: DataFrame, keys: list[str], order: list[str], arrival: str | None = None, n_batches: int = 4) -> SortedRunStore:
    """A store of df. With arrival, df is replayed as n_batches deliveries, in one pass."""
    store = SortedRunStore(df, keys, order)
    store.upsert_batches(df, [f"b{i}" for i in range(n_batches if arrival else 1)], batch_of(c(arrival), n_batches) if arrival else F.lit(0))
    return store


def exactly_once(df: DataFrame, keys: list[str], order: list[str], arrival: str | None = None, n_batches: int = 4) -> DataFrame:
    """One copy of each message of df, with n_copies."""
    return delivered(df, keys, order, arrival, n_batches).compact()
