"""Keyed tables by partition, with a log of their changes, on plain parquet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import c
from tidemark.operators.latest import keep_latest


def merged(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target with source's rows in place of those of equal keys. Null keys equal nothing."""
    return target.join(source.select(*map(c, keys)), keys, "left_anti").unionByName(source)


def merge_condition(keys: list[str], part: str | None = None, target: str = "t", source: str = "s") -> str:
    """What a MERGE of source into target matches rows on, for engines that have one: the partition column first, so that it prunes."""
    quoted = lambda x: "`" + x.replace("`", "``") + "`"
    names = [*([part] if part else []), *(k for k in keys if k != part)]
    return " AND ".join(f"{target}.{quoted(x)} = {source}.{quoted(x)}" for x in names)


class KeyedTable:
    """A parquet table under ``path``, partitioned by one column, and its change log under ``path``_changes.

    upsert reads and rewrites only the partitions that a batch touches. The new partitions are first written beside the table,
    then swapped in. A run that stops before they are complete has changed nothing; one that stops later, even amid the swap,
    is made good by the next upsert, which swaps them in again before it does anything else. So a batch may be repeated at
    will. Rows with a null key are refused: they go to ``path``_refused. With ordered=True a row replaces
    another only if its order column isn't less, so batches may come in any order; otherwise the last batch wins. The change
    log has one folder per batch, with the rows that the batch put into the table, not those that lost to older ones.
    A date of any size is written by as many tasks as its size asks for.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], part: str, order: str = "kafka_offset", ordered: bool = False):
        self.spark, self.path, self.keys, self.part, self.order, self.ordered = spark, path, keys, part, order, ordered

    def _at(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def exists(self) -> bool:
        fs, p = self._at(self.path)
        return fs.exists(p)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def _swap(self, staging: str) -> None:
        fresh = self.spark.read.parquet(staging)
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.part).parquet(self.path)

    def recover(self) -> str | None:
        """Swaps in what a stopped run has left complete beside the table, and says of which batch it was."""
        fs, p = self._at(f"{self.path}_staging")
        batch = None
        for x in fs.listStatus(p) if fs.exists(p) else []:
            at = x.getPath().toString()
            done = fs.exists(self._at(f"{at}/_SUCCESS")[1])
            if done:
                self._swap(at)
                batch = at.rpartition("=")[2]
            fs.delete(x.getPath(), True)
        return batch

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        if self.recover() == str(batch_id):
            return
        known = reduce(lambda a, b: a & b, [c(k).isNotNull() for k in self.keys])
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            refused = batch.filter(~known)
            if not refused.isEmpty():
                refused.write.mode("overwrite").parquet(f"{self.path}_refused/batch_id={batch_id}")
            source = keep_latest(batch.filter(known), self.keys, self.order)
            rest = [x for x in source.columns if x not in self.keys and x != self.order]
            both = source.withColumn("__new", F.lit(1))
            if self.exists():
                # prunes the partitions that the batch doesn't touch
                old = self.read().join(source.select(self.part).distinct(), self.part, "left_semi").select(*map(c, source.columns))
                both = both.unionByName(old.withColumn("__new", F.lit(0)))
            first = [c(self.order), F.col("__new")] if self.ordered else [F.col("__new"), c(self.order)]
            best = both.groupBy(*map(c, self.keys)).agg(F.max(F.struct(*first, *map(c, rest))).alias("m"), F.min("__new").alias("all_new"))
            after = best.select(*map(c, self.keys), *(F.col("m").getField(x).alias(x) for x in [self.order, *rest]), F.col("m.__new").alias("__new"), "all_new")
            after = after.persist()
            try:
                kind = F.when(F.col("all_new") == 1, "insert").otherwise("update_postimage")
                log = after.filter("__new = 1").select(*map(c, source.columns), kind.alias("_change_type"), F.lit(batch_id).cast("bigint").alias("_commit_version"))
                log.write.mode("overwrite").parquet(f"{self.path}_changes/batch_id={batch_id}")
                # parts of a useful size, whatever a date holds
                staging = f"{self.path}_staging/batch_id={batch_id}"
                whole = after.select(*map(c, source.columns)).hint("rebalance", c(self.part))
                whole.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(self.part).parquet(staging)
            finally:
                after.unpersist()
            self._swap(staging)
            fs, p = self._at(staging)
            fs.delete(p, True)
        finally:
            batch.unpersist()
