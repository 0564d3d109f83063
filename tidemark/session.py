"""Session set-up and the shared folder for tables that cut lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders written by this process, deleted when it ends.
_written: list[str] = []


def get_spark(cores: int | str = "*", shuffle_partitions: int = 8, master: str | None = None, **conf: str) -> SparkSession:
    """A session, local unless said otherwise, with the settings the library is tuned for; conf with dots or double underscores."""
    b = (
        SparkSession.builder.master(master or f"local[{cores}]")
        .appName("tidemark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one of our own where that is unset, as in tests."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", at)
        _written.append(at)
    return at.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    if not _written:
        atexit.register(_clean, spark)
    path = f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def _clean(spark: SparkSession) -> None:
    try:
        jvm = spark.sparkContext._jvm
        for path in _written:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the JVM may be gone by then
        pass


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it again: its lineage ends there, and losing an executor loses nothing."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def width(spark: SparkSession) -> int:
    """Partitions of a shuffle in this session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def input_bytes(df: DataFrame) -> int:
    """The size of the files that df is made of, as the planner knows it; nothing is read. Rows made in the driver don't count."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(x for x in sizes if x < 1 << 57)


#: Input of a partition where the number of partitions has to be given, as in a sort over range partitions.
PARTITION_BYTES = 64 << 20


def partitions(df: DataFrame) -> int:
    """How many partitions df's rows should be put into: those of a shuffle in this session, or more if the input asks for them."""
    return max(width(df.sparkSession), -(-input_bytes(df) // PARTITION_BYTES))


def spread(df: DataFrame) -> DataFrame:
    """df for work that costs far more than moving its rows: in as many partitions as a shuffle has, if it has fewer."""
    n = partitions(df)
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df
