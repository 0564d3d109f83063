import pytest

from tidemark import session


def test_partitions_follow_the_input(spark, tmp_path, monkeypatch):
    spark.range(50_000).selectExpr("id", "cast(id as string) s").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    size = session.input_bytes(df)
    assert size == sum(x.stat().st_size for x in (tmp_path / "t").glob("*.parquet"))
    assert session.input_bytes(df.join(df.select("id"), "id")) == 2 * size  # a sum, not a product
    assert session.input_bytes(spark.createDataFrame([(1,)], "a int")) == 0
    assert session.partitions(df) == session.width(spark)
    monkeypatch.setattr(session, "PARTITION_BYTES", size // 10)
    assert session.partitions(df) in (10, 11) and session.spread(df).rdd.getNumPartitions() >= 10


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="checkpoint"):
        session.shared_dir(Session())
