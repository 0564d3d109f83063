from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.operators.sorted_runs import SortedRunStore, batch_of, collapse, delivered, exactly_once, merge_sorted, upsert_stream

SCHEMA = "k string, j int, o int, v string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def brute(rows):
    """Keys 0 and 1, order 2."""
    best, n, loose = {}, Counter(), []
    low = lambda x: (x is not None, x)
    for r in rows:
        if r[0] is None or r[1] is None:
            loose.append((*r, 1))
            continue
        k = r[:2]
        n[k] += 1
        if k not in best or tuple(map(low, r[2:])) > tuple(map(low, best[k][2:])):
            best[k] = r
    return sorted([(*r, n[k]) for k, r in best.items()] + loose, key=repr)


cells = st.tuples(st.sampled_from(["a", "b", "", None]), st.sampled_from([1, 2, None]), st.sampled_from([1, 2, None]), st.sampled_from(["x", "yy", None]))


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(cells, max_size=12), min_size=1, max_size=3))
def test_any_batches_give_one_copy_of_each(spark, parts):
    like = spark.createDataFrame([], SCHEMA)
    store = SortedRunStore(like, ["k", "j"], ["o"])
    for i, p in enumerate(parts):
        store.upsert(spark.createDataFrame(p, SCHEMA), f"b{i}")
    assert rows_of(store.compact()) == brute([r for p in parts for r in p])


def test_a_batch_upserted_again_changes_nothing(spark):
    a = spark.createDataFrame([("a", 1, 1, "x"), ("a", 1, 1, "x"), ("b", 1, 1, "x")], SCHEMA)
    b = spark.createDataFrame([("a", 1, 2, "z")], SCHEMA)
    store = SortedRunStore(a, ["k", "j"], ["o"])
    for name, df in (("1", a), ("2", b), ("1", a), ("2", b)):
        store.upsert(df, name)
    want = [("a", 1, 2, "z", 3), ("b", 1, 1, "x", 1)]
    assert rows_of(store.compact()) == want
    store.rewrite()
    assert rows_of(store.compact()) == want
    store.upsert(spark.createDataFrame([("b", 1, 9, "new")], SCHEMA), "3")
    assert rows_of(store.compact()) == [("a", 1, 2, "z", 3), ("b", 1, 9, "new", 2)]


def test_compaction_neither_moves_nor_sorts(spark):
    df = spark.range(1000).selectExpr("cast(id % 300 as string) k", "cast(id % 2 as int) j", "cast(id as int) o", "'v' v")
    store = SortedRunStore(df, ["k", "j"], ["o"])
    store.upsert(df, "b")
    store.upsert(df, "c")
    out = store.compact().filter("n_copies > 1")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Exchange" not in plan and "Sort" not in plan
    assert out.count() == 300 and {r.n_copies for r in out.collect()} == {6, 8}


def test_all_batches_in_one_scan_and_one_exchange(spark, tmp_path):
    spark.range(1000).selectExpr("cast(id % 300 as string) k", "cast(id as int) o", "timestamp_micros(id * 60000000) at").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    store = delivered(df, ["k"], ["o"], "at")
    assert sorted(store.runs) == ["b0", "b1", "b2", "b3"]
    want = {str(k): (max(range(k, 1000, 300)), len(range(k, 1000, 300))) for k in range(300)}
    assert {r.k: (r.o, r.n_copies) for r in store.compact().collect()} == want


def test_after_a_rewrite_retries_change_nothing_and_names_are_free(spark):
    a = spark.createDataFrame([("a", 1, 1, "x"), ("b", 1, 1, "x"), (None, 1, 1, "loose")], SCHEMA)
    store = SortedRunStore(a, ["k", "j"], ["o"])
    store.upsert(a, "1")
    store.rewrite()
    store.upsert(a, "1")  # again, as after a failure
    want = [("a", 1, 1, "x", 1), ("b", 1, 1, "x", 1), (None, 1, 1, "loose", 1)]
    assert rows_of(store.compact()) == sorted(want, key=repr)
    for name in ("g", "run=0", "../x", "it's", ""):
        store.upsert(spark.createDataFrame([("z", 1, 1, name)], SCHEMA), name)
    assert [r[4] for r in rows_of(store.compact().filter("k = 'z'"))] == [5]
    store.rewrite()
    assert {r[0]: r[4] for r in rows_of(store.compact())} == {"a": 1, "b": 1, "z": 5, None: 1}


def test_a_store_is_opened_again_and_dropped(spark, tmp_path):
    a = spark.createDataFrame([("a", 1, 1, "x")], SCHEMA)
    store = SortedRunStore(a, ["k", "j"], ["o"], path=f"file://{tmp_path}/s")
    store.upsert(a, "1")
    store.rewrite()
    again = SortedRunStore.open(spark, f"file://{tmp_path}/s")
    again.upsert(a, "1")
    again.upsert(a, "2")
    assert rows_of(again.compact()) == [("a", 1, 1, "x", 2)]
    again.drop()
    assert not (tmp_path / "s").exists() and not [t for t in spark.catalog.listTables() if "tidemark" in t.name]


def test_a_rewrite_splits_buckets_that_are_too_large(spark):
    df = spark.range(3000).selectExpr("cast(id as string) k", "cast(id % 2 as int) j", "cast(id as int) o", "'v' v")
    store = SortedRunStore(df, ["k", "j"], ["o"], n_buckets=2)
    store.upsert(df, "1")
    store.rewrite(bucket_rows=200)
    assert store.n_buckets == 16
    store.upsert(df, "2")
    assert store.compact().filter("n_copies = 2").count() == 3000


def test_hashes_that_collide(spark):
    part = lambda rows: pa.table({"h": pa.array([r[0] for r in rows], pa.int64()), "k0": [r[1] for r in rows], "c0": pa.array([r[2] for r in rows], pa.float64()), "n": pa.array([1] * len(rows), pa.int64())})
    a, b = [(1, "x", 1.0), (1, "y", 2.0), (2, "z", None)], [(1, "x", float("nan")), (1, "w", 0.0), (2, "z", 3.0)]
    out = collapse([part(a), part(b)], ["k0"], ["c0"])
    got = {(r["k0"], str(r["c0"]), r["n"]) for r in out.to_pylist()}
    assert got == {("x", "nan", 2), ("y", "2.0", 1), ("w", "0.0", 1), ("z", "3.0", 2)}
    # the rows of a hash may be spread over many small tables
    small = [iter([part([r]) for r in rows]) for rows in (a, b, [])]
    assert sorted((r["k0"], r["n"]) for t in merge_sorted(small, ["k0"], ["c0"]) for r in t.to_pylist()) == [("w", 1), ("x", 2), ("y", 1), ("z", 2)]


def test_kinds_of_columns(spark):
    kinds = ["binary", "timestamp", "timestamp_ntz", "date", "decimal(20,3)", "double", "array<int>", "struct<a:int,b:string>", "boolean", "tinyint"]
    lits = ["X'00ff'", "timestamp'2020-01-01 01:02:03.000004'", "timestamp_ntz'2020-01-01 01:02:03.000004'", "date'2020-01-01'", "12.345", "double('nan')", "array(1, null)", "named_struct('a', 1, 'b', 'x')", "true", "1"]
    df = spark.range(2).selectExpr("'k' k", *(f"if(id = 0, cast({x} as {k}), null) c{i}" for i, (x, k) in enumerate(zip(lits, kinds))))
    out = exactly_once(df, ["k"], [f"c{i}" for i in range(len(kinds))])
    assert [x for x, _ in out.dtypes] == [*df.columns, "n_copies"] and out.drop("n_copies").exceptAll(df.filter("c0 is not null")).count() == 0
    assert exactly_once(df, [f"c{i}" for i in (1, 4, 5)], ["k"]).count() == 2


def test_a_stream_of_deliveries(spark, tmp_path):
    parts = [[("a", 1, 1, "x"), (None, 1, 1, "loose")], [("a", 1, 2, "y"), ("b", 1, 1, "x"), (None, 1, 1, "loose")], [("a", 1, 1, "x")]]
    for i, p in enumerate(parts):
        spark.createDataFrame(p, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    src = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    store = SortedRunStore(spark.createDataFrame([], SCHEMA), ["k", "j"], ["o"])
    upsert_stream(src, store, f"{tmp_path}/c").awaitTermination()
    assert rows_of(store.compact()) == brute([r for p in parts for r in p])


def test_names_may_clash(spark):
    df = spark.createDataFrame([("a", 1, 5, 6), ("a", 2, 7, 8)], "`a.b` string, n_copies int, run int, kept int")
    out = exactly_once(df, ["a.b"], ["n_copies"])
    assert out.columns == ["a.b", "n_copies", "run", "kept", "n_copies_"]
    assert rows_of(out) == [("a", 2, 7, 8, 2)]


def test_only_keys_and_empty_tables(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows_of(exactly_once(df, ["k"], [])) == [("a", 2), (None, 1)]
    assert exactly_once(df.limit(0), ["k"], []).count() == 0


def test_batches_cover_each_row_once(spark):
    df = spark.sql("select id, if(id % 7 = 0, null, timestamp_ntz '2020-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(id as int) * 10, 0)) t from range(100)")
    got = defaultdict(set)
    for r in df.select("id", batch_of(F.col("t"), 4).alias("b")).collect():
        got[r.b].add(r.id)
    assert sorted(got) == [0, 1, 2, 3] and sum(map(len, got.values())) == 100 and got[0] >= {0, 7, 14}


def test_very_long_identifiers(spark):
    long = "x" * 300_000
    df = spark.createDataFrame([(long, 1, 1, long), (long, 1, 2, "y")], SCHEMA)
    assert [(r.v, r.n_copies) for r in exactly_once(df, ["k", "j"], ["o"]).collect()] == [("y", 2)]
