import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.operators.offset_chunks import balanced_results, number_rows

SCHEMA = "k string, n_rows int, t bigint, s int, v double"


def made(seed, n):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        k = "hot" if r.random() < 0.5 else r.choice(["a", "b", None, ""])
        rows.append((k, r.choice([1, 1, 1, None]), r.choice([r.randrange(200), r.randrange(200), None]), r.randrange(3), r.choice([None, r.uniform(0, 9), 4.0])))
    return rows + [("same", 1, 5, 0, 1.0)] * (n // 3)


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[:2]].append(r)
    out = {}
    for k, g in groups.items():
        low = lambda x: (x is not None, x or 0)
        g.sort(key=lambda x: (low(x[2]), low(x[3]), low(x[4])))
        v = [x[4] for x in g]
        real = [x for x in v if x is not None]
        pairs = [(a, b) for a, b in zip(v, v[1:]) if a is not None and b is not None]
        steps = [b[2] - a[2] for a, b in zip(g, g[1:]) if a[2] is not None and b[2] is not None]
        out[k] = [len(g), sum(real) if real else None, min(real, default=None), max(real, default=None), v[0], v[-1], sum(b > a for a, b in pairs), sum(b < a for a, b in pairs), max(steps, default=None)]
    return out


@pytest.mark.parametrize(("seed", "n", "size"), [(1, 60, 1), (2, 900, 37), (3, 400, 10**6)])
def test_against_brute_force(spark, seed, n, size):
    rows = made(seed, n)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    out = balanced_results(df, ["k", "n_rows"], ["t", "s"], "v", size)
    assert out.columns[:2] == ["k", "n_rows_"]
    cols = ("n_rows", "total", "least", "greatest", "first_value", "last_value", "rises", "falls", "longest_step")
    got = {(r.k, r.n_rows_): [r[c] for c in cols] for r in out.collect()}
    want = brute(rows)
    assert got.keys() == want.keys()
    for k in want:
        assert all(a == b if a is None or b is None else a == pytest.approx(b) for a, b in zip(got[k], want[k])), (k, got[k], want[k])


def test_numbers_are_exact_and_chunks_equal(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("k"), F.hash("id").cast("bigint").alias("t"))
    rows = number_rows(df, ["k"], ["t"], 100).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.k0].append((r.o0, r.number, r.chunk))
    assert sum(map(len, by.values())) == 5000
    for g in by.values():
        g.sort(key=lambda x: x[1])
        assert [x[1] for x in g] == list(range(len(g)))
        assert [x[0] for x in g] == sorted(x[0] for x in g)
        assert [x[2] for x in g] == [i // 100 for i in range(len(g))]


def test_empty(spark):
    assert balanced_results(spark.createDataFrame([], SCHEMA), ["k"], ["t", "s"], "v").collect() == []
