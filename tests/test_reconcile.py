import random

import numpy as np
import pytest

from tidemark.operators.reconcile import CHECKS, P, differing, field_differences, latest, mulmod, points, products, rational, side_name, sieved


def test_field_products_are_exact():
    r = random.Random(0)
    a = [0, 1, P - 1, P - 1, 1 << 60] + [r.randrange(P) for _ in range(500)]
    b = [5, P - 1, P - 1, 1, (1 << 60) - 1] + [r.randrange(P) for _ in range(500)]
    got = mulmod(np.array(a, np.uint64), np.array(b, np.uint64)).tolist()
    assert got == [x * y % P for x, y in zip(a, b)]
    e = np.array([r.randrange(1 << 60) for _ in range(40)], np.uint64)
    g = np.sort(np.array([r.randrange(4) for _ in range(40)]))
    at = points(5)
    groups, v = products(e, g, at)
    for i, k in enumerate(groups.tolist()):
        for j, z in enumerate(at.tolist()):
            want = 1
            for x in e[g == k].tolist():
                want = want * (z - x) % P
            assert int(v[i, j]) == want


@pytest.mark.parametrize(("a", "b"), [(0, 0), (1, 0), (0, 3), (4, 4), (5, 2), (1, 7)])
def test_rational_function_comes_back(a, b):
    r = random.Random(a * 10 + b)
    both, own_a, own_b = ([r.randrange(1 << 60) for _ in range(n)] for n in (20, a, b))
    bound = 8
    at = points(bound + 1 + CHECKS).tolist()

    def ratio(z):
        p = q = 1
        for x in both + own_a:
            p = p * (z - x) % P
        for x in both + own_b:
            q = q * (z - x) % P
        return p * pow(q, -1, P) % P

    p, q = rational([ratio(z) for z in at], at, a - b)
    value = lambda c, z: sum(x * pow(z, i, P) for i, x in enumerate(c)) % P
    assert len(p) - 1 == a and len(q) - 1 == b
    assert all(value(p, x) == 0 for x in own_a) and all(value(q, x) == 0 for x in own_b)


def test_too_low_a_bound_is_noticed():
    r = random.Random(9)
    a = [r.randrange(1 << 60) for _ in range(12)]
    at = points(4 + 1 + CHECKS).tolist()
    ratio = []
    for z in at:
        v = 1
        for x in a:
            v = v * (z - x) % P
        ratio.append(v)
    assert rational(ratio, at, 12) is None


SCHEMA = "k string, d int, x double, s string, side int"
KEYS, FIELDS = ["k", "d"], ["x", "s", "side"]


def brute(a, b, tol=1e-4):
    a, b = ({r[:2]: r[2:] for r in t} for t in (a, b))
    out = set()
    for k in a.keys() | b.keys():
        if k not in a or k not in b:
            out.add((*k, "missing_in_a" if k not in a else "missing_in_b"))
            continue
        for f, p, q in zip(FIELDS, a[k], b[k]):
            if p is None or q is None or f == "s":
                far = p != q
            else:
                far = not (p != p and q != q) and not abs(p - q) <= tol
            if far:
                out.add((*k, f))
    return out


def found(spark, a, b, **kw):
    a, b = spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)
    rows = differing(a, b, KEYS, FIELDS, **kw)
    assert side_name(KEYS, FIELDS) == "side_"
    return {tuple(r) for r in field_differences(rows, KEYS, FIELDS).collect()}


def test_the_sieve_lets_all_that_differ_through(spark):
    rows = spark.range(200_000).selectExpr("shiftrightunsigned(xxhash64(id), 4) e", "id")
    own = rows.filter("id < 3000")
    out = sieved(rows, own.select("e"), 3000, "e")
    assert out.columns == ["e", "id"] and out.filter("id < 3000").count() == 3000 and out.count() < 40_000
    assert sieved(rows, own.select("e").limit(0), 0, "e").count() == 0


@pytest.mark.parametrize(("n", "share", "sieve"), [(300, 0.02, 10**9), (400, 0.7, 10**9), (400, 0.7, 0)])
def test_against_brute_force(spark, n, share, sieve):
    r = random.Random(n)
    a = [(r.choice(["A", None, "", "B"]), i, r.choice([None, float("nan"), r.uniform(0, 9)]), r.choice(["x", "", None]), r.choice([1, None])) for i in range(n)]
    b = []
    for k in a:
        x = k[2]
        if r.random() < share:
            if r.random() < 0.3:
                continue
            x = r.choice([None, 1.0, float("nan")])
        elif x is not None:
            x += r.choice([0, 1e-12])
        b.append((k[0], k[1], x, *k[3:]))
    b += [("new", i, 1.0, "x", 1) for i in range(int(n * share))]
    r.shuffle(b)
    assert found(spark, a, b, sieve_from=sieve) == brute(a, b)


def test_tolerance_and_empty_copies(spark):
    a = [("A", 1, 1.0, "x", 1), ("A", 2, 1.0, "x", 1), ("A", 3, float("inf"), "x", 1)]
    b = [("A", 1, 1.00009, "x", 1), ("A", 2, 1.0002, "x", 1), ("A", 3, float("inf"), "x", 1)]
    assert found(spark, a, b) == {("A", 2, "x")}
    assert found(spark, a, []) == {("A", i, "missing_in_b") for i in (1, 2, 3)}
    assert found(spark, [], []) == set()


def test_latest_row(spark):
    df = spark.createDataFrame([("A", 1, 5.0), ("A", 2, 1.0), ("A", 2, 1.0), ("A", 2, None), (None, None, 3.0)], "k string, v int, x double")
    assert sorted(map(tuple, latest(df, ["k"], ["v"]).collect()), key=repr) == [("A", 2, 1.0), (None, None, 3.0)]


@pytest.mark.parametrize("kind", ["bigint", "decimal(38,0)", "decimal(38,4)"])
def test_whole_numbers_and_decimals_are_exact(spark, kind):
    big = [2**53, 2**53 + 1, 10**17, 10**17 + 1, 10**18, 10**18 + 100]
    make = lambda add: spark.createDataFrame([(i, x + add * (i % 2)) for i, x in enumerate(big)], "k int, x bigint").selectExpr("k", f"cast(x as {kind}) x")
    rows = differing(make(0), make(1), ["k"], ["x"])
    assert {tuple(r) for r in field_differences(rows, ["k"], ["x"]).collect()} == {(i, "x") for i in (1, 3, 5)}


def test_copies_of_other_types(spark):
    a = spark.sql("select 1 k, 5 x, 1.50 y, 2.0D z union all select 2, 6, 2.00, 3.0D")
    b = spark.sql("select 1L k, 5L x, 1.5000 y, 2 z union all select 2L, 7L, 2.0001, 4")
    rows = differing(a, b, ["k"], ["x", "y", "z"])
    assert {(r.k, r.finding) for r in field_differences(rows, ["k"], ["x", "y", "z"]).collect()} == {(2, "x"), (2, "y"), (2, "z")}


def test_large_doubles_further_apart_than_the_tolerance(spark):
    r = random.Random(4)
    xs = [10 ** r.uniform(6, 17) for _ in range(400)]
    a = [(f"{i}", i, x, "x", 1) for i, x in enumerate(xs)]
    b = [(f"{i}", i, float(np.nextafter(x, np.inf)), "x", 1) for i, x in enumerate(xs)]
    assert found(spark, a, b) == brute(a, b)
