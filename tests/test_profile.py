import math
import random
from collections import Counter, defaultdict

import pytest

from tidemark.operators.profile import DECILES, changes, findings, profile, value_counts

BASE = "column_name string, null_rate double, min_value double, max_value double, pattern string, " + ", ".join(f"{q} double" for q in DECILES)
SCHEMA = "load int, value double, n string, partner string"


def base(spark):
    return spark.createDataFrame(
        [("value", 0.1, 0.0, 100.0, None, *map(float, range(10, 100, 10))), ("n", 0.1, None, None, "^X[0-9]+$", *[None] * 9)], BASE
    )


def get(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    counts = value_counts(df, "load", ["value", "n"], {"n": "partner"})
    return {tuple(r) for r in findings(counts, base(spark)).collect()}


def test_each_finding(spark):
    even = [float(i) for i in range(1, 101)]
    good = [(1, v, f"X{i}", f"s{i}") for i, v in enumerate(even)]
    nulls = [(2, v if i > 15 else None, f"X{i}", f"s{i}") for i, v in enumerate(even[::-1])]
    ranges = [(3, v, f"X{i}", f"s{i}") for i, v in enumerate(even)] + [(3, -0.5, "X1", "s1"), (3, math.nan, "X1", "s1")]
    shift = [(4, v / 3, f"X{i}", f"s{i}") for i, v in enumerate(even)]
    pattern = [(5, v, f"X{i}", f"s{i}") for i, v in enumerate(even)] + [(5, 50.0, "X1\n", "s"), (5, 50.0, "", "s")]
    twice = [(6, v, f"X{i % 50}", f"s{i}") for i, v in enumerate(even)]
    out = get(spark, good + nulls + ranges + shift + pattern + twice)
    assert out == {(2, "value", "nulls"), (3, "value", "range"), (4, "value", "shift"), (5, "n", "pattern"), (6, "n", "distinct")}


def test_null_loads_empty_tables_and_all_null(spark):
    assert get(spark, []) == set()
    assert get(spark, [(None, None, None, None)] * 3) == {(None, "value", "nulls"), (None, "n", "nulls")}


def test_profile_against_brute_force(spark):
    rows = [(i % 3, [None, math.nan, 1.5, -2.0, float(i)][i % 5], ["", None, "X1", "y"][i % 4], "p") for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {(r.load, r.column_name): r for r in profile(value_counts(df, "load"), base(spark)).collect()}
    assert len(out) == 9
    by = defaultdict(list)
    for r in rows:
        by[r[0], "value"].append(r[1])
        by[r[0], "n"].append(r[2])
    for k, v in by.items():
        o = out[k]
        real = [x for x in v if x is not None]
        assert (o.row_count, o.null_count, o.distinct_count) == (len(v), v.count(None), len({str(x) for x in real}))
        assert o.top_count == max(Counter(map(str, real)).values())
        if k[1] == "value":
            num = [x for x in real if x == x]
            assert (o.least_number, o.greatest_number, o.nan_count) == (min(num), max(num), len(real) - len(num))
        else:
            assert (o.least_text, o.greatest_text) == (min(real), max(real))
    assert out[0, "n"].psi is None and out[1, "n"].psi == pytest.approx(0, abs=0.05) and out[1, "n"].chi_square >= 0


def test_change_between_loads(spark):
    rows = [(1, float(i % 100), "X1", "p") for i in range(1000)] + [(2, float(i % 30), "X1", "p") for i in range(1000)] + [(3, float(i % 30), "X1", "p") for i in range(500)]
    out = {r.load: r for r in profile(value_counts(spark.createDataFrame(rows, SCHEMA), "load", ["value"]), base(spark)).collect()}
    assert out[2].psi > 1 and out[2].chi_square > 500 and out[3].psi < 0.01 and out[3].chi_square < 5


def test_any_column_names_and_types(spark):
    df = spark.sql("select 1 load, 'a' `e.x`, array(1, 2) arr, named_struct('a', 1) st, cast(null as int) `column_name`, true ok")
    assert {r.column_name for r in value_counts(df, "load").collect()} == {"e.x", "arr", "st", "column_name", "ok"}


def test_changed_identifiers_show_by_value(spark):
    """A third of 1,200 identifiers damaged: hash bins don't show it, their values do."""
    rows = [(1, f"BBG{i:09d}") for i in range(1200)] + [(2, f"BBG{i:09d}" if i % 3 else f"bbg{i:09d}") for i in range(1200)]
    counts = value_counts(spark.createDataFrame(rows, "load int, n string"), "load")
    out = {(r.load, r.column_name): r for r in changes(counts, base(spark)).collect()}
    assert set(out) == {(2, "n")}
    p, q, half = 1.5 / 1200.5, 0.5 / 1200.5, 400
    r = out[2, "n"]
    assert r.psi == pytest.approx(2 * half * (p - q) * math.log(p / q)) and r.chi_square == pytest.approx(2 * half) and r.n_bins == 1600
    assert {x.load: x.psi for x in profile(counts, base(spark)).collect()}[2] < r.psi / 10


def test_numbers_without_baseline_by_deciles_of_the_load_before(spark):
    """Within one power of two, so that only quantiles of the load before show the move."""
    r = random.Random(1)
    loads = {1: [r.choice([None, math.nan, 70 + r.random() * 50]) if r.random() < 0.3 else 70 + r.random() * 50 for _ in range(999)], 2: [100 + r.random() * 20 for _ in range(500)], 3: [None] * 7, 4: [80.0] * 10}
    counts = value_counts(spark.createDataFrame([(k, v) for k, x in loads.items() for v in x] + [(None, 1.0)], "load int, other double"), "load")
    out = {x.load: x for x in changes(counts, base(spark)).collect()}
    assert set(out) == {2, 3, 4}
    for k, x in out.items():
        now, old = loads[k], loads[k - 1]
        real = sorted(v for v in old if v is not None and v == v)
        cuts = [real[-(-i * len(real) // 10) - 1] for i in range(1, 10)] if real else []
        place = lambda v: "null" if v is None else "nan" if v != v else sum(v > q for q in cuts)  # noqa: B023, E731
        a, z = Counter(map(place, now)), Counter(map(place, old))
        n, m, both = len(now), len(old), set(a) | set(z)
        terms = [((a[b] + 0.5) / (n + 0.5), (z[b] + 0.5) / (m + 0.5)) for b in both]
        assert x.psi == pytest.approx(sum((p - q) * math.log(p / q) for p, q in terms)) and (x.n_bins, x.row_count, x.rows_before) == (len(both), n, m)
        assert x.chi_square == pytest.approx(sum((math.sqrt(m / n) * a[b] - math.sqrt(n / m) * z[b]) ** 2 / (a[b] + z[b]) for b in both))
    assert out[2].psi > 1
