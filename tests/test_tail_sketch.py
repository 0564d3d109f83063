import math

import numpy as np
import pytest

from tidemark.operators.tail_sketch import SECTION, TailSketch, TwoTails, merge_sketches, nearer_bound, percentiles, rank_bound, sketches

PS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.95, 0.99, 0.999, 1.0]


def off(xs, v, p):
    """Distance in ranks, as a share, of v from p: 0 if p lies among the ranks of values equal to v."""
    n = len(xs)
    lo, hi = np.searchsorted(xs, v, "left") / n, np.searchsorted(xs, v, "right") / n
    return max(lo - p, p - hi, 0)


@pytest.mark.parametrize("kind", ["lognormal", "sorted", "reversed", "ties"])
@pytest.mark.parametrize("parts", [1, 25])
def test_errors_within_bound_and_tail_exact(kind, parts):
    rng = np.random.default_rng(3)
    n = 200_000
    x = {"lognormal": rng.lognormal(3, 2, n), "sorted": np.arange(float(n)), "reversed": np.arange(float(n))[::-1], "ties": rng.integers(0, 50, n) * 1.0}[kind]
    some = []
    for i, part in enumerate(np.array_split(x, parts)):
        s = TailSketch(SECTION, i)
        s.update(part)
        some.append(TailSketch.unpack(s.pack()))
    while len(some) > 1:  # merged as a tree, in another order than they were made
        some = _paired(some)
    s, xs = some[0], np.sort(x)
    assert s.n == n and sum(len(v) << h for h, v in enumerate(s.items)) == n
    assert sum(map(len, s.items)) < n / 20
    for p, v in zip(PS, s.quantiles(PS)):
        assert off(xs, v, p) <= rank_bound(SECTION, p) + 2 / n, (p, v)
    assert s.quantiles([1.0]) == [xs[-1]]


@pytest.mark.parametrize("kind", ["lognormal", "sorted", "reversed", "ties"])
@pytest.mark.parametrize("parts", [1, 25])
def test_both_tails(kind, parts):
    rng = np.random.default_rng(5)
    n = 200_000
    x = {"lognormal": rng.lognormal(3, 2, n), "sorted": np.arange(float(n)), "reversed": np.arange(float(n))[::-1], "ties": rng.integers(0, 50, n) * 1.0}[kind]
    some = []
    for i, part in enumerate(np.array_split(x, parts)):
        s = TwoTails(SECTION, i)
        s.update(part)
        some.append(TwoTails.unpack(s.pack()))
    while len(some) > 1:
        some = _paired(some)
    xs = np.sort(x)
    for p, v in zip([0.0001, 0.001, *PS], some[0].quantiles([0.0001, 0.001, *PS])):
        assert off(xs, v, p) <= nearer_bound(SECTION, p) + 2 / n, (p, v)
    assert some[0].quantiles([0.0, 1.0]) == [xs[0], xs[-1]] and some[0].n == n and not some[0].exact


def _paired(some):
    out = []
    for a, b in zip(some[::2], some[1::2]):
        b.merge(a)
        out.append(b)
    return out + some[len(out) * 2 :]


@pytest.mark.parametrize("kind", [TailSketch, TwoTails])
def test_small_groups_are_exact(kind):
    s = kind()
    x = np.arange(1.0, 101)
    s.update(x)
    assert s.quantiles([0, 0.01, 0.5, 0.501, 1]) == [1, 1, 50, 51, 100]
    if kind is TwoTails:
        assert s.down.mirrored([0, 0.01, 0.5, 0.501, 1]) == [1, 1, 50, 51, 100]


def test_groups_days_and_odd_values(spark):
    rows = [("a", 1, float(i)) for i in range(5000)] + [("a", 2, float(i)) for i in range(5000, 10000)]
    rows += [("b", 1, None), ("b", 1, math.nan), ("c", None, 7.0), (None, 1, math.inf), (None, 1, 1.0), ("c", None, -math.inf)]
    df = spark.createDataFrame(rows, "n string, d int, v double").repartition(6)
    days = sketches(df, ["n", "d"], "v", fan_in=2)
    every = merge_sketches(days, ["n"])
    out = {(r.n_, r.p): r for r in percentiles(every, [0.5, 0.99]).collect()}
    assert {k[0] for k in out} == {"a", "c", None}
    assert out["a", 0.5].n == 10000 and abs(out["a", 0.99].value - 9900) <= 3 * 0.0041 * 100 + 1 and abs(out["a", 0.5].value - 5000) <= 62
    assert 0 < out["a", 0.99].rank_bound < out["a", 0.5].rank_bound and out["c", 0.5].rank_bound == 0
    assert out[None, 0.99].value == math.inf and out["c", 0.5].value == -math.inf and out["c", 0.5].n == 2
    assert {(r.n_, r.d): r.n for r in percentiles(days, [0.5]).collect()} == {("a", 1): 5000, ("a", 2): 5000, ("c", None): 2, (None, 1): 2}
    assert sketches(df.limit(0), ["n"], "v").count() == 0
    one = percentiles(sketches(df, [], "v"), [0.5]).collect()
    assert one[0].n == 10004
