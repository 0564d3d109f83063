import itertools
import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm.mix import FRAME, exact, mix, period, proportions, slots

DOCS = "doc_id bigint, text_key string, source string, n_tokens bigint, h int"
TARGETS = "source string, target_share double, max_repeats int"


@pytest.mark.parametrize("shares", [{"a": 0.2, "b": 0.2, "c": 0.15, "d": 0.1, "e": 0.35}, {"a": 1.0}, {"a": 1 / 3, "b": 2 / 3}, {"a": 0.9999, "b": 0.0001}, {}])
def test_every_prefix_is_less_than_a_block_off(shares):
    slots = period(shares)
    h = sum(map(len, slots.values()))
    assert sorted(t for x in slots.values() for t in x) == list(range(h))
    for x in slots.values():
        w = len(x) / h
        for i, t in enumerate(x):  # between release and deadline
            assert i / w < t + 1 + 1e-9 and t < (i + 1) / w + 1e-9
        done = 0
        for t in range(h):
            done += t in set(x[done : done + 1])
            assert abs(done - (t + 1) * w) < 1


def test_no_drift_from_the_targets_in_a_long_mix():
    """Against the target weights, not those of the schedule itself."""
    parts = {"filings": 20, "wire": 5, "research": 15, "chat": 23, "web": 35}
    slots = period({s: n / 100 for s, n in parts.items()})
    h = sum(map(len, slots.values()))
    for s, n in parts.items():
        for t in (h, 1_000, 15_000, 1_000_000, 10_000_019):
            done = t // h * len(slots[s]) + sum(x < t % h for x in slots[s])
            assert abs(done - Fraction(n, 98) * t) < 1


LONG = {"a": 0.123456789, "b": 0.5123, "c": 2**0.5 / 4, "d": 1e-9, "e": 0.01}


@pytest.mark.parametrize("shares", [LONG, {s: Fraction(n, 98) for s, n in (("a", 20), ("b", 5), ("c", 15), ("d", 23), ("e", 35))}, {"a": 1 / 7, "b": 1 / 11, "c": 0.3}])
def test_less_than_a_block_off_at_every_slot_of_a_long_mix(shares):
    """120,000 slots against the exact target weights."""
    parts = proportions(shares)
    total = sum(exact(w) for w in shares.values())
    weight = {s: exact(w) / total for s, w in shares.items()}
    h, stop = sum(parts.values()), 120_000
    at = np.full(stop, -1)
    names = list(parts)
    if h <= FRAME:
        one = period(shares)
        for k, s in enumerate(names):
            every = (np.array(one[s])[None, :] + h * np.arange(stop // h + 1)[:, None]).ravel()
            at[every[every < stop]] = k
    else:
        for s, i, t in itertools.islice(slots(parts), stop):
            w = weight[s]
            assert math.floor(i / w) <= t < math.ceil((i + 1) / w) and at[t] == -1
            at[t] = names.index(s)
    assert (at >= 0).all()
    for k, s in enumerate(names):
        n, d = weight[s].numerator, weight[s].denominator
        done = np.cumsum(at == k)
        # |done - w t| < 1 in whole numbers
        assert all(abs(int(x) * d - n * t) < d for t, x in enumerate(done, 1))


def test_mix_of_weights_of_a_long_period(spark):
    goals = [("big", 0.5123456789, 1), ("mid", 2**0.5 / 5, 2)]
    out, report = run(spark, made(), goals, block_tokens=100)
    used = {s: sum(x.source == s for x in out) for s in report}
    assert all(r.n_used == used[s] > 0 for s, r in report.items()) and len({(x.source, x.slot) for x in out}) == len({(x.source, x.start_token // 100) for x in out})
    total = sum(exact(g[1]) for g in goals)
    weight = {g[0]: exact(g[1]) / total for g in goals}
    for x in out:
        i, w = x.start_token // 100, weight[x.source]
        assert math.floor(i / w) <= x.slot < math.ceil((i + 1) / w)


def made(seed=0):
    r = random.Random(seed)
    rows, i = [], 0
    for source, n in (("big", 900), ("mid ", 200), ("SMALL", 12), ("other", 50), (None, 20)):
        for _ in range(n):
            rows.append((i, f"t{i}", source, r.choice([0, 5, 20, 60]), 1))
            i += 1
    rows += [(5000 + k, "t3", "mid", rows[3][3], 1) for k in range(40)]  # one text under many ids, in another source too
    return rows


GOALS = [("Big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.1, 3), ("nothing", 0.1, 5)]


def run(spark, rows, goals, **kw):
    out, report = mix(spark.createDataFrame(rows, DOCS).repartition(3), spark.createDataFrame(goals, TARGETS), **kw)
    return out.collect(), {r.source: r for r in report.collect()}


def test_shares_caps_and_order(spark):
    rows = made()
    size = {r[0]: r[3] for r in rows}
    out, report = run(spark, rows, GOALS, block_tokens=100)
    caps = {"big": 1, "mid": 2, "small": 3}
    key = {r[0]: r[1] for r in rows}
    used = Counter(key[x.doc_id] for x in out)
    assert set(x.source for x in out) == set(caps) and all(x.n_tokens == size[x.doc_id] for x in out)
    for x in out:
        assert used[key[x.doc_id]] <= caps[x.source]
    assert used["t3"] <= 1  # it counts as big's, under its least id
    total = sum(x.n_tokens for x in out)
    for s, w in (("big", 0.5 / 0.9), ("mid", 0.3 / 0.9), ("small", 0.1 / 0.9)):
        r = report[s]
        assert r.actual_share == pytest.approx(w, abs=60 / total) and r.actual_share == pytest.approx(r.tokens / total) and r.repeats <= r.max_repeats
    assert report["nothing"].tokens == 0 and report["nothing"].share_among_present == 0 and report["small"].repeats == 3
    # as read, every prefix is near its targets: a block of each side, and the text that runs over it
    out.sort(key=lambda x: (x.slot, x.start_token))
    done, n = Counter(), 0
    for x, y in zip(out, [*out[1:], None]):
        done[x.source] += x.n_tokens
        n += x.n_tokens
        if y is None or y.slot != x.slot:
            for s, w in (("big", 0.5 / 0.9), ("mid", 0.3 / 0.9), ("small", 0.1 / 0.9)):
                # a block of the source, one of all, and for each the text that runs over it
                assert abs(done[s] - w * n) <= 100 * (1 + w) + 60 * (1 + w)


def test_running_sums_over_buckets(spark, monkeypatch):
    rows = made()
    a = run(spark, rows, GOALS)[0]
    monkeypatch.setattr("tidemark.llm.mix.BUCKET_ROWS", 50)
    b = run(spark, rows, GOALS)[0]
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    by = defaultdict(list)
    for x in a:
        by[x.source].append((x.start_token, x.n_tokens))
    for v in by.values():
        v.sort()
        assert all(s + n <= t for (s, n), (t, _) in zip(v, v[1:]))


def test_smaller_and_larger_totals(spark):
    out, _ = run(spark, made(), GOALS, total_tokens=500)
    assert 350 < sum(x.n_tokens for x in out) < 750
    out, report = run(spark, made(), GOALS, total_tokens=10**7)
    assert report["big"].n_used == 900 and report["small"].n_used == 36


def test_empty_tables(spark):
    assert run(spark, [], GOALS)[0] == [] and run(spark, made(), []) == ([], {})
    out, report = run(spark, [(1, "a", "big", 0, 1)], GOALS)
    assert out == [] and report["big"].tokens == 0
