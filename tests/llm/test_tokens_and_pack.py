import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm.pack import pack, sum_of_squares
from tidemark.llm.tokens import encoder, token_counts, VOCABULARY


def plain(sizes, capacity):
    """Every choice tried, the sum worked out anew each time."""
    gaps, out, used = [], [], 0
    for s in sizes:
        def total(g):
            n = Counter(x for x in g if 0 < x < capacity)
            return sum(v * v for v in n.values())

        options = []
        for k, g in enumerate(gaps):
            if g >= s:
                options.append((total(gaps[:k] + [g - s] + gaps[k + 1 :]), 0, g, k))
        options.append((total([*gaps, capacity - s]), 1, 0, used))
        cost, fresh, _, k = min(options, key=lambda x: x[:3])
        if fresh:
            gaps.append(capacity - s)
            used += 1
        else:
            gaps[k] -= s
        out.append(k)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_same_sums_as_trying_every_choice(seed):
    r = random.Random(seed)
    cap = r.choice([7, 20, 50])
    sizes = [r.randint(1, cap) for _ in range(60)]
    a, b = sum_of_squares(np.array(sizes), cap, 0.0), plain(sizes, cap)
    load = lambda o: sorted(np.bincount(np.unique(o, return_inverse=True)[1], weights=sizes).tolist())
    assert load(a) == load(b)


def test_little_room_is_left():
    r = np.random.default_rng(0)
    sizes = np.sort(np.minimum(512, r.lognormal(4.5, 1, 5000).astype(int) + 1))[::-1]
    for full in (0.0, 0.98):
        o = sum_of_squares(sizes, 512, full)
        load = np.bincount(o, weights=sizes)
        assert load.max() <= 512 and sizes.sum() / (512 * len(load)) > 0.99


def packed(spark, items, specs, **kw):
    return pack(spark.createDataFrame(items, "item bigint, n_tokens bigint, cap int, `block` string").repartition(3), specs, **kw).collect()


@pytest.mark.parametrize(("bins", "rows"), [(4096, 100_000), (3, 40)])
def test_containers_hold_whole_items(spark, bins, rows):
    r = random.Random(4)
    items = [(i, r.choice([0, 1, 5, 9, 10, 11, 25, 30]), 0, "") for i in range(300)]
    items += [items[0], (None, 7, 0, "")]  # a repeated row and one without an id
    out = packed(spark, items, [("a", 10), ("b", 30)], bins=bins, rows=rows)
    for name, cap in (("a", 10), ("b", 30)):
        load, parts = Counter(), defaultdict(list)
        for x in out:
            if x.container_name == name:
                load[x.container_id] += x.tokens
                parts[x.item].append((x.part, x.parts, x.tokens))
        assert max(load.values()) <= cap and sum(load.values()) == sum(x[1] for x in items)
        for i, n, *_ in items[1:-2]:
            assert len(parts[i]) == max(1, -(-n // cap)) and sum(x[2] for x in parts[i]) == n
            assert sorted(x[0] for x in parts[i]) == list(range(len(parts[i]))) and all(x[2] == cap for x in parts[i] if x[0] < x[1] - 1)
        assert len(parts[0]) == 2 * max(1, -(-items[0][1] // cap)) and parts[None] == [(0, 1, 7)]
        assert sum(load.values()) / (cap * len([v for v in load.values() if v])) > (0.95 if bins > 3 else 0.8)


def test_empty_and_impossible(spark):
    assert packed(spark, [], [("a", 10)]) == []
    assert [x.tokens for x in packed(spark, [(1, 0, 0, "")], [("a", 10)])] == [0]
    with pytest.raises(ValueError):
        packed(spark, [], [("a", 0)])


def test_token_counts(spark):
    texts = ["", None, "Hello world, hello!", "ü" * 50_000, "<|endoftext|>", " \n\t "]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: r.n_tokens for r in token_counts(df, "text", {"id": "id"}).collect()}
    e = encoder(VOCABULARY)
    assert got == {i: len(e.encode_ordinary(t)) if t else 0 for i, t in enumerate(texts)}
    assert e.decode(e.encode_ordinary(texts[2])) == texts[2] and got[4] > 1
