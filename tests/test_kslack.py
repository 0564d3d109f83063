import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.kslack import kslack
from tidemark.streaming.kslack import BUFFER, advance, kslack_stream

T0 = datetime(2020, 1, 2, 14, 30)
SCHEMA = "key string, t timestamp_ntz, arrived timestamp_ntz, seq bigint, v double, extra string"


def brute(rows, grace=120, slack=3600):
    first = {}
    for r in rows:
        k, t, a, q, v, _ = r
        if t is None:
            continue
        old = first.get((k, t, q))
        rank = lambda x: (x[2] is None, x[2] or T0, x[4] is not None, x[4] or 0)
        if old is None or rank(r) < rank(old):
            first[k, t, q] = r
    out = {}
    for k, t, a, q, v, _ in first.values():
        if v is None or v <= 0:
            continue
        w = t.replace(second=0, microsecond=0)
        m = out.setdefault((k, w), {"am": 0, "rej": 0, "prov": [], "final": []})
        delay = None if a is None else (a - w).total_seconds() - 60
        if delay is None or delay > slack:
            m["rej"] += 1
            continue
        m["final"].append((t, q, v))
        if delay > grace:
            m["am"] += 1
        else:
            m["prov"].append((t, q, v))
    res = {}
    for (k, w), m in out.items():
        row = [m["am"], m["rej"]]
        for s in ("prov", "final"):
            e = sorted(m[s], key=lambda x: (x[0], x[1]))
            if not e:
                row += [0, None, None, None, None]
                continue
            stop = w + timedelta(minutes=1)
            at = [x[0] for x in e] + [stop]
            area = sum(x[2] * (b - a).total_seconds() for x, a, b in zip(e, at, at[1:]))
            span = (stop - e[0][0]).total_seconds()
            row += [len(e), sum(x[2] for x in e) / len(e), e[0][2], e[-1][2], area / span if span else None]
        res[k, w] = row
    return res


def made(seed, n, hot=False):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        k = "H" if hot and r.random() < 0.6 else r.choice(["A", "B", "", None])
        t = T0 + timedelta(seconds=r.randrange(30 if hot else 240), microseconds=r.randrange(10**6))
        late = r.choice([0, 1, 30, 130, 200, 3500, 3700, 9000])
        rows.append((k, r.choice([t, t, t, None]), r.choice([t + timedelta(seconds=late)] * 9 + [None]), r.randrange(3), r.choice([None, -1.0] + [r.uniform(1, 9) for _ in range(6)]), "x"))
    return rows + r.sample(rows, n // 4) + [(*x[:2], x[2] and x[2] + timedelta(seconds=5), *x[3:]) for x in rows[: n // 5]]


def near(a, b):
    return len(a) == len(b) and all(x == y if x is None or y is None else x == pytest.approx(y, rel=1e-9) for x, y in zip(a, b))


def run(spark, rows, parts=3, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    out = kslack(df, "key", "t", "arrived", "seq", {"v": F.col("v")}, F.col("v") > 0, ranged=("v",), ordered=("v",), **kw)
    got = {}
    for r in out.collect():
        w = datetime(1970, 1, 1) + timedelta(microseconds=r.period)
        got[r.key, w] = [r.n_amended, r.n_rejected, *(x for s in ("prov", "final") for x in (r[f"{s}_n"], r[f"{s}_avg_v"], r[f"{s}_open_v"], r[f"{s}_close_v"], r[f"{s}_twa_v"]))]
    return got


@pytest.mark.parametrize(("seed", "n", "hot"), [(1, 150, False), (2, 600, True)])
def test_against_brute_force(spark, seed, n, hot):
    rows = made(seed, n, hot)
    # small batches: a period then reaches into many of them
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got, want = run(spark, rows), brute(rows)
        assert run(spark, rows, inputs=("v",)) == got
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert got.keys() == want.keys()
    for k in want:
        assert near(got[k], want[k]), (k, got[k], want[k])


def test_empty(spark):
    assert run(spark, []) == {}


def streamed(spark, at, parts, **kw):
    """Rows that come out of a stream fed with one file per part and, at the end, two far events; Spark's count of dropped rows."""
    far = T0 + timedelta(days=1)
    for i, part in enumerate([*parts, [("Z", far, far, 0, 1.0, "x")], [("Z", far, far + timedelta(hours=1), 1, 1.0, "x")]]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(f"{at}/in/{i}")
    src = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{at}/in")
    out = []

    def batch(df, n):
        out.extend((n, x) for x in df.collect() if x.key != "Z")

    q = kslack_stream(src, "key", "t", "arrived", "seq", "v", **kw).writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", f"{at}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    dropped = sum(o["numRowsDroppedByWatermark"] for p in q.recentProgress for o in p["stateOperators"])
    return out, dropped


def start(x):
    return datetime(1970, 1, 1) + timedelta(microseconds=x.period)


def test_stream_gives_the_same_values(spark, tmp_path):
    r = random.Random(5)
    rows = []
    for i in range(160):
        t = T0 + timedelta(seconds=r.randrange(180))
        v = r.choice([None, -1.0] + [float(i + 1)] * 6)
        rows.append(("A" if i % 3 else "B", t, t + timedelta(seconds=r.choice([1, 40, 150, 3000, 4000])), i, v, "x"))
    rows += [(*x[:2], x[2] + timedelta(seconds=7), *x[3:]) for x in r.sample(rows, 40)]  # copies
    want = brute(rows)
    rows.sort(key=lambda x: x[2])
    out, dropped = streamed(spark, tmp_path, [rows[:60], rows[60:110], rows[110:]], valid=F.col("v") > 0)
    assert dropped == 0 and {x.stage for _, x in out} == {"provisional", "amended", "final", "rejected"}
    for stage, at in (("provisional", 2), ("final", 7)):
        got = {(x.key, start(x)): (x.n, x.mean, x.open, x.close) for _, x in out if x.stage == stage}
        assert len(got) == sum(x.stage == stage for _, x in out)
        assert got == {k: (w[at], pytest.approx(w[at + 1]), w[at + 2], w[at + 3]) for k, w in want.items() if w[at]}
    assert {(x.key, start(x)): x.n_amended for _, x in out if x.stage == "final"} == {k: w[0] for k, w in want.items() if w[7]}


def test_provisional_values_come_at_the_grace(spark, tmp_path):
    at = lambda s: T0 + timedelta(seconds=s)
    # nothing more comes to A's minute; B's event moves the clock beyond its grace, but not its slack
    out, _ = streamed(spark, tmp_path, [[("A", at(1), at(2), 1, 5.0, "")], [("B", at(200), at(201), 1, 7.0, "")], [("B", at(201), at(202), 2, 7.0, "")]])
    a = [(n, x.stage, x.n, x.mean) for n, x in out if x.key == "A"]
    assert [x[1:] for x in a] == [("provisional", 1, 5.0), ("final", 1, 5.0)] and a[0][0] < a[1][0]
    assert [x.stage for _, x in out if x.key == "B"] == ["provisional", "final"]


@pytest.mark.parametrize("reorder", [0, 3600])
def test_arrivals_out_of_order_across_batches_are_kept_or_counted(spark, tmp_path, reorder):
    at = lambda s: T0 + timedelta(seconds=s)
    parts = [[("A", at(1), at(2), 1, 5.0, "")], [("B", at(40), at(45), 1, 1.0, "")], [("A", at(3), at(5), 2, 9.0, "")], [("B", at(3700), at(3800), 1, 1.0, "")], [("A", at(4), at(6), 3, 1.0, "")]]
    out, dropped = streamed(spark, tmp_path, parts, reorder_s=reorder)
    final = [x.n for _, x in out if x.stage == "final" and x.key == "A"]
    missed = sum(x.n_missed for _, x in out if x.key == "A")
    assert dropped == 0 and (final, missed) == (([3], 0) if reorder else ([2], 1))


def test_a_hot_key_in_one_state(spark):
    held, told = np.empty(0, BUFFER), np.empty(0, np.int64)
    new = np.zeros(1000, BUFFER)
    new["t"], new["seq"], new["arrival"], new["v"], new["ok"] = np.arange(1000) * 10**6, 1, np.arange(1000) * 10**6, 2.0, 1
    held, told, out, due = advance(held, told, new, 0, 60 * 10**6, 3600 * 10**6, 120 * 10**6)
    assert not out and due == 180 * 10**6
    held, told, out, due = advance(held, told, new[:0], 300 * 10**6, 60 * 10**6, 3600 * 10**6, 120 * 10**6)
    assert out[0]["n"].tolist() == [60] * 3 and due == 360 * 10**6 and len(held) == 1000
    held, told, out, due = advance(held, told, new[:0], 10**12, 60 * 10**6, 3600 * 10**6, 120 * 10**6)
    assert due is None and {x for o in out for x in o["stage"]} == {"provisional", "final"} and out[-1]["n"].sum() == 1000
