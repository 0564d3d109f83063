"""Differences between two copies of data: characteristic-polynomial set reconciliation.

Every row becomes an element of the field of 2**61 - 1: a 60-bit hash of its key and fields. Rows fall into buckets by a
hash of their key. Per bucket and copy, only the values of the characteristic polynomial prod(z - element) at a few fixed
points are gathered. The ratio of the two copies' values is a rational function whose zeros and poles are the elements that
one copy has and the other hasn't; with degree bound d it is recovered from d + 1 points (Euclid's algorithm on the
interpolating polynomial, O(d**2)), and three more points verify it. Buckets that aren't verified go into another round
with twice the bound, others don't; as soon as the bound reaches a bucket's number of rows it can't fail. Each copy then
finds its differing rows as the zeros among its own elements, and only those rows are fetched and compared field by field.

Shuffled are (bucket, side, element) alone, twenty bytes a row, and after that sketches and polynomials, a dozen numbers per
bucket of about ``per_bucket`` rows; fields are read only when the rows that differ are fetched, by a semi join on the element
that the planner broadcasts while they are few. Beyond ``SIEVE_FROM`` of them, rows pass a broadcast bitmap first, eight
bits for each element that differs, so that hardly any others are shuffled; it has at most 64 MB. No bucket can be large: keys
are unique by then (``latest``), and copies of one key collapse before they are shuffled.

Defined results: nulls are values like others, equal to each other; integers and decimals are compared as they are;
floating-point numbers are equal if they lie at most ``tolerance`` apart (hashes are taken of the multiples of half of it, or,
where doubles are hardly denser than that, of the doubles, so that rows further apart always hash differently); NaN equals NaN; a
null in a key column matches a null; an empty copy leaves every row of the other one missing. Both copies are read several
times, so what is costly to work out should be written first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import c
from tidemark.session import staged

P = (1 << 61) - 1
M31, M30 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
P64 = np.uint64(P)
CHECKS = 3
#: Differing rows from which a bitmap goes before the join that fetches them, and bits of the bitmap at most.
SIEVE_FROM, SIEVE_BITS = 100_000, 1 << 29


def mulmod(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b mod 2**61 - 1 of uint64 arrays."""
    au, ad, bu, bd = a >> np.uint64(31), a & M31, b >> np.uint64(31), b & M31
    mid = ad * bu + au * bd
    x = au * bu * np.uint64(2) + (mid >> np.uint64(30)) + ((mid & M30) << np.uint64(31)) + ad * bd
    x = (x >> np.uint64(61)) + (x & P64)
    return np.where(x >= P64, x - P64, x)


def points(n: int) -> np.ndarray:
    """Fixed points, above every element."""
    return np.uint64(1 << 60) + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7 % (1 << 40))


def products(elements: np.ndarray, groups: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers in order, and per group and point the product of (point - element). groups must be in order."""
    v = at[None, :] - elements[:, None]  # elements lie below 2**60, points above
    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    sizes = np.diff(np.r_[starts, len(groups)])
    rank = np.arange(len(groups)) - np.repeat(starts, sizes)
    g = groups
    while len(rank) and rank.max() > 0:
        odd = np.flatnonzero(rank & 1)
        v[odd - 1] = mulmod(v[odd - 1], v[odd])
        keep = (rank & 1) == 0
        v, g, rank = v[keep], g[keep], rank[keep] >> 1
    return g, v


def _trim(a: list[int]) -> list[int]:
    while a and not a[-1]:
        a.pop()
    return a


def _divide(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    a, q, inv = a[:], [0] * max(0, len(a) - len(b) + 1), pow(b[-1], -1, P)
    for i in range(len(a) - len(b), -1, -1):
        q[i] = f = a[i + len(b) - 1] * inv % P
        if f:
            for j, x in enumerate(b):
                a[i + j] = (a[i + j] - f * x) % P
    return _trim(q), _trim(a)


def _multiply(a: list[int], b: list[int]) -> list[int]:
    out = [0] * (len(a) + len(b) - 1) if a and b else []
    for i, x in enumerate(a):
        if x:
            for j, y in enumerate(b):
                out[i + j] = (out[i + j] + x * y) % P
    return out


def _value(a: list[int], z: int) -> int:
    s = 0
    for x in reversed(a):
        s = (s * z + x) % P
    return s


def rational(ratio: list[int], at: list[int], surplus: int) -> tuple[list[int], list[int]] | None:
    """The monic polynomials of ratio at the points, degrees differing by surplus; None if the last CHECKS points deny them."""
    n = len(at) - CHECKS
    whole, newton = [1], []
    part: list[int] = []
    for z, f in zip(at[:n], ratio[:n]):  # Newton's form, and the product of all (x - z)
        newton = (f - _value(part, z)) * pow(_value(whole, z), -1, P) % P
        part = [((part[i] if i < len(part) else 0) + newton * x) % P for i, x in enumerate(whole)]
        whole = _multiply(whole, [-z % P, 1])
    bound = (n - 1 + surplus) // 2
    if not 0 <= bound < n:
        return None
    r0, r1, t0, t1 = whole, _trim(part), [], [1]
    while len(r1) - 1 > bound:
        q, r = _divide(r0, r1)
        qt = _multiply(q, t1)
        t = _trim([((t0[i] if i < len(t0) else 0) - (qt[i] if i < len(qt) else 0)) % P for i in range(max(len(t0), len(qt)))])
        r0, r1, t0, t1 = r1, r, t1, t
    if not r1 or not t1 or r1[-1] != t1[-1] or len(r1) - len(t1) != surplus:
        return None
    inv = pow(t1[-1], -1, P)
    p, q = [x * inv % P for x in r1], [x * inv % P for x in t1]
    if any(_value(p, z) != f * _value(q, z) % P for z, f in zip(at[n:], ratio[n:])):
        return None
    return p, q


def _sketch(n: int):
    """Rows of (bucket, side, element), in order of bucket, to (bucket, side, n, values)."""
    at = points(n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            group = b.column(0).to_numpy() * 2 + b.column(1).to_numpy()
            e = b.column(2).to_numpy().astype(np.uint64)
            o = np.argsort(group, kind="stable")
            g, v = products(e[o], group[o], at)
            count = np.unique(group, return_counts=True)[1]
            flat = pa.FixedSizeListArray.from_arrays(pa.array(v.astype(np.int64).ravel()), n).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(g >> 1), pa.array((g & 1).astype(np.int32)), pa.array(count.astype(np.int64)), flat], names=["bucket", "side", "n", "v"])

    return run


def _decode(n: int):
    """Sketches in order of bucket to the buckets that differ: (bucket, ok, p, q)."""
    at = [int(z) for z in points(n)]

    def bucket(rows: list[tuple[int, int, np.ndarray]]) -> tuple[bool, list[int], list[int]] | None:
        count, value = [0, 0], [np.ones(n, np.uint64), np.ones(n, np.uint64)]
        for side, k, v in rows:
            count[side] += k
            value[side] = mulmod(value[side], v)
        if count[0] == count[1] and (value[0] == value[1]).all():
            return None
        ratio = [int(a) * pow(int(b), -1, P) % P for a, b in zip(*value)]
        got = rational(ratio, at, count[0] - count[1])
        return (True, *got) if got else (False, [], [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, out = None, [], []

        def emit() -> pa.RecordBatch:
            cols = list(zip(*out))
            kinds = (pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, kinds)], names=["bucket", "ok", "p", "q"])

        for b in batches:
            vs = b.column(3).values.to_numpy().astype(np.uint64).reshape(-1, n) if b.num_rows else []
            for k, side, m, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), vs):
                if k != key:
                    if rows and (got := bucket(rows)):
                        out.append((key, *got))
                    key, rows = k, []
                rows.append((side, m, v))
            if len(out) >= 1000:
                yield emit()
                out = []
        if rows and (got := bucket(rows)):
            out.append((key, *got))
        if out:
            yield emit()

    return run


def _zeros(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (bucket, side, element, p, q): those whose element is a zero of their side's polynomial."""
    for b in batches:
        if not b.num_rows:
            continue
        side, e = b.column(1).to_numpy(), b.column(2).to_numpy().astype(np.uint64)
        polys = [p if s == 0 else q for s, p, q in zip(side, b.column(3).to_pylist(), b.column(4).to_pylist())]
        longest = max(map(len, polys))
        a = np.zeros((len(polys), longest), np.uint64)  # highest first; leading zeros change nothing
        for i, x in enumerate(polys):
            a[i, longest - len(x) :] = x[::-1]
        s = np.zeros(len(e), np.uint64)
        for j in range(longest):
            s = mulmod(s, e) + a[:, j]
            s = np.where(s >= P64, s - P64, s)
        yield pa.RecordBatch.from_arrays([b.column(i).filter(pa.array(s == 0)) for i in range(3)], names=["bucket", "side", "element"])


def latest(df: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """Per key the row with the greatest version, ties going to the greatest other columns."""
    rest = [x for x in df.columns if x not in keys and x not in version]
    best = df.groupBy(*map(c, keys)).agg(F.max(F.struct(*map(c, [*version, *rest]))).alias("__best"))
    return best.select(*map(c, keys), *(F.col("__best").getField(x).alias(x) for x in [*version, *rest]))


FLOATS, WHOLES = ("float", "double"), ("tinyint", "smallint", "int", "bigint")


def _kinds(a: DataFrame, b: DataFrame, names: list[str]) -> dict[str, str]:
    """What the columns of both copies are compared as: double if either is floating-point, an exact decimal if either is one, else text."""
    p, q, out = dict(a.dtypes), dict(b.dtypes), {}
    for x in names:
        both = {p[x].split("(")[0], q[x].split("(")[0]}
        number = both <= {*FLOATS, *WHOLES, "decimal"}
        scale = max((int(k[x].split(",")[1].rstrip(")")) for k in (p, q) if k[x].startswith("decimal")), default=0)
        out[x] = "double" if number and both & {*FLOATS} else f"decimal(38,{scale})" if number and "decimal" in both else "bigint" if number else "text"
    return out


def _text(x: Column, nested: bool, kind: str, tolerance: float) -> Column:
    if kind == "double":
        x = x.cast("double")
        # halves of the tolerance, so that rounding can't bring numbers further apart together; the number itself
        # from where doubles are about an eighth of the tolerance apart; -0.0 is 0.0
        x = F.when(F.abs(x) * 2**-50 >= tolerance / 2, x).otherwise(F.round(x / (tolerance / 2))) + F.lit(0.0)
    elif kind != "text":
        x = x.cast(kind)
    elif nested:
        x = F.to_json(x)
    return F.coalesce(F.concat(F.lit("v"), x.cast("string")), F.lit("n"))


def sieved(rows: DataFrame, elements: DataFrame, n: int, name: str) -> DataFrame:
    """The rows whose column name is among the n values of elements, and about an eighth of the others: by a bitmap in pieces of 4 KB."""
    bits = min(SIEVE_BITS, 1 << max(15, math.ceil(math.log2(8 * max(1, n)))))
    if 2 * n > bits:
        return rows  # the bitmap would be full
    place = lambda: F.pmod(c(name), F.lit(bits)) + 1
    maps = elements.groupBy(F.bitmap_bucket_number(place()).alias("__piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place())).alias("__bits"))
    both = rows.withColumn("__piece", F.bitmap_bucket_number(place())).join(F.broadcast(maps), "__piece")
    at = F.bitmap_bit_position(place())
    byte = F.conv(F.hex(F.substring("__bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return both.filter(F.expr("1") == F.getbit(byte, (at % 8).cast("int"))).drop("__piece", "__bits")


def side_name(keys: list[str], fields: list[str]) -> str:
    """The column that tells the copies apart: side, with as many underscores after it as keep it from keys and fields."""
    name, taken = "side", {x.lower() for x in [*keys, *fields]}
    while name in taken:
        name += "_"
    return name


def differing(a: DataFrame, b: DataFrame, keys: list[str], fields: list[str], tolerance: float = 1e-4, per_bucket: int = 64, bound: int = 8, sieve_from: int = SIEVE_FROM) -> DataFrame:
    """Rows that one copy has and the other hasn't: ``side_name`` (0 for a, 1 for b), keys and fields. Rows of a copy must be distinct."""
    mark = side_name(keys, fields)
    kinds = _kinds(a, b, [*keys, *fields])

    def elements(df: DataFrame, side: int, buckets: int, *also: Column) -> DataFrame:
        nested = {x for x, k in df.dtypes if k.startswith(("struct", "array", "map"))}
        key = [_text(c(x), x in nested, kinds[x], 1.0) for x in keys]
        whole = [*key, *(_text(c(x), x in nested, kinds[x], tolerance) for x in fields)]
        return df.select(
            F.pmod(F.xxhash64(F.lit("bucket"), *key), F.lit(buckets).cast("bigint")).alias("__bucket"), F.lit(side).alias("__side"),
            F.shiftrightunsigned(F.xxhash64(F.lit("element"), *whole), 4).alias("__element"), *also,
        )

    plain = {"__bucket": "bucket", "__side": "side", "__element": "element"}
    back = {y: x for x, y in plain.items()}
    buckets = max(1, math.ceil(max(a.count(), b.count()) / per_bucket))
    here = elements(a, 0, buckets).unionAll(elements(b, 1, buckets)).withColumnsRenamed(plain)
    here = staged(here.repartition("bucket").sortWithinPartitions("bucket"), "elements")
    todo, found = here, []
    while True:
        n = bound + 1 + CHECKS
        sketch = todo.mapInArrow(_sketch(n), "bucket bigint, side int, n bigint, v array<bigint>")
        decoded = sketch.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_decode(n), "bucket bigint, ok boolean, p array<bigint>, q array<bigint>")
        decoded = staged(decoded, "decoded")
        found.append(decoded.filter("ok"))
        left = decoded.filter("not ok").select("bucket")
        if left.isEmpty():
            break
        todo, bound = todo.join(left, "bucket", "left_semi"), bound * 2
    polys = found[0]
    for x in found[1:]:
        polys = polys.unionAll(x)
    near = here.join(polys.drop("ok"), "bucket").select("bucket", "side", "element", "p", "q")
    zeros = staged(near.mapInArrow(_zeros, "bucket bigint, side int, element bigint"), "zeros").withColumnsRenamed(back)
    n = zeros.count()
    rows = []
    for i, df in enumerate((a, b)):
        own = zeros.filter(c("__side") == i).drop("__side")
        all_ = elements(df, i, buckets, *map(c, keys), *map(c, fields))
        rows.append((sieved(all_, own, n, "__element") if n >= sieve_from else all_).join(own, ["__bucket", "__element"], "left_semi"))
    return rows[0].unionByName(rows[1]).drop("__bucket", "__element").withColumnRenamed("__side", mark)


def field_differences(
    rows: DataFrame, keys: list[str], fields: list[str], tolerance: float = 1e-4, missing: tuple[str, str] = ("missing_in_a", "missing_in_b")
) -> DataFrame:
    """Of ``differing`` rows with unique keys: keys and ``finding``, the side a key is missing on or a field that differs."""
    kinds = dict(rows.dtypes)
    mark = side_name(keys, fields)
    # both copies' rows of a key meet in one group of two at most
    s = [F.max(F.when(c(mark) == i, F.struct(*(c(x).alias(f"f{j}") for j, x in enumerate(fields)), F.lit(1).alias("there")))).alias(f"s{i}") for i in (0, 1)]
    both = rows.groupBy(*map(c, keys)).agg(*s)
    tests = [F.when(F.col("s0").isNull(), F.lit(missing[0])), F.when(F.col("s1").isNull(), F.lit(missing[1]))]
    there = F.col("s0").isNotNull() & F.col("s1").isNotNull()
    for j, x in enumerate(fields):
        p, q = F.col(f"s0.f{j}"), F.col(f"s1.f{j}")
        far = ~p.eqNullSafe(q)
        if kinds[x] in FLOATS:
            far = far & F.coalesce(F.abs(p.cast("double") - q.cast("double")) > tolerance, F.lit(True))
        tests.append(F.when(there & far, F.lit(x)))
    return both.select(*map(c, keys), F.explode(F.array_compact(F.array(*tests))).alias("finding"))
