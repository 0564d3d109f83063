"""Column-level data quality profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import stamp
from tidemark.operators.profile import changes, findings, profile, value_counts
from tidemark.sources.tables import table

#: The tables, the column that tells their loads apart, the columns of the baseline, and those checked to map one to one.
LOADS = (
    ("gold_minute_bars", "silver_timestamp", ["volume", "composite_figi"], {"composite_figi": "symbol"}),
    ("gold_quote_stats", "updated_at", ["avg_spread_bps"], {}),
)


def _baseline(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, "profile_baseline").filter(F.col("table_name") == name).drop("table_name")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the loads departs from the accepted one."""
    parts = []
    for name, load, columns, partner in LOADS:
        counts = value_counts(table(spark, sf_dir, name), load, columns, partner)
        out = findings(counts, _baseline(spark, sf_dir, name))
        parts.append(out.select(F.lit(name).alias("table_name"), "column_name", stamp(F.col("load")).alias("load_ts"), "finding"))
    return parts[0].unionAll(parts[1])


def p6_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of every load."""
    parts = []
    for name, load, _, _ in LOADS:
        out = profile(value_counts(table(spark, sf_dir, name), load), _baseline(spark, sf_dir, name))
        rounded = [F.round(F.col(x) + 1e-9, 4).alias(x) if x in ("null_rate", "psi", "chi_square") else F.col(x) for x in out.columns if x != "load"]
        parts.append(out.select(F.lit(name).alias("table_name"), stamp(F.col("load")).alias("load_ts"), *rounded))
    return parts[0].unionAll(parts[1])


def p6_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of every load against the load before: text by value, numbers by deciles."""
    parts = []
    for name, load, _, _ in LOADS:
        out = changes(value_counts(table(spark, sf_dir, name), load), _baseline(spark, sf_dir, name))
        rounded = [F.round(F.col(x) + 1e-9, 4).alias(x) for x in ("psi", "chi_square")]
        parts.append(out.select(F.lit(name).alias("table_name"), stamp(F.col("load")).alias("load_ts"), "column_name", "rows_before", "row_count", "n_bins", *rounded))
    return parts[0].unionAll(parts[1])


QUERIES = {f.__name__: f for f in (p6_found, p6_profile, p6_changes)}


def _sql() -> str:
    parts = []
    for name, load, columns, partner in LOADS:
        for x in columns:
            numeric = not partner.get(x)
            rows = f"SELECT {load} AS load, {x} AS v, {partner.get(x, 'NULL')} AS s, b.* FROM {name}, profile_baseline b WHERE b.table_name = '{name}' AND b.column_name = '{x}'"
            head = f"SELECT '{name}' AS table_name, '{x}' AS column_name, strftime(load, '%Y-%m-%d %H:%M:%S') AS load_ts"
            parts.append(f"{head}, 'nulls' AS finding FROM ({rows}) GROUP BY load HAVING avg(CASE WHEN v IS NULL THEN 1.0 ELSE 0 END) > any_value(null_rate) + 0.05")
            if numeric:
                bad = "(isnan(CAST(v AS DOUBLE)) OR v < min_value OR v > max_value)"
                parts.append(f"{head}, 'range' FROM ({rows}) GROUP BY load HAVING count(*) FILTER (v IS NOT NULL AND {bad}) > 0")
                far = " OR ".join(f"abs(avg(CASE WHEN v <= q{i}0 THEN 1.0 ELSE 0 END) - {i / 10}) > 0.2" for i in range(1, 10))
                parts.append(f"{head}, 'shift' FROM ({rows}) WHERE v IS NOT NULL AND NOT {bad} GROUP BY load HAVING {far}")
            else:
                parts.append(f"{head}, 'pattern' FROM ({rows}) WHERE NOT regexp_matches(v, pattern) GROUP BY load")
                parts.append(
                    f"{head}, 'distinct' FROM ({rows}) WHERE regexp_matches(v, pattern) GROUP BY load "
                    "HAVING count(DISTINCT s) <> count(DISTINCT v) OR count(DISTINCT v) <> count(DISTINCT (s, v))"
                )
    return " UNION ALL ".join(parts)


_COLUMNS = {
    "gold_minute_bars": "composite_figi symbol event_type window_start window_end event_date open_price# high_price# low_price# close_price# volume# vwap# trade_count#",
    "gold_quote_stats": "composite_figi symbol window_start quote_date quote_count# avg_bid_price# avg_ask_price# avg_spread_dollars# avg_spread_bps# min_spread_bps# max_spread_bps# "
    "avg_mid_price# avg_bid_size# avg_ask_size# bid_size_total# ask_size_total# order_imbalance#",
}


def _profile_sql() -> str:
    long = []
    for name, load, _, _ in LOADS:
        for x in _COLUMNS[name].split():
            v = f"CAST({x[:-1]} AS DOUBLE)" if x.endswith("#") else "CAST(NULL AS DOUBLE)"
            t = "CAST(NULL AS VARCHAR)" if x.endswith("#") else f"CAST({x} AS VARCHAR)"
            long.append(f"SELECT '{name}' AS t, {load} AS load, '{x.rstrip('#')}' AS c, {v} AS v, {t} AS s FROM {name}")
    decile = " + ".join(f"(CASE WHEN v > q{i}0 THEN 1 ELSE 0 END)" for i in range(1, 10))
    power = "CASE WHEN v < 0 THEN '-' ELSE '' END || CASE WHEN abs(v) * 10000 < 1 THEN '0' ELSE CAST(length(bin(CAST(floor(least(abs(v) * 10000, 1e15)) AS BIGINT))) AS VARCHAR) END"
    return f"""
        WITH long AS ({" UNION ALL ".join(long)}),
        flat AS (SELECT t, load, c, v, s, count(*) AS n FROM long GROUP BY ALL),
        g AS (SELECT t, load, c, CAST(sum(n) AS BIGINT) AS row_count, CAST(coalesce(sum(n) FILTER (v IS NULL AND s IS NULL), 0) AS BIGINT) AS null_count, count(coalesce(CAST(v AS VARCHAR), s)) AS distinct_count,
          min(v) FILTER (NOT isnan(v)) AS least_number, max(v) FILTER (NOT isnan(v)) AS greatest_number, CAST(coalesce(sum(n) FILTER (isnan(v)), 0) AS BIGINT) AS nan_count,
          min(s) AS least_text, max(s) AS greatest_text, CAST(max(n) FILTER (v IS NOT NULL OR s IS NOT NULL) AS BIGINT) AS top_count FROM flat GROUP BY ALL),
        top AS (SELECT g.t, g.load, g.c, max(f.v) AS top_number, max(f.s) AS top_text FROM g JOIN flat f ON g.t = f.t AND g.load = f.load AND g.c = f.c AND g.top_count = f.n
          AND (f.v IS NOT NULL OR f.s IS NOT NULL) GROUP BY ALL),
        bins AS (SELECT t, load, c, CASE WHEN v IS NULL AND s IS NULL THEN 'null' WHEN isnan(v) THEN 'nan' WHEN q50 IS NOT NULL AND v IS NOT NULL THEN CAST({decile} AS VARCHAR)
            WHEN v IS NOT NULL THEN {power} ELSE substr(md5(s), 1, 1) END AS bin, sum(n) AS n
          FROM flat LEFT JOIN profile_baseline b ON t = b.table_name AND c = b.column_name GROUP BY ALL),
        loads AS (SELECT t, load, c, row_count, lag(load) OVER w AS before, lag(row_count) OVER w AS rows_before FROM g WINDOW w AS (PARTITION BY t, c ORDER BY load)),
        both_ AS (SELECT t, load, c, bin, sum(a) AS a, sum(z) AS z FROM (
            SELECT b.t, b.load, b.c, bin, n AS a, 0 AS z FROM bins b JOIN loads USING (t, load, c) WHERE before IS NOT NULL
            UNION ALL SELECT l.t, l.load, l.c, bin, 0, n FROM bins b JOIN loads l ON b.t = l.t AND b.c = l.c AND b.load = l.before) GROUP BY ALL),
        x AS (SELECT b.*, row_count, rows_before, (a + 0.5) / (row_count + 0.5) AS p, (z + 0.5) / (rows_before + 0.5) AS q FROM both_ b JOIN loads USING (t, load, c)),
        change AS (SELECT t, load, c, sum((p - q) * ln(p / q)) AS psi,
          sum(pow(sqrt(CAST(rows_before AS DOUBLE) / row_count) * a - sqrt(CAST(row_count AS DOUBLE) / rows_before) * z, 2) / (a + z)) AS chi_square FROM x GROUP BY ALL)
        SELECT g.t AS table_name, strftime(g.load, '%Y-%m-%d %H:%M:%S') AS load_ts, g.c AS column_name, row_count, null_count, round(null_count / row_count + 1e-9, 4) AS null_rate, nan_count, distinct_count,
          least_number, greatest_number, least_text, greatest_text, top_text, top_number, top_count, round(psi + 1e-9, 4) AS psi, round(chi_square + 1e-9, 4) AS chi_square
        FROM g LEFT JOIN top USING (t, load, c) LEFT JOIN change USING (t, load, c)"""


def _changes_sql() -> str:
    long = []
    for name, load, _, _ in LOADS:
        for x in _COLUMNS[name].split():
            v = f"CAST({x[:-1]} AS DOUBLE)" if x.endswith("#") else "CAST(NULL AS DOUBLE)"
            t = "CAST(NULL AS VARCHAR)" if x.endswith("#") else f"CAST({x} AS VARCHAR)"
            long.append(f"SELECT '{name}' AS t, {load} AS load, '{x.rstrip('#')}' AS c, {v} AS v, {t} AS s FROM {name}")
    own = ", ".join(f"min(v) FILTER (10 * upto >= {i} * total) AS o{i}" for i in range(1, 10))
    cuts = ", ".join(f"CASE WHEN q50 IS NULL THEN o{i} ELSE q{i}0 END AS c{i}" for i in range(1, 10))
    before = ", ".join(f"lag(c{i}) OVER w AS b{i}" for i in range(1, 10))
    bin_ = lambda p: (
        "CASE WHEN v IS NULL AND s IS NULL THEN 'null' WHEN s IS NOT NULL THEN '=' || s WHEN isnan(v) THEN 'nan' ELSE CAST("
        + " + ".join(f"(CASE WHEN v > {p}{i} THEN 1 ELSE 0 END)" for i in range(1, 10)) + " AS VARCHAR) END"
    )
    return f"""
        WITH long AS ({" UNION ALL ".join(long)}),
        flat AS (SELECT t, load, c, v, s, count(*) AS n FROM long WHERE load IS NOT NULL GROUP BY ALL),
        ranked AS (SELECT t, load, c, v, sum(n) OVER (PARTITION BY t, load, c ORDER BY v) AS upto, sum(n) OVER (PARTITION BY t, load, c) AS total FROM flat WHERE v IS NOT NULL AND NOT isnan(v)),
        own AS (SELECT t, load, c, {own} FROM ranked GROUP BY ALL),
        sized AS (SELECT t, load, c, CAST(sum(n) AS BIGINT) AS row_count FROM flat GROUP BY ALL),
        cuts AS (SELECT g.*, {cuts} FROM sized g LEFT JOIN own USING (t, load, c) LEFT JOIN profile_baseline b ON g.t = b.table_name AND g.c = b.column_name),
        loads AS (SELECT *, lag(row_count) OVER w AS rows_before, lead(load) OVER w AS next, {before} FROM cuts WINDOW w AS (PARTITION BY t, c ORDER BY load)),
        both_ AS (SELECT t, load, c, bin, sum(a) AS a, sum(z) AS z FROM (
            SELECT f.t, f.load, f.c, {bin_("b")} AS bin, n AS a, 0 AS z FROM flat f JOIN loads l ON f.t = l.t AND f.load = l.load AND f.c = l.c WHERE rows_before IS NOT NULL
            UNION ALL SELECT f.t, l.next, f.c, {bin_("c")}, 0, n FROM flat f JOIN loads l ON f.t = l.t AND f.load = l.load AND f.c = l.c WHERE next IS NOT NULL) GROUP BY ALL),
        x AS (SELECT b.*, row_count, rows_before, (a + 0.5) / (row_count + 0.5) AS p, (z + 0.5) / (rows_before + 0.5) AS q FROM both_ b JOIN loads USING (t, load, c))
        SELECT t AS table_name, strftime(load, '%Y-%m-%d %H:%M:%S') AS load_ts, c AS column_name, rows_before, row_count, count(*) AS n_bins, round(sum((p - q) * ln(p / q)) + 1e-9, 4) AS psi,
          round(sum(pow(sqrt(CAST(rows_before AS DOUBLE) / row_count) * a - sqrt(CAST(row_count AS DOUBLE) / rows_before) * z, 2) / (a + z)) + 1e-9, 4) AS chi_square FROM x GROUP BY ALL"""


SQL = {"p6_found": _sql(), "p6_profile": _profile_sql(), "p6_changes": _changes_sql()}
