"""Exact column profiles from column-value counts, and comparison of loads.

All columns of a table are unpivoted to (load, column, value) and counted; equal values collapse in each input partition
before they are shuffled, and the shuffle key holds the value, so no load or column is worked on by one task. Everything
else comes from the counts: null rates, distinct numbers, ranges, violations of a pattern, and frequencies, by which a
load is compared with the one before it (population stability index and chi-square). ``changes`` compares text value by
value and numbers over the deciles of the load before; ``profile`` has the same measures over fixed, coarse bins.

Values are counted as text; a number's text reads back as the same number. Defined results: null, NaN and the empty
string are three values; a null load is a load of its own; a column named like the load column's own is not profiled;
a load without rows doesn't exist; columns of nested types are counted by their JSON text; columns may have any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import c
from tidemark.operators.quantiles import ranked_counts
from tidemark.session import staged

NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
DECILES = [f"q{i}0" for i in range(1, 10)]


def value_counts(df: DataFrame, load: str, columns: list[str] | None = None, partner: dict[str, str] | None = None) -> DataFrame:
    """load, column_name, numeric, value, partner, n. partner: columns counted together with another one's value."""
    kinds = dict(df.dtypes)
    entries = []
    for x in columns or [y for y in df.columns if y != load]:
        text = c(x).cast("string") if not kinds[x].startswith(("struct", "array", "map")) else F.to_json(c(x))
        mate = c(partner[x]).cast("string") if partner and x in partner else F.lit(None).cast("string")
        entries.append(
            F.struct(F.lit(x).alias("column_name"), F.lit(kinds[x].split("(")[0] in NUMBERS).alias("numeric"), text.alias("value"), mate.alias("partner"))
        )
    long = df.select(c(load).alias("load"), F.explode(F.array(*entries)).alias("e")).select("load", "e.*")
    return long.groupBy("load", "column_name", "numeric", "value", "partner").agg(F.count(F.lit(1)).alias("n"))


def findings(counts: DataFrame, baseline: DataFrame) -> DataFrame:
    """load, column_name, finding: nulls, range, shift, pattern and distinct against the accepted load's row in baseline."""
    b = counts.join(baseline.withColumnRenamed("column_name", "name"), F.col("column_name") == F.col("name"))
    v = F.when(F.col("numeric"), F.col("value").try_cast("double"))
    known = F.col("value").isNotNull()
    out_of_range = F.isnan(v) | F.coalesce(v < F.col("min_value"), F.lit(False)) | F.coalesce(v > F.col("max_value"), F.lit(False))
    bad = F.col("numeric") & known & out_of_range
    within = F.col("numeric") & known & ~out_of_range
    # the end of the text, not of a line before its last line break
    matches = F.regexp_like(F.col("value"), F.regexp_replace("pattern", r"\$$", r"\\z"))
    fits = ~F.col("numeric") & known & matches
    total = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0))
    g = b.groupBy("load", "column_name", "numeric", "null_rate", "pattern", *DECILES).agg(
        F.sum("n").alias("rows"), total(~known).alias("null_rows"), total(bad).alias("bad"), total(within).alias("within"),
        total(~F.col("numeric") & known & ~matches).alias("unfit"),
        *(total(within & (v <= F.col(q))).alias(f"upto_{q}") for q in DECILES),
        F.count_distinct(F.when(fits, F.col("partner"))).alias("partners"),
        F.count_distinct(F.when(fits, F.col("value"))).alias("values"),
        F.count_distinct(F.when(fits & F.col("partner").isNotNull(), F.struct("partner", "value"))).alias("pairs"),
    )
    far = [F.coalesce(F.abs(F.try_divide(f"upto_{q}", "within") - F.lit((i + 1) / 10)) > 0.2, F.lit(False)) for i, q in enumerate(DECILES)]
    tests: dict[str, Column] = {
        "nulls": F.col("null_rows") / F.col("rows") > F.col("null_rate") + 0.05,
        "range": F.col("bad") > 0,
        "shift": F.col("numeric") & reduce(lambda x, y: x | y, far),
        "pattern": F.col("pattern").isNotNull() & (F.col("unfit") > 0),
        "distinct": F.col("pattern").isNotNull() & ((F.col("partners") != F.col("values")) | (F.col("values") != F.col("pairs"))),
    }
    found = F.array_compact(F.array(*(F.when(t, F.lit(k)) for k, t in tests.items())))
    return g.select("load", "column_name", F.explode(found).alias("finding"))


def _distances() -> tuple[Column, Column]:
    """psi and chi_square over bins with a rows of row_count now and z of rows_before before."""
    p, q = (F.col("a") + 0.5) / (F.col("row_count") + 0.5), (F.col("z") + 0.5) / (F.col("rows_before") + 0.5)
    ra, rz = F.sqrt(F.col("rows_before") / F.col("row_count")), F.sqrt(F.col("row_count") / F.col("rows_before"))
    return (
        F.sum((p - q) * F.log(p / q)).alias("psi"),
        F.sum(F.pow(ra * F.col("a") - rz * F.col("z"), 2) / (F.col("a") + F.col("z"))).alias("chi_square"),
    )


def profile(counts: DataFrame, baseline: DataFrame) -> DataFrame:
    """Per load and column: rows, nulls, distinct values, range, most frequent value, and the change since the load before.

    Bins: the deciles of baseline for the columns it has; for other numbers their sign and the bits of their ten-thousandths,
    so that a bin spans a factor of two; for the rest 16 hash bins of the value. psi and chi_square compare counts per bin, each with half a row added to keep logarithms finite.
    Hash bins hardly show changed identifiers: for those, changes compares the values themselves.
    """
    v = F.when(F.col("numeric"), F.col("value").try_cast("double"))
    flat = staged(counts.groupBy("load", "column_name", "numeric", "value").agg(F.sum("n").alias("n")), "counts")  # read by two branches
    real = F.when(~F.isnan(v), v)
    g = flat.groupBy("load", "column_name", "numeric").agg(
        F.sum("n").alias("row_count"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("null_count"),
        F.count("value").alias("distinct_count"), F.min(real).alias("least_number"), F.max(real).alias("greatest_number"),
        F.sum(F.when(F.isnan(v), F.col("n")).otherwise(0)).alias("nan_count"),
        F.min(F.when(~F.col("numeric"), F.col("value"))).alias("least_text"), F.max(F.when(~F.col("numeric"), F.col("value"))).alias("greatest_text"),
        F.max(F.when(F.col("value").isNotNull(), F.struct("n", v.alias("x"), "value"))).alias("top"),
    )
    b = flat.join(baseline.select(F.col("column_name").alias("name"), *DECILES), F.col("column_name") == F.col("name"), "left")
    decile = reduce(lambda x, y: x + y, [F.when(v > F.col(q), 1).otherwise(0) for q in DECILES])
    bits = F.bin(F.floor(F.least(F.abs(v) * 10_000, F.lit(1e15))))
    power = F.concat(F.when(v < 0, "-").otherwise(""), F.when(F.abs(v) * 10_000 < 1, "0").otherwise(F.length(bits).cast("string")))
    bin_ = (
        F.when(F.col("value").isNull(), "null").when(F.isnan(v), "nan").when(F.col("q50").isNotNull() & F.col("numeric"), decile.cast("string"))
        .when(F.col("numeric"), power).otherwise(F.substring(F.md5("value"), 1, 1))
    )
    bins = staged(b.groupBy("load", "column_name", bin_.alias("bin")).agg(F.sum("n").alias("n")), "bins")  # some twenty rows per load and column
    g = staged(g, "totals")  # one row per load and column
    order = Window.partitionBy("column_name").orderBy("load")  # as many rows as loads
    loads = g.select("load", "column_name", F.col("row_count")).withColumn("before", F.lag("load").over(order)).withColumn("rows_before", F.lag("row_count").over(order))
    now = bins.join(loads, ["load", "column_name"]).filter("before is not null")
    cur = now.select("load", "column_name", "bin", F.col("n").alias("a"), F.lit(0).cast("bigint").alias("z"))
    old = bins.withColumnRenamed("load", "before").join(loads, ["before", "column_name"]).select(
        "load", "column_name", "bin", F.lit(0).cast("bigint").alias("a"), F.col("n").alias("z")
    )
    both = cur.unionAll(old).groupBy("load", "column_name", "bin").agg(F.sum("a").alias("a"), F.sum("z").alias("z"))
    both = both.join(loads.select("load", "column_name", "row_count", "rows_before"), ["load", "column_name"])
    change = both.groupBy("load", "column_name").agg(*_distances())
    return (
        g.join(change, ["load", "column_name"], "left")
        .withColumn("null_rate", F.col("null_count") / F.col("row_count"))
        .select("load", "column_name", "row_count", "null_count", "null_rate", "nan_count", "distinct_count", "least_number", "greatest_number", "least_text", "greatest_text", F.when(~F.col("numeric"), F.col("top.value")).alias("top_text"), F.col("top.x").alias("top_number"), F.col("top.n").alias("top_count"), "psi", "chi_square")
    )


def load_deciles(flat: DataFrame) -> DataFrame:
    """load, column_name, own: the exact deciles of each load's numbers, from (load, column_name, v, n). The k-th is the least value up to which k tenths of the rows lie."""
    ranked = ranked_counts(flat.select("load", "column_name", "v", "n"), ["load", "column_name"])
    reached = lambda k: F.col("upto") * 10 >= F.col("total") * k
    return ranked.groupBy("load", "column_name").agg(F.array(*(F.min(F.when(reached(k), F.col("v"))) for k in range(1, 10))).alias("own"))


def changes(counts: DataFrame, baseline: DataFrame) -> DataFrame:
    """Each load's columns against the load before: load, column_name, rows_before, row_count, n_bins, psi, chi_square.

    Bins: every value for columns that aren't numbers; the deciles of baseline for the numbers it has, and for others the
    exact deciles of the load before. Null and NaN are bins. Measures as in profile. The first load has no row, nor has the null load.
    """
    v = F.when(F.col("numeric"), F.col("value").try_cast("double"))
    flat = counts.filter("load is not null").groupBy("load", "column_name", "numeric", "value").agg(F.sum("n").alias("n")).withColumn("v", v)
    flat = staged(flat, "counts")
    fixed = baseline.filter("q50 is not null").select("column_name", F.array(*map(F.col, DECILES)).alias("fixed"))
    free = flat.filter("numeric and v is not null and not isnan(v)").join(fixed, "column_name", "left_anti").select("load", "column_name", "v", "n")
    order = Window.partitionBy("column_name").orderBy("load")  # as many rows as loads
    loads = flat.groupBy("load", "column_name").agg(F.sum("n").alias("row_count")).join(load_deciles(free), ["load", "column_name"], "left")
    loads = loads.join(fixed, "column_name", "left").select("load", "column_name", "row_count", F.coalesce("fixed", "own").alias("cuts"))
    loads = loads.withColumns({"rows_before": F.lag("row_count").over(order), "cuts_before": F.lag("cuts").over(order), "next": F.lead("load").over(order)})
    loads = staged(loads, "loads")  # a row per load and column

    def bin_(cuts: str) -> Column:
        decile = F.size(F.filter(F.coalesce(F.col(cuts), F.array().cast("array<double>")), lambda q: F.col("v") > q))
        return F.when(F.col("value").isNull(), "null").when(~F.col("numeric"), F.concat(F.lit("="), "value")).when(F.isnan("v"), "nan").otherwise(decile.cast("string"))

    nil = F.lit(0).cast("bigint")
    placed = flat.join(loads.select("load", "column_name", "cuts", "cuts_before", "rows_before", "next"), ["load", "column_name"])
    now = placed.filter("rows_before is not null").select("load", "column_name", bin_("cuts_before").alias("bin"), F.col("n").alias("a"), nil.alias("z"))
    old = placed.filter("next is not null").select(F.col("next").alias("load"), "column_name", bin_("cuts").alias("bin"), nil.alias("a"), F.col("n").alias("z"))
    both = now.unionAll(old).groupBy("load", "column_name", "bin").agg(F.sum("a").alias("a"), F.sum("z").alias("z"))
    both = both.join(loads.select("load", "column_name", "row_count", "rows_before"), ["load", "column_name"])
    psi, chi_square = _distances()
    return both.groupBy("load", "column_name", "rows_before", "row_count").agg(F.count(F.lit(1)).alias("n_bins"), psi, chi_square)
