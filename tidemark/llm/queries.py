"""Queries over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.mix import mix
from tidemark.llm.pack import pack
from tidemark.llm.subjects import subject_sentences
from tidemark.llm.tokens import normal_source, token_counts
from tidemark.session import staged
from tidemark.sources.tables import table

#: Tokens of a block of a mix.
BLOCK_TOKENS = 2048


def _specs(spark: SparkSession, sf_dir: str) -> list[tuple[str, int]]:
    return [(r[0], r[1]) for r in table(spark, sf_dir, "pack_specs").select("container_name", "capacity_tokens").collect()]  # a fixed table


def _packed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The sizes of the texts, and their containers."""
    sizes = staged(token_counts(table(spark, sf_dir, "documents"), "text", {"doc_id": "item"}), "sizes")
    return sizes, pack(sizes, _specs(spark, sf_dir))


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of each text, for each capacity of pack_specs."""
    sizes = token_counts(table(spark, sf_dir, "documents"), "text", {"doc_id": "item"})
    return pack(sizes, _specs(spark, sf_dir)).withColumnRenamed("item", "doc_id")


def p8_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text in every kind of container: whether its parts add up to it, follow one another, and are one unless it is larger than the container."""
    sizes, packed = _packed(spark, sf_dir)
    got = packed.groupBy("container_name", "item").agg(F.sum("tokens").alias("s"), F.count(F.lit(1)).alias("n"), F.count_distinct("part").alias("d"), F.max("part").alias("last"), F.max("parts").alias("parts"))
    each = sizes.join(got, "item").join(table(spark, sf_dir, "pack_specs"), "container_name")
    one = (F.col("parts") == 1) | (F.col("n_tokens") > F.col("capacity_tokens"))
    return each.select("container_name", F.col("item").alias("doc_id"), ((F.col("s") == F.col("n_tokens")) & (F.col("n") == F.col("parts")) & (F.col("d") == F.col("n")) & (F.col("last") == F.col("n") - 1) & one).alias("whole"))


def p8_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per kind of container: those loaded above their capacity, the texts in them, and whether there are at most a hundredth more, and one, than all tokens need."""
    packed = staged(_packed(spark, sf_dir)[1], "packed")
    bins = packed.groupBy("container_name", "container_id").agg(F.sum("tokens").alias("t")).join(table(spark, sf_dir, "pack_specs"), "container_name")
    cap = F.col("capacity_tokens")
    per = bins.groupBy("container_name", "capacity_tokens").agg(F.count(F.when(F.col("t") > cap, 1)).alias("overfull"), F.count(F.lit(1)).alias("n"), F.sum("t").alias("t"))
    texts = packed.groupBy("container_name").agg(F.count_distinct("item").alias("n_docs"))
    return per.join(texts, "container_name").select("container_name", "capacity_tokens", "overfull", (F.col("n") <= F.ceil(F.col("t") / cap) * 1.01 + 1).alias("near_bound"), "n_docs")


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers and the share of their room that is used, per capacity."""
    specs = table(spark, sf_dir, "pack_specs")
    bins = p8_containers(spark, sf_dir).groupBy("container_name", "container_id").agg(F.sum("tokens").alias("t"), F.max("parts").alias("parts"))
    per = bins.groupBy("container_name").agg(F.count(F.lit(1)).alias("containers"), F.sum("t").alias("tokens"), F.max("t").alias("fullest"))
    out = per.join(specs, "container_name")
    return out.select("container_name", "capacity_tokens", "containers", "tokens", "fullest", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6).alias("fill"))


def _mix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    targets = table(spark, sf_dir, "mix_targets")
    goals = [r[0] for r in targets.select(normal_source(F.col("source"))).distinct().collect() if r[0] is not None]  # a fixed table
    # only texts that may be used are tokenised
    docs = table(spark, sf_dir, "documents").filter(normal_source(F.col("source")).isin(goals)).withColumn("text_key", F.sha2(F.coalesce("text", F.lit("")), 256))
    sizes = staged(token_counts(docs, "text", {"doc_id": "doc_id", "text_key": "text_key", "source": "source"}), "sizes")
    return mix(sizes, targets, block_tokens=BLOCK_TOKENS)


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The selection, with the slot of each text; read by (slot, start_token) every prefix is mixed to the targets."""
    return _mix(spark, sf_dir)[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares reached."""
    return _mix(spark, sf_dir)[1]


def p9_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source: whether no text is used more often than allowed, the share reached is off by less than the longest text, and every block stands between its release and its deadline."""
    out, report = (staged(x, "mix") for x in _mix(spark, sf_dir))
    targets = table(spark, sf_dir, "mix_targets").groupBy(normal_source(F.col("source")).alias("source")).agg(F.sum("target_share").alias("target_share"), F.min("max_repeats").alias("max_repeats"))
    used = out.groupBy("source", "doc_id").agg(F.count(F.lit(1)).alias("n")).groupBy("source").agg(F.max("n").alias("most"))
    whole = out.agg(F.sum("n_tokens").alias("total"), F.max("n_tokens").alias("longest"))  # one row
    w, block = F.col("share_among_present"), F.floor(F.col("start_token") / BLOCK_TOKENS)
    rows = out.join(report.select("source", "share_among_present"), "source")
    placed = (F.col("slot") >= F.floor(block / w + 1e-6)) & (F.col("slot") < F.ceil((block + 1) / w - 1e-6))
    slots = rows.groupBy("source").agg(F.bool_and(placed).alias("placed"))
    each = report.select("source", "share_among_present", "tokens").withColumn("one", F.lit(1)).join(whole.withColumn("one", F.lit(1)), "one").drop("one")
    each = targets.join(each, "source", "left").join(used, "source", "left").join(slots, "source", "left")
    none = F.coalesce(F.col("tokens"), F.lit(0)) == 0
    return each.select(
        "source", "target_share", "max_repeats", F.coalesce(F.col("most") <= F.col("max_repeats"), none).alias("cap_kept"),
        F.coalesce(F.abs(F.col("tokens") - w * F.col("total")) <= F.col("longest"), none).alias("share_kept"), F.coalesce("placed", none).alias("slots_kept"),
    )


def _subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subject_sentences(*(table(spark, sf_dir, x) for x in ("documents", "doc_labels", "subject_areas")))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The subjects of each document."""
    return _subjects(spark, sf_dir).select("doc_id", F.explode("found").alias("subject")).distinct()


def p10_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus by subject: documents, and sentences with their share of all sentences."""
    docs = staged(_subjects(spark, sf_dir), "subjects")
    whole = docs.agg(F.sum("n_sentences")).first()[0] or 0
    n = docs.select(F.explode("found").alias("subject")).groupBy("subject").agg(F.count(F.lit(1)).alias("n_docs"))
    s = docs.select(F.explode("subjects").alias("s")).groupBy("s.subject").agg(F.sum("s.n").alias("n_sentences"))
    return s.join(n, "subject", "left").select("subject", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), "n_sentences", F.round(F.try_divide("n_sentences", F.lit(whole)), 6).alias("share"))


def p10_consistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per subject area: whether the documents counted for it are those in which two sentences deal with it, or one of fewer than six, and no sentence was left unsettled."""
    docs = staged(_subjects(spark, sf_dir), "subjects")
    by_rule = docs.select("doc_id", "n_sentences", F.explode("subjects").alias("s")).filter("s.n > 1 or n_sentences < 6").groupBy("s.subject").agg(F.count_distinct("doc_id").alias("by_rule"))
    found = docs.select("doc_id", F.explode("found").alias("subject")).groupBy("subject").agg(F.count_distinct("doc_id").alias("found"))
    left = docs.agg(F.coalesce(F.sum("n_unsettled"), F.lit(0)).alias("left")).withColumn("one", F.lit(1))  # one row
    areas = table(spark, sf_dir, "subject_areas").select("subject").withColumn("one", F.lit(1)).join(left, "one")
    return areas.join(by_rule, "subject", "left").join(found, "subject", "left").select("subject", F.col("by_rule").eqNullSafe(F.col("found")).alias("agrees"), (F.col("left") == 0).alias("settled"))


QUERIES = {f.__name__: f for f in (p8_containers, p8_fill, p8_whole, p8_limits, p9_mix, p9_shares, p9_within, p10_found, p10_composition, p10_consistent)}

#: The others have none, as SQL has no tokenizer and no factorisation; these hold their rows against SQL (tests: brute force, held-out labels).
SQL = {
    "p8_whole": "SELECT container_name, doc_id, TRUE AS whole FROM pack_specs, documents",
    "p8_limits": "SELECT container_name, capacity_tokens, CAST(0 AS BIGINT) AS overfull, TRUE AS near_bound, (SELECT count(*) FROM documents) AS n_docs FROM pack_specs",
    "p9_within": "SELECT lower(trim(source)) AS source, sum(target_share) AS target_share, min(max_repeats) AS max_repeats, TRUE AS cap_kept, TRUE AS share_kept, TRUE AS slots_kept FROM mix_targets GROUP BY 1",
    "p10_consistent": "SELECT subject, TRUE AS agrees, TRUE AS settled FROM subject_areas",
}
