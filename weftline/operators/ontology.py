"""Skills as canonical keys with their variants, histograms and confidences; and pairs of keys that may be the same skill."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.ranking import global_rank
from weftline.functions.scoring import display_name, with_canonical
from weftline.functions.text import half_up, strip
from weftline.session import cut

# Suffixes that qualify a skill without making another of it, in the order they are tried.
QUALIFIERS = ("programming", "language", "framework", "platform", "tools", "tool", "software", "technologies", "technology", "development", "applications", "application")
MIN_CONTAINED_JOBS = 20


def named(mentions: DataFrame, aliases=None) -> DataFrame:
    """Skill mentions with ``name`` (normalized_candidate or else the span, stripped), ``span`` and ``canonical_key``; nameless ones are left out."""
    span = strip(F.coalesce("skill_span", F.lit("")))
    candidate = F.col("normalized_candidate")
    name = strip(F.when(candidate.isNotNull() & (candidate != ""), candidate).otherwise(span))
    rows = mentions.where("is_skill").withColumn("span", span).withColumn("name", name).where("name != ''")
    return with_canonical(rows, "name", aliases=aliases).where("canonical_key != ''")


def build_ontology(mentions: DataFrame, aliases=None, min_mention_count: int = 1, top_titles: int = 10) -> DataFrame:
    """A row per canonical key of the skill mentions.

    Needs job_index, mention_idx (order), job_id, title_raw, skill_span, normalized_candidate, is_skill, hard_soft,
    requirement_level, final_confidence. A null job_id is one id; null hard_soft counts as 'unknown', null requirement_level as
    'unclear'. Everything is map-side combined on (key, value); a key on a third of all rows moves only its counts.
    """
    at = F.struct("job_index", "mention_idx")
    rows = named(mentions, aliases).select("canonical_key", "name", "span", F.coalesce("hard_soft", F.lit("unknown")).alias("type"), F.coalesce("requirement_level", F.lit("unclear")).alias("requirement"), "final_confidence", F.coalesce("job_id", F.lit("")).alias("job"), strip(F.coalesce("title_raw", F.lit(""))).alias("title"), at.alias("at"))
    # one aggregate feeds all others: rows that agree in all that is asked for are combined first and written once
    pre = cut(rows.groupBy("canonical_key", "name", "span", "type", "requirement", "job", "title").agg(F.count("*").alias("n"), F.min("at").alias("at"), F.sum(F.col("final_confidence").cast("decimal(18,6)")).alias("conf"), F.count("final_confidence").alias("n_conf"), F.min("final_confidence").alias("low"), F.max("final_confidence").alias("high")))
    base = pre.groupBy("canonical_key").agg(F.sum("n").alias("mention_count"), F.min("at").alias("first_at"), (F.sum("conf").cast("double") / F.nullif(F.sum("n_conf"), F.lit(0))).alias("avg"), F.min("low").alias("low"), F.max("high").alias("high")).where(F.col("mention_count") >= min_mention_count)
    jobs = pre.groupBy("canonical_key", "job").agg(F.lit(1).alias("one")).groupBy("canonical_key").agg(F.count("*").alias("job_count"))
    names = pre.select("canonical_key", F.explode(F.array_distinct(F.array("name", F.when(F.col("span") != "", F.col("span")).otherwise(F.col("name"))))).alias("v")).groupBy("canonical_key").agg(F.collect_set("v").alias("all_variants"))

    def mode(value: str) -> DataFrame:
        counts = pre.groupBy("canonical_key", value).agg(F.sum("n").alias("n"), F.min("at").alias("at"))
        ranked = F.array_min(F.collect_list(F.struct((-F.col("n")).alias("neg"), "at", F.col(value).alias("v"))))
        return counts.groupBy("canonical_key").agg(ranked["v"].alias(value), F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(value).alias("k"), F.col("n").alias("v"))))).alias(f"{value}_distribution"))

    titles = pre.where("title != ''").groupBy("canonical_key", "title").agg(F.sum("n").alias("n"), F.min("at").alias("at"))
    rank = F.row_number().over(Window.partitionBy("canonical_key").orderBy(F.desc("n"), "at", "title"))
    top = titles.withColumn("rank", rank).where(F.col("rank") <= top_titles).groupBy("canonical_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "title"))), lambda x: x["title"]).alias("common_contexts"))
    j = base.join(jobs, "canonical_key").join(names, "canonical_key").join(mode("type"), "canonical_key").join(mode("requirement"), "canonical_key").join(top, "canonical_key", "left")
    display = display_name(F.col("canonical_key"), F.col("all_variants"))
    return j.withColumn("canonical_skill", display).select(
        "canonical_skill",
        "canonical_key",
        F.array_sort(F.filter("all_variants", lambda v: F.lower(v) != F.lower("canonical_skill"))).alias("variants"),
        "type",
        "type_distribution",
        F.col("requirement").alias("requirement_level"),
        "requirement_distribution",
        "job_count",
        "mention_count",
        half_up(F.col("avg")).alias("avg_confidence"),
        F.array(F.round("low", 4), F.round("high", 4)).alias("confidence_range"),
        F.coalesce("common_contexts", F.array().cast("array<string>")).alias("common_contexts"),
        "first_at",
    )


def ranked(ontology: DataFrame) -> DataFrame:
    """In order of jobs, mentions and first appearance, with ``rank``."""
    return global_rank(ontology, [F.desc("job_count"), F.desc("mention_count"), F.asc("first_at")])


def duplicate_pairs(ontology: DataFrame, min_jobs: int = 2, min_contained_jobs: int = MIN_CONTAINED_JOBS) -> DataFrame:
    """``key_a, key_b, skill_a, skill_a_jobs, skill_b, skill_b_jobs, reason, suggested_target``, a row per unordered pair.

    Whole-word containment is an equi-join: every run of a key between two word boundaries is looked up among the keys, so no
    pair of keys is compared that doesn't share it. Of several reasons the first in the order below holds.
    """
    e = cut(ontology.select(F.col("canonical_key").alias("k"), F.col("canonical_skill").alias("skill"), F.col("job_count").alias("jobs")))
    b = e.select(F.col("k").alias("base"), F.col("skill").alias("base_skill"), F.col("jobs").alias("base_jobs"))
    long = e.where(F.col("jobs") >= min_jobs)
    suffix = "|".join(QUALIFIERS)
    rules = F.array(
        F.struct(F.lit(1).alias("p"), F.lit("microsoft_prefix").alias("reason"), F.when(F.col("k").startswith("microsoft "), F.substring("k", 11, 10**6)).alias("base")),
        F.struct(F.lit(2).alias("p"), F.lit("ms_prefix").alias("reason"), F.when(F.col("k").startswith("ms "), F.substring("k", 4, 10**6)).alias("base")),
        F.struct(F.lit(3).alias("p"), F.lit("qualifier_suffix").alias("reason"), F.when(F.col("k").rlike(rf" (?:{suffix})$"), F.regexp_replace("k", rf" (?:{suffix})$", "")).alias("base")),
        F.struct(F.lit(4).alias("p"), F.lit("version_variant").alias("reason"), F.when(F.col("k").rlike(r"(?U)\s+\d+(\.\d+)*(\.x)?$"), F.regexp_replace("k", r"(?U)\s+\d+(\.\d+)*(\.x)?$", "")).alias("base")),
    )
    affix = long.select("k", "skill", "jobs", F.explode(rules).alias("r")).select("k", "skill", "jobs", "r.*").where(F.col("base").isNotNull() & (F.col("base") != F.col("k"))).join(b, "base")
    prefix = F.col("p") <= 2
    target = F.when(prefix & (F.col("base_jobs") < F.col("jobs")), F.col("skill")).otherwise(F.col("base_skill"))
    affix = affix.select(F.col("k").alias("key_a"), F.col("base").alias("key_b"), F.col("skill").alias("skill_a"), F.col("jobs").alias("skill_a_jobs"), F.col("base_skill").alias("skill_b"), F.col("base_jobs").alias("skill_b_jobs"), "reason", target.alias("suggested_target"), "p")
    parts = F.regexp_extract_all("k", F.lit(r"(?U)(\w+|\W+)"), 1)
    n = F.size("parts")
    word = lambda i: F.get(F.col("parts"), i).rlike(r"(?U)^\w")
    opens = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i > 0) | word(i))
    closes = lambda i: F.filter(F.sequence(i, n - 1), lambda j: (j < n - 1) | word(j))
    runs = F.flatten(F.transform(opens, lambda i: F.transform(closes(i), lambda j: F.array_join(F.slice(F.col("parts"), i + 1, j - i + 1), ""))))
    held = long.where(F.length("k") > 3).withColumn("parts", parts).select("k", "skill", "jobs", F.explode(F.array_distinct(runs)).alias("base")).where((F.length("base") >= 3) & (F.length("base") < F.length("k")))
    inside = held.join(b.where(F.col("base_jobs") >= min_jobs), "base").where(F.greatest("jobs", "base_jobs") >= min_contained_jobs)
    inside = inside.select(F.col("base").alias("key_a"), F.col("k").alias("key_b"), F.col("base_skill").alias("skill_a"), F.col("base_jobs").alias("skill_a_jobs"), F.col("skill").alias("skill_b"), F.col("jobs").alias("skill_b_jobs"), F.lit("substring_containment").alias("reason"), F.when(F.col("base_jobs") >= F.col("jobs"), F.col("base_skill")).otherwise(F.col("skill")).alias("suggested_target"), F.lit(5).alias("p"))
    best = F.row_number().over(Window.partitionBy(F.least("key_a", "key_b"), F.greatest("key_a", "key_b")).orderBy("p", "key_a"))
    return affix.unionByName(inside).withColumn("_n", best).where("_n = 1").drop("_n", "p")


def by_jobs(pairs: DataFrame) -> DataFrame:
    """Pairs in the order a reader should look at them: those of most jobs first."""
    return pairs.orderBy(F.desc(F.col("skill_a_jobs") + F.col("skill_b_jobs")), "key_a", "key_b")
