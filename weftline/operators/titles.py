"""Which skills a job title asks for, weighted by how many of its postings do."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.scoring import display_name
from weftline.functions.text import strip
from weftline.operators.ontology import named

# Fixed values.
HARD_WEIGHT, SOFT_WEIGHT, CONFIDENCE_FLOOR = 1.0, 0.5, 0.6


def titled(jobs: DataFrame, normalization: DataFrame | None = None) -> DataFrame:
    """``job_index, job, title`` of the jobs with a title: lower-cased, or its entry in ``raw_title, normalized_title``; jobs without entry are left out.

    Of several entries of a raw title the last by ``position`` holds, or the greatest where the table has no such column.
    """
    rows = jobs.select("job_index", F.coalesce(F.col("job_id").cast("string"), F.lit("")).alias("job"), strip(F.coalesce("title_raw", F.lit(""))).alias("raw")).where("raw != ''")
    if normalization is None:
        return rows.select("job_index", "job", F.lower("raw").alias("title"))
    place = F.col("position") if "position" in normalization.columns else F.lit(0)
    table = normalization.select(strip(F.col("raw_title")).alias("raw"), strip(F.col("normalized_title")).alias("title"), place.alias("at")).where("raw != '' and title != ''")
    return rows.join(table.groupBy("raw").agg(F.max(F.struct("at", "title"))["title"].alias("title")), "raw").select("job_index", "job", "title")


def unmapped(jobs: DataFrame, normalization: DataFrame) -> DataFrame:
    """``n_jobs`` whose title has no entry."""
    rows = jobs.select("job_index", strip(F.coalesce("title_raw", F.lit(""))).alias("raw")).where("raw != ''")
    return rows.join(normalization.select(strip(F.col("raw_title")).alias("raw")), "raw", "left_anti").agg(F.count("*").alias("n_jobs"))


def title_skills(jobs: DataFrame, mentions: DataFrame, normalization: DataFrame | None = None, aliases=None, confidence_floor: float = CONFIDENCE_FLOOR) -> DataFrame:
    """``title, job_count, canonical_key, skill, points, type, posting_count``; a null confidence passes the floor.

    A job counts once per key and type; the type with most votes gives the weight, the first seen among equals.
    """
    t = titled(jobs, normalization)
    sure = mentions.where(F.col("final_confidence").isNull() | (F.col("final_confidence") >= confidence_floor))
    rows = named(sure, aliases).select("job_index", "mention_idx", "canonical_key", "name", F.coalesce("hard_soft", F.lit("unknown")).alias("type"))
    once = rows.groupBy("job_index", "canonical_key", "type").agg(F.min("mention_idx").alias("mention_idx"))
    met = once.join(t, "job_index")
    votes = met.groupBy("title", "canonical_key", "type").agg(F.count("*").alias("n"), F.min(F.struct("job_index", "mention_idx")).alias("at"))
    kinds = votes.groupBy("title", "canonical_key").agg(F.array_min(F.collect_list(F.struct((-F.col("n")).alias("neg"), "at", "type")))["type"].alias("type"))
    postings = met.select("title", "canonical_key", "job").distinct().groupBy("title", "canonical_key").agg(F.count("*").alias("posting_count"))
    names = rows.join(t.select("job_index"), "job_index", "left_semi").groupBy("canonical_key").agg(F.collect_set("name").alias("v"))
    jobs_of = t.groupBy("title").agg(F.count_distinct("job").alias("job_count"))
    j = postings.join(kinds, ["title", "canonical_key"]).join(names, "canonical_key").join(jobs_of, "title")
    weight = F.when(F.col("type") == "hard", HARD_WEIGHT).otherwise(SOFT_WEIGHT)
    return j.select("title", "job_count", "canonical_key", display_name(F.col("canonical_key"), F.col("v")).alias("skill"), F.round(F.col("posting_count") * weight, 1).alias("points"), "type", "posting_count")


def nested(flat: DataFrame) -> DataFrame:
    """``title, job_count, skills`` (array by points, then name), for a JSON sink."""
    skills = F.array_sort(F.collect_list(F.struct((-F.col("points")).alias("neg"), "skill", "points", "type", "posting_count")))
    return flat.groupBy("title", "job_count").agg(F.transform(skills, lambda s: F.struct(s["skill"].alias("skill"), s["points"].alias("points"), s["type"].alias("type"), s["posting_count"].alias("posting_count"))).alias("skills"))


def top_titles(flat: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` titles of most jobs."""
    return flat.select("title", "job_count").distinct().orderBy(F.desc("job_count"), "title").limit(n)


def rank_skills(flat: DataFrame) -> DataFrame:
    return flat.withColumn("rank", F.row_number().over(Window.partitionBy("title").orderBy(F.desc("points"), "canonical_key")))
