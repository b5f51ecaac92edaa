"""The results of the stages are joined to final mentions, with the rules of which stage has the say.

All joins are on job_index and mention_idx; where a stage has a row twice, the later by ``_order`` or the greatest holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.scoring import final_confidence

KEY = ["job_index", "mention_idx"]
RAN_VERIFIER = ("accepted", "rejected", "parse_failed", "error")
RAN_CLASSIFIER = ("completed", "parse_failed", "error")


def one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by ``order``."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def stage(df: DataFrame, prefix: str, value: str) -> DataFrame:
    """A stage's rows with prefixed columns, one per mention."""
    once = one_per_key(df, KEY, [F.desc_nulls_last("status"), F.desc_nulls_last("confidence"), F.desc_nulls_last(value)])
    return once.select(*KEY, *[F.col(c).alias(f"{prefix}_{c}") for c in ("status", "confidence", value)])


def merge_stages(mentions: DataFrame, verified: DataFrame, required: DataFrame, hardsoft: DataFrame, legacy: bool = False) -> DataFrame:
    """Mentions with is_skill, requirement_level, hard_soft and their statuses and confidences after the merge.

    A verifier that ran decides; rejected, unreadable and failed replies mean no skill. Without one the extractor's flag holds,
    and without that the mention is a skill. In legacy mode only a rejection means no skill. Classifiers likewise; values outside their vocabulary count as not given.
    """
    v = stage(verified, "v", "is_skill")
    r = stage(required, "r", "requirement_level")
    h = stage(hardsoft, "h", "hard_soft")
    j = mentions.join(v, KEY, "left").join(r, KEY, "left").join(h, KEY, "left")
    v_status, raw = F.coalesce("v_status", F.lit("skipped")), F.coalesce("raw_model_confidence", F.lit(0.7))
    ran, flag = v_status.isin(*RAN_VERIFIER), F.col("is_skill")
    verdict = v_status != "rejected" if legacy else (v_status == "accepted") & F.coalesce("v_is_skill", F.lit(True))
    is_skill = F.when(ran, verdict).otherwise(F.coalesce(flag, F.lit(True)))

    def classified(p: str, value: str, own: Column, words: tuple[str, ...], default: str) -> tuple[Column, Column, Column]:
        status = F.coalesce(f"{p}_status", F.lit("skipped"))
        done = status.isin(*RAN_CLASSIFIER)
        extracted = own.isin(*words)
        return (
            F.when(done, F.coalesce(f"{p}_{value}", F.lit(default))).when(extracted, own).otherwise(F.lit(default)),
            F.when(done, status).when(extracted, F.lit("extractor")).otherwise(status),
            F.when(done, F.col(f"{p}_confidence")).when(extracted, raw).otherwise(F.col(f"{p}_confidence")),
        )

    req, req_status, req_conf = classified("r", "requirement_level", F.col("requirement_level"), ("required", "optional", "unclear"), "unclear")
    hs, hs_status, hs_conf = classified("h", "hard_soft", F.col("hard_soft"), ("hard", "soft", "unknown"), "unknown")
    out = j.select(
        *[c for c in mentions.columns if c not in ("is_skill", "requirement_level", "hard_soft", "raw_model_confidence")],
        raw.alias("raw_model_confidence"),
        is_skill.alias("is_skill"),
        F.when(ran, v_status).when(flag.isNotNull(), "extractor").otherwise(v_status).alias("verifier_status"),
        F.when(ran, F.col("v_confidence")).when(flag.isNotNull(), raw).otherwise(F.col("v_confidence")).alias("verifier_confidence"),
        req.alias("requirement_level"),
        req_status.alias("requirement_status"),
        req_conf.alias("requirement_confidence"),
        hs.alias("hard_soft"),
        hs_status.alias("hardsoft_status"),
        hs_conf.alias("hardsoft_confidence"),
    )
    return out


def with_lines(mentions: DataFrame, lines: DataFrame) -> DataFrame:
    """Mentions with the section, label and text of their line; those whose line is unknown are dropped, numbering keeps their gap."""
    once = one_per_key(lines.where(F.col("line_id").isNotNull()), ["line_id"], [F.asc("line_index"), F.asc_nulls_last("boilerplate_label")])
    return mentions.drop("section").join(once.select("line_id", "section", "boilerplate_label", F.col("text").alias("source_line"), F.col("char_start").alias("line_start")), "line_id")


def scored(merged: DataFrame) -> DataFrame:
    """Merged mentions with final_confidence; needs section, boilerplate_label, n_rules, offset_valid and evidence_ok."""
    c = F.col
    return merged.withColumn(
        "final_confidence",
        final_confidence(c("raw_model_confidence"), c("verifier_status"), c("verifier_confidence"), c("requirement_status"), c("requirement_confidence"), c("hardsoft_status"), c("hardsoft_confidence"), c("section"), c("boilerplate_label"), c("n_rules"), c("offset_valid"), c("evidence_ok")),
    )


def numbered(mentions: DataFrame) -> DataFrame:
    """Dense mention ids per job, in order of mention_idx."""
    n = F.row_number().over(Window.partitionBy("job_index").orderBy("mention_idx")) - 1
    return mentions.withColumn("mention_id", F.format_string("%s_M%05d", "job_key", n))


def audit(merged: DataFrame) -> DataFrame:
    """Merged mentions with ``pipeline_audit``, the status of each stage as a struct."""
    return merged.withColumn("pipeline_audit", F.struct(*[F.struct(F.col(f"{s}_status").alias("status"), F.col(f"{s}_confidence").alias("confidence")).alias(f"{s}_stage") for s in ("verifier", "requirement", "hardsoft")]))


def with_metadata(jobs: DataFrame, run_id: str, version: str, models: dict[str, str], started: str, completed: str) -> DataFrame:
    """Described jobs with ``extraction_metadata``; the title is kept to 200 characters there."""
    extra = F.create_map(*[F.lit(x) for kv in models.items() for x in kv]) if models else F.create_map().cast("map<string,string>")
    error = F.col("error") if "error" in jobs.columns else F.lit(None).cast("string")
    return jobs.withColumn("extraction_metadata", F.struct(F.lit(run_id).alias("run_id"), F.lit(version).alias("version"), F.col("job_key"), F.substring("title", 1, 200).alias("job_title_snapshot"), F.lit(started).alias("started_at"), F.lit(completed).alias("completed_at"), error.alias("error"), extra.alias("models")))


def stage_counters(merged: DataFrame) -> DataFrame:
    """One row of counters over mentions; an empty table gives zeros."""
    n = lambda condition: F.count_if(condition)
    return merged.agg(
        F.count("*").alias("mentions"),
        n(F.col("is_skill")).alias("skills"),
        n(F.col("verifier_status") == "parse_failed").alias("verifier_parse_failed"),
        n(F.col("verifier_status") == "rejected").alias("verifier_rejected"),
        n(F.col("requirement_status") == "parse_failed").alias("requirement_parse_failed"),
        n(F.col("hardsoft_status") == "parse_failed").alias("hardsoft_parse_failed"),
        (n(F.col("requirement_status") == "error") + n(F.col("hardsoft_status") == "error")).alias("stage_errors"),
    )


def run_totals(jobs: DataFrame, mentions: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """``total_jobs, jobs_success, jobs_failed, total_mentions, zero_mention_jobs``; a job without mentions is a success."""
    per_job = mentions.groupBy("job_index").agg(F.count("*").alias("n"))
    failed = errors.select("job_index").distinct().withColumn("failed", F.lit(True)) if errors is not None else None
    all_ = jobs.select("job_index").distinct().join(per_job, "job_index", "left")
    all_ = all_.join(failed, "job_index", "left") if failed is not None else all_.withColumn("failed", F.lit(None).cast("boolean"))
    return all_.agg(F.count("*").alias("total_jobs"), F.count_if(F.col("failed").isNull()).alias("jobs_success"), F.count_if(F.col("failed").isNotNull()).alias("jobs_failed"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_mentions"), F.count_if(F.col("n").isNull()).alias("zero_mention_jobs"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those with the same keys."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def missing(all_items: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What is still to do: items without a finished row."""
    return all_items.join(done.select(*keys).distinct(), keys, "left_anti")
