"""The queries of the core operators over the tables of a data folder; their SQL is in ``weftline.plans.oracle``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import scoring, text
from weftline.operators import assemble, candidates, checks, grounding, lines, model_calls, ontology, reports, titles
from weftline.plans import oracle, pipeline
from weftline.session import table
from weftline.sources import sinks

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


# --- views -------------------------------------------------------------------------------------------------------------


def jobs(spark: SparkSession, d: str) -> DataFrame:
    return lines.current_jobs(table(spark, d, "jobs"))


def described(spark: SparkSession, d: str) -> DataFrame:
    return lines.describe(jobs(spark, d))


def labelled(spark: SparkSession, d: str) -> DataFrame:
    return lines.label(lines.segment(described(spark, d)))


def mentions(spark: SparkSession, d: str) -> DataFrame:
    """Distinct mentions with ``mention_idx``, their place in the job."""
    return table(spark, d, "skill_mentions").distinct().withColumn("mention_idx", F.regexp_extract("mention_id", r"_M(\d+)$", 1).cast("int"))


def stored_lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "parsed_lines").distinct()


def aliases(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "skill_reference").select(F.explode("aliases").alias("alias"), F.lower("canonical_skill").alias("target"))
    return rows.select(F.lower("alias").alias("alias"), "target")


def stages(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Verdicts as the stages would have left them, from the mention table's own columns: classifiers ran on accepted mentions."""
    m = mentions(spark, d)
    key = ["job_index", "mention_idx"]
    verified = m.where(F.col("verifier_status").isin(*assemble.RAN_VERIFIER)).select(*key, F.col("verifier_status").alias("status"), F.nanvl("verifier_confidence", F.lit(None).cast("double")).alias("confidence"), "is_skill")
    ran = m.where("verifier_status = 'accepted'")
    required = ran.select(*key, F.when(F.col("requirement_level").isNull(), "parse_failed").otherwise("completed").alias("status"), F.col("final_confidence").alias("confidence"), "requirement_level")
    kinds = ran.select(*key, F.when(F.col("hard_soft").isNull(), "parse_failed").otherwise("completed").alias("status"), F.col("final_confidence").alias("confidence"), "hard_soft")
    return verified, required, kinds


def merged(spark: SparkSession, d: str) -> DataFrame:
    base = mentions(spark, d).drop("verifier_status", "verifier_confidence", "final_confidence", "section")
    m = assemble.merge_stages(base, *stages(spark, d))
    placed = assemble.with_lines(m, stored_lines(spark, d))
    return placed.withColumns(
        {
            "n_rules": F.lit(0),
            "offset_valid": grounding.offset_valid(F.col("source_line"), F.col("skill_span"), F.col("line_start"), F.col("char_start")),
            "evidence_ok": grounding.evidence_ok(F.col("source_line"), F.col("evidence")),
        }
    )


def calls(spark: SparkSession, d: str) -> DataFrame:
    """A call log from the events: the type as model and role, the value as seconds, k as tokens and speed."""
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(F.col("event_id").alias("call_id"), "ts", F.col("event_type").alias("model"), F.when(F.col("event_type") == "view", "extractor").otherwise("skill_verifier").alias("role"), F.col("value").alias("wall_time"), (F.length("props") * 40).alias("resp_chars"), k.alias("eval_tokens"), k.cast("double").alias("tok_s"))


def two_runs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Required mentions and all others, as two runs over the same jobs."""
    m = mentions(spark, d)
    needed = F.coalesce(F.col("requirement_level") == "required", F.lit(False))
    return m.where(needed), m.where(~needed)


def by_extractor(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Mentions of the two extractor models; each saw other jobs."""
    m = mentions(spark, d)
    return m.where("extractor_model = 'ext-large'"), m.where("extractor_model = 'ext-small'")


def compared(spark: SparkSession, d: str) -> DataFrame:
    a, b = two_runs(spark, d)
    per_job = lambda m: m.groupBy("job_index").agg(F.count("*").alias("n"))
    return reports.compare_runs(per_job(a), per_job(b))


# --- jobs and texts ------------------------------------------------------------------------------------------------------


@query
def job_keys(spark: SparkSession, d: str) -> DataFrame:
    return described(spark, d).select("job_index", "job_key")


@query
def title_coalesce(spark: SparkSession, d: str) -> DataFrame:
    return described(spark, d).select("job_index", "title")


@query
def description_coalesce(spark: SparkSession, d: str) -> DataFrame:
    return described(spark, d).select("job_index", "description_raw")


@query
def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    return lines.describe(jobs(spark, d), split=False).select("job_index", "description_normalized")


@query
def split_headers(spark: SparkSession, d: str) -> DataFrame:
    return described(spark, d).select("job_index", "description_normalized")


@query
def segment_lines(spark: SparkSession, d: str) -> DataFrame:
    return lines.segment(described(spark, d)).select("job_index", "line_id", "line_index", "section", "text", "char_start", "char_end")


@query
def line_labels(spark: SparkSession, d: str) -> DataFrame:
    return labelled(spark, d).select("line_id", "job_index", "line_index", "boilerplate_label")


@query
def label_histogram(spark: SparkSession, d: str) -> DataFrame:
    return labelled(spark, d).groupBy("section", "boilerplate_label").agg(F.count("*").alias("n"))


@query
def extraction_lines(spark: SparkSession, d: str) -> DataFrame:
    return lines.for_extraction(labelled(spark, d)).select("job_index", "line_index", "text")


@query
def line_batches(spark: SparkSession, d: str) -> DataFrame:
    return lines.batches(lines.for_extraction(labelled(spark, d))).select("job_index", "batch", F.size("line_ids").alias("n_lines"), "text")


@query
def line_chunks(spark: SparkSession, d: str) -> DataFrame:
    return lines.chunks(described(spark, d))


@query
def quality_assessment(spark: SparkSession, d: str) -> DataFrame:
    rows = text.with_quality(described(spark, d), out="q").select("job_index", "q")
    f = lambda name: F.col(f"q.features.{name}").alias(name)
    return rows.select("job_index", "q.status", "q.quality_score", F.array_join("q.reasons", "; ").alias("reasons"), f("char_length"), f("non_empty_line_count"), f("section_header_like_lines"), f("skillish_line_count"), F.round("q.features.duplicate_line_ratio", 6).alias("duplicate_line_ratio"), F.round("q.features.boilerplate_line_ratio", 6).alias("boilerplate_line_ratio"))


@query
def quality_histogram(spark: SparkSession, d: str) -> DataFrame:
    return reports.quality_histogram(text.with_quality(described(spark, d)).select("quality_assessment.status"))


@query
def model_eligible(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.eligible(described(spark, d)).select("job_index")


# --- candidates and grounding ----------------------------------------------------------------------------------------------


@query
def candidate_rule_counts(spark: SparkSession, d: str) -> DataFrame:
    return candidates.rule_counts(labelled(spark, d))


@query
def mine_candidates(spark: SparkSession, d: str) -> DataFrame:
    return candidates.mine(labelled(spark, d))


@query
def rules_fired(spark: SparkSession, d: str) -> DataFrame:
    stored = stored_lines(spark, d).withColumn("boilerplate_label", F.coalesce("boilerplate_label", F.lit("uncertain")))
    return candidates.rules_fired(mentions(spark, d).where("char_start >= 0"), candidates.mine(stored)).select("mention_id", F.array_join("rules_fired", ";").alias("rules_fired"))


@query
def ground_spans(spark: SparkSession, d: str) -> DataFrame:
    asked = mentions(spark, d).select("job_index", "mention_idx", "skill_span", F.col("evidence").alias("context"), F.col("section").alias("section_hint"))
    return grounding.ground(asked, stored_lines(spark, d)).select("job_index", "mention_idx", "line_id", "char_start", "char_end", "offset_valid")


@query
def span_checks(spark: SparkSession, d: str) -> DataFrame:
    return merged(spark, d).select("mention_id", "offset_valid", "evidence_ok")


@query
def repair_offsets(spark: SparkSession, d: str) -> DataFrame:
    """Proposals by mention_idx: as stored, three characters too far, none but the evidence, and none at all."""
    m = assemble.with_lines(mentions(spark, d), stored_lines(spark, d))
    c, turn = F.col, F.pmod("mention_idx", F.lit(4))
    start = F.when(turn == 0, c("char_start") - c("line_start")).when(turn == 1, c("char_start") - c("line_start") + 3).otherwise(-1)
    end = F.when(turn < 2, start + F.length("skill_span")).otherwise(-1)
    place = grounding.repair_offset(c("source_line"), c("skill_span"), start, end, F.when(turn != 3, c("evidence")))
    return m.select("mention_id", place.alias("line_char_start"))


@query
def resolve_lines(spark: SparkSession, d: str) -> DataFrame:
    return assemble.with_lines(mentions(spark, d), stored_lines(spark, d)).select("mention_id", "line_id", "section", "boilerplate_label", "source_line")


# --- assembly ----------------------------------------------------------------------------------------------------------------


@query
def merge_stages(spark: SparkSession, d: str) -> DataFrame:
    return merged(spark, d).select("mention_id", "is_skill", "verifier_status", "verifier_confidence", "requirement_level", "requirement_status", "requirement_confidence", "hard_soft", "hardsoft_status", "hardsoft_confidence")


@query
def final_confidence(spark: SparkSession, d: str) -> DataFrame:
    return assemble.scored(merged(spark, d)).select("mention_id", "final_confidence")


@query
def legacy_merge(spark: SparkSession, d: str) -> DataFrame:
    base = mentions(spark, d).drop("verifier_status", "verifier_confidence", "final_confidence")
    return assemble.merge_stages(base, *stages(spark, d), legacy=True).select("mention_id", "is_skill", "verifier_status")


@query
def legacy_confidence(spark: SparkSession, d: str) -> DataFrame:
    """The confidence with the mining rules that support each mention."""
    stored = stored_lines(spark, d).withColumn("boilerplate_label", F.coalesce("boilerplate_label", F.lit("uncertain")))
    fired = candidates.rules_fired(mentions(spark, d).where("char_start >= 0"), candidates.mine(stored)).select("mention_id", F.size("rules_fired").alias("n"))
    m = merged(spark, d).join(fired, "mention_id", "left").withColumn("n_rules", F.coalesce("n", F.lit(0)))
    return assemble.scored(m).select("mention_id", "n_rules", "final_confidence")


@query
def needs_verifier(spark: SparkSession, d: str) -> DataFrame:
    m = assemble.with_lines(mentions(spark, d), stored_lines(spark, d))
    c = F.col
    wanted = scoring.needs_verifier(c("raw_model_confidence"), F.coalesce("hard_soft", F.lit("unknown")), F.coalesce("requirement_level", F.lit("unclear")), F.coalesce("boilerplate_label", F.lit("uncertain")))
    return m.select("mention_id", wanted.alias("needed"))


@query
def line_checks(spark: SparkSession, d: str) -> DataFrame:
    return checks.broken_lines(stored_lines(spark, d))


@query
def mention_checks(spark: SparkSession, d: str) -> DataFrame:
    return checks.broken_mentions(mentions(spark, d), table(spark, d, "preprocessed_descriptions"))


@query
def candidates_per_line(spark: SparkSession, d: str) -> DataFrame:
    return candidates.per_line(candidates.mine(labelled(spark, d))).select("job_index", "line_id", F.array_join("hints", "; ").alias("hints"))


@query
def chunk_texts(spark: SparkSession, d: str) -> DataFrame:
    return lines.chunk_texts(described(spark, d))


@query
def extract_batches_stub(spark: SparkSession, d: str) -> DataFrame:
    vocabulary = tuple(r.canonical_skill for r in table(spark, d, "skill_reference").orderBy("ref_id").toLocalIterator())
    return model_calls.extract_batches(lines.for_extraction(labelled(spark, d)), model_calls.StubBackend(vocabulary)).drop("seconds")


@query
def mention_numbers(spark: SparkSession, d: str) -> DataFrame:
    m = merged(spark, d).select("job_index", "job_key", "mention_idx", F.col("mention_id").alias("given_id"))
    return assemble.numbered(m).select("given_id", "mention_id")


@query
def stage_counters(spark: SparkSession, d: str) -> DataFrame:
    return assemble.stage_counters(merged(spark, d))


@query
def run_totals(spark: SparkSession, d: str) -> DataFrame:
    return assemble.run_totals(table(spark, d, "jobs"), mentions(spark, d))


@query
def resume_delta(spark: SparkSession, d: str) -> DataFrame:
    """Jobs that the large extractor has still to do."""
    return assemble.missing(jobs(spark, d).select("job_index"), by_extractor(spark, d)[0], ["job_index"])


@query
def retry_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the first extractor, replaced job by job by the second's where that has any."""
    a, b = by_extractor(spark, d)
    return assemble.upsert(a, b, ["job_index"]).groupBy("extractor_model").agg(F.count("*").alias("n"), F.count_distinct("job_index").alias("jobs"))


@query
def extract_stub(spark: SparkSession, d: str) -> DataFrame:
    vocabulary = tuple(r.canonical_skill for r in table(spark, d, "skill_reference").orderBy("ref_id").toLocalIterator())
    return model_calls.extract(described(spark, d), model_calls.StubBackend(vocabulary)).drop("seconds")


@query
def verify_stub(spark: SparkSession, d: str) -> DataFrame:
    m = assemble.with_lines(mentions(spark, d), stored_lines(spark, d))
    return model_calls.classify(m, model_calls.StubBackend(), "verify").drop("seconds")


@query
def requirement_stub(spark: SparkSession, d: str) -> DataFrame:
    m = assemble.with_lines(mentions(spark, d), stored_lines(spark, d))
    return model_calls.classify(m, model_calls.StubBackend(), "requirement").drop("seconds")


@query
def hardsoft_stub(spark: SparkSession, d: str) -> DataFrame:
    m = assemble.with_lines(mentions(spark, d), stored_lines(spark, d))
    return model_calls.classify(m, model_calls.StubBackend(), "hardsoft").drop("seconds")


@query
def reply_json(spark: SparkSession, d: str) -> DataFrame:
    """The JSON inside the documents' model replies."""
    replies = table(spark, d, "documents").where("kind = 'reply'")
    return replies.select("doc_id", scoring.repair_json(scoring.strip_thinking(F.col("text"))).alias("body"))


# --- ontology and titles -------------------------------------------------------------------------------------------------------


def _ontology(spark: SparkSession, d: str) -> DataFrame:
    return ontology.build_ontology(mentions(spark, d), aliases(spark, d))


@query
def canonical_keys(spark: SparkSession, d: str) -> DataFrame:
    return ontology.named(mentions(spark, d), aliases(spark, d)).select("mention_id", "canonical_key")


@query
def ontology_core(spark: SparkSession, d: str) -> DataFrame:
    return _ontology(spark, d).select("canonical_key", "job_count", "mention_count", "avg_confidence", "type")


@query
def ontology_full(spark: SparkSession, d: str) -> DataFrame:
    shown = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")
    o = _ontology(spark, d)
    return o.select("canonical_skill", "canonical_key", F.array_join("variants", "; ").alias("variants"), "type", shown("type_distribution").alias("type_distribution"), "requirement_level", shown("requirement_distribution").alias("requirement_distribution"), "job_count", "mention_count", "avg_confidence", F.get("confidence_range", F.lit(0)).alias("confidence_min"), F.get("confidence_range", F.lit(1)).alias("confidence_max"), F.array_join("common_contexts", "; ").alias("common_contexts"))


@query
def ontology_ranked(spark: SparkSession, d: str) -> DataFrame:
    return ontology.ranked(_ontology(spark, d)).select("rank", "canonical_key", "job_count", "mention_count")


@query
def ontology_csv(spark: SparkSession, d: str) -> DataFrame:
    return sinks.ontology_csv(_ontology(spark, d), "sf")


@query
def duplicate_pairs(spark: SparkSession, d: str) -> DataFrame:
    return ontology.duplicate_pairs(_ontology(spark, d))


@query
def title_skills(spark: SparkSession, d: str) -> DataFrame:
    m = mentions(spark, d)
    return titles.title_skills(m.select("job_index", "job_id", "title_raw").distinct(), m, aliases=aliases(spark, d))


def _title_table(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "title_reference").select(F.col("normalized_title").alias("raw_title"), F.concat("family", F.lit(": "), "normalized_title").alias("normalized_title"))


@query
def title_skills_mapped(spark: SparkSession, d: str) -> DataFrame:
    m = mentions(spark, d)
    flat = titles.title_skills(m.select("job_index", "job_id", "title_raw").distinct(), m, _title_table(spark, d), aliases(spark, d))
    return titles.rank_skills(flat).select("title", "canonical_key", "points", "posting_count", "rank")


@query
def title_unmapped(spark: SparkSession, d: str) -> DataFrame:
    return titles.unmapped(mentions(spark, d).select("job_index", "title_raw").distinct(), _title_table(spark, d))


# --- reports -----------------------------------------------------------------------------------------------------------------------


@query
def skill_frequency(spark: SparkSession, d: str) -> DataFrame:
    return reports.skill_frequency(mentions(spark, d))


@query
def job_skills(spark: SparkSession, d: str) -> DataFrame:
    return reports.job_skills(mentions(spark, d))


@query
def low_confidence(spark: SparkSession, d: str) -> DataFrame:
    return reports.low_confidence(mentions(spark, d)).select("mention_id", "job_id", "final_confidence", "verifier_status")


@query
def mentions_export(spark: SparkSession, d: str) -> DataFrame:
    return sinks.mentions_csv(mentions(spark, d))


@query
def extraction_summary(spark: SparkSession, d: str) -> DataFrame:
    return reports.extraction_summary(reports.mentions_per_job(table(spark, d, "jobs"), mentions(spark, d)))


@query
def mention_classes(spark: SparkSession, d: str) -> DataFrame:
    return reports.classes(reports.mentions_per_job(table(spark, d, "jobs"), mentions(spark, d)), "n", reports.MENTION_CLASSES)


@query
def confidence_histogram(spark: SparkSession, d: str) -> DataFrame:
    return reports.confidence_deciles(mentions(spark, d))


@query
def top_skills(spark: SparkSession, d: str) -> DataFrame:
    return reports.top_values(mentions(spark, d), "normalized_candidate", 30)


@query
def field_frequency(spark: SparkSession, d: str) -> DataFrame:
    return reports.field_frequency(mentions(spark, d), ["job_id", "line_id", "title_raw", "section", "normalized_candidate", "hard_soft", "requirement_level", "evidence"])


@query
def verdict_distribution(spark: SparkSession, d: str) -> DataFrame:
    return reports.distribution(mentions(spark, d), ["verifier_status", "is_skill", "hard_soft", "requirement_level", "extractor_model"])


@query
def run_compare(spark: SparkSession, d: str) -> DataFrame:
    return compared(spark, d)


@query
def run_compare_summary(spark: SparkSession, d: str) -> DataFrame:
    return reports.comparison_summary(compared(spark, d))


@query
def difference_classes(spark: SparkSession, d: str) -> DataFrame:
    return reports.classes(compared(spark, d).where("side = 'both'"), "difference", reports.DIFFERENCE_CLASSES)


@query
def largest_differences(spark: SparkSession, d: str) -> DataFrame:
    return reports.largest_differences(compared(spark, d))


@query
def zero_mention_jobs(spark: SparkSession, d: str) -> DataFrame:
    return reports.zero_jobs(reports.mentions_per_job(table(spark, d, "jobs"), mentions(spark, d)))


@query
def topk_overlap(spark: SparkSession, d: str) -> DataFrame:
    return reports.top_overlap(*two_runs(spark, d), "normalized_candidate")


@query
def hourly_calls(spark: SparkSession, d: str) -> DataFrame:
    return reports.hourly(calls(spark, d))


@query
def daily_calls(spark: SparkSession, d: str) -> DataFrame:
    return reports.daily(calls(spark, d))


@query
def role_timing(spark: SparkSession, d: str) -> DataFrame:
    return reports.role_timing(calls(spark, d))


@query
def last_day_calls(spark: SparkSession, d: str) -> DataFrame:
    return reports.call_stats(reports.last_hours(calls(spark, d)), ["role"])


@query
def last_100_calls(spark: SparkSession, d: str) -> DataFrame:
    return reports.last_rows(calls(spark, d)).select("call_id", "ts", "model")


@query
def phase_transitions(spark: SparkSession, d: str) -> DataFrame:
    return reports.transitions(calls(spark, d))


@query
def transitions_apart(spark: SparkSession, d: str) -> DataFrame:
    return reports.keep_apart(reports.transitions(calls(spark, d)), ["model", "kind"])


@query
def call_phases(spark: SparkSession, d: str) -> DataFrame:
    return reports.phases(calls(spark, d))


@query
def log_levels(spark: SparkSession, d: str) -> DataFrame:
    logs = table(spark, d, "documents").where("kind = 'log'").select(F.explode(F.split("text", "\n")).alias("value"))
    return reports.level_counts(logs)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in oracle.statements().items() if k in _QUERIES}
