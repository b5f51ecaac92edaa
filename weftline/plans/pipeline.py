"""The whole run: describe, segment, extract, verify, classify, assemble, aggregate, report."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline import __version__
from weftline.functions.text import with_quality
from weftline.operators import assemble, grounding, lines, model_calls, ontology, reports, titles
from weftline.plans.runs import Store, content_hash, fingerprints
from weftline.sources import sinks


@dataclass
class Config:
    extractor: object = field(default_factory=model_calls.StubBackend)
    verifier: object = field(default_factory=model_calls.StubBackend)
    requirement: object = field(default_factory=model_calls.StubBackend)
    hardsoft: object = field(default_factory=model_calls.StubBackend)
    fallback: object | None = None
    endpoints: int = 1
    enable_verifier: bool = True
    enable_requirement: bool = True
    enable_hardsoft: bool = True
    skip_models: bool = False
    complete_min_score: float = 0.45
    confidence_floor: float = 0.6
    min_mention_count: int = 1
    strict_fingerprint: bool = True
    aliases: dict | DataFrame | None = None


def eligible(described: DataFrame, skip_models: bool = False) -> DataFrame:
    """Jobs a model should see: all, less truncated and malformed ones of under 40 characters; none where models are skipped."""
    assessed = with_quality(described, out="_quality")
    poor = F.col("_quality.status").isin("truncated_or_broken", "malformed") & (F.length("description_normalized") < 40)
    return assessed.where(~poor & ~F.lit(skip_models)).drop("_quality")


def stage_parts(cfg: Config) -> dict[str, dict]:
    """What each stage's results depend on, for its fingerprint."""
    backends = {"extract": cfg.extractor, "verify": cfg.verifier, "requirement": cfg.requirement, "hardsoft": cfg.hardsoft}
    out = {s: {"model": b.model, "backend": type(b).__name__, "prompts": [model_calls.SYSTEMS[s], model_calls.PROMPTS[s]], "settings": {"thinking": getattr(b, "thinking", False)}} for s, b in backends.items()}
    out["extract"]["settings"]["fallback"] = cfg.fallback.model if cfg.fallback else None
    return out


def run_pipeline(spark: SparkSession, jobs: DataFrame, cfg: Config, folder: str, run_id: str, rerun_from: str | None = None, retry_errors: bool = False, write_reports: bool = True) -> dict:
    """Runs all stages on ``job_index, id`` and text columns; returns the paths and totals, also written as a summary file. Finished stages are reused."""
    began, started, store = time.time(), time.strftime("%Y-%m-%dT%H:%M:%S"), Store(spark, f"{folder}/stages")
    if rerun_from:
        store.rerun_from(rerun_from, run_id)
    described = lines.describe(jobs)
    labelled = lines.label(lines.segment(described))
    seen = eligible(described, cfg.skip_models).select("job_index", "description_raw", "description_normalized")
    prints = fingerprints(stage_parts(cfg), __version__, content_hash(seen, ["job_index", "description_raw"]) if cfg.strict_fingerprint else "")
    extract = lambda todo: model_calls.extract(todo, cfg.extractor, cfg.fallback, cfg.endpoints)
    raw = store.load_or_run("extract", run_id, prints["extract"], seen, ["job_index"], extract)
    broken = raw.where(F.col("error").isNotNull()).select("job_index").distinct()
    if retry_errors and not broken.isEmpty():
        raw = store.replace("extract", run_id, prints["extract"], extract(seen.join(broken, "job_index", "left_semi")), ["job_index"])
    found = raw.where("mention_idx >= 0")
    grounded = grounding.ground(found, labelled)
    mentions = found.drop("error", "seconds").join(grounded.drop("section"), ["job_index", "mention_idx"]).withColumn("is_skill", F.lit(True))
    placed = assemble.with_lines(mentions.drop("boilerplate_label"), labelled)
    asked = placed.select("job_index", "mention_idx", "skill_span", "section", "source_line")
    keys = ["job_index", "mention_idx"]

    def classified(stage: str, enabled: bool, backend, items: DataFrame, value: str, kind: str) -> DataFrame:
        if not enabled:
            return spark.createDataFrame([], model_calls.VERDICT.format(value=value, kind=kind))
        return store.load_or_run(stage, run_id, prints[stage], items, keys, lambda todo: model_calls.classify(todo, backend, stage, cfg.endpoints))

    verdicts = classified("verify", cfg.enable_verifier, cfg.verifier, asked, "is_skill", "boolean")
    skills = asked.join(verdicts.where(F.col("status").isin("rejected", "parse_failed", "error")), keys, "left_anti")
    required = classified("requirement", cfg.enable_requirement, cfg.requirement, skills, "requirement_level", "string")
    kinds = classified("hardsoft", cfg.enable_hardsoft, cfg.hardsoft, skills, "hard_soft", "string")
    merged = assemble.merge_stages(placed, verdicts, required, kinds).withColumns({"n_rules": F.lit(0), "evidence_ok": grounding.evidence_ok(F.col("source_line"), F.col("evidence")), "rules_fired": F.array().cast("array<string>"), "run_id": F.lit(run_id)})
    head = described.select("job_index", "job_key", F.col("title").alias("title_raw")).join(jobs.select("job_index", F.col("id").cast("string").alias("job_id")), "job_index")
    final = assemble.numbered(assemble.audit(assemble.scored(merged)).join(head, "job_index"))
    path = f"{folder}/mentions/run_id={run_id}"
    final.drop("run_id").write.mode("overwrite").parquet(path)
    final = spark.read.parquet(path).withColumn("run_id", F.lit(run_id))
    assessed = with_quality(described, complete_min_score=cfg.complete_min_score)
    failed = raw.where(F.col("error").isNotNull()).groupBy("job_index").agg(F.min("error").alias("error"))
    models = {s: p["model"] for s, p in stage_parts(cfg).items()}
    assessed = assemble.with_metadata(assessed.join(failed, "job_index", "left"), run_id, __version__, models, started, time.strftime("%Y-%m-%dT%H:%M:%S")).drop("title", "error")
    paths = {"mentions": path}
    if write_reports:
        onto = ontology.build_ontology(final, cfg.aliases, cfg.min_mention_count)
        kinds_of = {"augmented": "jsonl", "mentions_jsonl": "jsonl", "mentions_csv": "csv", "ontology": "parquet", "ontology_json": "jsonl", "ontology_csv": "csv", "duplicates": "json", "title_skills": "parquet", "title_skills_json": "jsonl", "quality": "csv", "frequency": "csv", "low_confidence": "json"}
        paths |= {k: sinks.artifact(folder, k, run_id, e) for k, e in kinds_of.items()}
        onto.write.mode("overwrite").parquet(paths["ontology"])
        onto = spark.read.parquet(paths["ontology"])
        sinks.write_json_lines(sinks.nested_mentions(sinks.overlay(jobs, assessed), final), paths["augmented"])
        sinks.write_json_lines(sinks.mentions_json(final), paths["mentions_jsonl"])
        sinks.write_csv(sinks.mentions_csv(final), paths["mentions_csv"])
        sinks.write_json_lines(onto.orderBy(F.desc("job_count"), F.desc("mention_count"), "first_at").drop("first_at"), paths["ontology_json"])
        sinks.write_csv(sinks.ontology_csv(onto, run_id), paths["ontology_csv"])
        sinks.write_json_lines(ontology.by_jobs(ontology.duplicate_pairs(onto)), paths["duplicates"])
        titles.title_skills(head, final, aliases=cfg.aliases, confidence_floor=cfg.confidence_floor).write.mode("overwrite").parquet(paths["title_skills"])
        sinks.write_json_lines(titles.nested(spark.read.parquet(paths["title_skills"])).orderBy(F.desc("job_count"), "title"), paths["title_skills_json"])
        sinks.write_csv(reports.quality_histogram(assessed.select("quality_assessment.status")), paths["quality"])
        sinks.write_csv(reports.skill_frequency(final), paths["frequency"])
        sinks.write_json_lines(reports.low_confidence(final), paths["low_confidence"])
    totals = assemble.run_totals(jobs, final, raw.where(F.col("error").isNotNull())).first().asDict()
    ran = [df for df, on in ((raw, True), (verdicts, cfg.enable_verifier), (required, cfg.enable_requirement), (kinds, cfg.enable_hardsoft)) if on]
    timing = [r.asDict() for r in model_calls.call_timing(*ran).orderBy("model").toLocalIterator()]
    summary = {"run_id": run_id, "version": __version__, "started": started, "paths": paths, "totals": totals, "stages": store.status(run_id), "calls": timing, "seconds": round(time.time() - began, 1)}
    sinks.write_summary(summary, sinks.artifact(folder, "summary", run_id, "json"))
    return summary
