"""Command line: ``python -m weftline.plans.cli run|ontology|titles|status|archive …``."""

from __future__ import annotations

import argparse
import json
import os
import time
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from weftline.operators import lines, model_calls, ontology, titles
from weftline.plans.pipeline import Config, run_pipeline
from weftline.plans.runs import Store
from weftline.sources import readers, sinks


PREFIX = "WEFTLINE_"


def eta(done: int, total: int, seconds: float) -> str:
    """Time left, from what has been done so far."""
    if not done:
        return "unknown"
    left = int(seconds / done * (total - done))
    return f"{left // 3600}h{left % 3600 // 60:02d}m" if left >= 3600 else f"{left // 60}m{left % 60:02d}s"


def environment(env: Mapping[str, str], dotenv: str = ".env") -> dict[str, str]:
    """Settings by lower-cased name: WEFTLINE_* of the environment before those of a .env file."""
    path = Path(dotenv)
    rows = path.read_text(encoding="utf-8").splitlines() if path.is_file() else []
    pairs = [(k.strip().removeprefix("export ").strip(), v.strip().strip("\"'")) for k, sep, v in (r.partition("=") for r in rows if not r.lstrip().startswith("#")) if sep]
    return {k.removeprefix(PREFIX).lower(): v for k, v in {**dict(pairs), **env}.items() if k.startswith(PREFIX)}


def parser(settings: Mapping[str, str] | None = None) -> argparse.ArgumentParser:
    """The command line; ``settings`` give defaults of the run command, which its own arguments override."""
    given = settings or {}
    p = argparse.ArgumentParser(prog="weftline")
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="all stages on a file of jobs")
    run.add_argument("-i", "--input", required=True)
    run.add_argument("-o", "--output", required=True)
    run.add_argument("--run-id", default=time.strftime("%Y%m%d_%H%M%S"))
    run.add_argument("--sample", type=int, help="the first jobs only")
    run.add_argument("--endpoint", action="append", default=[x for x in given.get("endpoints", "").split(",") if x])
    run.add_argument("--kind", choices=("openai", "ollama"), default=given.get("kind", "openai"))
    run.add_argument("--key", default=given.get("key"), help="bearer token of the endpoints")
    run.add_argument("--extractor-model", default=given.get("extractor_model", "stub"))
    run.add_argument("--classifier-model", default=given.get("classifier_model", "stub"))
    run.add_argument("--timeout", type=float, default=float(given.get("timeout", 300)))
    run.add_argument("--vocabulary", default=given.get("vocabulary"), help="terms of the offline stub, one a line")
    for switch in ("verifier", "requirement", "hardsoft"):
        run.add_argument(f"--no-{switch}", action="store_true")
    run.add_argument("--aliases", default=given.get("aliases"), help="a table alias, target (CSV or Parquet)")
    run.add_argument("--skip-models", action="store_true")
    run.add_argument("--no-reports", action="store_true")
    run.add_argument("--rerun-from", choices=("extract", "verify", "requirement", "hardsoft"))
    run.add_argument("--retry-errors", action="store_true")
    for name in ("ontology", "titles"):
        s = sub.add_parser(name, help=f"{name} of a mention table")
        s.add_argument("mentions")
        s.add_argument("-o", "--output", required=True)
        s.add_argument("--aliases", help="a table alias, target (CSV or Parquet)")
    sub.choices["titles"].add_argument("--title-list")
    sub.choices["titles"].add_argument("--confidence-floor", type=float, default=titles.CONFIDENCE_FLOOR)
    status = sub.add_parser("status")
    status.add_argument("folder")
    status.add_argument("run_id")
    shown = sub.add_parser("lines", help="one job's lines with their labels")
    shown.add_argument("-i", "--input", required=True)
    shown.add_argument("job_index", type=int)
    archive = sub.add_parser("archive")
    archive.add_argument("folder")
    archive.add_argument("target")
    archive.add_argument("--keep", type=int, default=2)
    archive.add_argument("--protect", action="append", default=[])
    archive.add_argument("--yes", action="store_true", help="move; without it only say what would be moved")
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser(environment(os.environ)).parse_args(argv)
    spark = SparkSession.builder.appName("weftline").getOrCreate()
    if a.command == "run":
        jobs = (readers.read_job_lines if a.input.endswith(".jsonl") else readers.read_jobs)(spark, a.input)
        jobs = jobs.select("job_index", "id", F.col("title").alias("title_raw"), F.col("description").alias("description_raw"))
        if a.sample is not None:
            jobs = jobs.where(F.col("job_index") < a.sample)
        words = tuple(x.strip() for x in open(a.vocabulary, encoding="utf-8") if x.strip()) if a.vocabulary else ()
        backend = lambda model: model_calls.HttpBackend(tuple(a.endpoint), model, a.kind, timeout=a.timeout, key=a.key) if a.endpoint else model_calls.StubBackend(words)
        small = backend(a.classifier_model)
        cfg = Config(backend(a.extractor_model), small, small, small, endpoints=max(1, len(a.endpoint)), enable_verifier=not a.no_verifier, enable_requirement=not a.no_requirement, enable_hardsoft=not a.no_hardsoft, skip_models=a.skip_models, aliases=readers.read_aliases(spark, a.aliases) if a.aliases else None)
        print(json.dumps(run_pipeline(spark, jobs, cfg, a.output, a.run_id, a.rerun_from, a.retry_errors, not a.no_reports), default=str))
    elif a.command == "ontology":
        onto = ontology.build_ontology(spark.read.parquet(a.mentions), readers.read_aliases(spark, a.aliases) if a.aliases else None)
        onto.write.mode("overwrite").parquet(a.output)
        sinks.write_csv(sinks.ontology_csv(spark.read.parquet(a.output), readers.run_id_of(a.mentions)), f"{a.output}.csv")
    elif a.command == "titles":
        mentions = spark.read.parquet(a.mentions)
        table = readers.read_titles(spark, a.title_list) if a.title_list else None
        titles.title_skills(mentions.select("job_index", "job_id", "title_raw").distinct(), mentions, table, readers.read_aliases(spark, a.aliases) if a.aliases else None, confidence_floor=a.confidence_floor).write.mode("overwrite").parquet(a.output)
    elif a.command == "status":
        rows = Store(spark, f"{a.folder}/stages").status(a.run_id)
        print(json.dumps([r | {"left": eta(r["records"], max(r["expected"], r["records"]), r["seconds"])} for r in rows]))
    elif a.command == "lines":
        jobs = (readers.read_job_lines if a.input.endswith(".jsonl") else readers.read_jobs)(spark, a.input)
        labelled = lines.label(lines.segment(lines.describe(jobs)))
        for r in lines.inspect(labelled, a.job_index).toLocalIterator():
            print(json.dumps(r.asDict(), ensure_ascii=False))
    else:
        print(json.dumps(Store(spark, f"{a.folder}/stages").archive(a.target, a.keep, tuple(a.protect), not a.yes)))


if __name__ == "__main__":
    main()
