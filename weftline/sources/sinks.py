"""Sinks: mention tables and reports as JSON lines, CSV or Parquet folders, and single files where a tool wants one."""

from __future__ import annotations

import json
import logging
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG = logging.getLogger("weftline")

# The columns of the mention exports.
MENTION_JSON = "run_id job_id line_id mention_id title_raw section source_line skill_span normalized_candidate hard_soft requirement_level char_start char_end evidence raw_model_confidence final_confidence extractor_model verifier_status requirement_status hardsoft_status rules_fired is_skill pipeline_audit".split()
MENTION_CSV = "run_id job_id line_id mention_id title_raw section source_line skill_span normalized_candidate hard_soft requirement_level char_start char_end evidence raw_model_confidence final_confidence extractor_model verifier_status verifier_model requirement_status requirement_model hardsoft_status hardsoft_model rules_fired is_skill pipeline_audit".split()
ONTOLOGY_CSV = "canonical_skill canonical_key variants type type_distribution requirement_level requirement_distribution job_count mention_count avg_confidence confidence_min confidence_max common_contexts run_id".split()


def artifact(folder: str, kind: str, run_id: str, ext: str) -> str:
    return f"{folder}/weftline_{kind}_run_{run_id}.{ext}"


def _pick(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[F.col(n) if n in df.columns else F.lit(None).cast("string").alias(n) for n in names])


def mentions_json(mentions: DataFrame) -> DataFrame:
    """The JSON lines export; absent columns are null."""
    return _pick(mentions, MENTION_JSON)


def mentions_csv(mentions: DataFrame) -> DataFrame:
    """The CSV export, all text: null is '', rules joined by ';', the audit as JSON."""
    df = _pick(mentions, MENTION_CSV)
    types = dict(df.dtypes)

    def text(n: str) -> Column:
        if types[n].startswith("array"):
            return F.array_join(n, ";")
        if types[n].startswith(("struct", "map")):
            return F.to_json(n)
        return F.col(n).cast("string")

    return df.select(*[F.coalesce(text(n), F.lit("")).alias(n) for n in MENTION_CSV])


def ontology_csv(ontology: DataFrame, run_id: str, legacy_format: bool = False) -> DataFrame:
    """Lists joined by '; ', distributions as JSON; a confidence of 0 is kept, or '' in the legacy format."""
    low, high = F.get("confidence_range", F.lit(0)), F.get("confidence_range", F.lit(1))
    shown = lambda c: F.coalesce(F.when(c == 0, F.lit("")).otherwise(c.cast("string")) if legacy_format else c.cast("string"), F.lit(""))
    df = ontology.withColumns({"variants": F.array_join("variants", "; "), "common_contexts": F.array_join("common_contexts", "; "), "type_distribution": F.to_json("type_distribution"), "requirement_distribution": F.to_json("requirement_distribution"), "confidence_min": shown(low), "confidence_max": shown(high), "run_id": F.lit(run_id)})
    return df.select(*ONTOLOGY_CSV)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="", nullValue="")


def write_json_array(df: DataFrame, path: str, pretty: bool = False) -> None:
    """One JSON array in one file, streamed partition by partition; the driver holds one partition at a time."""
    Path(os.path.dirname(path) or ".").mkdir(parents=True, exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("[")
        for i, r in enumerate(df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).toLocalIterator()):
            f.write(("," if i else "") + "\n" + (json.dumps(json.loads(r.j), ensure_ascii=False, indent=2) if pretty else r.j))
        f.write("\n]\n")


def write_counts(df: DataFrame, path: str, legacy_format: bool = False) -> None:
    """A two-column report of few rows as one CSV file; quoted, or bare in the legacy format."""
    import csv

    Path(os.path.dirname(path) or ".").mkdir(parents=True, exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        if legacy_format:
            f.write("\n".join([",".join(df.columns), *(",".join(map(str, r)) for r in df.toLocalIterator())]))
        else:
            w = csv.writer(f)
            w.writerow(df.columns)
            w.writerows(tuple(r) for r in df.toLocalIterator())


def summary_lines(summary: dict) -> list[str]:
    """A run's summary as lines of a log."""
    out = [f"run {summary['run_id']}, version {summary['version']}, {summary['seconds']} s", "totals: " + ", ".join(f"{k} {v}" for k, v in summary["totals"].items())]
    out += [f"stage {s['stage']}: {s['records']} of {s['expected']} ({s['percent']} %), {s['errors']} errors, {s['seconds']} s" for s in summary["stages"]]
    return out + [f"model {c['model']}: {c['calls']} calls, {c['seconds'] or 0:.1f} s" for c in summary["calls"]]


def write_summary(summary: dict, path: str) -> None:
    """The summary as one JSON file, and as a block in the log."""
    Path(os.path.dirname(path) or ".").mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(summary, default=str, indent=2), encoding="utf-8")
    for line in summary_lines(summary):
        LOG.info(line)


def nested_mentions(jobs: DataFrame, mentions: DataFrame) -> DataFrame:
    """Jobs with ``skill_mentions``, an array by mention_idx; a job's mentions are bounded by its text."""
    own = F.array_sort(F.collect_list(F.struct("mention_idx", *[c for c in mentions.columns if c not in ("job_index", "mention_idx")])))
    grouped = mentions.groupBy("job_index").agg(own.alias("skill_mentions"))
    return jobs.drop("skill_mentions").join(grouped, "job_index", "left")


def overlay(original: DataFrame, augmentation: DataFrame, key: str = "job_index") -> DataFrame:
    """``original`` with the columns of ``augmentation``, which win where both have one."""
    new = [c for c in augmentation.columns if c != key]
    return original.drop(*[c for c in new if c in original.columns]).join(augmentation, key, "left")
