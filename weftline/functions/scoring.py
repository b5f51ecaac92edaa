"""Column expressions over mentions: confidence, canonical keys, tolerant JSON; and fingerprints on the driver."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import half_up, strip

# Boosts of sections, penalties of labels.
SECTION_BOOST = {"requirements": 0.06, "qualifications": 0.05, "preferred": 0.03, "education": 0.03, "responsibilities": 0.02}
LABEL_PENALTY = {"likely_legal": 0.14, "likely_benefits": 0.14, "likely_marketing": 0.14, "likely_boilerplate": 0.14, "uncertain": 0.04}
# Weights and costs of the confidence.
DEFAULT_RAW = 0.7
RAW_WITH_VERIFIER, VERIFIER = 0.45, 0.55
SCORE_WITH_CLASSIFIERS, CLASSIFIERS = 0.7, 0.3
VERIFIER_COST = {"parse_failed": 0.18, "error": 0.12}
CLASSIFIER_COST = {"parse_failed": 0.08, "error": 0.06}
RULE_WORTH, RULES_AT_MOST = 0.025, 0.1
WRONG_OFFSET, WRONG_EVIDENCE = 0.12, 0.06
# Words at the end of a name that say nothing about it, and those that only say what kind of thing it is.
NOISE_SUFFIX = r"(?iU)\s+(skills?|proficiency|expertise|knowledge|experience|abilities|ability)$"
GENERIC_SUFFIX = r"(?iU)\s+(programming|language|framework|platform|tools?|software|technologies|technology|development|applications?)$"
# Common short forms and their keys; a longer table is a parameter wherever keys are made.
ALIASES = {
    "js": "javascript",
    "ts": "typescript",
    "k8s": "kubernetes",
    "ml": "machine learning",
    "dl": "deep learning",
    "nlp": "natural language processing",
    "ai": "artificial intelligence",
    "ci/cd": "continuous integration/continuous deployment",
    "cicd": "continuous integration/continuous deployment",
    "qa": "quality assurance",
    "gcp": "google cloud platform",
    "google cloud platform": "google cloud",
    "aws": "amazon web services",
    "ux": "user experience",
    "ui": "user interface",
    "swe": "software engineer",
    "sde": "software engineer",
    "ms excel": "excel",
    "microsoft excel": "excel",
    "ms word": "word",
    "ms teams": "teams",
    "microsoft .net": "net",
    "net": "net",
}


def final_confidence(
    raw: Column,
    verifier_status: Column,
    verifier_confidence: Column,
    requirement_status: Column,
    requirement_confidence: Column,
    hardsoft_status: Column,
    hardsoft_confidence: Column,
    section: Column,
    label: Column,
    n_rules: Column,
    offset_valid: Column,
    evidence_ok: Column,
) -> Column:
    """Several signals in one confidence of 0 to 1, four digits. Null flags count as false, a null raw confidence as 0.7."""
    def of(key: Column, table: dict[str, float]) -> Column:
        out = F.lit(0.0)
        for k, v in table.items():
            out = F.when(key == k, v).otherwise(out)
        return out

    s = F.coalesce(raw, F.lit(DEFAULT_RAW))
    judged = verifier_status.isin("accepted", "rejected") & verifier_confidence.isNotNull()
    s = F.when(verifier_status.isin(*VERIFIER_COST), s - of(verifier_status, VERIFIER_COST)).when(judged, RAW_WITH_VERIFIER * s + VERIFIER * verifier_confidence).otherwise(s)
    classifiers = ((requirement_status, requirement_confidence), (hardsoft_status, hardsoft_confidence))
    given = [F.when(status.isin("accepted", "completed"), confidence) for status, confidence in classifiers]
    n = sum((F.when(g.isNotNull(), 1).otherwise(0) for g in given), F.lit(0))
    mean = sum((F.coalesce(g, F.lit(0.0)) for g in given), F.lit(0.0)) / F.greatest(n, F.lit(1))
    s = F.when(n > 0, SCORE_WITH_CLASSIFIERS * s + CLASSIFIERS * mean).otherwise(s)
    for status, _ in classifiers:
        s = s - of(status, CLASSIFIER_COST)
    s = s + of(section, SECTION_BOOST) + F.least(F.lit(RULES_AT_MOST), n_rules * RULE_WORTH) - of(label, LABEL_PENALTY)
    s = s - F.when(F.coalesce(offset_valid, F.lit(False)), 0.0).otherwise(WRONG_OFFSET) - F.when(F.coalesce(evidence_ok, F.lit(False)), 0.0).otherwise(WRONG_EVIDENCE)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), half_up(s)))


def needs_verifier(raw: Column, hard_soft: Column, requirement: Column, label: Column, low_below: float = 0.75, unknown: bool = True, unclear: bool = True, uncertain: bool = True) -> Column:
    """Whether a mention should be verified, where verification is conditional."""
    return (raw < low_below) | (F.lit(unknown) & (hard_soft == "unknown")) | (F.lit(unclear) & (requirement == "unclear")) | (F.lit(uncertain) & (label == "uncertain"))


def with_nfkc(df: DataFrame, column: str, out: str) -> DataFrame:
    """``df`` with the NFKC form of ``column``; only rows with non-ASCII values leave the JVM, in Arrow batches."""
    ascii_ = F.coalesce(~F.col(column).rlike(r"[^\x00-\x7F]"), F.lit(True))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b[out] = b[out].str.normalize("NFKC")
            yield b

    plain = df.where(ascii_).withColumn(out, F.col(column))
    other = df.where(~ascii_).withColumn(out, F.col(column))
    return plain.unionByName(other.mapInPandas(run, other.schema))


def canonical_base(nfkc: Column) -> Column:
    """A folded name without one trailing noise word and edge signs; the alias lookup follows."""
    s = F.regexp_replace(F.lower(strip(nfkc)), r"(?U)\s+", " ")
    return F.btrim(F.regexp_replace(s, NOISE_SUFFIX, ""), F.lit(" .,;:-/"))


def with_canonical(df: DataFrame, column: str, out: str = "canonical_key", aliases: dict[str, str] | DataFrame | None = None) -> DataFrame:
    """``df`` with the canonical key of ``column``: one alias hop, tried on the key and then on the key without a generic suffix.

    ``aliases``: a small dict, or a DataFrame ``alias, target`` of any size (the join adapts to it); ALIASES if none is given.
    """
    base = with_nfkc(df, column, "_nfkc").withColumn("_base", canonical_base(F.col("_nfkc"))).drop("_nfkc")
    stem = F.regexp_replace("_base", GENERIC_SUFFIX, "")
    if isinstance(aliases, DataFrame):
        table = aliases.groupBy(F.col("alias").alias("_alias")).agg(F.min("target").alias("_target"))
        first = base.withColumn("_stem", stem).join(table, F.col("_base") == F.col("_alias"), "left").withColumnRenamed("_target", "_exact").drop("_alias")
        both = first.join(table, (F.col("_stem") == F.col("_alias")) & (F.col("_stem") != F.col("_base")), "left").drop("_alias")
        return both.withColumn(out, F.coalesce("_exact", "_target", "_base")).drop("_exact", "_target", "_base", "_stem")
    table = aliases if aliases is not None else ALIASES
    if not table:
        return base.withColumnRenamed("_base", out)
    lookup = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return base.withColumn(out, F.coalesce(F.try_element_at(lookup, F.col("_base")), F.when(stem != F.col("_base"), F.try_element_at(lookup, stem)), F.col("_base"))).drop("_base")


def display_name(canon: Column, variants: Column) -> Column:
    """Of the sorted variants the first that is the key with a capital, else the first; the key if there are none."""
    ordered = F.array_sort(variants)
    capital = F.filter(ordered, lambda v: v.rlike(r"^\p{Lu}") & (F.lower(v) == canon))
    return F.coalesce(F.get(capital, F.lit(0)), F.get(ordered, F.lit(0)), canon)


def strip_thinking(reply: Column) -> Column:
    """A model reply without leading think blocks."""
    return F.regexp_replace(reply, r"(?is)^(\s*<think\b[^>]*>.*?</think>\s*)+", "")


def repair_json(reply: Column) -> Column:
    """The JSON inside a reply: out of a code fence, cut to the outermost brackets, trailing commas dropped."""
    t = strip(reply)
    fenced = F.regexp_extract(t, r"(?is)```(?:json)?\s*(.*?)\s*```", 1)
    t = F.when(fenced != "", fenced).otherwise(t)
    outer = F.regexp_extract(t, r"(?s)[\[{].*[\]}]", 0)
    t = F.when(outer != "", outer).otherwise(t)
    return F.regexp_replace(t, r",\s*([\]}])", "$1")


def fingerprint(stage: str, model: str, backend: str, prompts: list[str], upstream: str | None = None, version: str = "", settings: dict | None = None) -> str:
    """Sixteen hex digits that change with anything that changes a stage's result."""
    parts = [f"stage={stage}\n", f"model={model}\n", f"backend={backend}\n", f"version={version}\n", *prompts]
    if upstream:
        parts.append(f"upstream={upstream}\n")
    parts += [f"{k}={json.dumps(v, ensure_ascii=False, sort_keys=True)}\n" for k, v in sorted((settings or {}).items())]
    return hashlib.sha256("".join(parts).encode()).hexdigest()[:16]
