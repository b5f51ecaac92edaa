"""Data-quality checks on lines and mentions: each returns the rows that break a rule, and which."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _broken(df: DataFrame, rules: dict, keep: list[str]) -> DataFrame:
    problems = F.filter(F.array(*[F.when(F.coalesce(bad, F.lit(True)), name) for name, bad in rules.items()]), lambda p: p.isNotNull())
    return df.select(*keep, F.array_join(problems, ";").alias("problems")).where("problems != ''")


def broken_lines(lines: DataFrame) -> DataFrame:
    """``line_id, problems`` of lines without id or text, or whose offsets don't span their text."""
    c = F.col
    return _broken(lines, {"no_id": c("line_id").isNull() | (c("line_id") == ""), "no_text": c("text").isNull(), "offsets": (c("char_start") < 0) | (c("char_end") - c("char_start") != F.length("text"))}, ["line_id"])


def broken_mentions(mentions: DataFrame, texts: DataFrame) -> DataFrame:
    """``mention_id, problems`` of grounded mentions whose span isn't what stands at their offsets in ``job_index, description_normalized``."""
    grounded = mentions.where("char_start >= 0").join(texts.select("job_index", "description_normalized").dropDuplicates(["job_index"]), "job_index", "left")
    c = F.col
    there = F.substr(c("description_normalized"), c("char_start") + 1, c("char_end") - c("char_start"))
    return _broken(grounded, {"no_text": c("description_normalized").isNull(), "order": c("char_end") <= c("char_start"), "beyond": c("char_end") > F.length("description_normalized"), "span": there != c("skill_span")}, ["mention_id"])
