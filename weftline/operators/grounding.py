"""Spans named by a model are bound to the lines they stand on.

Everything is a join and two aggregates: mentions meet the lines of their job that hold their span, each mention's places are
put in its order of preference, and a fold over the mentions of one span takes for each the first place that none before took.
A group is the mentions of one span in one job, bounded by the job's own text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import starts, strip

# Orders of preference: the line that holds the mention's context, a line of the hinted section, any other.
BY_CONTEXT, BY_SECTION, BY_TEXT = 0, 1, 2


def places(mentions: DataFrame, lines: DataFrame) -> DataFrame:
    """``job_index, mention_idx, span, options``: the places of each mention's span, the preferred ones first.

    A span that stands nowhere on a line as it is may stand there in other letter case. Of a line with the context only the first place is preferred.
    """
    text_or = lambda c, other: F.when(strip(F.col(c)) != "", F.col(c)).otherwise(F.lit(other))
    asked = mentions.where(strip(F.coalesce("skill_span", F.lit(""))) != "").select("job_index", "mention_idx", F.col("skill_span").alias("span"), text_or("context", None).alias("context"), F.lower(text_or("section_hint", "General")).alias("hint"))
    shown = lines.select("job_index", "line_index", "line_id", "section", "boilerplate_label", "text", "char_start")
    held = asked.join(shown, "job_index").where(F.contains(F.lower("text"), F.lower("span")) | F.contains("text", F.col("span")))
    exact = F.contains("text", F.col("span"))
    at = F.when(exact, starts(F.col("text"), F.col("span"))).otherwise(starts(F.lower("text"), F.lower("span")))
    section = F.when(F.lower(F.coalesce("section", F.lit(""))) == F.col("hint"), BY_SECTION).otherwise(BY_TEXT)
    # a line with the context gives its first place twice, once in front of all others
    ranked = F.concat(F.when(exact & F.contains("text", F.col("context")), F.array(F.struct(F.lit(BY_CONTEXT).alias("rank"), F.get(at, F.lit(0)).alias("at")))).otherwise(F.array().cast("array<struct<rank: int, at: int>>")), F.transform(at, lambda p: F.struct(section.alias("rank"), p.alias("at"))))
    each = held.select("job_index", "mention_idx", "span", "line_index", "line_id", "section", "boilerplate_label", "char_start", "text", F.explode(ranked).alias("r"))
    option = F.struct(F.col("r.rank").alias("rank"), "line_index", F.col("r.at").alias("at"), "line_id", "section", "boilerplate_label", "char_start", (F.substr("text", F.col("r.at") + 1, F.length("span")) == F.col("span")).alias("offset_valid"))
    return each.groupBy("job_index", "mention_idx", "span").agg(F.array_sort(F.collect_set(option)).alias("options"))


def ground(mentions: DataFrame, lines: DataFrame) -> DataFrame:
    """``job_index, mention_idx, line_id, section, boilerplate_label, line_char_start, line_char_end, char_start, char_end, offset_valid``.

    For ``job_index, mention_idx, skill_span, context, section_hint``. Mentions without a place are left out; where all places are
    taken, the one preferred by section and order is used again.
    """
    turn = F.array_sort(F.collect_list(F.struct("mention_idx", "options")))
    queue = places(mentions, lines).groupBy("job_index", "span").agg(turn.alias("turns"))
    place = lambda o: F.struct(o["line_id"].alias("line_id"), o["at"].alias("at"))
    one = "struct<mention_idx: int, o: struct<rank: int, line_index: int, at: int, line_id: string, section: string, boilerplate_label: string, char_start: int, offset_valid: boolean>>"
    start = F.struct(F.array().cast("array<struct<line_id: string, at: int>>").alias("used"), F.array().cast(f"array<{one}>").alias("out"))

    def take(acc: Column, x: Column) -> Column:
        free = F.get(F.filter(x["options"], lambda o: ~F.array_contains(acc["used"], place(o))), F.lit(0))
        again = F.get(F.filter(x["options"], lambda o: o["rank"] != BY_CONTEXT), F.lit(0))
        o = F.coalesce(free, again)
        return F.struct(F.array_append(acc["used"], place(o)).alias("used"), F.array_append(acc["out"], F.struct(x["mention_idx"].alias("mention_idx"), o.alias("o")).cast(one)).alias("out"))

    rows = queue.select("job_index", "span", F.explode(F.aggregate("turns", start, take, lambda acc: acc["out"])).alias("t"))
    end = F.col("t.o.at") + F.length("span")
    return rows.select("job_index", "t.mention_idx", "t.o.line_id", "t.o.section", "t.o.boilerplate_label", F.col("t.o.at").alias("line_char_start"), end.alias("line_char_end"), (F.col("t.o.char_start") + F.col("t.o.at")).alias("char_start"), (F.col("t.o.char_start") + end).alias("char_end"), "t.o.offset_valid")


def repair_offset(text: Column, span: Column, start: Column, end: Column, evidence: Column) -> Column:
    """Where a span stands on its line: as proposed if that is right, else nearest to the proposal, else to the evidence, else first; null if nowhere."""
    right = (start >= 0) & (start < end) & (end <= F.length(text)) & (F.substr(text, start + 1, end - start) == span)
    found = starts(text, span)
    hint = F.when(start >= 0, start).otherwise(F.when(F.coalesce(F.trim(evidence), F.lit("")) != "", F.nullif(F.instr(text, F.trim(evidence)) - 1, F.lit(-1))))
    nearest = F.array_min(F.transform(found, lambda p: F.struct(F.abs(p - F.coalesce(hint, F.lit(0))).alias("d"), p.alias("p"))))["p"]
    return F.when(F.coalesce(right, F.lit(False)), start).otherwise(nearest)


def offset_valid(text: Column, span: Column, line_start: Column, start: Column) -> Column:
    return F.coalesce((start >= 0) & (F.substr(text, start - line_start + 1, F.length(span)) == span), F.lit(False))


def evidence_ok(text: Column, evidence: Column) -> Column:
    return F.coalesce((evidence != "") & text.contains(evidence), F.lit(False))
