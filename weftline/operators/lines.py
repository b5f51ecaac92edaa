"""From jobs to descriptions, labelled lines and batches of lines."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions import text as T
from weftline.session import spread

_SENTENCE_END = re.compile(r"[.!?;\n]+\s+")
# The size of a retry unit, and how far from the middle a text may be cut at a space.
CHUNK_CHARS, CHUNK_LINES, NEAR = 5000, 24, 400


def current_jobs(jobs: DataFrame) -> DataFrame:
    """The latest crawl of each posting; later rows by the remaining columns where ingested_at ties."""
    latest = Window.partitionBy("job_index").orderBy(F.desc_nulls_last("ingested_at"), F.desc_nulls_last("description_raw"), F.desc_nulls_last("job_description"), F.desc_nulls_last("title_raw"), F.desc_nulls_last("job_title"))
    return spread(jobs, "job_index").withColumn("_n", F.row_number().over(latest)).where("_n = 1").drop("_n")


def describe(jobs: DataFrame, split: bool = True) -> DataFrame:
    """``job_index, job_key, title, description_raw, description_normalized`` of each job row; '' where a job has none."""
    types = dict(jobs.dtypes)
    raw = T.first_text(jobs.columns, types, T.DESCRIPTION_KEYS)
    title = T.first_text(jobs.columns, types, T.TITLE_KEYS)
    named = T.once(jobs.select("job_index", T.job_key(F.col("id").cast("string"), F.col("job_index")).alias("job_key"), title.alias("title"), raw.alias("_raw")), description_raw=F.col("_raw")).drop("_raw")
    normalized = T.normalize_text(F.col("description_raw"))
    return T.once(named, description_normalized=T.split_headings(normalized) if split else normalized)


def runs_of(items: Column, heads: Column, make) -> Column:
    """``items`` as rows made by ``make(item, index, head)``, head being the last of ``heads`` (by ``i``, the first at 0) at or before the item.

    Each run is a slice, so the work is in proportion to the items.
    """

    def run(head: Column, k: Column) -> Column:
        end = F.coalesce(F.get(heads, k + 1)["i"], F.size(items))
        return F.transform(F.slice(items, head["i"] + 1, end - head["i"]), lambda x, j: make(x, head["i"] + j, head))

    return F.flatten(F.transform(heads, run))


def line_arrays(described: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and ``lines``, an array of ``line_index, section, text, char_start, char_end`` per text that isn't empty.

    A line's start is the place behind the line feed before it; its section that of the last heading. Both come from the
    row's own arrays, so no text is shuffled.
    """
    text = F.col("description_normalized")
    feeds = F.filter(F.transform(F.split(text, ""), lambda c, i: F.when(c == "\n", i)), lambda i: i.isNotNull())
    cut = T.once(described.where(text != "").select(*keep, "description_normalized"), _cut=F.split(text, "\n", -1), _feeds=feeds)
    opened = F.filter(F.transform("_cut", lambda x, i: F.struct(i.alias("i"), T.section_header(T.strip(x)).alias("section"))), lambda h: h["section"].isNotNull())
    body = F.array(F.struct(F.lit(0).alias("i"), F.lit("body").alias("section")))
    headed = T.once(cut, _heads=F.when(F.get(opened, F.lit(0))["i"] == 0, opened).otherwise(F.concat(body, opened)))

    def line(x: Column, i: Column, head: Column) -> Column:
        start = F.coalesce(F.get("_feeds", i - 1) + 1, F.lit(0))
        return F.struct(i.alias("line_index"), head["section"].alias("section"), x.alias("text"), start.alias("char_start"), (start + F.length(x)).alias("char_end"))

    return headed.select(*keep, runs_of(F.col("_cut"), F.col("_heads"), line).alias("lines"))


def line_id(job_key: Column, index: Column) -> Column:
    """The key and the line's number from 1, of four digits at least."""
    number = (index + 1).cast("string")
    return F.concat(job_key, F.lit("_L"), F.when(index < 9999, F.lpad(number, 4, "0")).otherwise(number))


def segment(described: DataFrame) -> DataFrame:
    """A row per line: ``job_index, job_key, line_id, line_index, section, text, char_start, char_end``. Empty texts have no lines."""
    rows = line_arrays(described, "job_index", "job_key").select("job_index", "job_key", F.explode("lines").alias("l"))
    return rows.select("job_index", "job_key", line_id(F.col("job_key"), F.col("l.line_index")).alias("line_id"), "l.*")


def label(lines: DataFrame) -> DataFrame:
    return lines.withColumn("boilerplate_label", T.line_label(T.strip(F.col("text")), F.col("section")))


def for_extraction(labelled: DataFrame) -> DataFrame:
    """The lines a model is shown: not blank, neither legal nor benefits."""
    return labelled.where((T.strip(F.col("text")) != "") & ~F.col("boilerplate_label").isin("likely_legal", "likely_benefits"))


def batches(lines: DataFrame, size: int = 5) -> DataFrame:
    """``job_index, batch, line_ids, text``: the non-blank lines of a job in order, ``size`` to a batch."""
    order = Window.partitionBy("job_index").orderBy("line_index")
    numbered = lines.where(T.strip(F.col("text")) != "").withColumn("batch", F.floor((F.row_number().over(order) - 1) / size).cast("int"))
    grouped = numbered.groupBy("job_index", "batch").agg(F.array_sort(F.collect_list(F.struct("line_index", "line_id", "text"))).alias("l"))
    return grouped.select("job_index", "batch", F.col("l.line_id").alias("line_ids"), F.array_join("l.text", "\n").alias("text"))


def chunk_starts(lines: Column, max_chars: int = CHUNK_CHARS, max_lines: int = CHUNK_LINES) -> Column:
    """``array<struct<i, k>>``: the first line and the number of each retry unit of ``lines``.

    A fold along the lines: a unit ends where the next line would exceed a limit or, once it is half full, changes the section.
    """
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("chars"), F.lit(0).alias("count"), F.lit("").alias("section"), F.array().cast("array<int>").alias("cuts"))

    def step(acc: Column, x: Column) -> Column:
        size, section = F.greatest(F.lit(1), x["char_end"] - x["char_start"]), F.lower(x["section"])
        grown = acc["chars"] + size + 1
        turned = (section != acc["section"]) & (acc["chars"] >= max_chars // 2)
        cut = (acc["count"] == 0) | (grown > max_chars) | (acc["count"] >= max_lines) | turned
        return F.struct(
            (acc["i"] + 1).alias("i"),
            F.when(cut, size).otherwise(grown).alias("chars"),
            F.when(cut, 1).otherwise(acc["count"] + 1).alias("count"),
            section.alias("section"),
            F.when(cut, F.concat(acc["cuts"], F.array(acc["i"]))).otherwise(acc["cuts"]).alias("cuts"),
        )

    return F.transform(F.aggregate(lines, start, step, lambda acc: acc["cuts"]), lambda i, k: F.struct(i.alias("i"), k.alias("k")))


def chunks(described: DataFrame) -> DataFrame:
    """``job_index, line_id, chunk``: the retry unit of each line."""
    arrays = T.once(line_arrays(described, "job_index", "job_key"), _starts=chunk_starts(F.col("lines")))
    numbered = runs_of(F.col("lines"), F.col("_starts"), lambda x, i, head: F.struct(i.alias("i"), head["k"].alias("chunk")))
    rows = arrays.select("job_index", "job_key", F.explode(numbered).alias("l"))
    return rows.select("job_index", line_id(F.col("job_key"), F.col("l.i")).alias("line_id"), "l.chunk")


def with_chunks(described: DataFrame, *keep: str) -> DataFrame:
    """``keep``, ``n_lines`` and ``chunks``, the texts of a description's retry units, cut out of it in the row itself."""
    text = F.col("description_normalized")
    arrays = line_arrays(described, *keep, "description_normalized").withColumnRenamed("lines", "_lines")
    arrays = T.once(arrays, _starts=chunk_starts(F.col("_lines")))

    def part(head: Column, k: Column) -> Column:
        a = F.get("_lines", head["i"])["char_start"]
        b = F.get("_lines", F.coalesce(F.get("_starts", k + 1)["i"], F.size("_lines")) - 1)["char_end"]
        return F.substr(text, a + 1, b - a)

    return arrays.select(*keep, F.size("_lines").alias("n_lines"), F.transform("_starts", part).alias("chunks"))


def chunk_texts(described: DataFrame) -> DataFrame:
    """``job_index, chunk, text`` of each retry unit."""
    return with_chunks(described, "job_index").select("job_index", F.posexplode("chunks").alias("chunk", "text"))


def inspect(labelled: DataFrame, job_index: int) -> DataFrame:
    """One job's lines with their labels and whether a model is shown them."""
    shown = (T.strip(F.col("text")) != "") & ~F.col("boilerplate_label").isin("likely_legal", "likely_benefits")
    return labelled.where(F.col("job_index") == job_index).select("line_index", "section", "boilerplate_label", shown.alias("shown"), "text").orderBy("line_index")


def split_near_middle(text: str) -> tuple[str, str] | None:
    """Two parts of a text, cut at its best place: a sentence's end before a near space before the middle itself, each the nearer the better."""
    middle = len(text) // 2
    spaces = range(max(1, middle - NEAR), min(len(text) - 1, middle + NEAR))
    places = [(0, abs(m.end() - middle), m.end()) for m in _SENTENCE_END.finditer(text)]
    places += [(1, abs(i - middle), i) for i in spaces if text[i] == " "]
    at = min([*places, (2, 0, middle)])[2]
    parts = text[:at].strip(), text[at:].strip()
    return parts if all(parts) else None
