"""Readers: jobs as JSON, augmented jobs, stage tables, title lists, call logs, file inventories."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.text import DESCRIPTION_KEYS, TITLE_KEYS, strip

# The format of a call log's lines, and where a file name has its run id.
CALL_LINE = r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}),\d+ - DEBUG - .* - LLM (\S+) \[(\w+)\] ([\d.]+)s \| prompt=(\d+) chars, resp=(\d+) chars, eval=(\d+) tok, ([\d.]+) tok/s, total=([\d.]+)s"
RUN_FILE = r"run_(\S+?)\.jsonl?$"


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    """Jobs of a JSON file: a list, an object with a list ``jobs``, or one object. ``job_index`` is the place in the file.

    One document is one row until its jobs are exploded, so a file must fit a task; ``read_job_lines`` reads JSON lines of any size.
    Keys are read as they are; ``_original`` keeps each job's JSON.
    """
    whole = spark.read.text(path, wholetext=True)
    variant = F.try_parse_json("value")
    root = F.schema_of_variant(variant)
    listed = whole.select(F.when(root.startswith("ARRAY"), F.col("value")).otherwise(F.coalesce(F.get_json_object("value", "$.jobs"), F.concat(F.lit("["), F.col("value"), F.lit("]")))).alias("doc"))
    items = listed.select(F.posexplode(F.from_json("doc", T.ArrayType(T.StringType()))).alias("job_index", "_original"))
    return _keyed(items)


def read_job_lines(spark: SparkSession, path: str) -> DataFrame:
    """Jobs of JSON lines, split by Spark; the place in the data numbers them by file and offset."""
    lines = spark.read.text(path).where(F.trim("value") != "").select(F.col("value").alias("_original"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"))
    parts = lines.withColumn("_part", F.spark_partition_id())
    sizes = parts.groupBy("_part").agg(F.count("*").alias("n"), F.min("_file").alias("f"), F.min("_block").alias("b"), F.min("_row").alias("first"))
    offsets = sizes.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("f", "b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_part", "before", "first")
    numbered = parts.join(F.broadcast(offsets), "_part").select((F.col("before") + F.col("_row") - F.col("first")).alias("job_index"), "_original")
    return _keyed(numbered)


def _keyed(items: DataFrame) -> DataFrame:
    keys = dict.fromkeys(("id", "source", "employer", *TITLE_KEYS, *DESCRIPTION_KEYS))
    lower: dict[str, str] = {}
    for k in keys:  # keys that differ in case only share a column name in Spark; each stays under its own struct
        lower.setdefault(k.lower(), k)
    value = F.try_parse_json("_original")
    cols = [F.when(F.schema_of_variant(F.try_variant_get(value, f"$.{k}", "variant")) == "STRING", F.try_variant_get(value, f"$.{k}", "string")).alias(f"_k{i}") for i, k in enumerate(keys) if k != "id"]
    ids = F.try_variant_get(value, "$.id", "string").alias("id")
    wide = items.select("job_index", "_original", ids, *cols)
    names = [k for k in keys if k != "id"]
    at = {k: f"_k{i}" for i, k in enumerate(keys) if k != "id"}

    def first(options: tuple[str, ...]):
        return F.coalesce(*[F.when(F.regexp_replace(at[k], r"(?U)^\s+|\s+$", "") != "", F.regexp_replace(at[k], r"(?U)^\s+|\s+$", "")) for k in options if k in names])

    return wide.select(F.col("job_index").cast("bigint").alias("job_index"), "id", first(TITLE_KEYS).alias("title"), first(DESCRIPTION_KEYS).alias("description"), F.col(at["source"]).alias("source"), F.col(at["employer"]).alias("employer"), "_original")


def run_id_of(path: str) -> str:
    """The run id in a file name, 'unknown' if it has none."""
    m = re.search(r"run_(\S+?)\.json", os.path.basename(path))
    return m[1] if m else "unknown"


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines of a stage: NULs, blank and corrupt lines, header and footer are left out."""
    text = spark.read.text(path).select(F.trim(F.replace("value", F.lit("\0"), F.lit(""))).alias("value")).where("value != ''")
    parsed = text.select("value", F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r"), F.get_json_object("value", "$._meta").alias("m"), F.get_json_object("value", "$._complete").alias("c"))
    return parsed.where(F.try_parse_json("value").isNotNull() & F.col("m").isNull() & F.col("c").isNull() & F.col("r").isNotNull()).select("r.*")


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a stage's JSON lines have their footer."""
    return not spark.read.text(path).where(F.get_json_object("value", "$._complete") == "true").isEmpty()


def count_records(spark: SparkSession, path: str) -> int:
    """Records of a stage's JSON lines, without header, footer and corrupt lines."""
    return read_records(spark, path, "job_index bigint").count()


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """``raw_title, normalized_title`` of a title list (CSV, Parquet, or Excel where pandas can read it); of equal raw titles the last row holds."""
    if path.endswith((".xlsx", ".xls")):
        import pandas as pd

        book = pd.ExcelFile(path)
        sheet = "Job_Titles" if "Job_Titles" in book.sheet_names else book.sheet_names[0]
        pdf = pd.read_excel(book, sheet_name=sheet)[["Raw_title", "Normalized_title"]]
        rows = [(i, r, n) for i, (r, n) in enumerate(pdf.itertuples(index=False)) if isinstance(r, str) and isinstance(n, str)]
        df = spark.createDataFrame(rows, "at bigint, raw_title string, normalized_title string")
    else:
        read = spark.read.parquet(path) if path.endswith(".parquet") else spark.read.csv(path, header=True)
        df = read.select(F.monotonically_increasing_id().alias("at"), F.col("Raw_title").alias("raw_title"), F.col("Normalized_title").alias("normalized_title"))
    clean = df.select("at", strip(F.col("raw_title")).alias("raw_title"), strip(F.col("normalized_title")).alias("normalized_title")).where("raw_title != '' and normalized_title != ''")
    return clean.groupBy("raw_title").agg(F.max_by("normalized_title", "at").alias("normalized_title"))


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    """``alias, target`` of an alias table of any size, CSV or Parquet with those columns; folded, of several targets of an alias the least holds."""
    read = spark.read.parquet(path) if path.endswith(".parquet") else spark.read.csv(path, header=True)
    folded = read.select(F.lower(strip(F.col("alias"))).alias("alias"), F.lower(strip(F.col("target"))).alias("target"))
    return folded.where("alias != '' and target != ''").groupBy("alias").agg(F.min("target").alias("target"))


def parse_calls(lines: DataFrame) -> DataFrame:
    """A call log's lines ``value`` as ``ts, model, role, wall_time, prompt_chars, resp_chars, eval_tokens, tok_s, total_duration``."""
    part = lambda i: F.regexp_extract("value", CALL_LINE, i)
    kinds = ["timestamp", "string", "string", "double", "int", "int", "int", "double", "double"]
    names = ["ts", "model", "role", "wall_time", "prompt_chars", "resp_chars", "eval_tokens", "tok_s", "total_duration"]
    found = lines.where(F.col("value").rlike(CALL_LINE))
    return found.select(*[(F.try_to_timestamp(part(i + 1), F.lit("yyyy-MM-dd HH:mm:ss")) if k == "timestamp" else part(i + 1).try_cast(k)).alias(n) for i, (n, k) in enumerate(zip(names, kinds))])


def inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path, run_id, size, modified`` of the files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.coalesce(F.nullif(F.regexp_extract("path", RUN_FILE, 1), F.lit("")), F.lit("unknown")).alias("run_id"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def latest_run(files: DataFrame) -> str | None:
    """The run that was written to last."""
    row = files.groupBy("run_id").agg(F.max("modified").alias("at")).orderBy(F.desc("at"), F.desc("run_id")).first()
    return row.run_id if row else None
