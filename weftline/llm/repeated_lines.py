"""Problem 3: lines repeated over many documents of one source, and the documents without them.

Two lines are the same if their letters (category L, lower-cased, in order) are. Before anything is counted, copies are
collapsed: a line counts once per document cluster, however often the cluster's documents were republished. Clusters are

* ``"posting"``: the rows of one job_index are one document (a posting crawled again is a copy of itself);
* ``"text"``: postings of a source whose sets of lines are the same are one cluster as well, so an article republished
  under many ids weighs as one. They are grouped by the sorted keys themselves.

Per line and source come the number of clusters, of postings and, if dates are given, of publication days; a notice
recurs over all three, a republished article over one cluster. All three are counted from the clusters alone, each with its
number of postings and its days: the lines of copies are counted once, however many the copies are.

Only 128-bit keys are shuffled, never text. Lines are brought together by posting once, copies combined before, and postings by their lines once; a cluster's
days are as many as the calendar has at most. Sums over clusters and distinct (line, day) are combined map-side, so that neither a source
with a third of all rows nor a notice on a third of all postings makes one large task or one large buffer. At least a share ``min_share`` of a
source's postings must hold a line, so a source has at most 1 / min_share times its mean number of distinct lines per posting
of them; the join back is left to adaptive execution, which broadcasts or splits by measured sizes.

Rows without a source or text belong to no repetition and are kept as they are. Exact duplicate rows count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import require

MIN_WORDS = 5
MIN_POSTINGS = 3
MIN_SHARE = 0.1


def line_key(text: Column) -> list[Column]:
    """128 bits of the letters of a line, as two longs."""
    letters = F.lower(F.regexp_replace(text, r"[^\p{L}]+", ""))
    return [F.xxhash64(letters).alias("h1"), F.xxhash64(F.lit("line"), letters).alias("h2")]


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\p{L}+"))


def document_clusters(lines: DataFrame, dates: DataFrame | None = None, cluster: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``source, all, n_postings, days``: every cluster once, with its lines of enough words (sorted keys), the number of its postings and their distinct days (null without ``dates``).

    ``dates``: ``job_index, posted_at``. A posting's day is its earliest.
    """
    if cluster not in ("posting", "text"):
        raise ValueError("cluster is 'posting' or 'text'")
    require(lines, "source", "job_index", "text")
    kept = lines.where(F.col("source").isNotNull() & F.col("job_index").isNotNull() & F.col("text").isNotNull())
    keyed = kept.select("source", "job_index", *line_key(F.col("text")), (word_count(F.col("text")) >= min_words).alias("long"))
    # one group per posting, copies of its rows combined map-side: its lines are bounded by its text, and postings without a long line stay
    postings = keyed.groupBy("source", "job_index").agg(F.sort_array(F.collect_set(F.when(F.col("long"), F.struct("h1", "h2")))).alias("all"))
    own = ["source", "all"] if cluster == "text" else ["source", "all", "job_index"]
    if dates is None:
        return postings.groupBy(*own).agg(F.count("*").alias("n_postings")).select("source", "all", "n_postings", F.lit(None).cast("array<date>").alias("days"))
    days = dates.where(F.col("job_index").isNotNull()).groupBy("job_index").agg(F.to_date(F.min("posted_at")).alias("day"))
    return postings.join(days, "job_index", "left").groupBy(*own).agg(F.count("*").alias("n_postings"), F.collect_set("day").alias("days")).select("source", "all", "n_postings", "days")


def line_counts(lines: DataFrame, dates: DataFrame | None = None, cluster: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``source, h1, h2, n_clusters, n_postings, n_days, source_clusters, source_postings`` of every line of enough words.

    Only clusters are counted: each of a line's clusters adds one cluster, its postings and its days. ``dates``: ``job_index, posted_at``; without it n_days is null.
    """
    found = document_clusters(lines, dates, cluster, min_words)
    line = ["source", "h1", "h2"]
    of_source = found.groupBy("source").agg(F.sum("n_postings").alias("source_postings"), F.count("*").alias("source_clusters"))
    # outer, else a filter for explode would go below the clusters and they would be made twice
    held = found.select("source", F.explode_outer("all").alias("l"), "n_postings", "days").where(F.col("l").isNotNull()).select("source", "l.h1", "l.h2", "n_postings", "days")
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    by_cluster = held.select(*line, one.alias("n_clusters"), "n_postings", zero.alias("n_days"))
    by_day = held.select(*line, F.explode("days").alias("day")).distinct().select(*line, zero.alias("n_clusters"), zero.alias("n_postings"), one.alias("n_days"))
    both = by_cluster if dates is None else by_cluster.unionByName(by_day)
    counts = both.groupBy(*line).agg(*[F.sum(c).alias(c) for c in ("n_clusters", "n_postings", "n_days")])
    n_days = F.col("n_days") if dates is not None else F.lit(None).cast("bigint")
    return counts.join(of_source, "source").select(*line, "n_clusters", "n_postings", n_days.alias("n_days"), "source_clusters", "source_postings")


def repeated_lines(lines: DataFrame, dates: DataFrame | None = None, cluster: str = "text", min_clusters: int = MIN_POSTINGS, min_share: float = MIN_SHARE, min_days: int = 0, min_words: int = MIN_WORDS, by: str = "clusters") -> DataFrame:
    """The rows of ``line_counts`` that recur excessively, on ``min_days`` days.

    ``by`` says what is counted, "clusters" or "postings": at least ``min_clusters`` of them, and the share ``min_share`` of those of their source.
    """
    if by not in ("clusters", "postings"):
        raise ValueError("by is 'clusters' or 'postings'")
    counts = line_counts(lines, dates, cluster, min_words)
    hit = (F.col(f"n_{by}") >= min_clusters) & (F.col(f"n_{by}") >= F.lit(min_share) * F.col(f"source_{by}"))
    return counts.where(hit & (F.col("n_days") >= min_days) if min_days else hit)


def _keyed(lines: DataFrame, min_words: int) -> DataFrame:
    """Each row as a struct, so that no name of its columns clashes, and the key of its line; other lines have one that equals no mark and spreads them."""
    require(lines, "source", "text")
    long = F.col("source").isNotNull() & (word_count(F.col("text")) >= min_words)
    none = F.struct(F.lit(None).cast("string").alias("s"), F.xxhash64(*[F.col(f"`{c}`") for c in lines.columns]).alias("h1"), F.lit(0).cast("bigint").alias("h2"))
    key = F.when(F.coalesce(long, F.lit(False)), F.struct(F.col("source").alias("s"), *line_key(F.col("text")))).otherwise(none)
    return lines.select(F.struct(*[F.col(f"`{c}`") for c in lines.columns]).alias("row"), key.alias("key"))


def _marks(repeated: DataFrame) -> DataFrame:
    return repeated.select(F.struct(F.col("source").alias("s"), "h1", "h2").alias("mark"))


def mark_lines(lines: DataFrame, repeated: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``lines`` with boolean column ``repeated``; every row stays, extra columns pass through."""
    joined = _keyed(lines, min_words).join(_marks(repeated), F.col("key") == F.col("mark"), "left")
    return joined.select(*[F.col(f"row.`{c}`") for c in lines.columns if c != "repeated"], F.col("mark").isNotNull().alias("repeated"))


def repeated_line_rows(lines: DataFrame, repeated: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``lines`` that are repeated lines: a semi join, so that all other rows end in the scan's stage."""
    require(lines, "source", "text")
    long = lines.where(F.col("source").isNotNull() & (word_count(F.col("text")) >= min_words))
    row = F.struct(*[F.col(f"`{c}`") for c in lines.columns]).alias("row")
    keyed = long.select(row, F.struct(F.col("source").alias("s"), *line_key(F.col("text"))).alias("key"))
    return keyed.join(_marks(repeated), F.col("key") == F.col("mark"), "left_semi").select("row.*")


def without_repeated(lines: DataFrame, repeated: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Each posting's lines without the repeated ones; exact duplicate rows are one row. Null lines stay."""
    return mark_lines(lines, repeated, min_words).where(~F.col("repeated")).drop("repeated").distinct()


def named(lines: DataFrame, repeated: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``repeated`` with ``letters``, the letters that the lines have in common."""
    long = lines.where(F.col("source").isNotNull() & (word_count(F.col("text")) >= min_words))
    letters = F.lower(F.regexp_replace("text", r"[^\p{L}]+", ""))
    keyed = long.select(F.struct(F.col("source").alias("s"), *line_key(F.col("text"))).alias("key"), letters.alias("letters"))
    marks = repeated.select(F.struct(F.col("source").alias("s"), "h1", "h2").alias("key"), "*")
    return keyed.join(marks, "key").dropDuplicates(["source", "h1", "h2"]).drop("key")
