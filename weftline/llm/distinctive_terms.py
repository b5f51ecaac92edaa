"""Problem 7: how distinctive a term is for a record, compared with the whole collection.

The score is the log-odds ratio of record against rest with an informative Dirichlet prior taken from the collection's
counts, divided by its standard error (a z-score). With y the record's count of a term, n the record's total, Y and N those
of the rest, and prior a for the term and A in all::

    delta = ln((y + a) / (n + A - y - a)) - ln((Y + a) / (N + A - Y - a))
    z = delta / sqrt(1 / (y + a) + 1 / (Y + a))

The prior is the term's share of the collection times ``prior_size``. Where a term is all there is on one side, that side's
odds are those of one further pseudo count.

All sums are map-side combined: terms per record first, then terms, records and the total from those few counts. A term that
holds a third of all rows only meets its own one-row statistics; adaptive execution splits that join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import fold, require

PRIOR_SIZE = 500.0
ROUNDING = 1e-9


def log_odds(y: Column, n: Column, c: Column, all_: Column, prior_size: Column) -> Column:
    """``delta`` of a term that a record of ``n`` has ``y`` times and the whole collection of ``all_`` has ``c`` times."""
    a, rest, floor = c / all_ * prior_size, c - y, F.lit(1.0)
    inside = F.log((y + a) / F.greatest(n + prior_size - y - a, floor))
    outside = F.log((rest + a) / F.greatest(all_ - n + prior_size - rest - a, floor))
    return inside - outside


def term_scores(counts: DataFrame, prior_size: float = PRIOR_SIZE) -> DataFrame:
    """``field, record, term, y, n_record, n_collection, n_records, z`` from distinct ``field, record, term, y`` (y > 0), and what z is made of: ``delta, n_all, prior_size`` and ``max_y``, the field's largest y."""
    terms = counts.groupBy("field", "term").agg(F.sum("y").alias("n_collection"), F.count("*").alias("n_records"))
    records = counts.groupBy("field", "record").agg(F.sum("y").alias("n_record"))
    total = counts.groupBy("field").agg(F.sum("y").alias("n_all"), F.max("y").alias("max_y"))
    joined = counts.join(records, ["field", "record"]).join(terms, ["field", "term"]).join(F.broadcast(total), "field")
    y, n, c, all_ = (F.col(x).cast("double") for x in ("y", "n_record", "n_collection", "n_all"))
    size = F.lit(float(prior_size))
    a = c / all_ * size
    delta = log_odds(y, n, c, all_, size)
    z = delta / F.sqrt(1 / (y + a) + 1 / (c - y + a))
    return joined.select("field", "record", "term", "y", "n_record", "n_collection", "n_records", z.alias("z"), delta.alias("delta"), "n_all", size.alias("prior_size"), "max_y")


def candidate_counts(mentions: DataFrame) -> DataFrame:
    """``field, record, term, y``: distinct mentions of a folded normalized_candidate in a posting."""
    require(mentions, "job_index", "mention_id", "normalized_candidate")
    rows = mentions.select(F.lit("normalized_candidate").alias("field"), F.col("job_index").alias("record"), fold("normalized_candidate").alias("term"), "mention_id")
    once = rows.where(F.col("record").isNotNull() & F.col("term").isNotNull() & F.col("mention_id").isNotNull()).distinct()
    return once.groupBy("field", "record", "term").agg(F.count("*").alias("y"))


def title_counts(jobs: DataFrame) -> DataFrame:
    """``field, record, term, y``: words of a posting's titles (letters, lower-cased), in how many of its distinct titles each stands."""
    require(jobs, "job_index", "title_raw")
    titles = jobs.where(F.col("job_index").isNotNull() & F.col("title_raw").isNotNull()).select("job_index", "title_raw").distinct()
    words = titles.select(F.lit("title_raw").alias("field"), F.col("job_index").alias("record"), F.explode(F.array_distinct(F.regexp_extract_all(F.lower("title_raw"), F.lit(r"(\p{L}+)"), 1))).alias("term"))
    return words.groupBy("field", "record", "term").agg(F.count("*").alias("y"))


def posting_terms(mentions: DataFrame, jobs: DataFrame, prior_size: float = PRIOR_SIZE) -> DataFrame:
    """Scores of each posting's normalized_candidate values and title_raw words, with ``max_records``, how many postings may hold a term that still tells postings apart: 1 % of them, 4 at least."""
    scores = term_scores(candidate_counts(mentions).unionByName(title_counts(jobs)), prior_size)
    of_mentions = mentions.agg(F.count_distinct("job_index").alias("n")).select(F.lit("normalized_candidate").alias("field"), "n")
    of_titles = jobs.where(F.trim("title_raw") != "").agg(F.count_distinct("job_index").alias("n")).select(F.lit("title_raw").alias("field"), "n")
    bounds = of_mentions.unionByName(of_titles).select("field", F.greatest(F.lit(4), F.floor(F.col("n") / 100)).alias("max_records"))
    return scores.join(F.broadcast(bounds), "field")


def stressed_enough(scores: DataFrame, min_mentions: int = 3) -> DataFrame:
    """The scored terms whose delta reaches that of the weakest case their record can have: ``least`` mentions of its own, and ``max_y`` in each of ``max_records`` - 1 others.

    No case is below. While the weakest has P_out < P_in <= 1/2 for the shares (y + a) / (n + A) and (Y + a) / (N + A), delta falls as Y grows; from P_in >= P_out on it grows with y.
    Where that doesn't hold for a record (its share is small against what the others may have, as in small collections), or the term is all but the whole collection, nothing is left out.
    """
    n, c, all_, size = (F.col(x).cast("double") for x in ("n_record", "n_collection", "n_all", "prior_size"))
    least = F.when(F.col("field") == "normalized_candidate", F.lit(float(min_mentions))).otherwise(1.0)
    most = least + (F.col("max_records").cast("double") - 1) * F.col("max_y")
    weakest = log_odds(least, n, most, all_, size)
    proven = (weakest > 0) & (2 * (least + most / all_ * size) <= n + size) & (size >= 1) & (size * (1 - c / all_) >= 1)
    return scores.where(~F.coalesce(proven, F.lit(False)) | (F.col("delta") >= weakest - ROUNDING))


def distinctive(scores: DataFrame, min_mentions: int = 3, min_letters: int = 4) -> DataFrame:
    """Distinct ``field, job_index, term`` of the scored terms that the posting stresses and few other postings have: the score selects, then the counts decide."""
    stressed = ((F.col("field") == "normalized_candidate") & (F.col("y") >= min_mentions)) | ((F.col("field") == "title_raw") & (F.length("term") >= min_letters))
    return stressed_enough(scores, min_mentions).where(stressed & F.col("n_records").between(2, F.col("max_records"))).select("field", F.col("record").alias("job_index"), "term").distinct()
