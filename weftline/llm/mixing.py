"""Problem 9: records of several sources are mixed so that each source holds its target share of the total size.

Every document of a source is used in as many complete epochs as the source's budget holds, at most ``max_repeats``; the rest
of the budget is filled by a weighted sample without replacement (Efraimidis and Spirakis): each document draws the key
``-ln(u) / weight``, u from a hash of its id and the seed, weight from its quality; documents are taken in ascending order of
keys until their tokens reach the rest. A document that would exceed it is passed over, and so on to the last key, so that in the end
no document left fits the gap of its source.

The prefix sum is distributed: a key falls into a bucket by its logarithm, ``PER_OCTAVE`` buckets to a factor of two. As keys are
exponential, a bucket holds at most ln(2) / e / PER_OCTAVE of its source (about 1 in 8,000) whatever the weights. The sums per
source and bucket are combined map-side, and their running sum tells for every bucket but one per source whether it is in or
out. Only that boundary bucket is sorted. A source with a third of all rows is spread over its buckets. What the prefix leaves is a gap
smaller than the document that ended it. Only documents that fit can go into it, and of those of one size s only the first gap / s by key: gap * (ln gap + 1) documents at
most, however many there are, which one task per source takes or passes over in order.

Total size: the tokens of all documents of the listed sources, unless given. Documents without tokens or without a listed
source are not selected. Targets that need more repeats than allowed end as 'capped'; the report has actual shares and what is missing in tokens.
A source's tokens never exceed its budget. As no other source makes up for what a capped or short one lacks, the others' shares come out above their targets ('over').
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import require
from weftline.llm.tokens import TOKENIZER, with_token_counts
from weftline.session import cut

PER_OCTAVE = 2048
TOLERANCE = 0.02
SALTS = 64


def quality(text: Column) -> Column:
    """A weight of 0.1 to 1: the share of letters and spaces, less for lost characters and for very short texts."""
    n = F.greatest(F.length(text), F.lit(1))
    letters = F.length(F.regexp_replace(text, r"[^\p{L} ]+", "")) / n
    lost = F.length(text) - F.length(F.replace(text, F.lit("�")))
    short = F.least(F.lit(1.0), n / 200)
    return F.greatest(F.lit(0.1), F.least(F.lit(1.0), letters * (0.5 + 0.5 * short) - 10 * lost / n))


def sampled(documents: DataFrame, seed: int, tokenizer: str) -> DataFrame:
    """``doc_id, source, n_tokens, key, bucket`` of the documents with a source and tokens."""
    require(documents, "doc_id", "source", "text")
    rows = documents.where(F.col("source").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "source", quality(F.col("text")).alias("weight"), "text")
    sized = with_token_counts(rows, path=tokenizer).where(F.col("n_tokens") > 0)
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id").cast("string")), 11) + 0.5) * F.lit(2.0**-53)
    key = -F.log(u) / F.col("weight")
    return sized.select("doc_id", "source", "n_tokens", key.alias("key"), F.floor(F.log2(key) * PER_OCTAVE).cast("int").alias("bucket"))


def _prefix(docs: DataFrame) -> DataFrame:
    """The documents of each source, in ascending order of keys, whose running sum of tokens stays within the source's ``rest``."""
    sums = docs.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("tokens"), F.first("rest").alias("rest"))
    running = F.sum("tokens").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    edges = sums.withColumn("upto", running).withColumn("before", F.col("upto") - F.col("tokens")).where(F.col("before") < F.col("rest"))
    joined = docs.join(edges.select("source", "bucket", "before", (F.col("upto") <= F.col("rest")).alias("inside")), ["source", "bucket"])
    ahead = F.sum("n_tokens").over(Window.partitionBy("source").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    boundary = joined.where(~F.col("inside")).withColumn("ahead", ahead).where(F.col("before") + F.col("ahead") <= F.col("rest")).drop("ahead")
    return joined.where("inside").unionByName(boundary).select("doc_id", "source", "n_tokens")


def _filled(docs: DataFrame) -> DataFrame:
    """The documents that go into the gap ``rest`` of their source, each taken in ascending order of keys if it still fits."""
    may = docs.where(F.col("n_tokens") <= F.col("rest")).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    most = F.floor(F.col("rest") / F.col("n_tokens"))
    for group in (("source", "n_tokens", "salt"), ("source", "n_tokens")):  # one size of one source may be very frequent
        may = may.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy("key", "doc_id"))).where(F.col("_n") <= most).drop("_n")

    def take(group: pa.Table) -> pa.Table:
        group = group.sort_by([("key", "ascending"), ("doc_id", "ascending")])
        rest, places = group.column("rest")[0].as_py(), []
        for i, n in enumerate(group.column("n_tokens").to_pylist()):
            if n <= rest:
                places.append(i)
                rest -= n
        return group.take(pa.array(places, pa.int64())).select(["doc_id", "source", "n_tokens"])

    columns = may.select("doc_id", "source", "n_tokens", "key", "rest")
    return columns.groupBy("source").applyInArrow(take, columns.select("doc_id", "source", "n_tokens").schema)


def mix(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 7, tokenizer: str = TOKENIZER) -> tuple[DataFrame, DataFrame]:
    """(selection, shares).

    selection: ``doc_id, source, n_tokens, copies`` with copies of 1 to max_repeats.
    shares: ``source, target_share, actual_share, target_tokens, selected_tokens, missing_tokens, available_tokens, epochs, max_repeats, n_docs, status``,
    a row per target; status is 'met' or 'over' (actual share within TOLERANCE of the target, or above), 'capped' (max_repeats reached below the target), 'short' (below, as every document left is longer than the gap) or 'empty'.
    A target with null share counts as 0, with null max_repeats as 1; of several rows of a source the first by share holds.
    """
    require(targets, "source", "target_share", "max_repeats")
    docs = cut(sampled(documents, seed, tokenizer))
    first = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("target_share"), "max_repeats"))
    goals = targets.where(F.col("source").isNotNull()).withColumn("_n", first).where("_n = 1").select("source", F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0)).alias("max_repeats"))
    sums = docs.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("tokens"))
    available = sums.groupBy("source").agg(F.sum("tokens").alias("available_tokens"))
    known = goals.join(available, "source", "left").withColumn("available_tokens", F.coalesce("available_tokens", F.lit(0)))
    size = F.lit(total_tokens).cast("bigint") if total_tokens is not None else F.col("pool")
    pool = known.agg(F.sum("available_tokens").alias("pool"))
    plan = known.crossJoin(F.broadcast(pool)) if total_tokens is None else known
    plan = plan.withColumn("target_tokens", F.round(F.col("target_share") * size).cast("bigint"))
    epochs = F.when(F.col("available_tokens") > 0, F.least(F.floor(F.col("target_tokens") / F.col("available_tokens")), F.col("max_repeats").cast("bigint"))).otherwise(0)
    plan = plan.withColumn("epochs", epochs.cast("int"))
    rest = F.when(F.col("epochs") < F.col("max_repeats"), F.col("target_tokens") - F.col("epochs") * F.col("available_tokens")).otherwise(0)
    plan = plan.withColumn("rest", F.greatest(rest, F.lit(0)).cast("bigint")).select("source", "target_share", "max_repeats", "available_tokens", "target_tokens", "epochs", "rest")
    plan = cut(plan)  # a row per source; all that follows reads it many times
    goal = plan.where("rest > 0").select("source", "rest")
    first = cut(_prefix(docs.join(goal, "source").where(F.col("n_tokens") <= F.col("rest"))))
    used = first.groupBy("source").agg(F.sum("n_tokens").alias("used"))
    gap = cut(goal.join(used, "source", "left").select("source", (F.col("rest") - F.coalesce("used", F.lit(0))).alias("rest")).where("rest > 0"))
    left = docs.join(gap, "source").where(F.col("n_tokens") <= F.col("rest")).join(first.select("doc_id"), "doc_id", "left_anti")
    extra = first.unionByName(_filled(left))
    whole = docs.join(plan.where("epochs > 0").select("source", "epochs"), "source").select("doc_id", "source", "n_tokens", F.col("epochs").alias("copies"))
    both = whole.unionByName(extra.select("doc_id", "source", "n_tokens", F.lit(1).alias("copies")))
    selection = both.groupBy("doc_id", "source", "n_tokens").agg(F.sum("copies").cast("int").alias("copies"))
    got = selection.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("selected_tokens"), F.count("*").alias("n_docs"))
    all_ = got.agg(F.sum("selected_tokens").alias("all_tokens"))
    full = plan.join(got, "source", "left").crossJoin(F.broadcast(all_))
    selected = F.coalesce("selected_tokens", F.lit(0))
    actual = F.coalesce(selected / F.nullif("all_tokens", F.lit(0)), F.lit(0.0))
    status = F.when(F.col("available_tokens") == 0, "empty").when(actual > F.col("target_share") * (1 + TOLERANCE), "over").when(actual >= F.col("target_share") * (1 - TOLERANCE), "met").when(F.col("target_tokens") > F.col("available_tokens") * F.col("max_repeats"), "capped").otherwise("short")
    missing = F.greatest(F.col("target_tokens") - selected, F.lit(0))
    shares = full.select("source", "target_share", actual.alias("actual_share"), "target_tokens", selected.alias("selected_tokens"), missing.alias("missing_tokens"), "available_tokens", "epochs", "max_repeats", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), status.alias("status"))
    return selection, shares
