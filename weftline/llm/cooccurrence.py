"""Problem 6: how often two items occur in the same basket, and how far that exceeds chance.

Items are deduplicated per basket, ordered pairs are emitted from each basket's sorted items, their counts are combined
map-side before the shuffle, and lift and pointwise mutual information come from the marginals.

A pair that occurs in ``min_count`` baskets needs two items that do, so rarer items are left out first; no result is lost by
that. Baskets of at most ``block`` items emit their pairs within one row. Larger ones (one basket may hold a third of all rows)
are cut into blocks of items by hash, and each pair of blocks is one row of its own, so that no task and no row ever
holds all pairs of a basket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import fold, require

MIN_COUNT = 5
MIN_LIFT = 3
BLOCK = 128


def basket_items(df: DataFrame, basket: str, item: str) -> DataFrame:
    """Distinct ``basket, item``; items folded; rows without a basket or an item left out."""
    require(df, basket, item)
    return df.select(F.col(f"`{basket}`").alias("basket"), fold(F.col(f"`{item}`")).alias("item")).where(F.col("basket").isNotNull() & F.col("item").isNotNull()).distinct()


def _pairs(items: Column) -> Column:
    """Ordered pairs of a sorted array."""
    return F.flatten(F.transform(items, lambda a, i: F.transform(F.slice(items, i + 2, F.greatest(F.size(items) - i - 1, F.lit(0))), lambda b: F.struct(a.alias("a"), b.alias("b")))))


def _across(left: Column, right: Column) -> Column:
    """Pairs of an item of one array and an item of another, the smaller first."""
    return F.flatten(F.transform(left, lambda a: F.transform(right, lambda b: F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")))))


def pair_counts(items: DataFrame, block: int = BLOCK) -> DataFrame:
    """``a, b, n_both`` for all pairs of items of a basket, from distinct ``basket, item``; a < b by code point.

    The number of blocks follows the basket's size, so that a block holds about ``block / 2`` items.
    """
    sizes = items.groupBy("basket").agg(F.count("*").alias("n"))
    big = sizes.where(F.col("n") > block).select("basket", F.ceil(F.col("n") * 2 / block).cast("int").alias("blocks"))
    cut = items.join(big, "basket", "left").withColumn("k", F.when(F.col("blocks").isNotNull(), F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int")))
    blocks = cut.groupBy("basket", "k").agg(F.array_sort(F.collect_list("item")).alias("items"), F.first("blocks").alias("blocks"))
    within = blocks.select(F.explode(_pairs(F.col("items"))).alias("p"))
    # each block of a large basket meets every later one: keyed by (basket, lower, upper), spread over all tasks
    large = blocks.where(F.col("k").isNotNull())
    left = large.select("basket", F.col("k").alias("lo"), F.explode(F.sequence(F.col("k"), F.col("blocks") - 1)).alias("hi"), F.col("items").alias("l")).where("lo < hi")
    right = large.select("basket", F.explode(F.sequence(F.lit(0), F.col("k"))).alias("lo"), F.col("k").alias("hi"), F.col("items").alias("r")).where("lo < hi")
    across = left.join(right, ["basket", "lo", "hi"]).select(F.explode(_across(F.col("l"), F.col("r"))).alias("p"))
    return within.unionByName(across).groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.count("*").alias("n_both"))


def cooccurrence(df: DataFrame, basket: str, item: str, min_count: int = MIN_COUNT, block: int = BLOCK) -> DataFrame:
    """``a, b, n_a, n_b, n_both, n_baskets, lift, pmi`` of every pair in at least ``min_count`` baskets.

    Exact duplicates count once; an empty table gives no rows. PMI is in bits.
    """
    all_items = basket_items(df, basket, item)
    margins = all_items.groupBy("item").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)
    n = all_items.agg(F.count_distinct("basket").alias("n_baskets"))
    counted = pair_counts(all_items.join(margins.select("item"), "item", "left_semi"), block).where(F.col("n_both") >= min_count)
    with_margins = counted.join(margins.select(F.col("item").alias("a"), F.col("n").alias("n_a")), "a").join(margins.select(F.col("item").alias("b"), F.col("n").alias("n_b")), "b").join(F.broadcast(n))
    lift = F.col("n_both") * F.col("n_baskets") / (F.col("n_a").cast("double") * F.col("n_b"))
    return with_margins.select("a", "b", "n_a", "n_b", "n_both", "n_baskets", lift.alias("lift"), F.log2(lift).alias("pmi"))
