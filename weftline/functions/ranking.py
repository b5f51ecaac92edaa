"""A rank over a whole table without bringing it into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.session import cut


def global_rank(df: DataFrame, order: list[Column | str], out: str = "rank") -> DataFrame:
    """``df`` with its place in ``order``, from 1; ``order`` should be total.

    The table is range-partitioned and sorted, its partitions are counted, and a row's rank is its place in the partition plus the
    rows before it. What is broadcast has a row per partition. The sorted table is materialised, so that the counts hold.
    """
    placed = cut(df.orderBy(*order).select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row")))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("n"), F.min("_row").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", (before - F.col("first") + 1).alias("_shift"))
    return placed.join(F.broadcast(offsets), "_part").select(*df.columns, (F.col("_row") + F.col("_shift")).alias(out))
