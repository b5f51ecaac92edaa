"""New job files as a stream: each micro-batch is described, segmented and appended to stage tables, exactly once.

Everything before the aggregates works on single rows, so the stream needs no state; a batch that is replayed after a failure
overwrites its own partition and changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weftline.functions.text import with_quality
from weftline.operators import lines


def write_batch(batch: DataFrame, batch_id: int, out: str) -> None:
    """The described jobs and labelled lines of one micro-batch, in partitions of their own."""
    described = lines.describe(batch).persist()
    try:
        with_quality(described).write.mode("overwrite").parquet(f"{out}/described/batch={batch_id}")
        lines.label(lines.segment(described)).write.mode("overwrite").parquet(f"{out}/lines/batch={batch_id}")
    finally:
        described.unpersist()


def start(spark: SparkSession, source: str, schema, out: str, checkpoint: str, available_now: bool = True, files_per_batch: int = 100) -> StreamingQuery:
    """A query over Parquet job files in ``source``; with ``available_now`` it ends when all present files are done."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    writer = stream.writeStream.foreachBatch(lambda batch, i: write_batch(batch, i, out)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")).start()


def mention_rates(mentions: DataFrame, late: str = "28 days", width: str = "1 day") -> DataFrame:
    """``window, n`` of mentions by creation day from a stream; mentions later than ``late`` are left out by the watermark."""
    return mentions.withWatermark("created_at", late).groupBy(F.window("created_at", width)).agg(F.count("*").alias("n"))
