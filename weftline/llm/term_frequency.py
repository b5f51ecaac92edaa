"""Problem 5: how often every distinct term occurs, in how many records, and which terms are too rare or too common.

Pairs (field, term, record) are sorted externally: range-partitioned on the whole triple and sorted within partitions, so
that a term holding a third of all rows spreads over as many partitions as its share needs. One scan over each sorted
partition then closes a run whenever the triple changes: Arrow's run-end encoding finds the runs of a batch, and the run that
is open at a batch's end is carried to the next. A triple never crosses a partition, a term may; its parts (at most one a
partition) are added up at the end, by an aggregate over partial counts.

Rows are not kept in memory: Spark's sort spills, and the scan holds one batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import fold, require

MIN_RECORDS = 3
MAX_SHARE = 0.08


def pairs_of(df: DataFrame, fields: dict[str, str], record: str) -> DataFrame:
    """Long ``field, term, record``, a row for each field of a row that has a term; terms folded, empty ones and rows without a record left out."""
    require(df, record, *fields.values())
    entries = F.array(*[F.struct(F.lit(name).alias("field"), fold(F.col(f"`{c}`")).alias("term")) for name, c in fields.items()])
    return df.where(F.col(f"`{record}`").isNotNull()).select(F.explode(entries).alias("e"), F.col(f"`{record}`").alias("record")).select("e.field", "e.term", "record").where(F.col("term").isNotNull())


def run_lengths(sorted_pairs: DataFrame) -> DataFrame:
    """``field, term, n_rows, n_records`` of each run of a partition that is sorted by field, term, record."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow.compute as pc

        def runs(values: pa.Array) -> np.ndarray:
            """Starts of the runs of equal values."""
            ends = pc.run_end_encode(values).run_ends.to_numpy()
            return np.concatenate([[0], ends[:-1]]).astype(np.int64)

        open_run = None  # [field, term, rows, records, last record]
        for b in batches:
            if not b.num_rows:
                continue
            f, t, r = (b.column(i) for i in range(3))
            term_starts = np.union1d(runs(f), runs(t))
            all_starts = np.union1d(term_starts, runs(r))
            rows = np.diff(np.append(term_starts, b.num_rows))
            records = np.diff(np.append(np.searchsorted(all_starts, term_starts), len(all_starts)))
            at = pa.array(term_starts)
            fields, terms = f.take(at).to_pylist(), t.take(at).to_pylist()
            first, last = r[0].as_py(), r[b.num_rows - 1].as_py()
            if open_run is not None and [fields[0], terms[0]] == open_run[:2]:
                rows[0] += open_run[2]
                records[0] += open_run[3] - (first == open_run[4])
                open_run = None
            out = [[open_run[0]], [open_run[1]], [open_run[2]], [open_run[3]]] if open_run is not None else [[], [], [], []]
            for to, new in zip(out, (fields[:-1], terms[:-1], rows[:-1].tolist(), records[:-1].tolist())):
                to.extend(new)
            open_run = [fields[-1], terms[-1], int(rows[-1]), int(records[-1]), last]
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64())], names=["field", "term", "n_rows", "n_records"])
        if open_run is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(open_run[:4], (pa.string(), pa.string(), pa.int64(), pa.int64()))], names=["field", "term", "n_rows", "n_records"])

    return sorted_pairs.mapInArrow(scan, "field string, term string, n_rows bigint, n_records bigint")


def term_frequency(df: DataFrame, fields: dict[str, str], record: str) -> DataFrame:
    """``field, term, n_rows, n_records`` of every distinct folded value of the given columns; empty input gives no rows.

    Exact duplicate rows of ``df`` must be dropped before, where they shall count once.
    """
    pairs = pairs_of(df, fields, record)
    ordered = pairs.repartitionByRange("field", "term", "record").sortWithinPartitions("field", "term", "record")
    parts = run_lengths(ordered)
    return parts.groupBy("field", "term").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_records").alias("n_records"))


def mark_terms(counts: DataFrame, total_records: DataFrame, min_records: int = MIN_RECORDS, max_share: float = MAX_SHARE) -> DataFrame:
    """``counts`` with ``mark``: 'rare' under ``min_records`` records, 'common' over ``max_share`` of all, else null.

    ``total_records`` has one row, ``n_total``; a term that is both is rare.
    """
    mark = F.when(F.col("n_records") < min_records, "rare").when(F.col("n_records") > F.lit(max_share) * F.col("n_total"), "common")
    return counts.join(F.broadcast(total_records)).withColumn("mark", mark).drop("n_total")


def mention_terms(mentions: DataFrame) -> DataFrame:
    """Marked counts of normalized_candidate and skill_span over mentions; duplicate mentions count once."""
    narrow = mentions.select("mention_id", "job_index", "normalized_candidate", "skill_span")
    # a mention's copies are equal in all columns; what differs in any of these is another row
    once = narrow.distinct()
    counts = term_frequency(once, {"normalized_candidate": "normalized_candidate", "skill_span": "skill_span"}, "job_index")
    total = mentions.agg(F.count_distinct("job_index").alias("n_total"))
    return mark_terms(counts, total)
