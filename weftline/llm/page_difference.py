"""Problem 4, the method named: pages of one host that lie side by side by URL path are differenced, and the lines they share are deleted.

What a template repeats on every page (menus, footers, share prompts) stands on the neighbour too; what is the page's own does not.

Copies of a page are one page, as differencing two of them would leave nothing. The pages of all hosts are ordered by host, path and
content; the neighbour with the longer common path, the one before at a tie, is the partner. Both neighbours are looked up by rank in
equi-joins, and a rank needs no group, so a host with a third of all pages is spread like any other. A pair's lines are aligned
by their longest common subsequence, in bit-parallel rows, so that a line that both hold at different places is not deleted twice.

Pages without host or text are kept as they are; a host's only page has no partner and keeps its lines. Blank lines stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions.ranking import global_rank
from weftline.llm.common import require


def common_lines(a: list[str], b: list[str]) -> set[int]:
    """The places in ``a`` of one longest common subsequence of both."""
    where: dict[str, int] = {}
    for j, line in enumerate(b):
        where[line] = where.get(line, 0) | 1 << j
    full, row, rows = (1 << len(b)) - 1, (1 << len(b)) - 1, []
    for line in a:  # a zero at place j: the length grows there
        rows.append(row)
        hit = row & where.get(line, 0)
        row = ((row + hit) | (row - hit)) & full
    out, upto = set(), len(b)
    for i in range(len(a) - 1, -1, -1):
        before, mask = rows[i], (1 << upto) - 1
        if (~row & mask).bit_count() > (~before & mask).bit_count():  # line i lengthens what b's first ``upto`` lines hold
            new = ~row & before & mask
            place = where[a[i]] & mask
            # the last place of the line in b from which the length can still be reached
            while place:
                j = place.bit_length() - 1
                low = (1 << j) - 1
                if (~before & low).bit_count() + 1 == (~row & mask).bit_count():
                    break
                place &= low
            out.add(i)
            upto = place.bit_length() - 1 if place else new.bit_length() - 1
        row = before
    return out


def without_shared(text: str, partner: str | None) -> str:
    """``text`` without the lines it shares with ``partner``, compared without surrounding white space."""
    if partner is None:
        return text
    lines = text.split("\n")
    own = [(i, x.strip()) for i, x in enumerate(lines) if x.strip()]
    shared = common_lines([x for _, x in own], [x.strip() for x in partner.split("\n") if x.strip()])
    gone = {own[k][0] for k in shared}
    return "\n".join(x for i, x in enumerate(lines) if i not in gone)


def page_differences(pages: DataFrame, host: str = "host", path: str = "path", text: str = "text", out: str = "difference") -> DataFrame:
    """``pages`` with ``out``, each page's text without the lines shared with its nearest neighbour; every row stays, extra columns pass through."""
    require(pages, host, path, text)
    rest = [c for c in pages.columns if c != out]
    row = F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row")
    known = F.col(f"`{host}`").isNotNull() & F.col(f"`{text}`").isNotNull()
    content = F.struct(F.xxhash64(f"`{text}`").alias("h1"), F.xxhash64(F.lit("page"), f"`{text}`").alias("h2"))
    keyed = pages.select(row, F.when(known, F.struct(F.col(f"`{host}`").alias("host"), content.alias("content"))).alias("key"), F.coalesce(f"`{path}`", F.lit("")).alias("path"), F.col(f"`{text}`").alias("text"))
    distinct = keyed.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("path").alias("path"), F.first("text").alias("text"))
    ranked = global_rank(distinct.select("key", F.col("key.host").alias("host"), "path", "text"), ["host", "path", "key"], "rank")
    place = ranked.select("rank", "host", "path")
    beside = lambda step, name: place.select((F.col("rank") + step).alias("rank"), F.struct("host", "path").alias(name))
    near = place.join(beside(1, "before"), "rank", "left").join(beside(-1, "after"), "rank", "left")

    def in_common(name: str):
        """Characters that both paths begin with; null for a page of another host."""
        shorter = F.least(F.length("path"), F.length(f"{name}.path"))
        same = F.filter(F.sequence(F.lit(0), shorter), lambda n: F.substr("path", F.lit(1), n) == F.substr(F.col(f"{name}.path"), F.lit(1), n))
        return F.when(F.col(f"{name}.host") == F.col("host"), F.array_max(same))

    measured = near.select("rank", in_common("before").alias("back"), in_common("after").alias("ahead"))
    partner = F.when(F.col("back").isNull() & F.col("ahead").isNull(), None).when(F.coalesce("back", F.lit(-1)) >= F.coalesce("ahead", F.lit(-1)), F.col("rank") - 1).otherwise(F.col("rank") + 1)
    pairs = measured.select("rank", partner.alias("partner"))
    texts = ranked.select(F.col("rank").alias("partner"), F.col("text").alias("other"))
    met = ranked.select("rank", "key", "text").join(pairs, "rank").join(texts, "partner", "left").select("key", "text", "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [without_shared(t, o) for t, o in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.string())], names=["key", "left"])

    differenced = met.mapInArrow(run, met.select("key", F.col("text").alias("left")).schema)
    joined = keyed.select("row", "key", "text").join(differenced, "key", "left")
    return joined.select(*[F.col(f"row.`{c}`") for c in rest], F.coalesce("left", "text").alias(out))
