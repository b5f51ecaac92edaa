"""Problem 8: documents are put into containers of fixed capacity with little unused space.

Vector bin packing: a container has a limit on tokens, on segments (documents in it) and on loss-bearing tokens. A
container is filled by the dot-product heuristic: of all items that still fit in every dimension, the one whose demand has
the largest weighted dot product with what is left goes in, until none fits; then the next container is opened. Items of
one kind and size are alike, so the choice is over distinct sizes (at most two per token of capacity), vectorised.

Only documents above a capacity are split: into full pieces, a container each, and a remainder that is packed as an item.

Documents are hashed, by id and place in the table, to shards of about ``SHARD_ITEMS`` items, whatever their source or how often an id occurs, and each shard is packed on its own:
no group grows with the data, and a shard wastes at most its last container. Only sizes are shuffled, never text.

Empty and null texts need no room; they are listed with bin_id null. A document whose own loss-bearing tokens exceed their limit uses
it up: only documents that bear none join it. A doc_id that occurs on several rows is packed as often.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import require
from weftline.llm.tokens import TOKENIZER, with_token_counts

SHARD_ITEMS = 20_000
TOKENS_PER_SEGMENT = 16  # a container takes capacity / 16 segments
LOSS_SHARE = 0.75  # of the capacity
LOSS_KINDS = ("reply",)  # documents of these kinds bear loss on all their tokens, others on none
MAX_CONTAINERS = 1_000


def pack(sizes: list[int], losses: list[int], capacity: int, max_segments: int, max_loss: int) -> list[int]:
    """The bin of each item; every size is 1 to ``capacity``."""
    import numpy as np

    bins = [-1] * len(sizes)
    kinds: dict[tuple[int, int], list[int]] = {}
    for i, (s, v) in enumerate(zip(sizes, losses)):
        kinds.setdefault((s, min(v, max_loss)), []).append(i)
    order = sorted(kinds)
    tokens = np.array([k[0] for k in order], dtype=np.int64)
    loss = np.array([k[1] for k in order], dtype=np.int64)
    left = np.array([len(kinds[k]) for k in order], dtype=np.int64)
    total = left.sum()
    # a dimension weighs by how scarce it is: demand in all over capacity
    weight_t = float((tokens * left).sum()) / capacity**2
    weight_l = float((loss * left).sum()) / max(1, max_loss) ** 2
    weight_s = float(total) / max(1, max_segments) ** 2
    n = 0
    while total:
        room_t, room_l, room_s = capacity, max_loss, max_segments
        while room_s:
            upto = int(np.searchsorted(tokens, room_t, side="right"))
            if not upto:
                break
            fits = (left[:upto] > 0) & (loss[:upto] <= room_l)
            if not fits.any():
                break
            score = np.where(fits, weight_t * room_t * tokens[:upto] + weight_l * room_l * loss[:upto] + weight_s * room_s, -1.0)
            k = int(score.argmax())
            bins[kinds[order[k]].pop()] = n
            left[k] -= 1
            total -= 1
            room_t -= int(tokens[k])
            room_l -= int(loss[k])
            room_s -= 1
        n += 1
        if n % 256 == 0 and len(left) > 64:
            keep = left > 0
            if keep.sum() < 0.7 * len(left):
                order = [k for k, x in zip(order, keep) if x]
                tokens, loss, left = tokens[keep], loss[keep], left[keep]
    return bins


def pack_documents(documents: DataFrame, capacities: DataFrame, tokenizer: str = TOKENIZER, shard_items: int = SHARD_ITEMS, loss_kinds: tuple[str, ...] = LOSS_KINDS, loss_share: float = LOSS_SHARE) -> DataFrame:
    """``container, capacity_tokens, doc_id, piece, first_token, n_tokens, loss_tokens, bin_id``, once per capacity.

    Pieces of a document are numbered from 0 and cover its tokens without overlap. bin_id is unique within a container kind.
    ``capacities`` holds at most MAX_CONTAINERS rows; null and non-positive capacities raise an error.
    """
    require(documents, "doc_id", "text")
    require(capacities, "container", "capacity_tokens")
    kinds = capacities.select("container", "capacity_tokens").distinct().limit(MAX_CONTAINERS + 1).collect()
    if len(kinds) > MAX_CONTAINERS or any(not r.capacity_tokens or r.capacity_tokens < 1 for r in kinds):
        raise ValueError(f"capacities must be 1 to {MAX_CONTAINERS} rows of positive capacity_tokens")
    loss = F.col("kind").isin(*loss_kinds) if "kind" in documents.columns else F.lit(False)
    sized = with_token_counts(documents.select("doc_id", F.coalesce(loss, F.lit(False)).alias("bears"), F.monotonically_increasing_id().alias("row"), "text"), path=tokenizer)
    offered = F.array(*[F.struct(F.lit(r.container).alias("container"), F.lit(int(r.capacity_tokens)).alias("capacity_tokens")) for r in kinds]) if kinds else F.array().cast("array<struct<container: string, capacity_tokens: int>>")
    each = sized.select("doc_id", "bears", "row", F.col("n_tokens").alias("size"), F.explode(offered).alias("c")).select("doc_id", "bears", "row", "size", "c.container", "c.capacity_tokens")
    # the number of items decides the number of shards; the scan is repeated for it by Parquet's row counts alone
    shards = max(1, -(-documents.count() // shard_items))
    keyed = each.withColumn("shard", F.pmod(F.xxhash64("doc_id", "row", F.lit("pack")), F.lit(shards)).cast("int")).drop("row")
    spec = keyed.groupBy("container", "shard")

    def run(group: pa.Table) -> pa.Table:
        capacity, container, shard = (group.column(c)[0].as_py() for c in ("capacity_tokens", "container", "shard"))
        ids, sizes, bears = (group.column(c).to_pylist() for c in ("doc_id", "size", "bears"))
        rows, rest, full = [], [], 0
        for i in sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, sizes[i])):
            if not sizes[i]:
                rows.append((ids[i], 0, 0, 0, 0, None))
                continue
            whole, tail = divmod(sizes[i] - 1, capacity)
            tail += 1  # a remainder of 1 to capacity tokens is an item; the pieces before it are full
            for p in range(whole):
                rows.append((ids[i], p, p * capacity, capacity, capacity if bears[i] else 0, f"{shard}-f{full}"))
                full += 1
            rest.append((ids[i], whole, whole * capacity, tail, tail if bears[i] else 0))
        bins = pack([r[3] for r in rest], [r[4] for r in rest], capacity, max(1, capacity // TOKENS_PER_SEGMENT), max(1, int(capacity * loss_share)))
        rows.extend((*r, f"{shard}-{b}") for r, b in zip(rest, bins))
        columns = list(zip(*rows)) or [()] * 6
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        names = ("doc_id", "piece", "first_token", "n_tokens", "loss_tokens", "bin_id")
        head = {"container": pa.array([container] * len(rows), pa.string()), "capacity_tokens": pa.array([capacity] * len(rows), pa.int32())}
        return pa.table(head | {n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})

    return spec.applyInArrow(run, "container string, capacity_tokens int, doc_id bigint, piece int, first_token bigint, n_tokens bigint, loss_tokens bigint, bin_id string")


def usage(packed: DataFrame) -> DataFrame:
    """``container, capacity_tokens, n_bins, n_pieces, used_tokens, unused_share, max_segments_used``."""
    bins = packed.where(F.col("bin_id").isNotNull()).groupBy("container", "capacity_tokens", "bin_id").agg(F.sum("n_tokens").alias("used"), F.count("*").alias("segments"))
    totals = bins.groupBy("container", "capacity_tokens").agg(F.count("*").alias("n_bins"), F.sum("segments").alias("n_pieces"), F.sum("used").alias("used_tokens"), F.max("segments").alias("max_segments_used"))
    return totals.withColumn("unused_share", 1 - F.col("used_tokens") / (F.col("n_bins") * F.col("capacity_tokens")))
