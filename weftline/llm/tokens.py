"""Sizes of texts in tokens of a public tokenizer; only the counts leave the tasks."""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import require

TOKENIZER = os.environ.get("WEFTLINE_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
# Fixed value: how the byte-level vocabulary of 50k entries cuts a text into pieces.
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.cache
def encoder(path: str):
    """The tokenizer of a ranks file, once per Python worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})


def with_token_counts(df: DataFrame, text: str = "text", out: str = "n_tokens", path: str = TOKENIZER) -> DataFrame:
    """``df`` without ``text`` and with ``out``, its size in tokens; null and '' have none. Whole texts are counted."""
    require(df, text)
    rest = [c for c in df.columns if c not in (text, out)]
    shaped = df.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`").alias(text))
    schema = df.select(*[F.col(f"`{c}`") for c in rest], F.lit(0).cast("bigint").alias(out)).schema
    at = len(rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            sizes = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:at], pa.array(sizes, pa.int64())], names=[*rest, out])

    return shaped.mapInArrow(run, schema)
