"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import c
from tidemark.session import spread

#: Rank file of a byte-level BPE; it must lie at this path on every executor.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the texts of that vocabulary are split before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoder(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, text: str, keep: dict[str, str], vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns keep (old name to new) and n_tokens, of whole texts; null and empty texts have no tokens."""
    out = df.select(*(c(x).alias(y) for x, y in keep.items()), c(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode_ordinary
        for b in batches:
            sizes = [len(encode(x)) if x else 0 for x in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sizes, pa.int64())], names=[*b.schema.names[:-1], "n_tokens"])

    kinds = dict(out.dtypes)
    return spread(out).mapInArrow(run, ", ".join([*(f"`{y}` {kinds[y]}" for y in keep.values()), "n_tokens bigint"]))


def normal_source(col):
    """Spellings of a source compare after trimming and lower-casing."""
    return F.lower(F.trim(col))
