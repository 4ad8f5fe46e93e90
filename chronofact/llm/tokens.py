"""Sizes of texts in tokens of a public byte-level BPE tokenizer.

A byte-level BPE never merges across its pre-tokens, and its pre-token pattern always cuts before a space that has a
non-space on either side. So a text's size is the sum over its blank-separated pieces, each with its space before it.
Workers keep the sizes of the pieces met so far: a text costs one split and a look-up a word, several times less than
encoding it, and the count is exact. Texts with other white space beside a space are encoded as they are.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Default place of the vocabulary; every operator that counts tokens takes another path as a parameter.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed value: the pre-token pattern that belongs to this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: A space between white space: there the cut before the space isn't certain.
_UNSURE = re.compile(r"\s \s")


class _Sizes(dict):
    """Size of each piece met so far, with a space before it."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, piece: str) -> int:
        n = len(self.encode(" " + piece))
        if len(piece) <= 64:
            if len(self) > 2_000_000:
                self.clear()
            self[piece] = n
        return n


@lru_cache(maxsize=2)
def sizes(vocabulary: str = VOCABULARY) -> _Sizes:
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return _Sizes(tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary)


def count(text: str | None, known: _Sizes) -> int:
    """Tokens of a text; null and empty texts have none."""
    if not text:
        return 0
    if _UNSURE.search(text):
        return len(known.encode(text))
    first, *rest = text.split(" ")
    return (len(known.encode(first)) if first else 0) + sum(map(known.__getitem__, rest))


def with_tokens(df: DataFrame, text: str, keep: list[str], vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns of keep, and n_tokens (bigint) of the text; one Arrow pass, no shuffle."""
    wanted = df.select(*keep, df[text].alias("__text"))
    schema = T.StructType([*wanted.schema.fields[:-1], T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sizes(vocabulary)
        for b in batches:
            n = pa.array([count(x, known) for x in b.column(b.num_columns - 1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], n], names=[*b.schema.names[:-1], "n_tokens"])

    return wanted.mapInArrow(run, schema)
