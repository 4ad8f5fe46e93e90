"""Splitting oversized texts at natural boundaries, by pointer doubling.

The units of a text are its paragraphs, else its sentences, words or characters: the coarsest kind of which none exceeds
the limit less the overlap. Every unit is joined to its farthest legal successor, the unit with which the next piece
begins, by one binary search over all units of a batch. Squaring that table again and again (1, 2, 4, ... pieces ahead)
marks the beginnings of all greedy pieces of all texts at once, in as many steps as the logarithm of the most pieces.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

LIMIT, OVERLAP = 1500, 200
_BLANK = re.compile(r"\n\s*\n")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_WORD = re.compile(r"\S+")


def _between(text: str, gaps: re.Pattern, low: int, high: int) -> Iterator[tuple[int, int]]:
    """Trimmed spans between the gaps, empty ones left out."""
    at = low
    for a, b in [*((m.start(), m.end()) for m in gaps.finditer(text, low, high)), (high, high)]:
        piece = text[at:a]
        left = len(piece) - len(piece.lstrip())
        body = len(piece.strip())
        if body:
            yield at + left, at + left + body
        at = b


def units(text: str, most: int, step: int = 1) -> tuple[str, np.ndarray, np.ndarray]:
    """(boundary, starts, ends) of the coarsest units of which none exceeds `most` characters; step: length of the units of
    a text cut by characters.

    A text of white space only has no unit: it counts as a paragraph and gets the whole text as its unit, cut by
    characters if it is too long. For `char` a unit is as many characters as divide every possible cut.
    """
    paragraphs = list(_between(text, _BLANK, 0, len(text)))
    kinds = (
        ("paragraph", lambda: paragraphs),
        ("sentence", lambda: [s for a, b in paragraphs for s in _between(text, _SENTENCE, a, b)]),
        ("word", lambda: [m.span() for m in _WORD.finditer(text)]),
    )
    for name, spans in kinds:
        found = spans()
        if found and all(b - a <= most for a, b in found):
            at = np.array(found, dtype=np.int64)
            return name, at[:, 0], at[:, 1]
    starts = np.arange(0, len(text), step, dtype=np.int64)
    return ("char" if paragraphs else "paragraph"), starts, np.minimum(starts + step, len(text))


def greedy_starts(starts: np.ndarray, ends: np.ndarray, first: np.ndarray, limit: int, overlap: int, origin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first units, units after the last) of all pieces, by pointer doubling.

    starts, ends: all units of all texts, in one coordinate; texts lie more than `limit` apart. first: index of each
    text's first unit. origin: coordinate at which each unit's text begins.
    """
    n = len(starts)
    reach = starts - np.minimum(overlap, starts - origin) + limit
    reach[first] = np.maximum(reach[first], starts[first] + limit)  # the first piece has none before it
    after = np.searchsorted(ends, reach, side="right")
    after = np.append(np.maximum(after, np.arange(n) + 1), n)
    marked = np.zeros(n + 1, dtype=bool)
    marked[first] = True
    table = after
    for _ in range(int(np.diff(np.append(first, n)).max(initial=1)).bit_length()):
        marked[table[np.flatnonzero(marked)]] = True
        table = table[table]  # twice as far
    begin = np.flatnonzero(marked[:n])
    return begin, after[begin]


def split_texts(texts: list[str], limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[str, list[str]]]:
    """Of each text (longer than limit) its boundary and its pieces; all pieces of all texts are found together.

    A piece holds at most `limit` characters: the `overlap` characters before its first unit, then whole units. The
    first piece has no overlap.
    """
    if not 0 <= overlap < limit:
        raise ValueError(f"an overlap of {overlap} characters leaves no room in pieces of {limit}")
    if not texts:
        return []
    found = [units(t, limit - overlap, math.gcd(limit, overlap)) for t in texts]
    base = np.cumsum([0, *(len(t) + 2 * limit for t in texts)])[:-1]
    count = np.array([len(f[1]) for f in found])
    first = np.cumsum(count) - count
    origin = np.repeat(base, count)
    starts = np.concatenate([f[1] for f in found]) + origin
    ends = np.concatenate([f[2] for f in found]) + origin
    begin, after = greedy_starts(starts, ends, first, limit, overlap, origin)
    owner = np.searchsorted(first, begin, side="right") - 1
    low = starts[begin] - base[owner]
    low = np.where(begin == first[owner], low, np.maximum(low - overlap, 0))
    high = ends[after - 1] - base[owner]
    out: list[tuple[str, list[str]]] = [(f[0], []) for f in found]
    for k, a, b in zip(owner.tolist(), low.tolist(), high.tolist(), strict=True):
        out[k][1].append(texts[k][a:b])
    return out


def section_name(c: Column) -> Column:
    """Item 1A, 1A and 1a are one section."""
    return F.regexp_replace(F.lower(F.trim(c)), r"^item\s+", "")


def _split_batches(limit: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                names = b.schema.names
                ids, texts = (b.column(names.index(c)).to_pylist() for c in ("chunk_id", "text"))
                rows: dict[str, list] = {"chunk_id": [], "boundary": [], "piece": [], "pieces": [], "text": []}
                for i, (boundary, pieces) in zip(ids, split_texts(texts, limit, overlap), strict=True):
                    n = len(pieces)
                    rows["chunk_id"] += [i] * n
                    rows["boundary"] += [boundary] * n
                    rows["piece"] += range(n)
                    rows["pieces"] += [n] * n
                    rows["text"] += pieces
                yield pa.record_batch({"chunk_id": pa.array(rows["chunk_id"], pa.string()), "boundary": pa.array(rows["boundary"], pa.string()), "piece": pa.array(rows["piece"], pa.int32()), "pieces": pa.array(rows["pieces"], pa.int32()), "text": pa.array(rows["text"], pa.string())})

    return run


_PIECES = T.StructType([T.StructField("chunk_id", T.StringType()), T.StructField("boundary", T.StringType()), T.StructField("piece", T.IntegerType()), T.StructField("pieces", T.IntegerType()), T.StructField("text", T.StringType())])


def oversized_pieces(chunks: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """Pieces of every text of more than `limit` characters: chunk_id, boundary, piece (from 0), pieces, text. Every piece
    but a text's first begins with the `overlap` characters before it, and none has more than `limit`.

    Rows are taken as they come (a repeated row gives its pieces again). Null texts and short texts give none.
    """
    return chunks.where(F.length("text") > limit).select("chunk_id", "text").mapInArrow(_split_batches(limit, overlap), _PIECES)


def recut_chunks(chunks: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, bucket: int = 512) -> DataFrame:
    """All chunks with oversized ones cut, and numbered anew within their filing's section.

    adsh, section (as section_name), chunk_index (new, from 0), chunk_id, piece, boundary (null if uncut), text, n_chars.
    Order within a section is that of the old chunk_index (nulls last), then chunk_id, then piece. Repeated rows count
    once. Numbers are counted in ranges of `bucket` old indexes, so no section is sorted by one task.
    """
    own = chunks.where("chunk_id is not null").groupBy("chunk_id").agg(*(F.first(c).alias(c) for c in ("adsh", "section", "chunk_index", "text")))
    cut = own.where(F.length("text") > limit)
    short = own.where(F.coalesce(F.length("text"), F.lit(0)) <= limit).select("chunk_id", F.lit(None).cast("string").alias("boundary"), F.lit(0).alias("piece"), F.lit(1).alias("pieces"), "text")
    pieces = oversized_pieces(cut, limit, overlap).unionByName(short)
    placed = pieces.join(own.select("chunk_id", "adsh", section_name(F.col("section")).alias("section"), F.coalesce("chunk_index", F.lit(2**31 - 1)).alias("old")), "chunk_id").withColumn("__range", F.floor(F.col("old") / bucket))
    counts = placed.groupBy("adsh", "section", "__range").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.withColumn("__before", F.sum("__n").over(Window.partitionBy("adsh", "section").orderBy("__range")) - F.col("__n")).drop("__n")
    place = F.row_number().over(Window.partitionBy("adsh", "section", "__range").orderBy("old", "chunk_id", "piece")) - 1
    b = before.select(F.col("adsh").alias("a"), F.col("section").alias("s"), F.col("__range").alias("r"), "__before")
    numbered = placed.withColumn("__place", place).join(b, F.col("adsh").eqNullSafe(F.col("a")) & F.col("section").eqNullSafe(F.col("s")) & (F.col("__range") == F.col("r")))
    return numbered.select("adsh", "section", (F.col("__before") + F.col("__place")).alias("chunk_index"), "chunk_id", "piece", "boundary", "text", F.length("text").alias("n_chars"))
