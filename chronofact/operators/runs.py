"""Whole key groups out of Arrow batches of sorted partitions.

A partition sorted by its keys is read batch by batch; the rows of a key that may go on in the next batch are held back.
Memory is bounded by one batch and the rows of one key, whatever the size of the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def whole_keys(batches: Iterator[pa.RecordBatch], keys: list[str], least_rows: int = 20_000) -> Iterator[pa.Table]:
    """Tables of at least least_rows rows (but the last) in which every key is complete."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        rows += b.num_rows
        if rows < least_rows:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        at = _last_start(t, keys)
        if at:
            yield t.slice(0, at)
            t = t.slice(at)
        held, rows = t.combine_chunks().to_batches(), t.num_rows if at else 0
        if not at:  # one key only so far: double the patience, so that a large key is not copied again and again
            least_rows *= 2
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    """Mask of rows at which a new key begins (null is a key like any other)."""
    n = t.num_rows
    new = np.zeros(n, dtype=bool)
    if not n:
        return new
    new[0] = True
    for k in keys:
        c = t.column(k)
        c = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
        codes = c.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return new


def _last_start(t: pa.Table, keys: list[str]) -> int:
    return int(np.flatnonzero(starts(t, keys))[-1])
