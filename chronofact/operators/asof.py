"""Attributes as known at event time, by path-copied persistent search trees.

Each entity has one tree over its versions' valid-time ranks. Inserting the versions in the order in which they became
known copies the path from the root to one leaf and keeps every earlier root: root k is the entity as it was known after
its k-th version. An event takes the last root not younger than its known time and searches that tree for the rightmost
leaf that starts at or before its valid time and ends after it; nodes carry the latest valid_to below them, so the search
never leaves its path more than once. Trees of a whole batch of entities are built and searched together, level by level.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofact.operators.runs import starts, whole_keys
from chronofact.session import shuffle_partitions

#: Hot keys are broadcast up to this many.
HOT_BROADCAST = 100_000
#: Composite of entity and day: more than the days of all dates, and a shift that makes days before 1970 positive.
_SPAN, _SHIFT = 1 << 24, 1 << 23


class PersistentTrees:
    """Persistent trees of many entities; entity codes ascend, every entity's versions are contiguous.

    known, start and end are days, sorted by (entity, known) with known ties in insertion order.
    """

    def __init__(self, entity: np.ndarray, known: np.ndarray, start: np.ndarray, end: np.ndarray):
        n = len(entity)
        self.known_at = entity * _SPAN + _SHIFT + known
        by_start = np.lexsort((np.arange(n), start, entity))
        self.start_at = (entity * _SPAN + _SHIFT + start)[by_start]
        first = np.flatnonzero(np.append(True, entity[1:] != entity[:-1])) if n else np.zeros(0, dtype=np.int64)
        size = np.diff(np.append(first, n))
        at = np.repeat(first, size)  # where the version's entity begins
        order = np.arange(n) - at  # insertion number
        rank = np.empty(n, dtype=np.int64)
        rank[by_start] = np.arange(n) - at  # entities are contiguous in either order
        depth = np.zeros(len(size), dtype=np.int64)
        while ((1 << depth) < size).any():
            depth += (1 << depth) < size
        self.depth = np.repeat(depth, size)
        # nodes: node 0 is empty; every version adds depth + 1 nodes, one per level, root first
        width = self.depth + 1
        self.root = np.cumsum(width) - width + 1
        total = int(width.sum()) + 1
        self.left, self.right = np.zeros(total, dtype=np.int64), np.zeros(total, dtype=np.int64)
        self.latest, self.payload = np.full(total, -_SPAN, dtype=np.int64), np.full(total, -1, dtype=np.int64)
        by_order = np.argsort(order, kind="stable")
        cuts = np.searchsorted(order[by_order], np.arange(int(size.max(initial=0)) + 1))
        for k in range(len(cuts) - 1):
            self._insert(by_order[cuts[k] : cuts[k + 1]], k, rank, end)
        self.first_of = dict(zip(entity[first].tolist(), first.tolist(), strict=True)) if n else {}
        self.start_of_entity, self.entities = first, entity[first]

    def _insert(self, rows: np.ndarray, k: int, rank: np.ndarray, end: np.ndarray) -> None:
        """The k-th version of every entity that has one: copy the path, point at the copies."""
        old = self.root[rows - 1] if k else np.zeros(len(rows), dtype=np.int64)
        depth, node = self.depth[rows], self.root[rows]
        for level in range(int(depth.max(initial=0)) + 1):
            inner = depth > level
            leaf = depth == level
            self.payload[node[leaf]] = rows[leaf]
            self.latest[node[leaf]] = end[rows[leaf]]
            if not inner.any():
                break
            rows, node, old, depth = rows[inner], node[inner], old[inner], depth[inner]
            right = (rank[rows] >> (depth - 1 - level)) & 1 == 1
            self.left[node] = np.where(right, self.left[old], node + 1)
            self.right[node] = np.where(right, node + 1, self.right[old])
            # what lies below the copy: the old subtree and the new leaf
            self.latest[node] = np.maximum(self.latest[old], end[rows])
            old = np.where(right, self.right[old], self.left[old])
            node = node + 1

    def find(self, entity: np.ndarray, known: np.ndarray, valid: np.ndarray) -> np.ndarray:
        """Of each event the row of its version, or -1."""
        found = np.full(len(entity), -1, dtype=np.int64)
        if not len(self.known_at) or not len(entity):
            return found
        low = np.searchsorted(self.known_at, entity * _SPAN)
        k = np.searchsorted(self.known_at, entity * _SPAN + _SHIFT + known, side="right") - low
        r = np.searchsorted(self.start_at, entity * _SPAN + _SHIFT + valid, side="right") - low
        ask = np.flatnonzero((k > 0) & (r > 0))
        rows = low[ask] + k[ask] - 1
        node, depth, target, day = self.root[rows], self.depth[rows], r[ask] - 1, valid[ask]
        # down along the path of the last rank not after the event; keep the last left sibling that may hold it
        other, other_level = np.zeros(len(ask), dtype=np.int64), np.zeros(len(ask), dtype=np.int64)
        for level in range(int(depth.max(initial=0))):
            go = (depth > level) & (node > 0)
            right = go & ((target >> np.maximum(depth - 1 - level, 0)) & 1 == 1)
            sibling = np.where(right, self.left[node], 0)
            hit = (sibling > 0) & (self.latest[sibling] > day)
            other, other_level = np.where(hit, sibling, other), np.where(hit, level + 1, other_level)
            node = np.where(go, np.where(right, self.right[node], self.left[node]), node)
        direct = (node > 0) & (self.latest[node] > day)
        found[ask[direct]] = self.payload[node[direct]]
        # the others: rightmost leaf below the kept sibling that ends after the day
        left = ~direct & (other > 0)
        ask, node, level, depth, day = ask[left], other[left], other_level[left], depth[left], day[left]
        while True:
            go = level < depth
            if not go.any():
                break
            right = go & (self.latest[self.right[node]] > day) & (self.right[node] > 0)
            node = np.where(go, np.where(right, self.right[node], self.left[node]), node)
            level = np.where(go, level + 1, level)
        found[ask] = self.payload[node]
        return found


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in whole_keys(batches, ["key", "slice"]):
        entity = np.cumsum(starts(t, ["key", "slice"])).astype(np.int64)
        col = {c: t.column(c).to_numpy() for c in ("kind", "known", "start", "end", "id")}
        v = np.flatnonzero(col["kind"] == 0)
        e = np.flatnonzero(col["kind"] == 1)
        if not len(e) or not len(v):
            continue
        trees = PersistentTrees(entity[v], *(col[c][v].astype(np.int64) for c in ("known", "start", "end")))
        at = trees.find(entity[e], col["known"][e].astype(np.int64), col["start"][e].astype(np.int64))
        hit = at >= 0
        out = pa.record_batch({"event_id": pa.array(col["id"][e][hit], pa.int64()), "version_no": pa.array(col["id"][v][at[hit]], pa.int64())})
        if out.num_rows:
            yield out


def attributes_as_of(events: DataFrame, versions: DataFrame, hot: int = 50_000) -> DataFrame:
    """The version of each event's entity that was known and valid at the event's times.

    events: event_id (bigint), key, known, valid (dates). versions: key, version_no (bigint), known, valid_from, valid_to
    (dates), one row per (key, version_no). Result: event_id, version_no; an event without such a version has no row.
    Of several versions that hold, the one that starts last (ties: known last, then the larger number) is taken. Nulls in
    keys, dates or ids never match; empty windows never match.
    Only versions of keys that are asked for go to the trees. Keys with more than `hot` events are cut into slices: the
    events are spread, the key's versions copied to each slice. The list of such keys is broadcast while it has no more
    than HOT_BROADCAST rows (counted), joined by shuffle beyond.
    """
    spark = events.sparkSession
    asked = events.select("event_id", "key", "known", "valid").where(" and ".join(f"{c} is not null" for c in ("event_id", "key", "known", "valid")))
    usable = versions.select("key", "version_no", "known", "valid_from", "valid_to").where("key is not null and version_no is not null and known is not null and valid_from < valid_to")
    per_key = asked.groupBy("key").agg(F.count(F.lit(1)).alias("n")).select("key", F.ceil(F.col("n") / hot).cast("int").alias("slices"))
    n = shuffle_partitions(spark)
    # every event of a key below the limit is in slice 0; a join for the number of slices is needed for the hot ones only
    many = per_key.where("slices > 1")
    few = many.count() <= HOT_BROADCAST
    e = asked.join(F.broadcast(many) if few else many, "key", "left").select("key", F.when(F.col("slices").isNull(), 0).otherwise(F.pmod(F.xxhash64("event_id"), F.col("slices"))).cast("int").alias("slice"), F.lit(1).alias("kind"), F.unix_date("known").alias("known"), F.unix_date("valid").alias("start"), F.lit(0).alias("end"), F.col("event_id").alias("id"))
    v = usable.join(per_key, "key").select("key", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.lit(0).alias("kind"), F.unix_date("known").alias("known"), F.unix_date("valid_from").alias("start"), F.unix_date("valid_to").alias("end"), F.col("version_no").alias("id"))
    both = v.unionByName(e).repartition(n, "key", "slice").sortWithinPartitions("key", "slice", "kind", "known", "start", "id")
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("version_no", T.LongType())])
    return both.mapInArrow(_answer, schema)


def fact_versions_as_known(comparisons: DataFrame, fact_versions: DataFrame) -> DataFrame:
    """Of each comparison the version of its base fact as known on its date (comparison_id, version_no).

    A version listed several times holds until its earliest valid_to. Repeated comparisons count once.
    """
    events = comparisons.select(F.col("comparison_id").alias("event_id"), F.col("base_fact_key").alias("key"), F.col("knowledge_date").alias("known"), F.col("knowledge_date").alias("valid")).distinct()
    versions = (
        fact_versions.where("fact_key is not null and version_no is not null")
        .groupBy(F.col("fact_key").alias("key"), "version_no")
        .agg(F.min("valid_from").alias("valid_from"), F.min("valid_to").alias("valid_to"))
        .withColumn("known", F.col("valid_from"))
    )
    return attributes_as_of(events, versions).withColumnRenamed("event_id", "comparison_id").distinct()
