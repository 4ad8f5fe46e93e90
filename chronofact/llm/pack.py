"""Filling containers of fixed capacity with items, by exact-complement hashing.

Sizes are whole numbers up to the capacity, so all that matters is how many items have each size: a histogram of at most
`capacity` rows, whatever the number of items. On it the plan is made: sums of one, two and three sizes are indexed, and
combinations that exactly fill the gap beside a larger item are consumed while there are items of their sizes; what is
left goes best-fit. The plan (combinations with their numbers of containers) is then given to the items by their rank
within their size, which is counted in salted buckets, so a size shared by a third of all items is no hot key.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chronofact.llm.tokens import VOCABULARY, with_tokens
from chronofact.session import cut

CAPACITY = 1800


@dataclass
class Group:
    """Containers alike: the sizes each holds (descending) and how many there are."""

    sizes: tuple[int, ...]
    containers: int


def plan(histogram: dict[int, int], capacity: int) -> list[Group]:
    """Groups of containers that hold all items of the histogram (sizes from 1 to capacity)."""
    have = np.zeros(capacity + 1, dtype=np.int64)
    for size, n in histogram.items():
        if not 1 <= size <= capacity:
            raise ValueError(f"size {size} is not within 1 and {capacity}")
        have[size] += n
    groups: list[Group] = []

    def take(sizes: tuple[int, ...]) -> int:
        """Consume the combination as often as there are items for it."""
        need = Counter(sizes)
        n = min(int(have[s]) // k for s, k in need.items())
        if n > 0:
            for s, k in need.items():
                have[s] -= n * k
            groups.append(Group(tuple(sorted(sizes, reverse=True)), n))
        return n

    for large in range(capacity, 0, -1):
        if not have[large]:
            continue
        gap = capacity - large
        if not gap:
            take((large,))
            continue
        if gap <= large:
            take((large, gap))
        # pairs, the larger part as large as can be
        while have[large]:
            b = np.arange(min(gap - 1, large), (gap - 1) // 2, -1)
            a = gap - b
            ok = (have[b] > 0) & (have[a] > 0)
            done = [take((large, int(y), int(x))) for y, x in zip(b[ok], a[ok], strict=True)]
            if not any(done):
                break
        # triples over the index of pair sums
        for c in range(min(gap - 2, large), (gap - 1) // 3, -1):
            if not have[large]:
                break
            if not have[c]:
                continue
            rest = gap - c
            b = np.arange(min(rest - 1, c), (rest - 1) // 2, -1)
            a = rest - b
            ok = (have[b] > 0) & (have[a] > 0)
            for y, x in zip(b[ok], a[ok], strict=True):
                if not have[large] or not have[c]:
                    break
                take((large, c, int(y), int(x)))
    return groups + _best_fit(have, capacity)


def _best_fit(have: np.ndarray, capacity: int) -> list[Group]:
    """Best fit, the largest first, whole runs of equal items and equal containers at a time."""
    by_gap: dict[int, list[Group]] = {}
    gaps = np.zeros(capacity + 1, dtype=np.int64)

    def put(gap: int, g: Group) -> None:
        by_gap.setdefault(gap, []).append(g)
        gaps[gap] += g.containers

    for size in range(capacity, 0, -1):
        left = int(have[size])
        while left:
            fitting = np.flatnonzero(gaps[size:])
            if not len(fitting):  # new containers, each with as many of this size as go in
                each = capacity // size
                whole = left // each
                if whole:
                    put(capacity - each * size, Group((size,) * each, whole))
                if left % each:
                    put(capacity - left % each * size, Group((size,) * (left % each), 1))
                break
            gap = size + int(fitting[0])
            g = by_gap[gap].pop()
            n = min(left, g.containers)
            gaps[gap] -= g.containers
            if n < g.containers:
                put(gap, Group(g.sizes, g.containers - n))
            put(gap - size, Group((*g.sizes, size), n))
            left -= n
    return [g for gs in by_gap.values() for g in gs]


def fitted(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """The plan by size: (size, first rank, end rank, first container, items of this size per container)."""
    used: Counter[int] = Counter()
    rows, container = [], 0
    for g in plan(histogram, capacity):
        for size, k in Counter(g.sizes).items():
            rows.append((size, used[size], used[size] + k * g.containers, container, k))
            used[size] += k * g.containers
        container += g.containers
    return rows


def ranked(items: DataFrame, size: str, order: str, bucket_rows: int = 100_000) -> DataFrame:
    """items with `rank`, from 0, within each size; no task sorts more than about bucket_rows items of one size."""
    largest = items.groupBy(size).count().agg(F.max("count")).first()[0] or 0
    salts = max(1, -(-largest // bucket_rows))
    salted = items.withColumn("__salt", F.pmod(F.xxhash64(order), F.lit(salts)))
    counts = salted.groupBy(size, "__salt").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select(size, "__salt", (F.sum("__n").over(Window.partitionBy(size).orderBy("__salt")) - F.col("__n")).alias("__before"))
    place = F.row_number().over(Window.partitionBy(size, "__salt").orderBy(order)) - 1
    return salted.withColumn("__place", place).join(before, [size, "__salt"]).withColumn("rank", F.col("__place") + F.col("__before")).drop("__salt", "__place", "__before")


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Containers for items (item_id bigint, size bigint): item_id, piece, pieces, from_unit, to_unit, size, container.

    An item beyond the capacity is cut into full pieces and a rest; the full pieces fill a container each, the rest is
    packed like any item. Items of no or null size take no room and no container (container is null, pieces 0). Ids must
    be unique. An empty input gives no rows.
    """
    spark = items.sparkSession
    n = F.coalesce(F.col("size"), F.lit(0))
    cutted = items.select("item_id", n.alias("total"), F.ceil(n / capacity).cast("int").alias("pieces"))
    part = cutted.withColumn("piece", F.explode_outer(F.when(F.col("pieces") > 0, F.sequence(F.lit(1), F.col("pieces"))))).select(
        "item_id", "piece", "pieces", ((F.col("piece") - 1).cast("bigint") * capacity).alias("from_unit"), F.least(F.col("piece").cast("bigint") * capacity, F.col("total")).alias("to_unit")
    )
    part = cut(part.withColumn("size", F.coalesce(F.col("to_unit") - F.col("from_unit"), F.lit(0)).cast("int")), "pieces")
    packed = part.where("size between 1 and " + str(capacity - 1))
    # at most `capacity` rows come to the driver
    histogram = {r["size"]: r["n"] for r in packed.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = fitted(histogram, capacity)
    slots = spark.createDataFrame(rows, "size int, low bigint, high bigint, first bigint, each int")
    used = max((r[3] + (r[2] - r[1]) // r[4] for r in rows), default=0)
    # slots: a few per size, bounded by the capacity and not by the items
    placed = (
        ranked(packed, "size", "item_id")
        .join(F.broadcast(slots), "size")
        .where((F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
        .select("item_id", "piece", "pieces", "from_unit", "to_unit", "size", (F.col("first") + F.floor((F.col("rank") - F.col("low")) / F.col("each"))).alias("container"))
    )
    full = ranked(part.where(f"size = {capacity}").withColumn("__id", F.struct("item_id", "piece")), "size", "__id").select("item_id", "piece", "pieces", "from_unit", "to_unit", "size", (F.col("rank") + used).alias("container"))
    none = part.where("size = 0").select("item_id", "piece", "pieces", "from_unit", "to_unit", "size", F.lit(None).cast("bigint").alias("container"))
    return placed.unionByName(full).unionByName(none)


def packed_documents(documents: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """Containers of documents by tokens (columns of pack, item_id as doc_id, units are tokens)."""
    sizes = with_tokens(documents.where("doc_id is not null"), "text", ["doc_id"], vocabulary)
    return pack(sizes.select(F.col("doc_id").alias("item_id"), F.col("n_tokens").alias("size")), capacity).withColumnRenamed("item_id", "doc_id")


def container_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: containers, containers exactly full, tokens, share of unused space, the largest container."""
    each = packed.where("container is not null").groupBy("container").agg(F.sum("size").alias("filled"), F.count(F.lit(1)).alias("items"))
    return each.agg(
        F.count(F.lit(1)).alias("n_containers"),
        F.coalesce(F.sum(F.when(F.col("filled") == capacity, 1)), F.lit(0)).alias("n_full"),
        F.sum("filled").alias("n_tokens"),
        F.round(1 - F.sum("filled") / (F.count(F.lit(1)) * capacity), 6).alias("unused_share"),
        F.max("filled").alias("largest"),
    )
