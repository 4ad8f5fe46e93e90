"""Dense retrieval, rank fusion and retrieval metrics."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Reciprocal rank fusion: constant, and candidates taken from each side.
RRF_K, CANDIDATES = 60, 30
#: Query vectors that go over the table in one scan: so many, and no more than QUERY_BYTES; scored SCORED at a time.
QUERY_BLOCK, QUERY_BYTES, SCORED = 65_536, 64 << 20, 512


def matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """Unit vectors of a list column, straight from its buffer (null components become 0); zero vectors stay zero."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    x = np.nan_to_num(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), nan=0.0, posinf=0.0, neginf=0.0).reshape(-1, dims)
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, n, out=np.zeros_like(x), where=n > 0)


def _first_k(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k greatest of each row, in order of column; of equal ones the first."""
    k = min(k, scores.shape[1])
    least = np.partition(scores, -k, axis=1)[:, -k:].min(axis=1, keepdims=True)
    equal = scores == least
    room = k - (scores > least).sum(axis=1, keepdims=True)
    return np.nonzero((scores > least) | (equal & (np.cumsum(equal, axis=1) <= room)))[1].reshape(-1, k)


def dense_topk(vectors: DataFrame, queries: DataFrame, k: int, dims: int) -> DataFrame:
    """query_id, id, score, rank: the k vectors nearest each query by cosine; ties by id.

    vectors: id (bigint or string), embedding; queries: query_id, embedding. Vectors that are null or of other dims are left
    out; a zero vector has cosine 0, a component that is no number counts as 0. Query vectors are broadcast in blocks of a
    bounded size, one scan of the vectors each; a task keeps its k best per query over all its batches, so k rows per query
    and task are shuffled, and never all pairs.
    """
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)["id"]
    usable = vectors.where(F.size("embedding") == dims).select("id", "embedding")
    asked = queries.where((F.size("embedding") == dims) & F.col("query_id").isNotNull()).select("query_id", "embedding")
    schema = f"query_id {dict(queries.dtypes)['query_id']}, id {kind}, score double"
    n = asked.count()
    scans = -(-n // max(1, min(QUERY_BLOCK, QUERY_BYTES // (8 * dims))))

    def scored(part: DataFrame) -> DataFrame:
        block = part.toArrow()  # about n / scans rows
        q = spark.sparkContext.broadcast((block.column("query_id").combine_chunks(), matrix(block.column("embedding"), dims)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, m = q.value
            best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty((len(m[i : i + SCORED]), 0)), np.empty((len(m[i : i + SCORED]), 0), dtype=object)) for i in range(0, len(m), SCORED)]
            for b in batches:
                if not b.num_rows:
                    continue
                ids = np.array(b.column(0).to_pylist(), dtype=object)
                order = np.argsort(ids, kind="stable")
                ids, x = ids[order], matrix(b.column(1), dims)[order]
                for at, (scores, found) in enumerate(best):
                    s = np.round(m[at * SCORED : (at + 1) * SCORED] @ x.T, 12)
                    top = _first_k(s, k)
                    s, i = np.concatenate([scores, np.take_along_axis(s, top, 1)], axis=1), np.concatenate([found, ids[top]], axis=1)
                    by_id = np.argsort(i, axis=1, kind="stable")
                    s, i = np.take_along_axis(s, by_id, 1), np.take_along_axis(i, by_id, 1)
                    top = _first_k(s, k)
                    best[at] = np.take_along_axis(s, top, 1), np.take_along_axis(i, top, 1)
            for at, (scores, found) in enumerate(best):
                if found.shape[1]:
                    rows = np.repeat(np.arange(len(found)) + at * SCORED, found.shape[1])
                    yield pa.RecordBatch.from_arrays([names.take(pa.array(rows)), pa.array(found.ravel().tolist(), b.schema.field(0).type), pa.array(scores.ravel())], names=["query_id", "id", "score"])

        return usable.mapInArrow(run, schema)

    found = spark.createDataFrame([], schema)
    for i in range(scans):
        part = scored(asked if scans == 1 else asked.where(F.pmod(F.xxhash64("query_id"), F.lit(scans)) == i))
        found = part if not i else found.unionByName(part)
    return ranked(found, k)


def dense_topk_within(vectors: DataFrame, queries: DataFrame, by: str, k: int, dims: int) -> DataFrame:
    """dense_topk where a query meets only the vectors with its value of the column `by`: one join and one pass."""
    kind = {c: t for c, t in vectors.dtypes}["id"]
    pairs = queries.where(F.size("embedding") == dims).select("query_id", by, F.col("embedding").alias("asked")).join(vectors.where(F.size("embedding") == dims).select("id", by, "embedding"), by).select("query_id", "id", "asked", "embedding")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.einsum("ij,ij->i", matrix(b.column(2), dims), matrix(b.column(3), dims)) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.round(s, 12), pa.float64())], names=["query_id", "id", "score"])

    return ranked(pairs.mapInArrow(run, f"query_id {dict(queries.dtypes)['query_id']}, id {kind}, score double"), k)


def ranked(scores: DataFrame, k: int) -> DataFrame:
    """rank from 1 within each query: score descending, then id; only the first k."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def rrf(lists: list[DataFrame], k: int, constant: int = RRF_K) -> DataFrame:
    """Fused rank of several ranked lists (query_id, id, rank): the sum of 1 / (constant + rank).

    Ties keep the better place of the earlier list, then the id.
    """
    all_rows = None
    for at, x in enumerate(lists):
        part = x.select("query_id", "id", "rank", F.lit(at).alias("list"))
        all_rows = part if all_rows is None else all_rows.unionByName(part)
    fused = all_rows.groupBy("query_id", "id").agg(F.sum(1.0 / (constant + F.col("rank"))).alias("score"), F.min(F.struct("list", "rank")).alias("best"))
    fused = fused.withColumn("score", F.round("score", 12))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "best.list", "best.rank", "id")
    return fused.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "id", "score", "rank")


def known_item_metrics(hits: DataFrame, expected: DataFrame) -> DataFrame:
    """One row of n, recall at 1 and 5, and mean reciprocal rank within the first five.

    hits: query_id, id, rank; expected: query_id, id. A query without its item within five counts 0.
    """
    place = expected.join(hits.where("rank <= 5").groupBy("query_id", "id").agg(F.min("rank").alias("rank")), ["query_id", "id"], "left")
    return place.agg(
        F.count(F.lit(1)).alias("n_known_item"),
        F.round(F.coalesce(F.avg(F.when(F.col("rank") == 1, 1.0).otherwise(0.0)), F.lit(0.0)), 4).alias("recall_at_1"),
        F.round(F.coalesce(F.avg(F.when(F.col("rank") <= 5, 1.0).otherwise(0.0)), F.lit(0.0)), 4).alias("recall_at_5"),
        F.round(F.coalesce(F.avg(F.coalesce(1.0 / F.col("rank"), F.lit(0.0))), F.lit(0.0)), 4).alias("mrr"),
    )


def hit_rate(hits: DataFrame, wanted: DataFrame, k: int = 5) -> DataFrame:
    """Share of queries with the wanted section among the first k (null without queries). hits: query_id, section, rank."""
    found = hits.where(F.col("rank") <= k).join(wanted.select("query_id", F.col("section")), ["query_id", "section"], "left_semi").select("query_id").distinct().withColumn("hit", F.lit(1.0))
    return wanted.join(found, "query_id", "left").agg(F.count(F.lit(1)).alias("n_section_intent"), F.round(F.avg(F.coalesce("hit", F.lit(0.0))), 4).alias("section_hit_at_5"))


def _steps(values: DataFrame, column: str, n: int, wanted: dict[str, float]) -> dict[str, float]:
    """Values at ranks by repeated halving of the range: each round counts the rows below a few points in one aggregate."""
    low, high = values.agg(F.min(column), F.max(column)).first()
    inside = {name: (float(low), float(high)) for name in wanted}
    rank = {name: min(int(n * q), n - 1) for name, q in wanted.items()}
    while True:
        open_ = [name for name, (a, b) in inside.items() if a < b]
        if not open_:
            return {name: a for name, (a, _) in inside.items()}
        # of every open range 15 points, evenly among the doubles; the first with more than `rank` rows up to it bounds the value
        points = {name: sorted({_double(lo + (hi - lo) * i // 16) for i in range(16) for lo, hi in [(_place(inside[name][0]), _place(inside[name][1]))]}) for name in open_}
        c = F.col(column)
        counts = values.agg(*(F.count_if(c <= x).alias(f"{name}|{i}") for name in open_ for i, x in enumerate(points[name])), *(F.min(F.when(c > x, c)).alias(f"{name}>{i}") for name in open_ for i, x in enumerate(points[name])), *(F.max(F.when(c <= x, c)).alias(f"{name}<{i}") for name in open_ for i, x in enumerate(points[name]))).first()
        for name in open_:
            a, b = inside[name]
            for i, x in enumerate(points[name]):
                if counts[f"{name}|{i}"] > rank[name]:
                    b = counts[f"{name}<{i}"]
                    break
                a = counts[f"{name}>{i}"]
            inside[name] = (a, b)


def _place(x: float) -> int:
    """Number of a double in the order of all doubles."""
    bits = struct.unpack("<q", struct.pack("<d", x + 0.0))[0]
    return bits if bits >= 0 else -(bits & 0x7FFFFFFFFFFFFFFF)


def _double(place: int) -> float:
    return struct.unpack("<d", struct.pack("<q", place))[0] if place >= 0 else -struct.unpack("<d", struct.pack("<q", -place))[0]


def index_percentiles(df: DataFrame, column: str, quantiles: dict[str, float]) -> DataFrame:
    """The value at index int(n * q) of the sorted values, without interpolation; null values and NaN don't count.

    Nothing is sorted: the range that holds the value is narrowed by aggregates over all rows, each with constant state,
    until its ends meet. One row; null for an empty column.
    """
    values = df.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))).select(F.col(column).cast("double").alias("v"))
    spark, n = df.sparkSession, values.count()
    found = _steps(values, "v", n, quantiles) if n else dict.fromkeys(quantiles)
    kind = dict(df.dtypes)[column]
    return spark.range(1).select(*(F.lit(found[name]).cast(kind).alias(name) for name in quantiles))
