"""Mixing sources to target weights, by a multivariate-hypergeometric splitting tree.

A source's records are dealt into blocks by hash (a random permutation cut into blocks). A mix needs so many blocks of
each source, pass by pass up to the cap on repeats. The quotas of blocks are split among output shards by a binary tree:
each node draws the left half's share of every source from the multivariate hypergeometric distribution, so the shards'
quotas add up exactly and are as random as a full shuffle would make them. Blocks go to shards disjointly, and each shard
is shuffled for itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chronofact.llm.tokens import VOCABULARY, with_tokens
from chronofact.session import cut

#: Records per block, tokens per output shard. Both stay as they are however large the sources and mixes become.
BLOCK_RECORDS, SHARD_TOKENS = 128, 2_000_000
#: Blocks that one task orders when the blocks of a source are laid in a row.
ROW_BLOCKS = 65_536


def source_name(c: Column) -> Column:
    """Sources match regardless of case and of blanks around them."""
    return F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))


def split_quotas(quotas: list[int], shards: int, seed: int) -> np.ndarray:
    """Blocks of each source per shard (shards x sources); columns add up to the quotas, rows differ by one in total."""
    out = np.zeros((shards, len(quotas)), dtype=np.int64)
    rng = np.random.default_rng(seed)
    stack = [(0, shards, np.asarray(quotas, dtype=np.int64))]
    while stack:
        low, high, have = stack.pop()
        if high - low == 1:
            out[low] = have
            continue
        middle = (low + high) // 2
        total = int(have.sum())
        # the left half's part of the blocks, in proportion to its shards
        sample = total * (middle - low) // (high - low)
        left = rng.multivariate_hypergeometric(have, sample, method="marginals") if total else np.zeros_like(have)
        stack += [(low, middle, left), (middle, high, have - left)]
    return out


def mix_report(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per mix and source: what it should give, what it has, what it gives and the share reached.

    sizes: source (as source_name), n_tokens. targets: mix_id, source, target_share, max_repeats, total_vs_corpus. The
    quota is target_share of the mix's total; a source gives its quota, or all its tokens max_repeats times where that is
    less (falls_short). The share reached refers to the mix's target total. Sources no record has count as empty.
    """
    per = sizes.groupBy("source").agg(F.sum("n_tokens").alias("source_tokens"), F.count(F.lit(1)).alias("source_records"))
    corpus = sizes.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("corpus_tokens"))
    t = targets.select("mix_id", F.col("source").alias("named"), source_name(F.col("source")).alias("source"), "target_share", "max_repeats", "total_vs_corpus").distinct()
    return (
        t.crossJoin(F.broadcast(corpus))  # one row
        .join(per, "source", "left")
        .select(
            "mix_id",
            F.col("named").alias("source"),
            F.col("source").alias("source_key"),
            "target_share",
            "max_repeats",
            (F.col("total_vs_corpus") * F.col("corpus_tokens")).alias("total_tokens"),
            F.coalesce("source_tokens", F.lit(0)).alias("source_tokens"),
            F.coalesce("source_records", F.lit(0)).alias("source_records"),
        )
        .withColumn("quota_tokens", F.col("target_share") * F.col("total_tokens"))
        .withColumn("most_tokens", F.col("source_tokens") * F.col("max_repeats"))
        .withColumn("falls_short", F.col("most_tokens") < F.col("quota_tokens"))
        .withColumn("given_tokens", F.least(F.col("most_tokens").cast("double"), F.col("quota_tokens")))
        .withColumn("reachable_share", F.when(F.col("total_tokens") > 0, F.col("given_tokens") / F.col("total_tokens")))
    )


def laid_in_a_row(blocks: DataFrame, most: int) -> DataFrame:
    """blocks with blocks_before and tokens_before: those before it in the order of h within its mix, source and pass.

    blocks: mix_id, source, repeat, block, tokens, h (a hash) and others. A pass of more than ROW_BLOCKS blocks (most: the
    largest number) is cut into stretches of h, which are summed first, so that no task orders a whole source.
    """
    key = ["mix_id", "source", "repeat"]
    bits = max(0, most // ROW_BLOCKS).bit_length()
    stretch = F.shiftright("h", 64 - bits) if bits else F.lit(0).cast("bigint")
    rows = blocks.withColumn("stretch", stretch)
    inside = Window.partitionBy(*key, "stretch").orderBy("h", "block")
    rows = rows.withColumns({"blocks_before": F.row_number().over(inside) - 1, "tokens_before": F.sum("tokens").over(inside) - F.col("tokens")})
    if not bits:
        return rows.drop("stretch", "h")
    along = Window.partitionBy(*key).orderBy("stretch")
    sums = blocks.withColumn("stretch", stretch).groupBy(*key, "stretch").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t"))
    before = sums.select(*key, "stretch", (F.sum("n").over(along) - F.col("n")).alias("n0"), (F.sum("t").over(along) - F.col("t")).alias("t0"))
    joined = rows.join(before, [*key, "stretch"])
    return joined.withColumns({"blocks_before": F.col("blocks_before") + F.col("n0"), "tokens_before": F.col("tokens_before") + F.col("t0")}).drop("stretch", "h", "n0", "t0")


def _deal(ends):
    """Shard of every drawn block: the first whose last block number lies beyond it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = dict(zip(b.schema.names, b.columns, strict=True))
            mixes, sources, number = c["mix_id"].to_pylist(), c["source"].to_pylist(), c["number"].to_numpy(zero_copy_only=False)
            shard = np.empty(b.num_rows, dtype=np.int32)
            keys = list(zip(mixes, sources, strict=True))
            codes: dict[tuple, int] = {}
            code = np.array([codes.setdefault(k, len(codes)) for k in keys], dtype=np.int64)
            for k, i in codes.items():
                at = code == i
                shard[at] = np.searchsorted(ends.value[k], number[at], side="right")
            yield pa.RecordBatch.from_arrays([c["mix_id"], c["source"], c["repeat"], c["block"], pa.array(shard, pa.int32()), c["room"], c["tokens"]], names=["mix_id", "source", "repeat", "block", "shard", "room", "block_tokens"])

    return run


def mix(records: DataFrame, targets: DataFrame, seed: int = 7) -> DataFrame:
    """The mixed records: mix_id, shard, place (within the shard), doc_id, source, repeat (from 0), n_tokens.

    records: doc_id, source (as source_name), n_tokens. A source's last record may pass its quota, so a share is met
    within one record. Records without tokens carry nothing and are left out; null sources only count in the total.
    """
    spark = records.sparkSession
    report = mix_report(records, targets)
    # a row per mix and source of the targets table
    plan = report.where("source_tokens > 0 and given_tokens > 0").select("mix_id", "source_key", "max_repeats", "total_tokens", "source_tokens", "source_records", "given_tokens").collect()
    if not plan:
        return spark.createDataFrame([], "mix_id int, shard int, place bigint, doc_id bigint, source string, repeat int, n_tokens bigint")
    n_blocks = {r["source_key"]: max(1, -(-r["source_records"] // BLOCK_RECORDS)) for r in plan}
    of = F.create_map(*[F.lit(x) for kv in n_blocks.items() for x in kv])
    rows = records.where(F.col("n_tokens") > 0).where(F.col("source").isin(list(n_blocks))).withColumn("block", F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), of[F.col("source")]).cast("int"))
    rows = cut(rows.select("doc_id", "source", "block", "n_tokens"), "blocks")
    blocks = rows.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens"))
    passes = spark.createDataFrame(
        [(r["mix_id"], r["source_key"], p, p * r["source_tokens"], float(r["given_tokens"])) for r in plan for p in range(min(r["max_repeats"], -int(-r["given_tokens"] // r["source_tokens"])))],
        "mix_id int, source string, repeat int, before bigint, given double",
    )
    # order of the blocks in each pass: a permutation by hash; blocks beyond the quota are not drawn
    laid = laid_in_a_row(blocks.join(F.broadcast(passes), "source").withColumn("h", F.xxhash64("mix_id", "source", "repeat", "block", F.lit(seed))), max(n_blocks.values()))
    drawn = laid.withColumn("room", F.col("given") - F.col("before") - F.col("tokens_before")).where("room > 0")
    # numbers over all passes of a source, so that the quotas' blocks are dealt once: every pass but the last draws all
    filled = blocks.groupBy("source").agg(F.count(F.lit(1)).alias("filled"))  # a row a source
    drawn = drawn.join(F.broadcast(filled), "source").withColumn("number", F.col("repeat") * F.col("filled") + F.col("blocks_before"))
    drawn = cut(drawn.select("mix_id", "source", "repeat", "block", "number", "room", "tokens"), "drawn")
    quotas = {(r["mix_id"], r["source"]): r["n"] for r in drawn.groupBy("mix_id", "source").agg(F.count(F.lit(1)).alias("n")).collect()}
    ends: dict[tuple[int, str], np.ndarray] = {}  # a number a shard of a source
    for m in sorted({k[0] for k in quotas}):
        names = sorted(s for i, s in quotas if i == m)
        total = next(r["total_tokens"] for r in plan if r["mix_id"] == m)
        shards = max(1, min(-(-int(total) // SHARD_TOKENS), sum(quotas[m, s] for s in names)))
        split = split_quotas([quotas[m, s] for s in names], shards, seed + int(m)).cumsum(axis=0)
        ends |= {(m, s): split[:, i] for i, s in enumerate(names)}
    dealt = drawn.mapInArrow(_deal(spark.sparkContext.broadcast(ends)), "mix_id int, source string, repeat int, block int, shard int, room double, block_tokens bigint")
    all_rows = rows.join(dealt, ["source", "block"])
    whole = all_rows.where("room >= block_tokens")
    # only the last block of a quota is cut, record by record
    inside = Window.partitionBy("mix_id", "source", "repeat", "block").orderBy(F.xxhash64("doc_id", "repeat"), "doc_id")
    part = all_rows.where("room < block_tokens").withColumn("sofar", F.sum("n_tokens").over(inside) - F.col("n_tokens")).where("sofar < room").drop("sofar")
    local = Window.partitionBy("mix_id", "shard").orderBy(F.xxhash64("doc_id", "repeat", "mix_id", F.lit(seed)), "doc_id", "repeat")
    return whole.unionByName(part).select("mix_id", "shard", (F.row_number().over(local) - 1).cast("bigint").alias("place"), "doc_id", "source", "repeat", "n_tokens")


def document_sizes(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, source (as source_name), n_tokens of all documents."""
    return with_tokens(documents.select("doc_id", source_name(F.col("source")).alias("source"), "text"), "text", ["doc_id", "source"], vocabulary)
