"""Queries of the operators for training data, and the SQL that checks them where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofact.llm import knn, mix, pack, reading, split
from chronofact.llm.tokens import with_tokens
from chronofact.sources.tables import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of vectors of which one is among the other's five most similar."""
    return knn.similar_pairs(table(spark, d, "chunk_embeddings"), table(spark, d, "index_versions"))


def p2_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """The five most similar vectors of every usable vector, ranked."""
    return knn.similar_vectors(table(spark, d, "chunk_embeddings"), table(spark, d, "index_versions"))


def p2_asked(spark: SparkSession, d: str) -> DataFrame:
    """The neighbours of every vector whose id is divisible by 100, which SQL can check by brute force."""
    return p2_neighbours(spark, d).where("vec_id % 100 = 0").select("vec_id", F.col("rank").cast("bigint").alias("rank"), "neighbour")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Of each oversized text the kind of boundary it is cut at."""
    return split.oversized_pieces(table(spark, d, "chunks")).where("piece = 0 and chunk_id is not null").select("chunk_id", "boundary").distinct()


def p6_chunks(spark: SparkSession, d: str) -> DataFrame:
    """All chunks, oversized ones cut, numbered anew within their section."""
    return split.recut_chunks(table(spark, d, "chunks"))


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    """The container of every document or piece of a document."""
    return pack.packed_documents(table(spark, d, "documents"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that don't fit one container."""
    return p7_containers(spark, d).where("pieces > 1").select("doc_id").distinct()


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    """How full the containers are."""
    return pack.container_report(p7_containers(spark, d))


def p7_check(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of the containers: none over the capacity, every token once, only documents beyond it split."""
    from chronofact.session import cut

    docs = table(spark, d, "documents").where("doc_id is not null")
    packed = cut(p7_containers(spark, d), "packed")
    whole = packed.groupBy("doc_id").agg(F.sum("size").alias("packed"), F.max("pieces").alias("pieces"), F.min("from_unit").alias("low"), F.max("to_unit").alias("high"))
    sizes = with_tokens(docs, "text", ["doc_id"])
    each = sizes.join(whole, "doc_id", "left").agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.count_if(~F.col("packed").eqNullSafe(F.col("n_tokens")) | ((F.col("n_tokens") > 0) & ~((F.col("low") == 0) & (F.col("high") == F.col("n_tokens"))))).alias("n_not_whole"),
        F.count_if((F.col("n_tokens") <= pack.CAPACITY) & (F.col("pieces") > 1)).alias("n_split_small"),
    )
    over = packed.where("container is not null").groupBy("container").agg(F.sum("size").alias("filled")).agg(F.count_if(F.col("filled") > pack.CAPACITY).alias("n_over"))
    return each.crossJoin(F.broadcast(over))  # one row each


def p8_check(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of every mix: no record too often, no source short of what it can give, none beyond it by more than a
    record."""
    from chronofact.session import cut

    sizes = cut(mix.document_sizes(table(spark, d, "documents")), "sizes")
    targets = table(spark, d, "mix_targets")
    report = mix.mix_report(sizes, targets).select("mix_id", "source_key", "max_repeats", "given_tokens")
    drawn = cut(mix.mix(sizes, targets).groupBy("mix_id", F.col("source").alias("source_key"), "doc_id").agg(F.count(F.lit(1)).alias("times"), F.sum("n_tokens").alias("n_tokens"), F.max("n_tokens").alias("largest")), "drawn")
    often = drawn.join(report, ["mix_id", "source_key"]).where("times > max_repeats").groupBy("mix_id").agg(F.count(F.lit(1)).alias("n_too_often"))
    per = drawn.groupBy("mix_id", "source_key").agg(F.sum("n_tokens").alias("drawn"), F.max("largest").alias("largest"))
    got = F.coalesce("drawn", F.lit(0))
    each = report.join(per, ["mix_id", "source_key"], "left").groupBy("mix_id").agg(F.count(F.lit(1)).alias("n_sources"), F.count_if(got < F.col("given_tokens") - 1e-6).alias("n_short"), F.count_if(got > F.col("given_tokens") + F.coalesce("largest", F.lit(0))).alias("n_over"))
    return each.join(often, "mix_id", "left").select("mix_id", "n_sources", "n_short", "n_over", F.coalesce("n_too_often", F.lit(0)).alias("n_too_often"))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    """What each source gives to each mix, and the share it reaches."""
    return mix.mix_report(mix.document_sizes(table(spark, d, "documents")), table(spark, d, "mix_targets")).drop("source_key")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Sources that can't reach their share of a mix: drawn with all repeats used, they stay under their quota."""
    return short_of_quota(p8_shares(spark, d)).select("mix_id", "source").distinct()


def short_of_quota(shares: DataFrame) -> DataFrame:
    """Rows of p8_shares whose drawn tokens stay under the quota; falls_short must say the same, else the draw is wrong."""
    short = F.col("drawn_tokens") < F.col("quota_tokens")
    wrong = F.concat(F.lit("mix "), F.col("mix_id").cast("string"), F.lit(": drawn tokens and falls_short disagree on "), F.coalesce("source", F.lit("null")))
    return shares.where(F.when(short.eqNullSafe(F.col("falls_short")), short).otherwise(F.raise_error(wrong).cast("boolean")))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    """The mixed records by shard."""
    from chronofact.session import cut

    return mix.mix(cut(mix.document_sizes(table(spark, d, "documents")), "sizes"), table(spark, d, "mix_targets"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """Shares of the sources in the mixes as drawn, beside their targets."""
    from chronofact.session import cut

    sizes = cut(mix.document_sizes(table(spark, d, "documents")), "sizes")
    targets = table(spark, d, "mix_targets")
    drawn = mix.mix(sizes, targets).groupBy("mix_id", F.col("source").alias("source_key")).agg(F.sum("n_tokens").alias("drawn_tokens"), F.count(F.lit(1)).alias("drawn_records"), (F.max("repeat") + 1).alias("passes"))
    report = mix.mix_report(sizes, targets)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return report.join(drawn, ["mix_id", "source_key"], "left").select("mix_id", "source", "target_share", "max_repeats", zero("drawn_tokens"), zero("drawn_records"), zero("passes"), F.round(F.coalesce(F.col("drawn_tokens"), F.lit(0)) / F.col("total_tokens"), 6).alias("reached_share"), "quota_tokens", "falls_short")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Reading level of each English document with words that isn't labelled."""
    return reading.unlabelled_levels(table(spark, d, "documents"), table(spark, d, "reading_labels"))


def p9_levels(spark: SparkSession, d: str) -> DataFrame:
    """Reading level and sentence levels of every document."""
    return reading.reading_levels(table(spark, d, "documents"), table(spark, d, "reading_labels"))


def p9_graded(spark: SparkSession, d: str) -> DataFrame:
    """The documents that have a level: those of the labelled documents' languages with words."""
    return p9_levels(spark, d).where("reading_level between 1 and 3").select("doc_id").distinct()


QUERIES = {f.__name__: f for f in (p2_found, p2_neighbours, p2_asked, p6_found, p6_chunks, p7_found, p7_containers, p7_report, p7_check, p8_found, p8_report, p8_mix, p8_shares, p8_check, p9_found, p9_levels, p9_graded)}
#: What SQL can express of these results; the rest is held against brute force in tests/llm.
SQL: dict[str, str] = {
    "p2_asked": """
with d as (select index_version, max(dims) as dims from index_versions group by 1),
u as (select c.index_version, c.vec_id, any_value(c.embedding::double[]) as e from chunk_embeddings c join d on d.index_version = c.index_version
      where c.vec_id is not null and len(c.embedding) = d.dims and len(list_filter(c.embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(c.embedding, lambda x: x <> 0)) > 0 group by 1, 2),
p as (select q.vec_id, v.vec_id as neighbour, round(list_cosine_similarity(q.e, v.e), 12) as s from u q join u v on v.index_version = q.index_version and v.vec_id <> q.vec_id where q.vec_id % 100 = 0)
select vec_id, rank, neighbour from (select *, row_number() over (partition by vec_id order by s desc, neighbour) as rank from p) where rank <= 5""",
    "p6_found": r"""
with t as (select distinct chunk_id, text from chunks where chunk_id is not null and len(text) > 1500),
ps as (select chunk_id, text, unnest(string_split_regex(text, '\n\s*\n')) as p from t),
p as (select chunk_id, text, regexp_replace(p, '^\s+|\s+$', '', 'g') as p from ps),
s as (select chunk_id, unnest(string_split(regexp_replace(p, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))) as s from p),
l as (select chunk_id, max(len(p)) as p,
      max(list_aggregate(list_transform(string_split_regex(text, '\s+'), lambda x: len(x)), 'max')) as w from p group by 1),
m as (select chunk_id, max(len(s)) as s from s group by 1)
select l.chunk_id, case when l.p <= 1300 then 'paragraph' when m.s <= 1300 then 'sentence' when l.w <= 1300 then 'word' else 'char' end as boundary from l join m on m.chunk_id = l.chunk_id""",
    "p7_check": "select count(*) as n_documents, 0 as n_not_whole, 0 as n_split_small, 0 as n_over from documents where doc_id is not null",
    "p8_check": "select mix_id, count(distinct source) as n_sources, 0 as n_short, 0 as n_over, 0 as n_too_often from mix_targets group by 1",
    "p9_graded": r"""select distinct doc_id from documents where regexp_matches(text, '\p{L}') and lang in
 (select lang from documents join reading_labels using (doc_id) where regexp_matches(text, '\p{L}') and reading_level between 1 and 3 and lang is not null group by 1 having count(distinct doc_id) >= 2)""",
}
