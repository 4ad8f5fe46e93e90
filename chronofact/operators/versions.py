"""Versioned facts (K1): every reported value with the window in which it was the one last reported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chronofact.functions.scalar import OPEN_END
from chronofact.operators import bitemporal
from chronofact.operators.bitemporal import BUCKETS, HOT_ROWS, hot_buckets, mark_shared_days
from chronofact.session import cut

#: Columns of a report that go along with its version.
CARRIED = ["cik", "tag", "ddate", "qtrs", "uom", "coreg", "segments", "is_dimensional", "value", "footnote", "form", "fy", "fp", "version", "knowledge_date"]


def ambiguous_pairs(facts: DataFrame, *by: str) -> DataFrame:
    """A1: (filing, key) pairs with more than one distinct non-null value; of two values one is null is no contradiction.

    Least and greatest value tell the same as a distinct count, with constant state and map-side combine.
    """
    keys = [*by, "adsh", "fact_key"]
    return facts.groupBy(*keys).agg(F.min("value").alias("low"), F.max("value").alias("high")).where("low < high").select(*keys)


def _nulls_last(name: str) -> list[Column]:
    return [F.col(name).isNull().alias(f"{name}_null"), F.col(name)]


#: Filings that no submission lists are broadcast to the reports up to this many (counted first), joined by shuffle beyond.
UNLISTED_BROADCAST = 100_000
#: Of several rows of a filing for a key the first in this order counts.
_FIRST = ("footnote", "version", "value")


def clean_reports(facts: DataFrame) -> DataFrame:
    """One row per (filing, key), contradicting pairs left out (J2, N1): the smallest footnote, nulls last; ties by
    version and value, nulls last. One aggregate does both, so the pairs are shuffled once and combined before."""
    order = [x for c in _FIRST for x in _nulls_last(c)]
    rest = [F.col(c) for c in CARRIED if c not in _FIRST]
    kept = facts.where("adsh is not null and fact_key is not null").groupBy("adsh", "fact_key").agg(F.min(F.struct(*order, *rest)).alias("r"), F.min("value").alias("low"), F.max("value").alias("high"))
    return kept.where("low is null or low = high").select("adsh", "fact_key", "r.*").drop(*(f"{c}_null" for c in _FIRST))


def clean_in_place(placed: DataFrame) -> DataFrame:
    """clean_reports of rows that are placed by fact_key: windows without a shuffle, through which columns are pruned."""
    pair = Window.partitionBy("fact_key", "adsh")
    first = F.row_number().over(pair.orderBy(*(F.col(c).asc_nulls_last() for c in (*_FIRST, "knowledge_date"))))
    kept = placed.withColumn("__first", first).withColumns({"__low": F.min("value").over(pair), "__high": F.max("value").over(pair)})
    return kept.where("__first = 1 and (__low is null or __low = __high)").drop("__first", "__low", "__high")


def number_in_place(rows: DataFrame, key: str, day: str, order: list[Column]) -> DataFrame:
    """version_no, n_versions and next_day of each row within its key (N2-N4); rows are placed by key, so nothing moves."""
    w = Window.partitionBy(key).orderBy(F.col(day).asc_nulls_last(), *order)
    return rows.withColumns({"version_no": F.row_number().over(w).cast("bigint"), "next_day": F.lead(day).over(w), "n_versions": F.count(F.lit(1)).over(Window.partitionBy(key))})


def number_by_day(rows: DataFrame, key: str, day: str, order: list[Column]) -> DataFrame:
    """The same for hot keys, day by day: counts per (key, day) give the numbers before a day and the day that follows, so
    no task sorts more than a day of such a key."""
    days = rows.groupBy(key, day).agg(F.count(F.lit(1)).alias("__n"))
    along = Window.partitionBy(key).orderBy(F.col(day).asc_nulls_last())
    days = days.select(key, F.col(day).alias("__day"), (F.sum("__n").over(along) - F.col("__n")).alias("__before"), F.sum("__n").over(Window.partitionBy(key)).alias("n_versions"), F.lead(day).over(along).alias("__next")).withColumnRenamed(key, "__key")
    within = Window.partitionBy(key, day).orderBy(*order)
    numbered = rows.withColumns({"__at": F.row_number().over(within), "__later": F.lead(F.lit(True)).over(within)})
    joined = numbered.join(days, F.col(key).eqNullSafe(F.col("__key")) & F.col(day).eqNullSafe(F.col("__day")))
    return joined.select(*rows.columns, (F.col("__before") + F.col("__at")).cast("bigint").alias("version_no"), "n_versions", F.when(F.col("__later"), F.col(day)).otherwise(F.col("__next")).alias("next_day"))


def _of_listed_filings(rows: DataFrame, filings: DataFrame) -> DataFrame:
    """Reports of filings that a submission lists. The unlisted filings, rarely any, are found among the distinct ones."""
    unlisted = rows.select("adsh").distinct().join(filings, "adsh", "left_anti")
    n = unlisted.count()
    if not n:
        return rows
    unlisted = cut(unlisted, "unlisted")
    return rows.join(F.broadcast(unlisted) if n <= UNLISTED_BROADCAST else unlisted, "adsh", "left_anti")


def fact_versions(facts: DataFrame, submissions: DataFrame, hot_rows: int = HOT_ROWS, filings_broadcast: int | None = None) -> DataFrame:
    """All versions of all facts with their windows [valid_from, valid_to).

    Reports of filings without a submission are dropped; a submission listed twice counts once. Versions of a day are
    ordered by acceptance (nulls last), then adsh: the earlier of the day gets an empty window. Contradicting
    (filing, key) pairs are left out. Empty tables give no rows.

    Reports are shuffled once, by fact_key; choosing, numbering and windows follow in place. The submissions are broadcast up to
    filings_broadcast (bitemporal.FILINGS_BROADCAST) filings, a counted size; beyond, only keys with several filings on one day
    are joined with them for their order (both branches share the shuffle). Hot keys are combined by (filing, key) before
    they are shuffled, and numbered day by day.
    """
    filings = submissions.where("adsh is not null").groupBy("adsh").agg(F.max("accepted").alias("accepted"))
    small = filings.count() <= (bitemporal.FILINGS_BROADCAST if filings_broadcast is None else filings_broadcast)
    rows = facts.select("adsh", "fact_key", *CARRIED).where("adsh is not null and fact_key is not null")
    hot = hot_buckets(rows.select(F.col("fact_key").alias("key")), hot_rows)
    bucket = F.pmod(F.xxhash64("fact_key"), F.lit(BUCKETS))
    at = ("fact_key", "knowledge_date")
    by_acceptance = [F.col("accepted").asc_nulls_last(), F.col("adsh")]
    plain = rows.where(~bucket.isin(hot)) if hot else rows
    if small:
        listed = plain.join(F.broadcast(filings), "adsh").repartition("fact_key")
        numbered = number_in_place(clean_in_place(listed), *at, by_acceptance).drop("accepted")
    else:
        clean = mark_shared_days(clean_in_place(_of_listed_filings(plain, filings).repartition("fact_key")), *at, "adsh")
        numbered = number_in_place(clean.where(~F.col("__shared")), *at, []).drop("__shared")
        shared = clean.where("__shared").drop("__shared").join(filings, "adsh").repartition("fact_key")
        numbered = numbered.unionByName(number_in_place(shared, *at, by_acceptance).drop("accepted"))
    if hot:
        large = clean_reports(rows.where(bucket.isin(hot))).join(F.broadcast(filings) if small else filings, "adsh")
        numbered = numbered.unionByName(number_by_day(large, *at, by_acceptance).drop("accepted"))
    return numbered.select(
        "fact_key", "cik", "tag", "ddate", "qtrs", "uom", "coreg", "segments", "is_dimensional", "value", "footnote", "adsh", "form", "fy", "fp",
        F.col("version").alias("taxonomy_version"),
        F.col("knowledge_date").alias("valid_from"),
        F.coalesce("next_day", F.lit(OPEN_END)).alias("valid_to"),
        "version_no",
        "n_versions",
        F.col("next_day").isNull().alias("is_latest"),
    )
