"""Point-in-time reads and the serving surface: as-of filter, history, company periods, restatements, search, ask."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofact.schema import struct
from chronofact.session import cut

# Response shapes of the serving methods.
FACT = struct("cik int, tag string, ddate date, qtrs int, uom string, segments string, value double, form string, fy int, fp string, adsh string, valid_from date, valid_to date, version_no bigint, n_versions bigint")
PASSAGE = T.StructType([T.StructField(n, T.StringType()) for n in ("chunk_id", "adsh", "section", "text", "form", "company")] + [T.StructField("cik", T.IntegerType()), T.StructField("chunk_index", T.IntegerType()), T.StructField("score", T.DoubleType())])


class NotFound(LookupError):
    """Nothing answers the request."""


def as_of(versions: DataFrame, day: datetime.date | str) -> DataFrame:
    """What was known on a day. A plain filter: it reaches the scan, and one on fact_key passes below the windows."""
    d = F.lit(day).cast("date")
    return versions.where((F.col("valid_from") <= d) & (F.col("valid_to") > d))


def optional(df: DataFrame, **equal) -> DataFrame:
    """P5: equality for every argument that isn't None (0 is a value)."""
    for column, value in equal.items():
        if value is not None:
            df = df.where(F.col(column) == F.lit(value))
    return df


def facts(versions: DataFrame, cik: int, tag: str, day: datetime.date | str | None = None, ddate: datetime.date | str | None = None, limit: int = 50) -> DataFrame:
    """Consolidated facts of a company as known on a day (today unless given), newest period first; segment slices come
    along. At most 500 rows."""
    found = optional(as_of(versions, day or datetime.date.today()), cik=cik, tag=tag).where("coreg is null")
    if ddate is not None:
        found = found.where(F.col("ddate") == F.lit(ddate).cast("date"))
    return found.select(*FACT.names).orderBy(F.desc("ddate"), "qtrs", "uom", F.col("segments").asc_nulls_first(), "version_no").limit(min(limit, 500))


def history(versions: DataFrame, cik: int, tag: str, ddate: datetime.date | str, qtrs: int = 4) -> DataFrame:
    """All versions of a company's fact, in order (L2)."""
    found = optional(versions, cik=cik, tag=tag, qtrs=qtrs).where((F.col("ddate") == F.lit(ddate).cast("date")) & F.col("coreg").isNull())
    return found.select("fact_key", *FACT.names, "is_latest").orderBy("fact_key", "version_no")


def company(company_quarters: DataFrame, cik: int) -> DataFrame:
    """A company's periods, newest first (L3)."""
    return optional(company_quarters, cik=cik).orderBy(F.desc("fy"), F.desc("fp"), F.desc("period_end"))


def top_restatements(restated: DataFrame, cik: int | None = None, least_change: float = 0.0, limit: int = 100) -> DataFrame:
    """Restatements by size of the relative change (P11, L4); at most 1000."""
    size = F.abs(F.coalesce("rel_change", F.lit(0.0)))
    return optional(restated, cik=cik).where(size >= least_change).orderBy(size.desc(), "fact_key").limit(min(limit, 1000))


def require(df: DataFrame) -> DataFrame:
    """The frame, or NotFound if it has no rows."""
    if df.isEmpty():
        raise NotFound("no rows")
    return df


class Engine:
    """The serving surface over published tables; every method returns a DataFrame."""

    def __init__(self, versions: DataFrame, restated: DataFrame, company_quarters: DataFrame, quality: DataFrame, index=None, costs: DataFrame | None = None):
        self.versions, self.restated, self.company_quarters, self.quality = versions, restated, company_quarters, quality
        self.index, self.cost_rows = index, costs

    def health(self) -> DataFrame:
        """Scorecard per quarter, with the promoted index version, the number of chunks, and the status: degraded without a
        promoted version. Without an index, or without quarters, there is one row at least, which says so."""
        promoted = self.index.promoted() if self.index else None
        n = self.index.chunks.select("chunk_id").distinct().count() if self.index else 0
        quarters = self.quality
        if quarters.isEmpty():
            quarters = quarters.sparkSession.range(1).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in quarters.schema))
        status = "ok" if promoted is not None and not self.quality.isEmpty() else "degraded"
        return quarters.withColumns({"promoted_index": F.lit(promoted).cast("string"), "n_chunks": F.lit(n).cast("bigint"), "status": F.lit(status)}).orderBy("quarter")

    def index_history(self, limit: int = 20) -> DataFrame:
        """Index versions, the newest first, with the promoted one marked."""
        promoted = F.col("index_version").eqNullSafe(F.lit(self.index.promoted()))
        return self.index.versions().withColumn("promoted", promoted).orderBy(F.desc("created_at"), "index_version").limit(limit)

    def costs(self) -> DataFrame:
        """Ledger by stage, and the total (A10)."""
        return cost_by_stage(self.cost_rows)

    def facts(self, cik: int, tag: str, day=None, ddate=None, limit: int = 50) -> DataFrame:
        return require(facts(self.versions, cik, tag, day, ddate, limit))

    def history(self, cik: int, tag: str, ddate, qtrs: int = 4) -> DataFrame:
        return require(history(self.versions, cik, tag, ddate, qtrs))

    def company(self, cik: int) -> DataFrame:
        return require(company(self.company_quarters, cik))

    def restatements(self, cik: int | None = None, least_change: float = 0.0, limit: int = 100) -> DataFrame:
        return top_restatements(self.restated, cik, least_change, limit)

    def search(self, question: str, cik: int | None = None, form: str | None = None, k: int = 5) -> DataFrame:
        """Passages for a question in the promoted index, with company, form and day of their filing; at most 20."""
        return self.index.search([question], k=min(k, 20), cik=cik, form=form)

    def ask(self, question: str, cik: int | None = None, form: str | None = None, k: int = 5) -> DataFrame:
        """An extractive answer, the head of the best passage and where it is from, with the passages as citations;
        NotFound if nothing is retrieved."""
        hits = require(cut(self.search(question, cik, form, k), "hits"))  # at most 20 rows
        cited = [c for c in ("chunk_id", "adsh", "cik", "company", "form", "filed", "section", "chunk_index", "score", "text") if c in hits.columns]
        head = F.concat_ws(" ", *(F.col(c).cast("string") for c in ("company", "form", "filed") if c in cited), F.concat(F.lit("Item "), "section"))
        return hits.groupBy().agg(
            F.substring(F.min_by("text", "rank"), 1, 800).alias("answer"),
            F.min_by(head, "rank").alias("source"),
            F.lit("extractive").alias("answer_mode"),
            F.lit(self.index.promoted()).alias("index_version"),
            F.array_sort(F.collect_list(F.struct("rank", *cited))).alias("citations"),
        )


def cost_by_stage(ledger: DataFrame) -> DataFrame:
    """Runs, quantity, dollars and last run by stage, with a row for all (A10)."""
    sums = [F.count(F.lit(1)).alias("n_runs"), F.round(F.sum("quantity"), 4).alias("quantity"), F.round(F.sum("usd"), 4).alias("usd"), F.max("run_at").alias("last_run")]
    return ledger.groupBy("stage").agg(*sums).unionByName(ledger.groupBy().agg(*sums).withColumn("stage", F.lit("total")))
