"""Marts over versioned facts (K2): restatements, reporting periods, the quality scorecard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chronofact.functions.scalar import percent, ratio
from chronofact.operators.versions import ambiguous_pairs
from chronofact.session import cut

# Headline metrics and the concepts that report them.
FLOWS = {
    "revenue": ["Revenues", "RevenueFromContractWithCustomerExcludingAssessedTax", "SalesRevenueNet"],
    "net_income": ["NetIncomeLoss", "ProfitLoss"],
    "operating_income": ["OperatingIncomeLoss"],
    "operating_cash_flow": ["NetCashProvidedByUsedInOperatingActivities"],
    "eps_diluted": ["EarningsPerShareDiluted"],
}
INSTANTS = {"total_assets": ["Assets"], "total_liabilities": ["Liabilities"], "stockholders_equity": ["StockholdersEquity"]}


def restatements(versions: DataFrame) -> DataFrame:
    """Facts whose latest value differs from the first.

    A fact that went from A to B and back isn't listed. rel_change is null where the original is null or 0.
    """
    latest = lambda c: F.max(F.when(F.col("is_latest"), F.col(c)))
    each = versions.groupBy("fact_key", "cik", "tag", "ddate", "qtrs", "uom", "segments", "is_dimensional").agg(
        F.min(F.when(F.col("version_no") == 1, F.col("value"))).alias("original_value"),
        latest("value").alias("latest_value"),
        F.min("valid_from").alias("first_reported"),
        F.max("valid_from").alias("last_reported"),
        F.max("n_versions").alias("n_versions"),
        latest("adsh").alias("latest_adsh"),
        latest("footnote").alias("latest_footnote"),
    )
    change = F.col("latest_value") - F.col("original_value")
    return each.where((F.col("n_versions") > 1) & ~F.col("original_value").eqNullSafe(F.col("latest_value"))).select(
        "*",
        change.alias("abs_change"),
        F.when(F.col("original_value") != 0, change / F.abs("original_value")).alias("rel_change"),
        F.datediff("last_reported", "first_reported").cast("bigint").alias("days_between"),
    )


def period_labels(submissions: DataFrame) -> DataFrame:
    """fy and fp of each (cik, period end) that a filing covers; the greatest of each (A3)."""
    return submissions.where("period is not null and fp is not null").groupBy("cik", F.col("period").alias("period_end")).agg(F.max("fy").alias("fy"), F.max("fp").alias("fp"))


def headline_versions(versions: DataFrame) -> DataFrame:
    """Latest versions of whole-company facts in dollars, with the day any version was first reported.

    The first day comes from an aggregate joined in the same exchange by fact_key, so a hot key is combined map-side.
    """
    used = versions.where("coreg is null and not is_dimensional and uom in ('USD', 'USD/shares') and qtrs in (0, 1, 4)")
    # one row per key: the day first reported, and the latest version (several rows only where a build lists it twice)
    return used.groupBy("fact_key", "cik", "tag", "ddate", "qtrs").agg(F.min("valid_from").alias("first_reported"), F.max(F.when(F.col("is_latest"), F.col("value"))).alias("value"), F.max("is_latest").alias("any")).where("any").drop("any")


def periods(latest: DataFrame, labels: DataFrame) -> DataFrame:
    """Every (cik, period end) with a fact, labelled by the filing that covers it, else by calendar year and duration."""
    spans = latest.groupBy("cik", F.col("ddate").alias("period_end")).agg(F.max("qtrs").alias("longest"))
    return spans.join(labels, ["cik", "period_end"], "left").select(
        "cik", "period_end", F.coalesce("fy", F.year("period_end")).alias("fy"), F.coalesce("fp", F.when(F.col("longest") == 4, "FY").otherwise("Q")).alias("fp")
    )


def _metric(tags: list[str], also: Column | None = None) -> Column:
    hit = F.col("tag").isin(tags)
    return hit if also is None else hit & also


def company_quarter(versions: DataFrame, submissions: DataFrame, flows: dict[str, list[str]] = FLOWS, instants: dict[str, list[str]] = INSTANTS) -> DataFrame:
    """Headline metrics per company and reporting period as now known, each with the day it was first reported (A4, A5).

    Flow metrics take fiscal years for fp FY, else quarters; instants take points in time; of several concepts the
    greatest value counts. Ratios are null unless the denominator is positive. (The build time is left to the writer.)
    """
    latest = cut(headline_versions(versions), "headlines")  # read twice below
    labelled = periods(latest, period_labels(submissions))
    rows = labelled.join(latest.withColumnRenamed("ddate", "period_end"), ["cik", "period_end"])
    flow_span = F.col("qtrs") == F.when(F.col("fp") == "FY", 4).otherwise(1)
    aggs = []
    for name, tags in [*flows.items(), *instants.items()]:
        span = flow_span if name in flows else F.col("qtrs") == 0
        aggs.append(F.max(F.when(_metric(tags, span), F.col("value"))).alias(name))
        aggs.append(F.min(F.when(_metric(tags), F.col("first_reported"))).alias(f"{name}_first_reported"))
    pivoted = rows.groupBy("cik", "period_end", "fy", "fp").agg(*aggs)
    names = submissions.groupBy("cik").agg(F.max("name").alias("company_name"), F.max("sic").alias("sic"))
    metrics = [c for name in [*flows, *instants] for c in (name, f"{name}_first_reported")]
    out = pivoted.join(names, "cik").select("cik", "company_name", "sic", "fy", "fp", "period_end", *metrics)
    if {"total_assets", "total_liabilities"} <= set(metrics):
        out = out.withColumn("leverage_ratio", ratio(F.col("total_liabilities"), F.col("total_assets")))
    if {"net_income", "revenue"} <= set(metrics):
        out = out.withColumn("net_margin", ratio(F.col("net_income"), F.col("revenue")))
    return out


def company_latest(company_quarters: DataFrame) -> DataFrame:
    """The newest period of each company (N-per-group with a group limit)."""
    w = Window.partitionBy("cik").orderBy(F.desc("period_end"), F.desc("fy"), F.desc("fp"))
    return company_quarters.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def data_quality(facts: DataFrame, submissions: DataFrame, n_restated: DataFrame) -> DataFrame:
    """Scorecard per quarter, counted on the rows as loaded (A2, A6, J7-J9). n_restated: one row, n_restated_facts.

    Quarters without facts or without submissions are left out. (The build time is left to the writer.)
    """
    f = facts.groupBy("quarter").agg(
        F.count(F.lit(1)).alias("n_facts"),
        F.countDistinct("adsh").alias("n_filings_with_facts"),
        F.countDistinct("cik").alias("n_companies"),
        F.min("knowledge_date").alias("first_filed"),
        F.max("knowledge_date").alias("last_filed"),
        F.count_if(F.col("value").isNull()).alias("n_null_values"),
    )
    s = submissions.groupBy("quarter").agg(
        F.count(F.lit(1)).alias("n_submissions"),
        F.count_if(F.col("form").isin("10-K", "10-K/A")).alias("n_10k"),
        F.count_if(F.col("form").isin("10-Q", "10-Q/A")).alias("n_10q"),
    )
    a = ambiguous_pairs(facts, "quarter").groupBy("quarter").agg(F.count(F.lit(1)).alias("n_ambiguous_facts"))
    return (
        s.join(f, "quarter")
        .join(a, "quarter", "left")
        .crossJoin(F.broadcast(n_restated))  # one row
        .select(
            "quarter", "n_submissions", "n_10k", "n_10q", "n_facts", "n_filings_with_facts", "n_companies", "first_filed", "last_filed", "n_null_values",
            percent(F.col("n_null_values"), F.col("n_facts"), 3).alias("pct_null_values"),
            percent(F.col("n_filings_with_facts"), F.col("n_submissions"), 2).alias("pct_filings_with_facts"),
            "n_restated_facts",
            F.coalesce("n_ambiguous_facts", F.lit(0)).cast("bigint").alias("n_ambiguous_facts"),
        )
    )
