"""Queries of the general data operations: profile, history, as-of values, packed fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofact.operators import asof, bitemporal, profile, segments
from chronofact.sources.tables import table

OPEN = "date'9999-12-31'"


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Values and loads that break their rules."""
    return profile.broken_rules(table(spark, d, "facts"), table(spark, d, "data_quality"), table(spark, d, "processed_manifest"))


def p1_profile(spark: SparkSession, d: str) -> DataFrame:
    """Profile of every column of facts and data_quality with its induced expression."""
    return profile.profile_columns(table(spark, d, "facts"), "facts").unionByName(profile.profile_columns(table(spark, d, "data_quality"), "data_quality"))


def p1_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows, nulls and distinct values of every column."""
    return profile.column_counts(table(spark, d, "facts"), "facts").unionByName(profile.column_counts(table(spark, d, "data_quality"), "data_quality"))


def p1_values(spark: SparkSession, d: str) -> DataFrame:
    """Every value of every column that doesn't conform to the column's induced expression."""
    return profile.nonconforming_values(table(spark, d, "facts"), "facts").unionByName(profile.nonconforming_values(table(spark, d, "data_quality"), "data_quality"))


def p1_loads(spark: SparkSession, d: str) -> DataFrame:
    """Every load of facts beside the load it follows."""
    return profile.load_report(table(spark, d, "facts"), table(spark, d, "processed_manifest"))


def p1_load_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Rows, nulls, distinct and negative values and the exact median of |value| of every load."""
    m = profile.load_profiles(profile.load_values(table(spark, d, "facts"), "source_sha256", "value"))
    return m.select("load", "n_rows", "n_null", "n_values", "n_distinct", "n_negative", F.round("median_abs", 3).alias("median_abs"))


def p3_ledger(spark: SparkSession, d: str) -> DataFrame:
    """The whole bitemporal ledger, superseded rows included."""
    return bitemporal.fact_ledger(table(spark, d, "facts"), table(spark, d, "submissions"))


def p3_extended(spark: SparkSession, d: str) -> DataFrame:
    """The ledger of all loads but the last, extended by the last: it must be that of all."""
    facts, subs = table(spark, d, "facts"), table(spark, d, "submissions")
    last = facts.agg(F.max_by("source_sha256", "loaded_at")).first()[0]
    is_last = F.col("source_sha256").eqNullSafe(F.lit(last))
    before = facts.where(~is_last)
    return bitemporal.extend_ledger(bitemporal.fact_ledger(before, subs), before, facts.where(is_last), subs)


def p3_history(spark: SparkSession, d: str) -> DataFrame:
    """The history believed now: each fact's successive values."""
    return p3_ledger(spark, d).where(f"recorded_to = {OPEN}").select("fact_key", "version_no", "value", "valid_from", "valid_to")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Each version after the first of its key."""
    return p3_history(spark, d).where("version_no > 1").select("fact_key", F.date_format("valid_from", "yyyy-MM-dd").alias("valid_from"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Of each comparison the version known on its date."""
    return asof.fact_versions_as_known(table(spark, d, "comparisons"), table(spark, d, "fact_versions"))


def p4_values(spark: SparkSession, d: str) -> DataFrame:
    """Each comparison with the value known on its date; without one, value is null."""
    comparisons = table(spark, d, "comparisons").select("comparison_id", "base_fact_key", "knowledge_date").distinct()
    versions = table(spark, d, "fact_versions").groupBy(F.col("fact_key").alias("base_fact_key"), "version_no").agg(F.min("value").alias("value"), F.min("valid_from").alias("valid_from"))
    found = comparisons.join(p4_found(spark, d), "comparison_id", "left")
    return found.join(versions, ["base_fact_key", "version_no"], "left").select("comparison_id", "base_fact_key", "knowledge_date", "version_no", "valid_from", "value")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Values of every segments field that holds two or more."""
    return p5_segments(spark, d).where("n_values >= 2").select("fact_key", "pos", "axis_member")


def p5_segments(spark: SparkSession, d: str) -> DataFrame:
    """Every value of every segments field with its place."""
    return segments.packed_segments(table(spark, d, "fact_versions"))


def p5_delimiters(spark: SparkSession, d: str) -> DataFrame:
    """Scores of the candidate delimiters per filer."""
    v = table(spark, d, "fact_versions").select(F.col("cik").cast("string").alias("source"), F.col("segments").alias("text"))
    return segments.delimiter_scores(v)


QUERIES = {f.__name__: f for f in (p1_found, p1_profile, p1_counts, p1_values, p1_loads, p1_load_metrics, p3_found, p3_history, p3_ledger, p3_extended, p4_found, p4_values, p5_found, p5_segments, p5_delimiters)}

_REPORTS = """
with said as (select fact_key, adsh, min(knowledge_date) as kd, min(value) as v from facts where value is not null group by 1, 2 having count(distinct value) = 1),
acc as (select adsh, max(accepted) as accepted from submissions group by 1),
day as (select fact_key, kd, v from (select said.*, row_number() over (partition by fact_key, kd order by accepted desc nulls first, said.adsh desc) as rn
        from said left join acc on said.adsh = acc.adsh) where rn = 1),
opened as (select fact_key, kd, v from (select *, lag(v) over (partition by fact_key order by kd) as pv, row_number() over (partition by fact_key order by kd) as n from day) where n = 1 or v <> pv),
versions as (select fact_key, kd, v, row_number() over (partition by fact_key order by kd) as n, lead(kd) over (partition by fact_key order by kd) as nxt from opened)
"""
_AS_KNOWN = """
with v as (select fact_key, version_no, min(valid_from) as f, min(valid_to) as t, min(value) as value from fact_versions group by 1, 2),
c as (select distinct comparison_id, base_fact_key, knowledge_date from comparisons)
"""
#: Columns whose counts are checked, by table.
_COUNTED = {t: "adsh cik tag version ddate qtrs uom value coreg footnote form fy fp knowledge_date fact_key quarter source_sha256 loaded_at segments is_dimensional".split() if t == "facts" else "build_id quarter n_submissions n_10k n_10q n_facts n_filings_with_facts n_companies first_filed last_filed n_null_values pct_null_values pct_filings_with_facts n_restated_facts n_ambiguous_facts built_at".split() for t in ("facts", "data_quality")}
SQL = {
    "p1_counts": " union all ".join(f"select '{t}' as table_name, '{c}' as column_name, count(*) as n_rows, count(*) - count({c}) as n_null, count(distinct {c}) as n_distinct from {t}" for t, cs in _COUNTED.items() for c in cs),
    "p1_load_metrics": """select source_sha256 as load, count(*) as n_rows, count(*) - count(value) as n_null, count(value) as n_values, count(distinct value) as n_distinct,
 count(*) filter (value < 0) as n_negative, round(median(abs(value)) filter (value <> 0), 3) as median_abs from facts where source_sha256 is not null group by 1""",
    # belief at every recording day, then days with the same belief joined
    "p3_ledger": """
with v as (select fact_key, adsh, value, min(loaded_at::date) as rec, min(knowledge_date) as kd from facts
           where value is not null and fact_key is not null and adsh is not null and knowledge_date is not null and loaded_at is not null group by 1, 2, 3),
o as (select *, row_number() over w as rn, lead(rec) over w as nxt from v window w as (partition by fact_key, adsh order by rec, value, kd)),
st as (select fact_key, adsh, value, kd, rec as r_from, coalesce(nxt, date '9999-12-31') as r_to from o where rn = 1 and (nxt is null or nxt > rec)),
acc as (select adsh, max(accepted) as accepted from submissions group by 1),
days as (select fact_key, r_from as t from st union select fact_key, r_to from st where r_to < date '9999-12-31'),
times as (select *, row_number() over (partition by fact_key order by t) as no, lead(t) over (partition by fact_key order by t) as until from days),
held as (select t.fact_key, t.t, t.no, st.kd, st.value, row_number() over (partition by t.fact_key, t.t, st.kd order by accepted desc nulls first, st.adsh desc) as place
         from times t join st on st.fact_key = t.fact_key and st.r_from <= t.t and st.r_to > t.t left join acc on acc.adsh = st.adsh),
said as (select *, lag(value) over (partition by fact_key, t order by kd) as before, row_number() over (partition by fact_key, t order by kd) as nth from held where place = 1),
belief as (select fact_key, t, no, value, kd as valid_from, coalesce(lead(kd) over (partition by fact_key, t order by kd), date '9999-12-31') as valid_to,
           row_number() over (partition by fact_key, t order by kd) as version_no from said where nth = 1 or value <> before),
runs as (select *, no - row_number() over (partition by fact_key, value, valid_from, valid_to order by no) as run from belief),
whole as (select fact_key, value, valid_from, valid_to, min(t) as recorded_from, max(no) as last_no, arg_max(version_no, no) as version_no from runs group by fact_key, value, valid_from, valid_to, run)
select w.fact_key, value, valid_from, valid_to, recorded_from, coalesce(until, date '9999-12-31') as recorded_to, case when until is null then version_no end as version_no
from whole w join times on times.fact_key = w.fact_key and times.no = w.last_no""",
    "p1_found": """
with m as (select distinct source_sha256 as ld, previous_sha256 as prev from processed_manifest where previous_sha256 is not null),
s as (select source_sha256 as ld, count(*) as n, count(*) - count(value) as nn, count(value) as nv, count(distinct value) as nd, sum(case when value < 0 then 1 else 0 end) as ng,
      median(case when value <> 0 then abs(value) end) as md from facts group by 1),
j as (select m.ld, abs(a.nn / a.n - b.nn / b.n) as dn, abs(a.ng / nullif(a.nv, 0) - b.ng / nullif(b.nv, 0)) as ds, abs(a.nd / nullif(a.nv, 0) - b.nd / nullif(b.nv, 0)) as dd,
      greatest(a.md / b.md, b.md / a.md) as f from m join s a on a.ld = m.ld join s b on b.ld = m.prev)
select 'facts' as table_name, 'value' as column_name, ld as load_key, 'null_rate' as check_name from j where dn >= 0.12
union all select 'facts', 'value', ld, 'sign' from j where ds >= 0.25
union all select 'facts', 'value', ld, 'distinct' from j where dd >= 0.2
union all select 'facts', 'value', ld, 'scale' from j where f >= 30
union all select 'data_quality', 'quarter', cast(build_id as varchar), case when quarter is null then 'null' else 'pattern' end from data_quality
  where quarter is null or not regexp_full_match(quarter, '[0-9]{4}q[1-4]')
union all select 'data_quality', 'pct_filings_with_facts', cast(build_id as varchar), case when pct_filings_with_facts is null then 'null' else 'range' end from data_quality
  where pct_filings_with_facts is null or not (pct_filings_with_facts between 50 and 100)""",
    "p3_found": _REPORTS + "select fact_key, strftime(kd, '%Y-%m-%d') as valid_from from versions where n > 1",
    "p3_history": _REPORTS + "select fact_key, n as version_no, v as value, kd as valid_from, coalesce(nxt, date '9999-12-31') as valid_to from versions",
    "p4_found": _AS_KNOWN + "select comparison_id, version_no from c join v on v.fact_key = c.base_fact_key and v.f <= c.knowledge_date and v.t > c.knowledge_date",
    "p4_values": _AS_KNOWN + "select comparison_id, base_fact_key, knowledge_date, version_no, f as valid_from, value from c left join v on v.fact_key = c.base_fact_key and v.f <= c.knowledge_date and v.t > c.knowledge_date",
}
SQL["p3_extended"] = SQL["p3_ledger"]
