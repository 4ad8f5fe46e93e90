"""Versions, marts and checks: edge cases beyond the goldens."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from chronofact.operators import bitemporal, checks, marts, versions
from chronofact.schema import FACT_VERSIONS, FACTS, SUBMISSIONS, schema_differences

D = datetime.date
T0 = datetime.datetime(2024, 1, 1)


def fact(adsh, key, value, day, footnote=None, **more):
    row = dict(adsh=adsh, cik=1, tag="T", version="v", ddate=D(2023, 12, 31), qtrs=4, uom="USD", value=value, coreg=None, footnote=footnote, form="10-K", fy=2023, fp="FY", knowledge_date=day, fact_key=key, quarter="2024q1", source_sha256="s", loaded_at=T0, segments=None, is_dimensional=False)
    return row | more


def sub(adsh, accepted, **more):
    row = {f.name: None for f in SUBMISSIONS} | dict(adsh=adsh, cik=1, accepted=accepted, quarter="2024q1", source_sha256="s", loaded_at=T0, name="A")
    return row | more


def frames(spark, facts, subs):
    nullable = lambda t: StructType([StructField(x.name, x.dataType) for x in t])
    f = spark.createDataFrame([tuple(r[c] for c in FACTS.names) for r in facts], nullable(FACTS))
    s = spark.createDataFrame([tuple(r[c] for c in SUBMISSIONS.names) for r in subs], nullable(SUBMISSIONS))
    return f, s


CASES = [
    fact("a", "k", 1.0, D(2024, 1, 1)), fact("a", "k", 1.0, D(2024, 1, 1)),  # repeated row
    fact("b", "k", 2.0, D(2024, 1, 5)), fact("c", "k", 3.0, D(2024, 1, 5)),  # same day, c accepted before b
    fact("d", "k", 4.0, D(2024, 2, 1)), fact("d", "k", 5.0, D(2024, 2, 1)),  # contradicts itself
    fact("e", "k", None, D(2024, 3, 1)), fact("e", "k", 6.0, D(2024, 3, 1), footnote="z"),  # null and a value, footnote first
    fact("orphan", "k", 9.0, D(2024, 4, 1)), fact("a", "other", None, D(2024, 1, 1)),
]
SUBS = [sub("a", T0), sub("a", T0), sub("b", None), sub("c", T0), sub("d", T0), sub("e", T0)]


def test_order_ambiguity_and_ties(spark):
    f, s = frames(spark, CASES, SUBS)
    for hot in (bitemporal.HOT_ROWS, 0):
        v = versions.fact_versions(f, s, hot_rows=hot)
        assert not schema_differences(v, FACT_VERSIONS)
        rows = [tuple(r) for r in v.where("fact_key = 'k'").orderBy("version_no").select("adsh", "value", "valid_from", "valid_to", "n_versions").collect()]
        assert rows == [("a", 1.0, D(2024, 1, 1), D(2024, 1, 5), 4), ("c", 3.0, D(2024, 1, 5), D(2024, 1, 5), 4), ("b", 2.0, D(2024, 1, 5), D(2024, 3, 1), 4), ("e", 6.0, D(2024, 3, 1), D(9999, 12, 31), 4)]
        assert checks.not_single_latest(v).count() == 0 and checks.gaps_in_windows(v).count() == 0
    assert [tuple(r) for r in versions.ambiguous_pairs(f).collect()] == [("d", "k")]


def test_hot_keys_are_numbered_alike(spark, monkeypatch):
    monkeypatch.setattr(bitemporal, "HOT_TIMES", 0)
    rows = [fact(f"f{i:03d}", "hot" if i % 3 else f"k{i % 7}", float(i % 5), D(2024, 1, 1 + i % 9)) for i in range(200)]
    f, s = frames(spark, rows, [sub(f"f{i:03d}", T0 + datetime.timedelta(minutes=i % 4)) for i in range(200)])
    a, b = versions.fact_versions(f, s), None
    orig = versions.hot_buckets
    versions.hot_buckets = lambda keys, least: orig(keys, 5, 0)
    try:
        b = versions.fact_versions(f, s)
        assert a.exceptAll(b).count() == 0 and a.count() == b.count() == 200
    finally:
        versions.hot_buckets = orig


def test_many_filings_are_joined_alike(spark):
    """Beyond the limit of the broadcast: the same versions, and reports are shuffled as often."""
    f, s = frames(spark, CASES, SUBS)
    a, b = versions.fact_versions(f, s), versions.fact_versions(f, s, filings_broadcast=0)
    assert a.count() == b.count() == 5 and a.exceptAll(b).count() == 0
    rows = [fact(f"f{i % 40:02d}", f"k{i % 23}", float(i % 4), D(2024, 1, 1 + i % 40 % 6)) for i in range(300)]
    f, s = frames(spark, rows, [sub(f"f{i:02d}", T0 + datetime.timedelta(minutes=-i % 7) if i % 5 else None) for i in range(38)])
    a, b = versions.fact_versions(f, s), versions.fact_versions(f, s, filings_broadcast=0)
    assert a.exceptAll(b).count() == 0 and a.count() == b.count() > 50
    x, y = bitemporal.fact_ledger(f, s), bitemporal.fact_ledger(f, s, filings_broadcast=0)
    assert x.exceptAll(y).count() == 0 and x.count() == y.count() > 20
    wide = [str(d._jdf.queryExecution().executedPlan()) for d in (versions.fact_versions(f, s), versions.fact_versions(f, s, filings_broadcast=0))]
    by_key = [sum("Exchange hashpartitioning(fact_key" in line and "Reused" not in line for line in p.splitlines()) for p in wide]
    assert by_key[0] == 1 and by_key[1] <= 3  # both branches, of which the second reuses the first's, and the shared days


def test_empty_tables_and_extra_columns(spark):
    f, s = frames(spark, [], [])
    v = versions.fact_versions(f, s)
    assert v.count() == 0 and marts.restatements(v).count() == 0 and marts.company_quarter(v, s).count() == 0
    assert marts.data_quality(f, s, v.agg(F.count(F.lit(1)).alias("n_restated_facts"))).count() == 0
    f, s = frames(spark, CASES, SUBS)
    extra = versions.fact_versions(f.withColumn("accepted", F.lit("x")).withColumn("rn", F.lit(1)), s.withColumn("value", F.lit(0)))
    assert extra.count() == 5


def test_back_and_forth_is_no_restatement(spark):
    f, s = frames(spark, [fact("a", "k", 1.0, D(2024, 1, 1)), fact("b", "k", 2.0, D(2024, 1, 5)), fact("c", "k", 1.0, D(2024, 2, 1)), fact("a", "n", None, D(2024, 1, 1)), fact("b", "n", 2.0, D(2024, 1, 5)), fact("a", "z", 0.0, D(2024, 1, 1)), fact("b", "z", 2.0, D(2024, 1, 5))], [sub(x, T0) for x in "abc"])
    r = {x.fact_key: x for x in marts.restatements(versions.fact_versions(f, s)).collect()}
    assert set(r) == {"n", "z"} and r["n"].rel_change is None and r["z"].rel_change is None and r["z"].abs_change == 2


def test_checks(spark):
    df = spark.createDataFrame([(1, "FY", 1.0), (1, "X", None), (None, None, 200.0), (None, "Q1", float("nan"))], "a int, fp string, x double")
    assert checks.not_null(df, "a").count() == 2
    assert sorted(tuple(r) for r in checks.duplicates(df, "a").select("n_rows").collect()) == [(2,), (2,)]
    assert [r.fp for r in checks.not_accepted(df, "fp", ["FY", "Q1"]).collect()] == ["X"]
    assert checks.out_of_range(df, "x", 0, 100).count() == 2
    assert checks.orphans(df, df.where("a = 1"), "a").count() == 2
    assert checks.require_none("w", df, severity="warn") == 4
