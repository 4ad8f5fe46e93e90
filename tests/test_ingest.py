"""Archives, idempotent loading, gold tables on the golden fixture."""

from __future__ import annotations

import datetime
import io
import urllib.error

import pytest
from pyspark.sql import functions as F

from chronofact.functions import scalar
from chronofact.operators import checks, index, pit
from chronofact.schema import ContractError, FACTS, SUBMISSIONS, conform, normalize_for_publish, schema_differences
from chronofact.sources import documents
from chronofact.sources.archive import parse_archive
from chronofact.sources.ingest import Lakehouse, NotPublished, Pipeline, download
from chronofact.sources.store import ObjectStore, PartitionedTable, SwapTable
from tests.conftest import NUM, SUB, write_archive

NOW = datetime.datetime(2025, 4, 1)


def test_quarters():
    assert scalar.quarter_id(datetime.date(2025, 5, 1)) == "2025q2"
    assert scalar.latest_quarters(2, datetime.date(2025, 9, 23)) == ["2025q1", "2025q2"]
    assert scalar.quarters_since("2024q3", datetime.date(2025, 5, 1)) == ["2024q3", "2024q4", "2025q1"] and scalar.quarters_since("2026q1", datetime.date(2025, 5, 1)) == []
    assert scalar.latest_quarters(1, datetime.date(2025, 1, 5)) == ["2024q4"]


def test_parse(spark, archive):
    subs, facts = parse_archive(spark, archive, "2025q1", "abc", NOW)
    assert not schema_differences(subs, SUBMISSIONS) and not schema_differences(facts, FACTS)
    assert (subs.count(), facts.count()) == (3, 8)
    assert {r.filed for r in subs.collect()} == {datetime.date(2021, 1, 18), datetime.date(2021, 6, 7), datetime.date(2022, 1, 21)}
    assert {r.prevrpt for r in subs.where("form = '10-K/A'").collect()} == {True} and subs.where("nciks = 2 and detail").count() == 1
    assert facts.where("is_dimensional").count() == 2
    assert facts.where("fact_key = '7731|ProfitLoss|20200630|4|USD||'").count() == 2


def test_schema_drift_null_tokens_malformed_and_orphans(spark, tmp_path):
    num = [[c for c in NUM[0] if c != "segments"], ["0088-21-000417", "Assets", "us-gaap/2019", "20200630", "0", "USD", "NA", "500", "n/a"], ["0088-21-000417", "bad"], ["9999-99-999999", "Assets", "v", "20231231", "0", "USD", "", "1", ""]]
    _, facts = parse_archive(spark, write_archive(tmp_path / "a.zip", num=num), "2024q1", "x", NOW)
    rows = facts.collect()
    assert len(rows) == 1 and rows[0].segments is None and not rows[0].is_dimensional and rows[0].coreg is None and rows[0].footnote is None and rows[0].value == 500


def test_missing_member_and_required_null(spark, tmp_path):
    with pytest.raises(KeyError):
        parse_archive(spark, write_archive(tmp_path / "a.zip", num=None), "2024q1", "x", NOW)
    num = [NUM[0], ["0088-21-000417", "", "us-gaap/2019", "20200630", "4", "USD", "", "", "1", ""]]
    with pytest.raises(ContractError):
        parse_archive(spark, write_archive(tmp_path / "b.zip", num=num), "2024q1", "x", NOW)


def test_object_store(tmp_path):
    store = ObjectStore(str(tmp_path / "bronze"))
    f = tmp_path / "f"
    f.write_text("one")
    assert not store.put_file(str(f), "2025q1.zip")["skipped"]
    assert store.put_file(str(f), "2025q1.zip")["skipped"]
    f.write_text("two")
    assert not store.put_file(str(f), "2025q1.zip", source_url="u")["skipped"]
    assert [m["source_url"] for m in store.manifests("2025")] == ["u"] and not store.manifests("2024")


def test_pipeline_is_idempotent_and_replaces_one_quarter(spark, tmp_path, archive):
    lake = Lakehouse(spark, str(tmp_path / "lake"), ObjectStore(str(tmp_path / "bronze")))
    with pytest.raises(FileNotFoundError):
        lake.load_quarter("2025q1")
    other = write_archive(tmp_path / "2024q4.zip", [SUB[0], ["0088-20-000009", *SUB[1][1:]]], [NUM[0], ["0088-20-000009", *NUM[1][1:]]])
    files = {"2025q1": archive, "2024q4": other}

    def fetch(q):
        if q not in files:
            raise NotPublished(q)
        return files[q]

    out = Pipeline(lake, fetch).run(["2025q1", "2024q4", "2030q1"])
    assert [x["skipped"] for x in out["loaded"]] == [False, False]
    assert [x["skipped"] for x in Pipeline(lake, fetch).run(["2024q4", "2025q1"])["loaded"]] == [True, True]
    assert lake.facts.read().count() == 9
    files["2025q1"] = write_archive(tmp_path / "changed.zip", num=NUM[:4])
    lake.bronze.put_file(files["2025q1"], "2025q1.zip")
    assert lake.load_quarter("2025q1")["n_facts"] == 3
    assert lake.facts.read().count() == 4 and lake.facts.read().where("quarter = '2024q4'").count() == 1
    lake.facts.replace(lake.facts.read().limit(0), "2024q4")  # an empty frame empties the quarter
    assert lake.facts.read().where("quarter = '2024q4'").count() == 0


def test_gold_goldens(spark, tmp_path, archive):
    lake = Lakehouse(spark, str(tmp_path / "lake"), ObjectStore(str(tmp_path / "bronze")))
    lake.bronze.put_file(archive, "2025q1.zip")
    lake.load_quarter("2025q1")
    gold = lake.build_gold()
    v = gold["fact_versions"]
    d = datetime.date
    loss = "fact_key = '7731|ProfitLoss|20200630|4|USD||'"
    assert [tuple(r) for r in v.where(loss).orderBy("valid_from").select("value", "valid_from", "valid_to", "version_no", "n_versions", "is_latest", "footnote").collect()] == [
        (-64.5, d(2021, 1, 18), d(2021, 6, 7), 1, 2, False, None),
        (-80.625, d(2021, 6, 7), d(9999, 12, 31), 2, 2, True, "inventory corrected"),
    ]
    assert checks.not_single_latest(v).count() == 0 and checks.gaps_in_windows(v).count() == 0
    assert sorted(tuple(r) for r in v.where("is_dimensional").select("segments", "value", "n_versions").collect()) == [("PlantAxis=FenMillMember;", 515.0, 1), ("PlantAxis=MossMillMember;", 940.0, 1)]
    known = {day: [r.value for r in pit.as_of(v, day).where(loss).collect()] for day in ("2021-01-17", "2021-06-06", "2021-06-07")}
    assert known == {"2021-01-17": [], "2021-06-06": [-64.5], "2021-06-07": [-80.625]}
    # the assets were filed again unchanged: two versions, and no restatement
    assert [(x.tag, x.abs_change, x.rel_change, x.days_between, x.latest_footnote) for x in gold["restatements"].collect()] == [("ProfitLoss", -16.125, -0.25, 140, "inventory corrected")]
    c = {x.fy: x for x in gold["company_quarter"].collect()}
    assert set(c) == {2020, 2021} and {x.company_name for x in c.values()} == {"HOLLOW REED MILLING"} and {x.fp for x in c.values()} == {"FY"}
    assert (c[2020].net_income, c[2020].total_assets, c[2020].net_income_first_reported) == (-80.625, 2210, d(2021, 1, 18)) and (c[2021].net_income, c[2021].total_assets, c[2021].revenue) == (31, 2475, None)
    q = gold["data_quality"].first()
    assert (q.quarter, q.n_submissions, q.n_10k, q.n_facts, q.pct_filings_with_facts, q.n_restated_facts, q.n_ambiguous_facts) == ("2025q1", 3, 3, 8, 100.0, 1, 0)
    engine = pit.Engine(v, gold["restatements"], gold["company_quarter"], gold["data_quality"])
    assert [x.value for x in engine.facts(7731, "Assets", "2022-06-30").collect()] == [2475.0, 515.0, 940.0, 2210.0]
    assert engine.history(7731, "ProfitLoss", "2020-06-30").count() == 2
    assert engine.company(7731).first().fy == 2021 and engine.restatements(cik=7731).count() == 1 and engine.restatements(cik=0).count() == 0
    with pytest.raises(pit.NotFound):
        engine.facts(7731, "Nothing")
    assert engine.health().first().promoted_index is None


def test_download(tmp_path):
    calls = []

    def flaky(url):
        calls.append(url)
        if len(calls) < 3:
            raise ConnectionError
        return io.BytesIO(b"x")

    waits: list[float] = []
    assert open(download("u", str(tmp_path / "f"), open_url=flaky, sleep=waits.append), "rb").read() == b"x" and waits == [1, 2]

    def gone(url):
        raise urllib.error.HTTPError(url, 404, "", {}, None)

    with pytest.raises(NotPublished):
        download("u", str(tmp_path / "f"), open_url=gone)


def test_normalize_and_conform(spark):
    df = spark.sql("select cast(1.5 as decimal(9,2)) as a, cast(1 as smallint) as b, 'x' as c")
    assert normalize_for_publish(df).dtypes == [("a", "double"), ("b", "bigint"), ("c", "string")]
    with pytest.raises(ContractError):
        conform(df, FACTS)


def test_urls(spark):
    df = spark.createDataFrame([(7731, "0088-22-000381", "reed-20210630_htm.xml")], "cik int, adsh string, instance string")
    assert df.select(scalar.document_url("https://x.example/", F.col("cik"), F.col("adsh"), F.col("instance"))).first()[0] == "https://x.example/7731/008822000381/reed-20210630.htm"


def test_documents_are_replaced_one_by_one(spark, tmp_path):
    c = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3"), ("c", "4")], "adsh string, chunk_id string")
    new = spark.createDataFrame([("b", "5"), ("d", "6"), (None, "7")], "adsh string, chunk_id string")
    assert sorted(tuple(r) for r in documents.replace_documents(c, new).collect()) == [("a", "1"), ("a", "2"), ("b", "5"), ("c", "4"), ("d", "6")]
    anew = spark.createDataFrame([("a", "2"), ("a", "1"), ("b", "9")], "adsh string, chunk_id string")
    out, changed = documents.rechunk(c, anew)
    assert sorted(r.adsh for r in changed.collect()) == ["b", "c"] and sorted(tuple(r) for r in out.collect()) == [("a", "1"), ("a", "2"), ("b", "9")]
    subs = spark.createDataFrame([("x", 1, "10-Q", "i", 3), ("y", 1, "10-K", "i", 2), ("y", 1, "10-K", "i", 2), ("z", 1, "10-K", "", 1), ("w", 2, "10-K", "i", 1)], "adsh string, cik int, form string, instance string, filed int")
    got = documents.filings_to_fetch(subs, spark.createDataFrame([(1,), (1,)], "cik int"), ["10-K", "10-Q"], 5).orderBy("place")
    assert [r.adsh for r in got.collect()] == ["y", "x"]
    (tmp_path / "q.jsonl").write_text('{"query": "a", "cik": 1}\n\n{"query": "b"}\n')
    assert [tuple(r) for r in documents.read_jsonl(spark, str(tmp_path / "q.jsonl"), "query string, cik int").orderBy("query").collect()] == [("a", 1), ("b", None)]
    reports = documents.Reports(str(tmp_path / "reports"))
    reports.write({"index_version": "v", "promoted": True})
    assert reports.read("v")["promoted"]


def test_document_run(spark, tmp_path, archive):
    subs, _ = parse_archive(spark, archive, "2025q1", "abc", NOW)
    pages = {"reed-20210630.htm": "<html><body><p>Item 1. Business</p><p>" + "We mill reeds. " * 300 + "</p></body></html>"}
    asked, waits = [], []

    def fetch(url, path):
        asked.append(url)
        with open(path, "w") as f:
            f.write(pages.get(url.rsplit("/", 1)[-1], "<p>" + "Older mill report. " * 20 + "</p>"))

    ledger = SwapTable(spark, str(tmp_path / "ledger"), "run_at timestamp, stage string, units string, quantity double, usd double, detail string")
    config = tmp_path / "companies.json"
    config.write_text('{"companies": [{"cik": 7731, "name": "Hollow Reed"}, {"cik": 5}], "forms": ["10-K", "10-K/A"]}')
    companies, forms = documents.read_companies(str(config))
    run = documents.DocumentRun(spark, str(tmp_path / "docs"), ObjectStore(str(tmp_path / "bronze")), fetch, str(tmp_path / "landing"), "https://x.example", ledger, sleep=waits.append, batch=2)
    first = run.run(subs, companies, forms, 10)
    assert (first["seen"], first["fetched"], first["skipped"]) == (3, 3, 0) and first["chunks"] == run.chunks.read().count() > 3 and waits == [0.15] * 3
    assert asked[0] == "https://x.example/7731/008821000417/reed-20200630.htm"
    assert {(r.form, r.company) for r in run.documents.read().collect()} == {("10-K", "HOLLOW REED MILLING"), ("10-K/A", "HOLLOW REED MILLING"), ("10-K", "HOLLOW REED GROUP")}
    assert run.run(subs, companies, forms, 10) == {"seen": 3, "fetched": 0, "skipped": 3, "chunks": 0, "bytes": 0}
    pages["reed-20210630.htm"] = "<p>" + "Reeds are scarce now. " * 10 + "</p>"
    again = run.run(subs, companies, forms, 10)
    assert (again["fetched"], again["skipped"]) == (1, 2) and run.documents.read().count() == 3
    assert [r.section for r in run.chunks.read().where("adsh = '0088-22-000381'").collect()] == ["full"]
    assert ledger.read().count() == 3 and len(list((tmp_path / "ledger").glob("v*"))) == 1  # appends add files
    (tmp_path / "bad.json").write_text('{"companies": [{"name": "x"}]}')
    with pytest.raises(ValueError):
        documents.read_companies(str(tmp_path / "bad.json"))


def test_stores_through_spark_file_systems(spark, tmp_path):
    store = ObjectStore(f"file://{tmp_path}/bronze", spark)
    f = tmp_path / "f"
    f.write_text("one")
    assert store.manifest("a/x.zip") is None and list(store.manifests()) == []
    assert not store.put_file(str(f), "a/x.zip", source_url="u")["skipped"] and store.put_file(str(f), "a/x.zip")["skipped"]
    assert [m["key"] for m in store.manifests("a/")] == ["a/x.zip"] and (tmp_path / "bronze/a/x.zip").read_text() == "one"
    parse_archive(spark, "file://" + write_archive(tmp_path / "z.zip"), "2025q1", "s", NOW)
    table = PartitionedTable(spark, str(tmp_path / "facts"), FACTS)
    table.ensure("default.ensured_facts")
    table.ensure("default.ensured_facts")
    assert spark.table("default.ensured_facts").count() == 0 and not schema_differences(table.read(), FACTS)
    spark.sql("drop table default.ensured_facts")


def test_malformed_lines_are_counted_and_views_served(spark, tmp_path):
    lake = Lakehouse(spark, str(tmp_path / "lake"), ObjectStore(str(tmp_path / "bronze")))
    lake.bronze.put_file(write_archive(tmp_path / "a.zip", num=[*NUM, ["broken"], ["too", "short"]]), "2025q1.zip")
    out = lake.load_quarter("2025q1")
    assert (out["n_facts"], out["n_malformed"], out["malformed"]["num.txt"]) == (8, 2, 2)
    lake.build_gold()
    names = lake.serve("served")
    assert spark.table("served.fact_versions").count() == 8 and len(names) == 4
    spark.sql("drop database served cascade")


def test_whole_pipeline(spark, tmp_path, archive):
    lake = Lakehouse(spark, str(tmp_path / "lake"), ObjectStore(str(tmp_path / "bronze")))
    chunks = spark.createDataFrame([(f"c{i}", "a", 1, "7", i, f"word{i} " * 150) for i in range(3)], "chunk_id string, adsh string, cik int, section string, chunk_index int, text string")
    ix = index.Index(spark, str(tmp_path / "ix"), chunks, spark.createDataFrame([("a", "10-K")], "adsh string, form string"), index.HashingEmbedder())
    out = Pipeline(lake, lambda q: archive, documents=lambda: {"seen": 0}, index=ix).run(["2025q1"])
    assert out["documents"] == {"seen": 0} and out["evaluation"]["promoted"] and ix.promoted() is not None
    with pytest.raises(checks.CheckFailed):
        checks.require_promoted(None)


def test_answer_cost(spark):
    df = spark.createDataFrame([("a", 1_000_000, 100_000), ("b", 1_000_000, 100_000), (None, 0, 0)], "model string, asked int, answered int")
    assert [r[0] for r in df.select(scalar.answer_cost(F.col("model"), F.col("asked"), F.col("answered"), {"a": (1.0, 5.0)})).collect()] == [1.5, 4.5, 0.0]
