"""The driver's contract and the streams."""

from __future__ import annotations

import __spark_entry__ as entry
import pytest
from chronofact.streaming import ingest
from tests.conftest import SF


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q) and all(f"p{n}_found" in q for n in (1, 3, 4, 5))


@pytest.mark.parametrize("name", ["p1_found", "p3_found", "p4_found", "restatements", "data_quality", "company_quarter", "lexical_and_match"])
def test_against_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in ("facts", "submissions", "processed_manifest", "data_quality", "fact_versions", "comparisons", "chunks"):
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = entry.queries()[name](spark, SF)
    rel = c.sql(entry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(rel.columns)
    key = lambda rows, cols: sorted(str([r[cols.index(x)] if not isinstance(r[cols.index(x)], float) else round(r[cols.index(x)], 9) for x in sorted(cols)]) for r in rows)
    assert key(got.collect(), got.columns) == key(rel.fetchall(), rel.columns)


def test_stream_into_quarters(spark, tmp_path):
    src = spark.read.parquet(f"{SF}/facts.parquet")
    folder, path = str(tmp_path / "in"), str(tmp_path / "facts")
    src.repartition(3).write.parquet(folder)
    for _ in range(2):  # the second run finds nothing new
        ingest.keep_batches(ingest.stream_facts(spark, folder, src.schema, max_files=1), path, str(tmp_path / "cp")).awaitTermination(240)
    kept = ingest.read_batches(spark, path, src.schema)
    assert kept.count() == src.count() and kept.select(*src.columns).exceptAll(src).count() == 0
    ingest.write_batch(path, kept.where("quarter = '2020q1'").limit(1), 99)
    ingest.write_batch(path, kept.where("quarter = '2020q1'").limit(1), 99)  # run again
    assert ingest.read_batches(spark, path, src.schema).count() == src.count() + 1
    q = ingest.reports_per_day(ingest.stream_facts(spark, folder, src.schema)).writeStream.format("memory").queryName("per_day").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(240)
    assert spark.sql("select sum(n_facts) from per_day").first()[0] == src.where("knowledge_date is not null").count()
