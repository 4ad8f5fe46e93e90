"""Held-out accuracy on labelled documents, and dirt."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from chronofact.llm import reading

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy():
    docs = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text", "lang"]).to_pylist() if r["lang"] == "en" and r["text"]}
    rows = [(docs[r["doc_id"]], r["reading_level"]) for r in sorted(pq.read_table(f"{SF}/reading_labels.parquet").to_pylist(), key=lambda r: r["doc_id"]) if r["doc_id"] in docs]
    right = 0
    for k in range(2):
        model = reading.train([t for i, (t, _) in enumerate(rows) if i % 2 != k], [v for i, (_, v) in enumerate(rows) if i % 2 != k])
        held = [r for i, r in enumerate(rows) if i % 2 == k]
        b = pa.record_batch({"doc_id": pa.array(range(len(held))), "text": pa.array([t for t, _ in held])})
        right += sum(a == v for a, (_, v) in zip(next(iter(reading._grade(model)(iter([b])))).column(1).to_pylist(), held, strict=True))
    assert right / len(rows) >= 0.9


def test_sentences():
    w = reading.Words()
    words, first = reading.sentences("One two. Three <br> four!\n\n 12,000 \n", w)
    assert len(words) == 4 and first.tolist() == [0, 2, 3]
    assert [len(x) for x in reading.sentences("", w)] == [0, 0] and [len(x) for x in reading.sentences("12 — 7", w)] == [0, 0]
    assert reading.document_features(np.zeros((0, 3)), np.zeros(0), np.zeros(0, dtype=int), 2)[:, -1].tolist() == [1, 1]


def test_levels_table(spark):
    easy, hard = "We sell pans. The shop is shut. You may lose it all. ", "Notwithstanding the aforementioned indemnification, derecognition presupposes crystallization. "
    rows = [(i, easy * (1 + i % 3), "en") for i in range(0, 20)] + [(i, hard * (1 + i % 3), "en") for i in range(20, 40)]
    rows += [(50, easy, "en"), (51, hard, "en"), (52, None, "en"), (53, "", "en"), (54, "12 — 3", "en"), (55, easy, "fr"), (56, easy, None), (57, "word " * 300_000, "en"), (58, easy, "en")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("reading_level", F.lit("clash"))
    labels = spark.createDataFrame([(i, 1) for i in range(20)] + [(i, 3) for i in range(20, 40)] + [(3, 1), (None, 2), (58, 9)], "doc_id bigint, reading_level int")
    got = {r.doc_id: r for r in reading.reading_levels(docs, labels).collect()}
    assert got[50].reading_level == 1 and got[51].reading_level == 3 and len(got) == len(rows)
    assert got[55].reading_level is None and got[56].reading_level is None and got[55].n_sentences == 0  # no label is in their language
    texts, levels, langs = reading.labelled_sample(docs, labels.union(spark.createDataFrame([(57, 2)], labels.schema)))
    assert langs == ["en"] and len(texts) == 41 and max(map(len, texts)) < reading.SAMPLE_SENTENCES * reading.SAMPLE_WORDS * 16
    assert got[52].reading_level is None and got[54].n_sentences == 0 and got[50].n_sentences == got[50].sentences_1 + got[50].sentences_2 + got[50].sentences_3
    found = {r.doc_id: r.reading_level for r in reading.unlabelled_levels(docs, labels).collect()}
    assert set(found) == {50, 51, 57} and found[50] == 1
    assert all(r.reading_level is None for r in reading.reading_levels(docs, labels.limit(0)).collect())
    assert reading.reading_levels(docs.limit(0), labels.limit(0)).count() == 0
