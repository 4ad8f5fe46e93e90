"""Text, lexical and dense retrieval, index versions."""

from __future__ import annotations

import datetime
import json

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronofact.operators import index, lexical, pit, retrieval, text
from chronofact.plans import reference

BODY = {"1": "We make widgets for farms and schools. ", "1a": "Demand may fall and costs may rise in any year. ", "7": "Net sales grew on higher prices and new plants. "}
PAGE = (
    "<html><head><title>hidden title</title><style>p {color: red}</style></head><body><ix:header>hidden facts</ix:header><p>Item 1. Business 3</p><p>Item 1A. Risk Factors 9</p><p>Item 7. Discussion 20</p>"
    + "".join(f"<h2>Item {k.upper()}. {t}</h2><p>{BODY[k] * 14}</p>" for k, t in (("1", "Business"), ("1a", "Risk Factors"), ("7", "Management’s Discussion")))
    + "<script>var hidden = 1</script></body></html>"
)


def test_html_and_sections():
    t = text.html_to_text(PAGE)
    assert "hidden" not in t and "<" not in t and "Management's" in t
    s = text.split_sections(t)
    assert [x.item for x in s] == ["1", "1a", "7"] and s[1].title == "Risk Factors"
    assert text.html_to_text(None) == "" and text.html_to_text("<head><title>x<body>a<br>b&nbsp; c") == "a\nb c"
    assert [x.item for x in text.split_sections("short")] == ["full"]
    long = "\n".join(f"Item {k}. {'A very long title of an item ' * 3}45\n{'Body text of it. ' * 40}" for k in ("6", "7", "9"))
    assert [x.item for x in text.split_sections(long)] == ["6", "7", "9"]
    twice = f"Item 2. First place\n{'a ' * 250}\nItem 3. Other\n{'b ' * 300}\nItem 2. Second place\n{'c ' * 400}"
    assert [(x.item, x.text[0]) for x in text.split_sections(twice)] == [("3", "b"), ("2", "c")]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=30))
def test_chunks_are_bounded_and_stable(sizes):
    t = "\n\n".join(f"Paragraph {i} " + "word " * n for i, n in enumerate(sizes))
    c = text.chunk_text(t, 800, 100)
    assert c == text.chunk_text(t, 800, 100) and all(50 <= len(x) <= 900 for x in c)
    for a, b in zip(c, c[1:], strict=False):
        assert a[-60:].strip() in b[:140]


def test_chunk_table(spark):
    df = spark.createDataFrame([("a", PAGE), ("b", None), (None, PAGE), ("c", "")], "adsh string, text string").withColumn("section", F.lit("clash"))
    rows = text.chunk_documents(df, html=True).collect()
    assert {r.adsh for r in rows} == {"a"} and all(r.chunk_id == text.content_address(r.adsh, r.section, r.chunk_index, r.text) and r.n_chars == len(r.text) for r in rows)
    a, b = text.chunk_documents(df, html=True), text.chunk_documents(df, html=True, limit=300)
    assert text.changed_documents(a, a).count() == 0 and [r.adsh for r in text.changed_documents(a, b).collect()] == ["a"]


def test_stems():
    # examples published with the algorithm
    pairs = "caresses caress ponies poni ties ti cats cat feed feed agreed agre plastered plaster motoring motor sing sing conflated conflat troubled troubl sized size hopping hop falling fall hissing hiss fizzed fizz failing fail filing file happy happi sky sky relational relat conditional condit rational ration digitizer digit operator oper feudalism feudal decisiveness decis hopefulness hope formaliti formal triplicate triplic formative form formalize formal electrical electr goodness good revival reviv allowance allow inference infer airliner airlin adjustable adjust defensible defens irritant irrit replacement replac adoption adopt communism commun activate activ effective effect bowdlerize bowdler probate probat rate rate cease ceas controll control roll roll".split()
    for word, want in zip(pairs[::2], pairs[1::2], strict=True):
        assert lexical.stem(word) == want, word


def test_english_stems():
    # examples published with the algorithm
    pairs = "consign consign consigned consign consigning consign consignment consign consist consist consisted consist consistency consist consistent consist consistently consist consolation consol consolations consol consolatory consolatori console consol consoled consol consoles consol consoling consol consolingly consol knack knack knackeries knackeri knacks knack knaves knave knavish knavish kneaded knead kneading knead knee knee kneel kneel knees knee knelt knelt knew knew knick knick knife knife knightly knight knights knight knit knit knives knive knocking knock knoll knoll knot knot knots knot knowing know knowingly know knowledge knowledg known known gas gas gaps gap kiwis kiwi ties tie cries cri dying die skies sky news news inning inning succeed succeed hopping hop hoping hope luxuriated luxuri cry cri by by say say generate generat communism communism happily happili bank's bank".split()
    for word, want in zip(pairs[::2], pairs[1::2], strict=True):
        assert lexical.english_stem(word) == want, word
    assert lexical.english_stem("été") == "été" and lexical.english_stem("10k") == "10k" and lexical.english_stem("''") == "''"
    assert lexical.terms("The banks' prices", stemmer=lexical.stem) == [("bank", 2), ("price", 3)]


def test_query_grammar_and_density():
    q = lexical.parse_query('term "loan risks" -bank or prices')
    assert [x["need"] for x in q] == [["loan", "risk", "term"], ["price"]] and q[0]["without"] == ["bank"] and q[0]["phrases"] == [[["loan", 0], ["risk", 1]]]
    assert lexical.parse_query("the of") == [] and lexical.parse_query("") == []
    assert lexical.covers({"a": [1, 5], "b": [2, 9]}) == [(1, 2, 2), (2, 5, 2), (5, 9, 2)]
    assert lexical.cover_density({"a": [1], "b": [2]}) == pytest.approx(0.1) and lexical.cover_density({"a": [1], "b": [4]}) == pytest.approx(0.1 / 3)
    places = {"loan": [3], "risk": [4], "term": [9]}
    assert lexical.match_rank(q[0], places) is not None and lexical.match_rank(q[0], places | {"bank": [1]}) is None and lexical.match_rank(q[0], places | {"risk": [6]}) is None


def test_lexical_matches(spark):
    c = spark.createDataFrame([("c1", "The bank lends long term loans."), ("c2", "Loans carry risks; terms differ."), ("c3", None), ("c4", ""), ("c5", "prices")], "chunk_id string, text string")
    q = spark.createDataFrame([("q1", "loan term"), ("q2", "loan -bank"), ("q3", "the"), ("q4", None), ("q5", "nothing here"), ("q6", "bank or price")], "query_id string, query string")
    got = {(r.query_id, r.chunk_id) for r in lexical.lexical_matches(lexical.index_terms(c), q).collect()}
    assert got == {("q1", "c1"), ("q1", "c2"), ("q2", "c2"), ("q6", "c1"), ("q6", "c5")}


@settings(max_examples=100, deadline=None)
@given(st.permutations(range(8)))
def test_fusion_does_not_depend_on_row_order(order):
    # the formula itself; the frame version is checked against SQL
    ranks = {i: (i + 1, 8 - i) for i in range(8)}
    s = {i: sum(1 / (60 + r) for r in ranks[i]) for i in order}
    assert sorted(s, key=lambda i: (-round(s[i], 12), i)) == sorted(ranks, key=lambda i: (-round(sum(1 / (60 + r) for r in ranks[i]), 12), i))


def test_dense_topk_against_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((60, 8)).astype(np.float32)
    x[7] = x[3]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(100, None), (101, [1.0] * 3), (102, [0.0] * 8)]
    v = spark.createDataFrame(rows, "id bigint, embedding array<float>")
    q = v.where("id % 10 = 3").withColumnRenamed("id", "query_id")
    retrieval_block, retrieval.QUERY_BLOCK = retrieval.QUERY_BLOCK, 2
    try:
        got = {(r.query_id, r.rank): r.id for r in retrieval.dense_topk(v, q, 4, 8).collect()}
    finally:
        retrieval.QUERY_BLOCK = retrieval_block
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(3, 60, 10):
        s = np.round(u[i].astype(float) @ u.T.astype(float), 6)
        assert [got[i, k] for k in (1, 2, 3, 4)] == sorted(range(60), key=lambda j: (-s[j], j))[:4]
    assert retrieval.dense_topk(v.limit(0), q, 4, 8).count() == 0 and retrieval.dense_topk(v, q.limit(0), 4, 8).count() == 0


def test_metrics(spark):
    hits = spark.createDataFrame([("a", 1, 1), ("b", 9, 1), ("b", 2, 2), ("c", 9, 1)], "query_id string, id int, rank int")
    want = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4)], "query_id string, id int")
    assert tuple(retrieval.known_item_metrics(hits, want).first()) == (4, 0.25, 0.5, 0.375)
    assert tuple(retrieval.known_item_metrics(hits, want.limit(0)).first()) == (0, 0.0, 0.0, 0.0)
    df = spark.createDataFrame([(float(i),) for i in [5, 1, 4, 2, 3, 3]] + [(None,)], "x double")
    assert tuple(retrieval.index_percentiles(df, "x", {"p50": 0.5, "p95": 0.95}).first()) == (3.0, 5.0)
    assert tuple(retrieval.index_percentiles(df.limit(0), "x", {"p50": 0.5}).first()) == (None,)


def test_gate():
    ok = {"known_item_recall_at_5": 0.8, "section_hit_at_5": 0.6}
    assert index.promote_if(ok, None) == (True, [])
    assert not index.promote_if(ok | {"section_hit_at_5": 0.59}, None)[0]
    assert index.promote_if({"known_item_recall_at_5": 0.93, "section_hit_at_5": None}, {"known_item_recall_at_5": 0.95})[0]
    passed, why = index.promote_if({"known_item_recall_at_5": 0.7}, {"known_item_recall_at_5": 0.95})
    assert not passed and len(why) == 2


def test_index_life(spark, tmp_path):
    topics = ["widgets farms schools tractors", "loans banks interest default", "plants steel furnace energy", "software billing cloud servers"]
    chunks = spark.createDataFrame([(f"c{i}", f"ad{i % 2}", i % 2, "1a" if i % 2 else "7", i, " ".join([topics[i]] * 30) + f" item{i}") for i in range(4)], "chunk_id string, adsh string, cik int, section string, chunk_index int, text string")
    docs = spark.createDataFrame([("ad0", "10-Q", "A"), ("ad1", "10-K", "B")], "adsh string, form string, company string")
    ix = index.Index(spark, str(tmp_path / "ix"), chunks, docs, index.HashingEmbedder())
    with pytest.raises(LookupError):
        ix.search(["anything"])
    t = datetime.datetime(2025, 1, 1, tzinfo=datetime.UTC)
    v1 = ix.build("hybrid", t)
    assert v1 == "hashing-hybrid-20250101T000000Z" and ix.newest_candidate() == v1
    items = index.known_items(chunks)
    intents = spark.createDataFrame([("i1", "loans banks", 1, "1a"), ("i2", "plants", 0, "7")], "query_id string, query string, cik int, section string")
    m = ix.evaluate(v1, items, intents)
    assert m["n_known_item"] == 4 and m["known_item_recall_at_5"] == 1.0 and m["n_section_intent"] == 1 and m["section_hit_at_5"] == 1.0
    assert ix.decide(v1, m)["promoted"] and ix.promoted() == v1
    assert ix.decide(v1, m)["promoted"] and {r.status for r in ix.versions().collect()} == {"promoted"}  # again: it stays
    more = chunks.union(spark.createDataFrame([("c9", "ad1", 1, "7", 9, "new words here " * 50)], chunks.schema))
    ix.chunks = more
    v2 = ix.build("dense", t + datetime.timedelta(days=1))
    row = ix.versions().where(F.col("index_version") == v2).first()
    assert (row.n_chunks, row.n_embedded_new) == (5, 1) and ix.vectors(v2).count() == 5
    assert not ix.decide(v2, m | {"known_item_recall_at_5": 0.5})["promoted"] and ix.promoted() == v1
    assert ix.decide(v2, m)["promoted"] and {r.index_version: r.status for r in ix.versions().collect()} == {v1: "superseded", v2: "promoted"}
    assert index.stale_items(items, chunks.where("chunk_id <> 'c1'")).count() == 1
    hits = ix.search(["banks default interest"], k=2, version=v1).collect()
    assert hits[0].chunk_id == "c1" and hits[0].company == "B"
    assert [r.chunk_id for r in ix.search(["banks"], k=5, cik=0, version=v1).collect()].count("c1") == 0
    engine = pit.Engine(None, None, None, None, ix, ix.ledger())
    answer = engine.ask("banks default interest", k=2).first()
    assert answer.answer.startswith("loans") and len(answer.citations) == 2
    costs = {r.stage: r.n_runs for r in engine.costs().collect()}
    assert costs["documents.embed"] == 2 and costs["total"] == 2 + costs["documents.evaluate"]
    assert engine.index_history().count() == 2 and json.loads(ix.versions().first().eval)["promoted"] is not None


def test_questions_come_from_the_stated_set(spark):
    ids = [f"{i * 7919:015x}" + "f" * 17 for i in range(1000)]
    c = spark.createDataFrame([(i, "several sensible questions follow") for i in ids], "chunk_id string, text string")
    got = {r.query_id for r in reference._questions(c, 2).collect()}
    assert got == {i for i in ids if int(i[:15], 16) % 100 == 0} and len(got) == 10


def test_known_items_are_stored_and_drawn_anew_when_stale(spark, tmp_path):
    chunks = spark.createDataFrame([(f"c{i}", "a", 1, "7", i, f"word{i} " * 150) for i in range(6)], "chunk_id string, adsh string, cik int, section string, chunk_index int, text string")
    docs = spark.createDataFrame([("a", "10-K", "A", datetime.date(2024, 2, 1))], "adsh string, form string, company string, filed date")
    ix = index.Index(spark, str(tmp_path / "ix"), chunks, docs, index.HashingEmbedder())
    first = {r.id for r in ix.known_item_set(n=3).collect()}
    assert len(first) == 3 and {r.id for r in ix.known_item_set(n=5).collect()} == first  # stored
    ix.chunks = chunks.where(F.col("chunk_id") != sorted(first)[0])
    again = {r.id for r in ix.known_item_set(n=3).collect()}
    assert len(again) == 3 and sorted(first)[0] not in again
    ix.chunks = chunks
    version = ix.build("dense", ciks=[1])
    with pytest.raises(ValueError):
        ix.build("dense", ciks=[2])
    m = ix.evaluate(version, ix.known_item_set(), timed=2)
    assert m["known_item_recall_at_5"] == 1.0 and 0 < m["latency_p50_ms"] <= m["latency_p95_ms"]
    quality = spark.createDataFrame([("2024q1", 3)], "quarter string, n_facts int")
    engine = pit.Engine(None, None, None, quality, ix, ix.ledger())
    assert [(r.quarter, r.status, r.n_chunks, r.promoted_index) for r in engine.health().collect()] == [("2024q1", "degraded", 6, None)]
    ix.decide(version, m)
    assert engine.health().first().status == "ok" and engine.index_history().first().promoted
    assert pit.Engine(None, None, None, quality.limit(0), ix).health().first().status == "degraded"
    answer = engine.ask("word3 word3", k=2).first()
    assert answer.answer.startswith("word3") and answer.source == "A 10-K 2024-02-01 Item 7" and answer.citations[0].company == "A" and answer.index_version == version
    with pytest.raises(pit.NotFound):
        engine.ask("word3", cik=99)


def test_questions_within_their_company(spark):
    x = [[1.0, 0.0], [0.9, 0.1], [0.0, 1.0], [float("nan"), 1.0]]
    v = spark.createDataFrame([(i, i % 2, e) for i, e in enumerate(x)], "id int, cik int, embedding array<float>")
    q = spark.createDataFrame([("a", 0, [1.0, 0.0]), ("b", 1, [1.0, 0.0]), ("c", 7, [1.0, 0.0]), ("d", None, [1.0, 0.0])], "query_id string, cik int, embedding array<float>")
    got = {(r.query_id, r.rank): r.id for r in retrieval.dense_topk_within(v, q, "cik", 1, 2).collect()}
    assert got == {("a", 1): 0, ("b", 1): 1}


def test_percentiles_of_any_doubles(spark):
    import random

    rng = random.Random(3)
    xs = [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randrange(-300, 300) for _ in range(400)] + [0.0, -0.0, float("inf"), float("-inf"), 5e-324] * 3
    df = spark.createDataFrame([(x,) for x in xs] + [(float("nan"),), (None,)], "x double")
    want = [sorted(xs)[min(int(len(xs) * q), len(xs) - 1)] for q in (0.0, 0.31, 0.5, 0.95, 1.0)]
    assert list(retrieval.index_percentiles(df, "x", {f"p{i}": q for i, q in enumerate((0.0, 0.31, 0.5, 0.95, 1.0))}).first()) == want
    assert retrieval.index_percentiles(df.selectExpr("cast(7 as int) as x"), "x", {"p": 0.5}).first().p == 7
