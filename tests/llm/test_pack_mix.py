"""Exact round trips, bounds, quotas; token counts against the tokenizer."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronofact.llm import mix, pack, queries, tokens
from tests.conftest import SF


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab 1.'\n\t\r\x0b\x1c\x85\xa0 é—日😀", max_size=40))
def test_counts_equal_the_tokenizer(text):
    known = tokens.sizes()
    assert tokens.count(text, known) == len(known.encode(text))


def test_counts_of_null_and_long_texts():
    known = tokens.sizes()
    assert tokens.count(None, known) == tokens.count("", known) == 0
    assert tokens.count("word " * 200_000, known) == len(known.encode("word " * 200_000))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_plan_holds_every_item_once(sizes):
    groups = pack.plan(Counter(sizes), 40)
    assert all(sum(g.sizes) <= 40 and g.containers > 0 for g in groups)
    packed = Counter()
    for g in groups:
        for s in g.sizes:
            packed[s] += g.containers
    assert packed == Counter(sizes)
    n = sum(g.containers for g in groups)
    assert n <= 1.25 * -(-sum(sizes) // 40) + 2


def test_exact_complements_are_used():
    groups = pack.plan({30: 2, 10: 1, 6: 1, 4: 1, 20: 1, 12: 1, 5: 1, 3: 1}, 40)
    assert sorted(sum(g.sizes) for g in groups for _ in range(g.containers)).count(40) >= 3
    with pytest.raises(ValueError):
        pack.plan({41: 1}, 40)


def test_pack_table(spark, monkeypatch):
    rng = random.Random(1)
    items = [(i, rng.choice([700, 350, rng.randint(1, 1800)])) for i in range(900)] + [(1000, 0), (1001, None), (1002, 1800), (1003, 5400), (1004, 4000)]
    df = spark.createDataFrame(items, "item_id bigint, size bigint").withColumn("rank", F.lit("clash")).withColumn("container", F.lit(1)).repartition(5)
    one = pack.ranked
    monkeypatch.setattr(pack, "ranked", lambda i, s, o: one(i, s, o, bucket_rows=20))  # a hot size in many buckets
    rows = pack.pack(df).collect()
    by = {}
    for r in rows:
        by.setdefault(r.container, []).append(r)
    assert all(sum(r.size for r in rs) <= 1800 for c, rs in by.items() if c is not None)
    assert sorted((r.item_id, r.pieces) for r in by[None]) == [(1000, 0), (1001, 0)]
    assert sorted(by[c] is not None for c in by if c is not None) and sorted(c for c in by if c is not None) == list(range(len(by) - 1))
    whole = Counter()
    for r in rows:
        whole[r.item_id] += r.size
    assert all(whole[i] == (n or 0) for i, n in items) and len(rows) == len(items) + 2 + 2
    assert sorted(r.item_id for r in rows if r.pieces > 1) == [1003] * 3 + [1004] * 3
    rep = pack.container_report(pack.pack(df)).first()
    assert rep.n_tokens == sum(n or 0 for _, n in items) and rep.unused_share < 0.05 and rep.largest <= 1800
    assert pack.pack(df.limit(0)).count() == 0


def test_documents_that_dont_fit(spark):
    docs = spark.createDataFrame([(1, "word " * 3000), (2, "short"), (3, None), (4, ""), (None, "word " * 9000)], "doc_id bigint, text string")
    got = pack.packed_documents(docs)
    assert {r.doc_id for r in got.where("pieces > 1").collect()} == {1} and got.select("doc_id").distinct().count() == 4


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=5), st.integers(1, 9))
def test_quotas_add_up(quotas, shards):
    q = mix.split_quotas(quotas, shards, 3)
    assert q.sum(axis=0).tolist() == quotas and (q >= 0).all()
    assert max(q.sum(axis=1)) - min(q.sum(axis=1)) <= np.log2(shards) + 2


@pytest.mark.parametrize("row_blocks", [mix.ROW_BLOCKS, 4])
def test_mix(spark, monkeypatch, row_blocks):
    monkeypatch.setattr(mix, "ROW_BLOCKS", row_blocks)  # small: a source's blocks are laid stretch by stretch
    monkeypatch.setattr(mix, "SHARD_TOKENS", 500)
    monkeypatch.setattr(mix, "BLOCK_RECORDS", 8)
    rng = random.Random(2)
    rows = [(i, s, rng.randint(1, 40)) for i, s in enumerate(rng.choices(["big", "mid", "rare", None], [60, 30, 4, 6], k=900))] + [(2000, "big", 0)]
    raw = spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint").withColumn("block", F.lit("clash"))
    targets = spark.createDataFrame([(1, " BIG\t", 0.5, 1, 0.5), (1, "mid", 0.3, 3, 0.5), (1, "mid", 0.3, 3, 0.5), (1, "Rare", 0.2, 4, 0.5), (2, "big", 1.0, 3, 2.0), (3, "nothing", 1.0, 2, 0.1)], "mix_id int, source string, target_share double, max_repeats int, total_vs_corpus double")
    total = sum(r[2] for r in rows)
    of = Counter()
    for _, s, n in rows:
        of[s] += n
    report = {(r.mix_id, r.source): r for r in mix.mix_report(raw, targets).collect()}
    assert len(report) == 5 and report[1, "Rare"].falls_short == (of["rare"] * 4 < 0.2 * 0.5 * total) and report[3, "nothing"].falls_short
    got = mix.mix(raw, targets).collect()
    drawn = Counter()
    times = Counter()
    for r in got:
        drawn[r.mix_id, r.source] += r.n_tokens
        times[r.mix_id, r.doc_id] += 1
        assert rows[r.doc_id][1] == r.source and r.n_tokens > 0
    for (m, s), r in report.items():
        key = s.strip().lower()
        want = min(of[key] * r.max_repeats, r.quota_tokens)
        assert want <= drawn[m, key] + 1e-6 and drawn[m, key] < want + 41
        assert all(n <= r.max_repeats for (x, d), n in times.items() if x == m and rows[d][1] == key)
    for m in (1, 2):
        shards = {r.shard for r in got if r.mix_id == m}
        assert len(shards) > 1
        for k in shards:
            assert sorted(r.place for r in got if (r.mix_id, r.shard) == (m, k)) == list(range(sum((r.mix_id, r.shard) == (m, k) for r in got)))
    assert len({(r.mix_id, r.doc_id, r.repeat) for r in got}) == len(got)
    assert mix.mix(raw.limit(0), targets).count() == 0 and mix.mix(raw, targets.limit(0)).count() == 0


def test_found_sources_come_from_the_draw(spark, monkeypatch):
    drawn = []
    one = mix.mix
    monkeypatch.setattr(mix, "mix", lambda *a, **k: drawn.append(1) or one(*a, **k))
    got = {tuple(r) for r in queries.p8_found(spark, SF).collect()}
    assert drawn and got == {tuple(r) for r in queries.p8_report(spark, SF).where("falls_short").select("mix_id", "source").collect()}
    bad = spark.createDataFrame([(1, "a", 5, 10.0, False)], "mix_id int, source string, drawn_tokens bigint, quota_tokens double, falls_short boolean")
    with pytest.raises(Exception, match="disagree"):
        queries.short_of_quota(bad).collect()
