"""P6 against a greedy loop."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronofact.llm import split


def greedy(text):
    kind, starts, ends = split.units(text, split.LIMIT - split.OVERLAP)
    out, i = [], 0
    while i < len(starts):
        low = starts[i] if i == 0 else max(0, starts[i] - split.OVERLAP)
        j = i
        while j + 1 < len(starts) and ends[j + 1] - low <= split.LIMIT:
            j += 1
        out.append(text[low : ends[j]])
        i = j + 1
    return kind, out


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 5))
def test_doubling_equals_the_greedy_loop(seed, n):
    rng = random.Random(seed)
    texts = []
    while len(texts) < n:
        kinds = rng.sample(["word ", "end. ", "\n\n", "\n \t\n", "x" * 40, "y" * 1400, " ", "e! "], rng.randint(1, 6))
        t = "".join(rng.choice(kinds) for _ in range(rng.randint(10, 1500)))
        if len(t) > split.LIMIT:
            texts.append(t)
    found = split.split_texts(texts)
    assert found == [greedy(t) for t in texts]
    for t, (_, pieces) in zip(texts, found, strict=True):
        assert all(len(p) <= split.LIMIT for p in pieces)
        # without the overlap, the pieces are the text but for white space between units
        own = pieces[0] + "".join(p[split.OVERLAP :] for p in pieces[1:])
        assert "".join(own.split()) == "".join(t.split())
        assert all(p[: split.OVERLAP] in t for p in pieces)


def test_boundaries():
    para, sent = "a b. " * 200, "word " * 240
    assert split.units("\n\n".join([para, para]), 1300)[0] == "paragraph"
    assert split.units("\n \n".join([para, para]), 1300)[0] == "paragraph"
    assert split.units(para * 3, 1300)[0] == "sentence" and split.units("\n".join([sent + "."] * 3), 1300)[0] == "sentence"
    assert split.units(sent * 3, 1300)[0] == "word" and split.units("z" * 5000, 1300)[0] == "char"
    assert split.split_texts([]) == []
    kind, pieces = split.split_texts(["z" * 5000])[0]
    assert [len(p) for p in pieces] == [1500, 1500, 1500, 1100] and kind == "char"
    assert split.split_texts([" " * 4000])[0][0] == "paragraph" and "".join(split.split_texts(["é" * 1501])[0][1])[:1] == "é"
    assert len(split.split_texts(["w " * 3_000_000])[0][1]) == 4616


def test_table(spark):
    long = "Sentence one is here. " * 200
    rows = [("c1", "a", "Item 1A", 3, long), ("c1", "a", "Item 1A", 3, long), ("c2", "a", "1a ", 1, "short"), ("c3", "a", "1a", 9, None), ("c4", None, None, None, ""), (None, "a", "1a", 1, long), ("c5", "a", "1a", 3, "tie")]
    c = spark.createDataFrame(rows, "chunk_id string, adsh string, section string, chunk_index int, text string").withColumn("piece", F.lit("clash")).withColumn("n_chars", F.lit(0))
    got = split.recut_chunks(c, bucket=2).orderBy("adsh", "section", "chunk_index").collect()
    own = [r for r in got if r.adsh == "a"]
    n = sum(r.chunk_id == "c1" for r in own)
    assert n == len(greedy(long)[1]) and [r.chunk_index for r in own] == list(range(n + 3)) and {r.section for r in own} == {"1a"}
    assert [r.chunk_id for r in own] == ["c2", *["c1"] * n, "c5", "c3"] and [r.chunk_id for r in got if r.adsh is None] == ["c4"]
    assert {r.boundary for r in own} == {None, "sentence"} and all(r.n_chars is None or r.n_chars <= split.LIMIT for r in got)
    assert split.recut_chunks(c.limit(0)).count() == 0 and split.oversized_pieces(c.limit(0)).count() == 0


def test_limit_and_overlap_are_parameters(spark):
    import pytest

    text = "Sentence one is here. " * 50
    c = spark.createDataFrame([("c", text)], "chunk_id string, text string")
    for limit, overlap in ((300, 50), (100, 0), (80, 33)):
        pieces = [r.text for r in split.oversized_pieces(c, limit, overlap).orderBy("piece").collect()]
        assert len(pieces) > 1 and all(len(p) <= limit for p in pieces)
        assert all(p[:overlap] in text and (not overlap or q.endswith(p[:overlap].rstrip()) or p[:overlap].strip() in q) for q, p in zip(pieces, pieces[1:], strict=False))
        assert "".join((pieces[0] + "".join(p[overlap:] for p in pieces[1:])).split()) == "".join(text.split())
    with pytest.raises(ValueError):
        split.split_texts([text], 100, 100)
