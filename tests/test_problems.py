"""Profile, ledger, as-of trees, packed fields: against brute force, with dirty input."""

from __future__ import annotations

import datetime
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronofact.operators import asof, bitemporal, profile, segments
from chronofact.session import clear_work, cut
from tests.test_versions import frames, fact, sub

D = datetime.date
T0 = datetime.datetime(2024, 1, 1)

# --- P3 -------------------------------------------------------------------------------------------------------------


def brute_belief(rows, at):
    """Versions believed at a recording day: rows (day, r_from, r_to, rank, value)."""
    days: dict[int, tuple] = {}
    for day, a, b, rank, value in rows:
        if a <= at < b and (day not in days or rank > days[day][0]):
            days[day] = (rank, value)
    out, last = [], None
    for day in sorted(days):
        if last is None or days[day][1] != last:
            out.append((day, days[day][1]))
            last = days[day][1]
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 6), st.integers(1, 6), st.integers(1, 7), st.integers(1, 3)), min_size=1, max_size=12))
def test_sweep_equals_brute_force_at_every_recording_day(raw):
    rows = [(d, a, bitemporal.FOREVER if b == 7 else a + b, i, float(v)) for i, (d, a, b, v) in enumerate(raw)]
    rows.sort(key=lambda r: (r[0], r[3], r[1]))
    valid, a, b, value = (np.array(x) for x in zip(*((r[0], r[1], r[2], r[4]) for r in rows), strict=True))
    ledger = bitemporal.sweep_key(valid, a, b, value)
    for now in range(0, 16):
        seen = sorted((f, value[row]) for row, f, _, r0, r1, _ in ledger if r0 <= now < r1)
        assert seen == brute_belief(rows, now)
        spans = sorted((f, t) for _, f, t, r0, r1, _ in ledger if r0 <= now < r1)
        assert all(x[1] == y[0] for x, y in zip(spans, spans[1:], strict=False)) and (not spans or spans[-1][1] == bitemporal.FOREVER)


def test_ledger_late_load_and_withdrawal(spark):
    late = dict(loaded_at=datetime.datetime(2024, 9, 1))
    rows = [fact("a", "k", 1.0, D(2024, 1, 1)), fact("c", "k", 3.0, D(2024, 3, 1)), fact("b", "k", 2.0, D(2024, 2, 1), **late), fact("c", "k", 4.0, D(2024, 3, 1), **late), fact("x", "n", None, D(2024, 1, 1)), fact("a", None, 1.0, D(2024, 1, 1))]
    f, s = frames(spark, rows, [sub("a", T0)])
    led = bitemporal.fact_ledger(f, s)
    now = [tuple(r) for r in led.where("recorded_to = date'9999-12-31'").orderBy("valid_from").select("value", "valid_from", "valid_to", "version_no").collect()]
    assert now == [(1.0, D(2024, 1, 1), D(2024, 2, 1), 1), (2.0, D(2024, 2, 1), D(9999, 12, 31), 2)]
    old = {tuple(r) for r in led.where("recorded_to <> date'9999-12-31'").select("value", "valid_from", "valid_to", "recorded_to").collect()}
    assert old == {(1.0, D(2024, 1, 1), D(2024, 3, 1), D(2024, 9, 1)), (3.0, D(2024, 3, 1), D(9999, 12, 31), D(2024, 9, 1))}
    empty, none = frames(spark, [], [])
    assert bitemporal.fact_ledger(empty, none).count() == 0
    assert bitemporal.fact_ledger(f.withColumn("key", F.lit("clash")).withColumn("valid", F.lit(1)), s).count() == led.count()


def test_a_load_extends_the_ledger(spark):
    rng = random.Random(8)
    rows = [fact(f"f{rng.randrange(30)}", f"k{rng.randrange(12)}", rng.choice([None, 1.0, 2.0, 3.0]), D(2024, 1, 1 + rng.randrange(9)), loaded_at=T0 + datetime.timedelta(days=rng.randrange(6))) for _ in range(250)] + [fact("f1", None, 1.0, D(2024, 1, 1))]
    f, s = frames(spark, rows, [sub(f"f{i}", T0 + datetime.timedelta(minutes=i % 5)) for i in range(30)])
    day = F.to_date("loaded_at")
    ledger, seen = bitemporal.fact_ledger(f.limit(0), s), f.limit(0)
    for n in range(6):
        load = f.where(day == F.lit(T0.date() + datetime.timedelta(days=n)))
        ledger = cut(bitemporal.extend_ledger(ledger, seen, load, s))
        seen = seen.unionByName(load)
    whole = bitemporal.fact_ledger(f, s)
    assert whole.count() > 30 and whole.exceptAll(ledger).count() == 0 and ledger.count() == whole.count()
    assert bitemporal.extend_ledger(ledger, f, f.limit(0), s).exceptAll(whole).count() == 0


def test_hot_keys_give_the_same_ledger(spark, monkeypatch):
    rng = random.Random(3)
    rows = [fact(f"f{rng.randrange(40)}", rng.choice(["hot", "hot", "k1", "k2"]), float(rng.randrange(3)), D(2024, 1, 1 + rng.randrange(9)), loaded_at=T0 + datetime.timedelta(days=rng.randrange(5))) for _ in range(300)]
    f, s = frames(spark, rows, [sub(f"f{i}", T0 if i % 2 else None) for i in range(40)])
    cold = bitemporal.fact_ledger(f, s)
    orig = bitemporal.hot_buckets
    monkeypatch.setattr(bitemporal, "hot_buckets", lambda keys, least: orig(keys, 10, 0))
    hot = bitemporal.fact_ledger(f, s)
    assert cold.exceptAll(hot).count() == 0 and cold.count() == hot.count() > 0


# --- P4 -------------------------------------------------------------------------------------------------------------


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 9), st.integers(0, 9), st.integers(1, 6)), max_size=25), st.lists(st.tuples(st.integers(0, 3), st.integers(0, 12), st.integers(0, 12)), min_size=1, max_size=20))
def test_trees_equal_brute_force(versions, events):
    v = sorted((e, k, s, s + n) for e, k, s, n in versions)
    cols = [np.array(c, dtype=np.int64) for c in zip(*v, strict=True)] if v else [np.zeros(0, dtype=np.int64)] * 4
    trees = asof.PersistentTrees(*cols)
    ask = [np.array(c, dtype=np.int64) for c in zip(*events, strict=True)]
    for (e, known, valid), at in zip(events, trees.find(*ask), strict=True):
        fits = [(s, i) for i, (x, k, s, t) in enumerate(v) if x == e and k <= known and s <= valid < t]
        assert (at >= 0) == bool(fits)
        if fits:
            assert v[at][2] == max(fits)[0] and v[at][1] <= known and v[at][3] > valid


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-9, 9), st.integers(-9, 9), st.integers(1, 6)), max_size=25), st.lists(st.tuples(st.integers(0, 3), st.integers(-12, 12), st.integers(-12, 12)), min_size=1, max_size=20), st.sampled_from([0, -719_000, -3000]))
def test_trees_before_1970(versions, events, shift):
    test_trees_equal_brute_force.hypothesis.inner_test([(e, k + shift, s + shift, n) for e, k, s, n in versions], [(e, k + shift, v + shift) for e, k, v in events])


def test_as_of_before_1970(spark):
    versions = spark.createDataFrame([("k", 1, D(1969, 9, 23), D(1970, 1, 11)), ("k", 2, D(1970, 1, 11), D(9999, 12, 31))], "fact_key string, version_no bigint, valid_from date, valid_to date")
    events = spark.createDataFrame([(1, "k", D(1969, 11, 12)), (2, "k", D(1970, 1, 21)), (3, "k", D(1969, 9, 22))], "comparison_id bigint, base_fact_key string, knowledge_date date")
    assert sorted(tuple(r) for r in asof.fact_versions_as_known(events, versions).collect()) == [(1, 1), (2, 2)]


def test_as_of_never_sees_later_knowledge_and_survives_dirt(spark):
    versions = spark.createDataFrame([("k", 1, D(2024, 1, 1), D(9999, 12, 31)), ("k", 1, D(2024, 1, 1), D(2024, 2, 1)), ("k", 2, D(2024, 2, 1), D(2024, 2, 1)), ("k", 3, D(2024, 2, 1), D(9999, 12, 31)), (None, 1, D(2024, 1, 1), D(9999, 12, 31)), ("n", 1, None, None)], "fact_key string, version_no bigint, valid_from date, valid_to date")
    events = spark.createDataFrame([(1, "k", D(2024, 1, 31)), (1, "k", D(2024, 1, 31)), (2, "k", D(2024, 2, 1)), (3, "k", D(2023, 12, 31)), (4, "k", None), (5, None, D(2024, 3, 1)), (6, "none", D(2024, 3, 1)), (7, "n", D(2024, 3, 1))], "comparison_id bigint, base_fact_key string, knowledge_date date").withColumn("slice", F.lit(1))
    got = sorted(tuple(r) for r in asof.fact_versions_as_known(events, versions.withColumn("known", F.lit("clash"))).collect())
    assert got == [(1, 1), (2, 3)]
    assert asof.fact_versions_as_known(events.limit(0), versions).count() == 0 and asof.fact_versions_as_known(events, versions.limit(0)).count() == 0


def test_as_of_hot_key_is_sliced(spark):
    versions = spark.createDataFrame([("hot", i, D(2024, 1, i), D(2024, 1, i + 1)) for i in range(1, 28)], "key string, version_no bigint, valid_from date, valid_to date").withColumn("known", F.col("valid_from"))
    events = spark.range(500).select(F.col("id").alias("event_id"), F.lit("hot").alias("key"), F.date_add(F.lit(D(2024, 1, 1)), (F.col("id") % 27).cast("int")).alias("known")).withColumn("valid", F.col("known"))
    got = asof.attributes_as_of(events, versions, hot=40)
    assert got.count() == 500 and got.where("version_no <> event_id % 27 + 1").count() == 0


# --- P5 -------------------------------------------------------------------------------------------------------------

FIELDS = {
    'AAxis="Tier=1 Loans"|BAxis=Tubes, Valves|CAxis=\'M\'|DAxis = N': ["AAxis=Tier=1 Loans", "BAxis=Tubes, Valves", "CAxis=M", "DAxis=N"],
    'AAxis="Plan ""B"" Unit";;BAxis="Grain | Feed"': ['AAxis=Plan "B" Unit', "BAxis=Grain | Feed"],
    '"AAxis=Own / Lease" ; ; BAxis="""Gold"" Card",': ["AAxis=Own / Lease", 'BAxis="Gold" Card'],
    "AAxis=Driver's Choice\nBAxis='Oils\tFats',": ["AAxis=Driver's Choice", "BAxis=Oils\tFats"],
    "AAxis=Parts / Repair/": ["AAxis=Parts / Repair"],
    "; AAxis=Fenmoor, Pellgate / BAxis='Miller's Row';": ["AAxis=Fenmoor, Pellgate", "BAxis=Miller's Row"],
    'AAxis="never closed; BAxis=x': ['AAxis="never closed', "BAxis=x"],
    "": [], " ;|, ": [], "no axis at all": [],
}


def test_split_fields():
    for text, values in FIELDS.items():
        assert segments.split_field(text) == values, text
        assert segments.split_field(text, ("\n", "|")) == values, text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["plain", "double", "single", "whole"]), st.text(alphabet="ab ,;|/'\"=\t", max_size=12)), min_size=1, max_size=6), st.sampled_from([";", " ; ", "|", ", ", "\t", ";;", " / ", ";\n"]))
def test_quoted_values_round_trip(parts, gap):
    out, want = [], []
    for i, (style, raw) in enumerate(parts):
        raw = raw.strip()
        if style == "plain":
            raw = "".join(c for c in raw if c in "ab") or "a"
            out.append(f"X{i}Axis={raw}")
        elif style == "single":
            raw = "".join(c for c in raw if c not in "'").strip() or "a"
            out.append(f"X{i}Axis='{raw}'")
        else:
            raw = raw or "a"
            q = raw.replace('"', '""')
            if q.startswith('""') or q.endswith('""') or style == "whole" and raw[0] in "\"'":
                q = raw = "b"
            out.append(f'X{i}Axis="{q}"' if style == "double" else f'"X{i}Axis={q}"')
        want.append(f"X{i}Axis={raw}")
    if any("'" in w or '"' in w for w in want):  # apostrophes before delimiters are ambiguous by nature
        return
    assert segments.split_field(gap.join(out)) == want


def test_packed_segments(spark):
    v = spark.createDataFrame([("k1", 1, "AAxis=a;BAxis=b"), ("k1", 1, "AAxis=a;BAxis=b"), ("k2", None, "AAxis=Own / Lease|BAxis='c'"), ("k3", 2, None), ("k4", 2, ""), (None, 1, "AAxis=a")], "fact_key string, cik int, segments string").withColumn("text", F.lit("clash")).withColumn("source", F.lit(1))
    got = sorted(tuple(r) for r in segments.packed_segments(v).collect())
    assert got == [("k1", 1, "AAxis=a", 2), ("k1", 2, "BAxis=b", 2), ("k2", 1, "AAxis=Own / Lease", 2), ("k2", 2, "BAxis=c", 2)]
    assert segments.packed_segments(v.limit(0)).count() == 0
    best = segments.delimiter_scores(v.select(F.col("cik").cast("string").alias("source"), F.col("segments").alias("text"))).where("source = '1'").orderBy(F.desc("score")).first()
    assert best.delimiter == ";"


def test_inferred_delimiters_decide(spark, monkeypatch):
    """Without acceptance nothing is split; a sign that is a delimiter nowhere divides nothing, even before an equals sign."""
    assert segments.is_delimiter(3, 10) and not segments.is_delimiter(0, 5) and not segments.is_delimiter(1, 400)
    rows = [(f"a{i}", "s1", f"AAxis=m{i};BAxis=n{i}") for i in range(40)] + [(f"b{i}", "s2", f"AAxis=Own / Lease {i}|BAxis=n") for i in range(400)] + [("odd", "s2", "AAxis=rate/x=3|BAxis=n"), ("rare", "s1", "AAxis=m|BAxis=n")]
    fields = spark.createDataFrame(rows, "id string, source string, text string")
    own, common = segments.source_delimiters(segments.delimiter_scores(fields))
    assert {tuple(r) for r in own.collect()} == {("s1", ";|"), ("s2", "|")} and sorted(common) == [";", "|"]
    got = {r.id: r.n_values for r in segments.split_packed(fields).collect()}
    assert got["odd"] == 2 and got["rare"] == 2 and set(got.values()) == {2}
    assert ("odd", 1, "AAxis=rate/x=3") in {(r.id, r.pos, r.value) for r in segments.split_packed(fields).collect()}
    monkeypatch.setattr(segments, "ACCEPT", 1e9)
    assert {r.n_values for r in segments.split_packed(fields).collect()} == {1}


def test_long_field_of_open_quotes_is_quick():
    assert len(segments.split_field("".join(f"X{i}Axis=\"a; " for i in range(3000)))) == 3000


# --- P1 -------------------------------------------------------------------------------------------------------------


def test_expression_and_row_checks(spark):
    good = [(i, f"{2019 + i % 6}q{1 + i % 4}", 60.0 + i % 40) for i in range(60)]
    bad = [(100, "2019q5", 105.0), (101, "2019q1\n", float("nan")), (102, "２019q1", 0.9), (103, None, None), (104, "", 50.0), (105, "2020Q1", 100.0), (None, "x", 1.0)]
    df = spark.createDataFrame(good + bad, "build_id bigint, quarter string, pct double")
    e = profile.leading_expression(df, "quarter")  # without the rule
    assert "q" in e and df.where(F.col("quarter").rlike(e)).count() == 60
    got = {tuple(r) for r in profile.row_checks(df, "t", "quarter", "build_id", rule=profile.QUARTER_RULE).select("load_key", "check_name").collect()}
    assert got == {("100", "pattern"), ("101", "pattern"), ("102", "pattern"), ("103", "null"), ("104", "pattern"), ("105", "pattern")}
    got = {tuple(r) for r in profile.row_checks(df, "t", "pct", "build_id", low=50, high=100).select("load_key", "check_name").collect()}
    assert got == {("100", "range"), ("101", "range"), ("102", "range"), ("103", "null")}
    assert profile.row_checks(df.limit(0), "t", "quarter", "build_id", rule=profile.QUARTER_RULE).count() == 0


def test_profile(spark):
    df = spark.createDataFrame([("ab12", 1.5, None), ("cd34", -2.0, None), ("cd34", None, None), ("??", float("nan"), None)], "s string, x double, n int")
    p = {r.column_name: r for r in profile.profile_columns(df, "t").collect()}
    assert (p["s"].n_rows, p["s"].n_distinct, p["s"].n_null) == (4, 3, 0) and (p["x"].n_null, p["x"].n_negative) == (1, 1)
    assert p["n"].n_distinct == 0 and p["n"].null_rate == 1 and p["n"].expression == ".*"
    assert [r.n_rows for r in profile.profile_columns(df.limit(0), "t").collect()] == [0, 0, 0]
    many = spark.range(500).select(F.format_string("%c%c-%04d", (F.lit(97) + F.col("id") % 26).cast("int"), (F.lit(98) + F.col("id") % 20).cast("int"), "id").alias("code")).union(spark.sql("select '#!'"))
    r = profile.profile_columns(many, "t").first()
    assert r.expression == r"(?:[a-z]{2}\-[0-9]{4})" and r.n_nonconforming == 1


def test_leading_expression_decides_what_is_checked(spark, monkeypatch):
    """Dirt of many kinds, more distinct values than the clean ones have; an expression that takes all in finds nothing."""
    good = [f"{y}q{q}" for y in range(2019, 2025) for q in (1, 2, 3, 4) for _ in range(40)]
    dirt = [f"{y}{x}" for y in range(2019, 2025) for x in ("q5", "q0", "Q1", "-q2", " q3", "q4 ", "r1")] + [f"FY{y}" for y in range(2019, 2025)] * 2 + ["21q3", "02020q1", "n/a", "n/a", "q1 2020", "", "2019q12"]
    df = spark.createDataFrame(list(enumerate(good + dirt)), "build_id int, quarter string")
    e = profile.leading_expression(df, "quarter")
    assert e == r"(?s)^(?:[0-9]{4}q[1-4])\z"
    assert profile.row_checks(df, "t", "quarter", "build_id", rule=profile.QUARTER_RULE).count() == len(dirt)
    monkeypatch.setattr(profile, "leading_expression", lambda df, c: "(?s)^.*\\z")
    assert profile.row_checks(df, "t", "quarter", "build_id", rule=profile.QUARTER_RULE).count() == 0


def test_fields_and_nonconforming_values(spark):
    """A key of fields gets the expressions of its fields; values that don't conform are listed."""
    rng = random.Random(2)
    names = ["".join(rng.choice(["Ab", "c9", "D", "ee-", "F_", "g+7"]) for _ in range(rng.randint(2, 5))) for _ in range(40)]
    rows = [(f"{1000 + i % 37}|{rng.choice(names)}|{'' if i % 5 else rng.choice(names) + '=' + 'yz'[i % 2] * (1 + i % 7)}|{i % 4}",) for i in range(5000)]
    df = spark.createDataFrame(rows + [("1001|Ab||7",), ("1001-Ab",), ("1001|{?}||1",)], "key string")
    p = profile.profile_columns(df, "t").first()
    fits = f"(?s)^(?:{p.expression})\\z"
    odd = {r.value: r.n_rows for r in profile.nonconforming_values(df, "t").collect()}
    assert odd == {"1001|Ab||7": 1, "1001-Ab": 1, "1001|{?}||1": 1} and p.n_nonconforming == 3
    assert df.where(~F.col("key").rlike(fits)).count() == 3 and p.expression.startswith(r"(?:(?:[0-9]{4}))\|")
    import hashlib

    hexes = spark.createDataFrame([(hashlib.sha256(str(i).encode()).hexdigest(),) for i in range(400)] + [("0" * 63,)], "h string")
    h = profile.profile_columns(hexes, "t").first()
    assert (h.expression, h.n_nonconforming) == ("(?:[a-f0-9]{63,64})", 0)
    few = spark.createDataFrame([("FY",)] * 50 + [("Q1",)] * 40 + [(None,)], "fp string")
    assert profile.profile_columns(few, "t").first().n_nonconforming == 0
    counts = {r.column_name: (r.n_rows, r.n_null, r.n_distinct) for r in profile.column_counts(few.withColumn("n_rows", F.lit(1)), "t").collect()}
    assert counts == {"fp": (91, 1, 2), "n_rows": (91, 0, 1)} and profile.column_counts(few.limit(0), "t").first().n_rows == 0


def test_loads_against_plain_python(spark):
    rng = random.Random(1)
    rows = []
    for load in range(6):
        for _ in range(200):
            v = rng.choice([None, 0.0, -5.0, rng.random() * 10 ** rng.randrange(-300, 300), float(rng.randrange(5)), 5e-324])
            rows.append((f"l{load}", v if load != 3 else (None if v is None else -abs(v) * 1000)))
    rows += [("empty", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "load string, value double")
    got = {r.load: r for r in profile.load_profiles(profile.load_values(df, "load", "value")).collect()}
    for load in {r[0] for r in rows} - {None}:
        own = [v for x, v in rows if x == load]
        vals = [v for v in own if v is not None]
        assert (got[load].n_rows, got[load].n_null, got[load].n_distinct, got[load].n_negative) == (len(own), len(own) - len(vals), len(set(vals)), sum(v < 0 for v in vals))
        nz = [abs(v) for v in vals if v]
        assert got[load].median_abs is None if not nz else np.isclose(got[load].median_abs, np.median(nz), rtol=1e-12)
    follows = spark.createDataFrame([("l3", "l2"), ("l3", "l2"), ("l0", None), ("empty", "l0"), ("l1", "gone")], "load string, previous string")
    flags = {r.load: r for r in profile.compare_loads(profile.load_profiles(profile.load_values(df, "load", "value")), follows).collect()}
    assert set(flags) == {"l3", "empty"} and flags["l3"].is_sign and flags["empty"].is_null_rate and not flags["empty"].is_scale


def test_expression_shift_between_loads(spark):
    rows = [("a", float(i), 1) for i in range(10)] + [("b", float(i), 1) for i in range(5)] + [("b", float(i) * -1, 1) for i in range(1, 6)] + [("c", None, 3)]
    counted = spark.createDataFrame(rows, "load string, value double, n bigint")
    follows = spark.createDataFrame([("b", "a"), ("b", "a"), ("c", "b"), ("a", None)], "load string, previous string")
    got = profile.expression_shift(counted, follows, r"(?:[0-9]\.0)|(?:\-[0-9]\.0)").collect()
    assert [tuple(r) for r in got] == [("b", "a", 0.5)]
    assert profile.expression_shift(counted, follows, ".*").first().expression_shift == 0


def test_every_shape_is_weighed(spark):
    """Thousands of shapes, none of them common: one general expression, and what doesn't fit it is reported."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcABC0123456789xyzXYZ") for _ in range(rng.randint(8, 14)))
    good = sorted({f"{word()}={word()};" for _ in range(600)})
    df = spark.createDataFrame([(x,) for x in good] + [("#!",), ("",)], "s string")
    assert profile.shaped(profile.distinct_values(df, ["s"])).select("collapsed").distinct().count() > 500
    r = profile.profile_columns(df, "t").first()
    assert r.expression != ".*" and r.n_nonconforming == 2 and r.alternatives < 24
    assert df.where(F.col("s").rlike(f"(?s)^(?:{r.expression})\\z")).count() == len(good)
    # forty shapes of fixed lengths, equally common
    many = spark.range(4000).select(F.concat(*(F.when(F.shiftright("id", i).bitwiseAND(F.lit(1)) == 1, F.format_string("%02d", F.col("id") % 97)).otherwise(F.lit("xy")) for i in range(6)), F.lit("-"), F.format_string("%04d", "id")).alias("code"))
    r = profile.profile_columns(many, "t").first()
    assert r.expression != ".*" and r.n_nonconforming == 0 and many.where(F.col("code").rlike(f"^(?:{r.expression})\\z")).count() == 4000


def test_every_column_of_every_load_is_compared(spark):
    rows = [(load, f"note {i % 9}" if load == "a" else None, f"{i:04d}" if load == "a" else "ab" * (1 + i % 3), float(i + 1), 2020 + i % 3) for load in "ab" for i in range(60)]
    facts = spark.createDataFrame(rows, "source_sha256 string, footnote string, tag string, value double, fy int")
    manifest = spark.createDataFrame([("b", "a"), ("b", "a"), ("a", None)], "source_sha256 string, previous_sha256 string")
    got = {r.column_name: r for r in profile.load_report(facts, manifest).collect()}
    assert set(got) == set(facts.columns) and all((r.load, r.previous) == ("b", "a") for r in got.values())
    assert got["footnote"].is_null_rate and (got["footnote"].null_before, got["footnote"].null_now) == (0, 1)
    assert got["tag"].is_distinct and got["tag"].is_shape and got["tag"].expression_shift == 1
    assert not any(got[c][f] for c in ("value", "fy") for f in ("is_null_rate", "is_distinct", "is_shape", "is_scale", "is_sign"))
    assert np.isclose(got["value"].median_now, 30.5) and got["value"].coverage_now == 1 and got["tag"].median_now is None


def test_work_tables_are_removed(spark):
    import os

    df = cut(spark.range(5))
    path = df.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path) and clear_work(spark) >= 1 and not os.path.exists(path)
