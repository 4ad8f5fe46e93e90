"""History of changing attributes as a bitemporal ledger.

Every row of the ledger says: from `recorded_from` until `recorded_to` we believed that `key` had `value` during
[valid_from, valid_to). A row is never overwritten: when a late or corrected statement arrives, the rows whose valid
interval it cuts are closed at that recording time and their successors appended.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from chronofact.operators.runs import starts, whole_keys
from chronofact.session import cut

#: Open end of both times, as days since 1970-01-01 (9999-12-31).
FOREVER = 2932896
LEDGER = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("valid_from", T.DateType()),
        T.StructField("valid_to", T.DateType()),
        T.StructField("recorded_from", T.DateType()),
        T.StructField("recorded_to", T.DateType()),
        T.StructField("version_no", T.LongType()),
    ]
)


#: The filings' acceptance is broadcast to their reports up to so many filings (counted first). Beyond, it is joined by a
#: shuffle, but only with the reports of keys for which the order within a day matters. Either way reports are shuffled once.
FILINGS_BROADCAST = 250_000
#: Keys are counted by this many hash buckets; a bucket is hot from HOT_ROWS rows and HOT_TIMES the mean on.
BUCKETS, HOT_ROWS, HOT_TIMES = 1 << 18, 500_000, 16


def filing_statements(said: DataFrame) -> DataFrame:
    """What each filing says about each key, and during which recording time it says it.

    said: key, filing, valid, value, rec (days) without nulls. A filing speaks from the day its first value was recorded;
    from the day a second, different value of it is recorded it says nothing. Repeated rows collapse in the aggregate;
    at most two rows of a filing enter the window's sort (window group limit). Of several valid days the first counts.
    Columns: key, filing, valid, value, r_from, r_to (days).
    """
    values = said.groupBy("key", "filing", "value").agg(F.min("rec").alias("rec"), F.min("valid").alias("valid"))
    w = Window.partitionBy("key", "filing").orderBy("rec", "value", "valid")
    two = values.withColumn("other", F.row_number().over(w)).where(F.col("other") <= 2)
    return (
        two.groupBy("key", "filing")
        .agg(F.min(F.struct("rec", "value", "valid")).alias("a"), F.max(F.struct("rec", "value", "valid")).alias("b"), F.count(F.lit(1)).alias("n"))
        .select("key", "filing", F.col("a.valid").alias("valid"), F.col("a.value").alias("value"), F.col("a.rec").alias("r_from"), F.when(F.col("n") > 1, F.col("b.rec")).otherwise(F.lit(FOREVER)).alias("r_to"))
        .where("r_from < r_to")
    )


def hot_buckets(keys: DataFrame, least: int = HOT_ROWS, times: int = HOT_TIMES) -> list[int]:
    """Hash buckets of `key` with so many rows that they may hold a hot key: a count by bucket, combined map-side.

    The list has at most BUCKETS / times entries.
    """
    counts = keys.groupBy(F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    mean = F.sum("n").over(Window.partitionBy()) / BUCKETS  # of at most BUCKETS rows
    return [r["b"] for r in counts.withColumn("mean", mean).where((F.col("n") >= least) & (F.col("n") >= times * F.col("mean"))).select("b").collect()]


def day_statements(statements: DataFrame, order: list[Column | str]) -> DataFrame:
    """Of statements on one day, recording interval by recording interval, the last in order: rows bounded by the calendar.

    After this no key has more rows than pairs of recording days per valid day, so the sweep may take a key whole.
    Columns: key, valid, r_from, r_to, rank, value; rank orders statements within the day.
    """
    rank = F.struct(*order)
    return (
        statements.groupBy("key", "valid", "r_from", "r_to")
        .agg(F.max_by("value", rank).alias("value"), F.max(rank).alias("rank"))
        .select("key", F.unix_date("valid").alias("valid"), "r_from", "r_to", "value", "rank")
    )


def bitemporal_ledger(statements: DataFrame, placed: bool = False) -> DataFrame:
    """Ledger of day_statements: one shuffle by key (none if they are placed by key already), then a sweep over each sorted
    partition.

    Keys whose statements were recorded in valid order (nearly all) are done with array operations over whole batches;
    keys with late or withdrawn statements go through the sweep line. version_no numbers the versions believed now
    (recorded_to open) and is null in superseded rows. An empty input gives an empty ledger.
    """
    by_key = statements if placed else statements.repartition("key")
    ordered = by_key.sortWithinPartitions("key", "valid", "rank", "r_from").select("key", "valid", "r_from", "r_to", "value")
    return ordered.mapInArrow(_sweep_batches, LEDGER)


def _sweep_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in whole_keys(batches, ["key"]):
        yield from sweep_table(t).to_batches()


def sweep_table(t: pa.Table) -> pa.Table:
    """Ledger rows of a table with whole keys, sorted by key, valid and rank within the day."""
    new = starts(t, ["key"])
    group = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    end = np.append(first[1:], t.num_rows)
    valid, rf, rt, value = (np.asarray(t.column(c).to_numpy()) for c in ("valid", "r_from", "r_to", "value"))
    valid, rf, rt = valid.astype(np.int64), rf.astype(np.int64), rt.astype(np.int64)
    late = np.zeros(len(first), dtype=bool)
    if len(valid):
        back = np.zeros(len(valid), dtype=bool)
        back[1:] = (~new[1:]) & ((rf[1:] < rf[:-1]) | (valid[1:] == valid[:-1]))
        np.logical_or.at(late, group, back | (rt != FOREVER))
    plain = ~late[group]
    rows = np.flatnonzero(plain)
    # a value equal to the one in force opens no version
    opens = new[rows].copy()
    if len(rows):
        v, g = value[rows], group[rows]
        opens[1:] |= (g[1:] == g[:-1]) & (v[1:] != v[:-1])
    o = rows[opens]
    nxt_same = np.zeros(len(o), dtype=bool)
    nxt_same[:-1] = group[o[1:]] == group[o[:-1]]
    nxt = np.append(o[1:], 0)
    idx = np.arange(len(o))
    no = idx - np.maximum.accumulate(np.where(new[o], idx, 0)) + 1 if len(o) else idx
    vt = np.where(nxt_same, valid[nxt] if len(o) else 0, FOREVER)
    cut_at = np.where(nxt_same, rf[nxt] if len(o) else 0, FOREVER)
    # open row until the successor was recorded, closed row from then on
    was = nxt_same & (cut_at > rf[o])
    parts = [
        (o[was], valid[o][was], np.full(was.sum(), FOREVER), rf[o][was], cut_at[was], np.zeros(was.sum(), dtype=np.int64)),
        (o, valid[o], vt, np.where(nxt_same, np.maximum(cut_at, rf[o]), rf[o]), np.full(len(o), FOREVER), no),
    ]
    for g in np.flatnonzero(late):
        a, b = first[g], end[g]
        swept = sweep_key(valid[a:b], rf[a:b], rt[a:b], value[a:b])
        if swept:
            at, s = np.array([x[0] for x in swept]), np.array([x[1:] for x in swept], dtype=np.int64)
            parts.append((a + at, s[:, 0], s[:, 1], s[:, 2], s[:, 3], s[:, 4]))
    at, vf, vto, rec_f, rec_t, number = (np.concatenate(x) for x in zip(*parts, strict=True))
    day = lambda x: pa.array(x.astype(np.int32), pa.int32()).cast(pa.date32())
    return pa.table(
        {
            "key": t.column("key").take(pa.array(at)).cast(pa.string()),
            "value": pa.array(value[at], pa.float64()),
            "valid_from": day(vf),
            "valid_to": day(vto),
            "recorded_from": day(rec_f),
            "recorded_to": day(rec_t),
            "version_no": pa.array(number, pa.int64(), mask=number == 0),
        }
    )


def sweep_key(valid: np.ndarray, r_from: np.ndarray, r_to: np.ndarray, value: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
    """Sweep line over recording time for one key: (row of the value, valid_from, valid_to, recorded_from, recorded_to, number).

    Rows of one day are in ascending rank. The state is the day list with the statement in force per day; each change
    touches the version before it, its own and the next one only.
    """
    events: dict[int, list[tuple[int, bool]]] = {}
    for i in range(len(valid)):
        events.setdefault(int(r_from[i]), []).append((i, True))
        if r_to[i] != FOREVER:
            events.setdefault(int(r_to[i]), []).append((i, False))
    active: dict[int, list[int]] = {}  # day -> rows that hold now, ascending rank
    days: list[int] = []  # sorted days with a statement
    state: dict[int, int] = {}  # day -> row in force
    belief: dict[int, tuple[int, int, int]] = {}  # opening day -> (row, valid_to, recorded_from)
    openings: list[int] = []
    out: list[tuple[int, int, int, int, int, int]] = []

    def around(day: int) -> set[int]:
        k = bisect.bisect_left(days, day)
        near = set(days[max(0, k - 1) : k + 2])
        j = bisect.bisect_left(openings, day)
        return near | set(openings[max(0, j - 1) : j + 2]) | {day}

    for now in sorted(events):
        touched: set[int] = set()
        for i, come in events[now]:
            d = int(valid[i])
            rows = active.setdefault(d, [])
            (bisect.insort(rows, i) if come else rows.remove(i))
            touched.add(d)
        check: set[int] = set()
        for d in touched:
            check |= around(d)
            rows = active[d]
            if rows:
                if d not in state:
                    bisect.insort(days, d)
                state[d] = rows[-1]
            elif d in state:
                del state[d]
                days.pop(bisect.bisect_left(days, d))
            check |= around(d)
        for d in sorted(check):  # which of these days open a version now
            k = bisect.bisect_left(days, d)
            is_open = d in state and (k == 0 or value[state[days[k - 1]]] != value[state[d]])
            j = bisect.bisect_left(openings, d)
            there = j < len(openings) and openings[j] == d
            if is_open and not there:
                openings.insert(j, d)
            elif there and not is_open:
                openings.pop(j)
        again = set(check)
        for d in check:
            j = bisect.bisect_left(openings, d)
            again |= set(openings[max(0, j - 1) : j + 1])
        for d in again:
            j = bisect.bisect_left(openings, d)
            if j < len(openings) and openings[j] == d:
                row, to = state[d], openings[j + 1] if j + 1 < len(openings) else FOREVER
                old = belief.get(d)
                if old and value[old[0]] == value[row] and old[1] == to:
                    continue
                if old and old[2] < now:
                    out.append((old[0], d, old[1], old[2], now, 0))
                belief[d] = (row, to, now)
            elif d in belief:
                old = belief.pop(d)
                if old[2] < now:
                    out.append((old[0], d, old[1], old[2], now, 0))
    for no, d in enumerate(openings, 1):
        row, to, rec = belief[d]
        out.append((row, d, to, rec, FOREVER, no))
    return out


def mark_shared_days(rows: DataFrame, key: str, day: str, one: str) -> DataFrame:
    """rows with `__shared`: whether the row's key has a day on which several of `one` speak. Windows over the key only."""
    along = Window.partitionBy(key).orderBy(F.col(day).asc_nulls_last(), one)
    again = F.lag(day).over(along).eqNullSafe(F.col(day)) & ~F.lag(one).over(along).eqNullSafe(F.col(one))
    # the first row of a key has none before it
    again = again & (F.row_number().over(along) > 1)
    return rows.withColumn("__again", again).withColumn("__shared", F.max("__again").over(Window.partitionBy(key))).drop("__again")


def fact_ledger(facts: DataFrame, submissions: DataFrame, hot_rows: int = HOT_ROWS, filings_broadcast: int | None = None) -> DataFrame:
    """Ledger of the reported facts: valid time is the filing date, recorded time the day the load arrived.

    Null values and reports without key, filing, date or loading time say nothing. Within a day the filing accepted last
    speaks (nulls last of all, then the larger adsh).

    Keys of ordinary buckets are shuffled once, by key, and all steps follow in place. When a filing was accepted is
    broadcast up to filings_broadcast (FILINGS_BROADCAST) filings, a counted size; beyond, only the statements of keys for which
    several filings speak on one day are joined with the submissions (both branches share the shuffle by key). Keys of hot
    buckets are first combined by filing and by day, each with its own shuffle, so that a key with a third of all rows
    arrives at the sweep with no more rows than the calendar allows.
    """
    rows = (
        facts.select(F.col("fact_key").alias("key"), F.col("adsh").alias("filing"), F.col("knowledge_date").alias("valid"), (F.col("value") + F.lit(0.0)).alias("value"), F.unix_date(F.to_date("loaded_at")).alias("rec"))
        .where(" and ".join(f"{c} is not null" for c in ("key", "filing", "valid", "value", "rec")))
    )
    accepted = submissions.where(F.col("adsh").isNotNull()).groupBy(F.col("adsh").alias("filing")).agg(F.max("accepted").alias("accepted"))
    order = [F.col("accepted").isNull(), "accepted", "filing"]
    hot = hot_buckets(rows.select("key"), hot_rows)
    bucket = F.pmod(F.xxhash64("key"), F.lit(BUCKETS))
    said = filing_statements((rows.where(~bucket.isin(hot)) if hot else rows).repartition("key"))
    small = accepted.count() <= (FILINGS_BROADCAST if filings_broadcast is None else filings_broadcast)
    if small:
        out = bitemporal_ledger(day_statements(said.join(F.broadcast(accepted), "filing", "left"), order), placed=True)
    else:
        said = mark_shared_days(said, "key", "valid", "filing")
        alone = said.where(~F.col("__shared")).select("key", F.unix_date("valid").alias("valid"), "r_from", "r_to", "value", F.lit(0).alias("rank"))
        shared = said.where("__shared").drop("__shared").join(accepted, "filing", "left").repartition("key")
        out = bitemporal_ledger(alone, placed=True).unionByName(bitemporal_ledger(day_statements(shared, order), placed=True))
    if hot:
        large = filing_statements(rows.where(bucket.isin(hot))).join(F.broadcast(accepted) if small else accepted, "filing", "left")
        out = out.unionByName(bitemporal_ledger(day_statements(large, order)))
    return out.withColumnRenamed("key", "fact_key")


def extend_ledger(ledger: DataFrame, before: DataFrame, new: DataFrame, submissions: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The ledger after a load: that of all reports, at the cost of the keys the load speaks of.

    ledger: of `before`, the reports so far; new: the load's reports (facts). Rows of other keys stay as they are; of keys
    in the load the reports so far are read again, so that late, repeated and contradicting statements close the rows they
    cut. The keys are written once; Spark broadcasts them where they are few. When a filing was accepted is taken from
    submissions: if that changed for filings known before, their reports have to be in `new` again (repeated rows count
    once). A load without keys changes nothing.
    """
    touched = cut(new.where("fact_key is not null").select("fact_key").distinct(), "touched")
    again = before.join(touched, "fact_key", "left_semi").select(*before.columns).unionByName(new.select(*before.columns))
    return ledger.join(touched, "fact_key", "left_anti").select(*ledger.columns).unionByName(fact_ledger(again, submissions, hot_rows).select(*ledger.columns))
