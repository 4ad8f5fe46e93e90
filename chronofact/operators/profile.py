"""Column-level quality profile, with column expressions induced by minimum description length (MDL).

Every distinct value of a column is reduced on the JVM to its shape (runs of digits, lower, upper, other letters, and
literal signs), and the shapes are counted; the values themselves never leave their partition. Shapes are the leaves of
a tree of ever more general ones: words in camel case repeat, letters and digits join, groups repeat, signs become a
class, at last one class for the column. The expression of a column is the cut through the tree with the shortest
description: bits of the alternatives, plus bits of the distinct values under them, plus bits of the values under none,
spelled out in every row that has them. Every shape is weighed. A column whose values are fields between a sign is also
described field by field, and that is its expression where it is the shorter description. Runs become literals, classes,
fixed or ranged repeats; a sign or a length that few rows have at its place is left out where that shortens the whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chronofact.session import cut

#: Run classes of a shape: name, sign in the shape, expression, bits a character.
CLASSES = (("digit", "9", r"[0-9]", math.log2(10)), ("lower", "a", r"[a-z]", math.log2(26)), ("upper", "A", r"[A-Z]", math.log2(26)), ("letter", "ä", r"[^\x00-\x7f]", math.log2(2000)))
CLASS_OF = {c[1]: c[2] for c in CLASSES}
ANY_BITS = math.log2(96)
#: What an alternative costs besides its runs: its ends and its place among the others.
ALTERNATIVE_BITS = 12.0
#: The textual forms of types that have but one.
FORMS = {"date": r"[0-9]{4}-[0-9]{2}-[0-9]{2}", "boolean": "true|false"} | dict.fromkeys(("timestamp", "timestamp_ntz"), r"[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]{1,6})?")
#: Loads are broadcast to their rows up to this many (counted first), joined by shuffle beyond.
LOADS_BROADCAST = 200_000
#: Levels of the tree of shapes, from the shape itself to the one class of all signs of the column.
LEVELS = 7
#: What the class of a run and a sign cost in an alternative. The two ends of a run's lengths cost half log2(distinct values) each.
RUN_BITS, SIGN_BITS = 3.0, 8.0

_ASCII = {"A": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "a": "abcdefghijklmnopqrstuvwxyz", "9": "0123456789"}


def shape(value: Column) -> Column:
    """Shape with one sign per character: 9, a, A, ä or the literal sign."""
    plain = F.when(value.rlike(r"[^\x00-\x7f]"), F.regexp_replace(value, r"[^\x00-\x7f]", "ä")).otherwise(value)
    return F.translate(plain, "".join(_ASCII.values()), "".join(k * len(v) for k, v in _ASCII.items()))


def runs(s: Column) -> Column:
    """Shape with its runs collapsed: 9999q9 -> 9q9 (literal letters have become classes)."""
    return F.regexp_replace(s, r"(9|a|A|ä)\1+", "$1")


def sign_class(signs: list[str]) -> str:
    """Expression of one sign out of some: the sign itself, or a class with neighbours as ranges."""
    codes = sorted(map(ord, signs))
    if len(codes) == 1:
        return re.escape(chr(codes[0]))
    out, at = "", 0
    while at < len(codes):
        end = at
        while end + 1 < len(codes) and codes[end + 1] == codes[end] + 1:
            end += 1
        low, high = (re.escape(chr(codes[i])) for i in (at, end))
        out += low if at == end else low + high if end == at + 1 else f"{low}-{high}"
        at = end + 1
    return f"[{out}]"


def kept_signs(rows: dict[str, int], escape: float) -> list[str]:
    """Signs of a place that its class keeps: of the k commonest, those for which rows * log2(k), plus `escape` bits for
    every row with another sign, is least."""
    order = sorted(rows, key=lambda x: (-rows[x], x))
    total, inside, best, keep = sum(rows.values()), 0, math.inf, len(order)
    for k, sign in enumerate(order, 1):
        inside += rows[sign]
        bits = inside * math.log2(k) + (total - inside) * escape
        if bits < best - 1e-9:
            best, keep = bits, k
    return order[:keep]


def kept_length(rows: dict[int, int], escape: float) -> tuple[int, int]:
    """Range of lengths of a run: the commonest length alone where that, with `escape` bits for every other row, is
    shorter than all rows choosing from the whole range. Ranges keep their tails."""
    low, high, total = min(rows), max(rows), sum(rows.values())
    most = max(rows, key=lambda x: (rows[x], -x))
    if low < high and escape < math.inf and (total - rows[most]) * escape < total * math.log2(high - low + 1):
        return most, most
    return low, high


def _pieces(value: Column) -> Column:
    """The runs of a value."""
    return F.regexp_extract_all(value, F.lit(r"[0-9]++|[a-z]++|[A-Z]++|[^\x00-\x7f]++|[\x00-\x7f]"), 0)


def shaped(distinct_values: DataFrame) -> DataFrame:
    """Values with their shapes, exact (s) and collapsed."""
    return distinct_values.withColumn("s", shape(F.col("value"))).withColumn("collapsed", runs(F.col("s")))


def _keys(k0: Column) -> list[Column]:
    """Keys of a collapsed shape on levels 1 to LEVELS - 1, each a function of the one before. Letters of a shape are
    classes, so that C (words in camel case), w ([a-z0-9]), W ([A-Za-z0-9]) and L, R (ends of a repeated group) are free."""
    k1 = F.regexp_replace(k0, "(?:Aa)+", "C")
    k2 = F.regexp_replace(F.regexp_replace(k1, "[9a]*[AC][9aAC]*", "W"), "[9a]+", "w")
    k3 = F.translate(k2, "w", "W")
    k4 = F.regexp_replace(k3, r"((?:W[^W]+){1,2}?)\1+", "L$1R")
    k5 = F.array_join(F.array_sort(F.array_distinct(F.split(k3, ""))), "")
    return [k1, k2, k3, k4, k5, F.lit("")]


#: Runs and signs of an exact shape on levels 0 to 3; they stand in the order of the key's signs.
_TOKENS = (r"(9+|a+|A+|ä+|[\s\S])", r"((?:A+a+)+|9+|a+|A+|ä+|[\s\S])", r"([9aA]+|ä+|[\s\S])", r"([9aA]+|ä+|[\s\S])")


def _count(key: Column, signs: str) -> Column:
    return F.length(key) - F.length(F.translate(key, signs, ""))


def _own_bits(level: int, key: Column, signs: Column) -> Column:
    """Bits of one alternative for all values of a node, and of these values under it. signs: size of the column's class."""
    n, log = F.col("values"), lambda c: F.log2(c.cast("double"))
    # letters of the column: a to f, or all; none or 26 capitals count alike
    small_signs, all_signs = 10 + F.col("lowers_of"), 10 + F.col("lowers_of") + F.col("uppers_of")
    lengths = lambda chars, runs: F.when((F.col("patterns") > 1) & (runs > 0), runs * log(chars / runs + 1)).otherwise(0.0)
    place = n * log(F.col("distinct") / n)
    run = RUN_BITS + log(F.col("distinct"))
    if level <= 1:
        model = run * _count(key, "9aAäC") + SIGN_BITS * (F.length(key) - _count(key, "9aAäC"))
        data = CLASSES[0][3] * F.col("digits") + log(F.col("lowers_of")) * F.col("lowers") + log(F.col("uppers_of")) * F.col("uppers") + CLASSES[3][3] * F.col("others") + lengths(F.col("alnum") + F.col("others"), F.col("runs")) + (2 * n * _count(key, "C") if level else F.lit(0))
    elif level <= 4:
        model = run * _count(key, "wWä") + SIGN_BITS * (F.length(key) - _count(key, "wWä"))
        small = F.col("small") if level == 2 else F.lit(0)
        data = log(small_signs) * small + log(all_signs) * (F.col("alnum") - small) + CLASSES[3][3] * F.col("others") + lengths(F.col("alnum") + F.col("others"), n * _count(F.col("k3"), "Wä") if level < 4 else F.col("words"))
        data = data + 3 * n * _count(key, "L")
    else:
        size = F.when(F.length(key) > 0, F.length(key) + 61 * _count(key, "W") + 2000 * _count(key, "ä")).otherwise(F.lit(1)) if level == 5 else signs
        model = run + SIGN_BITS * (F.length(key) if level == 5 else F.least(signs, F.lit(96)))
        data = F.col("chars") * log(size) + n * log(F.col("chars") / n + 1)
    return ALTERNATIVE_BITS + model + data + place


def shape_tree(distinct_values: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every exact shape of every column (column_name, s) with its place in the cut of the tree that has the shortest
    description: level and key of its alternative (level null: its values are spelled out), values, rows, h (least hash).
    And per column the bits of that description, its distinct values, and the letters its values are of, 6 or 26
    (column_name, bits, distinct, lowers_of, uppers_of).

    distinct_values: column_name, value (string, not null), n. The best cut below each node is found level by level from
    the leaves: an alternative of its own against the best of its children, at the leaves against spelling out. All is
    hash aggregates over shapes; no shape is left out, however rare.
    """
    v = distinct_values if "collapsed" in distinct_values.columns else shaped(distinct_values)
    ks = [f"k{i}" for i in range(LEVELS)]
    exact = v.groupBy("column_name", "s", F.col("collapsed").alias("k0")).agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("rows"), F.min(F.xxhash64("value")).alias("h"), F.max(F.col("value").rlike("[g-z]")).alias("lower_wide"), F.max(F.col("value").rlike("[G-Z]")).alias("upper_wide"))
    chain = exact
    for i in range(1, LEVELS):  # k5 comes from k3
        chain = chain.withColumn(f"k{i}", _keys(F.col("k0"))[i - 1])
    exact = cut(chain, "exact")
    n, s = F.col("values"), F.col("s")
    sums = {
        "values": n, "rows": F.col("rows"), "row_chars": F.col("rows") * F.length(s), "chars": n * F.length(s), "alnum": n * _count(s, "9aA"), "others": n * _count(s, "ä"),
        "small": n * _count(F.regexp_replace(s, "[9a]*A[9aA]*", ""), "9a"), "digits": n * _count(s, "9"), "lowers": n * _count(s, "a"), "uppers": n * _count(s, "A"),
        "runs": n * _count(F.col("k0"), "9aAä"), "words": n * _count(F.col("k3"), "Wä"),
    }
    node = cut(exact.groupBy("column_name", *ks).agg(*(F.sum(c).alias(k) for k, c in sums.items()), F.count(F.lit(1)).alias("patterns")), "leaves")
    distinct = exact.groupBy("column_name").agg(F.sum("values").alias("distinct"), *(F.when(F.max(f"{x}_wide"), 26).otherwise(6).alias(f"{x}s_of") for x in ("lower", "upper")))
    seen = node.select("column_name", F.explode(F.split("k5", "")).alias("sign")).distinct().groupBy("column_name").agg(F.sum(F.when(F.col("sign") == "W", 62).when(F.col("sign") == "ä", 2000).otherwise(F.length("sign"))).alias("signs"))
    per = F.broadcast(distinct.join(seen, "column_name", "left").withColumn("signs", F.greatest(F.coalesce("signs", F.lit(1)), F.lit(1))))  # a row a column
    placed = node.select("column_name", *ks)
    node = node.withColumn("below", (F.col("row_chars") + F.col("rows")) * ANY_BITS + F.col("rows"))
    for level in range(LEVELS):
        if level:
            node = node.groupBy("column_name", *ks[level:]).agg(*(F.sum(k).alias(k) for k in [*sums, "patterns"]), F.sum("best").alias("below"))
            if level >= 4:
                node = node.withColumn("k3", F.lit(""))
        node = node.drop("distinct", "signs", "lowers_of", "uppers_of").join(per, "column_name")
        node = cut(node.withColumn("own", _own_bits(level, F.col(ks[level]), F.col("signs"))).withColumn("best", F.least("own", "below")), "nodes")
        placed = placed.join(node.select("column_name", ks[level], (F.col("own") < F.col("below")).alias(f"own{level}")), ["column_name", ks[level]])
        if level >= 4:
            node = node.drop("k3")
    level = F.coalesce(*(F.when(F.col(f"own{i}"), F.lit(i)) for i in reversed(range(LEVELS))))
    placed = placed.withColumn("level", level)
    key = F.coalesce(*(F.when(F.col("level") == i, F.col(k)) for i, k in enumerate(ks)))
    placed = placed.select("column_name", "k0", "level", key.alias("key"))
    tree = cut(exact.select("column_name", "s", "k0", "k5", "values", "rows", "h").join(placed, ["column_name", "k0"]), "tree")
    # level 6: a row a column
    return tree, node.select("column_name", F.col("best").alias("bits"), F.col("values").alias("distinct"), "lowers_of", "uppers_of")


def shape_details(distinct_values: DataFrame, chosen: DataFrame) -> DataFrame:
    """Of alternatives that are shapes themselves (level 0): an example's runs, which runs differ from the example (bits),
    rows by sign of runs that mostly have one sign, and rows by length of every run. Runs after the 62nd count as differing.

    All aggregates over values keep numbers only, so they are hash aggregates, combined before the shuffle; only runs of
    one sign are exploded. No more rows than signs and lengths meet in a list.
    """
    v = distinct_values if "collapsed" in distinct_values.columns else shaped(distinct_values)
    key = ["column_name", "collapsed"]
    leaves = chosen.where("level = 0").withColumnRenamed("k0", "collapsed")
    tokens = leaves.select(*key, "rows", F.posexplode(F.regexp_extract_all("s", F.lit(_TOKENS[0]), 1)).alias("at", "run")).where(F.col("run").rlike("^[9aAä]"))
    spread = cut(tokens.groupBy(*key, "at", F.length("run").alias("length")).agg(F.sum("rows").alias("rows")), "lengths")
    usual = spread.groupBy(*key, "at").agg(F.max_by("length", F.struct("rows", -F.col("length"))).alias("usual"))
    single = usual.groupBy(*key).agg(F.sort_array(F.collect_list(F.when(F.col("usual") == 1, F.col("at")))).alias("single"))
    lengths = spread.groupBy(*key).agg(F.collect_list(F.struct("at", "length", "rows")).alias("lengths"))
    top = leaves.groupBy(*key).agg(F.min("h").alias("h"))
    hashed = v.select(*key, "value", F.xxhash64("value").alias("h"))
    example = hashed.join(top, [*key, "h"]).groupBy(*key).agg(_pieces(F.min("value")).alias("example"))
    known = cut(example.join(single, key, "left").withColumn("single", F.coalesce("single", F.array().cast("array<int>"))), "alternatives")
    held = v.join(known, key).withColumn("p", _pieces(F.col("value")))
    bit = F.transform("p", lambda x, i: F.when((i < 62) & (x != F.get("example", i)), F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint")))
    held = held.select(*key, "n", F.aggregate(bit, F.lit(0).cast("bigint"), lambda a, x: a.bitwiseOR(x)).alias("bits"), F.transform(F.filter("single", lambda i: F.length(F.get("p", i)) == 1), lambda i: F.struct(i.alias("at"), F.ascii(F.get("p", i)).alias("sign"))).alias("signs"))
    one = held.select(*key, "n", "bits", F.explode_outer("signs").alias("x")).groupBy(*key, "x.at", "x.sign").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("rows"))
    seen = one.groupBy(*key).agg(F.bit_or("bits").alias("bits"), F.collect_list(F.struct("at", "sign", "rows")).alias("signs"))
    return known.join(seen, key).join(lengths, key, "left").select("column_name", F.col("collapsed").alias("key"), "example", "bits", "signs", "lengths")


def _shape_expression(key: str, details, escape: float, number: bool = False, classes: dict[str, str] = CLASS_OF) -> tuple[str, bool]:
    """(expression of an alternative that is a shape, whether it leaves out signs or lengths of its own values). Lengths
    of numbers are no format."""
    signs: dict[int, dict[str, int]] = {}
    for x in details["signs"]:
        if x["at"] is not None:
            signs.setdefault(x["at"], {})[chr(x["sign"])] = x["rows"]
    lengths: dict[int, dict[int, int]] = {}
    for x in details["lengths"] or ():
        lengths.setdefault(x["at"], {})[x["length"]] = x["rows"]
    out, narrowed = [], False
    for i, sign in enumerate(key):
        text = details["example"][i]
        if sign not in classes or (i < 62 and not details["bits"] >> i & 1):
            out.append(re.escape(text if sign in classes else sign))
        else:
            low, high = kept_length(lengths[i], math.inf if number else escape)
            narrowed |= (low, high) != (min(lengths[i]), max(lengths[i]))
            if low == high == 1 and i in signs:
                keep = kept_signs(signs[i], escape)
                narrowed |= len(keep) < len(signs[i])
                out.append(sign_class(keep))
            else:
                out.append(classes[sign] + ("" if low == high == 1 else f"{{{low}}}" if low == high else f"{{{low},{high}}}"))
    return "".join(out), narrowed


#: Expression of a sign of a key on levels 1 to 4, without its repeats.
_SIGNS = {c[1]: c[2] for c in CLASSES} | {"C": "(?:[A-Z]+[a-z]+)", "w": "[a-z0-9]", "W": "[A-Za-z0-9]", "L": "(?:", "R": "){2,}"}


def _of_letters(text: str, lowers: int, uppers: int) -> str:
    """Classes of an expression with the letters of the column: a to f where it has no others."""
    text = text if lowers == 26 else text.replace("a-z", "a-f")
    return text if uppers == 26 else text.replace("A-Z", "A-F")


def _general(level: int, key: str, low: list[int], high: list[int], signs: str, shortest: int, longest: int, letters: tuple[int, int] = (26, 26)) -> str:
    """Expression of an alternative on levels 1 to 6 (Java syntax)."""
    of = {k: _of_letters(v, *letters) for k, v in _SIGNS.items()}
    if level >= 5:
        inner = "".join(of[x][1:-1] if x == "W" else f"[{of[x][1:-1]}]" if x == "ä" else re.escape(x) for x in signs)
        return f"[{inner}]{{{shortest},{longest}}}" if inner else ""
    out = []
    for i, x in enumerate(key):
        if x not in of:
            out.append(re.escape(x))
        elif x in "LR":
            out.append(of[x])
        elif x == "C" or level == 4:
            out.append(of[x] + "+")
        else:
            out.append(of[x] + ("" if low[i] == high[i] == 1 else f"{{{low[i]}}}" if low[i] == high[i] else f"{{{low[i]},{high[i]}}}"))
    return "".join(out)


#: A column is described field by field if all but this share of its rows have the sign between the fields.
FIELDS_MISSED = 0.001
#: Sign between a column's name and the number of a field in the names of units (a unit is a column, or one field of it).
_UNIT = "\x1f"


@dataclass
class Induced:
    """Expression of a unit: its alternatives, most rows first, and the rows each stands for."""

    alternatives: list[str]
    rows: list[int]
    #: The sign between the fields, and the fields, if the column is described by them.
    sign: str = ""
    fields: list[Induced] = field(default_factory=list)

    @property
    def expression(self) -> str:
        if self.fields:
            return re.escape(self.sign).join(f"(?:{f.expression})" for f in self.fields)
        return "|".join(f"(?:{a})" for a in self.alternatives) or ".*"

    @property
    def size(self) -> int:
        return sum(f.size for f in self.fields) if self.fields else len(self.alternatives)


def field_signs(values: DataFrame, columns: list[str]) -> dict[str, tuple[str, int]]:
    """Per column the sign that parts its values into fields, and how often all values have it (but FIELDS_MISSED of the
    rows): the sign all have most often. Columns without such a sign are left out. values: column_name, collapsed, n."""
    shapes = values.where(F.col("column_name").isin(columns)).groupBy("column_name", "collapsed").agg(F.sum("n").alias("n"))
    total = shapes.groupBy("column_name").agg(F.sum("n").alias("total"))
    plain = F.regexp_replace("collapsed", r"[9aAä\s]", "")
    each = shapes.withColumn("sign", F.explode(F.array_distinct(F.split(plain, "")))).where("sign <> ''")
    counts = each.groupBy("column_name", "sign", (F.length("collapsed") - F.length(F.replace("collapsed", "sign"))).alias("times")).agg(F.sum("n").alias("n"))
    w = Window.partitionBy("column_name", "sign").orderBy(F.desc("times"))
    # rows that have the sign so often or more often
    least = counts.withColumn("upto", F.sum("n").over(w)).join(total, "column_name").where(F.col("upto") >= (1 - FIELDS_MISSED) * F.col("total")).groupBy("column_name", "sign").agg(F.max("times").alias("times"))
    return {r["column_name"]: (r["sign"], r["times"]) for r in least.groupBy("column_name").agg(F.max_by(F.struct("sign", "times"), F.struct("times", F.col("sign").alias("s"))).alias("x")).select("column_name", "x.*").collect()}


def field_values(values: DataFrame, signs: dict[str, tuple[str, int]]) -> DataFrame:
    """Values of columns with fields, one row a field: the columns of `values` (column_name, value and others), unit, i, field
    (values with too few fields have none)."""
    parts = F.array().cast("array<string>")
    for c, (sign, times) in signs.items():
        whole = F.split("value", "\\Q" + sign + "\\E", times + 1)
        parts = F.when((F.col("column_name") == c) & (F.size(whole) == times + 1), whole).otherwise(parts)
    return values.select("*", F.posexplode(parts).alias("i", "field")).withColumn("unit", F.concat("column_name", F.lit(_UNIT), F.col("i").cast("string")))


class Induction:
    """Expressions of all columns of a frame of distinct values (column_name, value, n), and what they leave out.

    found: Induced by column. members: every exact shape of every unit with its alternative: column_name (of the unit), s,
    rows, alternative (number from 0 in the order of the expression, -1: none). escape: bits that a row with a rare sign or
    length at its place costs; unless given, those of the value spelled out. numbers: columns whose values are numbers.
    The driver gets a row per alternative that pays for itself, and never values or shapes.
    """

    def __init__(self, distinct_values: DataFrame, escape: float | None = None, fields: bool = True, numbers: Iterable[str] = ()):
        self.values = distinct_values if "collapsed" in distinct_values.columns else shaped(distinct_values)
        self.spark = distinct_values.sparkSession
        columns = [r[0] for r in self.values.select("column_name").distinct().collect()]  # a row a column
        self.signs = field_signs(self.values, [c for c in columns if c not in numbers]) if fields else {}
        units = self.values.select("column_name", "value", "n", "s", "collapsed")
        if self.signs:
            parted = field_values(self.values, self.signs).groupBy(F.col("unit").alias("column_name"), F.col("field").alias("value")).agg(F.sum("n").alias("n"))
            units = units.unionByName(cut(shaped(parted), "fields"))
        tree, described = shape_tree(units)
        sizes = tree.where("level is not null").select("column_name", "level", "key").distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("size"))
        told = {r["column_name"]: (r["bits"], r["distinct"], r["size"] or 0, (r["lowers_of"], r["uppers_of"])) for r in described.join(sizes, "column_name", "left").collect()}  # a row a unit
        for c in list(self.signs):
            parts = [told.get(f"{c}{_UNIT}{i}") for i in range(self.signs[c][1] + 1)]
            # the fields' descriptions, and of each value which of the fields' values it has
            if None in parts or sum(p[0] for p in parts) + told[c][1] * sum(math.log2(p[1]) for p in parts) >= told[c][0] or sum(p[2] for p in parts) >= told[c][2] or not all(p[2] for p in parts):
                del self.signs[c]
        used = [c for c in columns if c not in self.signs] + [f"{c}{_UNIT}{i}" for c, (_, n) in self.signs.items() for i in range(n + 1)]
        self.units = units.where(F.col("column_name").isin(used))
        tree = tree.where(F.col("column_name").isin(used))
        chosen = tree.where("level is not null")
        node = ["column_name", "level", "key"]
        t = F.array(F.lit(""))
        for i, pattern in enumerate(_TOKENS):
            if i:
                t = F.when(F.col("level") == i, F.regexp_extract_all("s", F.lit(pattern), 1)).otherwise(t)
        spans = chosen.where("level between 1 and 3").select(*node, F.posexplode(t).alias("at", "run")).groupBy(*node, "at").agg(F.min(F.length("run")).alias("low"), F.max(F.length("run")).alias("high"))
        spans = spans.groupBy(*node).agg(F.array_sort(F.collect_list(F.struct("at", "low", "high"))).alias("spans"))
        ends = chosen.groupBy(*node).agg(F.sum("values").alias("values"), F.sum("rows").alias("rows"), F.min(F.length("s")).alias("shortest"), F.max(F.length("s")).alias("longest"))
        signs = chosen.where("level >= 5").select(*node, F.explode(F.split("k5", "")).alias("sign")).groupBy(*node).agg(F.array_join(F.array_sort(F.collect_set("sign")), "").alias("signs"))
        details = {(r["column_name"], r["key"]): r for r in shape_details(self.units, chosen).collect()}
        found: dict[str, list[tuple]] = {}
        self.narrowed: list[tuple[str, str, str]] = []
        for r in ends.join(spans, node, "left").join(signs, node, "left").collect():
            if r["level"]:
                low, high = [x["low"] for x in r["spans"] or ()], [x["high"] for x in r["spans"] or ()]
                text = _general(r["level"], r["key"], low, high, r["signs"] or "", r["shortest"], r["longest"], told[r["column_name"]][3])
            else:
                price = (r["longest"] + 1) * ANY_BITS if escape is None else escape
                text, narrowed = _shape_expression(r["key"], details[r["column_name"], r["key"]], price, r["column_name"] in numbers, {k: _of_letters(x, *told[r["column_name"]][3]) for k, x in CLASS_OF.items()})
                if narrowed:
                    self.narrowed.append((r["column_name"], r["key"], text))
            found.setdefault(r["column_name"], []).append((-r["rows"], r["level"], r["key"], text))
        units_found, places = {}, []
        for c, rows in found.items():
            rows.sort()
            units_found[c] = Induced([x[3] for x in rows], [-x[0] for x in rows])
            places += [(c, x[1], x[2], i) for i, x in enumerate(rows)]
        self.by_unit = units_found
        self.found = {c: x for c, x in units_found.items() if _UNIT not in c} | {c: Induced([], [], sign, [units_found[f"{c}{_UNIT}{i}"] for i in range(n + 1)]) for c, (sign, n) in self.signs.items()}
        place = self.spark.createDataFrame(places, "column_name string, level int, key string, alternative int")
        named = chosen.join(place, node).select("column_name", "s", "rows", "alternative")
        self.members = cut(named.unionByName(tree.where("level is null").select("column_name", "s", "rows", F.lit(-1).alias("alternative"))), "members")
        self._odd: DataFrame | None = None

    def odd(self) -> DataFrame:
        """The distinct values that don't conform to their column's expression: column_name, value, n (rows).

        Candidates are values of shapes under no alternative, and of alternatives that leave out signs or lengths; the
        expression then decides, so a value that fits another alternative by chance conforms.
        """
        if self._odd is None:
            none = self.members.where("alternative = -1").select("column_name", "s")
            suspects = self.units.join(none, ["column_name", "s"], "left_semi").select("column_name", "value")
            if self.narrowed:
                few = self.spark.createDataFrame([(c, k) for c, k, _ in self.narrowed], "column_name string, collapsed string")
                suspects = suspects.unionByName(self.units.join(few, ["column_name", "collapsed"], "left_semi").select("column_name", "value"))
            fits = F.lit(False)
            for c, x in self.by_unit.items():
                fits = F.when(F.col("column_name") == c, F.col("value").rlike(f"(?s)^(?:{x.expression})\\z")).otherwise(fits)
            # a column without alternatives is `.*`, which all values fit
            bad = cut(suspects.where(F.col("column_name").isin(list(self.by_unit))).where(~fits), "odd")
            whole = self.values.where(~F.col("column_name").isin(list(self.signs))).join(bad, ["column_name", "value"], "left_semi").select("column_name", "value", "n")
            if self.signs:
                own = self.values.where(F.col("column_name").isin(list(self.signs)))
                broken = field_values(own, self.signs).join(bad.select(F.col("column_name").alias("unit"), F.col("value").alias("field")), ["unit", "field"], "left_semi").select("column_name", "value", "n").distinct()
                short = F.lit(False)
                for c, (sign, times) in self.signs.items():
                    short = F.when(F.col("column_name") == c, F.length("value") - F.length(F.replace("value", F.lit(sign))) < times).otherwise(short)
                whole = whole.unionByName(broken).unionByName(own.where(short).select("column_name", "value", "n"))
            self._odd = cut(whole, "nonconforming")
        return self._odd


def as_text(c: str) -> Column:
    return F.col(c).cast("string")


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, value (text, null kept), n: one aggregation per column, each reading its column only."""
    parts = [df.groupBy(F.col(f"`{c}`").alias("v")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(c).alias("column_name"), F.col("v").cast("string").alias("value"), "n") for c in columns]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _is_number(kind: str) -> bool:
    return kind in ("int", "bigint", "double", "float", "smallint", "tinyint") or kind.startswith("decimal")


def plain_columns(df: DataFrame) -> list[str]:
    """Columns whose values aren't nested."""
    return [c for c, k in df.dtypes if not k.startswith(("array", "map", "struct"))]


def _induced(df: DataFrame, columns: list[str]) -> tuple[DataFrame, Induction]:
    """Distinct values of the columns, written once, and the induction over those that aren't of one form by their type."""
    kinds = dict(df.dtypes)
    texts = F.col("column_name").isin([c for c in columns if kinds[c] not in FORMS])
    text = F.when(texts & F.col("value").isNotNull(), F.col("value"))
    values = cut(distinct_values(df, columns).withColumn("s", shape(text)).withColumn("collapsed", runs(F.col("s"))), "profile")
    return values, Induction(values.where(F.col("value").isNotNull() & texts), numbers=[c for c in columns if _is_number(kinds[c])])


def nonconforming_values(df: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    """Every distinct value that doesn't conform to its column's expression: table_name, column_name, value, n_rows."""
    _, induced = _induced(df, columns or plain_columns(df))
    return induced.odd().select(F.lit(table).alias("table_name"), "column_name", "value", F.col("n").alias("n_rows"))


def column_counts(df: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    """Per column its rows, nulls, distinct values (null is none), and least and greatest value as text; one pass over the
    table for counts and ends, and one aggregate over distinct values. An empty table gives zeros."""
    columns = columns or plain_columns(df)
    counted = distinct_values(df, columns).groupBy("column_name").agg(F.sum("n").alias("n_rows"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_null"), F.count("value").alias("n_distinct"))
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return names.join(counted, "column_name", "left").select(F.lit(table).alias("table_name"), "column_name", zero("n_rows"), zero("n_null"), zero("n_distinct"))


def profile_columns(df: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    """One row per column: rows, nulls, null_rate, distinct, least and greatest (in the column's own order, as text), mean,
    negatives, the induced expression, its alternatives, and rows that don't conform to it.

    An empty table gives a row per column with zero counts. NaN counts as a value.
    """
    kinds = dict(df.dtypes)
    columns = columns or plain_columns(df)
    # dates, times and flags have one textual form each, and nothing to induce
    values, induced = _induced(df, columns)
    odd_rows = {r["column_name"]: r["n"] for r in induced.odd().groupBy("column_name").agg(F.sum("n").alias("n")).collect()}  # a row a column
    expressions = {c: (FORMS[kinds[c]], 1) for c in columns if kinds[c] in FORMS} | {c: (x.expression, x.size) for c, x in induced.found.items()}
    numeric = [c for c in columns if _is_number(kinds[c])]
    x = F.when(F.col("column_name").isin(numeric), F.col("value").cast("double"))
    counts = {
        r["column_name"]: r
        for r in values.withColumn("x", x)
        .groupBy("column_name")
        .agg(
            F.sum("n").alias("n_rows"),
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
            F.count("value").alias("n_distinct"),
            (F.sum(F.col("x") * F.col("n")) / F.sum(F.when(F.col("x").isNotNull(), F.col("n")))).alias("mean"),
            F.sum(F.when(F.col("x") < 0, F.col("n")).otherwise(0)).alias("n_negative"),
        )
        .collect()  # a row a column
    }
    ends = df.agg(*(f(f"`{c}`").cast("string").alias(f"{tag}{i}") for i, c in enumerate(columns) for f, tag in ((F.min, "a"), (F.max, "z")))).first()
    rows = []
    for i, c in enumerate(columns):
        r = counts.get(c)
        expression, n = expressions.get(c, (".*", 0))
        total, null = (r["n_rows"], r["n_null"]) if r else (0, 0)
        odd = odd_rows.get(c, 0)
        rows.append((table, c, total, null, round(null / total, 6) if total else None, r["n_distinct"] if r else 0, ends[f"a{i}"], ends[f"z{i}"], r["mean"] if r else None, r["n_negative"] if r else 0, expression, n, odd))
    return df.sparkSession.createDataFrame(
        rows, "table_name string, column_name string, n_rows bigint, n_null bigint, null_rate double, n_distinct bigint, min_value string, max_value string, mean double, n_negative bigint, expression string, alternatives int, n_nonconforming bigint"
    )


# --- loads ---------------------------------------------------------------------------------------------------------


def _select_median(counted: DataFrame, load: str, loads: int) -> DataFrame:
    """Exact median of `a` (> 0) per load from (load, a, n), by radix selection over the bits of the double.

    The bit pattern of a positive double orders like the double, so the middle ranks are found bucket by bucket: 20 bits
    (exponent and first digits), then 22, then 22. Each step shuffles counts of buckets only; no load is ever sorted or
    gathered, however many of all rows it holds. load, median.
    """
    bits = counted.select(load, "n", _double_bits(F.col("a")).alias("bits"))
    total = bits.groupBy(load).agg(F.sum("n").alias("m"))
    small = (lambda d: F.broadcast(d)) if loads <= LOADS_BROADCAST else (lambda d: d)
    # both middle ranks (from 0); equal for an odd count
    want = total.select(load, F.explode(F.array_distinct(F.array(F.floor((F.col("m") - 1) / 2), F.floor(F.col("m") / 2)))).alias("rank"))
    want = want.select(load, "rank", F.col("rank").alias("left"), F.lit(0).cast("bigint").alias("prefix"))
    for shift, above in ((44, 64), (22, 44), (0, 22)):
        want = cut(want, "ranks")
        bucket = bits.select(load, (F.shiftright("bits", above) if above < 64 else F.lit(0).cast("bigint")).alias("prefix"), F.shiftright("bits", shift).alias("bucket"), "n")
        near = bucket.join(small(want.select(load, "prefix").distinct()), [load, "prefix"], "left_semi") if above < 64 else bucket
        counts = near.groupBy(load, "prefix", "bucket").agg(F.sum("n").alias("n"))
        w = Window.partitionBy(load, "prefix").orderBy("bucket")
        upto = counts.withColumn("upto", F.sum("n").over(w))
        want = (
            upto.join(small(want), [load, "prefix"])
            .where((F.col("upto") > F.col("left")) & (F.col("upto") - F.col("n") <= F.col("left")))
            .select(load, "rank", (F.col("left") - F.col("upto") + F.col("n")).alias("left"), F.col("bucket").alias("prefix"))
        )
    return want.groupBy(load).agg(F.avg(_bits_double(F.col("prefix"))).alias("median"))


def _double_bits(c: Column) -> Column:
    """Bits of a positive double as bigint: exponent from the power of two, then 52 bits of the fraction."""
    e = F.greatest(F.floor(F.log2(c)), F.lit(-1022)).cast("bigint")
    e = F.when(c >= F.pow(F.lit(2.0), (e + 1).cast("double")), e + 1).when(c < F.pow(F.lit(2.0), e.cast("double")), e - 1).otherwise(e)
    m = ((c / F.pow(F.lit(2.0), e.cast("double")) - 1) * F.lit(float(1 << 52))).cast("bigint")
    return (e + 1023) * F.lit(1 << 52) + m


def _bits_double(c: Column) -> Column:
    e = F.shiftright(c, 52)
    m = c - e * F.lit(1 << 52)
    return (1 + m.cast("double") / F.lit(float(1 << 52))) * F.pow(F.lit(2.0), (e - 1023).cast("double"))


#: Limits from which two loads count as different: shares of nulls and negatives, ratio of distinct values, factor of medians.
LIMITS = {"null_rate": 0.12, "sign": 0.25, "distinct": 0.2, "scale": 30.0}


def load_values(df: DataFrame, load: str, value: str) -> DataFrame:
    """load, value, n: rows per load and value, counted map-side first and written once; all of a load comes from it."""
    counted = df.where(F.col(load).isNotNull()).groupBy(F.col(load).alias("load"), F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return cut(counted, "loads")


def load_profiles(counted: DataFrame) -> DataFrame:
    """Per load of load_values: n_rows, n_null, n_values, n_distinct, n_negative, median_abs (over non-zero values).

    If counted has a column x, it is the value as a number, null where the value isn't one.
    """
    x = "x" if "x" in counted.columns else "value"
    basic = counted.groupBy("load").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("n_values"),
        F.count("value").alias("n_distinct"),
        F.coalesce(F.sum(F.when(F.col(x) < 0, F.col("n"))), F.lit(0)).alias("n_negative"),
    )
    basic = cut(basic, "loads")
    finite = counted.where(f"{x} is not null and {x} != 0 and not isnan({x}) and abs({x}) < double('Infinity')").select("load", F.abs(x).alias("a"), "n")
    return basic.join(_select_median(finite, "load", basic.count()), "load", "left").select(*basic.columns, F.col("median").alias("median_abs"))


def compare_loads(profiles: DataFrame, follows: DataFrame) -> DataFrame:
    """Each load beside the load it follows (follows: load, previous): the metrics of both, and flags beyond LIMITS.

    Loads without a predecessor, or whose predecessor has no rows, are not compared. Shares of empty loads are null and
    flag nothing.
    """
    def shares(p: DataFrame, tag: str) -> DataFrame:
        return p.select(
            F.col("load").alias("load" if tag == "now" else "previous"),
            (F.col("n_null") / F.col("n_rows")).alias(f"null_{tag}"),
            F.when(F.col("n_values") > 0, F.col("n_negative") / F.col("n_values")).alias(f"negative_{tag}"),
            F.when(F.col("n_values") > 0, F.col("n_distinct") / F.col("n_values")).alias(f"distinct_{tag}"),
            F.col("median_abs").alias(f"median_{tag}"),
        )

    both = follows.where("load is not null and previous is not null").distinct().join(shares(profiles, "now"), "load").join(shares(profiles, "before"), "previous")
    apart = lambda x: F.abs(F.col(f"{x}_now") - F.col(f"{x}_before"))
    factor = F.greatest(F.col("median_now") / F.col("median_before"), F.col("median_before") / F.col("median_now"))
    return both.withColumns(
        {
            "is_null_rate": F.coalesce(apart("null") >= LIMITS["null_rate"], F.lit(False)),
            "is_sign": F.coalesce(apart("negative") >= LIMITS["sign"], F.lit(False)),
            "is_distinct": F.coalesce(apart("distinct") >= LIMITS["distinct"], F.lit(False)),
            "is_scale": F.coalesce(factor >= LIMITS["scale"], F.lit(False)),
        }
    )


def expression_shift(counted: DataFrame, follows: DataFrame, expression: str) -> DataFrame:
    """How much the values' shapes moved between a load and the one before (load, previous, expression_shift): half the sum
    of the differences of the alternatives' shares, 0 for alike and 1 for nothing in common. Values under no alternative
    are a share of their own. Loads without values aren't compared."""
    index = F.lit(-1)
    for i, a in enumerate(reversed(alternatives := expression.removeprefix("(?:").removesuffix(")").split(")|(?:"))):
        index = F.when(F.col("value").cast("string").rlike(f"(?s)^(?:{a})\\z"), len(alternatives) - 1 - i).otherwise(index)
    per = counted.where("value is not null").groupBy("load", index.alias("i")).agg(F.sum("n").alias("n"))
    return alternatives_shift(cut(per, "alternatives"), follows)  # a row a load and alternative


def alternatives_shift(per: DataFrame, follows: DataFrame) -> DataFrame:
    """expression_shift from rows per load and alternative (load, i, n)."""
    total = per.groupBy("load").agg(F.sum("n").alias("total"))
    share = per.join(total, "load").select("load", "i", (F.col("n") / F.col("total")).alias("share"))
    pairs = follows.where("load is not null and previous is not null").distinct().join(total.select("load"), "load", "left_semi").join(total.select(F.col("load").alias("previous")), "previous", "left_semi")
    now = pairs.join(share, "load").select("load", "previous", "i", "share")
    before = pairs.join(share.withColumnRenamed("load", "previous"), "previous").select("load", "previous", "i", (-F.col("share")).alias("share"))
    return now.unionByName(before).groupBy("load", "previous", "i").agg(F.abs(F.sum("share")).alias("d")).groupBy("load", "previous").agg(F.round(F.sum("d") / 2, 6).alias("expression_shift"))


#: Alternatives with fewer rows than this part of the commonest one's are suspect where a rule is declared.
LEADING = 0.1


def leading_expression(df: DataFrame, column: str) -> str:
    """Expression of what a column's values ordinarily look like, induced over all distinct values, whatever they are.

    Only its leading alternatives count, and a rare sign or length costs no more than naming its place and itself, so that
    rare values are left out rather than taken in: they are to be checked, not condemned. A column that has no values, or
    no expression, has no ordinary look: nothing matches.
    """
    values = distinct_values(df.select(F.col(f"`{column}`").cast("string").alias(column)), [column]).where(F.col("value").isNotNull())
    x = Induction(cut(shaped(values), "column"), escape=CLASSES[0][3] + 1.5, fields=False).found.get(column)
    if x is None:
        return "(?!)"
    kept = [a for a, n in zip(x.alternatives, x.rows, strict=True) if n >= LEADING * x.rows[0]]
    return "(?s)^(?:" + "|".join(kept) + ")\\z"


def row_checks(df: DataFrame, table: str, column: str, id_column: str, rule: str | None = None, low: float | None = None, high: float | None = None) -> DataFrame:
    """Rows of a column that break its rule: table_name, column_name, load_key (the row's id), check_name.

    null if the value is null. pattern: rows that don't look like the column's ordinary values (leading_expression) and
    don't follow the rule. range if the number isn't within [low, high] (NaN is not). Rows without an id can't be named.
    """
    v = F.col(f"`{column}`")
    checks = [F.when(v.isNull(), F.lit("null"))]
    if rule:
        text = v.cast("string")
        checks.append(F.when(v.isNotNull() & ~text.rlike(leading_expression(df, column)) & ~text.rlike(rule), F.lit("pattern")))
    if low is not None:
        checks.append(F.when(v.isNotNull() & ~((v >= low) & (v <= high) & ~F.isnan(v.cast("double"))), F.lit("range")))
    return (
        df.where(F.col(id_column).isNotNull())
        .select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), F.col(id_column).cast("string").alias("load_key"), F.explode(F.array_compact(F.array(*checks))).alias("check_name"))
        .distinct()
    )


#: Declared rule of a quarter label; \z since $ would let a line end pass.
QUARTER_RULE = r"^[0-9]{4}q[1-4]\z"


def load_checks(facts: DataFrame, manifest: DataFrame) -> DataFrame:
    """Loads of facts whose values differ from the load they follow, a row a check (columns as row_checks)."""
    follows = manifest.select(F.col("source_sha256").alias("load"), F.col("previous_sha256").alias("previous"))
    compared = compare_loads(load_profiles(load_values(facts, "source_sha256", "value")), follows)
    flags = [F.when(F.col(f"is_{x}"), F.lit(x)) for x in ("null_rate", "scale", "sign", "distinct")]
    return compared.select(F.lit("facts").alias("table_name"), F.lit("value").alias("column_name"), F.col("load").alias("load_key"), F.explode(F.array_compact(F.array(*flags))).alias("check_name")).distinct()


def broken_rules(facts: DataFrame, data_quality: DataFrame, manifest: DataFrame) -> DataFrame:
    """All values and loads that break the rules of the two tables (table_name, column_name, load_key, check_name)."""
    return (
        row_checks(data_quality, "data_quality", "quarter", "build_id", rule=QUARTER_RULE)
        .unionByName(row_checks(data_quality, "data_quality", "pct_filings_with_facts", "build_id", low=50.0, high=100.0))
        .unionByName(load_checks(facts, manifest))
    )


#: From this shift of the shapes' shares on a column's load is marked.
SHAPE_LIMIT = 0.25


def column_loads(df: DataFrame, load: str) -> DataFrame:
    """load (struct of column_name and load), value (text, null kept), x (numbers only), n: one aggregation per column."""
    out = None
    for c, kind in df.dtypes:
        if c == load or kind.startswith(("array", "map", "struct")):
            continue
        v = F.col("v")
        counted = df.where(F.col(load).isNotNull()).groupBy(F.col(load).alias("l"), F.col(f"`{c}`").alias("v")).agg(F.count(F.lit(1)).alias("n"))
        part = counted.select(F.struct(F.lit(c).alias("column_name"), F.col("l").alias("load")).alias("load"), v.cast("string").alias("value"), (v.cast("double") if _is_number(kind) else F.lit(None).cast("double")).alias("x"), "n")
        out = part if out is None else out.unionByName(part)
    return cut(out, "loads")


def load_report(facts: DataFrame, manifest: DataFrame, load: str = "source_sha256") -> DataFrame:
    """Every column of every load beside the load it follows: the metrics of both, the coverage of the column's expression
    (induced over all loads, as p1_profile has it), the shift of its alternatives, and flags. Signs and medians are those
    of numbers; dates, times and flags have one form, which covers all. Of a column described by fields, the shift is that
    of the field that moved most."""
    kinds = dict(facts.dtypes)
    # a number stands for the load in all that is shuffled below; a row a load
    codes = cut(facts.where(F.col(load).isNotNull()).select(F.col(load).alias("__load")).distinct().withColumn("__code", F.row_number().over(Window.orderBy("__load"))), "codes")
    small = codes.count() <= LOADS_BROADCAST
    coded = facts.join(F.broadcast(codes) if small else codes, F.col(load) == F.col("__load")).drop("__load")
    counted = column_loads(coded, "__code")
    name = F.col("load.column_name")
    formed = name.isin([c for c, k in kinds.items() if k in FORMS])
    texts = counted.where(F.col("value").isNotNull() & ~formed)
    values = cut(shaped(texts.groupBy(name.alias("column_name"), "value").agg(F.sum("n").alias("n"))), "profile")
    induced = Induction(values, numbers=[c for c, k in kinds.items() if _is_number(k)])
    parted = list(induced.signs)
    own = texts.select("load", name.alias("column_name"), "value", "n")
    units = own.where(~F.col("column_name").isin(parted)).select("load", "column_name", "value", "n")
    if parted:
        fields = field_values(own.where(F.col("column_name").isin(parted)), induced.signs)
        units = units.unionByName(fields.select("load", F.col("unit").alias("column_name"), F.col("field").alias("value"), "n"))
    shapes = units.groupBy("load", "column_name", shape(F.col("value")).alias("s")).agg(F.sum("n").alias("n"))
    # a column without alternatives is `.*`, which covers all
    i = F.when(F.col("column_name").isin(list(induced.by_unit)), F.coalesce("alternative", F.lit(-1))).otherwise(0)
    fixed = counted.where(F.col("value").isNotNull() & formed).groupBy("load").agg(F.sum("n").alias("n")).select(F.struct(F.col("load.column_name").alias("unit"), F.col("load").alias("load")).alias("load"), F.lit(0).alias("i"), "n")
    per = shapes.join(induced.members.select("column_name", "s", "alternative"), ["column_name", "s"], "left").groupBy(F.struct(F.col("column_name").alias("unit"), "load").alias("load"), i.alias("i")).agg(F.sum("n").alias("n"))
    per = cut(per.unionByName(fixed), "alternatives")  # a row a unit, load and alternative
    covered = F.when(F.col("odd").isNull(), F.col("n")).otherwise(0)
    cover = counted.where(F.col("value").isNotNull()).select("load", name.alias("column_name"), "value", "n").join(induced.odd().select("column_name", "value", F.lit(1).alias("odd")), ["column_name", "value"], "left").groupBy("load").agg((F.sum(covered) / F.sum("n")).alias("coverage"))
    cover = cut(cover, "coverage")
    columns = facts.sparkSession.createDataFrame([(c,) for c, k in kinds.items() if not k.startswith(("array", "map", "struct"))], "column_name string")
    names = [c for c in kinds if c not in induced.signs] + [f"{c}{_UNIT}{k}" for c, (_, n) in induced.signs.items() for k in range(n + 1)]
    all_units = facts.sparkSession.createDataFrame([(u, u.split(_UNIT)[0]) for u in names], "unit string, column_name string")
    known = lambda x: codes.select(F.col("__load").alias(x), F.col("__code").alias(f"{x}_code"))
    # loads without rows aren't compared
    pairs = manifest.select(F.col("source_sha256").alias("l"), F.col("previous_sha256").alias("p")).where("l is not null and p is not null").distinct()
    pairs = cut(pairs.join(known("l"), "l").join(known("p"), "p").select(F.col("l_code").alias("l"), F.col("p_code").alias("p")), "pairs")
    of = lambda x: F.struct("column_name", F.col(x).alias("load"))
    follows = cut(pairs.crossJoin(F.broadcast(columns)).select(of("l").alias("load"), of("p").alias("previous")), "follows")  # a row a column
    of_unit = lambda x: F.struct("unit", of(x).alias("load"))
    unit_follows = cut(pairs.crossJoin(F.broadcast(all_units)).select(of_unit("l").alias("load"), of_unit("p").alias("previous")), "follows")  # a row a unit
    shift = alternatives_shift(per, unit_follows).groupBy(F.col("load.load").alias("load"), F.col("previous.load").alias("previous")).agg(F.max("expression_shift").alias("expression_shift"))
    report = (
        compare_loads(load_profiles(counted), follows)
        .join(cover.withColumnRenamed("coverage", "coverage_now"), "load", "left")
        .join(cover.select(F.col("load").alias("previous"), F.col("coverage").alias("coverage_before")), "previous", "left")
        .join(shift, ["load", "previous"], "left")
        .withColumn("is_shape", F.coalesce(F.col("expression_shift") >= SHAPE_LIMIT, F.lit(False)))
    )
    report = report.withColumn("column_name", name).withColumn("l_code", F.col("load.load")).withColumn("p_code", F.col("previous.load"))
    return report.join(known("l"), "l_code").join(known("p"), "p_code").withColumn("load", F.col("l")).withColumn("previous", F.col("p")).drop("l", "p", "l_code", "p_code")
