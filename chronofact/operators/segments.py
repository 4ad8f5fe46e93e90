"""P5: several values packed in one field, split with their place kept.

The delimiters of each source are inferred. Every candidate is scored on piece-count consistency (how near the number of
pieces with an axis comes to the number of axes) and on the regularity of the pieces' type (how many of them look like
axis=member): a source accepts a candidate if its pieces are of that type far more often than by chance. A field is split
at its source's delimiters. A piece that still holds a further axis behind a candidate is irregular, and is split at the
delimiters that all sources together accept. A candidate nobody accepts divides nothing. Quoted text is never divided.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofact.session import cut

#: Candidate delimiters, in the order in which equal scores are tried.
CANDIDATES = (";", "|", ",", "/", "\t", "\n")
_ANY = "".join(re.escape(c) for c in CANDIDATES)
#: Share of pieces that look like axis=member by chance, and from which log-likelihood ratio against it a candidate is accepted.
CHANCE, ACCEPT = 0.01, 4.0
#: What an empty piece consists of.
_EMPTY = " \t\n\r\v\f" + "".join(CANDIDATES)
_HEAD = re.compile(r"\s*[\"']?\s*[A-Za-z][\w.:\-]*\s*=")
_AXIS = re.compile(r"\s*([A-Za-z][\w.:\-]*)\s*=\s*")
_CLOSE_AFTER = rf"(?=\s*(?:[{_ANY}]|$))"
#: Where quoted text can begin: at the start of a piece or after the = sign. It ends at a quote before a delimiter or the end.
_QUOTED = {q: re.compile(rf"{q}(?:[^{q}]|{q}{q}|{q}(?!\s*(?:[{_ANY}]|$)))*+{q}{_CLOSE_AFTER}", re.S) for q in "\"'"}
_OPENING = re.compile(rf"(?:^|[=;|,/\t\n])\s*([\"'])", re.S)


def quoted_spans(text: str) -> list[tuple[int, int]]:
    """Spans of quoted text, quotes included."""
    spans, at, unclosed = [], 0, ""
    while m := _OPENING.search(text, at):
        q = m[1] not in unclosed and _QUOTED[m[1]].match(text, m.start(1))
        if not q or q.end() - q.start() < 2:
            unclosed += m[1] * (not q)  # no end after here: later ones have none either
            at = m.start(1) + 1
            continue
        spans.append(q.span())
        at = q.end()
    return spans


def _masked(text: str) -> str:
    """The text with quoted text blanked out by letters, as long as before; a quoted pair keeps its head visible."""
    out, last = [], 0
    for a, b in quoted_spans(text):
        inner = text[a:b]
        m = _AXIS.match(inner, 1)
        keep = m.end() - 0 if m else 1
        shown = inner[:keep] if m else inner[0]
        out += [text[last:a], shown, "x" * (b - a - len(shown))]
        last = b
    return "".join([*out, text[last:]])


def _cut(masked: str, delimiter: str) -> list[tuple[int, int]]:
    """Spans between the delimiter's places (outside quotes, as masked)."""
    spans, last = [], 0
    for m in re.finditer(re.escape(delimiter), masked):
        spans.append((last, m.start()))
        last = m.end()
    return [*spans, (last, len(masked))]


def score_field(text: str) -> dict[str, tuple[float, int, int]]:
    """Of each candidate that divides this field outside quotes: (count consistency, pieces after the first that look like
    axis=member, other pieces after the first). Empty pieces don't count."""
    masked = _masked(text)
    axes = len(re.findall(r"(?:^|[\s\"';|,/])[A-Za-z][\w.:\-]*\s*=", masked))
    scores = {}
    for c in CANDIDATES:
        if c in masked:
            pieces = [masked[a:b] for a, b in _cut(masked, c) if masked[a:b].strip(_EMPTY)]
            if len(pieces) > 1:
                typed = [bool(_HEAD.match(p)) for p in pieces]
                scores[c] = (min(sum(typed), axes) / max(sum(typed), axes, 1), sum(typed[1:]), len(pieces) - 1 - sum(typed[1:]))
    return scores


def is_delimiter(typed: float, loose: float) -> bool:
    """Whether pieces behind a candidate are axis=member far more often than by chance."""
    if not typed:
        return False
    r = typed / (typed + loose)
    return r > CHANCE and typed * math.log(r / CHANCE) + (loose * math.log((1 - r) / (1 - CHANCE)) if loose else 0.0) > ACCEPT


def _divide(masked: str, pieces: list[tuple[int, int]], delimiters: tuple[str, ...]) -> list[tuple[int, int]]:
    """Pieces cut at the delimiters that an axis follows; text behind others belongs to the value before."""
    if not delimiters:
        return pieces
    gaps = re.compile("|".join(map(re.escape, delimiters)))
    out = []
    for a, b in pieces:
        begin = a
        for m in gaps.finditer(masked, a, b):
            if _HEAD.match(masked, m.end(), b):
                out.append((begin, m.start()))
                begin = m.end()
        out.append((begin, b))
    return out


def split_field(text: str, own: str | tuple[str, ...] = (), common: str | tuple[str, ...] = CANDIDATES) -> list[str]:
    """Values of one field in order: axis=member, unquoted, trimmed.

    own: delimiters of the field's source; common: those of all sources, for pieces that own leaves irregular. Text before
    the first axis has no value to belong to and is dropped.
    """
    masked = _masked(text)
    pieces = _divide(masked, [(0, len(text))], tuple(own))
    pieces = _divide(masked, pieces, tuple(c for c in common if c not in own))
    values: list[tuple[int, int]] = []
    for a, b in pieces:
        if not masked[a:b].strip(_EMPTY):
            continue
        if _HEAD.match(masked, a, b):
            values.append((a, b))
        elif values:  # no axis: belongs to the value before, unchanged
            values[-1] = (values[-1][0], b)
    return [_value(text[a:b]) for a, b in values]


def _unquote(s: str) -> str:
    if len(s) >= 2 and s[0] in "\"'" and (m := _QUOTED[s[0]].match(s)) and m.end() == len(s):
        return s[1:-1].replace(s[0] * 2, s[0]).strip()
    return s


def _value(piece: str) -> str:
    piece = piece.strip()
    spans = quoted_spans(piece)
    end = spans[-1][1] if spans else 0
    piece = piece[:end] + piece[end:].rstrip(_EMPTY)  # delimiters at the end, unless quoted
    whole = _unquote(piece)
    m = _AXIS.match(whole)
    return f"{m[1]}={_unquote(whole[m.end() :].strip())}" if m else whole


def _score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[tuple[object, str], list[float]] = {}
    for b in batches:
        for source, text, n in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
            for c, scores in score_field(text).items():
                t = total.setdefault((source, c), [0.0, 0.0, 0.0, 0.0])
                for i, x in enumerate((1, *scores)):
                    t[i] += n * x
    if total:
        keys = list(total)
        yield pa.record_batch({"source": pa.array([k[0] for k in keys], pa.string()), "delimiter": pa.array([k[1] for k in keys])} | {name: pa.array([total[k][i] for k in keys], pa.float64()) for i, name in enumerate(_SCORES.names[2:])})


_SCORES = T.StructType([T.StructField("source", T.StringType()), T.StructField("delimiter", T.StringType()), *(T.StructField(c, T.DoubleType()) for c in ("fields", "consistency", "typed", "loose"))])


def delimiter_scores(fields: DataFrame) -> DataFrame:
    """Per source and candidate: fields it divides, mean consistency, regularity (share of the pieces after the first that
    look like axis=member), score (both times support), typed and loose pieces.

    fields: source (string), text. Each partition adds up its own fields before the shuffle, so a hot source is no burden.
    """
    distinct = fields.where("text is not null").groupBy("source", "text").agg(F.count(F.lit(1)).alias("n"))
    return (
        distinct.mapInArrow(_score_batches, _SCORES)
        .groupBy("source", "delimiter")
        .agg(*(F.sum(c).alias(c) for c in _SCORES.names[2:]))
        .select("source", "delimiter", F.col("fields").cast("bigint").alias("fields"), F.round(F.col("consistency") / F.col("fields"), 6).alias("consistency"), F.round(F.col("typed") / (F.col("typed") + F.col("loose")), 6).alias("regularity"), "typed", "loose")
        .withColumn("score", F.round(F.col("consistency") * F.col("regularity") * F.log1p("fields"), 6))
    )


def _accepted() -> Column:
    """is_delimiter as an expression."""
    t, l = F.col("typed"), F.col("loose")
    r = t / (t + l)
    return F.when((t > 0) & (r > CHANCE), t * F.log(r / CHANCE) + F.when(l > 0, l * F.log((1 - r) / (1 - CHANCE))).otherwise(0.0) > ACCEPT).otherwise(False)


def source_delimiters(scores: DataFrame) -> tuple[DataFrame, str]:
    """(source and its accepted delimiters, the best first; delimiters that all sources together accept)."""
    best = F.reverse(F.array_sort(F.collect_list(F.struct("score", "delimiter"))))
    own = scores.where(_accepted()).groupBy("source").agg(F.array_join(F.transform(best, lambda x: x["delimiter"]), "").alias("delimiters"))
    # a row a candidate
    common = scores.groupBy("delimiter").agg(F.sum("typed").alias("typed"), F.sum("loose").alias("loose"), F.sum("score").alias("score")).where(_accepted()).orderBy(F.desc("score"), "delimiter").collect()
    return own, "".join(r["delimiter"] for r in common)


def _split_batches(common: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, str], list[str]] = {}
        for b in batches:
            names = b.schema.names
            ids, texts, owns = (b.column(names.index(c)).to_pylist() for c in ("id", "text", "delimiters"))
            out_id, out_pos, out_value, out_n = [], [], [], []
            for i, text, own in zip(ids, texts, owns, strict=True):
                key = (text, own or "")
                values = known.get(key)
                if values is None:
                    if len(known) > 200_000:
                        known.clear()
                    values = known[key] = split_field(text, own or "", common)
                n = len(values)
                out_id += [i] * n
                out_pos += range(1, n + 1)
                out_value += values
                out_n += [n] * n
            yield pa.record_batch({"id": pa.array(out_id, pa.string()), "pos": pa.array(out_pos, pa.int32()), "value": pa.array(out_value, pa.string()), "n_values": pa.array(out_n, pa.int32())})

    return run


_PARTS = T.StructType([T.StructField("id", T.StringType()), T.StructField("pos", T.IntegerType()), T.StructField("value", T.StringType()), T.StructField("n_values", T.IntegerType())])


def split_packed(fields: DataFrame, sources_broadcast: int = 100_000) -> DataFrame:
    """One row per value: id, pos (from 1), value, n_values.

    fields: id (string), source (string, may be null), text. Null and empty texts have no values. Rows are taken as they
    come: remove repeated ids before. The delimiters per source are broadcast while there are no more than sources_broadcast
    sources (a counted size), joined by shuffle beyond.
    """
    own, common = source_delimiters(cut(delimiter_scores(fields), "delimiters"))  # a row a source and candidate
    small = own.count() <= sources_broadcast
    right = own.withColumnRenamed("source", "s")
    joined = fields.where("text is not null").join(F.broadcast(right) if small else right, F.col("source").eqNullSafe(F.col("s")), "left")
    return joined.select("id", "text", "delimiters").mapInArrow(_split_batches(common), _PARTS)


def packed_segments(fact_versions: DataFrame) -> DataFrame:
    """Every value of each fact_key's segments (fact_key, pos, axis_member, n_values); sources are the filers."""
    fields = fact_versions.where("segments is not null and fact_key is not null").groupBy("fact_key").agg(F.first("segments").alias("text"), F.first("cik").cast("string").alias("source")).select(F.col("fact_key").alias("id"), "source", "text")
    return split_packed(fields).select(F.col("id").alias("fact_key"), "pos", F.col("value").alias("axis_member"), "n_values")
