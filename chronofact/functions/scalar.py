"""Scalar rules that must agree everywhere: keys, quarters, typed parsing, guarded arithmetic."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Open end of a validity window; always a date (a timestamp of that year doesn't survive conversion to pandas).
OPEN_END = datetime.date(9999, 12, 31)

# Texts that count as null in source files.
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null"]

#: Price of a hosted embedding call, USD per million tokens, and characters per token assumed for it.
HOSTED_USD_PER_MILLION, CHARS_PER_TOKEN = 0.02, 4


def null_tokens(c: Column) -> Column:
    """S3: null for every text that means null."""
    return F.when(~c.isin(NULL_TOKENS), c)


def to_int(c: Column) -> Column:
    """text to number to int, cut toward zero; bad text raises under ANSI."""
    return c.cast("double").cast("int")


def to_day(c: Column) -> Column:
    """yyyymmdd text to date; bad text raises under ANSI."""
    return F.to_date(c, "yyyyMMdd")


def to_moment(c: Column) -> Column:
    """the first 19 characters as a timestamp without zone."""
    return F.to_timestamp_ntz(F.substring(c, 1, 19), F.lit("yyyy-MM-dd HH:mm:ss"))


def flag(c: Column) -> Column:
    """'1' is true, other text false, null null."""
    return c == F.lit("1")


def fact_key(cik: Column, tag: Column, ddate_text: Column, qtrs: Column, uom: Column, coreg: Column, segments: Column) -> Column:
    """Identity of a fact across filings and taxonomy years (F5, F6). Null in a part other than coreg or segments gives
    null, which the contract then rejects."""
    bar = F.lit("|")
    blank = F.lit("")
    return F.concat(cik.cast("string"), bar, tag, bar, ddate_text, bar, qtrs.cast("string"), bar, uom, bar, F.coalesce(coreg, blank), bar, F.coalesce(segments, blank))


def quarter_of(day: Column) -> Column:
    """yyyyqN of a date."""
    return F.concat(F.year(day).cast("string"), F.lit("q"), F.quarter(day).cast("string"))


def quarter_id(day: datetime.date) -> str:
    return f"{day.year}q{(day.month + 2) // 3}"


def latest_quarters(n: int, today: datetime.date) -> list[str]:
    """The last n completed quarters, the oldest first."""
    month = 12 * today.year + 3 * ((today.month - 1) // 3)  # first month of the running quarter, counted from 0
    return [f"{m // 12}q{m % 12 // 3 + 1}" for m in range(month - 3 * n, month, 3)]


def quarters_since(first: str, today: datetime.date) -> list[str]:
    """Partitions from a quarter on to the last completed one."""
    year, q = map(int, first.split("q"))
    n = 4 * (today.year - year) + (today.month - 1) // 3 + 1 - q
    return latest_quarters(max(n, 0), today)


def chunk_id(adsh: Column, item: Column, index: Column, text: Column) -> Column:
    """F16: content address of a chunk, 32 hex digits."""
    return F.substring(F.sha2(F.concat_ws("|", adsh, item, index.cast("string"), text), 256), 1, 32)


def document_url(base: str, cik: Column, adsh: Column, instance: Column) -> Column:
    """address of a filing's main document from the name of its data file."""
    return F.concat(F.lit(base.rstrip("/") + "/"), cik.cast("string"), F.lit("/"), F.replace(adsh, F.lit("-"), F.lit("")), F.lit("/"), F.replace(instance, F.lit("_htm.xml"), F.lit(".htm")))


def hosted_cost(chars: Column) -> Column:
    """what a hosted model would have cost."""
    return chars / CHARS_PER_TOKEN / 1e6 * HOSTED_USD_PER_MILLION


#: Price of answers per million tokens (question, answer) in USD for a model that a price list lacks.
TOKEN_USD_PER_MILLION = (3.0, 15.0)


def answer_cost(model: Column, asked: Column, answered: Column, prices: dict[str, tuple[float, float]] | None = None) -> Column:
    """what answers cost in USD by tokens of question and answer, from a price list by model."""
    usd = asked / 1e6 * TOKEN_USD_PER_MILLION[0] + answered / 1e6 * TOKEN_USD_PER_MILLION[1]
    for name, (low, high) in (prices or {}).items():
        usd = F.when(model == name, asked / 1e6 * low + answered / 1e6 * high).otherwise(usd)
    return F.round(usd, 6)


def word_window(text: Column, words: int = 25, tail: int = 30) -> Column:
    """a window of words from about a third of the text on, not nearer than `tail` words to its end."""
    w = F.filter(F.split(text, r"\s+"), lambda x: x != "")
    n = F.size(w)
    start = F.least(F.floor(n / 3).cast("int"), F.greatest(F.lit(0), n - tail))
    return F.array_join(F.slice(w, start + 1, words), " ")


def ratio(a: Column, b: Column) -> Column:
    """a / b where b is positive, else null."""
    return F.when(b > 0, a / b)


def percent(part: Column, whole: Column, places: int) -> Column:
    """rounded percentage, null for an empty whole."""
    return F.round(F.when(whole != 0, 100.0 * part.cast("double") / whole), places)
