"""Lexical retrieval (R2): English stems, all terms required, phrases, alternatives and exclusions, cover-density rank.

Terms of chunks are kept with their positions. A query meets only the chunks that hold its rarest term, so a common term
never multiplies; the other terms are then looked up in those chunks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# English stop words.
STOP_WORDS = frozenset(
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself they them their theirs themselves what which who whom this that these "
    "those am is are was were be been being have has had having do does did doing a an the and but if or because as until while of at by for with about against between into through during before after "
    "above below to from up down in out on off over under again further then once here there when where why how all any both each few more most other some such no nor not only own same so than too very "
    "s t can will just don should now".split()
)
_WORD = re.compile(r"\w+(?:\.\w+)*")
_V = "aeiou"


def _consonants(w: str) -> str:
    """c or v for every letter; y is a vowel after a consonant."""
    out = ""
    for i, ch in enumerate(w):
        vowel = ch in _V or (ch == "y" and i > 0 and out[-1] == "c")
        out += "v" if vowel else "c"
    return out


def _measure(w: str) -> int:
    return len(re.findall("v+c", _consonants(w)))


# Suffix tables of Porter's algorithm (1980), steps 2 to 4.
_STEP2 = dict(ational="ate", tional="tion", enci="ence", anci="ance", izer="ize", abli="able", alli="al", entli="ent", eli="e", ousli="ous", ization="ize", ation="ate", ator="ate", alism="al", iveness="ive", fulness="ful", ousness="ous", aliti="al", iviti="ive", biliti="ble")
_STEP3 = dict(icate="ic", ative="", alize="al", iciti="ic", ical="ic", ful="", ness="")
_STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")


def _table(w: str, table: dict[str, str]) -> str:
    for suffix in sorted(table, key=len, reverse=True):
        if w.endswith(suffix):
            root = w[: -len(suffix)]
            return root + table[suffix] if _measure(root) > 0 else w
    return w


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    """Porter's stemmer of 1980."""
    w = word
    if len(w) <= 2 or not w.isascii() or not w.isalpha():
        return w
    if w.endswith("sses") or w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    if w.endswith("eed"):
        if _measure(w[:-3]) > 0:
            w = w[:-1]
    else:
        for suffix in ("ed", "ing"):
            if w.endswith(suffix):
                root = w[: -len(suffix)]
                if "v" in _consonants(root):
                    w = root
                    if w.endswith(("at", "bl", "iz")):
                        w += "e"
                    elif len(w) > 1 and w[-1] == w[-2] and _consonants(w)[-1] == "c" and w[-1] not in "lsz":
                        w = w[:-1]
                    elif _measure(w) == 1 and _short(w):
                        w += "e"
                break
    if w.endswith("y") and "v" in _consonants(w[:-1]):
        w = w[:-1] + "i"
    w = _table(_table(w, _STEP2), _STEP3)
    for suffix in sorted(_STEP4, key=len, reverse=True):
        if w.endswith(suffix):
            root = w[: -len(suffix)]
            if _measure(root) > 1 and (suffix != "ion" or root.endswith(("s", "t"))):
                w = root
            break
    if w.endswith("e"):
        root = w[:-1]
        if _measure(root) > 1 or (_measure(root) == 1 and not _short(root)):
            w = root
    if w.endswith("ll") and _measure(w) > 1:
        w = w[:-1]
    return w


def _short(w: str) -> bool:
    """Ends consonant, vowel, consonant, the last not w, x or y."""
    return _consonants(w)[-3:] == "cvc" and w[-1] not in "wxy"


# Letters, suffixes and exceptions of the English stemmer (Porter2), in the order in which they are tried.
_VOWELS, _DOUBLES, _LI = "aeiouy", ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt"), "cdeghkmnrt"
_PREFIXES = ("gener", "commun", "arsen")
_EXCEPTIONS = dict(skis="ski", skies="sky", dying="die", lying="lie", tying="tie", idly="idl", gently="gentl", ugly="ugli", early="earli", only="onli", singly="singl") | {w: w for w in ("sky", "news", "howe", "atlas", "cosmos", "bias", "andes")}
_AFTER_PLURAL = frozenset(("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"))
_SECOND = dict(tional="tion", enci="ence", anci="ance", abli="able", entli="ent", izer="ize", ization="ize", ational="ate", ation="ate", ator="ate", alism="al", aliti="al", alli="al", fulness="ful", ousli="ous", ousness="ous", iveness="ive", iviti="ive", biliti="ble", bli="ble", ogi="og", fulli="ful", lessli="less", li="")
_THIRD = dict(tional="tion", ational="ate", alize="al", icate="ic", iciti="ic", ical="ic", ful="", ness="", ative="")
_FOURTH = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion")


def _region(w: str, start: int) -> int:
    """Where the region after the first other letter that follows a vowel begins, from `start` on."""
    m = re.compile(f"[{_VOWELS}][^{_VOWELS}]").search(w, start)
    return m.end() if m else len(w)


def _ends_short(w: str) -> bool:
    """Whether w ends in a short syllable."""
    return bool(re.search(f"(?:[^{_VOWELS}][{_VOWELS}][^{_VOWELS}wxY]|^[{_VOWELS}][^{_VOWELS}])$", w))


def _longest(w: str, suffixes) -> str | None:
    return max((x for x in suffixes if w.endswith(x)), key=len, default=None)


@lru_cache(maxsize=200_000)
def english_stem(word: str) -> str:
    """The English stemmer that full-text search of databases uses (Porter2); other scripts and numbers stay as they are."""
    if len(word) <= 2 or not re.fullmatch(r"[a-z']+", word):
        return word
    if word in _EXCEPTIONS:
        return _EXCEPTIONS[word]
    w = re.sub(f"(?<=[{_VOWELS}])y|^y", "Y", word.lstrip("'"))
    head = next((p for p in _PREFIXES if w.startswith(p)), None)
    r1 = len(head) if head else _region(w, 0)
    r2 = _region(w, r1)
    w = re.sub(r"'s?'?$", "", w)
    # plurals
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("s") and not w.endswith(("us", "ss")) and re.search(f"[{_VOWELS}].", w[:-1]):
        w = w[:-1]
    if w in _AFTER_PLURAL:
        return w
    # past and progressive forms
    suffix = _longest(w, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    if suffix and suffix.startswith("ee"):
        if len(w) - len(suffix) >= r1:
            w = w[: -len(suffix)] + "ee"
    elif suffix and re.search(f"[{_VOWELS}]", w[: -len(suffix)]):
        w = w[: -len(suffix)]
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif w.endswith(_DOUBLES):
            w = w[:-1]
        elif r1 >= len(w) and _ends_short(w):
            w += "e"
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in _VOWELS:
        w = w[:-1] + "i"
    # derivations, the longest suffix of each round
    suffix = _longest(w, _SECOND)
    if suffix and len(w) - len(suffix) >= r1:
        root = w[: -len(suffix)]
        if (suffix != "ogi" or root.endswith("l")) and (suffix != "li" or root[-1:] in tuple(_LI)):
            w = root + _SECOND[suffix]
    suffix = _longest(w, _THIRD)
    if suffix and len(w) - len(suffix) >= (r2 if suffix == "ative" else r1):
        w = w[: -len(suffix)] + _THIRD[suffix]
    suffix = _longest(w, _FOURTH)
    if suffix and len(w) - len(suffix) >= r2 and (suffix != "ion" or w[:-3].endswith(("s", "t"))):
        w = w[: -len(suffix)]
    # final e and double l
    at = len(w) - 1
    if w.endswith("e") and (at >= r2 or (at >= r1 and not _ends_short(w[:-1]))) or (w.endswith("ll") and at >= r2):
        w = w[:-1]
    return w.lower()


def terms(text: str | None, english: bool = True, stemmer=english_stem) -> list[tuple[str, int]]:
    """(term, position from 1) of a text; stop words keep their place but give no term. stemmer: english_stem, or the older
    `stem`."""
    out = []
    for i, w in enumerate(_WORD.findall((text or "").lower()), 1):
        if not english:
            out.append((w, i))
        elif w not in STOP_WORDS:
            out.append((stemmer(w), i))
    return out


def parse_query(text: str, english: bool = True) -> list[dict]:
    """Alternatives (split at the word or) of a web-style query: terms all required, phrases in quotes, terms after a
    minus sign excluded. An alternative without a required term matches nothing."""
    out = []
    for part in re.split(r'\bor\b(?=(?:[^"]*"[^"]*")*[^"]*$)', text, flags=re.IGNORECASE):
        need: list[str] = []
        phrases: list[list[list]] = []
        without: list[str] = []
        for minus, quoted, word in re.findall(r'(-?)(?:"([^"]*)"|(\S+))', part):
            found = terms(quoted or word, english)
            if minus:
                without += [t for t, _ in found]
            else:
                need += [t for t, _ in found]
                if len(found) > 1:
                    phrases.append([[t, p - found[0][1]] for t, p in found])
        if need:
            out.append({"need": sorted(set(need)), "phrases": phrases, "without": sorted(set(without))})
    return out


def covers(places: dict[str, list[int]]) -> list[tuple[int, int, int]]:
    """Minimal spans that hold every term: (first position, last position, terms' occurrences within)."""
    flat = sorted((p, t) for t, ps in places.items() for p in ps)
    count: dict[str, int] = {}
    out, low = [], 0
    for high, (_, t) in enumerate(flat):
        count[t] = count.get(t, 0) + 1
        if len(count) < len(places):
            continue
        while count[flat[low][1]] > 1:
            count[flat[low][1]] -= 1
            low += 1
        out.append((flat[low][0], flat[high][0], high - low + 1))
        del count[flat[low][1]]
        low += 1
    return out


def cover_density(places: dict[str, list[int]], weight: float = 0.1) -> float:
    """Sum over minimal spans of weight over one plus the words between that aren't terms."""
    return sum(weight / (1 + max(0, (b - a) - (n - 1))) for a, b, n in covers(places))


def match_rank(alternative: dict, places: dict[str, list[int]]) -> float | None:
    """Rank of a chunk for one alternative of a query, or None."""
    if any(t not in places for t in alternative["need"]) or any(t in places for t in alternative["without"]):
        return None
    for phrase in alternative["phrases"]:
        begins = set(places[phrase[0][0]])
        for t, off in phrase[1:]:
            begins &= {p - off for p in places[t]}
        if not begins:
            return None
    return cover_density({t: places[t] for t in alternative["need"]})


_POSTINGS = T.StructType([T.StructField("term", T.StringType()), T.StructField("chunk_id", T.StringType()), T.StructField("positions", T.ArrayType(T.IntegerType()))])


def index_terms(chunks: DataFrame, english: bool = True) -> DataFrame:
    """term, chunk_id, positions: a row per term and chunk (repeated chunks give repeated rows). Chunks without an id have
    none, null and empty texts neither."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: dict[tuple[str, str], list[int]] = {}
            for n, (chunk, text) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
                for t, p in terms(text, english):
                    found.setdefault((t, n, chunk), []).append(p)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.string()), pa.array([k[2] for k in found], pa.string()), pa.array(list(found.values()), pa.list_(pa.int32()))], names=_POSTINGS.names)

    return chunks.where("chunk_id is not null").select("chunk_id", "text").mapInArrow(run, _POSTINGS)


_ALTERNATIVES = "query_id string, alternative int, need array<string>, used array<string>, plan string"


def lexical_matches(indexed: DataFrame, queries: DataFrame, english: bool = True) -> DataFrame:
    """query_id, chunk_id, score of every chunk that matches (the best of a query's alternatives).

    indexed: of index_terms; queries: query_id (string), query. A query without terms matches nothing. The postings of the
    terms asked for are written once; a query meets only the chunks of its rarest term, and of those only the postings of
    its own terms.
    """
    import json

    from chronofact.session import cut

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(q, i, a["need"], sorted({*a["need"], *a["without"]}), json.dumps(a)) for q, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for i, a in enumerate(parse_query(text or "", english))]
            c = list(zip(*rows, strict=True)) or [()] * 5
            words = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.string()), pa.array(c[1], pa.int32()), pa.array(c[2], words), pa.array(c[3], words), pa.array(c[4], pa.string())], names=["query_id", "alternative", "need", "used", "plan"])

    parsed = cut(queries.select(F.col("query_id").cast("string"), "query").mapInArrow(parse, _ALTERNATIVES), "queries")
    asked = cut(parsed.select(F.explode("used").alias("term")).distinct(), "terms")  # its size is known, so Spark broadcasts it where it is small
    # a chunk listed twice has one posting of a term
    held = cut(indexed.join(asked, "term").groupBy("term", "chunk_id").agg(F.max("positions").alias("positions")), "postings")
    frequency = held.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    key = ["query_id", "alternative"]
    counted = parsed.select(*key, F.explode("need").alias("term")).join(frequency, "term", "left")
    rarest = counted.groupBy(*key).agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term")).alias("r")).where("r.n > 0").select(*key, F.col("r.term").alias("term"))
    candidates = rarest.join(held.select("term", "chunk_id"), "term").select(*key, "chunk_id")
    wanted = candidates.join(parsed.select(*key, F.size("need").alias("n_need"), F.explode("used").alias("term"), F.array_contains("need", F.col("term")).alias("needed")), key)
    places = wanted.join(held, ["term", "chunk_id"]).groupBy(*key, "chunk_id").agg(F.first("n_need").alias("n_need"), F.collect_set(F.when(F.col("needed"), F.col("term"))).alias("have"), F.map_from_entries(F.collect_list(F.struct("term", "positions"))).alias("postings"))
    full = places.where(F.size("have") == F.col("n_need")).join(parsed.select(*key, "plan"), key)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            plans = [json.loads(p) for p in b.column(2).to_pylist()]
            scores = [match_rank(p, dict(m)) for p, m in zip(plans, b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(scores, pa.float64())], names=["query_id", "chunk_id", "score"])

    ranked = full.select("query_id", "chunk_id", "plan", "postings").mapInArrow(rank, "query_id string, chunk_id string, score double")
    return ranked.where("score is not null").groupBy("query_id", "chunk_id").agg(F.max("score").alias("score"))
