"""Reading level of each document, from the levels of its sentences.

A regularised multinomial model over hashed words and the character n-grams within them gives every sentence a
distribution over the levels; a second, small model, fitted on predictions for documents the first had not seen,
calibrates the aggregate of a document's sentences into its level. Both are fitted on the driver on a bounded sample of
the labelled documents; every document is then scored in one Arrow pass over its whole text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The models are fitted on at most so many labelled documents, so many sentences of each, drawn by hash, and so many words
#: of a sentence. Sentences are drawn where the documents are: the driver gets no text beyond these bounds.
SAMPLE_DOCUMENTS, SAMPLE_SENTENCES, SAMPLE_WORDS = 3000, 24, 200
#: A language is graded if so many labelled documents are in it.
LEAST_LABELS = 2
#: Hashed features: words, then character n-grams.
WORDS, GRAMS = 1 << 15, 1 << 15
LEVELS = 3
#: Words, ends of sentences, line ends and markup (an end like them).
_PIECE = re.compile(r"<[^<>]{0,99}>|[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?](?=\s|$)|\n")


def features(word: str) -> list[int]:
    """Hashed features of a word: itself and its character 3- to 5-grams with ends marked."""
    marked = f"<{word}>"
    out = [zlib.crc32(word.encode()) % WORDS]
    for n in (3, 4, 5):
        out += [WORDS + zlib.crc32(marked[i : i + n].encode()) % GRAMS for i in range(len(marked) - n + 1)]
    return out


def length_feature(words: np.ndarray) -> np.ndarray:
    """Class of a sentence's length: powers of the square root of two, up to 15."""
    return np.minimum(np.floor(2 * np.log2(np.maximum(words, 1))), 15).astype(np.int64)


class Words(dict):
    """Numbers of words met so far; 0 ends a sentence. New words wait in `fresh`."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []
        self.size = 1

    def __missing__(self, piece: str) -> int:
        if not piece[0].isalpha():
            n = 0
        else:
            n = self.size
            self.size += 1
            self.fresh.append(piece)
        self[piece] = n
        return n


def sentences(text: str, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(word numbers, first word of each sentence) of a text; sentences without words don't count."""
    ids = np.array(list(map(words.__getitem__, _PIECE.findall(text.lower()))), dtype=np.int64)
    inside = ids > 0
    begins = inside & ~np.append(False, inside[:-1])
    return ids[inside], np.flatnonzero(begins[inside])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _adam(theta: np.ndarray, gradient, steps: int, rate: float) -> np.ndarray:
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(1, steps + 1):
        g = gradient(theta)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-8)
    return theta


def _vocabulary(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(features of all words, first feature of each)."""
    fs = [features(w) for w in words]
    size = np.array([len(f) for f in fs], dtype=np.int64)
    return np.concatenate([np.array(f, dtype=np.int64) for f in fs]) if fs else np.zeros(0, dtype=np.int64), np.cumsum(size) - size


def word_vectors(words: list[str], theta: np.ndarray) -> np.ndarray:
    """Level scores of words: the mean over their features."""
    if not words:
        return np.zeros((0, theta.shape[1]), dtype=np.float32)
    flat, first = _vocabulary(words)
    size = np.diff(np.append(first, len(flat)))
    return np.add.reduceat(theta[flat], first, axis=0) / size[:, None]


@dataclass
class Sentences:
    """Sentences of a sample: words flat, their first words, and the document of each sentence."""

    words: np.ndarray
    first: np.ndarray
    document: np.ndarray


def train_sentences(s: Sentences, level: np.ndarray, vocabulary: list[str], steps: int = 60, l2: float = 2e-6, classes: int = LEVELS) -> tuple[np.ndarray, np.ndarray]:
    """(feature weights, length weights) of the sentence model; level: of each sentence, that of its document."""
    flat, vfirst = _vocabulary(vocabulary)
    vsize = np.diff(np.append(vfirst, len(flat)))
    n = np.diff(np.append(s.first, len(s.words)))
    ln = length_feature(n)
    y = np.eye(classes)[level]
    owner = np.repeat(np.arange(len(n)), n)
    order = np.argsort(s.words, kind="stable")
    used, ufirst = np.unique(s.words[order], return_index=True)
    fword = np.repeat(np.arange(len(vfirst)), vsize)
    forder = np.argsort(flat, kind="stable")
    fused, ffirst = np.unique(flat[forder], return_index=True)
    fword = fword[forder]
    size = WORDS + GRAMS

    def gradient(theta: np.ndarray) -> np.ndarray:
        v = np.add.reduceat(theta[flat], vfirst, axis=0) / vsize[:, None]
        z = np.add.reduceat(v[s.words], s.first, axis=0) / n[:, None] + theta[size + ln]
        dz = (_softmax(z) - y) / len(n)
        dword = np.zeros_like(v)
        dword[used] = np.add.reduceat((dz / n[:, None])[owner[order]], ufirst, axis=0)
        g = l2 * theta
        g[fused] += np.add.reduceat((dword / vsize[:, None])[fword], ffirst, axis=0)
        for k in range(16):
            g[size + k] += dz[ln == k].sum(axis=0)
        return g

    theta = _adam(np.zeros((size + 16, classes)), gradient, steps, 0.3)
    return theta[:size], theta[size:]


def document_features(p: np.ndarray, n: np.ndarray, owner: np.ndarray, documents: int) -> np.ndarray:
    """Per document, of its sentences' distributions p (weights: words n): means, shares of the likeliest level, the
    share of clear sentences, and a constant. Documents without sentences get the constant only."""
    out = np.zeros((documents, 3 * LEVELS + 1))
    weight = np.bincount(owner, n, documents)
    some = weight > 0
    best = p.argmax(axis=1)
    for k in range(LEVELS):
        out[:, k] = np.bincount(owner, n * p[:, k], documents)
        out[:, LEVELS + k] = np.bincount(owner, n * (best == k), documents)
        out[:, 2 * LEVELS + k] = np.bincount(owner, n * (p[:, k] > 0.8), documents)
    out[some] /= weight[some, None]
    out[:, -1] = 1
    return out


def train_documents(x: np.ndarray, level: np.ndarray, l2: float = 1e-3, steps: int = 400) -> np.ndarray:
    y = np.eye(LEVELS)[level]
    share = y.mean(axis=0)
    start = np.zeros((x.shape[1], LEVELS))
    for k in range(LEVELS):  # from "the level most of its sentences have" on
        start[k, k] = start[LEVELS + k, k] = 2.0
    start[-1] = 0.1 * np.log(share + 1e-3)
    return _adam(start, lambda t: x.T @ (_softmax(x @ t) - y) / len(x) + l2 * t, steps, 0.05)


@dataclass
class Model:
    theta: np.ndarray
    length: np.ndarray
    calibration: np.ndarray


def score(theta: np.ndarray, length: np.ndarray, words: np.ndarray, first: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distribution, number of words) of each sentence."""
    if not len(first):
        return np.zeros((0, LEVELS)), np.zeros(0)
    n = np.diff(np.append(first, len(words)))
    return _softmax(np.add.reduceat(vectors[words], first, axis=0) / n[:, None] + length[length_feature(n)]), n.astype(float)


def drawn(n: int, key: str) -> list[int]:
    """Numbers of the sentences drawn out of n, in order."""
    if n <= SAMPLE_SENTENCES:
        return list(range(n))
    return sorted(sorted(range(n), key=lambda k: zlib.crc32(f"{key}:{k}".encode()))[:SAMPLE_SENTENCES])


def _drawn_text(key: int, text: str) -> str:
    """The drawn sentences of a text, their words only."""
    found: list[list[str]] = [[]]
    for piece in _PIECE.findall(text.lower()):
        if piece[0].isalpha():
            found[-1].append(piece)
        elif found[-1]:
            found.append([])
    found = [x for x in found if x]
    return ". ".join(" ".join(found[k][:SAMPLE_WORDS]) for k in drawn(len(found), str(key)))


def _draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(_drawn_text, ids, texts), pa.string()), b.column(2), b.column(3)], names=b.schema.names)


def train(texts: list[str], levels: list[int], folds: int = 2) -> Model:
    """Both models from labelled texts (levels from 1). Cross-fitting: the calibration sees only held-out predictions."""
    words = Words()
    flat, first, owner, at = [], [], [], 0
    for i, t in enumerate(texts):
        w, f = sentences(t, words)
        end = np.append(f[1:], len(w))
        for k in drawn(len(f), str(i)):
            flat.append(w[f[k] : end[k]] - 1)
            first.append(at)
            owner.append(i)
            at += end[k] - f[k]
    s = Sentences(np.concatenate(flat), np.array(first), np.array(owner))
    level = np.array(levels) - 1
    vocabulary = words.fresh
    fold = np.array([zlib.crc32(f"fold {i}".encode()) % folds for i in range(len(texts))])
    p, n = np.full((len(s.first), LEVELS), 1 / LEVELS), np.diff(np.append(s.first, len(s.words))).astype(float)
    for k in range(folds):
        seen = fold[s.document] != k
        if len(set(level[s.document[seen]])) < 2 or seen.all():
            continue
        rows = np.flatnonzero(seen)
        size = n[rows].astype(int)
        part = Sentences(np.concatenate([s.words[s.first[r] : s.first[r] + c] for r, c in zip(rows, size, strict=True)]), np.cumsum(size) - size, s.document[rows])
        theta, length = train_sentences(part, level[part.document], vocabulary)
        held, _ = score(theta, length, s.words, s.first, word_vectors(vocabulary, theta))
        p[~seen] = held[~seen]
    theta, length = train_sentences(s, level[s.document], vocabulary)
    calibration = train_documents(document_features(p, n, s.document, len(texts)), level)
    return Model(theta.astype(np.float32), length.astype(np.float32), calibration.astype(np.float32))


def labelled_sample(documents: DataFrame, labels: DataFrame) -> tuple[list[str], list[int], list[str]]:
    """Drawn sentences and levels of at most SAMPLE_DOCUMENTS labelled documents with text, drawn by hash of the id, and the
    languages (lang, if documents have it) that at least LEAST_LABELS of them are in."""
    some = (
        labels.where(f"doc_id is not null and reading_level between 1 and {LEVELS}")
        .groupBy("doc_id").agg(F.min("reading_level").alias("reading_level"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(SAMPLE_DOCUMENTS)
    )
    lang = F.col("lang") if "lang" in documents.columns else F.lit(None).cast("string")
    # at most SAMPLE_DOCUMENTS rows of two numbers are broadcast
    texts = documents.where(F.col("text").rlike(r"\p{L}")).select("doc_id", "text", lang.alias("lang")).join(F.broadcast(some), "doc_id").select("doc_id", "text", "lang", "reading_level")
    rows = texts.mapInArrow(_draw, texts.schema).collect()
    rows.sort(key=lambda r: r["doc_id"])
    langs = [r["lang"] for r in rows if r["lang"] is not None]
    return [r["text"] for r in rows], [r["reading_level"] for r in rows], sorted({x for x in langs if langs.count(x) >= LEAST_LABELS})


_LEVELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("reading_level", T.IntegerType()), *(T.StructField(f"p{k}", T.DoubleType()) for k in (1, 2, 3)), T.StructField("n_sentences", T.IntegerType()), *(T.StructField(f"sentences_{k}", T.IntegerType()) for k in (1, 2, 3))])


def _grade(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        vectors = np.zeros((1, LEVELS), dtype=np.float32)
        for b in batches:
            if words.size > 1_000_000:
                words, vectors = Words(), np.zeros((1, LEVELS), dtype=np.float32)
            texts = b.column(b.schema.names.index("text")).to_pylist()
            flat, first, owner, at = [], [], [], 0
            for i, t in enumerate(texts):
                w, f = sentences(t, words)
                flat.append(w)
                first.append(f + at)
                owner.append(np.full(len(f), i))
                at += len(w)
            if words.fresh:
                vectors = np.concatenate([vectors, word_vectors(words.fresh, model.theta).astype(np.float32)])
                words.fresh = []
            joined = [np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (flat, first, owner)]
            p, n = score(model.theta, model.length, joined[0], joined[1], vectors)
            d = _softmax(document_features(p, n, joined[2], len(texts)) @ model.calibration)
            best = p.argmax(axis=1) if len(p) else np.zeros(0, dtype=np.int64)
            count = [np.bincount(joined[2][best == k], minlength=len(texts)) for k in range(LEVELS)]
            none = sum(count) == 0
            level = pa.array(d.argmax(axis=1) + 1, pa.int32(), mask=none)
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.names.index("doc_id")), level, *(pa.array(d[:, k], pa.float64(), mask=none) for k in range(LEVELS)), pa.array(sum(count), pa.int32()), *(pa.array(c, pa.int32()) for c in count)], names=_LEVELS.names
            )

    return run


def reading_levels(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Level of every document: doc_id, reading_level, its distribution p1 to p3, sentences in all and by level.

    Null texts count as empty. Documents without words have no level (null) and no sentences. Without labels of at least
    two levels there's no model, and every level is null. The model knows the languages of the labelled documents only:
    where documents have a column lang, those of other or no language have no level, and their sentences aren't counted.
    """
    texts, levels, langs = labelled_sample(documents, labels)
    null = [F.lit(None).cast("int").alias("reading_level"), *(F.lit(None).cast("double").alias(f"p{k}") for k in (1, 2, 3)), F.lit(0).alias("n_sentences"), *(F.lit(0).alias(f"sentences_{k}") for k in (1, 2, 3))]
    if len(set(levels)) < 2:
        return documents.select("doc_id", *null)
    known = F.col("lang").isin(langs) if "lang" in documents.columns else F.lit(True)
    rows = documents.where(known).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    graded = rows.mapInArrow(_grade(train(texts, levels)), _LEVELS)
    return graded.unionByName(documents.where(~F.coalesce(known, F.lit(False))).select("doc_id", *null))


def unlabelled_levels(documents: DataFrame, labels: DataFrame, lang: str = "en") -> DataFrame:
    """doc_id and reading_level of the documents of a language with a letter in their text that carry no label."""
    wanted = documents.where((F.col("lang") == lang) & F.col("text").rlike(r"\p{L}")).select("doc_id", "text")
    # levels first, then the anti join on two numbers a row: the texts are never shuffled
    return reading_levels(wanted, labels).select("doc_id", "reading_level").join(labels.select("doc_id").distinct(), "doc_id", "left_anti")
