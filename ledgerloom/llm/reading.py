"""Reading level of each document: sentence levels by character and word models, summed up to a calibrated document level.

A sentence is scored by a regularised multinomial model whose inputs are its words and the character n-grams in them
(hashed). A word's score doesn't depend on its neighbours, so each distinct word is scored once per worker and a sentence
is a mean over table rows. A document is described by the distribution of its sentences' levels, and a second small model
turns that into the document's level; it is fitted on sentences that the first model hasn't seen (two folds).

Models are fitted on the driver from at most MAX_LABELLED labelled documents (the ones with the smallest hash of their
id), read whole. Everything else covers all documents, whole texts, in one stage without a shuffle.

Defined results: NULL, empty and blank texts, and texts without a single word, get the most frequent level of the
labels; documents longer than any in the labels are treated alike, sentence by sentence; equal texts get equal levels; no
labels at all gives level NULL; labels for unknown documents and NULL levels are ignored; repeated labels of a document
count once (the smallest level).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_LABELLED = 1000
BUCKETS = 1 << 16
WINDOW = 40  # words; a longer run without a stop is cut into windows

_STOPS = re.compile(r"[.!?]+(?=\s)|\n+|</?(?:p|br|li|div|h\d)\b[^>]*>")
_ASIDE = re.compile(r"\([^()]*\)|https?://\S+|<[^<>]*>")  # each try ends at the next bracket, so this is linear
_WORD = re.compile(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*")


def sentences(text: str) -> list[list[str]]:
    """Lower-case words of each sentence; asides in brackets, addresses and markup don't count."""
    out = []
    for s in _STOPS.split(_ASIDE.sub(" ", text.lower())):
        words = s.split()
        if len(words) > WINDOW:
            out.extend(words[i : i + WINDOW] for i in range(0, len(words), WINDOW))
        elif words:
            out.append(words)
    return out


def features(word: str) -> list[int]:
    """Hashed features of a written word: itself and its character 3-grams; none without letters."""
    m = _WORD.search(word)
    if not m:
        return []
    w = m.group()
    marked = f"<{w}>".encode()
    out = {zlib.crc32(marked[i : i + 3]) % BUCKETS for i in range(len(marked) - 2)}
    out.add(zlib.crc32(b"=" + marked) % BUCKETS)
    return [*out]


class Vocabulary(dict):
    """Written word to row number, growing as words come; row 0 is for words without letters."""

    def __init__(self):
        super().__init__()
        self.rows: list[list[int]] = [[]]

    def __missing__(self, word: str) -> int:
        f = features(word)
        n = len(self.rows) if f else 0
        if f:
            self.rows.append(f)
        self[word] = n
        return n


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_softmax(forward, backward, params: list[np.ndarray], y: np.ndarray, weight, l2: list[float], steps: int, rate: float):
    """Adam on the whole sample; forward(params) gives logits, backward(gradient of logits) the gradients."""
    m = [np.zeros_like(p) for p in params]
    v = [np.zeros_like(p) for p in params]
    onehot = np.eye(params[-1].shape[-1], dtype=np.float32)[y]
    for t in range(1, steps + 1):
        g = (softmax(forward(params)) - onehot) * weight[:, None]
        for k, d in enumerate(backward(g)):
            d = d + l2[k] * params[k]
            m[k] += 0.1 * (d - m[k])
            v[k] += 0.01 * (d * d - v[k])
            params[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)
    return params


class SentenceModel:
    def __init__(self, weights: np.ndarray, bias: np.ndarray):
        self.weights, self.bias = weights, bias

    @staticmethod
    def fit(docs: list[list[list[str]]], levels: np.ndarray, n_levels: int, steps: int = 25) -> SentenceModel:
        vocab = Vocabulary()
        sents = [(s, y) for d, y in zip(docs, levels) for s in d]
        ids = np.fromiter(chain.from_iterable(map(vocab.__getitem__, s) for s, _ in sents), np.int64)
        size = np.array([len(s) for s, _ in sents])
        owner = np.repeat(np.arange(len(sents)), size)
        keep = ids > 0
        ids, owner = ids[keep], owner[keep]
        n_words = np.maximum(np.bincount(owner, minlength=len(sents)), 1).astype(np.float32)
        y = np.array([v for _, v in sents])
        # a document's sentences share one vote, levels count alike
        per_doc = np.repeat([1 / max(1, len(d)) for d in docs], [len(d) for d in docs]).astype(np.float32)
        per_level = np.bincount(y, weights=per_doc, minlength=n_levels)
        weight = per_doc / per_level[y] / n_levels
        flat = np.fromiter(chain.from_iterable(vocab.rows), np.int64)
        row = np.repeat(np.arange(len(vocab.rows)), [len(r) for r in vocab.rows])
        scale = (1 / np.sqrt(np.maximum([len(r) for r in vocab.rows], 1))).astype(np.float32)
        used, flat = np.unique(flat, return_inverse=True)

        def forward(p):
            word = sums(p[0][flat], row, len(vocab.rows)) * scale[:, None]
            return sums(word[ids], owner, len(sents)) / n_words[:, None] + p[1]

        def backward(g):
            word = sums((g / n_words[:, None])[owner], ids, len(vocab.rows)) * scale[:, None]
            return [sums(word[row], flat, len(used)), g.sum(axis=0)]

        start = [np.zeros((len(used), n_levels), np.float32), np.zeros(n_levels, np.float32)]
        w, b = fit_softmax(forward, backward, start, y, weight, [1e-6, 0.0], steps, 0.3)
        weights = np.zeros((BUCKETS, n_levels), np.float32)
        weights[used] = w
        return SentenceModel(weights, b)

    def word_score(self, word: str) -> np.ndarray | None:
        f = features(word)
        return self.weights[f].sum(axis=0) / np.sqrt(len(f)) if f else None


def sums(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(owner, weights=values[:, k], minlength=n) for k in range(values.shape[1])], 1).astype(
        np.float32
    )


class WordScores(dict):
    """Written word to row of a growing score table; rows past `most` are recomputed, so memory stays bounded."""

    def __init__(self, model: SentenceModel, most: int = 300_000):
        super().__init__()
        self.model, self.most = model, most
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.table = np.zeros((4096, len(self.model.bias)), np.float32)
        self.n = 1

    def __missing__(self, word: str) -> int:
        score = self.model.word_score(word)
        row = 0
        if score is not None:
            if self.n == len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            row, self.n = self.n, self.n + 1
            self.table[row] = score
        self[word] = row
        return row


def describe(docs: list[list[list[str]]], scores: WordScores) -> tuple[np.ndarray, np.ndarray]:
    """Per document, and word counts: mean of its sentences' level probabilities and share of their leading levels.

    Both are taken twice: a sentence counted by its words up to ten (headings and fragments tell little), and by all.
    """
    k = len(scores.model.bias)
    if len(scores) > scores.most:
        scores.reset()
    sents = [s for d in docs for s in d]
    x, n_words = np.zeros((len(docs), 4 * k), np.float32), np.zeros(len(docs))
    if not sents:
        return x, n_words
    ids = np.fromiter(map(scores.__getitem__, chain.from_iterable(sents)), np.int64)
    starts = np.cumsum([0, *map(len, sents[:-1])])
    known = np.add.reduceat((ids > 0).astype(np.float32), starts)
    logits = np.add.reduceat(scores.table[ids], starts, axis=0) / np.maximum(known, 1)[:, None] + scores.model.bias
    p = softmax(logits.astype(np.float64))
    lead = np.eye(k)[p.argmax(axis=1)]
    owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    for at, w in enumerate((np.minimum(known, 10), known)):
        total = np.bincount(owner, weights=w, minlength=len(docs))
        both = np.concatenate([p, lead], 1) * w[:, None]
        x[:, 2 * k * at : 2 * k * (at + 1)] = sums(both, owner, len(docs)) / np.maximum(total, 1e-9)[:, None]
    return x, np.bincount(owner, weights=known, minlength=len(docs))


class ReadingModel:
    """Sentence model and document calibration; `levels` are the classes in order."""

    def __init__(self, levels, usual, sentence: SentenceModel | None, weights=None, bias=None):
        self.levels, self.usual = levels, usual
        self.sentence, self.weights, self.bias = sentence, weights, bias

    @staticmethod
    def fit(texts: list[str], levels: list[int]) -> ReadingModel:
        kinds = sorted(set(levels))
        if not kinds:
            return ReadingModel([], None, None)
        usual = max(kinds, key=levels.count)
        docs = [sentences(t) for t in texts]
        y = np.array([kinds.index(v) for v in levels])
        full = [bool(d) for d in docs]
        docs, y = [d for d, ok in zip(docs, full) if ok], y[full]
        if len(set(y)) < 2:
            return ReadingModel(kinds, usual, None)
        k = len(kinds)
        # every level is dealt out evenly to both folds, in no order that the ids might have
        fold = np.zeros(len(docs), int)
        rng = np.random.default_rng(0)
        for level in range(k):
            at = rng.permutation(np.flatnonzero(y == level))
            fold[at] = np.arange(len(at)) % 2
        x = np.zeros((len(docs), 4 * k), np.float32)
        for f in (0, 1):
            seen, unseen = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            if not len(seen) or not len(unseen):
                continue
            model = SentenceModel.fit([docs[i] for i in seen], y[seen], k)
            x[unseen] = describe([docs[i] for i in unseen], WordScores(model))[0]
        start = [np.vstack([np.eye(k)] * 4).astype(np.float32) * 3, np.zeros(k, np.float32)]
        weight = np.full(len(y), 1 / len(y), np.float32)
        w, b = fit_softmax(
            lambda p: x @ p[0] + p[1], lambda g: [x.T @ g, g.sum(axis=0)], start, y, weight, [1e-4, 0.0], 300, 0.1
        )
        return ReadingModel(kinds, usual, SentenceModel.fit(docs, y, k), w, b)

    def levels_of(self, texts, scores: WordScores) -> list[int]:
        docs = [sentences(t) if t else [] for t in texts]
        x, n = describe(docs, scores)
        best = (x @ self.weights + self.bias).argmax(axis=1)
        return [self.levels[j] if m > 0 else self.usual for j, m in zip(best, n)]


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED, key: str = "doc_id") -> ReadingModel:
    """Fit on a bounded sample of labelled documents, chosen by a hash of the id."""
    chosen = (
        labels.filter(F.col("level").isNotNull())
        .groupBy(key)
        .agg(F.min("level").alias("level"))
        .orderBy(F.xxhash64(key), key)
        .limit(most)
    )
    # at most `most` rows on this side, so it may be broadcast
    rows = docs.select(key, "text").join(F.broadcast(chosen), key).filter(F.col("text").isNotNull()).collect()
    rows.sort(key=lambda r: r[key])
    return ReadingModel.fit([r["text"] for r in rows], [r["level"] for r in rows])


def reading_levels(docs: DataFrame, model: ReadingModel, key: str = "doc_id") -> DataFrame:
    """key, level of every document."""
    if model.sentence is None:
        return docs.select(key, F.lit(model.usual).cast("int").alias("level"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("int")
    def level(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scores = WordScores(shared.value.sentence)
        for s in batches:
            out: list[int] = []
            for at in range(0, len(s), 200):
                out += shared.value.levels_of(s.iloc[at : at + 200].tolist(), scores)
            yield pd.Series(out, dtype="int32")

    return docs.select(key, level("text").alias("level"))
