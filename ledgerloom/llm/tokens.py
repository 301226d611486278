"""Encoding of the whole corpus with a public byte-level BPE vocabulary, in linear time.

Bytes are mapped to Latin-1 characters, so the vocabulary is one Aho-Corasick automaton over text. A pre-token is encoded
by backtracking from longest matches: from each place the longest vocabulary item is taken whose pair with the item
before is *compatible*, that is, merging by rank would never have joined across their border; where none fits, the last
item gives way to its next shorter prefix. Compatibility of a pair of ids is decided by undoing merges on both sides of
the border and memoised; places that failed are marked, so each is tried once. The result is exactly that of merging by
rank.

Text is cut where a token must end anyway: between a character that isn't white space and one that is. The pieces between
(a word with its leading space, mostly) repeat, so each is looked up in a memo of bounded size first. A text is processed
whole; a very long one is one row and needs memory for its own ids only.

Defined results: NULL text gives NULL ids; empty text gives an empty list; blank text is encoded like any other; strings
that look like special tokens are ordinary text; equal texts give equal ids; lone surrogates can't occur in Spark
strings.
"""

from __future__ import annotations

import base64
import json
import os
import re
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import ahocorasick
import pandas as pd
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"

# White space as Unicode defines it; Python's own \s also takes four control characters.
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PRETOKEN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"
)
_RUN_OF_SPACE = re.compile(r"\s (?:\s|\Z)")
_PIECES = re.compile(rf"[{_WS}]*[^{_WS}]+|[{_WS}]+")


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins of bytes in vocabulary files: printable Latin-1 stands for itself, the rest follows 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Exact byte-level BPE of one vocabulary."""

    MEMO = 300_000

    def __init__(self, path: str = DEFAULT_VOCABULARY):
        vocab, merges = self._load(path)
        self.item = {i: t for t, i in vocab.items()}
        self.length = {i: len(t) for t, i in vocab.items()}
        self.vocab = vocab
        self.joined: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            pair = (vocab[a], vocab[b])
            self.joined[pair] = rank
            self.halves.setdefault(vocab[a + b], (*pair, rank))
        self.shorter: dict[int, int | None] = {}
        self.whole: dict[int, bool] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.words = _Memo(self.encode_word, self.MEMO)
        self.memo = _Memo(self._piece, self.MEMO)
        self.spaced = _Memo(lambda piece: self._piece(" " + piece), self.MEMO)
        self.automaton = ahocorasick.Automaton()
        for t, i in vocab.items():
            self.automaton.add_word(t, i)
        self.automaton.make_automaton()

    @staticmethod
    def _load(path: str):
        """Items and merges as Latin-1 text, from a tokenizer file (json) or a file of ranks."""
        if path.endswith(".json"):
            model = json.loads(Path(path).read_text(encoding="utf-8"))["model"]
            to_byte = _byte_letters()
            latin = lambda s: "".join(chr(to_byte[c]) for c in s)
            vocab = {latin(t): i for t, i in model["vocab"].items() if all(c in to_byte for c in t)}
            pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
            return vocab, [(latin(a), latin(b)) for a, b in pairs]
        ranks = {}
        for line in Path(path).read_bytes().splitlines():
            token, rank = line.split()
            ranks[base64.b64decode(token).decode("latin-1")] = int(rank)
        merges = []
        for t in sorted(ranks, key=ranks.get):
            if len(t) > 1:  # the halves are what merging by lower ranks leaves
                parts = list(t)
                while len(parts) > 2:
                    r, k = min((ranks.get(parts[k] + parts[k + 1], 1 << 30), k) for k in range(len(parts) - 1))
                    if r >= ranks[t]:
                        break
                    parts[k : k + 2] = [parts[k] + parts[k + 1]]
                merges.append((parts[0], parts[1]))
        return ranks, merges

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging by rank leaves a border between two adjacent items.

        Undoes, step by step, the later of the last merges next to the border; if at any moment the two neighbours could
        have merged before both were complete, the border would not exist.
        """
        key = (left, right)
        if (known := self.fits.get(key)) is not None:
            return known
        joined, halves = self.joined, self.halves
        a, b, limit, ok = left, right, 1 << 30, True
        while True:
            rank = joined.get((a, b))
            if rank is not None and rank < limit:
                ok = False
                break
            ha, hb = halves.get(a), halves.get(b)
            ra, rb = (ha[2] if ha else -1), (hb[2] if hb else -1)
            if ra < 0 and rb < 0:
                break
            # of the two merges the one that happened later is undone; at equal rank the left one happened first
            if ra > rb:
                limit, a = ra, ha[1]
            else:
                limit, b = rb + 1, hb[0]
        self.fits[key] = ok
        return ok

    def _prefix(self, token: int) -> int | None:
        """The longest vocabulary item that is a proper prefix of an item."""
        if token not in self.shorter:
            t = self.item[token]
            self.shorter[token] = next((self.vocab[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.vocab), None)
        return self.shorter[token]

    def encode_word(self, word: str) -> tuple[int, ...]:
        text = word.encode("utf-8").decode("latin-1")
        if (one := self.vocab.get(text)) is not None and self._whole(one):
            return (one,)
        n, length = len(text), self.length
        longest: list[int] = [0] * n
        reach = [0] * n
        for end, token in self.automaton.iter(text):
            start = end - length[token] + 1
            if length[token] > reach[start]:
                reach[start], longest[start] = length[token], token
        out: list[int] = []
        dead = bytearray(n + 1)
        pos, token = 0, longest[0]
        while pos < n:
            nxt = pos + length[token]
            if not dead[nxt] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                pos = nxt
                if pos < n:
                    token = longest[pos]
                continue
            shorter = self._prefix(token)
            while shorter is None:
                # nothing fits here: this place is dead, the item before gives way
                dead[pos] = 1
                token = out.pop()
                pos -= length[token]
                shorter = self._prefix(token)
            token = shorter
        return tuple(out)

    def _whole(self, token: int) -> bool:
        """Whether merging an item's bytes by rank gives the item itself; worked out once per item."""
        if token not in self.whole:
            parts = [self.vocab[ch] for ch in self.item[token]] if all(ch in self.vocab for ch in self.item[token]) else []
            while len(parts) > 1:
                rank, k = min((self.joined.get((parts[k], parts[k + 1]), 1 << 30), k) for k in range(len(parts) - 1))
                if rank == 1 << 30:
                    break
                parts[k : k + 2] = [self.vocab[self.item[parts[k]] + self.item[parts[k + 1]]]]
            self.whole[token] = parts == [token]
        return self.whole[token]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        self.encode_into(text, out)
        return out

    def encode_into(self, text: str, out: list[int]) -> None:
        if not text:
            return
        if _RUN_OF_SPACE.search(text):
            out.extend(chain.from_iterable(map(self.memo.__getitem__, _PIECES.findall(text))))
            return
        first, *rest = text.split(" ")
        if first:
            out.extend(self.memo[first])
        out.extend(chain.from_iterable(map(self.spaced.__getitem__, rest)))

    def count(self, text: str) -> int:
        return len(self.encode(text))

    def _piece(self, piece: str) -> tuple[int, ...]:
        ids: list[int] = []
        for w in PRETOKEN.findall(piece):
            ids.extend(self.words[w])
        return tuple(ids)


class _Memo(dict):
    """Results by key, computed when missing; emptied when full, and long keys aren't kept."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key: str):
        value = self.make(key)
        if len(key) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


_LOADED: dict[str, Encoder] = {}


def encoder(path: str = DEFAULT_VOCABULARY) -> Encoder:
    """One encoder per Python worker. Where the path isn't there, the file that `share` sent is read."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)))
    return _LOADED[path]


def share(spark: SparkSession, path: str) -> None:
    """Send the vocabulary file to all executors, once per session."""
    context = spark.sparkContext
    sent = context.__dict__.setdefault("_vocabularies", set())
    if path not in sent:
        context.addFile(path)
        sent.add(path)


def encode_documents(
    docs: DataFrame, path: str = DEFAULT_VOCABULARY, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """key, ids. Read, encode and write are one stage without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for at in range(0, len(keys), 512):  # small output batches: ids take more room than text
                flat: list[int] = []
                starts: list[int | None] = []
                for t in texts[at : at + 512].to_pylist():
                    starts.append(None if t is None else len(flat))  # a missing start is a NULL list
                    if t is not None:
                        enc.encode_into(t, flat)
                ids = pa.ListArray.from_arrays(
                    pa.array([*starts, len(flat)], pa.int32()), pa.array(flat, pa.int32())
                )
                yield pa.RecordBatch.from_arrays([keys[at : at + 512], ids], names=[key, "ids"])

    share(docs.sparkSession, path)
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"{key} {kind}, ids array<int>")


def count_tokens(docs: DataFrame, path: str = DEFAULT_VOCABULARY, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_tokens; 0 for empty text, NULL for NULL text."""

    @F.pandas_udf("int")
    def sizes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(path)
        for s in batches:
            yield pd.Series([None if t is None else enc.count(t) for t in s], dtype="Int32")

    share(docs.sparkSession, path)
    return docs.select(key, sizes(F.col(text)).alias("n_tokens"))
