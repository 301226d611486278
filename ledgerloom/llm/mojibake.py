"""Garbled text from wrong character encoding: forms of clean words under every chain, joined with the corpus's words.

A chain is "text was written in one encoding and read in another", once or twice. The words of all cells are reduced to
the distinct ones with a character outside ASCII (combined on the map side). Every clean one generates its garbled form
under every chain; a hash join of the corpus's words with these forms finds garbled words and gives their originals.
Originals are verified by the join itself: the original, garbled under the chain, is the word found.

Only words that the join doesn't find are judged by themselves, against the same table one level down: the garbled forms
of every character of the common alphabets, with all of a word's characters under one chain, and letters that can't stand
where they do. The column `how` tells the ways apart (join, characters, lost); the README gives their shares.

A word with U+FFFD has lost characters: it is marked, and restored only if exactly one clean word of the corpus fits.
Where two words are garbled forms of each other, the more frequent one is the original, then the smaller one.

Defined results: NULL, empty and plain ASCII texts are never marked; a text may be garbled in part; texts already clean
(capitals such as 'SAO' with a tilde, Cyrillic names) stay as they are; a cell is listed once however many words it has;
very long texts are split by blanks only; equal candidates go to the more frequent original, then to the smaller text; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOST = "�"

# Written in the first encoding, read in the second; the last two of a chain of four are applied after the first two.
CHAINS = (
    ("utf-8", "cp1252"),
    ("utf-8", "latin-1"),
    ("utf-8", "mac_roman"),
    ("utf-8", "cp437"),
    ("utf-8", "cp850"),
    ("utf-8", "cp1250"),
    ("utf-8", "cp1251"),
    ("utf-8", "cp1254"),
    ("utf-8", "cp1257"),
    ("utf-8", "iso8859-2"),
    ("utf-8", "iso8859-15"),
    ("utf-8", "cp866"),
    ("utf-8", "koi8-r"),
    ("utf-8", "cp1252", "utf-8", "cp1252"),
    ("utf-8", "latin-1", "utf-8", "latin-1"),
    ("utf-8", "cp1252", "utf-8", "latin-1"),
    ("utf-8", "latin-1", "utf-8", "cp1252"),
    ("mac_roman", "cp1252"),
    ("cp1251", "cp1252"),
    ("cp1251", "latin-1"),
    ("koi8-r", "cp1252"),
    ("koi8-r", "cp1251"),
)


def _read(data: bytes, codec: str) -> str:
    """Decode as browsers do: bytes that a Windows code page leaves open stand for themselves."""
    try:
        return data.decode(codec)
    except UnicodeDecodeError:
        if not codec.startswith("cp125"):
            raise
        return "".join(_one(b, codec) for b in data)


def _one(b: int, codec: str) -> str:
    try:
        return bytes([b]).decode(codec)
    except UnicodeDecodeError:
        return chr(b)


def garble(text: str, chain: tuple[str, ...]) -> str | None:
    """The text under a chain, or None where an encoding lacks a character or nothing changes."""
    out = text
    try:
        for k in range(0, len(chain), 2):
            out = _read(out.encode(chain[k]), chain[k + 1])
    except (UnicodeEncodeError, UnicodeDecodeError):
        return None
    return out if out != text else None


# The common alphabets, by rule: Latin-1 and Latin Extended-A letters, Cyrillic, typographic signs.
ALPHABET = [
    *(chr(c) for c in (*range(0xA1, 0x180), 0x192, *range(0x400, 0x460), *range(0x2010, 0x2028), 0x2030, 0x2039, 0x203A)),
    "€", "™", "№", " ",
]
_PLAIN = re.compile(r"[^\x00-\x7f]{2,}|[\x80-\x9f]")
_C1 = re.compile(r"[\x80-\x9f]")


class Characters:
    """Per multi-byte chain, the garbled forms of the alphabet's characters, longest first."""

    def __init__(self):
        self.tables = []
        for k, chain in enumerate(CHAINS):
            if chain[0] != "utf-8":
                continue
            back: dict[str, str] = {}
            for ch in ALPHABET:
                g = garble(ch, chain)
                if g and len(g) > 1:
                    back.setdefault(g, ch)
            forms = sorted(back, key=len, reverse=True)
            self.tables.append((k, back, re.compile("|".join(map(re.escape, forms)))))

    def mend(self, word: str) -> tuple[str, int] | None:
        """The word with every garbled character restored under one chain, and the chain's number."""
        best = None
        for k, back, forms in self.tables:
            hits = 0

            def put(m: re.Match, back=back) -> str:
                nonlocal hits
                hits += len(m.group())
                return back[m.group()]

            fixed = forms.sub(put, word)
            if not hits or _C1.search(fixed):
                continue
            # fewest characters left outside ASCII wins: a longer chain explains more of the word
            score = (sum(ch > "\x7f" for ch in fixed), len(fixed), k)
            if best is None or score < best[0]:
                best = (score, fixed, k)
        return (best[1], best[2]) if best else None


# Letters that can't stand where they do: a capital or sign inside a lower-case word, a small letter inside capitals.
_MISFIT = re.compile(
    "[a-z](?:[À-ÖØ-ÞŠŽŒŸ]|[‡ˆ‰‹›œ™¨¿•](?=[a-z]))"
    "|[A-Z](?:Ÿ(?=[a-z])|[ß-öø-ÿšž](?=[A-Z]))"
)
_HIGH_LATIN = re.compile("^[^\x00-\x7f]*[À-ÿ][^A-Za-z]*$")


def mend_alone(word: str) -> str | None:
    """Restoration of a word garbled between one-byte encodings, where its own shape gives it away."""
    letters = [ch for ch in word if ch.isalpha() or ch in "¨¸"]
    if len(set(letters)) >= 3 and _HIGH_LATIN.match(word):
        # no ASCII letter at all, three or more different accented Latin ones: Cyrillic read as Western
        try:
            fixed = word.encode("cp1252").decode("cp1251")
        except (UnicodeEncodeError, UnicodeDecodeError):
            fixed = ""
        if fixed and all("Ѐ" <= ch <= "џ" for ch in fixed if ch.isalpha()):
            return fixed
    if _MISFIT.search(word):
        try:
            fixed = word.encode("cp1252").decode("mac_roman")
        except (UnicodeEncodeError, UnicodeDecodeError):
            return None
        if not _MISFIT.search(fixed) and all(ch.isalpha() or ch in "’‘“”–—…€®" for ch in fixed if ch > "\x7f"):
            return fixed
    return None


_LEAD_AT_END = re.compile("(?:[a-z]|^)[ÃÅĂ√├](?=$)")


def cells(df: DataFrame, columns=("name", "description"), key: str = "row_id") -> DataFrame:
    """key, column_name, text of every cell with a character outside ASCII."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("t")) for c in columns]))
    x = df.select(F.col(key), each.alias("x")).select(key, F.col("x.c").alias("column_name"), F.col("x.t").alias("text"))
    return x.filter(F.col("text").rlike(r"[^\x00-\x7F]"))


def words_of(c: DataFrame, key: str = "row_id") -> DataFrame:
    """key, column_name, word of the distinct words outside ASCII in each cell; split at ASCII blanks only."""
    w = F.filter(F.array_distinct(F.split("text", r"[ \t\r\n\f]+")), lambda x: x.rlike(r"[^\x00-\x7F]"))
    return c.select(key, "column_name", F.explode(w).alias("word"))


def garbled_words(words: DataFrame) -> DataFrame:
    """word, original (NULL where it can't be restored), how: every garbled word in `words`, a table with a column word."""
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    # few bytes that mean much work: spread by number, not by size
    counted = counted.repartition(max(16, 2 * words.sparkSession.sparkContext.defaultParallelism), "word")

    # Each distinct word gives one row (form = '') with what its own shape says, and, if it is clean, its garbled forms.
    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chars = Characters()
        for b in batches:
            word, form, kind, n, mended = [], [], [], [], []

            def row(w, f, k, c, m=None, word=word, form=form, kind=kind, n=n, mended=mended):
                word.append(w), form.append(f), kind.append(k), n.append(c), mended.append(m)

            for w, c in zip(b["word"], b["n"]):
                if LOST in w:
                    row(w, w, "lost", c)
                    continue
                m = chars.mend(w) if _PLAIN.search(w) else None
                alone = None if m else mend_alone(w)
                if m or alone or _C1.search(w) or _LEAD_AT_END.search(w):
                    row(w, w, "odd", c, m[0] if m else alone)
                    continue
                row(w, w, "clean", c)
                for g in {garble(w, chain) for chain in CHAINS} - {None}:
                    row(w, g, "form", c)
                row(w, _lose(w), "lossy", c)
            yield pd.DataFrame({"word": word, "form": form, "kind": kind, "n": n, "mended": mended})

    x = counted.mapInPandas(expand, "word string, form string, kind string, n bigint, mended string")
    # One shuffle on the form brings found words and generated forms together.
    own = F.col("kind").isin("lost", "odd", "clean")
    form = F.struct(F.col("n"), F.col("word").alias("original"))
    g = x.groupBy("form").agg(
        F.max(F.when(own, F.struct("kind", "n", "mended"))).alias("own"),
        F.max(F.when(F.col("kind") == "form", form)).alias("best"),
        F.min(F.when(F.col("kind") == "lossy", F.col("word"))).alias("lossy"),
        F.count_if(F.col("kind") == "lossy").alias("n_lossy"),
    ).filter(F.col("own").isNotNull())
    kind, joined = F.col("own.kind"), F.col("best").isNotNull()
    # two words that both look clean may be forms of each other
    turned = F.when(joined & (kind == "clean"), _is_form("best.original", "form"))
    first = (F.col("best.n") > F.col("own.n")) | ((F.col("best.n") == F.col("own.n")) & (F.col("best.original") < F.col("form")))
    how = (
        F.when(joined & (~F.coalesce(turned, F.lit(False)) | first), "join")
        .when(kind == "odd", "characters")
        .when(kind == "lost", "lost")
    )
    original = (
        F.when(F.col("how") == "join", F.col("best.original"))
        .when(F.col("how") == "characters", F.col("own.mended"))
        .when(F.col("n_lossy") == 1, F.col("lossy"))
    )
    found = g.withColumn("how", how).filter(F.col("how").isNotNull())
    return found.select(F.col("form").alias("word"), original.alias("original"), "how")


def _is_form(form: str, word: str) -> Column:
    """`form` is a garbled form of `word`; NULL stays NULL."""

    def run(forms: pd.Series, words: pd.Series) -> pd.Series:
        return pd.Series([f is not None and f in {garble(w, chain) for chain in CHAINS} for f, w in zip(forms, words)], dtype=bool)

    return F.pandas_udf(run, "boolean")(form, word)


def _lose(word: str) -> str:
    """The word as it looks when Western bytes were read as UTF-8 and every bad byte became U+FFFD."""
    return re.sub(r"[^\x00-\x7f]", LOST, word)


def find_garbled(df: DataFrame, columns=("name", "description"), key: str = "row_id") -> DataFrame:
    """key, column_name of every cell garbled in whole or in part."""
    words = words_of(cells(df, columns, key), key)
    return words.join(garbled_words(words).select("word"), "word", "left_semi").select(key, "column_name").distinct()


def ways_found(df: DataFrame, columns=("name", "description"), key: str = "row_id") -> DataFrame:
    """how, n_words, n_cells: what each way of finding adds; a cell counts for the first of join, lost, characters."""
    words = words_of(cells(df, columns, key), key)
    hits = words.join(garbled_words(words).select("word", "how"), "word")
    order = F.when(F.col("how") == "join", 0).when(F.col("how") == "lost", 1).otherwise(2)
    per_cell = hits.groupBy(key, "column_name").agg(F.min_by("how", order).alias("how")).groupBy("how").agg(F.count(F.lit(1)).alias("n_cells"))
    return hits.groupBy("how").agg(F.countDistinct("word").alias("n_words")).join(per_cell, "how", "left")


def restore(df: DataFrame, columns=("name", "description"), key: str = "row_id") -> DataFrame:
    """key, column_name, text, restored, complete (false where some word could not be restored)."""
    c = cells(df, columns, key)
    words = words_of(c, key)
    hits = words.join(garbled_words(words).drop("how"), "word").groupBy(key, "column_name").agg(
        F.map_from_entries(F.collect_list(F.struct("word", F.coalesce("original", "word")))).alias("_map"),
        F.bool_and(F.col("original").isNotNull()).alias("complete"),
    )
    parts = F.regexp_extract_all("text", F.lit(r"[ \t\r\n\f]+|[^ \t\r\n\f]+"), 0)
    mended = F.array_join(F.transform(parts, lambda w: F.coalesce(F.try_element_at("_map", w), w)), "")
    return c.join(hits, [key, "column_name"]).select(key, "column_name", "text", mended.alias("restored"), "complete")


