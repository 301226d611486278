"""Mapping free-entered values to a canonical list: symmetric-delete lookup, weighted edit distance, reported misses.

A dictionary is made from the reference list: every accepted spelling of an entry (its value and its other names) in
normal form, plus all strings that come from it by leaving out up to two letters. A value is looked up by its own
deletions, so no value is ever compared with the whole list; hits are ranked by weighted Damerau-Levenshtein distance and
then by how often the entry occurs verbatim in the data.

The list's other names are incomplete, so they are completed from the data, not by hand: a value that fits nothing is
learnt as another name of an entry if the companies that use it say so elsewhere. For at least LEAST_COMPANIES companies
and LEAST_SHARE of those that have a mapped value in another row, that entry must be the most frequent one. The values
left over are then looked up again, with the learnt names and their slips in the dictionary.

Only distinct values are looked up; rows get their entry by a join on the value. The dictionary is broadcast where it has
at most MAX_NAMES names (counted first); a longer one is joined by its deletions on the executors, with the same result.

Defined results: NULL and missing values and values written exactly as in the list give no row; a value that fits no
entry gives ref_id 0 (the reported miss); head counts go to the band that holds them, 0 and negative counts to none;
equal distances go to the entry with more verbatim rows, then to the smaller ref_id; one name of several entries goes to
the smallest ref_id; names of one or two letters must be met exactly, those of three or four but for a swapped or doubled
letter, up to eleven but for one edit, longer ones but for two; values with digits or markup aren't learnt; rows without
a company teach nothing; an empty reference list maps every value to 0; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.nulls import is_missing
from ledgerloom.runtime import cut

MAX_NAMES = 20_000
LEAST_COMPANIES, LEAST_SHARE = 2, 0.75
MOST_EDITS = 2

_FILLER = {"and", "und", "et", "y"}
_LEAD = re.compile(r"^(?:industry|sector|branch|branche|field|business)\s*[:\-–—]\s*", re.I)
_LEAD2 = re.compile(r"^sector\s+-\s+|^[\-*•·]+\s*", re.I)


def forms(text: str) -> list[str]:
    """Normal forms, shortest first: lower case, no accents, words of letters and digits, without lead-ins.

    The first is without filler words and a closing 'industry'; the others keep one or both, for slips in those words.
    """
    t = unicodedata.normalize("NFKD", text).strip()
    t = "".join(ch for ch in t if not unicodedata.combining(ch))
    t = _LEAD.sub("", _LEAD2.sub("", t.strip()))
    words = [w for w in re.split(r"[^0-9a-z]+", t.lower()) if w]
    out = []
    for tail in (True, False):
        kept = words[:-1] if tail and len(words) > 1 and words[-1] in ("industry", "branche") else words
        out += [" ".join(w for w in kept if w not in _FILLER), " ".join(kept)]
    return list(dict.fromkeys(x for x in out if x))


def normal(text: str) -> str:
    return (forms(text) or [""])[0]


def deletions(word: str, most: int) -> set[str]:
    out, edge = {word}, {word}
    for _ in range(most):
        edge = {w[:i] + w[i + 1 :] for w in edge for i in range(len(w))}
        out |= edge
    return out


_NEAR = {frozenset(p) for r in ("qwertyuiop", "asdfghjkl", "zxcvbnm") for p in zip(r, r[1:])}


def distance(a: str, b: str, most: float) -> float:
    """Weighted Damerau-Levenshtein (optimal string alignment).

    A swap of neighbours or a doubled letter costs 0.8, a substitution of keys that lie side by side or of two vowels
    0.9, any other edit 1.
    """
    if abs(len(a) - len(b)) > most + 1:
        return most + 1
    prev2, prev = None, [float(j) for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        row = [float(i)]
        for j, y in enumerate(b, 1):
            gap_a = 0.8 if i > 1 and a[i - 2] == x else 1.0
            gap_b = 0.8 if j > 1 and b[j - 2] == y else 1.0
            if x == y:
                sub = 0.0
            elif frozenset((x, y)) in _NEAR or (x in "aeiou" and y in "aeiou"):
                sub = 0.9
            else:
                sub = 1.0
            best = min(prev[j] + gap_a, row[j - 1] + gap_b, prev[j - 1] + sub)
            if prev2 is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, prev2[j - 2] + 0.8)
            row.append(best)
        prev2, prev = prev, row
    return prev[-1]


def limit(name: str) -> float:
    """The largest distance at which a value still means this name. Short names become others by one letter."""
    n = len(name)
    return 0.0 if n < 3 else 0.8 if n < 5 else 1.0 if n < 12 else 2.0


def reach(name: str) -> int:
    """Letters to leave out of a name so that all values within its limit share a text with it."""
    return 0 if len(name) < 3 else 1 if len(name) < 12 else MOST_EDITS


class SymmetricDelete:
    """Lookup in one list. `names`: (name in normal form, ref_id, verbatim rows of the entry)."""

    def __init__(self, names):
        self.exact: dict[str, int] = {}
        self.counts: dict[int, int] = {}
        self.longest = 0
        for name, ref_id, n in names:
            self.exact[name] = min(ref_id, self.exact.get(name, ref_id))
            self.counts[ref_id] = n
            self.longest = max(self.longest, len(name))
        self.table = defaultdict(set)
        for name in self.exact:
            for d in deletions(name, reach(name)):
                self.table[d].add(name)

    def find(self, value: str) -> int:
        written = forms(value)
        for n in written:
            if n in self.exact:
                return self.exact[n]
        ranked = []
        for n in written:
            if len(n) > self.longest + MOST_EDITS:
                continue  # too long for any name
            near = set().union(*(self.table.get(d, ()) for d in deletions(n, MOST_EDITS)))
            for name in near:
                if (dist := distance(n, name, limit(name))) <= limit(name):
                    ref = self.exact[name]
                    ranked.append((dist, -self.counts.get(ref, 0), ref))
        return min(ranked)[2] if ranked else 0


_MONTHS = {m: i for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split(), 1)}
_NUM = r"(\d{1,3}(?:[, .'’]\d{3})+|\d+(?:\.\d+)?)\s*([kK](?![a-zA-Z]))?"
_RANGE = re.compile(rf"{_NUM}\s*(?:-|–|—|−|/|\.\.+|\bto\b|\bbis\b|~)\s*{_NUM}")
_MORE = re.compile(rf"(?:>\s*|over\s+|more than\s+|above\s+){_NUM}|{_NUM}\s*(?:\+|plus\b|or more|and more)", re.I)
_ONE = re.compile(_NUM)
_DATE = re.compile(r"^(?:(\d{1,2})[\s\-./]([a-z]{3})[a-z]*|([a-z]{3})[a-z]*[\s\-./](\d{1,2}))$", re.I)


def _number(digits: str, kilo: str | None) -> float:
    grouped = re.fullmatch(r"\d{1,3}(?:[, .'’]\d{3})+", digits)
    n = float(re.sub(r"[^\d]", "", digits)) if grouped else float(digits)
    return n * 1000 if kilo else n


class HeadCount:
    """Maps head counts and written ranges to bands such as '11-50' and '10000+'."""

    def __init__(self, entries):
        self.bands = []
        for ref_id, value, _ in entries:
            if m := re.fullmatch(r"(\d+)-(\d+)", value):
                self.bands.append((float(m[1]), float(m[2]), ref_id))
            elif m := re.fullmatch(r"(\d+)\+", value):
                self.bands.append((float(m[1]) + 1, float("inf"), ref_id))
        self.bands.sort()

    def band(self, n: float) -> int:
        for low, high, ref_id in self.bands:
            if n <= high:
                return ref_id if n >= low else 0
        return 0

    def _range(self, low: float, high: float) -> int:
        for a, b, ref_id in self.bands:
            # '1k-5k' is how people round '1001-5000'
            if b == high and (a == low or (a == low + 1 and low >= 1000)):
                return ref_id
        # another range fits where one band holds both ends
        return self.band(low) if low <= high and self.band(low) == self.band(high) else 0

    def find(self, value: str) -> int:
        t = unicodedata.normalize("NFKC", value).strip()
        if m := _DATE.match(t):  # a range that a spreadsheet took for a date: '11-50' becomes 'Nov-50'
            month = _MONTHS.get((m[2] or m[3]).lower())
            day = int(m[1] or m[4])
            if month:
                return self._range(*sorted((float(month), float(day))))
        if re.match(r"^[-−]\s*\d", t):
            return 0
        if m := _RANGE.search(t):
            return self._range(_number(m[1], m[2]), _number(m[3], m[4]))
        if m := _MORE.search(t):
            digits, kilo = (m[1], m[2]) if m[1] else (m[3], m[4])
            return self.band(_number(digits, kilo) + 1)
        found = _ONE.findall(t)
        if len(found) == 1:
            return self.band(_number(*found[0]))
        return 0


def names_of(reference: DataFrame, counts: DataFrame) -> DataFrame:
    """column_name, name, ref_id, n of every accepted spelling in normal form, also without blanks; n: verbatim rows."""

    @F.pandas_udf("array<string>")
    def all_forms(value: pd.Series, others: pd.Series) -> pd.Series:
        out = []
        for v, o in zip(value, others):
            found = [n for name in [v or "", *(o or "").split(";")] for n in forms(name)]
            out.append(list(dict.fromkeys(x for n in found for x in (n, n.replace(" ", "")))))
        return pd.Series(out)

    x = reference.join(counts, ["column_name", "ref_id"], "left")
    x = x.select("column_name", "ref_id", F.coalesce("n", F.lit(0)).alias("n"), F.explode(all_forms("ref_value", "also_known_as")).alias("name"))
    return x.groupBy("column_name", "name").agg(F.min(F.struct("ref_id", "n")).alias("b")).select("column_name", "name", "b.ref_id", "b.n")


def lookup(values: DataFrame, names: DataFrame) -> DataFrame:
    """values (column_name, value and others) with ref_id, 0 where no name is near enough."""
    few = names.limit(MAX_NAMES + 1).collect()
    if len(few) > MAX_NAMES:
        return _lookup_by_join(values, names)
    by_column = defaultdict(list)
    for r in few:
        by_column[r["column_name"]].append((r["name"], r["ref_id"], r["n"]))
    finders = values.sparkSession.sparkContext.broadcast({c: SymmetricDelete(n) for c, n in by_column.items()})

    @F.pandas_udf("int")
    def find(column: pd.Series, value: pd.Series) -> pd.Series:
        known = finders.value
        return pd.Series([known[c].find(v) if c in known else 0 for c, v in zip(column, value)], dtype="int32")

    return values.withColumn("ref_id", find("column_name", "value"))


def _lookup_by_join(values: DataFrame, names: DataFrame) -> DataFrame:
    """`lookup` for a list of any length: both sides meet on their deletions."""

    @F.pandas_udf("array<string>")
    def cuts(name: pd.Series) -> pd.Series:
        return pd.Series([sorted(deletions(n, reach(n))) for n in name])

    @F.pandas_udf("array<struct<form:string,place:int,cuts:array<string>>>")
    def written(value: pd.Series) -> pd.Series:
        return pd.Series([[(n, k, sorted(deletions(n, MOST_EDITS))) for k, n in enumerate(forms(v))] for v in value])

    @F.pandas_udf("double")
    def far(form: pd.Series, name: pd.Series) -> pd.Series:
        out = ((distance(f, n, limit(n)), limit(n)) for f, n in zip(form, name))
        return pd.Series([d if d <= most else None for d, most in out], dtype="float64")

    longest = names.groupBy("column_name").agg(F.max(F.length("name")).alias("longest"))
    each = values.select("column_name", "value").distinct().join(longest, "column_name")
    each = each.select("column_name", "value", "longest", F.explode(written("value")).alias("w"))
    exact = each.select("column_name", "value", F.col("w.form").alias("name"), F.col("w.place").alias("place")).join(names, ["column_name", "name"])
    exact = exact.groupBy("column_name", "value").agg(F.min_by("ref_id", "place").alias("exact_id"))
    near = each.filter(F.length("w.form") <= F.col("longest") + MOST_EDITS)
    near = near.select("column_name", "value", F.col("w.form").alias("form"), F.explode("w.cuts").alias("cut"))
    by_cut = names.select("column_name", "name", "ref_id", "n", F.explode(cuts("name")).alias("cut"))
    near = near.join(by_cut, ["column_name", "cut"]).select("column_name", "value", "form", "name", "ref_id", "n").distinct()
    near = near.withColumn("d", far("form", "name")).filter("d IS NOT NULL")
    near = near.groupBy("column_name", "value").agg(F.min(F.struct("d", -F.col("n"), "ref_id")).alias("b"))
    near = near.select("column_name", "value", F.col("b.ref_id").alias("near_id"))
    x = values.join(exact, ["column_name", "value"], "left").join(near, ["column_name", "value"], "left")
    return x.withColumn("ref_id", F.coalesce("exact_id", "near_id", F.lit(0))).drop("exact_id", "near_id")


def _cells(df: DataFrame, columns, *more: str) -> DataFrame:
    """The columns in `more`, column_name, value of every value that isn't missing."""
    each = F.array(*[F.when(~is_missing(F.col(c)), F.struct(F.lit(c).alias("c"), F.col(c).alias("v"))) for c in columns])
    x = df.select(*more, F.explode(each).alias("x")).filter("x IS NOT NULL")
    return x.select(*more, F.col("x.c").alias("column_name"), F.col("x.v").alias("value"))


def learn_names(cells: DataFrame, values: DataFrame) -> DataFrame:
    """column_name, name, ref_id of names learnt from companies. cells: company, column_name, value; values: with form and ref_id."""
    x = cells.join(values.select("column_name", "value", "form", "ref_id"), ["column_name", "value"])
    said = x.filter("ref_id > 0").groupBy("company", "column_name", "ref_id").agg(F.count(F.lit(1)).alias("k"))
    said = said.groupBy("company", "column_name").agg(F.max(F.struct("k", -F.col("ref_id"))).alias("b"))
    said = said.select("company", "column_name", (-F.col("b.col2")).alias("ref_id"))
    plain = F.col("form").rlike(r"^[a-z ]{2,}$") & ~F.col("value").rlike(r"[<>{}]|http")
    open_ = x.filter((F.col("ref_id") == 0) & plain).select("company", "column_name", F.col("form").alias("name")).distinct()
    votes = open_.join(said, ["company", "column_name"]).groupBy("column_name", "name", "ref_id").agg(F.count(F.lit(1)).alias("k"))
    votes = votes.groupBy("column_name", "name").agg(F.sum("k").alias("total"), F.max(F.struct("k", -F.col("ref_id"))).alias("b"))
    sure = (F.col("b.k") >= LEAST_COMPANIES) & (F.col("b.k") >= LEAST_SHARE * F.col("total"))
    return votes.filter(sure).select("column_name", "name", (-F.col("b.col2")).cast("int").alias("ref_id"))


def map_values(df: DataFrame, reference: DataFrame, columns=("industry", "size"), company: str | None = "company_id") -> DataFrame:
    """row_id, column_name, value, ref_id of every value that isn't missing and isn't written as in the list."""
    reference = reference.filter(F.col("column_name").isin(*columns))
    counted = cut(_cells(df, columns).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))
    as_listed = reference.select("column_name", F.col("ref_value").alias("value"), "ref_id")
    counts = counted.join(as_listed, ["column_name", "value"]).select("column_name", "ref_id", "n")
    banded = _bands(reference)
    words = [c for c in columns if c not in banded]
    names = cut(names_of(reference.filter(F.col("column_name").isin(*words)), counts))
    first = cut(lookup(counted.filter(F.col("column_name").isin(*words)).drop("n").withColumn("form", _normal("value")), names))
    mapped = first
    if company is not None and words:
        learnt = learn_names(_cells(df.filter(F.col(company).isNotNull()).withColumn("company", F.col(company)), words, "company"), first)
        ranks = names.groupBy("column_name", "ref_id").agg(F.max("n").alias("n"))
        both = learnt.join(ranks, ["column_name", "ref_id"]).select("column_name", "name", "ref_id", "n")
        again = lookup(first.filter("ref_id = 0").drop("ref_id"), cut(names.unionByName(both)))
        mapped = first.filter("ref_id > 0").unionByName(again)
    mapped = mapped.select("column_name", "value", "ref_id")
    if banded:
        bands = df.sparkSession.sparkContext.broadcast({c: HeadCount(e) for c, e in banded.items()})

        @F.pandas_udf("int")
        def band(column: pd.Series, value: pd.Series) -> pd.Series:
            return pd.Series([bands.value[c].find(v) for c, v in zip(column, value)], dtype="int32")

        numbers = counted.filter(F.col("column_name").isin(*banded))
        mapped = mapped.unionByName(numbers.select("column_name", "value", band("column_name", "value").alias("ref_id")))
    mapped = cut(mapped.join(as_listed.select("column_name", "value"), ["column_name", "value"], "left_anti"))
    return _cells(df, columns, "row_id").join(mapped, ["column_name", "value"]).select("row_id", "column_name", "value", "ref_id")


def _normal(value: str) -> Column:
    return F.pandas_udf(lambda s: s.map(normal), "string")(value)


def _bands(reference: DataFrame) -> dict[str, list[tuple]]:
    """The entries of columns whose list is one of number bands only; such a list is a handful of rows."""
    is_band = F.col("ref_value").rlike(r"^(\d+-\d+|\d+\+)$")
    columns = reference.groupBy("column_name").agg(F.bool_and(is_band).alias("all")).filter("all").select("column_name")
    rows = reference.join(columns, "column_name", "left_semi").limit(MAX_NAMES + 1).collect()
    if len(rows) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} bands; a list of bands is broadcast")
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["ref_id"]):
        out[r["column_name"]].append((r["ref_id"], r["ref_value"], r["also_known_as"]))
    return dict(out)


def misses(mapped: DataFrame) -> DataFrame:
    """Values that fit no entry, with their number of rows."""
    return mapped.filter("ref_id = 0").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n_rows"))
