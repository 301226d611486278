"""Text similarity (normalised Indel) and the lossless blocking of its self-join.

ratio(a, b) = 100 * 2 * LCS(a, b) / (|a| + |b|); token_sort_ratio compares the texts with their words sorted.
"""

from __future__ import annotations

import itertools
import math
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.runtime import cut


def sorted_words(c: Column) -> Column:
    """Words in order, single blanks between; NULL where there is none."""
    t = F.array_join(F.array_sort(F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")), " ")
    return F.when(t != "", t)


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel: one whole number holds a row of the table."""
    if not a or not b:
        return 0
    at: dict[str, int] = {}
    for i, ch in enumerate(a):
        at[ch] = at.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & at.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def indel_ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 100.0 if not total else 200.0 * lcs_length(a, b) / total


def best_window_ratio(a: str, b: str) -> float:
    """Partial ratio: the shorter text against every window of its length in the longer, and shorter ends of it."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 100.0 if not b else 0.0
    n, m = len(a), len(b)
    windows = {b[i : i + n] for i in range(m - n + 1)}
    windows |= {b[:k] for k in range(1, n)} | {b[m - k :] for k in range(1, n)}
    return max(indel_ratio(a, w) for w in windows)


def ratio_udf(a: str, b: str) -> Column:
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else indel_ratio(p, q) for p, q in zip(x, y)], dtype="float64")

    return F.pandas_udf(run, "double")(a, b)


def partial_ratio_udf(a: Column, b: Column) -> Column:
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        out = [None if p is None or q is None else best_window_ratio(p, q) for p, q in zip(x, y)]
        return pd.Series(out, dtype="float64")

    return F.pandas_udf(run, "double")(a, b)


def _grams(texts: DataFrame, q: int) -> DataFrame:
    """texts with one row per numbered q-gram g: the second occurrence of a gram in a text is another one, so counts of
    shared grams are exact. Linear in the length of the texts."""
    raw = F.when(
        F.length("s") >= q, F.transform(F.sequence(F.lit(1), F.length("s") - q + 1), lambda i: F.substring("s", i, F.lit(q)))
    ).otherwise(F.array().cast("array<string>"))
    each = texts.select("*", F.explode(raw).alias("g")).groupBy(*texts.columns, "g").agg(F.count(F.lit(1)).alias("k"))
    return each.select(*texts.columns, F.explode(F.sequence(F.lit(1), F.col("k"))).alias("k"), "g").withColumn(
        "g", F.concat("g", F.lit("\x01"), F.col("k").cast("string"))
    ).drop("k")


def short_bounds(threshold: float, q: int) -> tuple[int, int]:
    """The longest length for which shared q-grams guarantee nothing, and the largest distance of a match there; (0, 0) if
    every length has its guarantee. Raises where there is no longest length."""

    def far(n: int) -> int:
        return int((n + int(n * (200 - threshold) / threshold + 1e-9)) * (1 - threshold / 100) + 1e-9)

    # a longer text gains 1 - q * slope shared grams a letter, so a bound exists where that is above 0
    gain = 1 - q * (1 + (200 - threshold) / threshold) * (1 - threshold / 100)
    if gain <= 0:
        raise ValueError(f"at {threshold} {q}-grams guarantee nothing at any length")
    short = [n for n in range(1, int(2 * q / gain) + q + 2) if n - q + 1 - q * far(n) < 1]
    return (max(short), max(far(n) for n in short)) if short else (0, 0)


def gram_length(threshold: float) -> int:
    """The longest grams for which short texts are no more than one letter from their matches; 1 if there are none."""
    for q in (3, 2):
        try:
            if short_bounds(threshold, q)[1] <= 1:
                return q
        except ValueError:
            continue
    return 1


def common_length(n: int, m: int, threshold: float) -> int:
    """Letters that the longest common subsequence of texts of n and m letters has at least, if they match."""
    return math.ceil((n + m) * threshold / 200 - 1e-6)


def _meetings(lengths: list[int], threshold: float) -> tuple[dict[int, set[int]], dict[int, set[int]], set[int]]:
    """Of texts of these lengths: per length of the shorter (and per length of the longer) text of a pair what lengths of common
    subsequences they meet on; and the lengths with a pair that has too many of them."""
    shorter, longer = {}, {}
    # of longer texts nothing is counted: leaving out one letter is too much already
    big = min((n for n in lengths if n > MOST_CUTS), default=math.inf)
    rest = {n for n in lengths if n >= big * threshold / (200 - threshold) - 1e-6}
    few = [n for n in lengths if n <= MOST_CUTS]
    for n, m in itertools.combinations_with_replacement(few, 2):
        c = common_length(n, m, threshold)
        if c > n:
            continue
        if math.comb(m, m - c) <= MOST_CUTS:
            shorter.setdefault(n, set()).add(c)
            longer.setdefault(m, set()).add(c)
        else:
            rest |= {n, m}
    return shorter, longer, rest


def _subsequences(c: Column, left_out: int) -> Column:
    """Hashes of what is left of a text after leaving out so many letters, for every choice of them."""

    def without(w: Column, i: Column) -> Column:
        return F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w)))

    def step(w: Column, start: Column, more: int) -> Column:
        def each(i: Column) -> Column:
            return F.xxhash64(without(w, i)) if more == 1 else step(without(w, i), i, more - 1)

        # the next letter left out is never before the last one, so no choice is made twice
        out = F.transform(F.sequence(start, F.length(w)), each)
        none = F.array().cast("array<bigint>")
        return F.when(start <= F.length(w), out if more == 1 else F.flatten(out)).otherwise(none)

    return F.array_distinct(step(c, F.lit(1), left_out)) if left_out else F.array(F.xxhash64(c))


def _meeting_keys(k: DataFrame, meetings: dict[int, set[int]], name: str) -> DataFrame:
    """h and the text's number under `name`, for every common subsequence that a text meets others on."""
    by_length = F.create_map(*[F.lit(v) for n, cs in sorted(meetings.items()) for v in (n, sorted(cs))])
    x = k.select("s", "id", "n", F.explode(F.element_at(by_length, F.col("n"))).alias("c")).withColumn("out", F.col("n") - F.col("c"))
    keys = F.lit(None).cast("array<bigint>")
    for out in sorted({n - c for n, cs in meetings.items() for c in cs}):
        keys = F.when(F.col("out") == out, _subsequences(F.col("s"), out)).otherwise(keys)
    return x.select(F.explode(keys).alias("h"), F.col("id").alias(name))


def _subsequence_pairs(k: DataFrame, sizes: dict[int, int], shorter: dict[int, set[int]], longer: dict[int, set[int]]) -> DataFrame:
    """s, s2: texts that have a subsequence in common which is as long as a match of their lengths needs."""
    made = sum(sizes[n] * math.comb(n, n - c) for part in (shorter, longer) for n, cs in part.items() for c in cs)
    l, r = _meeting_keys(k, shorter, "i"), _meeting_keys(k, longer, "j")
    if (parts := made // KEYS_PER_PART) > int(k.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        l, r = l.repartition(parts, "h"), r.repartition(parts, "h")
    # sizes are estimated from the texts, not from what is made of them: no side of these joins may be a broadcast
    met = l.hint("merge").join(r, "h").filter("i != j").select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")).distinct()
    a, b = k.select(F.col("id").alias("i"), F.col("s").alias("a")), k.select(F.col("id").alias("j"), F.col("s").alias("b"))
    met = met.join(a.hint("merge"), "i").join(b.hint("merge"), "j")
    return met.select(F.least("a", "b").alias("s"), F.greatest("a", "b").alias("s2"))


HOT = 5_000  # texts that one task compares for one gram
MOST_CUTS = 300  # subsequences of a text that one pair of lengths may ask for
KEYS_PER_PART = 1_000_000


def _gram_pairs(k: DataFrame, t: float) -> DataFrame:
    """s, s2: texts that share one of their rarest grams."""
    q = gram_length(t)
    shrink = t / (200.0 - t)  # least ratio of lengths
    longest = F.floor(F.col("n") / F.lit(shrink) + 1e-9)
    d_max = F.floor((F.col("n") + longest) * F.lit(1 - t / 100.0) + 1e-9)
    need = F.col("n") - q + 1 - q * d_max if q > 1 else F.ceil(F.col("n") * F.lit(shrink) - 1e-9)
    grams = _grams(k.select("s", "n", need.cast("int").alias("need")).filter("need >= 1"), q)
    freq = grams.groupBy("g").agg(F.count(F.lit(1)).alias("f"))
    order = Window.partitionBy("s").orderBy("f", "g")
    indexed = (
        grams.join(freq.hint("merge"), "g")
        .withColumn("r", F.row_number().over(order))
        .filter(F.col("r") <= F.col("n") - q + 1 - F.col("need") + 1)
        .select("s", "n", "g", F.ceil(F.col("f") / HOT).cast("int").alias("parts"))
    )
    fits = lambda a, b: F.least(a, b) >= F.greatest(a, b) * F.lit(shrink) - 1e-9
    l = indexed.withColumn("part", F.pmod(F.xxhash64("s"), F.col("parts")).cast("int")).drop("parts")
    r = indexed.select(F.col("s").alias("s2"), F.col("n").alias("n2"), "g", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return l.join(r.hint("merge"), ["g", "part"]).filter(F.col("s") < F.col("s2")).filter(fits(F.col("n"), F.col("n2"))).select("s", "s2")


def similar_pairs(keys: DataFrame, threshold: float, key: str = "key") -> DataFrame:
    """left, right, score of all pairs of distinct texts with ratio >= threshold (left < right). Threshold: above 0 to 100.

    A match of n and m letters has a common subsequence of at least t / 200 of n + m letters. Pairs of lengths for which the
    longer text has no more than MOST_CUTS of that length meet on it, by hash: work grows with the number of texts and of
    matches only. At 90 these are all texts up to 15 letters, and of longer ones (up to 25) those of about equal length.

    Other pairs, exact prefix filter: with threshold t, texts of length L share at least `need` numbered q-grams with any
    match, so two matches share one of their (grams - need + 1) rarest grams. Pairs meet on those grams only. Texts too short
    for a guarantee (five letters at 90) are all among the pairs above. Lower thresholds take shorter grams; single letters
    always give a guarantee, as matches have a common subsequence of at least t / (200 - t) of L. A gram of many texts is
    split over several tasks; its pairs grow with the square of the texts that have it. Edit distance, which is no more than
    the distance that the score is made of, drops most candidates before the exact score is asked.
    """
    t = float(threshold)
    if not 0 < t <= 100:
        raise ValueError("the threshold is above 0 and at most 100")
    k = keys.select(F.col(key).alias("s")).filter("s IS NOT NULL").distinct()
    k = cut(k.select("s", F.length("s").alias("n"), F.monotonically_increasing_id().alias("id")))
    sizes = {r["n"]: r["count"] for r in k.groupBy("n").count().collect()}  # one row per length
    shorter, longer, rest = _meetings(sorted(sizes), t)
    found = [_subsequence_pairs(k, sizes, shorter, longer)] if shorter else []
    if rest or not found:
        found.append(_gram_pairs(k.filter(F.col("n").isin(*rest)), t))
    cand = reduce(DataFrame.unionByName, found)
    room = f"cast(floor((length(s) + length(s2)) * {1 - t / 100.0!r} + 1e-9) as int)"
    cand = cand.distinct().filter(F.expr(f"levenshtein(s, s2, {room}) >= 0"))
    scored = cand.withColumn("score", ratio_udf("s", "s2"))
    return scored.filter(F.col("score") >= t - 1e-9).select(F.col("s").alias("left"), F.col("s2").alias("right"), "score")
