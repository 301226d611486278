"""Filling fixed-capacity containers: exact-complement hashing over length counts, then best fit.

Lengths are whole numbers up to the capacity, so the items reduce to a histogram of at most `capacity` counters, whatever
the size of the corpus. The plan is made on the histogram: for the longest length that is left, the gap is looked up among
single lengths, sums of two and sums of three that are still available; only if no combination fills it exactly, the
longest length that fits is taken (best fit) and the rest of the gap is looked up again. Each pattern is used as often as
its scarcest length allows, so every pattern ends at least one length and the plan has at most as many patterns as there
are lengths, plus those of partly filled containers.

Items then find their place without any further shuffle of texts: an item's rank among the items of its length is an
offset (per length and salt, from a small table of counts) plus its rank within (length, salt), and the plan maps
(length, rank) to a container by binary search. A length that a third of all items share is spread over all salts.

A text longer than the capacity is split into full containers and one remainder; no other item is split.

Defined results: NULL and empty texts have length 0 or NULL and take no room: they are left out (`n_tokens` 0 needs no
container); duplicate ids are separate items told apart by part_no within their own row order; capacities below 1 are
refused; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.tokens import DEFAULT_VOCABULARY, count_tokens
from ledgerloom.runtime import cut


@dataclass
class Plan:
    """Per use of a length in a pattern: ranks [start, stop) of that length go to containers from `base` on, `per` each."""

    length: np.ndarray
    start: np.ndarray
    base: np.ndarray
    per: np.ndarray
    n_containers: int

    def find(self, length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The row of the plan that holds each item of this length and rank. Rows are ordered by length and start.

        Length (by its place among the plan's lengths) and rank make one key; both are small enough together for any
        corpus of less than 2 ** 63 items and lengths.
        """
        lengths = np.unique(self.length)
        step = int(self.start.max(initial=0)) + 2
        if len(lengths) * step >= 1 << 63:
            raise OverflowError("more items and lengths than fit one key")
        starts = np.searchsorted(lengths, self.length) * step + self.start
        wanted = np.searchsorted(lengths, length) * step + np.minimum(rank, step - 1)
        return np.searchsorted(starts, wanted, side="right") - 1


class _Stock:
    """Lengths with items left: counters, and one bit per length in rising and falling order.

    With both bit strings, "is there a pair of lengths with this sum" is one shift and one AND of whole numbers.
    """

    def __init__(self, counts: np.ndarray):
        self.left = [int(n) for n in counts]
        self.left[0] = 0
        self.size = len(self.left)
        self.up = sum(1 << n for n, c in enumerate(self.left) if c)
        self.down = sum(1 << (self.size - n) for n, c in enumerate(self.left) if c)

    def take(self, n: int, k: int) -> None:
        self.left[n] -= k
        if not self.left[n]:
            self.up &= ~(1 << n)
            self.down &= ~(1 << (self.size - n))

    def largest(self, most: int, used: dict[int, int]) -> int:
        """The longest length up to `most` of which an item is left beside those in use; 0 if there is none."""
        bits = self.up & ((1 << (most + 1)) - 1)
        while bits:
            n = bits.bit_length() - 1
            if self.left[n] > used.get(n, 0):
                return n
            bits ^= 1 << n
        return 0

    def pair(self, gap: int, used: dict[int, int]) -> tuple[int, ...] | None:
        """Two lengths that fill the gap, the first as long as possible."""
        both = self.up & (self.down >> (self.size - gap)) & ((1 << gap) - 1)  # bit n: both n and gap - n are there
        while both:
            x = both.bit_length() - 1
            y = gap - x
            if x < y:
                return None
            if self.left[x] >= used.get(x, 0) + 1 + (x == y) and self.left[y] >= used.get(y, 0) + 1:
                return x, y
            both ^= 1 << x
        return None

    def triple(self, gap: int, used: dict[int, int]) -> tuple[int, ...] | None:
        """Three lengths that fill the gap; the longest member is tried in falling order."""
        bits = self.up & ((1 << (gap - 1)) - 1)
        while bits:
            x = bits.bit_length() - 1
            if 3 * x < gap:
                return None
            if self.left[x] > used.get(x, 0) and (p := self.pair(gap - x, {**used, x: used.get(x, 0) + 1})):
                return (x, *p)
            bits ^= 1 << x
        return None


def make_plan(counts: np.ndarray, capacity: int) -> Plan:
    """counts[n] items of length n, for n up to capacity."""
    stock = _Stock(counts)
    taken = [0] * stock.size
    rows: list[tuple[int, int, int, int]] = []
    n = 0
    while stock.up:
        top = stock.up.bit_length() - 1
        used, gap = {top: 1}, capacity - top
        while gap > 0 and (best := stock.largest(gap, used)):
            more = (best,) if best == gap else None
            if not more and gap <= 2 * best:
                more = stock.pair(gap, used)
            if not more and gap <= 3 * best:
                more = stock.triple(gap, used)
            if not more:
                # no exact complement: best fit, at once as often as three of it don't fill the gap yet
                more = (best,) * max(1, min(stock.left[best] - used.get(best, 0), gap // best - 2))
            for x in more:
                used[x] = used.get(x, 0) + 1
                gap -= x
        times = min(stock.left[x] // k for x, k in used.items())
        for x, k in used.items():
            rows.append((x, taken[x], n, k))
            taken[x] += times * k
            stock.take(x, times * k)
        n += times
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 4).T
    return Plan(cols[0], cols[1], cols[2], cols[3], n)


def items_of(sizes: DataFrame, capacities: list[int], key: str = "doc_id") -> DataFrame:
    """capacity, key, part_no, length: each text under each capacity, longer ones in full parts and a remainder."""
    caps = F.explode(F.array(*[F.lit(c) for c in capacities])).alias("capacity")
    x = sizes.filter(F.col("n_tokens") > 0).select(key, "n_tokens", caps)
    n_parts = F.ceil(F.col("n_tokens") / F.col("capacity")).cast("int")
    parts = x.select("capacity", key, "n_tokens", F.explode(F.sequence(F.lit(1), n_parts)).alias("part_no"))
    return parts.select(
        "capacity",
        key,
        "part_no",
        F.least(F.col("capacity"), F.col("n_tokens") - (F.col("part_no") - 1) * F.col("capacity")).cast("int").alias("length"),
    )


def pack(sizes: DataFrame, capacities: list[int], key: str = "doc_id") -> DataFrame:
    """capacity, key, part_no, n_tokens, container_id (from 0 per capacity). `sizes`: key and n_tokens, read twice."""
    if any(c < 1 for c in capacities):
        raise ValueError("a capacity is at least 1")
    spark = sizes.sparkSession
    items = items_of(sizes, capacities, key)
    n_salts = max(8, min(1024, 2 * spark.sparkContext.defaultParallelism))
    salted = items.withColumn("salt", F.pmod(F.xxhash64(key, "part_no"), F.lit(n_salts)).cast("int"))
    # at most sum(capacities) x salts small rows; the histogram proper has one counter per length
    by_salt = salted.groupBy("capacity", "length", "salt").agg(F.count(F.lit(1)).alias("n"))
    hist = by_salt.groupBy("capacity", "length").agg(F.sum("n").alias("n")).collect()
    plans = {}
    for c in capacities:
        counts = np.zeros(c + 1, dtype=np.int64)
        for r in hist:
            if r["capacity"] == c:
                counts[r["length"]] = r["n"]
        plans[c] = make_plan(counts, c)
    shared = spark.sparkContext.broadcast(plans)

    offset = F.sum("n").over(
        Window.partitionBy("capacity", "length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = by_salt.select("capacity", "length", "salt", F.coalesce(offset, F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("capacity", "length", "salt").orderBy(key, "part_no")) - 1
    ranked = salted.withColumn("rank", rank).join(offsets, ["capacity", "length", "salt"])

    @F.pandas_udf("bigint")
    def container(capacity: pd.Series, length: pd.Series, rank: pd.Series) -> pd.Series:
        out = np.empty(len(rank), dtype=np.int64)
        for c in capacity.unique():
            p, at = shared.value[int(c)], (capacity == c).to_numpy()
            ln, r = length.to_numpy()[at].astype(np.int64), rank.to_numpy()[at].astype(np.int64)
            k = p.find(ln, r)
            out[at] = p.base[k] + (r - p.start[k]) // p.per[k]
        return pd.Series(out)

    return ranked.select(
        "capacity",
        key,
        "part_no",
        F.col("length").alias("n_tokens"),
        container("capacity", "length", F.col("rank") + F.col("offset")).alias("container_id"),
    )


def pack_documents(docs: DataFrame, specs: DataFrame, path: str = DEFAULT_VOCABULARY, key: str = "doc_id") -> DataFrame:
    """spec_id, key, part_no, n_tokens, container_id of every document with at least one token under every spec."""
    rows = specs.select("spec_id", "capacity_tokens").collect()  # one row per kind of container
    sizes = cut(count_tokens(docs, path, key=key))
    packed = pack(sizes, sorted({r["capacity_tokens"] for r in rows}), key)
    kinds = F.broadcast(specs.select("spec_id", F.col("capacity_tokens").alias("capacity")))
    return packed.join(kinds, "capacity").select("spec_id", key, "part_no", "n_tokens", "container_id")


def fill_report(packed: DataFrame) -> DataFrame:
    """Per spec: items, containers and the share of room used, against the specs' capacities."""
    per = packed.groupBy("spec_id", "container_id").agg(
        F.sum("n_tokens").alias("used"), F.count(F.lit(1)).alias("n_items")
    )
    return per.groupBy("spec_id").agg(
        F.sum("n_items").alias("n_items"),
        F.count(F.lit(1)).alias("n_containers"),
        F.sum("used").alias("n_tokens"),
        F.max("used").alias("fullest"),
    )
