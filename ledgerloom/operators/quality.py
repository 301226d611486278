"""Column-level quality profile: declared checks compiled into one shared aggregate scan with mergeable states.

`column_states` reads the table once, for any number of columns and checks, and gives one small row per partition (a
load) and column: counts, ranges of text, numbers and times, and a HyperLogLog sketch. States of partitions merge without
reading rows again (`merge_states`), and a `StateStore` keeps them: a new load is scanned once, alone, and all that came
before is known from its states. `value_states` are such states for the columns whose most frequent value is watched: all
their checks are one scan, and values are counted on the map side before the only shuffle, so a value held by a third of
all rows is one row per task. `shifts` compares each load with the one before; `control_limits` tests each metric against
the mean and deviation of all earlier loads.

Defined results: shares of an empty set are NULL and never a shift; a load is compared with the load before it that
exists; NULL partition values are a load of their own, before all others; `least` and `most` are by text order of trimmed
values, `least_number` to `most_time` by value, for columns that have such a type or are declared to hold it (values that
can't be read as such don't count); `distinct` is an estimate (about 2 percent off); an empty table gives no rows; unlisted columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from ledgerloom.functions.nulls import clean_str
from ledgerloom.functions.text import EMAIL_RE, norm_domain, person_ok, phone_ok, to_utc


@dataclass(frozen=True)
class Check:
    """Values of `column` that are not missing are of the wrong form where `wrong(value)` holds."""

    column: str
    wrong: callable


COMPANY_CHECKS = (
    Check("phone", lambda v: ~phone_ok(v)),
    Check("ceo", lambda v: ~person_ok(v)),
    Check("founder", lambda v: F.exists(F.split(v, ","), lambda x: ~person_ok(x))),
    Check("industry", lambda v: v.rlike(r"[0-9<>]|http")),
    Check("email", lambda v: ~v.rlike(EMAIL_RE)),
    Check("website", lambda v: norm_domain(v) == ""),
    Check("confidence_score", lambda v: v.try_cast("double").isNull()),
)


# Text columns whose values are numbers or times.
NUMBERS = ("confidence_score",)
TIMES = ("last_updated",)


def column_states(
    df: DataFrame, part: str, columns: list[str], checks=COMPANY_CHECKS, numbers=NUMBERS, times=TIMES
) -> DataFrame:
    """One row per partition and column, from one scan and one aggregation over all columns."""
    wrong = {c.column: c.wrong for c in checks}
    kinds = {f.name: f.dataType for f in df.schema}
    is_time = lambda c: isinstance(kinds[c], DateType | TimestampType | TimestampNTZType)
    cleaned = df.select(
        F.col(part).alias("_part"),
        *[clean_str(F.col(c).cast("string")).alias(c) for c in columns],
        *[F.col(c).cast("timestamp").alias("_time_" + c) for c in columns if is_time(c)],
    )
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in columns:
        v, number, time = F.col(c), F.lit(None).cast("double"), F.lit(None).cast("timestamp")
        if isinstance(kinds[c], NumericType) or c in numbers:
            number = v.try_cast("double")
            number = F.when(~F.isnan(number), number)
        elif is_time(c):
            time = F.col("_time_" + c)
        elif c in times:
            time = to_utc(v)
        bad = F.count_if(v.isNotNull() & wrong[c](v)) if c in wrong else F.lit(None).cast("bigint")
        aggs.append(
            F.struct(
                F.count(v).alias("present"),
                bad.alias("wrong"),
                F.min(v).alias("least"),
                F.max(v).alias("most"),
                F.min(F.length(v)).alias("shortest"),
                F.max(F.length(v)).alias("longest"),
                F.min(number).alias("least_number"),
                F.max(number).alias("most_number"),
                F.min(time).alias("least_time"),
                F.max(time).alias("most_time"),
                F.hll_sketch_agg(v).alias("distinct"),
            ).alias(c)
        )
    g = cleaned.groupBy("_part").agg(*aggs)
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("s")) for c in columns])
    return g.select("_part", "_rows", F.explode(entries).alias("e")).select(
        F.col("_part").alias(part), "e.column_name", F.col("_rows").alias("rows"), "e.s.*"
    )


def merge_states(states: DataFrame, keys: list[str]) -> DataFrame:
    """Fold states into coarser ones (all loads, or old states with those of a new load)."""
    return states.groupBy(*keys).agg(
        F.sum("rows").alias("rows"),
        F.sum("present").alias("present"),
        F.sum("wrong").alias("wrong"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.min("shortest").alias("shortest"),
        F.max("longest").alias("longest"),
        F.min("least_number").alias("least_number"),
        F.max("most_number").alias("most_number"),
        F.min("least_time").alias("least_time"),
        F.max("most_time").alias("most_time"),
        F.hll_union_agg("distinct").alias("distinct"),
    )


class StateStore:
    """States of loads in a folder all executors share, one sub-folder per load. Storing a load again replaces its states."""

    def __init__(self, spark: SparkSession, path: str, part: str):
        self.spark, self.path, self.part = spark, path.rstrip("/"), part

    def known(self) -> DataFrame:
        """The loads that have states."""
        return self.states().select(self.part).distinct()

    def add(self, states: DataFrame) -> None:
        """Store the states of one or more loads; those of other loads stay as they are."""
        x = states.withColumn("_part", F.coalesce(F.col(self.part).cast("string"), F.lit("")))
        w = x.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
        w.partitionBy("_part").parquet(self.path)

    def states(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop("_part")


def profile(states: DataFrame) -> DataFrame:
    """Readable metrics of states."""
    return states.withColumns(
        {
            "missing_share": F.when(F.col("rows") > 0, 1 - F.col("present") / F.col("rows")),
            "wrong_share": F.when(F.col("present") > 0, F.col("wrong") / F.col("present")),
            "distinct": F.hll_sketch_estimate("distinct"),
        }
    )


def profile_by_load(states: DataFrame, part: str) -> DataFrame:
    """The profile of each partition (scope `load`) and of all together (scope `all`, partition NULL), from one set of states."""
    scopes = F.explode(
        F.array(
            F.struct(F.lit("load").alias("scope"), F.col(part).alias("p")),
            F.struct(F.lit("all").alias("scope"), F.lit(None).cast(states.schema[part].dataType).alias("p")),
        )
    )
    x = states.withColumn("_s", scopes).withColumns({"scope": F.col("_s.scope"), part: F.col("_s.p")}).drop("_s")
    return profile(merge_states(x, ["scope", part, "column_name"]))


def value_states(df: DataFrame, part: str, columns: list[str], checks=COMPANY_CHECKS) -> DataFrame:
    """Exact states of a few watched columns: rows, missing, wrong, top (rows of the most frequent value), values."""
    wrong = {c.column: c.wrong for c in checks}
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns]))
    counted = (
        df.select(F.col(part), cells.alias("x"))
        .select(part, F.col("x.c").alias("column_name"), clean_str(F.col("x.v")).alias("v"))
        .groupBy(part, "column_name", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    v, n = F.col("v"), F.col("n")
    bad = F.lit(False)
    for c in columns:
        if c in wrong:
            bad = F.when(F.col("column_name") == c, wrong[c](v)).otherwise(bad)
    return counted.groupBy(part, "column_name").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(v.isNull(), n)), F.lit(0)).alias("missing"),
        F.coalesce(F.sum(F.when(v.isNotNull() & bad, n)), F.lit(0)).alias("wrong"),
        F.coalesce(F.max(F.when(v.isNotNull(), n)), F.lit(0)).alias("top"),
        F.count("v").alias("values"),
    )


def shares(states: DataFrame) -> DataFrame:
    """The watched shares, one column per finding."""
    there = F.col("rows") - F.col("missing")
    return states.withColumns(
        {
            "missing_s": F.when(F.col("rows") > 0, F.col("missing") / F.col("rows")),
            "pattern_s": F.when(there > 0, F.col("wrong") / there),
            "top_value_s": F.when(there > 0, F.col("top") / there),
        }
    )


FINDINGS = ("missing", "pattern", "top_value")


def _long(states: DataFrame, part: str) -> DataFrame:
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("finding"), F.col(f + "_s").alias("share")) for f in FINDINGS]))
    return shares(states).select(part, "column_name", each.alias("e")).select(part, "column_name", "e.*")


def shifts(states: DataFrame, part: str, least_step: float = 0.15) -> DataFrame:
    """Shares that differ from the partition before by at least `least_step`."""
    w = Window.partitionBy("column_name", "finding").orderBy(part)
    step = F.abs(F.col("share") - F.lag("share").over(w))
    # shares are quotients of whole numbers; the slack only absorbs their rounding
    return _long(states, part).withColumn("_step", step).filter(F.col("_step") >= least_step - 1e-12).select(
        part, "column_name", "finding"
    )


def control_limits(states: DataFrame, part: str, sigmas: float = 3.0, least_history: int = 3) -> DataFrame:
    """Each share against mean plus or minus `sigmas` deviations of all earlier partitions."""
    w = Window.partitionBy("column_name", "finding").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    x = _long(states, part).withColumns(
        {"mean": F.avg("share").over(w), "sd": F.stddev_samp("share").over(w), "history": F.count("share").over(w)}
    )
    out = (F.col("history") >= least_history) & (F.abs(F.col("share") - F.col("mean")) > sigmas * F.col("sd"))
    return x.withColumn("out_of_limits", F.coalesce(out, F.lit(False)))
