"""Confidence score, status and review flags of a record, as column expressions.

NULL fields are absent everywhere; a record without any field is judged like any other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.nulls import clean_str, present, strip
from ledgerloom.schema import CRITICAL_FIELDS, OPTIONAL_FIELDS, Settings

# Base score of each source label.
BASE_SCORES = {
    "official_website": 95,
    "linkedin": 80,
    "public_database": 80,
    "llm_inferred": 60,
    "web_scrape": 60,
    "weak_signal": 30,
    "not_found": 0,
}
BONUS_MAX, CRITICAL_PENALTY, FLAG_PENALTY, FOUND_MIN, PARTIAL_MIN, SHORT_DESCRIPTION = 5, 8, 10, 80, 60, 30
# Review flags in the order in which they are raised; two more are known but never raised.
FLAGS = (
    "score_below_threshold",
    "missing_critical_field",
    "description_too_short",
    "suspicious_ceo_value",
    "suspicious_founder_value",
    "name_domain_mismatch",
)
UNUSED_FLAGS = ("duplicate_detected", "stale_data")


def _clamp(c: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(100), c))


def _count(fields) -> Column:
    return reduce(lambda a, b: a + b, [present(F.col(f)).cast("int") for f in fields])


def infer_source(source: Column, website: Column, description: Column) -> Column:
    """Source label of a free source_used text; the first test that holds wins."""
    s = F.lower(F.coalesce(source, F.lit("")))
    return (
        F.when(s.rlike("official|website"), "official_website")
        .when(s.contains("linkedin"), "linkedin")
        .when(s.rlike("clearbit|wikipedia|crunchbase|database"), "public_database")
        .when(s.rlike("llm|gpt|openai"), "llm_inferred")
        .when(s.contains("scrape"), "web_scrape")
        .when(present(website) | present(description), "web_scrape")
        .otherwise("not_found")
    )


def base_score(label: Column) -> Column:
    out = F.lit(0)
    for name, score in BASE_SCORES.items():
        out = F.when(label == name, score).otherwise(out)
    return out


def score_for_source(label: str) -> int:
    """Base score of one label; 0 for an unknown one."""
    return BASE_SCORES.get(label, 0)


def quick_status(score: int, all_critical: bool) -> str:
    """Status of a score without any flags."""
    if score >= FOUND_MIN and all_critical:
        return "FOUND"
    return "PARTIALLY_FOUND" if score >= PARTIAL_MIN else "NOT_FOUND"


def completeness_bonus() -> Column:
    # ninths never end in a half, so the direction of rounding doesn't matter
    return F.round(_count(OPTIONAL_FIELDS) * BONUS_MAX / len(OPTIONAL_FIELDS)).cast("int")


def raw_score() -> Column:
    base = base_score(infer_source(F.col("source_used"), F.col("website"), F.col("description")))
    missing = len(CRITICAL_FIELDS) - _count(CRITICAL_FIELDS)
    return _clamp(base + completeness_bonus() - missing * CRITICAL_PENALTY).cast("int")


def suspicious_person(c: Column) -> Column:
    v = strip(c)
    bad = v.rlike(r"(?U)^[\d\s\-+().]+$") | F.lower(v).contains("http") | v.contains("@") | (F.length(v) < 3)
    return F.coalesce((v != "") & bad, F.lit(False))


def _letters(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def name_word(name: Column) -> Column:
    return _letters(F.split(strip(name), r"(?U)\s+")[0])


def domain_root(domain: Column) -> Column:
    return _letters(F.substring_index(F.lower(domain), ".", 1))


def name_domain_clash(name: Column, domain: Column) -> Column:
    """The name's first word (four letters or more) and the domain's first label don't contain each other."""
    w, r = name_word(name), domain_root(domain)
    there = present(name) & present(domain)
    return F.coalesce(there & (F.length(w) >= 4) & ~r.contains(w) & ~w.contains(r), F.lit(False))


def review_flags(raw: Column, settings: Settings) -> Column:
    d = F.length(clean_str(F.col("description")))
    tests = (
        raw < settings.min_confidence,
        _count(CRITICAL_FIELDS) < len(CRITICAL_FIELDS),
        F.coalesce(d < SHORT_DESCRIPTION, F.lit(False)),
        suspicious_person(F.col("ceo")),
        suspicious_person(F.col("founder")),
        name_domain_clash(F.col("name"), F.col("website")),
    )
    return F.array_compact(F.array(*[F.when(t, f) for t, f in zip(tests, FLAGS)]))


def status_label(score: Column, n_critical: Column, needs_review: Column, settings: Settings) -> Column:
    return (
        F.when(needs_review, "NEEDS_REVIEW")
        .when((score >= FOUND_MIN) & (n_critical == len(CRITICAL_FIELDS)), "FOUND")
        .when((score >= settings.partial_min) & (n_critical >= 1), "PARTIALLY_FOUND")
        .otherwise("NOT_FOUND")
    )


def score_dataframe(df: DataFrame, settings: Settings | None = None) -> DataFrame:
    """df with confidence_score (int), status and _review_flags replaced by what the record shows."""
    s = settings or Settings()
    x = df.withColumn("_raw", raw_score())
    x = x.withColumn("_flags", review_flags(F.col("_raw"), s))
    x = x.withColumn("confidence_score", _clamp(F.col("_raw") - FLAG_PENALTY * F.size("_flags")).cast("int"))
    other = F.size(F.array_except("_flags", F.array(F.lit("missing_critical_field")))) > 0
    x = x.withColumn("status", status_label(F.col("confidence_score"), _count(CRITICAL_FIELDS), other, s))
    return x.withColumn("_review_flags", F.array_join("_flags", ", ")).drop("_raw", "_flags")


def score_record(spark, record: dict, settings: Settings | None = None) -> tuple[int, str, list[str]]:
    """Score of one record given as a dict."""
    from ledgerloom.schema import STANDARD_SCHEMA

    row = {f.name: (None if record.get(f.name) is None else str(record[f.name])) for f in STANDARD_SCHEMA}
    r = score_dataframe(spark.createDataFrame([row], STANDARD_SCHEMA), settings).first()
    return r["confidence_score"], r["status"], [f for f in r["_review_flags"].split(", ") if f]


def score_summary(df: DataFrame) -> DataFrame:
    """status, n, share of all rows, average_score."""
    # decimals add up to the same in any order of rows
    score = F.avg(F.col("confidence_score").try_cast("decimal(30,10)"))
    n = df.groupBy(F.coalesce("status", F.lit("NOT_FOUND")).alias("status")).agg(
        F.count(F.lit(1)).alias("n"), F.round(score, 2).cast("double").alias("average_score")
    )
    total = n.agg(F.sum("n").alias("total"))  # one row
    return n.join(F.broadcast(total)).select("status", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"), "average_score")
