"""Record rules and the aggregate report.

`validate` gives every row with invalid fields set to NULL and two arrays of codes; `report` is one aggregation over it.
Duplicates are found on the values before they are set to NULL. NULL websites and names are duplicates of nothing.
"""

from __future__ import annotations

import json
import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import text as X
from ledgerloom.functions.nulls import clean_str, present
from ledgerloom.functions.similarity import partial_ratio_udf, similar_pairs, sorted_words
from ledgerloom.operators.clean import ORD, with_order
from ledgerloom.operators.score import SHORT_DESCRIPTION, domain_root, name_word
from ledgerloom.runtime import cut, discard, write_text
from ledgerloom.schema import COMPLETENESS_FIELDS, CRITICAL_FIELDS, STATUSES, Settings

log = logging.getLogger(__name__)
URL_FIELDS = ("linkedin", "facebook", "twitter", "instagram")
CHECKED = ("email", "phone", *URL_FIELDS, "ceo", "founder", "size")  # set to NULL where invalid
NAME_MATCH_MIN = 60


def name_domain_match(name: Column, domain: Column) -> Column:
    """True where the name's first word and the domain's first label resemble each other, or too little is there to tell."""
    w, r = name_word(name), domain_root(domain)
    unknown = name.isNull() | domain.isNull() | (F.length(w) < 4) | (F.length(r) < 3)
    inside = r.contains(w) | w.contains(r)
    # the costly score is asked only where containment fails: its inputs are NULL elsewhere
    ask = ~unknown & ~inside
    score = partial_ratio_udf(F.when(ask, w), F.when(ask, r))
    return F.coalesce(unknown | inside | (score >= NAME_MATCH_MIN), F.lit(True))


def duplicate_domains(df: DataFrame) -> DataFrame:
    """domain, n of websites held by more than one row (any case)."""
    d = F.lower(clean_str(F.col("website")))
    return df.select(d.alias("domain")).filter("domain IS NOT NULL").groupBy("domain").agg(
        F.count(F.lit(1)).alias("n")
    ).filter("n > 1")


def duplicate_names(df: DataFrame, threshold: float = 92) -> DataFrame:
    """row, leader: greedy duplicates in row order. A row not yet flagged leads; later unflagged rows like it are flagged.

    Equal names follow their first row, so the greedy order only has to be settled among distinct names. That is done in
    rounds over all of them: names without an earlier open neighbour lead, their later neighbours follow, and both leave.
    """
    key = sorted_words(clean_str(F.col("name")))
    rows = df.select(F.col(ORD).alias("i"), key.alias("key")).filter(F.length("key") >= 3)
    names = cut(rows.groupBy("key").agg(F.min("i").alias("first")))
    pairs = similar_pairs(names, threshold)
    a = names.select(F.col("key").alias("left"), F.col("first").alias("a"))
    b = names.select(F.col("key").alias("right"), F.col("first").alias("b"))
    edges = cut(
        pairs.join(a.hint("merge"), "left").join(b.hint("merge"), "right").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )
    led = first_leaders(edges).withColumnsRenamed({"node": "first"})
    named = names.join(led.hint("merge"), "first", "left")
    return (
        rows.join(named.hint("merge"), "key")
        .select(F.col("i").alias("row"), F.coalesce("leader", "first").alias("leader"))
        .filter("row != leader")
    )


def first_leaders(edges: DataFrame) -> DataFrame:
    """node, leader of all nodes that follow. edges: a < b. In the order of nodes each one that doesn't follow yet leads, and
    its later neighbours that don't follow yet follow it. Every round settles at least the first open node of a component.
    """
    out = edges.select(F.col("b").alias("node"), F.col("a").alias("leader")).limit(0)
    while not edges.isEmpty():
        leads = edges.select("a").join(edges.select(F.col("b").alias("a")).hint("merge"), "a", "left_anti").distinct()
        new = cut(edges.join(leads.hint("merge"), "a").groupBy(F.col("b").alias("node")).agg(F.min("a").alias("leader")))
        out = out.unionByName(new)
        gone = new.select("node").unionByName(leads.select(F.col("a").alias("node")))
        rest = edges
        for end in ("a", "b"):
            rest = rest.join(gone.select(F.col("node").alias(end)).hint("merge"), end, "left_anti")
        before, edges = edges, cut(rest)
        discard(before)
    return out


def validate(df: DataFrame, settings: Settings | None = None) -> DataFrame:
    """df with invalid fields as NULL, `_issues` and `_warnings` (arrays of codes in rule order)."""
    s = settings or Settings()
    x = with_order(df)
    dup = duplicate_domains(x).select(F.col("domain").alias("_domain"), F.lit(True).alias("_dup"))
    x = x.withColumn("_domain", F.lower(clean_str(F.col("website")))).join(dup, "_domain", "left")
    # in stages: cleaned values, then rules, then arrays, so that no expression is written out more than once
    texts = [*CRITICAL_FIELDS, "email", "phone", *URL_FIELDS, "ceo", "founder", "size", "status"]
    x = x.withColumn("_v", F.struct(*[clean_str(F.col(c)).alias(c) for c in dict.fromkeys(texts)]))
    x = x.withColumn("_match", name_domain_match(F.col("_v.name"), F.col("_v.website")))
    v = {c: F.col(f"_v.{c}") for c in texts}
    bad = {
        "email": ~X.is_email(v["email"]),
        "phone": ~X.phone_ok(v["phone"]),
        **{c: ~X.url_ok(v[c]) for c in URL_FIELDS},
        "ceo": ~X.person_ok(v["ceo"]),
        "founder": ~X.founders_ok(v["founder"]),
        "size": ~v["size"].isin(*X.SIZE_BANDS),
    }
    x = x.withColumn("_bad", F.struct(*[F.coalesce(t, F.lit(False)).alias(c) for c, t in bad.items()]))
    bad = {c: F.col(f"_bad.{c}") for c in bad}
    score = X.score_int(F.col("confidence_score").cast("string"))
    warn = [
        (F.length(v["description"]) < SHORT_DESCRIPTION, "DESCRIPTION_TOO_SHORT"),
        (bad["email"], "INVALID_EMAIL"),
        (bad["phone"], "INVALID_PHONE"),
        *[(bad[c], "INVALID_URL") for c in URL_FIELDS],
        (bad["ceo"], "INVALID_CEO"),
        (bad["founder"], "INVALID_FOUNDER"),
        (~F.col("_match"), "NAME_DOMAIN_MISMATCH"),
        (score < s.min_confidence, "LOW_CONFIDENCE_SCORE"),
        (v["status"] == "NOT_FOUND", "STATUS_NOT_FOUND"),
        (v["status"] == "NEEDS_REVIEW", "STATUS_NEEDS_REVIEW"),
        (F.col("_dup"), "DUPLICATE_DOMAIN"),
    ]
    errors = [F.when(v[c].isNull(), f"MISSING_{c.upper()}") for c in CRITICAL_FIELDS]
    x = x.withColumns(
        {
            "_issues": F.array_compact(F.array(*errors)),
            "_warnings": F.array_compact(F.array(*[F.when(t, c) for t, c in warn])),
        }
    )
    return x.withColumns({c: F.when(~t, F.col(c)) for c, t in bad.items()}).drop("_domain", "_dup", "_match", "_v", "_bad")


def issue_counts(validated: DataFrame) -> DataFrame:
    """code, n over issues and warnings; a code counts as often as it is raised."""
    codes = validated.select(F.explode(F.concat("_issues", "_warnings")).alias("code"))
    return codes.groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def counters(validated: DataFrame) -> DataFrame:
    """One row of the report's counters."""
    score = F.col("confidence_score").cast("string").try_cast("double")
    status = F.coalesce(clean_str(F.col("status")), F.lit("NOT_FOUND"))
    valid = F.size("_issues") == 0
    return validated.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(valid).alias("valid"),
        F.count_if(~valid).alias("invalid"),
        F.coalesce(F.sum(F.size("_warnings")), F.lit(0)).alias("warnings"),
        *[F.count_if(status == s).alias(f"status_{s.lower()}") for s in STATUSES],
        *[F.count_if(present(F.col(c))).alias(f"filled_{c}") for c in COMPLETENESS_FIELDS],
        F.count_if(~present(F.col("ceo"))).alias("missing_ceo"),
        F.count_if(~present(F.col("founder"))).alias("missing_founder"),
        # decimals add up to the same in any order of rows
        F.coalesce(F.round(F.avg(score.try_cast("decimal(30,10)")), 2).cast("double"), F.lit(0.0)).alias("average_score"),
        F.coalesce(F.min(score).try_cast("int"), F.lit(0)).alias("min_score"),
        F.coalesce(F.max(score).try_cast("int"), F.lit(0)).alias("max_score"),
    )


def findings(validated: DataFrame) -> DataFrame:
    """Rows with an issue or a warning, compact."""
    return validated.filter(F.size("_issues") + F.size("_warnings") > 0).select(
        ORD, "company_id", "name", (F.size("_issues") == 0).alias("is_valid"), F.col("_issues").alias("errors"),
        F.col("_warnings").alias("warnings"),
    )


def report(df: DataFrame, settings: Settings | None = None) -> tuple[DataFrame, DataFrame]:
    """The validated rows and one row of counters with duplicates and code counts. Rows with findings: `findings`."""
    s = settings or Settings()
    x = with_order(df)
    validated = validate(x, s)
    dups = duplicate_domains(x).agg(F.count(F.lit(1)).alias("duplicate_domains"))
    names = duplicate_names(x, s.validation_threshold).agg(F.count(F.lit(1)).alias("duplicate_names"))
    entries = F.collect_list(F.struct("code", "n"))  # one entry per code of the rule set
    codes = issue_counts(validated).agg(F.map_from_entries(F.array_sort(entries)).alias("issue_counts"))
    one = counters(validated)
    for side in (dups, names, codes):
        one = one.join(F.broadcast(side))  # one row each
    return validated, one.withColumn("duplicates_removed", F.col("duplicate_domains") + F.col("duplicate_names"))


def save_report(one: DataFrame, rows: DataFrame, path: str) -> str:
    """The report as JSON: counters from the driver (one row), rows with findings written line by line beside it."""
    data = one.withColumn("generated_at", X.now_iso()).first().asDict(recursive=True)
    write_text(one.sparkSession, path, json.dumps(data, indent=2, ensure_ascii=False))
    rows.write.mode("overwrite").json(f"{path}.records")
    return path


def log_summary(one: DataFrame) -> None:
    """The report's counters as log lines, in groups: totals, states, duplicates, scores, completeness."""
    r = one.first().asDict(recursive=True)
    groups = (
        ("total", "valid", "invalid", "warnings"),
        tuple(f"status_{s.lower()}" for s in STATUSES),
        ("duplicate_domains", "duplicate_names", "duplicates_removed"),
        ("average_score", "min_score", "max_score"),
        tuple(f"filled_{c}" for c in COMPLETENESS_FIELDS),
    )
    for names in groups:
        for name in names:
            log.info("%s: %s", name.replace("_", " "), r.get(name))
        log.info("-" * 40)


def top_issues(validated: DataFrame, most: int = 10) -> DataFrame:
    return issue_counts(validated).orderBy(F.desc("n"), "code").limit(most)
