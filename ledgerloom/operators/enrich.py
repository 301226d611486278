"""Enrichment: facts of pages and model answers fill the gaps of records, once per domain, never overwriting.

Pages and answers are tables (see sources.providers), so the plan stays lazy and repeatable. A domain's facts are joined
to its records by an equi join; a domain held by a third of all rows is one row on the other side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import text as X
from ledgerloom.functions.nulls import clean_str, strip
from ledgerloom.functions.tokens import token_budget
from ledgerloom.operators.score import score_dataframe
from ledgerloom.schema import Settings
from ledgerloom.sources.html import best_description

ANSWER_FIELDS = ("description", "industry", "company_size", "ceo", "founder")
ANSWER_SCHEMA = ", ".join(f"{c} string" for c in (*ANSWER_FIELDS, "confidence_score"))
PROMPT = (
    "Read the website text below and answer with one JSON object with the keys description, industry, company_size, ceo,"
    " founder and confidence_score. Use only what the text says; leave a key empty if it doesn't say it."
    "\n\nTEXT:\n{website_text}\n\nCOMPANY: {company_name}\n"
)


def prompt_text(about: Column, team: Column, home: Column, contact: Column, settings: Settings) -> Column:
    """Non-empty texts in the order about, team, home, contact, cut to the token budget; NULL if there is none.

    Tokens are those of the settings' vocabulary; without one, words.
    """
    parts = [F.nullif(strip(F.coalesce(c, F.lit(""))), F.lit("")) for c in (about, team, home, contact)]
    whole, most = F.concat_ws("\n\n", *parts), settings.max_prompt_tokens
    cut = token_budget(whole, most, settings.token_vocabulary) if settings.token_vocabulary else X.token_budget(whole, most)
    return F.nullif(cut, F.lit(""))


def render_prompt(text: Column, name: Column, template: str = PROMPT) -> Column:
    t = F.replace(F.lit(template), F.lit("{website_text}"), text)
    return F.replace(t, F.lit("{company_name}"), F.coalesce(name, F.lit("")))


def parse_answer(raw: Column) -> Column:
    """A model's JSON as a struct: trimmed texts ('' for missing), a size band or '', a score of 0 to 100."""
    j = F.from_json(raw, ANSWER_SCHEMA)
    text = {c: F.coalesce(strip(j[c]), F.lit("")) for c in ANSWER_FIELDS}
    text["company_size"] = F.when(text["company_size"].isin(*X.SIZE_BANDS), text["company_size"]).otherwise("")
    score = F.greatest(F.lit(0), F.least(F.lit(100), X.score_int(j["confidence_score"])))
    return F.struct(*[v.alias(c) for c, v in text.items()], score.alias("confidence_score"))


def answer_empty(a: Column) -> Column:
    out = F.lit(True)
    for c in ANSWER_FIELDS:
        out = out & (a[c] == "")
    return out


def best_url(website: Column, linkedin: Column) -> tuple[Column, Column]:
    """Where to look for a record's facts, and the label of that source."""
    w, p = clean_str(website), clean_str(linkedin)
    label = F.when(w.isNotNull(), "official_website").when(p.isNotNull(), "linkedin").otherwise("not_found")
    return F.coalesce(w, p), label


def merge_field(old: Column, new: Column) -> Column:
    return F.coalesce(clean_str(old), clean_str(new), old)


def append_source(old: Column, new: Column) -> Column:
    a, b = F.coalesce(clean_str(old), F.lit("")), F.coalesce(clean_str(new), F.lit(""))
    return F.when((b == "") | ((a != "") & (F.instr(a, b) > 0)), F.nullif(a, F.lit(""))).when(a == "", b).otherwise(
        F.concat(a, F.lit(","), b)
    )


def payload(pages: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """Facts per domain from extracted pages (see sources.html) and answers (domain, answer); one row per domain."""
    x = pages.withColumn("domain", X.cache_domain(F.col("url"))).dropDuplicates(["domain"])
    if answers is not None:
        x = x.join(answers.dropDuplicates(["domain"]), "domain", "left")
    else:
        x = x.withColumn("answer", F.lit(None).cast("string"))
    x = x.withColumn("_a", parse_answer(F.coalesce("answer", F.lit("{}"))))
    a = F.col("_a")
    best = best_description(F.struct("og_description", "meta_description", "title"))
    some = lambda c: F.nullif(c, F.lit(""))
    empty = answer_empty(a)
    from_page = (a["description"] == "") & (best != "")
    return x.select(
        "domain",
        F.coalesce(some(a["description"]), some(best)).alias("description"),
        some(a["industry"]).alias("industry"),
        some(a["company_size"]).alias("size"),
        some(a["ceo"]).alias("ceo"),
        some(a["founder"]).alias("founder"),
        *[some(F.col(f"{c}_found")).alias(c) for c in ("linkedin", "facebook", "twitter", "instagram")],
        F.try_element_at("emails_found", F.lit(1)).alias("email"),
        F.try_element_at("phones_found", F.lit(1)).alias("phone"),
        F.when(from_page, ",web_scrape").when(~empty, ",llm_inferred").otherwise("").alias("_tag"),
        F.col("parse_error").alias(FAILED) if "parse_error" in pages.columns else F.lit(None).cast("string").alias(FAILED),
    )


FILLED = ("description", "industry", "size", "ceo", "founder", "linkedin", "facebook", "twitter", "instagram", "email", "phone")
FAILED = "_failure"


def fill(df: DataFrame, facts: DataFrame) -> DataFrame:
    """df with gaps filled from the facts of its domain and the source label appended."""
    url, label = best_url(F.col("website"), F.col("linkedin"))
    x = df.withColumns({"_domain": X.cache_domain(url), "_label": label})
    more = [c for c in ("_cached",) if c in facts.columns]
    f = facts.select(
        F.col("domain").alias("_domain"), F.struct(*[c for c in facts.columns if c != "domain"]).alias("_f")
    )
    x = x.join(f, "_domain", "left")
    new = {c: merge_field(F.col(c), F.col(f"_f.{c}")) for c in FILLED}
    tag = F.concat(F.col("_label"), F.coalesce(F.col("_f._tag"), F.lit("")))
    new["source_used"] = append_source(F.col("source_used"), tag)
    new |= {c: F.col(f"_f.{c}") for c in (FAILED, *more)}
    return x.withColumns(new).drop("_domain", "_label", "_f")


def follow_redirects(df: DataFrame, pages: DataFrame, settings: Settings) -> DataFrame:
    """Website replaced by where its page was found after a redirect: its host, or the full address if strict."""
    moved = pages.filter("redirect_count > 0 AND final_url IS NOT NULL").select(
        X.cache_domain(F.col("url")).alias("_domain"), "final_url"
    )
    moved = moved.dropDuplicates(["_domain"])
    x = df.withColumn("_domain", X.cache_domain(F.col("website"))).join(moved, "_domain", "left")
    to = F.col("final_url") if settings.strict_redirect else F.nullif(X.norm_domain(F.col("final_url")), F.lit(""))
    return x.withColumn("website", F.coalesce(to, "website")).drop("_domain", "final_url")


def split_done(df: DataFrame, skip_found: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows to skip, rows to work on)."""
    done = F.coalesce(strip(F.col("status")) == "FOUND", F.lit(False)) if skip_found else F.lit(False)
    return df.filter(done), df.filter(~done)


def domains_to_fetch(df: DataFrame, facts: DataFrame, ttl_days: int = 7) -> DataFrame:
    """Distinct domains without facts that are fresh enough (facts: domain, fetched_at)."""
    url, _ = best_url(F.col("website"), F.col("linkedin"))
    fresh = facts.filter(F.col("fetched_at") > F.current_timestamp() - F.expr(f"INTERVAL {ttl_days} DAYS"))
    wanted = df.select(X.cache_domain(url).alias("domain")).filter("domain IS NOT NULL").distinct()
    return wanted.join(fresh.select("domain"), "domain", "left_anti")


def enrich(df: DataFrame, pages: DataFrame, answers: DataFrame | None = None, settings: Settings | None = None) -> DataFrame:
    """Rows already found first and unchanged, then the others filled, scored and stamped.

    A record whose facts couldn't be worked out keeps its fields, with the reason in `_failure`, NOT_FOUND and 0. With
    `score_cached` off, records whose facts were known before this run (`cached` in `pages`) keep their score and status.
    """
    s = settings or Settings()
    done, todo = split_done(df, s.skip_found)
    facts = payload(pages, answers)
    if not s.score_cached and "cached" in pages.columns:
        known = pages.filter("cached").select(X.cache_domain(F.col("url")).alias("domain")).distinct().withColumn("_cached", F.lit(True))
        facts = facts.join(known, "domain", "left")
    work = fill(follow_redirects(todo, pages, s) if "redirect_count" in pages.columns else todo, facts)
    old = {c: F.col(c).alias(f"_old_{c}") for c in ("confidence_score", "status")}
    work = score_dataframe(work.select("*", *old.values()), s).withColumn("last_updated", X.now_iso())
    failed, kept = F.col(FAILED).isNotNull(), F.coalesce(F.col("_cached"), F.lit(False)) if "_cached" in facts.columns else F.lit(False)
    score, status = F.col("confidence_score").cast("string"), F.col("status")
    work = work.withColumns(
        {
            "confidence_score": F.when(failed, "0").when(kept, F.col("_old_confidence_score")).otherwise(score),
            "status": F.when(failed, "NOT_FOUND").when(kept, F.col("_old_status")).otherwise(status),
        }
    ).drop("_cached", *[f"_old_{c}" for c in old])
    return done.withColumn("_skipped", F.lit(True)).unionByName(work.withColumn("_skipped", F.lit(False)), allowMissingColumns=True)


def enrichment_stats(enriched: DataFrame) -> DataFrame:
    """One row of what `enrich` did: processed, succeeded, failed, skipped."""
    failed, skipped = F.col(FAILED).isNotNull(), F.col("_skipped")
    return enriched.agg(
        F.count_if(~skipped).alias("processed"),
        F.count_if(~skipped & ~failed).alias("succeeded"),
        F.count_if(~skipped & failed).alias("failed"),
        F.count_if(skipped).alias("skipped"),
    )
