"""Queries of the company-record operators over the provided tables, and their SQL.

`companies_raw` is a view derived from `customer` by arithmetic only, in text that both engines run: groups of three
spellings of a name, legal, illegal and missing values of every field in fixed cycles.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions import text as X
from ledgerloom.functions.nulls import NA_WORDS, SPACES, clean_str, safe_str, strip
from ledgerloom.functions.similarity import partial_ratio_udf, similar_pairs, sorted_words
from ledgerloom.operators import clean, enrich, score, validate
from ledgerloom.operators.clean import ORD
from ledgerloom.runtime import cut, shared_dir, table
from ledgerloom.schema import COMPLETENESS_FIELDS, STANDARD_COLUMNS, STATUSES, Settings
from ledgerloom.sources.export import column_profile, export_csv, read_checkpoint
from ledgerloom.sources.html import ABOUT_PATHS, extract_pages, scrape_state, sub_page_text

RAW = """
SELECT k AS rid,
  CASE WHEN k % 37 = 0 THEN CASE WHEN k % 2 = 0 THEN 'N/A' END
       WHEN k % 3 = 0 THEN w || ' inc'
       WHEN k % 3 = 1 THEN '  ' || upper(w) || '   Inc. '
       ELSE substr(w, 1, 2) || substr(w, 4) || ' Inc' END AS name,
  CASE WHEN k % 41 = 0 THEN 'zzzzz.org'
       ELSE CASE k % 5 WHEN 0 THEN 'https://www.' || w || '.com/about?x=1' WHEN 1 THEN 'http://www2.' || upper(w) || '.com/'
            WHEN 2 THEN w || '.com#t' WHEN 3 THEN 'info@' || w || '.com' END END AS website,
  CASE k % 4 WHEN 0 THEN 'https://www.linkedin.com/company/' || w || '/' WHEN 1 THEN 'uk.linkedin.com/in/' || w
       WHEN 2 THEN 'https://facebook.com/' || w ELSE '-' END AS linkedin,
  CASE k % 4 WHEN 0 THEN 'Makes tools and parts for small workshops in ' || seg WHEN 1 THEN 'Too short' WHEN 3 THEN 'nan' END
       AS description,
  CASE WHEN k % 6 <> 0 THEN seg END AS industry,
  CASE k % 4 WHEN 0 THEN '11-50' WHEN 1 THEN '2025 99.999' WHEN 3 THEN '10000+' END AS size,
  CASE k % 4 WHEN 0 THEN 'Info@' || w || '.com' WHEN 1 THEN 'info at ' || w WHEN 2 THEN ' ' ELSE 'a@b' END AS email,
  CASE k % 4 WHEN 0 THEN '+1 (555) 123-4567' WHEN 1 THEN 'Call: 44.20.7946.0958' WHEN 2 THEN '12' END AS phone,
  CASE k % 3 WHEN 0 THEN 'https://www.facebook.com/' || w || '?ref=x' WHEN 1 THEN 'n/a' END AS facebook,
  CASE k % 3 WHEN 0 THEN 'x.com/' || w WHEN 1 THEN 'http://twitter.com/' || w || '/status' END AS twitter,
  CASE k % 3 WHEN 0 THEN 'instagram.com/' || w WHEN 1 THEN w END AS instagram,
  CASE k % 5 WHEN 0 THEN 'Jane Smith' WHEN 1 THEN '12345678' WHEN 2 THEN 'https://x.com' WHEN 3 THEN 'Jo' END AS ceo,
  CASE k % 5 WHEN 0 THEN 'Jane Smith, John Doe' WHEN 1 THEN 'Jane Smith, 42' WHEN 2 THEN 'a@b.c' WHEN 3 THEN '-' END AS founder,
  CASE k % 7 WHEN 0 THEN 'official_website' WHEN 1 THEN 'LinkedIn' WHEN 2 THEN 'crunchbase' WHEN 3 THEN 'llm_inferred'
       WHEN 4 THEN 'web_scrape' WHEN 5 THEN 'weak' END AS source_used,
  CASE k % 6 WHEN 0 THEN '85' WHEN 1 THEN '12.7' WHEN 2 THEN 'abc' WHEN 4 THEN '100' WHEN 5 THEN '0' END AS confidence_score,
  CASE k % 5 WHEN 0 THEN 'FOUND' WHEN 1 THEN 'NOT_FOUND' WHEN 3 THEN 'NEEDS_REVIEW' WHEN 4 THEN 'PARTIALLY_FOUND' END AS status
FROM (SELECT k, seg, substr(md5(cast(k - k % 3 AS string)), 1, 12) AS w
      FROM (SELECT cast(c_custkey AS bigint) AS k, c_mktsegment AS seg FROM {customer}) t) u
"""
FIELDS = tuple(c for c in STANDARD_COLUMNS if c not in ("company_id", "company_name", "last_updated"))


def raw(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(RAW, customer=table(spark, d, "customer"))


def records(spark: SparkSession, d: str) -> DataFrame:
    """companies_raw as standard records with their row order."""
    x = raw(spark, d).withColumnRenamed("rid", ORD)
    x = x.withColumns({"company_id": X.company_id(F.col("name"), F.col("website"))})
    x = x.withColumns({c: F.lit(None).cast("string") for c in ("company_name", "last_updated")})
    return x.select(*STANDARD_COLUMNS, ORD)


def cleaned(spark: SparkSession, d: str) -> DataFrame:
    return clean.normalise(clean.coerce_and_trim(records(spark, d)))


def _each(fields, f) -> dict[str, Column]:
    return {c: f(F.col(c)) for c in fields}


# ---- SQL building blocks (DuckDB) ----
_RAW = RAW.replace("{customer}", "customer")
_NA = ", ".join(f"'{w}'" for w in NA_WORDS)


def _na(x: str) -> str:
    return f"CASE WHEN trim({x}) <> '' AND lower(trim({x})) NOT IN ({_NA}) THEN trim({x}) END"


_EMAIL = r"'^[^\s@]+@[^\s@]+\.[^\s@]+$'"
_PERSON = (
    "(length({0}) >= 2 AND NOT contains({0}, '@') AND NOT contains(lower({0}), 'http')"
    r" AND NOT regexp_matches({0}, '^[\d\s\-+().]+$') AND regexp_matches({0}, '^[A-Za-z\s\-.'']{{2,80}}$'))"
)


def _title(x: str) -> str:
    runs = f"list_transform(regexp_extract_all({x}, '([a-zA-Z]+|[^a-zA-Z]+)'), lambda r: upper(r[1]) || lower(r[2:]))"
    keep = f"length({x}) > 1 AND {x} = upper({x}) AND {x} <> lower({x})"
    return f"CASE WHEN {keep} THEN {x} ELSE array_to_string({runs}, '') END"


def _name(x: str) -> str:
    t = rf"regexp_replace(trim({x}), '\s+', ' ', 'g')"
    for form, spelt in X.LEGAL_FORMS:
        t = rf"regexp_replace({t}, '(?i)\b{form}\b\.?', '{spelt}', 'g')"
    return f"array_to_string(list_transform(string_split({t}, ' '), lambda v: {_title('v')}), ' ')"


def domain_sql(x: str) -> str:
    host = rf"regexp_replace(regexp_replace(trim({x}), '(?i)^(?:https?://)?(?:www\d?\.)?', ''), '[/?#].*$', '')"
    start = r"'(?i)^(?:https?://)?(?:www\.)?[a-z0-9\-]+(?:\.[a-z0-9\-]+)+'"
    bad = rf"regexp_matches(trim({x}), {_EMAIL}) OR NOT regexp_matches(trim({x}), {start})"
    bad += rf""" OR regexp_matches({host}, '[\s,;|"''<>()]')"""
    return f"CASE WHEN {x} IS NOT NULL THEN CASE WHEN {bad} THEN '' ELSE lower({host}) END END"


def _slug(x: str, pattern: str, prefix: str) -> str:
    got = f"regexp_extract({x}, '(?i){pattern}', 1)"
    return f"CASE WHEN {x} IS NOT NULL THEN CASE WHEN {got} <> '' THEN '{prefix}' || {got} ELSE '' END END"


def _linkedin(x: str) -> str:
    return _slug(x, r"linkedin\.com/(?:company|in|school)/([^/?#\s]+)", "https://www.linkedin.com/company/")


def _social(x: str, p: str) -> str:
    return _slug(x, X.SOCIAL_HOSTS[p] + r"/([^/?#\s]+)", f"https://www.{p}.com/")


def _mail(x: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN CASE WHEN regexp_matches(trim({x}), {_EMAIL}) THEN lower(trim({x})) ELSE '' END END"


def _phone(x: str) -> str:
    kept = rf"trim(regexp_replace({x}, '[^\d+\-()\s]', '', 'g'))"
    n = rf"length(regexp_replace({x}, '\D', '', 'g'))"
    return f"CASE WHEN {x} IS NOT NULL THEN CASE WHEN {n} >= 7 THEN {kept} ELSE '' END END"


_NORM = {
    "name": _name,
    "website": domain_sql,
    "linkedin": _linkedin,
    "email": _mail,
    "phone": _phone,
    **{p: (lambda x, p=p: _social(x, p)) for p in X.SOCIAL_HOSTS},
}
_TRIMMED = f"(SELECT rid, {', '.join(f'{_na(c)} AS {c}' for c in FIELDS)} FROM ({_RAW}) r)"
_CLEAN = (
    "(SELECT rid, "
    + ", ".join(f"nullif({_NORM[c](c)}, '') AS {c}" if c in _NORM else c for c in FIELDS)
    + f" FROM {_TRIMMED} t)"
)
_ID_KEY = "md5(lower(trim(coalesce(name, ''))) || '|' || lower(trim(coalesce(website, ''))))"
_ID = "||'-'||".join(f"substr({_ID_KEY}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
# company_id is always there, company_name and last_updated never
_FILLED = " + ".join(f"({c} IS NOT NULL)::int" for c in FIELDS) + " + 1"

def _lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence: each letter of a turns a row of the table into the next."""
    return (
        f"list_reduce(string_split({a}, ''), lambda line, ch: list_reduce(range(1, length({b}) + 1), lambda acc, j: list_append(acc,"
        f" greatest(line[j + 1], acc[-1], line[j] + (substr({b}, j, 1) = ch)::int)), [0::int]),"
        f" list_transform(range(0, length({b}) + 1), lambda z: 0::int))[-1]"
    )


def _partial(a: str, b: str) -> str:
    """Best score of a against the windows of its length in b, the longer text, and shorter ends of b."""
    windows = (
        f"list_concat(list_transform(range(1, length({b}) - length({a}) + 2), lambda i: substr({b}, i, length({a}))),"
        f" list_transform(range(1, length({a})), lambda i: substr({b}, 1, i)), list_transform(range(1, length({a})), lambda i: right({b}, i)))"
    )
    return f"list_max(list_transform({windows}, lambda v: 200.0 * {_lcs(a, 'v')} / (length({a}) + length(v))))"


# columns of a cleaned record that the view leaves out
_MORE = f"(SELECT rid, {_ID} AS company_id, NULL::varchar AS company_name, NULL::varchar AS last_updated FROM ({_RAW}) r)"


def _merged_sql(by: str, rows: str) -> str:
    """One row per group: of every column the first value in order of score, filled columns and arrival."""
    order = f"row(coalesce(try_cast(confidence_score AS double), -1e300), {_FILLED}, -rid)"
    columns = [c for c in STANDARD_COLUMNS if c != "confidence_score"]
    kept = ", ".join(f"arg_max({c}, {order}) FILTER ({c} IS NOT NULL) AS {c}" for c in columns)
    score_sql = (
        "CASE WHEN count(*) = 1 THEN max(confidence_score) ELSE coalesce(cast(cast(trunc(max(try_cast(confidence_score AS double))) AS int)"
        f" AS varchar), arg_max(confidence_score, {order}) FILTER (confidence_score IS NOT NULL)) END AS confidence_score"
    )
    return f"SELECT min(rid) AS {ORD}, {kept}, {score_sql} FROM {rows} GROUP BY {by}"


# rows that exact deduplication keeps
_KEPT = f"""(SELECT * EXCLUDE n FROM (SELECT *, row_number() OVER (PARTITION BY name, website, linkedin ORDER BY {_FILLED} DESC, rid) AS n
    FROM {_CLEAN} c) x WHERE n = 1)"""

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query(f"SELECT rid, {', '.join(f'{_na(c)} AS {c}' for c in FIELDS)} FROM ({_RAW}) r")
def clean_fields(spark, d):
    return raw(spark, d).select("rid", *[clean_str(F.col(c)).alias(c) for c in FIELDS])


@query(f"SELECT rid, coalesce({_na('ceo')}, '?') AS ceo FROM ({_RAW}) r")
def safe_text(spark, d):
    return raw(spark, d).select("rid", safe_str(F.col("ceo"), "?").alias("ceo"))


@query(f"SELECT rid, {_name('name')} AS name FROM ({_RAW}) r")
def norm_name(spark, d):
    return raw(spark, d).select("rid", X.norm_name(F.col("name")).alias("name"))


@query(f"SELECT rid, {domain_sql('website')} AS website FROM ({_RAW}) r")
def norm_domain(spark, d):
    return raw(spark, d).select("rid", X.norm_domain(F.col("website")).alias("website"))


@query(f"SELECT rid, {_linkedin('linkedin')} AS linkedin FROM ({_RAW}) r")
def norm_linkedin(spark, d):
    return raw(spark, d).select("rid", X.norm_linkedin(F.col("linkedin")).alias("linkedin"))


@query(f"SELECT rid, {', '.join(f'{_social(p, p)} AS {p}' for p in X.SOCIAL_HOSTS)} FROM ({_RAW}) r")
def norm_social(spark, d):
    return raw(spark, d).select("rid", *[X.norm_social(F.col(p), p).alias(p) for p in X.SOCIAL_HOSTS])


@query(f"SELECT rid, {_mail('email')} AS email, {_phone('phone')} AS phone FROM ({_RAW}) r")
def norm_contacts(spark, d):
    return raw(spark, d).select("rid", X.norm_email(F.col("email")).alias("email"), X.norm_phone(F.col("phone")).alias("phone"))


@query(
    "SELECT rid, CASE WHEN regexp_matches(trim(website), '(?i)^https?://') THEN trim(website) ELSE 'https://' || trim(website)"
    " END AS url, md5(lower(website)) AS cache_key,"
    " split_part(regexp_replace(regexp_replace(trim(lower(website)), '^https?://', ''), '^www\\.', ''), '/', 1) AS cache_domain"
    f" FROM ({_RAW}) r WHERE website IS NOT NULL"
)
def url_keys(spark, d):
    w = F.col("website")
    return raw(spark, d).filter("website IS NOT NULL").select(
        "rid", X.ensure_scheme(w).alias("url"), X.cache_key(w).alias("cache_key"), X.cache_domain(w).alias("cache_domain")
    )


@query(f"SELECT rid, {_ID} AS company_id FROM ({_RAW}) r")
def company_ids(spark, d):
    return raw(spark, d).select("rid", X.company_id(F.col("name"), F.col("website")).alias("company_id"))


@query(
    f"SELECT rid, CASE WHEN {_na('ceo')} IS NOT NULL THEN {_PERSON.format('trim(ceo)')} END AS ceo_ok,"
    f" regexp_matches(trim(email), {_EMAIL}) AS email_ok,"
    r" length(regexp_replace(phone, '\D', '', 'g')) BETWEEN 7 AND 15 AS phone_ok,"
    r" regexp_matches(trim(facebook), '^https?://[a-zA-Z0-9\-._~:/?#\[\]@!$&''()*+,;=%]+$') AS url_ok"
    f" FROM ({_RAW}) r"
)
def field_checks(spark, d):
    ceo = F.when(clean_str(F.col("ceo")).isNotNull(), X.person_ok(F.col("ceo")))
    return raw(spark, d).select(
        "rid",
        ceo.alias("ceo_ok"),
        X.is_email(F.col("email")).alias("email_ok"),
        X.phone_ok(F.col("phone")).alias("phone_ok"),
        X.url_ok(F.col("facebook")).alias("url_ok"),
    )


@query(
    f"SELECT rid FROM (SELECT rid, row_number() OVER (PARTITION BY name, website, linkedin ORDER BY {_FILLED} DESC, rid) AS n"
    f" FROM {_CLEAN} c) x WHERE n = 1"
)
def exact_dedup(spark, d):
    return clean.drop_exact_duplicates(cleaned(spark, d)).select(F.col(ORD).alias("rid"))


@query(f"SELECT rid, {_FILLED} AS n_filled FROM {_KEPT} k ORDER BY n_filled DESC, rid")
def output_order(spark, d):
    x = clean.in_output_order(clean.drop_exact_duplicates(cleaned(spark, d)))
    return x.select(F.col(ORD).alias("rid"), F.col("_filled").alias("n_filled"))


@query(
    f"SELECT rid, min(rid) OVER (PARTITION BY website) AS first_rid FROM {_CLEAN} c WHERE website IS NOT NULL"
)
def domain_clusters(spark, d):
    x = cleaned(spark, d).filter("website IS NOT NULL").select(F.col(ORD).alias("rid"), "website")
    first = x.groupBy("website").agg(F.min("rid").alias("first_rid"))
    return x.join(first, "website").select("rid", "first_rid")


@query(
    _merged_sql("website", f"(SELECT * FROM {_CLEAN} c JOIN {_MORE} i USING (rid) WHERE website IS NOT NULL) x").replace(f"min(rid) AS {ORD}, ", "")
)
def survivorship(spark, d):
    x = cut(cleaned(spark, d).filter("website IS NOT NULL"))
    first = x.groupBy("website").agg(F.min(ORD).alias("cluster"))
    return clean.merge_clusters(x.join(first, "website")).drop(ORD)


_KEY = "array_to_string(list_sort(list_filter(string_split(name, ' '), lambda w: w <> '')), ' ')"
def _similar_sql(rows: str, threshold: float, least: int = 1) -> str:
    """names: k, first; pairs: a, b, score of similar names. Edits are no more than letters that aren't common."""
    room = f"{1 - threshold / 100} * (length(x.k) + length(y.k)) + 1e-9"
    return f"""names AS (SELECT {_KEY} AS k, min(rid) AS first FROM {rows} c WHERE name IS NOT NULL GROUP BY ALL HAVING length(k) >= {least}),
    pairs AS (SELECT * FROM (SELECT a, b, fa, fb, 200.0 * {_lcs('a', 'b')} / (length(a) + length(b)) AS score FROM
      (SELECT x.k AS a, y.k AS b, x.first AS fa, y.first AS fb FROM names x JOIN names y ON x.k < y.k
        AND abs(length(x.k) - length(y.k)) <= {room} AND levenshtein(x.k, y.k) <= {room}) p) z WHERE score >= {threshold} - 1e-9)"""


@query(f'WITH {_similar_sql(_CLEAN, 90)} SELECT a AS "left", b AS "right", round(score, 4) AS score FROM pairs')
def similar_names(spark, d):
    names = cut(cleaned(spark, d).select(sorted_words(F.col("name")).alias("key")))
    return similar_pairs(names, 90).withColumn("score", F.round("score", 4))


_CLUSTERS = f"""kept AS MATERIALIZED {_KEPT}, {_similar_sql("kept", 90)},
    edges AS (SELECT fa AS i, fb AS j FROM pairs UNION SELECT rid, first FROM kept JOIN names ON {_KEY} = k
      UNION SELECT rid, min(rid) OVER (PARTITION BY website) FROM kept WHERE website IS NOT NULL),
    links AS MATERIALIZED (SELECT i, j FROM edges UNION SELECT j, i FROM edges),
    reach AS (SELECT rid AS i, rid AS top FROM kept UNION SELECT l.j, r.top FROM reach r JOIN links l ON l.i = r.i),
    clusters AS (SELECT i AS rid, min(top) AS cluster FROM reach GROUP BY i)"""


@query(f"WITH RECURSIVE {_CLUSTERS} SELECT rid, cluster FROM clusters")
def entity_clusters(spark, d):
    x = cut(clean.drop_exact_duplicates(cleaned(spark, d)))
    return clean.cluster(x).select(F.col(ORD).alias("rid"), "cluster")


@query(f"WITH RECURSIVE {_CLUSTERS} " + _merged_sql("cluster", f"kept JOIN clusters USING (rid) JOIN {_MORE} i USING (rid)"))
def clean_records(spark, d):
    return clean.clean(records(spark, d))


# ---- scores ----
_LABEL = (
    "CASE WHEN regexp_matches(s, 'official|website') THEN 'official_website' WHEN contains(s, 'linkedin') THEN 'linkedin'"
    " WHEN regexp_matches(s, 'clearbit|wikipedia|crunchbase|database') THEN 'public_database'"
    " WHEN regexp_matches(s, 'llm|gpt|openai') THEN 'llm_inferred' WHEN contains(s, 'scrape') THEN 'web_scrape'"
    " WHEN website IS NOT NULL OR description IS NOT NULL THEN 'web_scrape' ELSE 'not_found' END"
)
_BASE = "CASE label " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in score.BASE_SCORES.items()) + " END"
_OPT = "+".join(f"({c} IS NOT NULL)::int" for c in score.OPTIONAL_FIELDS)
_CRIT = "+".join(f"({c} IS NOT NULL)::int" for c in score.CRITICAL_FIELDS)
_ODD = r"(regexp_matches({0}, '^[\d\s\-+().]+$') OR contains(lower({0}), 'http') OR contains({0}, '@') OR length({0}) < 3)"
_WORD = r"regexp_replace(lower(split_part(name, ' ', 1)), '[^a-z0-9]', '', 'g')"
_ROOT = r"regexp_replace(lower(split_part(website, '.', 1)), '[^a-z0-9]', '', 'g')"
_SCORED = f"""(SELECT *, CASE WHEN len(list_filter(flags, lambda f: f <> 'missing_critical_field')) > 0 THEN 'NEEDS_REVIEW'
    WHEN score >= 80 AND crit = 4 THEN 'FOUND' WHEN score >= 60 AND crit >= 1 THEN 'PARTIALLY_FOUND' ELSE 'NOT_FOUND' END AS st
  FROM (SELECT *, greatest(0, least(100, raw - 10 * len(flags))) AS score
  FROM (SELECT *, list_filter([CASE WHEN raw < 30 THEN 'score_below_threshold' END,
      CASE WHEN crit < 4 THEN 'missing_critical_field' END,
      CASE WHEN length(description) < 30 THEN 'description_too_short' END,
      CASE WHEN {_ODD.format('ceo')} THEN 'suspicious_ceo_value' END,
      CASE WHEN {_ODD.format('founder')} THEN 'suspicious_founder_value' END,
      CASE WHEN length({_WORD}) >= 4 AND NOT contains({_ROOT}, {_WORD}) AND NOT contains({_WORD}, {_ROOT})
           THEN 'name_domain_mismatch' END], lambda f: f IS NOT NULL) AS flags
  FROM (SELECT *, greatest(0, least(100, {_BASE} + cast(round(5.0 * ({_OPT}) / 9) AS int) - 8 * (4 - crit))) AS raw
  FROM (SELECT *, {_LABEL} AS label, {_CRIT} AS crit FROM (SELECT *, lower(coalesce(source_used, '')) AS s FROM {_CLEAN} c)))))) z"""


@query(f"SELECT rid, label FROM {_SCORED.strip()}".replace("SELECT rid, label", "SELECT rid, label AS source_label"))
def infer_source(spark, d):
    label = score.infer_source(F.col("source_used"), F.col("website"), F.col("description"))
    return cleaned(spark, d).select(F.col(ORD).alias("rid"), label.alias("source_label"))


@query(
    f"SELECT rid, score AS confidence_score, st AS status, array_to_string(flags, ', ') AS review_flags FROM {_SCORED}"
)
def score_records(spark, d):
    x = score.score_dataframe(cleaned(spark, d))
    return x.select(F.col(ORD).alias("rid"), "confidence_score", "status", F.col("_review_flags").alias("review_flags"))


@query(
    "SELECT st AS status, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share, round(cast(avg(score) AS decimal(30, 10)), 2)::double AS average_score"
    f" FROM {_SCORED} GROUP BY st"
)
def status_breakdown(spark, d):
    return score.score_summary(score.score_dataframe(cleaned(spark, d)))


# ---- validation ----
_URLS = " , ".join(
    rf"CASE WHEN NOT regexp_matches({c}, '^https?://[a-zA-Z0-9\-._~:/?#\[\]@!$&''()*+,;=%]+$') THEN 'INVALID_URL' END"
    for c in validate.URL_FIELDS
)
_FOUNDER_BAD = f"len(list_filter(string_split(founder, ','), lambda v: trim(v) <> '' AND NOT {_PERSON.format('trim(v)')})) > 0"
# the name's first word and the host's first label, the shorter one first
_MATCHED = f"""(SELECT * EXCLUDE (short, long), w IS NULL OR r IS NULL OR length(w) < 4 OR length(r) < 3 OR contains(long, short)
    OR {_partial('short', 'long')} >= {validate.NAME_MATCH_MIN} AS fits FROM (SELECT *, CASE WHEN length(w) <= length(r) THEN w ELSE r END AS short,
    CASE WHEN length(w) <= length(r) THEN r ELSE w END AS long FROM (SELECT *, {_WORD} AS w, {_ROOT} AS r FROM {_CLEAN} c) c1) c2)"""
_VALID = f"""(SELECT *, list_filter([CASE WHEN name IS NULL THEN 'MISSING_NAME' END, CASE WHEN website IS NULL THEN 'MISSING_WEBSITE' END,
      CASE WHEN description IS NULL THEN 'MISSING_DESCRIPTION' END, CASE WHEN industry IS NULL THEN 'MISSING_INDUSTRY' END],
      lambda f: f IS NOT NULL) AS issues,
    list_filter([CASE WHEN length(description) < 30 THEN 'DESCRIPTION_TOO_SHORT' END,
      CASE WHEN NOT regexp_matches(email, {_EMAIL}) THEN 'INVALID_EMAIL' END,
      CASE WHEN length(regexp_replace(phone, '\\D', '', 'g')) NOT BETWEEN 7 AND 15 THEN 'INVALID_PHONE' END, {_URLS},
      CASE WHEN NOT {_PERSON.format('ceo')} THEN 'INVALID_CEO' END,
      CASE WHEN {_FOUNDER_BAD} THEN 'INVALID_FOUNDER' END,
      CASE WHEN NOT fits THEN 'NAME_DOMAIN_MISMATCH' END,
      CASE WHEN coalesce(cast(trunc(try_cast(confidence_score AS double)) AS int), 0) < 30 THEN 'LOW_CONFIDENCE_SCORE' END,
      CASE WHEN status = 'NOT_FOUND' THEN 'STATUS_NOT_FOUND' WHEN status = 'NEEDS_REVIEW' THEN 'STATUS_NEEDS_REVIEW' END,
      CASE WHEN website IS NOT NULL AND count(*) OVER (PARTITION BY website) > 1 THEN 'DUPLICATE_DOMAIN' END],
      lambda f: f IS NOT NULL) AS warnings FROM {_MATCHED} c) v"""


# fields as validation leaves them: what is invalid is NULL
_URL_BAD = r"NOT regexp_matches({0}, '^https?://[a-zA-Z0-9\-._~:/?#\[\]@!$&''()*+,;=%]+$')"
_INVALID = {
    "email": f"NOT regexp_matches(email, {_EMAIL})",
    "phone": r"length(regexp_replace(phone, '\D', '', 'g')) NOT BETWEEN 7 AND 15",
    **{c: _URL_BAD.format(c) for c in validate.URL_FIELDS},
    "ceo": f"NOT {_PERSON.format('ceo')}",
    "founder": _FOUNDER_BAD,
    "size": f"size NOT IN ({', '.join(f"'{b}'" for b in X.SIZE_BANDS)})",
}
_NULLED = ", ".join(f"CASE WHEN NOT coalesce({bad}, false) THEN {c} END AS {c}" for c, bad in _INVALID.items())
_VALIDATED = f"(SELECT * EXCLUDE ({', '.join(_INVALID)}), {_NULLED} FROM {_VALID})"


def _validated(spark, d):
    # as after a step of the pipeline: cleaning and validating in one stage is more code than the JVM takes at once
    return validate.validate(cut(cleaned(spark, d)))


@query(
    f"""SELECT rid, array_to_string(issues, ', ') AS issues, array_to_string(warnings, ', ') AS warnings, {', '.join(_INVALID)}
    FROM {_VALIDATED} w"""
)
def validate_rows(spark, d):
    join = lambda c: F.array_join(c, ", ")
    return _validated(spark, d).select(
        F.col(ORD).alias("rid"), join("_issues").alias("issues"), join("_warnings").alias("warnings"), *validate.CHECKED
    )


@query(f"SELECT code, count(*) AS n FROM (SELECT unnest(list_concat(issues, warnings)) AS code FROM {_VALID}) x GROUP BY code")
def issue_histogram(spark, d):
    return validate.issue_counts(_validated(spark, d))


@query(
    f"SELECT code, count(*) AS n FROM (SELECT unnest(list_concat(issues, warnings)) AS code FROM {_VALID}) x"
    " GROUP BY code ORDER BY n DESC, code LIMIT 10"
)
def top_issues(spark, d):
    return validate.top_issues(_validated(spark, d))


_STATE = "coalesce(status, 'NOT_FOUND')"
_POINTS = "try_cast(confidence_score AS double)"
_COUNTERS = ", ".join(
    [
        "count(*) AS total, count(*) FILTER (len(issues) = 0) AS valid, count(*) FILTER (len(issues) > 0) AS invalid, cast(sum(len(warnings)) AS bigint) AS warnings",
        *[f"count(*) FILTER ({_STATE} = '{x}') AS status_{x.lower()}" for x in STATUSES],
        *[f"count({c}) AS filled_{c}" for c in COMPLETENESS_FIELDS],
        "count(*) FILTER (ceo IS NULL) AS missing_ceo, count(*) FILTER (founder IS NULL) AS missing_founder",
        f"round(cast(avg({_POINTS}) AS decimal(30, 10)), 2)::double AS average_score, cast(min({_POINTS}) AS int) AS min_score, cast(max({_POINTS}) AS int) AS max_score",
    ]
)
@query(f"SELECT {_COUNTERS} FROM {_VALIDATED} w")
def report_counts(spark, d):
    return validate.counters(_validated(spark, d))


@query(
    f"SELECT rid, name, len(issues) = 0 AS is_valid, array_to_string(issues, ', ') AS errors, array_to_string(warnings, ', ') AS warnings"
    f" FROM {_VALID} WHERE len(issues) + len(warnings) > 0"
)
def findings(spark, d):
    return validate.findings(_validated(spark, d)).select(
        F.col(ORD).alias("rid"), "name", "is_valid", F.array_join("errors", ", ").alias("errors"), F.array_join("warnings", ", ").alias("warnings")
    )


@query(f"SELECT website AS domain, count(*) AS n FROM {_CLEAN} c WHERE website IS NOT NULL GROUP BY website HAVING count(*) > 1")
def dup_domains(spark, d):
    return validate.duplicate_domains(cleaned(spark, d))


def _leaders_sql(rows: str) -> str:
    return f"""WITH {_similar_sql(rows, 92, 3)}, edges AS (SELECT least(fa, fb) AS a, greatest(fa, fb) AS b FROM pairs),
    nodes AS (SELECT id, list_filter(list(a), lambda x: x IS NOT NULL) AS ns FROM (SELECT b AS id, a FROM edges UNION SELECT a, NULL FROM edges) u GROUP BY id),
    heads AS (SELECT list_reduce(list({{'id': id, 'ns': ns}} ORDER BY id), lambda acc, x: CASE WHEN list_has_any(acc, x.ns) THEN acc
      ELSE list_append(acc, x.id) END, []::bigint[]) AS leaders FROM nodes),
    led AS (SELECT id, list_min(list_intersect(ns, leaders)) AS leader FROM nodes, heads WHERE NOT list_contains(leaders, id))
    SELECT rid AS "row", coalesce(leader, first) AS leader FROM (SELECT rid, {_KEY} AS k FROM {rows} c WHERE name IS NOT NULL) r
    JOIN names USING (k) LEFT JOIN led ON led.id = first WHERE rid <> coalesce(leader, first)"""


@query(_leaders_sql(_CLEAN))
def dup_names(spark, d):
    return validate.duplicate_names(cut(cleaned(spark, d)))


_MERGED = f"SELECT {ORD} AS rid, * EXCLUDE ({ORD}) FROM ({_merged_sql('cluster', f'kept JOIN clusters USING (rid) JOIN {_MORE} i USING (rid)')}) m"
_REPORTED = _VALIDATED.replace(_CLEAN, "graded")


@query(
    f"""WITH RECURSIVE {_CLUSTERS}, merged AS MATERIALIZED ({_MERGED}), graded AS MATERIALIZED (SELECT * EXCLUDE (confidence_score, status, label, crit, s, raw,
      flags, score, st), score::varchar AS confidence_score, st AS status FROM {_SCORED.replace(f"FROM {_CLEAN} c", "FROM merged c")}),
    dups AS (SELECT (SELECT count(*) FROM (SELECT website FROM graded WHERE website IS NOT NULL GROUP BY website HAVING count(*) > 1)) AS duplicate_domains,
      (SELECT count(*) FROM ({_leaders_sql("graded")}) l) AS duplicate_names),
    codes AS (SELECT string_agg(code || '=' || n, ' ' ORDER BY code) AS issue_counts FROM (SELECT code, count(*) AS n FROM (SELECT
      unnest(list_concat(issues, warnings)) AS code FROM {_REPORTED} v) x GROUP BY code) y)
    SELECT *, duplicate_domains + duplicate_names AS duplicates_removed FROM (SELECT {_COUNTERS} FROM {_REPORTED} w) c, dups, codes"""
)
def pipeline_report(spark, d):
    x = cut(score.score_dataframe(clean.clean(records(spark, d))))
    one = validate.report(x)[1]
    codes = F.array_join(F.transform(F.map_entries("issue_counts"), lambda e: F.concat_ws("=", e["key"], e["value"])), " ")
    return one.withColumn("issue_counts", codes)


# ---- pages, answers, enrichment ----
HTML = """
SELECT k AS page_id, 'https://site' || k || '.com' AS url, 'info' || k || '@site.com' AS mail,
  '<html><head><title> Page ' || k || ' </title>' || CASE WHEN k % 3 = 0 THEN '<meta name="Description" content=" About ' || k || ' ">' ELSE '' END
  || CASE WHEN k % 4 = 0 THEN '<meta property="og:description" content="Shared ' || k || '">' ELSE '' END
  || '<style>p.red</style></head><body><nav>Home nav@site.com</nav><p>Write to info' || k || '@site.com &amp; call</p>'
  || '<p>+1 555 123 4567</p><script>var x = "a@b.com";</script>'
  || CASE WHEN k % 2 = 0 THEN '<footer><a href="https://www.linkedin.com/company/site' || k || '">in</a>'
     || '<a href="https://facebook.com/sharer/x">s</a><a href="https://facebook.com/site' || k || '?lang=en">f</a>'
     || '<a href="https://x.com/intent/t">t</a><a href="https://www.twitter.com/site' || k || '">t</a>'
     || '<a href="https://instagram.com/site' || k || '/">i</a></footer>' ELSE '' END
  || '</body></html>' AS html
FROM (SELECT cast(c_custkey AS bigint) AS k FROM {customer}) t
"""


def pages(spark, d):
    return spark.sql(HTML, customer=table(spark, d, "customer"))


_VISIBLE = "'Write to info' || page_id || '@site.com & call +1 555 123 4567'"


@query(
    "SELECT page_id, 'Page ' || page_id AS title, CASE WHEN page_id % 3 = 0 THEN 'About ' || page_id ELSE '' END AS meta_description,"
    " CASE WHEN page_id % 4 = 0 THEN 'Shared ' || page_id ELSE '' END AS og_description,"
    f" {_VISIBLE} AS visible_text, CASE WHEN page_id % 4 = 0 THEN 'Shared ' || page_id WHEN page_id % 3 = 0 THEN 'About ' || page_id"
    " ELSE 'Page ' || page_id END AS best_description, 'info' || page_id || '@site.com' AS emails, '+1 555 123 4567' AS phones,"
    " CASE WHEN page_id % 2 = 0 THEN 'https://www.linkedin.com/company/site' || page_id ELSE '' END AS linkedin,"
    " CASE WHEN page_id % 2 = 0 THEN 'https://facebook.com/site' || page_id || '?lang=en' ELSE '' END AS facebook,"
    " CASE WHEN page_id % 2 = 0 THEN 'https://www.twitter.com/site' || page_id ELSE '' END AS twitter,"
    " CASE WHEN page_id % 2 = 0 THEN 'https://instagram.com/site' || page_id || '/' ELSE '' END AS instagram"
    f" FROM ({HTML.replace('{customer}', 'customer')}) p"
)
def page_facts(spark, d):
    x = extract_pages(pages(spark, d))
    return x.select(
        "page_id", "title", "meta_description", "og_description", "visible_text", "best_description",
        F.array_join("emails_found", "|").alias("emails"), F.array_join("phones_found", "|").alias("phones"),
        *[F.col(f"{n}_found").alias(n) for n in ("linkedin", "facebook", "twitter", "instagram")],
    )


ANSWER = """
SELECT k AS answer_id, CASE k % 5 WHEN 0 THEN '{{"description": " Makes ' || k || ' ", "industry": "Retail", "company_size": "11-50", "ceo": null, "confidence_score": 85.7}}'
  WHEN 1 THEN '{{"description": "", "company_size": "12", "confidence_score": "250"}}' WHEN 2 THEN 'no json'
  WHEN 3 THEN '{{"founder": "Jane", "confidence_score": "abc", "extra": 1}}' END AS raw
FROM (SELECT cast(c_custkey AS bigint) AS k FROM {customer}) t
"""


def answers(spark, d):
    return spark.sql(ANSWER, customer=table(spark, d, "customer"))


@query(
    "SELECT answer_id, CASE WHEN answer_id % 5 = 0 THEN 'Makes ' || answer_id ELSE '' END AS description,"
    " CASE WHEN answer_id % 5 = 0 THEN '11-50' ELSE '' END AS company_size, CASE WHEN answer_id % 5 = 3 THEN 'Jane' ELSE '' END AS founder,"
    " CASE answer_id % 5 WHEN 0 THEN 85 WHEN 1 THEN 100 ELSE 0 END AS confidence_score, answer_id % 5 NOT IN (0, 3) AS is_empty"
    " FROM (SELECT cast(c_custkey AS bigint) AS answer_id FROM customer) t"
)
def llm_parse(spark, d):
    x = answers(spark, d).withColumn("a", enrich.parse_answer(F.col("raw")))
    return x.select(
        "answer_id", "a.description", "a.company_size", "a.founder", "a.confidence_score", enrich.answer_empty(F.col("a")).alias("is_empty")
    )


@query(
    "SELECT doc_id, md5('TEXT: ' || array_to_string(list_filter([trim(coalesce(source, '')), trim(coalesce(lang, ''))],"
    " lambda x: x <> ''), chr(10) || chr(10)) || ' FOR ' || coalesce(page_kind, '')) AS prompt FROM documents"
)
def prompts(spark, d):
    empty = F.lit(None).cast("string")
    text = enrich.prompt_text(F.col("source"), F.col("lang"), empty, empty, Settings())
    p = enrich.render_prompt(F.coalesce(text, F.lit("")), F.col("page_kind"), "TEXT: {website_text} FOR {company_name}")
    return table(spark, d, "documents").select("doc_id", F.md5(p).alias("prompt"))


PAGE_KINDS = {"about": "about", "leadership": "team", "contact": "contact"}


SALTS = 32


def site_prompts(documents: DataFrame, settings: Settings) -> DataFrame:
    """source, prompt: per host the texts of its documents by page kind (others count as home), in the order of doc_id.

    A prompt holds a budget of words, so a text is needed only if less than that stands before it. That is asked within
    salted parts of a host first, so no group holds more than SALTS budgets per kind of page, however many pages a host has.
    """
    kind = F.lit("home")
    for name, slot in PAGE_KINDS.items():
        kind = F.when(F.lower(F.trim("page_kind")) == name, slot).otherwise(kind)
    texts = documents.filter(F.col("source").isNotNull() & (strip(F.col("text")) != "")).select("source", "doc_id", "text", kind.alias("slot"))
    # no text beyond the budget of words can be in the prompt, so the long ones are cut before they are collected
    most = settings.max_prompt_tokens
    texts = texts.withColumn("text", X.token_budget(F.col("text"), most)).withColumn("_w", X.count_words(F.col("text")))
    part = Window.partitionBy("source", "slot", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    before = F.sum("_w").over(part.orderBy("doc_id", "text").rowsBetween(Window.unboundedPreceding, -1))
    near = texts.withColumn("_before", F.coalesce(before, F.lit(0))).filter(F.col("_before") < most)
    joined = near.groupBy("source").agg(
        *[
            F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("slot") == n, F.struct("doc_id", "text")))), lambda t: t["text"]), "\n\n").alias(n)
            for n in ("about", "team", "home", "contact")
        ]
    )
    text = enrich.prompt_text(*[F.col(n) for n in ("about", "team", "home", "contact")], settings)
    return joined.select("source", enrich.render_prompt(F.coalesce(text, F.lit("")), F.col("source")).alias("prompt"))


def _prompts_sql() -> str:
    space = " || ".join(f"chr({ord(ch)})" for ch in SPACES)
    slot = "CASE lower(trim(page_kind)) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PAGE_KINDS.items()) + " ELSE 'home' END"
    parts = ", ".join(f"max(t) FILTER (slot = '{n}')" for n in ("about", "team", "home", "contact"))
    most = Settings().max_prompt_tokens
    words = _WORDS.replace("text", "x")
    template = enrich.PROMPT.replace("'", "''")
    return f"""SELECT source, md5(replace(replace('{template}', '{{website_text}}', CASE WHEN len(w) > {most} THEN array_to_string(w[1:{most}], ' ') ELSE x END),
      '{{company_name}}', source)) AS prompt FROM (SELECT source, x, {words} AS w FROM (SELECT source, array_to_string(list_filter([{parts}], lambda p: p IS NOT NULL),
      chr(10) || chr(10)) AS x FROM (SELECT source, slot, trim(string_agg(text, chr(10) || chr(10) ORDER BY doc_id), {space}) AS t FROM (SELECT source, doc_id,
      text, {slot} AS slot FROM documents WHERE source IS NOT NULL AND trim(text, {space}) <> '') a GROUP BY source, slot) b GROUP BY source) c) d"""


def prompt_texts(spark, d):
    return site_prompts(table(spark, d, "documents"), Settings()).withColumn("prompt", F.md5("prompt"))


QUERIES["prompt_texts"] = prompt_texts


@query(
    f"SELECT rid, coalesce(ceo, 'New Ceo') AS ceo, coalesce(phone, '555') AS phone, CASE WHEN a = '' THEN b"
    " WHEN contains(a, b) THEN a ELSE a || ',' || b END AS source_used"
    f" FROM (SELECT *, coalesce(source_used, '') AS a, 'web' AS b FROM {_CLEAN} c) x"
)
def enrich_fields(spark, d):
    x = cleaned(spark, d)
    return x.select(
        F.col(ORD).alias("rid"),
        enrich.merge_field(F.col("ceo"), F.lit("New Ceo")).alias("ceo"),
        enrich.merge_field(F.col("phone"), F.lit("555")).alias("phone"),
        enrich.append_source(F.col("source_used"), F.lit("web")).alias("source_used"),
    )


_FACTS = f"""(SELECT * EXCLUDE (description, email, source_used), coalesce(description, 'About https://' || website) AS description,
    coalesce(email, CASE WHEN website IS NOT NULL THEN 'mail@site.com' END) AS email, CASE WHEN source_used IS NULL THEN tag
    WHEN contains(source_used, tag) THEN source_used ELSE source_used || ',' || tag END AS source_used FROM (SELECT *,
    CASE WHEN website IS NOT NULL THEN 'official_website,web_scrape' WHEN linkedin IS NOT NULL THEN 'linkedin' ELSE 'not_found' END AS tag
    FROM {_CLEAN} c WHERE coalesce(status, '') <> 'FOUND') t)"""
_WORKED = _SCORED.replace(f"FROM {_CLEAN} c", f"FROM {_FACTS} c")
_SAME = ", ".join(c for c in FIELDS if c not in ("confidence_score", "status"))


@query(
    f"""SELECT rid AS {ORD}, company_id, company_name, {_SAME}, confidence_score, status, review, false AS _skipped FROM (SELECT {_SAME}, rid,
    score::varchar AS confidence_score, st AS status, array_to_string(flags, ', ') AS review FROM {_WORKED}) w JOIN {_MORE} i USING (rid)
    UNION ALL SELECT rid, company_id, company_name, {_SAME}, confidence_score, status, NULL, true FROM {_CLEAN} c JOIN {_MORE} i USING (rid)
    WHERE status = 'FOUND'"""
)
def enrich_records(spark, d):
    x = cut(cleaned(spark, d))
    known = x.filter("website IS NOT NULL").select(F.concat(F.lit("https://"), "website").alias("url")).distinct()
    html = F.concat(F.lit("<title>About "), "url", F.lit("</title><p>mail@site.com</p>"))
    out = enrich.enrich(x, extract_pages(known.withColumn("html", html))).drop("last_updated", enrich.FAILED)
    return out.withColumnRenamed("_review_flags", "review")


@query(
    f"SELECT rid, CASE WHEN website IS NOT NULL THEN 'official_website' WHEN linkedin IS NOT NULL THEN 'linkedin' ELSE 'not_found' END"
    f" AS label, coalesce(website, linkedin) AS url FROM {_CLEAN} c"
)
def best_urls(spark, d):
    url, label = enrich.best_url(F.col("website"), F.col("linkedin"))
    return cleaned(spark, d).select(F.col(ORD).alias("rid"), label.alias("label"), url.alias("url"))


@query(f"SELECT rid, coalesce(trim(status) = 'FOUND', false) AS skipped FROM ({_RAW}) r")
def skip_partition(spark, d):
    done, todo = enrich.split_done(raw(spark, d))
    pick = lambda x, v: x.select("rid", F.lit(v).alias("skipped"))
    return pick(done, True).unionByName(pick(todo, False))


# ---- documents and other tables ----
@query(
    "SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text,"
    " '[a-zA-Z0-9._%+\\-]+@[a-zA-Z0-9.\\-]+\\.[a-zA-Z]{2,}'))), '|') AS emails FROM documents"
)
def doc_emails(spark, d):
    e = F.array_join(F.array_sort(X.find_emails(F.col("text"))), "|")
    return table(spark, d, "documents").select("doc_id", e.alias("emails"))


_DIGITS = r"length(regexp_replace(x, '\D', '', 'g'))"


@query(
    rf"""SELECT doc_id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i)[1:5], '|') AS phones FROM (SELECT doc_id,
    list_filter(list_transform(regexp_extract_all(text, '\+?\d[\d\s\-().]{{7,}}\d'), lambda x: trim(x)), lambda x: {_DIGITS} BETWEEN 7 AND 15) AS l
    FROM documents) p"""
)
def doc_phones(spark, d):
    return table(spark, d, "documents").select("doc_id", F.array_join(X.find_phones(F.col("text")), "|").alias("phones"))


@query("SELECT doc_id, md5(substr(text, 1, 8000)) AS text FROM documents")
def text_limit(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(F.substring("text", 1, 8000)).alias("text"))


_WORDS = "list_filter(string_split_regex(text, '[" + "".join(f"\\x{{{ord(ch):x}}}" for ch in SPACES) + "]+'), lambda w: w <> '')"


@query(
    f"SELECT doc_id, md5(CASE WHEN len(w) > 100 THEN array_to_string(w[1:100], ' ') ELSE text END) AS text FROM (SELECT doc_id, text, {_WORDS} AS w"
    " FROM documents) x"
)
def token_budget(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(X.token_budget(F.col("text"), 100)).alias("text"))


def _profile_sql(name: str, columns: list[tuple[str, str]]) -> str:
    one = "SELECT '{c}' AS column_name, count({c}) FILTER (cast({c} AS varchar) NOT IN ('', 'nan', 'None')) AS non_null, count(*) AS n, '{k}' AS kind FROM {t}"
    parts = " UNION ALL ".join(one.format(c=c, k=k, t=name) for c, k in columns)
    return f"SELECT column_name, non_null, n - non_null AS n_null, round(100.0 * non_null / n, 1) AS fill_pct, kind FROM ({parts}) x"


_ORDERS = [
    ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
    ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"),
]


@query(_profile_sql("orders", [(c, k) for c, k in _ORDERS]))
def profile_orders(spark, d):
    return column_profile(table(spark, d, "orders").select(*[c for c, _ in _ORDERS]))


_LINEITEM = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"), ("l_quantity", "double"),
    ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"), ("l_linestatus", "string"),
    ("l_shipdate", "timestamp_ntz"),
]


@query(_profile_sql("lineitem", _LINEITEM))
def profile_lineitem(spark, d):
    return column_profile(table(spark, d, "lineitem"))


@query(
    "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer"
    " UNION ALL BY NAME SELECT s_suppkey AS id, s_name AS name FROM supplier"
)
def union_by_name(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return c.unionByName(s, allowMissingColumns=True)


@query(
    "SELECT event_type, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS pct FROM events"
    " GROUP BY event_type ORDER BY n DESC, event_type LIMIT 10"
)
def top_events(spark, d):
    n = table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n").alias("total"))  # one row
    pct = F.round(100 * F.col("n") / F.col("total"), 4).alias("pct")
    return n.join(F.broadcast(total)).select("event_type", "n", pct).orderBy(F.desc("n"), "event_type").limit(10)


@query(
    "SELECT o_orderkey, CASE WHEN s < 60 THEN printf('%.1fs', s) WHEN s < 3600 THEN printf('%dm %ds', s::bigint // 60, s::bigint % 60)"
    " ELSE printf('%dh %dm %ds', s::bigint // 3600, (s::bigint % 3600) // 60, s::bigint % 60) END AS elapsed"
    " FROM (SELECT o_orderkey, cast(o_orderkey % 7300 AS double) AS s FROM orders) x"
)
def elapsed(spark, d):
    s = (F.col("o_orderkey") % 7300).cast("double")
    return table(spark, d, "orders").select("o_orderkey", X.format_elapsed(s).alias("elapsed"))


SQL["prompt_texts"] = _prompts_sql()


@query(
    f"""SELECT rid, CASE WHEN length(w) >= 4 AND length(r) >= 3 THEN round({_partial('short', 'long')}, 4) END AS score FROM (SELECT rid, w, r,
    CASE WHEN length(w) <= length(r) THEN w ELSE r END AS short, CASE WHEN length(w) <= length(r) THEN r ELSE w END AS long
    FROM (SELECT rid, {_WORD} AS w, {_ROOT} AS r FROM {_CLEAN} c) c1) c2"""
)
def name_domain_scores(spark, d):
    x = cut(cleaned(spark, d).select(F.col(ORD).alias("rid"), score.name_word(F.col("name")).alias("w"), score.domain_root(F.col("website")).alias("r")))
    ask = (F.length("w") >= 4) & (F.length("r") >= 3)
    return x.select("rid", F.round(partial_ratio_udf(F.when(ask, F.col("w")), F.when(ask, F.col("r"))), 4).alias("score"))


_SITES = """SELECT k, 'https://s' || k || '.com' || CASE WHEN k % 2 = 0 THEN '/' ELSE '' END AS url FROM (SELECT cast(c_custkey AS bigint) AS k FROM {customer}) t"""
# the page at one path has a text, the one before it is blank
_SUBPAGES = """SELECT 'https://s' || k || '.com' || path AS url, CASE WHEN k % 4 = 1 AND path = '/about' THEN ' ' ELSE path || ' of ' || k END AS visible_text
  FROM (SELECT cast(c_custkey AS bigint) AS k FROM {customer}) t, (VALUES ('/about'), ('/company'), ('/mission')) p(path) WHERE k % 4 < 3 AND (k % 4 > 0 OR path <> '/about')"""


@query(
    f"""SELECT s.url, arg_min(visible_text, list_position({list(ABOUT_PATHS)!r}, p.url[length(rtrim(s.url, '/')) + 1:])) AS about_text
    FROM ({_SITES.replace("{customer}", "customer")}) s JOIN ({_SUBPAGES.replace("{customer}", "customer")}) p ON starts_with(p.url, rtrim(s.url, '/') || '/')
    WHERE trim(visible_text) <> '' GROUP BY s.url"""
)
def sub_pages(spark, d):
    customer = table(spark, d, "customer")
    return sub_page_text(spark.sql(_SITES, customer=customer), spark.sql(_SUBPAGES, customer=customer), ABOUT_PATHS, "about_text")


_FETCHES = """SELECT k, CASE WHEN k % 7 = 0 THEN ' ' WHEN k % 7 = 1 THEN NULL ELSE 'https://a.io/' || k END AS url, CASE WHEN k % 5 = 0 THEN true WHEN k % 5 = 1 THEN false END
  AS cached, CASE WHEN k % 3 = 0 THEN true WHEN k % 3 = 1 THEN false END AS allowed, cast(CASE WHEN k % 4 = 0 THEN 200 WHEN k % 4 = 1 THEN 404 WHEN k % 4 = 2 THEN 204 END AS int)
  AS code, CASE WHEN k % 11 > 3 THEN true WHEN k % 11 = 0 THEN false END AS parsed FROM (SELECT cast(c_custkey AS bigint) AS k FROM {customer}) t"""


@query(
    f"""SELECT k, CASE WHEN coalesce(trim(url), '') = '' THEN 'empty_url' WHEN cached THEN 'cache_hit' WHEN NOT allowed THEN 'robots_blocked'
    WHEN code IS NULL OR code NOT BETWEEN 200 AND 299 THEN 'fetch_failed' WHEN parsed IS NULL OR NOT parsed THEN 'parse_error' ELSE 'success' END AS state
    FROM ({_FETCHES.replace("{customer}", "customer")}) f"""
)
def scrape_states(spark, d):
    x = spark.sql(_FETCHES, customer=table(spark, d, "customer"))
    return x.select("k", scrape_state(*[F.col(c) for c in ("url", "cached", "allowed", "code", "parsed")]).alias("state"))


@query(
    f"""SELECT rid, CASE WHEN website IS NULL THEN NULL WHEN k % 3 = 0 THEN 'moved' || k % 100 || '.org' ELSE website END AS website
    FROM (SELECT rid, website, min(rid) OVER (PARTITION BY website) AS k FROM {_CLEAN} c) x"""
)
def redirects(spark, d):
    x = cut(cleaned(spark, d))
    first = x.filter("website IS NOT NULL").groupBy("website").agg(F.min(ORD).alias("k"))
    to = F.when(F.col("k") % 3 == 0, F.concat(F.lit("http://www.moved"), F.col("k") % 100, F.lit(".org/new?x")))
    found = first.select(F.concat(F.lit("https://www."), "website").alias("url"), to.alias("final_url"), F.when(to.isNotNull(), 1).otherwise(0).alias("redirect_count"))
    return enrich.follow_redirects(x, found, Settings()).select(F.col(ORD).alias("rid"), "website")


@query(f"SELECT coalesce(name, '') AS name, coalesce(phone, '') AS phone, coalesce(email, '') AS email, coalesce(founder, '') AS founder FROM {_CLEAN} c")
def export_round_trip(spark, d):
    """What is written as one delimited file and read again, with blanks for what is missing."""
    path = f"{shared_dir(spark)}/export-{uuid.uuid4().hex}.csv"
    export_csv(cleaned(spark, d).select("name", "phone", "email", "founder", F.lit(1).alias("_internal")), path, single=True)
    back = read_checkpoint(spark, path)
    return back.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in back.columns])


@query(
    f"SELECT {', '.join(f'{c}' if c in ('name', 'website', 'email') else f"'' AS {c}" for c in STANDARD_COLUMNS)} FROM {_CLEAN} c"
)
def standard_projection(spark, d):
    return clean.standard_columns(cleaned(spark, d).select("email", "name", "website", F.lit(1).alias("other")))
