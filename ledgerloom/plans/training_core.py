"""Queries of the core operators for training data: rejects, drift and quality, over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.nulls import NA_WORDS, SPACES
from ledgerloom.functions.records import FIELD_WORDS, OWNER
from ledgerloom.operators import drift, quality, rejects
from ledgerloom.plans.company import domain_sql
from ledgerloom.runtime import shared_dir, table

WATCHED = ["ceo", "industry", "phone"]


def _batches(spark: SparkSession, d: str) -> list[DataFrame]:
    return [table(spark, d, "batch_01_standard"), table(spark, d, "batch_02_messy")]


def _judged(spark: SparkSession, d: str) -> DataFrame:
    return rejects.judge_batches(_batches(spark, d), table(spark, d, "batch_files"))


def _lines(spark: SparkSession, d: str) -> DataFrame:
    a, b = (t.select("line_id", "file_id", "raw_line") for t in _batches(spark, d))
    return a.unionAll(b)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return rejects.rejected(_judged(spark, d))


def p2_loaded(spark: SparkSession, d: str) -> DataFrame:
    return rejects.loaded(_judged(spark, d))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.changes(_lines(spark, d), table(spark, d, "batch_files"))


def p3_table(spark: SparkSession, d: str) -> DataFrame:
    return drift.one_table(_lines(spark, d), table(spark, d, "batch_files"))


def p3_alternatives(spark: SparkSession, d: str) -> DataFrame:
    return drift.alternatives(_lines(spark, d), table(spark, d, "batch_files"))


def _stored(states: DataFrame, part: str) -> DataFrame:
    """The states as later runs find them: stored by load and read back."""
    store = quality.StateStore(states.sparkSession, f"{shared_dir(states.sparkSession)}/states-{uuid.uuid4().hex}", part)
    store.add(states)
    return store.states()


def _watched(spark: SparkSession, d: str) -> DataFrame:
    return _stored(quality.value_states(table(spark, d, "enriched_companies"), "load_no", WATCHED), "load_no")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return quality.shifts(_watched(spark, d), "load_no")


def p4_profile(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "enriched_companies")
    states = _stored(quality.column_states(df, "load_no", df.columns), "load_no")
    return quality.profile_by_load(states, "load_no").orderBy("scope", "load_no", "column_name")


def p4_limits(spark: SparkSession, d: str) -> DataFrame:
    states = _watched(spark, d)
    return quality.control_limits(states, "load_no").filter("out_of_limits").select(
        "load_no", "column_name", "finding", F.round("share", 6).alias("share")
    )


QUERIES = {f.__name__: f for f in (p2_found, p2_loaded, p3_found, p3_alternatives, p3_table, p4_found, p4_profile, p4_limits)}


def _clean_sql(x: str) -> str:
    spaces = " || ".join(f"chr({ord(ch)})" for ch in SPACES)
    t = f"trim({x}, {spaces})"
    words = ", ".join(f"'{w}'" for w in NA_WORDS)
    return f"CASE WHEN {t} <> '' AND lower({t}) NOT IN ({words}) THEN {t} END"


_WRONG = {
    "ceo": r"NOT (length(v) >= 2 AND NOT contains(v, '@') AND NOT contains(lower(v), 'http')"
    r" AND NOT regexp_matches(v, '^[\d\s\-+().]+$') AND regexp_matches(v, '^[A-Za-z\s\-.'']{2,80}$'))",
    "industry": "regexp_matches(v, '[0-9<>]|http')",
    "phone": r"length(regexp_replace(v, '\D', '', 'g')) NOT BETWEEN 7 AND 15",
}
_CELLS = " UNION ALL ".join(
    f"SELECT load_no, '{c}' AS column_name, v, {w} AS wrong FROM (SELECT load_no, {_clean_sql(c)} AS v FROM enriched_companies) t"
    for c, w in _WRONG.items()
)
_STATES = f"""SELECT load_no, column_name, sum(n) AS n, coalesce(sum(n) FILTER (v IS NULL), 0) AS missing,
    coalesce(sum(n) FILTER (wrong), 0) AS wrong, coalesce(max(n) FILTER (v IS NOT NULL), 0) AS top
  FROM (SELECT load_no, column_name, v, wrong, count(*) AS n FROM ({_CELLS}) c GROUP BY ALL) g GROUP BY ALL"""
_SHARES = " UNION ALL ".join(
    f"SELECT load_no, column_name, '{f}' AS finding, {x} / nullif({y}, 0) AS share FROM ({_STATES}) s"
    for f, x, y in (("missing", "missing", "n"), ("pattern", "wrong", "(n - missing)"), ("top_value", "top", "(n - missing)"))
)

SQL: dict[str, str] = {
    "p4_found": f"""SELECT load_no, column_name, finding FROM (SELECT *, abs(share - lag(share) OVER
        (PARTITION BY column_name, finding ORDER BY load_no)) AS step FROM ({_SHARES}) x) y WHERE step >= 0.15 - 1e-12"""
}


# ---- records and files, quote-aware, for any delimiter that stands for itself in a class ----
_PATTERN = """ '(?:"[^"]*(?:""[^"]*)*"|[^"' || d || '][^' || d || ']*|)' """
_SPLIT = f"""list_transform(regexp_extract_all(d || {{x}}, '[' || d || '](' || {_PATTERN} || ')', 1),
    lambda v: CASE WHEN starts_with(v, '"') THEN replace(substr(v, 2, length(v) - 2), '""', '"') ELSE v END)"""
_FIELD_KEY = r"regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}]+', '', 'g')"


def _field_sql(x: str) -> str:
    tests = " ".join(f"WHEN regexp_full_match({_FIELD_KEY.format(x=x)}, '{OWNER}(?:{words})') THEN '{field}'" for field, words in FIELD_WORDS)
    return f"CASE {tests} END"


_HEADS = f"""heads AS MATERIALIZED (SELECT file_id, feed, delivered_at, d, names, list_transform(names, lambda n: {_field_sql('n')}) AS kinds FROM
    (SELECT *, {_SPLIT.format(x="ltrim(header_line, chr(65279))")} AS names FROM (SELECT *, delimiter AS d FROM batch_files) f) g)"""
_RECORDS = f"""records AS MATERIALIZED (SELECT *, CASE WHEN quoted THEN {_SPLIT.format(x="raw_line")} END AS fields FROM (SELECT l.*, d, names, kinds,
    regexp_full_match(raw_line, {_PATTERN} || '(?:[' || d || ']' || {_PATTERN} || ')*') AS quoted FROM (SELECT line_id, file_id, coalesce(raw_line, '') AS raw_line
    FROM batch_01_standard UNION ALL SELECT line_id, file_id, coalesce(raw_line, '') FROM batch_02_messy) l LEFT JOIN heads USING (file_id)) r)"""
_BAD = f"""list_filter(list_zip(kinds, list_transform(fields, lambda v: {_clean_sql('v')})), lambda c: c[2] IS NOT NULL AND ((c[1] = 'website'
    AND {domain_sql('c[2]')} = '') OR (c[1] = 'email' AND NOT regexp_matches(c[2], '^[^\\s@]+@[^\\s@]+\\.[^\\s@]+$'))))"""

SQL["p2_found"] = f"""WITH {_HEADS}, {_RECORDS} SELECT line_id, reason FROM (SELECT line_id, CASE WHEN d IS NULL THEN 'no_header' WHEN NOT quoted THEN 'quoting'
    WHEN len(fields) <> len(names) THEN 'column_count' WHEN len({_BAD}) > 0 THEN 'invalid_value' END AS reason FROM records) x WHERE reason IS NOT NULL"""

_TAG = """CASE WHEN regexp_matches(v, '(?i)^(true|false)$') THEN 'boolean' WHEN regexp_matches(v, '^[+-]?\\d+$') THEN 'integer'
    WHEN regexp_matches(v, '^[+-]?(\\d+\\.\\d*|\\.\\d+)([eE][+-]?\\d+)?$') THEN 'decimal'
    WHEN regexp_matches(v, '^\\d{4}-\\d{2}-\\d{2}$') AND try_cast(v AS date) IS NOT NULL THEN 'date' ELSE 'text' END"""
# All names are known here, so equal fields say the same as equal content does: the query asks the content first.
SQL["p3_found"] = f"""WITH {_HEADS}, {_RECORDS},
  cells AS (SELECT file_id, unnest(range(1, len(fields) + 1)) AS pos, unnest(fields) AS x FROM records WHERE quoted AND len(fields) = len(names)),
  tags AS (SELECT file_id, pos, {_TAG} AS tag, count(*) AS n FROM (SELECT file_id, pos, {_clean_sql('x')} AS v FROM cells) c WHERE v IS NOT NULL GROUP BY ALL),
  kinds AS (SELECT file_id, pos, arg_max(tag, row(n, list_position(['boolean', 'integer', 'decimal', 'date', 'text'], tag))) AS kind FROM tags GROUP BY ALL),
  cols AS (SELECT file_id, feed, delivered_at, name, min(pos) AS pos, arg_min(field, pos) AS field FROM (SELECT file_id, feed, delivered_at,
    unnest(range(1, len(names) + 1)) AS pos, unnest(names) AS name, unnest(kinds) AS field FROM heads) c GROUP BY ALL),
  typed AS (SELECT c.*, last_value(kind IGNORE NULLS) OVER (PARTITION BY feed, name ORDER BY delivered_at, c.file_id) AS kind
    FROM cols c LEFT JOIN kinds USING (file_id, pos)),
  steps AS (SELECT file_id, before FROM (SELECT file_id, lag(file_id) OVER (PARTITION BY feed ORDER BY delivered_at, file_id) AS before FROM batch_files) b
    WHERE before IS NOT NULL),
  now AS (SELECT s.file_id, t.name, t.field, t.kind, t.pos FROM steps s JOIN typed t ON t.file_id = s.file_id),
  was AS (SELECT s.file_id, t.name, t.field, t.kind, t.pos FROM steps s JOIN typed t ON t.file_id = s.before),
  gone AS (SELECT *, row_number() OVER (PARTITION BY file_id, field ORDER BY pos) AS r FROM was w WHERE NOT EXISTS (FROM now n WHERE n.file_id = w.file_id AND n.name = w.name)),
  new AS (SELECT *, row_number() OVER (PARTITION BY file_id, field ORDER BY pos) AS r FROM now n WHERE NOT EXISTS (FROM was w WHERE n.file_id = w.file_id AND n.name = w.name)),
  pairs AS (SELECT g.file_id, g.name AS o, n.name AS n FROM gone g JOIN new n USING (file_id, field, r))
  SELECT file_id, 'renamed' AS change_kind, o AS old_field, n AS new_field FROM pairs
  UNION ALL SELECT file_id, 'removed', name, '' FROM gone g WHERE NOT EXISTS (FROM pairs p WHERE p.file_id = g.file_id AND p.o = g.name)
  UNION ALL SELECT file_id, 'added', '', name FROM new n WHERE NOT EXISTS (FROM pairs p WHERE p.file_id = n.file_id AND p.n = n.name)
  UNION ALL SELECT n.file_id, 'type_changed', n.name, n.name FROM now n JOIN was w ON n.file_id = w.file_id AND n.name = w.name WHERE n.kind <> w.kind"""

SQL["p4_limits"] = f"""SELECT load_no, column_name, finding, round(share, 6) AS share FROM (SELECT *, avg(share) OVER w AS mean, stddev_samp(share) OVER w AS sd,
    count(share) OVER w AS history FROM ({_SHARES}) x WINDOW w AS (PARTITION BY column_name, finding ORDER BY load_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) y
    WHERE history >= 3 AND abs(share - mean) > 3 * sd"""
