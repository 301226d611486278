"""SQL of the queries in `queries` that SQL can express."""

from __future__ import annotations

from ledgerloom.functions.nulls import NA_WORDS, SPACES


def _clean(x: str) -> str:
    t = f"trim({x}, {' || '.join(f'chr({ord(ch)})' for ch in SPACES)})"
    words = ", ".join(f"'{w}'" for w in NA_WORDS)
    return f"CASE WHEN {t} <> '' AND lower({t}) NOT IN ({words}) THEN {t} END"


_FIELDS = ("email", "linkedin", "description", "source_used")
_CLASS = (
    "CASE WHEN s IS NULL THEN 'none' WHEN regexp_matches(s, 'official|website') THEN 'official' WHEN contains(s, 'linkedin')"
    " THEN 'linkedin' WHEN regexp_matches(s, 'clearbit|wikipedia|crunchbase|database') THEN 'public'"
    " WHEN regexp_matches(s, 'llm|gpt|openai') THEN 'llm' WHEN contains(s, 'scrape') THEN 'scrape' WHEN contains(s, 'weak')"
    " THEN 'weak' ELSE 'none' END"
)
_SCORE = f"CASE {_CLASS} WHEN 'official' THEN 95 WHEN 'linkedin' THEN 80 WHEN 'public' THEN 80 WHEN 'llm' THEN 60 WHEN 'scrape' THEN 60 WHEN 'weak' THEN 30 ELSE 0 END"
# phrases of notices, of its own and not those of the operator
_PHRASES = (
    "is parked", "default web page", "browser is out of date", "reject all", "accept all", "been blocked", "was denied by", "could not be found",
    "too many requests", "under maintenance", "under construction", "index of /", "confirm your age", "redirecting you", "service temporarily",
    "not a robot", "loading, please", "session has expired", "enable scripts",
)
_NOTICE = " OR ".join(f"contains(lower(description), '{p}')" for p in _PHRASES)
_USABLE = {
    "email": r"regexp_matches(email, '^[^\s@]+@[^\s@]+\.[^\s@]+$')",
    "linkedin": r"regexp_matches(linkedin, '(?i)linkedin\.[a-z]+/company/[^/?#\s]+')",
    "description": r"NOT regexp_matches(description, '(?i)(?:…|\.\.\.|[\[(](?:read )?more[\])])\s*$')"
    r" AND regexp_matches(description, '[.!?][^\p{L}\p{N}\s]*$|[.!?][^\s]{0,10}[^\x00-\x7F]$')"
    f" AND NOT ({_NOTICE})",
    "source_used": "lower(source_used) NOT IN ('not_found', 'not found')",
}
_ROWS = f"""SELECT *, {_SCORE} AS score, try_cast(CASE WHEN regexp_matches(stamp, '(?i)(z|[+-]\\d\\d:?\\d\\d)$') THEN stamp
    ELSE stamp || 'Z' END AS timestamptz) AS ts FROM (SELECT row_id, company_id, {', '.join(f'{_clean(c)} AS {c}' for c in _FIELDS)},
    lower({_clean('source_used')}) AS s, {_clean('last_updated')} AS stamp FROM enriched_companies WHERE company_id IN
    (SELECT company_id FROM enriched_companies GROUP BY company_id HAVING count(DISTINCT row_id) > 1)) e"""
_CELLS = " UNION ALL ".join(
    f"SELECT company_id, '{c}' AS column_name, row_id, score, ts FROM recs WHERE {c} IS NOT NULL AND {_USABLE[c]}" for c in _FIELDS
)

SQL: dict[str, str] = {
    "p1_found": f"""WITH recs AS ({_ROWS}) SELECT company_id, column_name, row_id FROM (SELECT *, row_number() OVER
        (PARTITION BY company_id, column_name ORDER BY score DESC, ts DESC NULLS LAST, row_id) AS n FROM ({_CELLS}) c) x WHERE n = 1"""
}
