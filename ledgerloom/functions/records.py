"""Splitting delimited records and headers, quote-aware, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _field(delimiter: Column) -> Column:
    """Pattern of one field: quoted with inner quotes doubled, or plain text that doesn't start with a quote.

    All repeats are possessive, so matching neither backtracks nor recurses on long records.
    """
    return F.concat(F.lit(r'(?:"[^"]*+(?:""[^"]*+)*+"|(?!")[^\Q'), delimiter, F.lit(r"\E]*+)"))


def well_quoted(line: Column, delimiter: Column) -> Column:
    """True where every field that starts with a quote ends with one directly before the delimiter or the end."""
    f, d = _field(delimiter), F.concat(F.lit(r"\Q"), delimiter, F.lit(r"\E"))
    return F.rlike(line, F.concat(F.lit(r"\A"), f, F.lit("(?:"), d, f, F.lit(r")*+\z")))


def split_record(line: Column, delimiter: Column) -> Column:
    """Fields of a well-quoted record, without their quotes."""
    pattern = F.concat(F.lit(r"\Q"), delimiter, F.lit(r"\E("), _field(delimiter), F.lit(")"))
    raw = F.regexp_extract_all(F.concat(delimiter, line), pattern, F.lit(1))
    return F.transform(
        raw,
        lambda x: F.when(
            x.startswith('"'), F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))
        ).otherwise(x),
    )


def header_names(header: Column, delimiter: Column) -> Column:
    """Names of a header line, without byte order mark and quotes."""
    return split_record(F.regexp_replace(header, r"^\x{FEFF}", ""), delimiter)


# What a column holds, by its name (case, blanks and punctuation don't count). The whole name must fit; first match wins.
# Kept apart from the loader's alias table: this one also knows fields outside the standard record.
OWNER = "(?:company|contact|business|firm|account|organi[sz]ation|input|inputcompany|our|official|main)?"
FIELD_WORDS = (
    ("email", "e?mail(?:s|id|address|addresses)?"),
    ("linkedin", "linkedin(?:url|link|page|profile|company|address)?|liurl|liprofile|li"),
    ("facebook", "(?:facebook|fb)(?:url|link|page|profile)?"),
    ("twitter", "(?:twitter|x)(?:url|link|page|profile|handle)|twitter"),
    ("instagram", "(?:instagram|ig)(?:url|link|page|profile|handle)?"),
    ("employees", "(?:num|no|number|count)?(?:of)?(?:employees?|staff|headcount)(?:count|number|size)?|size"),
    ("founded", "founded(?:in|year|on|date)?|founding(?:year|date)|established(?:in|year|on)?|year(?:founded|established|offounding)"),
    ("turnover", "(?:annual)?(?:turnover|revenues?|sales)(?:m?(?:usd|eur|gbp)|in[a-z]{3})?"),
    ("active", "(?:is|still|currently)?(?:active|trading|live)"),
    ("phone", "(?:tele)?phone(?:no|number|numbers)?|tel|telno|mobile(?:no|number|phone)?|contactnumber"),
    ("description", "(?:short|long)?description|about(?:us)?|overview|summary|bio"),
    ("industry", "industry(?:type|name)?|sector|vertical"),
    ("ceo", "ceo(?:name)?|chiefexecutive(?:officer)?"),
    ("founder", "(?:co)?founders?(?:name|names)?"),
    ("website", "web(?:site|page|address|siteaddress|siteurl|domain|url)?|(?:home)?page(?:url)?|homepage(?:url)?|domain(?:name)?|url|site(?:url)?"),
    ("name", "(?:legal|trading|full|registered)?name|firm|organi[sz]ation|company|account"),
)


def header_field(name: Column) -> Column:
    """The field that a header name stands for, or NULL where it's unknown."""
    key = F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]+", "")
    out = F.when(F.lit(False), "")
    for field, words in FIELD_WORDS:
        out = out.when(key.rlike(rf"^{OWNER}(?:{words})$"), field)
    return out
