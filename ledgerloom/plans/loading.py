"""Queries of loading: files with differing headers, header mapping and the standard record's defaults, and their SQL."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.nulls import SPACES
from ledgerloom.functions.records import header_names
from ledgerloom.operators.clean import ORD
from ledgerloom.runtime import shared_dir, table
from ledgerloom.schema import SOURCE_FILE, STANDARD_COLUMNS
from ledgerloom.sources.headers import COLUMN_ALIASES, aliases, column_mapping, plain
from ledgerloom.sources.loader import Loaded, finish, load_all, standardise

# What three senders' files hold, in text that both engines run.
CUSTOMERS = """SELECT 'Firm ' || c_custkey || ', "' || c_mktsegment || '"' AS company_name, 'www.Firm' || c_custkey || '.com' AS domain,
  CASE WHEN c_custkey % 10 = 0 THEN 'two' || chr(10) || 'lines' WHEN c_custkey % 10 = 1 THEN '  ' ELSE '-' END AS notes FROM {customer}"""
SUPPLIERS = "SELECT 'Société ' || s_suppkey AS organisation, 'http://S' || s_suppkey || '.fr/x' AS homepage FROM {supplier}"
NATIONS = "SELECT n_name AS company_name, 'nation ' || n_nationkey AS name, 'n/a' AS phone FROM {nation}"


def _loaded(spark: SparkSession, d: str) -> tuple[DataFrame, Loaded]:
    """The files as they come in: written one by one, then loaded as a folder."""
    folder = f"{shared_dir(spark)}/in-{uuid.uuid4().hex}"
    options = dict(header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    for name, sql, encoding in (("customer", CUSTOMERS, "UTF-8"), ("supplier", SUPPLIERS, "ISO-8859-1"), ("nation", NATIONS, "UTF-8")):
        rows = spark.sql(sql, **{name: table(spark, d, name)})
        rows.coalesce(1).write.csv(f"{folder}/{name}", encoding=encoding, **options)
    spark.sql(NATIONS, nation=table(spark, d, "nation")).limit(0).coalesce(1).write.csv(f"{folder}/none", **options)
    return load_all(spark, folder)


def load_files(spark: SparkSession, d: str) -> DataFrame:
    return _loaded(spark, d)[0].drop(ORD, SOURCE_FILE)


def load_report(spark: SparkSession, d: str) -> DataFrame:
    df, state = _loaded(spark, d)
    s = state.summary()
    files = spark.createDataFrame([(s["loaded"], s["failed"], len(state.skipped))], "loaded int, failed int, skipped int")
    rows = df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(SOURCE_FILE).cast("int").alias("n_sources"))
    return files.join(F.broadcast(rows))  # one row each


def header_columns(spark: SparkSession, d: str) -> DataFrame:
    """Every header name of the batch files with its plain form and the standard column it would be loaded as."""
    files = table(spark, d, "batch_files")
    names = files.select(F.explode(header_names(F.col("header_line"), F.col("delimiter"))).alias("header")).distinct()

    @F.pandas_udf("plain string, standard string")
    def mapped(header: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(plain(h), column_mapping([h]).get(h)) for h in header], columns=["plain", "standard"])

    return names.select("header", mapped("header").alias("m")).select("header", "m.*")


BATCHES = {
    "batch_01_standard": ("company_name", "website", "linkedin_url"),
    "batch_02_messy": ("input-company-name", "input-company-domain", "linked_in", "contact_email"),
}


def standard_records(spark: SparkSession, d: str) -> DataFrame:
    """The records of both batch families in the standard schema: renamed, missing columns added, ids and defaults set."""
    out = None
    for name, header in BATCHES.items():
        raw = table(spark, d, name).select(
            *[F.col(f"`{h}`").alias(f"c{i}") for i, h in enumerate(header)], F.col("file_id").cast("string").alias(SOURCE_FILE), F.col("line_id").alias(ORD)
        )
        one = standardise(raw, list(header))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return finish(out).withColumnRenamed(ORD, "line_id")


QUERIES = {f.__name__: f for f in (load_files, load_report, header_columns, standard_records)}


def _blank(x: str) -> str:
    return f"CASE WHEN trim({x}, {' || '.join(f'chr({ord(ch)})' for ch in SPACES)}) <> '' THEN {x} END"


def _standard(have: dict[str, str], more: tuple[str, ...] = ()) -> str:
    """The standard columns of a row set that has some of them."""
    name, website = (f"coalesce({c}, '')" if c in have else "''" for c in ("name", "website"))
    key = f"md5(lower(trim({name})) || '|' || lower(trim({website})))"
    own = {
        "company_id": "||'-'||".join(f"substr({key}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))),
        "status": "'NOT_FOUND'",
        "confidence_score": "'0'",
    }
    cols = [f"{own.get(c) or (c if c in have else 'NULL::varchar')} AS {c}" for c in STANDARD_COLUMNS]
    return ", ".join([*cols, *more])


def _files_sql() -> str:
    parts = (
        (CUSTOMERS, {"name": "company_name", "website": "domain"}, {"notes": "notes"}),
        (SUPPLIERS, {"name": "organisation", "website": "homepage"}, {}),
        (NATIONS, {"name": "company_name", "phone": "phone"}, {"name__raw2": "name"}),
    )
    out = []
    for sql, columns, extra in parts:
        inner = ", ".join(f"{_blank(raw)} AS {c}" for c, raw in {**columns, **extra}.items())
        more = tuple(f"{c if c in extra else 'NULL::varchar'} AS {c}" for c in ("notes", "name__raw2"))
        named = sql.format(customer="customer", supplier="supplier", nation="nation")
        out.append(f"SELECT {_standard(columns, more)} FROM (SELECT {inner} FROM ({named}) a) b")
    return " UNION ALL ".join(out)


def _records_sql() -> str:
    out = []
    for name, header in BATCHES.items():
        names = column_mapping(list(header))
        inner = ", ".join(f'{_blank(f'"{h}"')} AS {names[h]}' for h in header)
        more = ("file_id::varchar AS _source_file", "line_id")
        out.append(f"SELECT {_standard({v: v for v in names.values()}, more)} FROM (SELECT {inner}, file_id, line_id FROM {name}) b")
    return " UNION ALL ".join(out)


_ALIASES = ", ".join(f"({i}, '{c}', '{a}')" for i, c in enumerate(COLUMN_ALIASES) for a in aliases(c))
_NAMES = "SELECT DISTINCT trim(h, '\"') AS header FROM (SELECT unnest(string_split(ltrim(header_line, chr(65279)), delimiter)) AS h FROM batch_files) x"

SQL: dict[str, str] = {
    "load_files": _files_sql(),
    "load_report": "SELECT 3 AS loaded, 0 AS failed, 1 AS skipped, (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier)"
    " + (SELECT count(*) FROM nation) AS n_rows, 3 AS n_sources",
    # with one name, the last column of the table that has an alias in it gets the name
    "header_columns": f"""SELECT header, plain, arg_max(c, i) AS standard FROM (SELECT header, replace(replace(lower(trim(header)), '-', '_'), ' ', '_')
        AS plain FROM ({_NAMES}) n) p LEFT JOIN (VALUES {_ALIASES}) v(i, c, a) ON contains(plain, a) GROUP BY ALL""",
    "standard_records": _records_sql(),
}
