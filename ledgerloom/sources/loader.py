"""Loading folders of delimited files with differing headers into the standard record, from any file system Spark knows.

One pass over the files' lines on the executors gives each file's header, its encoding and whether a record may go on over
a line break. Files of equal header, encoding and kind are one scan, and the scans are united by name. Only files with
quoted line breaks are read whole by one task; all others are split.

Defined results: files without a header or rows are skipped; unreadable files are listed as failed and loading goes on;
records with more fields than the header are dropped, shorter ones are padded with NULL; a file is read as UTF-8 if it is
valid UTF-8, else as ISO-8859-1; of two raw columns mapped to one standard column the mapped one wins and the loser is
kept as `<name>__raw2`; no file at all gives the empty standard table.
"""

from __future__ import annotations

import csv
import io
import logging
import re
from dataclasses import dataclass, field
from fnmatch import fnmatch
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.nulls import blank_to_null, clean_str
from ledgerloom.functions.text import company_id
from ledgerloom.operators.clean import ORD
from ledgerloom.runtime import all_files
from ledgerloom.schema import LOADED_SCHEMA, SOURCE_FILE, STANDARD_COLUMNS
from ledgerloom.sources.headers import column_mapping

log = logging.getLogger(__name__)


@dataclass
class Loaded:
    """What a load found, by file."""

    loaded: list[str] = field(default_factory=list)
    failed: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)

    def summary(self) -> dict:
        return {
            "loaded": len(self.loaded),
            "failed": len(self.failed),
            "loaded_files": list(self.loaded),
            "failed_files": list(self.failed),
        }


@dataclass(frozen=True)
class Found:
    """What a file is read by."""

    header: tuple[str, ...]
    encoding: str
    multi_line: bool


def _path_of(uri: Column) -> Column:
    """The plain path of a file's URI, as `list_files` gives it."""
    return F.url_decode(F.replace(F.regexp_replace(uri, "^file:/+", "/"), F.lit("+"), F.lit("%2B")))


def _escaped(path: str) -> str:
    """A path whose special characters stand for themselves."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def list_files(spark: SparkSession, folder: str, glob: str = "*.csv") -> list[tuple[str, int]]:
    """Path and length of all files below a folder, or of the file itself, in path order; no content is read."""
    found = ((re.sub("^file:/+", "/", path), size) for path, size in all_files(spark, folder))
    return sorted((path, size) for path, size in found if fnmatch(path.rsplit("/", 1)[-1], glob))


def probe(spark: SparkSession, paths: list[str]) -> dict[str, Found | None]:
    """Per readable file what it is read by; None where it has no header or no record. One row per file comes to the driver."""
    if not paths:
        return {}
    raw = spark.read.option("ignoreCorruptFiles", True).text([_escaped(p) for p in paths])
    at = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    lines = raw.select(_path_of(F.col("_metadata.file_path")).alias("path"), "value", at.alias("at"))
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 1
    per = lines.groupBy("path").agg(
        F.min_by(F.col("value").cast("binary"), "at").alias("head"),
        F.count(F.lit(1)).alias("n"),
        F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
        F.bool_or(odd).alias("open"),
    )
    out: dict[str, Found | None] = {}
    for r in per.collect():
        encoding = "UTF-8" if r["utf8"] else "ISO-8859-1"
        head = bytes(r["head"]).decode(encoding).lstrip("\ufeff")
        names = next(csv.reader(io.StringIO(head)), [])
        usable = any(n.strip() for n in names) and "\x00" not in head and r["n"] > 1
        out[r["path"]] = Found(tuple(names), encoding, r["open"]) if usable else None
    return out


def standardise(df: DataFrame, header: list[str]) -> DataFrame:
    """Raw columns (named c0, c1, ...) under their standard names; extras kept, missing ones NULL."""
    mapping = column_mapping(header)
    taken: dict[str, int] = {}
    mapped = {mapping[h] for h in header if h in mapping}
    out = []
    for i, h in enumerate(header):
        target = mapping.get(h, h.strip())
        if h not in mapping and target in mapped | {ORD, SOURCE_FILE}:
            target += "__raw2"
        taken[target.lower()] = taken.get(target.lower(), 0) + 1
        if taken[target.lower()] > 1:
            target = f"{target}__raw{taken[target.lower()]}"
        out.append(F.col(f"c{i}").alias(target))
    x = df.select(*out, SOURCE_FILE, ORD)
    have = {c.lower() for c in x.columns}
    return x.withColumns({c: F.lit(None).cast("string") for c in STANDARD_COLUMNS if c.lower() not in have})


def finish(df: DataFrame) -> DataFrame:
    """Blank text to NULL, ids where missing (from raw values), default status and score."""
    texts = [c for c, kind in df.dtypes if kind == "string"]
    x = df.withColumns({c: blank_to_null(F.col(f"`{c}`")) for c in texts})
    ids = company_id(F.col("name"), F.col("website"))
    x = x.withColumn("company_id", F.coalesce(clean_str(F.col("company_id")), ids))
    x = x.withColumn("status", F.coalesce("status", F.lit("NOT_FOUND")))
    x = x.withColumn("confidence_score", F.coalesce("confidence_score", F.lit("0")))
    extras = [c for c in df.columns if c not in (*STANDARD_COLUMNS, SOURCE_FILE, ORD)]
    return x.select(*STANDARD_COLUMNS, *[f"`{c}`" for c in extras], SOURCE_FILE, ORD)


_PLACE = 43  # bits of a row order below a file's place: more than any file's bytes


def _scan(spark: SparkSession, found: Found, places: dict[str, int]) -> DataFrame:
    """Records of the files in `places` (path to place in path order); the row order is the place and the row in it.

    A row's number in its task is less than the bytes of the task, and blocks of a file are as far apart as a task is large
    at most, so block start and row number add up to a rising number.
    """
    # one column more than the header catches records with too many fields
    names = [f"c{i}" for i in range(len(found.header))]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_over"]])
    raw = spark.read.csv(
        [_escaped(p) for p in places], schema=schema, header=True, enforceSchema=True, multiLine=found.multi_line, escape='"', quote='"', encoding=found.encoding
    )
    row = F.col("_metadata.file_block_start") + F.monotonically_increasing_id() % F.lit(1 << 33)
    raw = raw.select(*names, "_over", F.col("_metadata.file_name").alias(SOURCE_FILE), _path_of(F.col("_metadata.file_path")).alias("_path"), row.alias("_n"))
    at = spark.createDataFrame(list(places.items()), "_path string, _place bigint")
    x = raw.filter("_over IS NULL").join(at, "_path", "left")
    return x.withColumn(ORD, F.coalesce("_place", F.lit(0)) * F.lit(1 << _PLACE) + F.col("_n")).drop("_over", "_path", "_place", "_n")


def load_single(spark: SparkSession, path: str | Path) -> DataFrame | None:
    """One file in the standard schema, or None where it has no rows."""
    known = list_files(spark, str(path), "*")
    found = probe(spark, [p for p, size in known if size])
    p, one = next(iter(found.items()), (None, None))
    return None if one is None else standardise(_scan(spark, one, {p: 0}), list(one.header))


def load_all(spark: SparkSession, folder: str | Path) -> tuple[DataFrame, Loaded]:
    """All `*.csv` below a folder, in path order, as one table."""
    state, groups = Loaded(), {}
    files = list_files(spark, str(folder))
    probed = probe(spark, [p for p, size in files if size])
    for place, (path, size) in enumerate(files):
        name = path.rsplit("/", 1)[-1]
        if size and path not in probed:
            log.warning("cannot read %s", path)
            state.failed.append(name)
        elif not size or probed[path] is None:
            state.skipped.append(name)
        else:
            groups.setdefault(probed[path], {})[path] = place
            state.loaded.append(name)
    if not groups:
        return spark.createDataFrame([], LOADED_SCHEMA), state
    parts = [standardise(_scan(spark, found, places), list(found.header)) for found, places in groups.items()]
    x = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return finish(x), state


def load_summary(df: DataFrame) -> DataFrame:
    return df.groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("n_rows"))
