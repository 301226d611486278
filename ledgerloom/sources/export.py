"""Sinks: delimited export, checkpoints, and the column profile of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.nulls import clean_str
from ledgerloom.runtime import exists, join_files

BOM = b"\xef\xbb\xbf"


def drop_internal(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def export_csv(df: DataFrame, path: str, columns: list[str] | None = None, internal: bool = False, single: bool = False) -> str:
    """UTF-8, quotes where needed, NULL as nothing. Listed columns first, the others after them.

    `path` is a folder of parts with a header each, which is what a large table should have. `single` gives one file with a
    byte order mark, put together from the parts as bytes by the driver, for tables meant to be opened by hand.
    """
    x = df if internal else drop_internal(df)
    if columns:
        x = x.select(*[c for c in columns if c in x.columns], *[c for c in x.columns if c not in columns])
    parts = f"{path}.parts" if single else path
    x.write.mode("overwrite").csv(parts, header=not single, emptyValue="", nullValue="", escape='"')
    if single:
        head = BOM + ",".join(_quoted(c) for c in x.columns).encode() + b"\n"
        join_files(df.sparkSession, head, parts, path)
    return path


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"' if any(ch in name for ch in ',"\n') else name


def write_checkpoint(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def has_checkpoint(spark: SparkSession, path: str) -> bool:
    """True where a checkpoint was written to its end."""
    return exists(spark, f"{path}/_SUCCESS")


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """A parquet checkpoint, or a delimited one with the NA words as NULL."""
    if path.endswith(".csv"):
        raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
        clean = {c: F.when(F.col(c) != "<NA>", clean_str(F.col(c))) for c in raw.columns}
        return raw.withColumns(clean).withColumnsRenamed({raw.columns[0]: raw.columns[0].lstrip("﻿")})
    return spark.read.parquet(path)


def column_profile(df: DataFrame) -> DataFrame:
    """column_name, non_null, n_null, fill_pct, kind of every column, from one aggregation.

    Empty text and the words nan and None (in this spelling) count as nulls.
    """
    kinds = dict(df.dtypes)

    def there(c: str):
        col = F.col(f"`{c}`")
        return F.count_if(col.isNotNull() & ~col.cast("string").isin("", "nan", "None"))

    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[there(c).alias(f"n{i}") for i, c in enumerate(df.columns)])
    each = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("non_null"), F.lit(kinds[c]).alias("kind"))
            for i, c in enumerate(df.columns)
        ]
    )
    x = one.select("_rows", F.explode(each).alias("e")).select("_rows", "e.*")
    pct = F.when(F.col("_rows") > 0, F.round(100 * F.col("non_null") / F.col("_rows"), 1)).otherwise(F.lit(0.0))
    return x.select(
        "column_name", "non_null", (F.col("_rows") - F.col("non_null")).alias("n_null"), pct.alias("fill_pct"), "kind"
    )
