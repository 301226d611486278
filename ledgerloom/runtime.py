"""Session helpers: table reading and lineage cuts that survive the loss of an executor."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Read from the session; where none is set, local mode alone gets a local one."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    fallback = os.path.join(tempfile.gettempdir(), f"ledgerloom-{os.getpid()}")
    os.makedirs(fallback, exist_ok=True)
    spark.conf.set("spark.checkpoint.dir", f"file://{fallback}")
    return f"file://{fallback}"


_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """For actions within: stages of more code than the JVM compiles (8000 bytes a method) run operator by operator.

    Spark's own limit is eight times as high, and what lies between is interpreted, at twice the time.
    """
    before = spark.conf.get(_METHOD_LIMIT, None)
    spark.conf.set(_METHOD_LIMIT, "8000")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_METHOD_LIMIT)
        else:
            spark.conf.set(_METHOD_LIMIT, before)


def cut(df: DataFrame, *by: str) -> DataFrame:
    """Cut the lineage: write df to the shared folder once and read it back. `by`: columns with a folder per value.

    The files go when the session ends, or by `discard`."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    w = df.write.option("compression", "zstd")
    with small_methods(spark):
        (w.partitionBy(*by) if by else w).parquet(path)
    fs, at = _place(spark, path)
    fs.deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def discard(df: DataFrame) -> None:
    """Remove what `cut` wrote for df; df and all that is built on it can't be read any more."""
    remove(df.sparkSession, df._cut_path)


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _place(spark, path)
    fs.delete(at, True)


def _place(spark: SparkSession, path: str):
    """The path's file system and the path for it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _place(spark, path)
    return fs.exists(at)


def all_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Path and length of every file below a folder."""
    fs, at = _place(spark, folder)
    found, out = fs.listFiles(at, True), []
    while found.hasNext():
        status = found.next()
        out.append((status.getPath().toString(), status.getLen()))
    return out


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file on any file system Spark knows."""
    fs, at = _place(spark, path)
    out = fs.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def join_files(spark: SparkSession, head: bytes, folder: str, path: str) -> None:
    """One file from a first piece and all parts in a folder, in the order of their names, copied as bytes; the folder goes."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs, parts = _place(spark, folder)
    to, at = _place(spark, path)
    out = to.create(at, True)
    try:
        out.write(bytearray(head))
        for status in sorted(fs.listStatus(parts), key=lambda s: s.getPath().getName()):
            if status.getPath().getName().startswith("part-"):
                src = fs.open(status.getPath())
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(src, out, conf, False)
                src.close()
    finally:
        out.close()
    fs.delete(parts, True)
