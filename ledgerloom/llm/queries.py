"""Queries of the operators for text and training data, over whole tables and whole texts."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import canonical, incremental, mojibake, packing, reading, survivors, tokens
from ledgerloom.runtime import table

# The country code of the numbers in the data.
COUNTRY_CODES = ("999",)
VOCABULARY = os.environ.get("LEDGERLOOM_VOCABULARY", tokens.DEFAULT_VOCABULARY)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    s = survivors.survivors(table(spark, d, "enriched_companies"), undated="oldest")
    return s.select("company_id", "column_name", "row_id")


def p1_representatives(spark: SparkSession, d: str) -> DataFrame:
    return survivors.representatives(table(spark, d, "enriched_companies"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.find_garbled(table(spark, d, "enriched_companies"))


def p5_restored(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.restore(table(spark, d, "enriched_companies"))


def p5_ways(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.ways_found(table(spark, d, "enriched_companies"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return incremental.dedupe_batches(table(spark, d, "enriched_companies"), table(spark, d, "incoming_companies"), COUNTRY_CODES)


def _mapped(spark: SparkSession, d: str) -> DataFrame:
    return canonical.map_values(table(spark, d, "enriched_companies"), table(spark, d, "reference_values"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _mapped(spark, d).select("row_id", "column_name", "ref_id")


def p7_misses(spark: SparkSession, d: str) -> DataFrame:
    return canonical.misses(_mapped(spark, d))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_documents(table(spark, d, "documents"), VOCABULARY)


def _packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents"), table(spark, d, "container_specs"), VOCABULARY)


def p9_packed(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d)


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(_packed(spark, d))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = table(spark, d, "documents"), table(spark, d, "reading_labels")
    model = reading.fit(docs, labels)
    todo = docs.filter(F.lower("lang").startswith("en") & (F.col("n_chars") >= 400))
    # the labels' ids are a small part of the documents': an anti join on ids, before any text is scored
    todo = todo.join(labels.select("doc_id"), "doc_id", "left_anti")
    return reading.reading_levels(todo, model)


QUERIES = {
    f.__name__: f
    for f in (
        p1_found,
        p1_representatives,
        p5_found,
        p5_restored,
        p5_ways,
        p6_found,
        p7_found,
        p7_misses,
        p8_ids,
        p9_packed,
        p9_report,
        p10_found,
    )
}
