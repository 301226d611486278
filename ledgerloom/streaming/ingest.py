"""Incremental ingest: records arriving as files are normalised and scored batch by batch.

Normalisers and scores are row expressions, so the batch code runs on a stream as it is. Exact duplicates of the stream
are dropped by key within the watermark; entity resolution needs the whole table and stays a batch step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerloom.operators.clean import coerce_and_trim, normalise
from ledgerloom.operators.score import score_dataframe
from ledgerloom.schema import Settings


def read_stream(spark: SparkSession, folder: str, schema: StructType, kind: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).format(kind).load(folder)


def scored_stream(
    records: DataFrame, settings: Settings | None = None, time: str | None = None, late: str = "1 day"
) -> DataFrame:
    """Normalised and scored records; with a time column, repeated ids within `late` are dropped."""
    x = normalise(coerce_and_trim(records))
    if time:
        x = x.withWatermark(time, late).dropDuplicatesWithinWatermark(["company_id"])
    return score_dataframe(x, settings)


def write_stream(df: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (w.trigger(availableNow=True) if once else w).start()
