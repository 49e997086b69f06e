"""The per-document operators on a stream of texts, and late-tolerant counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators import fragments as fr

SCHEMA = "license STRING, source STRING, text STRING, loaded_at TIMESTAMP"


def read_stream(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    """A stream over Parquet files that land in a folder."""
    return spark.readStream.schema(schema).parquet(path)


def fragment_stream(docs: DataFrame, label: str = "license", text: str = "text", max_width: int | None = None) -> DataFrame:
    """Windows and paragraphs of each text as it arrives; needs no state."""
    return fr.all_fragments(docs, [label], text, max_width)


def count_stream(docs: DataFrame, label: str = "license", time: str = "loaded_at", late: str = "2 days", width: str = "1 day") -> DataFrame:
    """Documents by label and time window; rows up to ``late`` behind the newest still count, state beyond that is dropped."""
    return docs.withWatermark(time, late).groupBy(F.window(time, width), label).agg(F.count("*").alias("count")).select(F.col("window.start").alias("start"), label, "count")
