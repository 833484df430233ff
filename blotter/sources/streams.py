"""Streams of keyed JSON rows: a topic, or files with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from blotter.schema import SOURCE_SCHEMA


def topic_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    max_rows_per_batch: int | None = None,
) -> dict[str, str]:
    """Reader options of a topic subscription."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_rows_per_batch:
        options["maxOffsetsPerTrigger"] = str(max_rows_per_batch)
    return options


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """A streaming frame over a topic; needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**options).load()


def read_file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = SOURCE_SCHEMA,
    max_files_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    """A streaming frame over Parquet files that arrive in a folder."""
    reader = spark.readStream.schema(schema).options(**options)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.parquet(path)
