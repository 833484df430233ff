"""Writing keyed rows to a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_topic(rows: DataFrame, servers: str, topic: str) -> None:
    """Append key and value rows to a topic; needs the Kafka connector on the class path."""
    (
        rows.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .mode("append")
        .save()
    )
