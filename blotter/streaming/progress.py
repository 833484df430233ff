"""Rows per trigger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from blotter.functions import time_bucket
from blotter.schema import NAMES, TRIGGER_SECONDS


def batch_volume(
    records: DataFrame, clock: str = NAMES.clock, trigger_seconds: int = TRIGGER_SECONDS
) -> DataFrame:
    """Rows per trigger interval, from stored records."""
    bucket = time_bucket(F.col(clock), trigger_seconds).alias("trigger_start")
    return records.groupBy(bucket).agg(F.count(F.lit(1)).alias("record_count"))


def recent_volume(query: StreamingQuery) -> list[dict]:
    """Batch id, time and input rows of the recent triggers of a running query."""
    return [
        {
            "batch_id": progress.batchId,
            "timestamp": progress.timestamp,
            "input_rows": progress.numInputRows,
        }
        for progress in query.recentProgress
    ]
