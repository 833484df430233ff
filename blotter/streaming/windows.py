"""Event-time windows that a watermark finishes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.operators.alerts import critical_alerts
from blotter.operators.cells import COUNT, LAST
from blotter.schema import NAMES, Names


def finished_windows(
    records: DataFrame, width_seconds: int, delay_seconds: int = 0, names: Names = NAMES
) -> DataFrame:
    """A stream of window cells, each once, when the watermark has passed its window's end.

    Spark's own streaming aggregation keeps one small state row per open window, area and
    category; rows without a clock are left out, rows behind the watermark are late.
    """
    clock = F.col(names.clock).cast("timestamp")
    timed = records.withColumn("__time", clock).where(F.col("__time").isNotNull())
    counted = (
        timed.withWatermark("__time", f"{delay_seconds} seconds")
        .groupBy(
            F.window("__time", f"{width_seconds} seconds").alias("__window"),
            names.area,
            names.category,
        )
        .agg(F.count(F.lit(1)).alias(COUNT), F.max("__time").alias(LAST))
    )
    return counted.select(
        F.col("__window.start").alias("window_start"), names.area, names.category, COUNT, LAST
    )


def finished_alerts(
    records: DataFrame,
    width_seconds: int,
    thresholds: Mapping[str, int] | DataFrame,
    delay_seconds: int = 0,
    names: Names = NAMES,
) -> DataFrame:
    """A stream of the critical alerts of finished windows, each window once."""
    return critical_alerts(finished_windows(records, width_seconds, delay_seconds, names), thresholds)
