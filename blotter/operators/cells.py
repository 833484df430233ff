"""Count cells: the one aggregation of the facts that every rollup derives from.

A cell holds a count and the newest clock value, so partial aggregation shrinks each task
to at most one row per cell before the shuffle, however hot a single area or category is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions import time_bucket
from blotter.schema import NAMES, Names

COUNT = "n"
LAST = "last_time"
_DAY = "__day"


def _count(df: DataFrame, keys: list[Column], clock: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(COUNT), F.max(clock).alias(LAST))


def day_of(records: DataFrame, names: Names = NAMES) -> Column:
    """The stored date of the records as a date, or else that of their clock."""
    if names.date in records.columns:
        return F.col(names.date).try_cast("date")
    return F.to_date(names.clock)


def hour_cells(
    records: DataFrame, names: Names = NAMES, by: Sequence[str] = ()
) -> DataFrame:
    """One row per date, area, category and hour, straight from the facts.

    The date is the stored one where the records have it, so that facts stay on the day they
    were written under; else it follows from the clock. ``by`` names more columns to keep the
    cells apart by, such as a batch.
    """
    clock = F.col(names.clock)
    # Grouping on the date and hour as integers; the weekday follows from the date.
    cells = _count(
        records,
        [
            day_of(records, names).alias(_DAY),
            F.col(names.area),
            F.col(names.category),
            F.hour(clock).alias("hour"),
            *[F.col(c) for c in by],
        ],
        names.clock,
    )
    return cells.select(
        F.col(_DAY).cast("string").alias(names.date),
        names.area,
        names.category,
        "hour",
        F.dayofweek(_DAY).alias("day_of_week"),
        *by,
        COUNT,
        LAST,
    )


def day_cells(records: DataFrame, names: Names = NAMES) -> DataFrame:
    """One row per date, area and category, straight from the facts."""
    cells = _count(
        records,
        [day_of(records, names).alias(_DAY), F.col(names.area), F.col(names.category)],
        names.clock,
    )
    return cells.select(
        F.col(_DAY).cast("string").alias(names.date), names.area, names.category, COUNT, LAST
    )


def window_cells(records: DataFrame, width_seconds: int, names: Names = NAMES) -> DataFrame:
    """One row per tumbling window, area and category; the explicit form of a micro-batch."""
    return _count(
        records,
        [
            time_bucket(F.col(names.clock), width_seconds).alias("window_start"),
            F.col(names.area),
            F.col(names.category),
        ],
        names.clock,
    )


def _fold(cells: DataFrame, keys: list[str]) -> DataFrame:
    return cells.groupBy(*keys).agg(F.sum(COUNT).alias(COUNT), F.max(LAST).alias(LAST))


def merge_cells(cells: DataFrame, names: Names = NAMES) -> DataFrame:
    """Hour cells of many batches, folded to one row per hour cell."""
    return _fold(cells, [names.date, names.area, names.category, "hour", "day_of_week"])


def fold_to_days(cells: DataFrame, names: Names = NAMES) -> DataFrame:
    """Hour cells folded to day cells."""
    return _fold(cells, [names.date, names.area, names.category])
