"""Threshold alerts and the alert feed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions import age_label, age_seconds, area_from_message, severity_label
from blotter.operators.cells import COUNT, LAST
from blotter.schema import ALERT_THRESHOLDS, NAMES, UNKNOWN, Names
from blotter.session import lookup_table

# --- fixed values
CRITICAL_LEVEL = "CRITICAL"
MESSAGE_PARTS = ("ALERTA: ", " casos de ", " en ")
DEFAULT_MESSAGE = "Security alert in "
# ---------------

_LIMIT = "__limit"


def evaluate_thresholds(
    cells: DataFrame,
    thresholds: Mapping[str, int] | DataFrame = ALERT_THRESHOLDS,
    names: Names = NAMES,
    critical_only: bool = False,
) -> DataFrame:
    """Mark cells whose count reaches the threshold of their category.

    ``thresholds`` is a mapping, or a table of (category, threshold) that is joined by its
    own size. Categories without a threshold are never critical.
    """
    if isinstance(thresholds, DataFrame):
        limits = thresholds.toDF(names.category, _LIMIT)
    else:
        limits = lookup_table(cells.sparkSession, thresholds, names.category, _LIMIT)
    joined = cells.join(limits, names.category, "inner" if critical_only else "left")
    reached = F.coalesce(F.col(COUNT) >= F.col(_LIMIT), F.lit(False))
    if critical_only:
        joined, reached = joined.where(reached), F.lit(True)
    return joined.select(
        *[
            F.col(c)
            for c in cells.columns
            if c not in (COUNT, LAST)
        ],
        F.col(COUNT).alias("crime_count"),
        F.col(LAST).alias("alert_time"),
        reached.alias("is_critical"),
    )


def alert_message(names: Names = NAMES) -> Column:
    lead, of, place = MESSAGE_PARTS
    return F.concat(
        F.lit(lead),
        F.col("crime_count").cast("string"),
        F.lit(of),
        F.col(names.category),
        F.lit(place),
        F.col(names.area),
    )


def critical_alerts(
    cells: DataFrame,
    thresholds: Mapping[str, int] | DataFrame = ALERT_THRESHOLDS,
    names: Names = NAMES,
) -> DataFrame:
    """The critical cells with level and message."""
    return evaluate_thresholds(cells, thresholds, names, critical_only=True).select(
        "*",
        F.lit(CRITICAL_LEVEL).alias("alert_level"),
        alert_message(names).alias("alert_message"),
    )


def _column(df: DataFrame, name: str) -> Column | None:
    """The column of that name in any letter case, if the table has one."""
    for column in df.columns:
        if column.lower() == name.lower():
            return F.col(f"`{column}`")
    return None


def _or_default(df: DataFrame, name: str, default: Column) -> Column:
    """The column where the table has it; the default only where it does not."""
    column = _column(df, name)
    return default if column is None else column


def _filled(df: DataFrame, name: str) -> Column:
    """The column with empty text turned into null; null where the table has none."""
    column = _column(df, name)
    return F.lit(None).cast("string") if column is None else F.nullif(column, F.lit(""))


def normalise_alerts(
    alerts: DataFrame, clock: Column, alert_id: Column | None = None, names: Names = NAMES
) -> DataFrame:
    """Alert rows of any writer, in one shape.

    Column names match in any letter case, missing columns get defaults, and a missing area
    is read from the message. Rows without a readable count are dropped, as are rows that
    need their area from a message that is null. ``clock`` is the arrival time. The default
    id names date, area, category and time, so the same alert read twice keeps its id.
    """
    area, message = _filled(alerts, names.area), _or_default(alerts, "alert_message", F.lit(""))
    category = F.coalesce(_filled(alerts, names.category), F.lit(UNKNOWN))
    known = F.nullif(area, F.lit(UNKNOWN))
    shaped = alerts.select(
        F.coalesce(known, area_from_message(message)).alias("district"),
        category.alias("crime_type"),
        _or_default(alerts, "crime_count", F.lit(0)).try_cast("bigint").alias("crime_count"),
        _or_default(alerts, "alert_level", F.lit(CRITICAL_LEVEL)).alias("alert_level"),
        _or_default(alerts, "alert_message", F.lit(None).cast("string")).alias("alert_message"),
        _or_default(alerts, "alert_time", clock).cast("string").alias("alert_time"),
        F.coalesce(
            _or_default(alerts, "is_critical", F.lit(True)).cast("boolean"), F.lit(False)
        ).alias("is_critical"),
        clock.alias("added_at"),
        *([alert_id.alias("id")] if alert_id is not None else []),
    ).where("crime_count IS NOT NULL AND district IS NOT NULL")
    if _column(alerts, "alert_message") is None:
        shaped = shaped.withColumn(
            "alert_message", F.concat(F.lit(DEFAULT_MESSAGE), F.col("district"))
        )
    if alert_id is None:
        shaped = shaped.withColumn(
            "id", F.concat_ws("-", F.lit("ALERT"), "district", "crime_type", "alert_time")
        )
    return shaped.select(
        "id",
        "district",
        "crime_type",
        "crime_count",
        "alert_level",
        "alert_message",
        "alert_time",
        "is_critical",
        "added_at",
    )


def alert_view(live_alerts: DataFrame, reference: Column) -> DataFrame:
    """The feed rows: critical first, then newest, with ages and labels."""
    age = age_seconds(F.col("added_at"), reference)
    return live_alerts.orderBy(F.desc("is_critical"), F.desc("added_at"), "id").select(
        "id",
        "district",
        "crime_type",
        "crime_count",
        "alert_level",
        "alert_message",
        "alert_time",
        "is_critical",
        age.alias("time_ago"),
        age_label(age).alias("time_ago_label"),
        severity_label(F.col("is_critical")).alias("severity"),
    )


def alert_counts(alerts: DataFrame) -> DataFrame:
    """Rows in the feed, and the critical ones among them."""
    return alerts.agg(
        F.count(F.lit(1)).alias("count"), F.count_if("is_critical").alias("critical_count")
    )
