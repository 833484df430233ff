"""The density report: normalised records, ranking, summary and relative scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.functions import day_key, quoted_list, variety_ratio
from blotter.schema import CATEGORY_UNIVERSE, UNKNOWN

# --- fixed value
NO_HOTSPOT = "N/A"
# ---------------


def category_list(df: DataFrame, column: str) -> Column:
    """The distinct categories in first-seen order, from an array or from JSON text."""
    stored = F.col(column)
    if isinstance(df.schema[column].dataType, T.StringType):
        stored = quoted_list(stored)
    return F.array_distinct(stored)


def normalise_density(records: DataFrame, clock: Column) -> DataFrame:
    """Density rows of any writer, in one shape, with the variety recounted from the list.

    Missing columns get defaults; rows whose list or total cannot be read are dropped.
    """
    have = set(records.columns)

    def pick(name: str, default: Column) -> Column:
        return F.col(name) if name in have else default

    types = (
        category_list(records, "crime_types_list")
        if "crime_types_list" in have
        else F.array().cast("array<string>")
    )
    return (
        records.select(
            pick("district", F.lit(UNKNOWN)).alias("district"),
            pick("total_crimes", F.lit(0)).try_cast("bigint").alias("total_crimes"),
            pick("crime_density_score", F.lit(0.0))
            .try_cast("double")
            .alias("crime_density_score"),
            types.alias("crime_types_list"),
            pick("last_updated", clock).alias("last_updated"),
            pick("date_partition", day_key(clock)).cast("string").alias("date_partition"),
        )
        .where("total_crimes IS NOT NULL AND crime_types_list IS NOT NULL")
        .withColumn("crime_type_variety", F.size("crime_types_list").cast("bigint"))
    )


def rank_density(records: DataFrame) -> DataFrame:
    """Highest score first; equal scores by area, then date."""
    return records.orderBy(F.desc("crime_density_score"), "district", "date_partition")


def density_summary(records: DataFrame) -> DataFrame:
    """One row: totals, mean and highest score, row count and the hotspot.

    Every measure has a partial form, so the shuffle carries one row per task. The hotspot
    is the first row of ``rank_density``.
    """
    score = F.col("crime_density_score")
    # Minimum of the ranking key: highest score, then area, then date.
    first = F.min(F.struct(-score, "district", "date_partition"))
    return records.agg(
        F.coalesce(F.sum("total_crimes"), F.lit(0)).alias("total_crimes"),
        F.coalesce(F.round(F.avg(score), 2), F.lit(0.0)).alias("avg_density"),
        F.coalesce(F.round(F.max(score).cast("double"), 2), F.lit(0.0)).alias("max_density"),
        F.count(F.lit(1)).alias("districts_analyzed"),
        F.coalesce(first["district"], F.lit(NO_HOTSPOT)).alias("hotspot"),
    )


def hotspot(records: DataFrame) -> DataFrame:
    """The first row of the ranking."""
    return rank_density(records).limit(1)


def relative_density(records: DataFrame, universe: int = CATEGORY_UNIVERSE) -> DataFrame:
    """Each score as a percentage of the highest one, and the variety as ``n/universe``.

    The maximum is a scalar subquery with partial aggregation, so no task sees all rows.
    It reads ``records`` a second time: pass a stored table or a cut lineage.
    """
    highest = records.agg(F.max("crime_density_score").alias("highest")).scalar()
    percent = F.col("crime_density_score") / highest * 100
    return records.select(
        "*",
        F.when(highest > 0, percent).otherwise(F.lit(0.0)).alias("density_percent"),
        variety_ratio(F.col("crime_type_variety"), universe).alias("variety_ratio"),
    )


def density_view(records: DataFrame) -> DataFrame:
    """The report rows in ranking order."""
    return rank_density(records).select(
        "district",
        "total_crimes",
        "crime_type_variety",
        "crime_density_score",
        "crime_types_list",
        "last_updated",
        "date_partition",
    )
