"""The rollup tables, each derived from count cells instead of from the facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions import density_score, diversity_index
from blotter.operators.cells import COUNT, LAST, day_of
from blotter.schema import CATEGORY_UNIVERSE, NAMES, Names

REPORTERS = "reporters_seen"
# A sketch of 2^13 registers: a standard error of about one percent.
SKETCH_BITS = 13


def statistics(day_cells: DataFrame, names: Names = NAMES) -> DataFrame:
    """Count and newest time per date, area and category."""
    return day_cells.select(
        names.date,
        names.area,
        names.category,
        F.col(COUNT).alias("crime_count"),
        F.col(LAST).alias("last_updated"),
    )


def temporal_profile(hour_cells: DataFrame, names: Names = NAMES) -> DataFrame:
    """Count per hour and weekday. The mean hour of an hour cell is the hour itself."""
    return hour_cells.select(
        names.date,
        names.area,
        names.category,
        "hour",
        "day_of_week",
        F.col(COUNT).alias("crimes_per_hour"),
        F.col("hour").cast("double").alias("avg_hour"),
        F.col(LAST).alias("last_crime_time"),
    )


def density(day_cells: DataFrame, names: Names = NAMES) -> DataFrame:
    """Total, variety and score per date and area.

    Day cells hold each category once, so the variety is a plain count and the lists have
    one entry per category: ``crime_type_counts`` is the whole bag of categories with its
    multiplicities, ``crime_types_list`` its distinct values, both in category order. The
    same counts row by row, for vocabularies too large for a list, are the statistics.
    """
    known = F.when(
        F.col(names.category).isNotNull(),
        F.struct(F.col(names.category).alias("category"), F.col(COUNT).alias("n")),
    )
    return (
        day_cells.groupBy(names.date, names.area)
        .agg(
            F.sum(COUNT).alias("total_crimes"),
            F.count(names.category).alias("crime_type_variety"),
            F.sort_array(F.collect_list(known)).alias("crime_type_counts"),
            F.max(LAST).alias("last_updated"),
        )
        .select(
            names.date,
            names.area,
            "total_crimes",
            "crime_type_variety",
            F.col("crime_type_counts.category").alias("crime_types_list"),
            "crime_type_counts",
            "last_updated",
            density_score(F.col("total_crimes"), F.col("crime_type_variety")).alias(
                "crime_density_score"
            ),
        )
    )


def category_bag(day_cells: DataFrame, chunk: int = 10_000, names: Names = NAMES) -> DataFrame:
    """The bag of categories with one list element per incident, in bounded chunks.

    A single array per date and area would grow with the incidents; here each row holds at
    most ``chunk`` elements and the rows of a hot cell are spread before they are filled.
    """
    chunks = day_cells.where(F.col(names.category).isNotNull()).select(
        names.date,
        names.area,
        names.category,
        F.explode(
            F.sequence(F.lit(0), F.floor((F.col(COUNT) - 1) / chunk).cast("int"))
        ).alias("chunk_no"),
        F.col(COUNT),
    )
    spread = chunks.repartition(names.date, names.area, names.category, "chunk_no")
    size = F.least(F.lit(chunk), F.col(COUNT) - F.col("chunk_no").cast("bigint") * chunk)
    return spread.select(
        names.date,
        names.area,
        names.category,
        "chunk_no",
        F.array_repeat(names.category, size.cast("int")).alias("crime_types_list"),
    )


def correlation(
    day_cells: DataFrame, universe: int = CATEGORY_UNIVERSE, names: Names = NAMES
) -> DataFrame:
    """Categories seen together in an area on a day, with the diversity index."""
    return (
        day_cells.groupBy(names.date, names.area)
        .agg(
            F.sort_array(F.collect_list(names.category)).alias("crime_types_in_area"),
            F.sum(COUNT).alias("total_crimes_in_area"),
            F.count(names.category).alias("unique_crime_types"),
            F.max(LAST).alias("last_updated"),
        )
        .withColumn(
            "crime_diversity_index", diversity_index(F.col("unique_crime_types"), universe)
        )
    )


def _reporter_keys(records: DataFrame, names: Names) -> list[Column]:
    return [day_of(records, names).cast("string").alias(names.date), F.col(names.area), F.col(names.category)]


def reporter_counts(records: DataFrame, names: Names = NAMES) -> DataFrame:
    """Distinct reporters per date, area and category, instead of a list of them.

    The date is the stored one where the records have it, as in all other rollups. The distinct
    is taken on (cell, reporter) first, so a hot cell spreads over reporters.
    """
    return records.groupBy(*_reporter_keys(records, names)).agg(
        F.count_distinct(names.reporter).alias("reporters")
    )


def reporter_cells(records: DataFrame, exact: bool = False, names: Names = NAMES) -> DataFrame:
    """What a batch keeps of its reporters: a sketch per date, area and category, or, exact, one
    row per reporter of each."""
    keys = _reporter_keys(records, names)
    if exact:
        return records.select(*keys, F.col(names.reporter).alias(REPORTERS)).distinct()
    sketch = F.hll_sketch_agg(names.reporter, F.lit(SKETCH_BITS)).alias(REPORTERS)
    return records.groupBy(*keys).agg(sketch)


def merge_reporters(cells: DataFrame, exact: bool = False, names: Names = NAMES) -> DataFrame:
    """The reporter cells of many batches as those of one."""
    keys = [names.date, names.area, names.category]
    if exact:
        return cells.select(*keys, REPORTERS).distinct()
    return cells.groupBy(*keys).agg(F.hll_union_agg(REPORTERS, F.lit(False)).alias(REPORTERS))


def count_reporters(merged: DataFrame, exact: bool = False, names: Names = NAMES) -> DataFrame:
    """Distinct reporters per date, area and category from merged reporter cells."""
    keys = [names.date, names.area, names.category]
    if exact:
        return merged.groupBy(*keys).agg(F.count(REPORTERS).alias("reporters"))
    return merged.select(*keys, F.hll_sketch_estimate(REPORTERS).alias("reporters"))
