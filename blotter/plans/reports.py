"""The three reports over the stored tables: live incidents, alert feed and density."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions import seconds
from blotter.operators.alerts import alert_view, normalise_alerts
from blotter.operators.density import (
    density_summary,
    normalise_density,
    rank_density,
    relative_density,
)
from blotter.operators.feeds import (
    Reference,
    first_per_id,
    incident_view,
    live_rows,
    live_set,
    reference_time,
)
from blotter.operators.points import decode_points
from blotter.schema import (
    ALERT_SCHEMA,
    ALERT_TTL_SECONDS,
    ALERTS,
    BATCH_KEY,
    CATEGORY_UNIVERSE,
    DENSITY,
    DENSITY_SCHEMA,
    FACT_SCHEMA,
    FACTS,
    FALLBACK_AREAS,
    INCIDENT_TTL_SECONDS,
    NAMES,
    with_batch_key,
)
from blotter.sources.commits import has_commits, live_files
from blotter.sources.tables import (
    discover_areas,
    latest_files,
    list_files,
    read_days,
    read_files,
    read_listed,
)

_BY_BATCH = (NAMES.date, NAMES.area, BATCH_KEY)
_DAY_SECONDS = 86_400


def touched_days(spark: SparkSession, now: Column, ttl_seconds: int) -> list[str]:
    """The days on which a row can have arrived that is alive at the reference time."""
    first, last = (
        spark.range(1)
        .select(
            F.to_date(now - seconds(ttl_seconds)).cast("string"), F.to_date(now).cast("string")
        )
        .first()
    )
    days = spark.range(ttl_seconds // _DAY_SECONDS + 2).select(
        F.date_add(F.lit(first).cast("date"), F.col("id").cast("int")).cast("string").alias("day")
    )
    return [r.day for r in days.where(F.col("day") <= last).collect()]


def _recent(
    spark: SparkSession,
    path: str,
    schema,
    clock: str,
    now: Column,
    ttl_seconds: int,
    files_per_area: int | None,
    partitions: Sequence[str],
) -> DataFrame:
    """Stored rows alive at the reference time, from all days that can hold some.

    The bounds on the clock are literals, so they reach the Parquet scan.
    """
    days = touched_days(spark, now, ttl_seconds)
    stored = with_batch_key(schema) if BATCH_KEY in partitions else schema
    if has_commits(spark, path):
        # The commits know which files can hold live rows; no other one is listed or opened.
        files = live_files(spark, path, days, now - seconds(ttl_seconds), now)
        if files_per_area is not None:
            files = latest_files(files, files_per_area, (NAMES.date, NAMES.area))
        return live_rows(read_listed(spark, path, files, stored, tolerant=True), now, ttl_seconds, clock)
    if files_per_area is None:
        rows = read_days(spark, path, days, stored, tolerant=True)
    else:
        lots = [
            latest_files(list_files(spark, path, partitions, day), files_per_area)
            for day in days
        ]
        listed = lots[0]
        for lot in lots[1:]:
            listed = listed.unionByName(lot)
        rows = read_files(spark, path, listed, stored)
    return live_rows(rows, now, ttl_seconds, clock)


def live_incidents(
    spark: SparkSession,
    root: str,
    reference: Reference,
    ttl_seconds: int = INCIDENT_TTL_SECONDS,
    files_per_area: int | None = None,
    partitions: Sequence[str] = _BY_BATCH,
) -> DataFrame:
    """Map points alive at the reference time, each id of its own once.

    Points that came without an id are all kept. ``files_per_area`` reads only so many of the
    newest files of each day and area, as a poll that keeps what it has read; by default all
    stored rows that are alive count.
    """
    now = reference_time(reference)
    facts = _recent(
        spark,
        f"{root}/{FACTS}",
        FACT_SCHEMA,
        NAMES.clock,
        now,
        ttl_seconds,
        files_per_area,
        partitions,
    )
    record = F.xxhash64(NAMES.payload, NAMES.source_time, NAMES.clock)
    points = decode_points(facts, position=record, own_id="__own")
    named = first_per_id(points.where("__own"), ["id"], tie=["timestamp", "lat", "lon", "type"])
    return incident_view(named.unionByName(points.where("NOT __own")))


def live_alerts(
    spark: SparkSession,
    root: str,
    reference: Reference,
    ttl_seconds: int = ALERT_TTL_SECONDS,
    files_per_area: int | None = None,
    partitions: Sequence[str] = _BY_BATCH,
) -> DataFrame:
    """The alert feed at the reference time, each alert once however often it was stored."""
    now = reference_time(reference)
    stored = _recent(
        spark,
        f"{root}/{ALERTS}",
        ALERT_SCHEMA,
        "alert_time",
        now,
        ttl_seconds,
        files_per_area,
        partitions,
    )
    alerts = normalise_alerts(stored, F.col("alert_time"))
    once = live_set(alerts, now, ttl_seconds, ["id"], tie=["crime_count", "alert_message"])
    return alert_view(once, now)


def density_records(
    spark: SparkSession,
    root: str,
    day: str,
    clock: Reference,
    files: int | None = None,
) -> DataFrame:
    """Normalised density rows of a day; with ``files`` only of so many newest files."""
    path = f"{root}/{DENSITY}"
    if files is None:
        stored = read_days(spark, path, [day], DENSITY_SCHEMA, tolerant=True)
    else:
        newest = latest_files(list_files(spark, path, (NAMES.date,), day), files, group=())
        stored = read_files(spark, path, newest, DENSITY_SCHEMA)
    return normalise_density(stored, reference_time(clock))


def density_report(
    records: DataFrame, universe: int = CATEGORY_UNIVERSE
) -> tuple[DataFrame, DataFrame]:
    """Ranked rows with relative scores, and the one-row summary."""
    return rank_density(relative_density(records, universe)), density_summary(records)


def report_areas(spark: SparkSession, root: str, day: str) -> DataFrame:
    """The areas with stored facts on a day, or the fallback list while there are none."""
    path = f"{root}/{FACTS}"
    if has_commits(spark, path):
        return discover_areas(live_files(spark, path, [day]), FALLBACK_AREAS)
    return discover_areas(list_files(spark, path, _BY_BATCH, day), FALLBACK_AREAS)
