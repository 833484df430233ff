"""Live sets: rows by id with a time to live, measured from their stored arrival time.

A live set at a reference time holds the rows that arrived at or before it and less than
the time to live ago. All operators take the reference time as a value, so a result can be
repeated later; none of them reads the wall clock. The reference may also be a frame of one
row and column, such as the newest arrival: its value is read first, so that the bounds are
literals that reach the scan and prune partitions.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions import seconds
from blotter.operators.ranking import latest_per_group


Reference = Column | datetime | DataFrame


def reference_time(reference: Reference) -> Column:
    """The reference time as a column; of a frame the one value it holds is read."""
    if isinstance(reference, Column):
        return reference
    if isinstance(reference, datetime):
        return F.lit(reference)
    at = F.col(reference.columns[0])
    if reference.schema[0].dataType.typeName() == "timestamp_ntz":
        return F.lit(reference.select(at.cast("string")).first()[0]).cast("timestamp_ntz")
    return F.timestamp_micros(F.lit(reference.select(F.unix_micros(at)).first()[0]))


def live_rows(
    df: DataFrame,
    reference: Reference,
    ttl_seconds: int,
    clock: str = "added_at",
    date: str | None = None,
) -> DataFrame:
    """Rows alive at the reference time; a row exactly ``ttl_seconds`` old has expired.

    Name the ``date`` partition column of the table to read only the days that can match.
    """
    now = reference_time(reference)
    oldest = now - seconds(ttl_seconds)
    alive = df.where((F.col(clock) > oldest) & (F.col(clock) <= now))
    if date:
        alive = alive.where(
            F.col(date).between(F.to_date(oldest).cast("string"), F.to_date(now).cast("string"))
        )
    return alive


def first_per_id(
    df: DataFrame, ids: list[str], clock: str = "added_at", tie: list[str] | None = None
) -> DataFrame:
    """The earliest row of each id; name ``tie`` columns to decide between equal times."""
    order = [F.col(clock).asc(), *[F.col(c).asc() for c in tie or []]]
    return latest_per_group(df, ids, order, 1)


def live_set(
    df: DataFrame,
    reference: Reference,
    ttl_seconds: int,
    ids: list[str],
    clock: str = "added_at",
    tie: list[str] | None = None,
) -> DataFrame:
    """Live rows, one per id."""
    return first_per_id(live_rows(df, reference, ttl_seconds, clock), ids, clock, tie)


def _without(left: DataFrame, right: DataFrame, ids: list[str]) -> DataFrame:
    seen = right.select(*[F.col(c).alias(f"__{c}") for c in ids]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in ids]
    return left.join(seen, same, "left_anti")


def new_rows(
    incoming: DataFrame,
    live: DataFrame,
    ids: list[str],
    clock: str = "added_at",
    keep_repeats: bool = False,
    tie: list[str] | None = None,
) -> DataFrame:
    """Incoming rows whose id is not live yet.

    Repeats inside ``incoming`` are folded before the join, so that a hot id reaches it as
    one row; ``keep_repeats`` keeps them and leaves a hot id to the adaptive skew join.
    """
    rows = incoming if keep_repeats else first_per_id(incoming, ids, clock, tie)
    return _without(rows, live, ids)


def expired_rows(previous: DataFrame, current: DataFrame, ids: list[str]) -> DataFrame:
    """Rows of the previous live set whose id is gone from the current one."""
    return _without(previous, current, ids)


def extend_live(live: DataFrame, fresh: DataFrame) -> DataFrame:
    """The live set with the new rows added."""
    return live.unionByName(fresh)


def feed_metrics(
    df: DataFrame,
    previous: Reference,
    reference: Reference,
    ttl_seconds: int,
    ids: list[str],
    clock: str = "added_at",
) -> DataFrame:
    """One row: ids expired, added and live between two reference times, in one pass."""

    def alive_at(at: Column) -> Column:
        return (F.col(clock) > at - seconds(ttl_seconds)) & (F.col(clock) <= at)

    before, now = alive_at(reference_time(previous)), alive_at(reference_time(reference))
    states = (
        df.where(before | now)
        .groupBy(*ids)
        .agg(F.max(before).alias("was_live"), F.max(now).alias("is_live"))
    )
    return states.agg(
        F.count_if(F.col("was_live") & ~F.col("is_live")).alias("expired_count"),
        F.count_if(F.col("is_live") & ~F.col("was_live")).alias("added_count"),
        F.count_if("is_live").alias("active_count"),
    )


def incident_view(points: DataFrame) -> DataFrame:
    """The columns the incident feed shows."""
    return points.select("id", "lat", "lon", "type", "district", "timestamp")
