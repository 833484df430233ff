"""Map points out of the stored JSON payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.schema import NAMES, POINT_UNKNOWN, Names

_DOC = "__doc"


def _text_or_default(path: str, default: Column) -> Column:
    """The field as text. The default replaces a missing field, not an explicit null."""
    text = F.try_variant_get(_DOC, path, "string")
    # Only a field without text is looked up again.
    missing = F.try_variant_get(_DOC, path, "variant").isNull()
    return F.when(text.isNotNull(), text).when(missing, default)


def _parsed(facts: DataFrame, clock: Column | None, names: Names) -> DataFrame:
    arrival = F.col(names.clock) if clock is None else clock
    # The one-element explode keeps the filter on lat and lon from parsing a second time.
    doc = facts.select("*", F.explode(F.array(F.try_parse_json(names.payload))).alias(_DOC))
    return doc.withColumns(
        {
            "lat": F.try_variant_get(_DOC, "$.location.coordinates.lat", "double"),
            "lon": F.try_variant_get(_DOC, "$.location.coordinates.lon", "double"),
            "added_at": arrival,
        }
    )


def decode_points(
    facts: DataFrame,
    clock: Column | None = None,
    names: Names = NAMES,
    position: Column | None = None,
    own_id: str | None = None,
) -> DataFrame:
    """Id, position, category and area of every payload that has a readable position.

    ``clock`` is the arrival time, by default the stored processing time. Missing ids and
    timestamps are filled from it; a ``position`` that is unique per record is added to such an
    id. With ``own_id`` a column of that name tells whether the id is the payload's own.
    """
    arrival = F.col("added_at")
    filled = [F.lit("crime_"), F.unix_seconds(arrival.cast("timestamp")).cast("string")]
    if position is not None:
        filled += [F.lit("_"), position.cast("string")]
    own = F.try_variant_get(_DOC, "$.crime_id", "string").isNotNull()
    return (
        _parsed(facts, clock, names)
        .where("lat IS NOT NULL AND lon IS NOT NULL")
        .select(
            _text_or_default("$.crime_id", F.concat(*filled)).alias("id"),
            _text_or_default(
                "$.timestamp", F.date_format(arrival, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            ).alias("timestamp"),
            "lat",
            "lon",
            _text_or_default("$.crime_type", F.lit(POINT_UNKNOWN)).alias("type"),
            _text_or_default("$.location.district", F.lit(POINT_UNKNOWN)).alias("district"),
            "added_at",
            *([own.alias(own_id)] if own_id else []),
        )
    )


def quarantined_points(facts: DataFrame, names: Names = NAMES) -> DataFrame:
    """The rows ``decode_points`` leaves out, as they are stored."""
    return (
        _parsed(facts, None, names)
        .where("lat IS NULL OR lon IS NULL")
        .select(*[F.col(c) for c in facts.columns])
    )
