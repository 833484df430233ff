"""From keyed source rows to typed records, and back to keyed rows for a topic."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions import day_key, field_struct
from blotter.schema import NAMES, RECORD_PATHS, UNKNOWN, Names

_RECORD = "__record"


def decode_envelope(raw: DataFrame, names: Names = NAMES) -> DataFrame:
    """Cast key and value to text and name the five source columns."""
    return raw.select(
        F.col("key").cast("string").alias(names.key),
        F.col("value").cast("string").alias(names.payload),
        F.col("timestamp").alias(names.source_time),
        F.col("partition").alias(names.source_partition),
        F.col("offset").alias(names.source_offset),
    )


def stamp_clock(df: DataFrame, clock: Column | None = None, names: Names = NAMES) -> DataFrame:
    """Add the processing time: the batch clock, or a column given for a replay."""
    return df.withColumn(names.clock, F.current_timestamp() if clock is None else clock)


def extract_fields(
    df: DataFrame,
    paths: Mapping[str, str] = RECORD_PATHS,
    default: str = UNKNOWN,
    per_path: bool = False,
    names: Names = NAMES,
) -> DataFrame:
    """Pull category, area and reporter out of the payload, with a default.

    The payload is parsed once per row. The parsed struct goes through ``explode`` of a
    one-element array, because a filter on plain projected columns would be pushed below
    the projection and parse the text again. With a key repeated inside one JSON object
    the last value wins; ``per_path`` reads each path on its own and takes the first.
    """
    columns = {field: getattr(names, field) for field in paths}
    if per_path:
        return df.withColumns(
            {
                columns[field]: F.coalesce(
                    F.get_json_object(names.payload, f"$.{path}"), F.lit(default)
                )
                for field, path in paths.items()
            }
        )
    parsed = df.select(
        "*", F.explode(F.array(field_struct(F.col(names.payload), paths.values()))).alias(_RECORD)
    )
    return parsed.withColumns(
        {
            columns[field]: F.coalesce(F.col(f"{_RECORD}.{path}"), F.lit(default))
            for field, path in paths.items()
        }
    ).drop(_RECORD)


def stamp_date(df: DataFrame, names: Names = NAMES) -> DataFrame:
    """Add the date partition of the processing time."""
    return df.withColumn(names.date, day_key(F.col(names.clock)))


def keep_valid(df: DataFrame, names: Names = NAMES) -> DataFrame:
    """Drop rows whose extracted fields are empty or whose date is missing."""
    return df.where(
        (F.col(names.category) != "")
        & (F.col(names.area) != "")
        & (F.col(names.reporter) != "")
        & F.col(names.date).isNotNull()
    )


def decode_records(
    raw: DataFrame,
    clock: Column | None = None,
    paths: Mapping[str, str] = RECORD_PATHS,
    per_path: bool = False,
    names: Names = NAMES,
) -> DataFrame:
    """Source rows to valid, dated records: works on batch and streaming frames alike."""
    decoded = stamp_clock(decode_envelope(raw, names), clock, names)
    fields = extract_fields(decoded, paths, per_path=per_path, names=names)
    return keep_valid(stamp_date(fields, names), names)


def topic_rows(records: DataFrame, names: Names = NAMES) -> DataFrame:
    """Key and JSON value of the processed topic; the payload stays escaped text inside."""
    return records.select(
        F.col(names.key).alias("key"),
        F.to_json(
            F.struct(
                names.payload,
                names.clock,
                names.source_time,
                names.source_partition,
                names.source_offset,
            )
        ).alias("value"),
    )


def fact_rows(records: DataFrame, names: Names = NAMES) -> DataFrame:
    """The columns the fact table keeps."""
    return records.select(
        names.payload,
        names.clock,
        names.source_time,
        names.category,
        names.reporter,
        names.date,
        names.area,
    )


def publish_rows(
    records: DataFrame,
    key: str = "crime_id",
    fields: Sequence[str] | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Records as keyed JSON, by default whole. Null fields and non-ASCII text are kept.

    ``carry`` names columns to pass along beside key and value.
    """
    value = F.struct(*(fields or records.columns))
    return records.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(value, {"ignoreNullFields": "false"}).alias("value"),
        *carry,
    )
