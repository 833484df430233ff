"""Column names, table schemas and the fixed values of the incident data model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Names:
    """Column names an operator works on; override them to run on another table."""

    key: str = "kafka_key"
    payload: str = "crime_data"
    source_time: str = "kafka_timestamp"
    source_partition: str = "kafka_partition"
    source_offset: str = "kafka_offset"
    clock: str = "processing_time"
    category: str = "crime_type"
    area: str = "district"
    reporter: str = "cedula_hash"
    date: str = "date_partition"


NAMES = Names()

# Idempotent sinks add this partition column: "<stream id>-<batch id>".
BATCH_KEY = "batch_key"

# Where the three extracted fields sit in the JSON record.
RECORD_PATHS = {
    "category": "crime_type",
    "area": "location.district",
    "reporter": "reporter_info.cedula_hash",
}

# --- fixed values -----------------------------------------------------------
UNKNOWN = "Unknown"
POINT_UNKNOWN = "unknown"

ALERT_THRESHOLDS = {
    "sicariato": 2,
    "asesinato": 3,
    "secuestro": 1,
    "extorsión": 5,
    "robo": 15,
    "estafa": 8,
}
CATEGORY_UNIVERSE = 6

# Offered while a day has no stored rows.
FALLBACK_AREAS = ("Centro", "Norte", "Sur")

CATEGORY_COLORS = {
    "robo": "#ff4444",
    "extorsion": "#ff8800",
    "sicariato": "#8800ff",
    "asesinato": "#ff0000",
    "secuestro": "#0088ff",
    "estafa": "#00ff88",
}
DEFAULT_COLOR = "#666666"

INCIDENT_TTL_SECONDS = 60
ALERT_TTL_SECONDS = 300

# Files per area, or in all, that a poll of the newest files alone takes.
INCIDENT_FILES_PER_AREA = 8
ALERT_FILES_PER_AREA = 3
DENSITY_FILES = 10

TRIGGER_SECONDS = 6

# Table folder names under the job's root.
FACTS = "processed"
STATISTICS = "statistics"
TEMPORAL = "temporal-analysis"
DENSITY = "density-analysis"
ALERTS = "real-time-alerts"
CORRELATION = "correlation-analysis"
CELLS = "hour-cells"
REPORTER_CELLS = "reporter-cells"
REPORTERS = "reporter-analysis"
# What each batch has committed: its files and the source offsets it took.
COMMITS = "commits"
# The tables whose rows count only once they are committed.
COMMITTED = (FACTS, ALERTS)
# ----------------------------------------------------------------------------

_BIGINT, _BINARY, _BOOLEAN, _DOUBLE = T.LongType(), T.BinaryType(), T.BooleanType(), T.DoubleType()
_INT, _STRING, _TIME = T.IntegerType(), T.StringType(), T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# The columns of a topic row, as every source of the job must offer them.
SOURCE_SCHEMA = _struct(
    key=_BINARY,
    value=_BINARY,
    topic=_STRING,
    partition=_INT,
    offset=_BIGINT,
    timestamp=_TIME,
)

FACT_SCHEMA = _struct(
    crime_data=_STRING,
    processing_time=_TIME,
    kafka_timestamp=_TIME,
    crime_type=_STRING,
    cedula_hash=_STRING,
    date_partition=_STRING,
    district=_STRING,
)

STATISTICS_SCHEMA = _struct(
    district=_STRING,
    crime_type=_STRING,
    crime_count=_BIGINT,
    last_updated=_TIME,
    date_partition=_STRING,
)

TEMPORAL_SCHEMA = _struct(
    crime_type=_STRING,
    hour=_INT,
    day_of_week=_INT,
    crimes_per_hour=_BIGINT,
    avg_hour=_DOUBLE,
    last_crime_time=_TIME,
    date_partition=_STRING,
    district=_STRING,
)

DENSITY_SCHEMA = _struct(
    district=_STRING,
    total_crimes=_BIGINT,
    crime_type_variety=_BIGINT,
    crime_types_list=T.ArrayType(_STRING),
    crime_type_counts=T.ArrayType(_struct(category=_STRING, n=_BIGINT)),
    last_updated=_TIME,
    crime_density_score=_BIGINT,
    date_partition=_STRING,
)

ALERT_SCHEMA = _struct(
    crime_type=_STRING,
    crime_count=_BIGINT,
    alert_time=_TIME,
    is_critical=_BOOLEAN,
    alert_level=_STRING,
    alert_message=_STRING,
    date_partition=_STRING,
    district=_STRING,
)

CORRELATION_SCHEMA = _struct(
    district=_STRING,
    crime_types_in_area=T.ArrayType(_STRING),
    total_crimes_in_area=_BIGINT,
    unique_crime_types=_BIGINT,
    last_updated=_TIME,
    crime_diversity_index=_DOUBLE,
    date_partition=_STRING,
)

CELL_SCHEMA = _struct(
    district=_STRING,
    crime_type=_STRING,
    hour=_INT,
    day_of_week=_INT,
    n=_BIGINT,
    last_time=_TIME,
    date_partition=_STRING,
)

REPORTERS_SCHEMA = _struct(
    district=_STRING, crime_type=_STRING, reporters=_BIGINT, date_partition=_STRING
)

# One row per file, per key that a compaction replaced on a day, and per run of source offsets;
# times are microseconds since 1970.
COMMIT_SCHEMA = _struct(
    kind=_STRING,
    table=_STRING,
    key=_STRING,
    date_partition=_STRING,
    district=_STRING,
    file_uri=_STRING,
    modified=_BIGINT,
    file_size=_BIGINT,
    row_count=_BIGINT,
    least=_BIGINT,
    greatest=_BIGINT,
    topic=_STRING,
    source_partition=_INT,
    first_offset=_BIGINT,
    last_offset=_BIGINT,
    bits=_BIGINT,
)


def with_batch_key(schema: T.StructType) -> T.StructType:
    """The same table with the partition column of the idempotent sinks."""
    return T.StructType(schema.fields + [T.StructField(BATCH_KEY, _STRING)])
