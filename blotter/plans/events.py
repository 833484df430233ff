"""The given tables seen as incidents, in the column names the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions import anonymous_id
from blotter.operators.envelope import publish_rows

# Areas by user id modulo their number; categories and their alert thresholds.
EVENT_AREAS = ("Center", "North", "South", "East", "West", "Coast Road")
EVENT_UNIVERSE = 5
EVENT_THRESHOLDS = {"error": 15, "purchase": 14, "signup": 16, "view": 18, "click": 20}
WINDOW_THRESHOLDS = {"error": 5, "purchase": 5, "signup": 6, "view": 6, "click": 7}
EVENT_COLORS = {
    "error": "#d62728",
    "purchase": "#2ca02c",
    "signup": "#1f77b4",
    "view": "#7f7f7f",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_incidents(events: DataFrame) -> DataFrame:
    """Events with area, category, reporter and clock columns."""
    position = (F.col("user_id") % len(EVENT_AREAS) + 1).cast("int")
    return events.select(
        F.col("event_id").alias("incident_id"),
        F.element_at(F.array(*[F.lit(a) for a in EVENT_AREAS]), position).alias("district"),
        F.col("event_type").alias("crime_type"),
        anonymous_id(F.col("user_id")).alias("cedula_hash"),
        F.col("ts").alias("processing_time"),
        "user_id",
        "value",
        "props",
    )


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_incidents(table(spark, sf_dir, "events"))


def source_rows(incident_rows: DataFrame) -> DataFrame:
    """The incidents as keyed JSON rows with the columns of a topic."""
    records = incident_rows.select(
        F.concat(F.lit("INC-"), F.col("incident_id").cast("string")).alias("crime_id"),
        F.date_format("processing_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.struct(
            "district",
            F.struct(
                F.col("value").alias("lat"), (F.lit(100.0) - F.col("value")).alias("lon")
            ).alias("coordinates"),
        ).alias("location"),
        "crime_type",
        F.struct("cedula_hash").alias("reporter_info"),
        "processing_time",
        "incident_id",
    )
    payload = records.drop("processing_time", "incident_id").columns
    published = publish_rows(
        records, "crime_id", payload, carry=["processing_time", "incident_id"]
    )
    return published.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit("incidents").alias("topic"),
        F.pmod("incident_id", F.lit(3)).cast("int").alias("partition"),
        F.col("incident_id").alias("offset"),
        F.col("processing_time").alias("timestamp"),
    )


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as records: status as area, priority as category, order date as clock."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("district"),
        F.col("o_orderpriority").alias("crime_type"),
        F.col("o_custkey").cast("string").alias("cedula_hash"),
        F.col("o_orderdate").alias("processing_time"),
    )
