"""The registered queries: every operator on the given tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from blotter.functions import age_label, age_seconds, area_from_message, minute_bucket, seconds
from blotter.operators import alerts, cells, density, envelope, feeds, lookups, ranking, rollups
from blotter.operators.points import decode_points, quarantined_points
from blotter.plans import events as ev
from blotter.plans.rebuild import rebuild_rollups
from blotter.plans.reports import density_records, density_report, live_alerts, live_incidents
from blotter.schema import (
    ALERT_SCHEMA,
    ALERTS,
    CORRELATION,
    CORRELATION_SCHEMA,
    DENSITY,
    DENSITY_SCHEMA,
    FACT_SCHEMA,
    FACTS,
    NAMES,
    REPORTERS,
    REPORTERS_SCHEMA,
    SOURCE_SCHEMA,
    STATISTICS,
    STATISTICS_SCHEMA,
    TEMPORAL,
    TEMPORAL_SCHEMA,
    with_batch_key,
)
from blotter.session import (
    cut_lineage,
    file_system,
    move_files,
    remove_folder,
    work_folder,
    work_folders,
)
from blotter.sinks.commits import file_rows, write_commit
from blotter.sinks.compaction import compact, sweep
from blotter.sinks.keys import batch_key
from blotter.sinks.snapshots import publish
from blotter.sinks.tables import append_rows, replace_partitions, replace_table, write_batch
from blotter.sources import commits
from blotter.sources.commits import live_files
from blotter.sources.skipped import set_aside, skipped_files
from blotter.sources.streams import read_file_stream
from blotter.sources.tables import (
    discover_areas,
    file_census,
    latest_files,
    list_files,
    read_days,
    read_files,
    read_listed,
    read_table,
    sample_read,
)
from blotter.streaming import job as streaming_job
from blotter.streaming.expiry import expired_markers
from blotter.streaming.live import BUCKET, dedupe_live, observe_feed, start_live_feed
from blotter.streaming.progress import batch_volume, recent_volume
from blotter.streaming.windows import finished_alerts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAY = 86_400
HOUR = 3_600


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the given tables have them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if f.dataType.typeName() == "timestamp"
            else F.col(f.name)
            for f in df.schema
        ]
    )


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents as feed rows: id and arrival time."""
    return ev.incidents(spark, sf_dir).withColumnsRenamed(
        {"incident_id": "id", "processing_time": "added_at"}
    )


def _newest(feed: DataFrame) -> Column:
    """The reference time: the newest arrival, read once."""
    return feeds.reference_time(feed.agg(F.max("added_at").alias("reference")))


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.day_cells(ev.incidents(spark, sf_dir))


def _joined(column: str) -> Column:
    return F.array_join(F.sort_array(column), ",")


# ---------------------------------------------------------------- envelope


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = ev.source_rows(ev.incidents(spark, sf_dir))
    return envelope.decode_records(raw, clock=F.col(NAMES.source_time))


@query
def envelope_decode(spark, sf_dir):
    return _records(spark, sf_dir).drop(NAMES.payload)


@query
def envelope_decode_per_path(spark, sf_dir):
    raw = ev.source_rows(ev.incidents(spark, sf_dir))
    records = envelope.decode_records(raw, clock=F.col(NAMES.source_time), per_path=True)
    return records.drop(NAMES.payload)


@query
def fact_projection(spark, sf_dir):
    facts = envelope.fact_rows(_records(spark, sf_dir))
    return facts.withColumn(NAMES.payload, F.get_json_object(NAMES.payload, "$.crime_id"))


@query
def topic_envelope(spark, sf_dir):
    rows = envelope.topic_rows(_records(spark, sf_dir))
    value = F.from_json(
        "value",
        f"{NAMES.payload} string, processing_time timestamp, kafka_timestamp timestamp, "
        "kafka_partition int, kafka_offset bigint",
    )
    inner = F.from_json(
        f"value.{NAMES.payload}",
        "location struct<district: string, coordinates: struct<lat: double>>",
    )
    parsed = rows.select("key", value.alias("value")).select(
        "key", "value.*", inner.alias("record")
    )
    return parsed.select(
        "key",
        "record.location.district",
        "record.location.coordinates.lat",
        F.col("processing_time").cast("timestamp_ntz").alias("processing_time"),
        F.col("kafka_timestamp").cast("timestamp_ntz").alias("kafka_timestamp"),
        "kafka_partition",
        "kafka_offset",
    )


@query
def json_default_filter(spark, sf_dir):
    events = ev.table(spark, sf_dir, "events").select(
        "event_id",
        F.col("props").alias(NAMES.payload),
        F.col("ts").alias(NAMES.clock),
        F.lit("no").alias(NAMES.area),
    )
    fields = envelope.extract_fields(events, {"category": "k", "reporter": "absent"})
    dated = envelope.stamp_date(fields)
    return envelope.keep_valid(dated).select(
        "event_id",
        F.col(NAMES.category).alias("k"),
        F.col(NAMES.reporter).alias("absent"),
        NAMES.date,
    )


@query
def point_decode(spark, sf_dir):
    return decode_points(_records(spark, sf_dir))


@query
def anonymize_id(spark, sf_dir):
    return ev.incidents(spark, sf_dir).select("incident_id", "cedula_hash")


# ----------------------------------------------------------------- rollups


@query
def statistics(spark, sf_dir):
    return rollups.statistics(_days(spark, sf_dir))


@query
def temporal_profile(spark, sf_dir):
    return rollups.temporal_profile(cells.hour_cells(ev.incidents(spark, sf_dir)))


@query
def ten_minute_bucket(spark, sf_dir):
    bucket = minute_bucket(F.col("processing_time")).alias("minute_window")
    return (
        ev.incidents(spark, sf_dir)
        .groupBy("crime_type", bucket)
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def density_by_area(spark, sf_dir):
    pair = F.transform(
        "crime_type_counts", lambda c: F.concat(c["category"], F.lit(":"), c["n"].cast("string"))
    )
    return (
        rollups.density(_days(spark, sf_dir))
        .withColumn("crime_types_list", _joined("crime_types_list"))
        .withColumn("crime_type_counts", F.array_join(pair, ","))
    )


@query
def density_category_bag(spark, sf_dir):
    bag = rollups.category_bag(_days(spark, sf_dir), chunk=5)
    return bag.withColumn("crime_types_list", F.array_join("crime_types_list", ","))


@query
def correlation(spark, sf_dir):
    return rollups.correlation(_days(spark, sf_dir), ev.EVENT_UNIVERSE).withColumn(
        "crime_types_in_area", _joined("crime_types_in_area")
    )


@query
def reporter_counts(spark, sf_dir):
    return rollups.reporter_counts(ev.incidents(spark, sf_dir))


@query
def merged_batch_cells(spark, sf_dir):
    """Cells kept apart by batch, merged again, must give the plain statistics."""
    records = ev.incidents(spark, sf_dir).withColumn("batch", F.hour("processing_time") % 6)
    batches = cells.hour_cells(records, by=["batch"])
    return rollups.statistics(cells.fold_to_days(cells.merge_cells(batches)))


# ----------------------------------------------------------------- density


def _density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored density rows, written once and read by each use."""
    return cut_lineage(rollups.density(_days(spark, sf_dir)))


@query
def density_list_normalize(spark, sf_dir):
    rows = rollups.density(_days(spark, sf_dir)).withColumn(
        "crime_types_list",
        F.to_json(F.concat("crime_types_list", "crime_types_list")),
    )
    normal = density.normalise_density(rows, F.col("last_updated"))
    return normal.withColumn("crime_types_list", F.array_join("crime_types_list", ","))


@query
def density_rank(spark, sf_dir):
    records = density.normalise_density(
        rollups.density(_days(spark, sf_dir)), F.col("last_updated")
    )
    ranked = density.density_view(records)
    return ranked.withColumn("crime_types_list", F.array_join("crime_types_list", ","))


@query
def density_summary(spark, sf_dir):
    return density.density_summary(rollups.density(_days(spark, sf_dir)))


@query
def density_summary_empty(spark, sf_dir):
    rows = rollups.density(_days(spark, sf_dir))
    return density.density_summary(rows.where("total_crimes < 0"))


@query
def hotspot(spark, sf_dir):
    return density.hotspot(rollups.density(_days(spark, sf_dir))).select(
        "district", "date_partition", "crime_density_score"
    )


@query
def density_percent(spark, sf_dir):
    return density.relative_density(_density(spark, sf_dir), ev.EVENT_UNIVERSE).select(
        "date_partition",
        "district",
        F.round("density_percent", 4).alias("density_percent"),
        "variety_ratio",
    )


# ------------------------------------------------------------------ alerts


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.critical_alerts(_days(spark, sf_dir), ev.EVENT_THRESHOLDS)


@query
def threshold_evaluation(spark, sf_dir):
    return alerts.evaluate_thresholds(_days(spark, sf_dir), ev.EVENT_THRESHOLDS)


@query
def critical_alerts(spark, sf_dir):
    return _alerts(spark, sf_dir)


@query
def critical_alerts_by_table(spark, sf_dir):
    """Thresholds derived from the data: the mean daily count of each category."""
    days = _days(spark, sf_dir)
    limits = days.groupBy("crime_type").agg(F.ceil(F.avg(cells.COUNT)).alias("threshold"))
    return alerts.critical_alerts(days, limits)


@query
def windowed_alerts(spark, sf_dir):
    windows = cells.window_cells(ev.incidents(spark, sf_dir), 6 * HOUR)
    return alerts.critical_alerts(windows, ev.WINDOW_THRESHOLDS)


def _alert_feed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column]:
    stored = _alerts(spark, sf_dir)
    feed = alerts.normalise_alerts(stored, F.col("alert_time"))
    return feed, _newest(_feed(spark, sf_dir))


@query
def alert_normalize(spark, sf_dir):
    stored = _alerts(spark, sf_dir).select(
        F.col("crime_type").alias("Crime_Type"),
        F.col("crime_count").cast("string").alias("crime_count"),
        "alert_message",
        "alert_time",
    )
    return alerts.normalise_alerts(stored, F.col("alert_time")).drop("id", "alert_time")


@query
def alert_feed(spark, sf_dir):
    feed, now = _alert_feed(spark, sf_dir)
    live = feeds.live_rows(feed, now, 7 * DAY)
    return alerts.alert_view(live, now).drop("id", "alert_time")


@query
def alert_counts(spark, sf_dir):
    marked = alerts.evaluate_thresholds(_days(spark, sf_dir), ev.EVENT_THRESHOLDS)
    return alerts.alert_counts(marked)


@query
def alert_area_recovery(spark, sf_dir):
    return _alerts(spark, sf_dir).select(
        "alert_message", area_from_message(F.col("alert_message")).alias("district")
    )


# ------------------------------------------------------------------- feeds


@query
def active_incidents(spark, sf_dir):
    feed = _feed(spark, sf_dir)
    live = feeds.live_set(feed, _newest(feed), DAY, ["id"])
    return live.select("id", "district", "crime_type", "added_at")


@query
def live_first_per_reporter(spark, sf_dir):
    feed = _feed(spark, sf_dir)
    live = feeds.live_set(feed, _newest(feed), 10 * DAY, ["user_id"], tie=["id"])
    return live.select("user_id", "id", "district", "added_at")


@query
def new_incidents(spark, sf_dir):
    feed = _feed(spark, sf_dir).select("user_id", "id", "added_at")
    newest = _newest(feed)
    before = feeds.live_rows(feed, newest - seconds(DAY), DAY)
    now = feeds.live_rows(feed, newest, DAY)
    return feeds.new_rows(now, before, ["user_id"], tie=["id"])


@query
def new_incidents_with_repeats(spark, sf_dir):
    feed = _feed(spark, sf_dir).select("user_id", "id", "added_at")
    newest = _newest(feed)
    before = feeds.live_rows(feed, newest - seconds(DAY), DAY)
    now = feeds.live_rows(feed, newest, DAY)
    return feeds.new_rows(now, before, ["user_id"], keep_repeats=True)


@query
def expired_incidents(spark, sf_dir):
    feed = _feed(spark, sf_dir).select("id", "added_at")
    newest = _newest(feed)
    before = feeds.live_rows(feed, newest - seconds(6 * HOUR), DAY)
    now = feeds.live_rows(feed, newest, DAY)
    return feeds.expired_rows(before, now, ["id"])


@query
def extended_live_set(spark, sf_dir):
    feed = _feed(spark, sf_dir).select("user_id", "id", "added_at")
    newest = _newest(feed)
    before = feeds.live_set(feed, newest - seconds(DAY), DAY, ["user_id"], tie=["id"])
    now = feeds.live_rows(feed, newest, DAY)
    return feeds.extend_live(before, feeds.new_rows(now, before, ["user_id"], tie=["id"]))


@query
def feed_metrics(spark, sf_dir):
    feed = _feed(spark, sf_dir)
    newest = _newest(feed)
    return feeds.feed_metrics(feed, newest - seconds(6 * HOUR), newest, DAY, ["id"])


@query
def incident_view(spark, sf_dir):
    points = decode_points(_records(spark, sf_dir))
    now = _newest(_feed(spark, sf_dir))
    return feeds.incident_view(feeds.live_rows(points, now, DAY))


@query
def age_labels(spark, sf_dir):
    feed = _feed(spark, sf_dir)
    age = age_seconds(F.col("added_at"), _newest(feed))
    aged = feed.select("id", age.alias("time_ago"))
    return aged.withColumn("time_ago_label", age_label(F.col("time_ago")))


@query
def latest_per_area(spark, sf_dir):
    rows = ev.incidents(spark, sf_dir).select("incident_id", "district", "processing_time")
    order = [F.desc("processing_time"), F.asc("incident_id")]
    return ranking.latest_per_group(rows, ["district"], order, 8)


@query
def latest_per_area_deep(spark, sf_dir):
    rows = ev.incidents(spark, sf_dir).select("incident_id", "district", "processing_time")
    order = [F.desc("processing_time"), F.asc("incident_id")]
    return ranking.latest_per_group(rows, ["district"], order, 1200)


@query
def latest_overall(spark, sf_dir):
    rows = ev.incidents(spark, sf_dir).select("incident_id", "district", "processing_time")
    order = [F.desc("processing_time"), F.asc("incident_id")]
    return ranking.latest_overall(rows, order, 10)


@query
def category_lookup(spark, sf_dir):
    rows = ev.incidents(spark, sf_dir).select(
        "incident_id", F.upper(F.translate("crime_type", "o", "ó")).alias("type")
    )
    return lookups.category_attribute(rows, "type", ev.EVENT_COLORS)


@query
def category_lookup_exact(spark, sf_dir):
    rows = ev.incidents(spark, sf_dir).select(
        "incident_id", F.upper(F.translate("crime_type", "o", "ó")).alias("type")
    )
    return lookups.category_attribute(rows, "type", ev.EVENT_COLORS, fold_accents=False)


# ----------------------------------------------------------------- batches


@query
def snapshot_latest_batch(spark, sf_dir):
    hour = F.date_trunc("hour", F.col("processing_time")).cast("timestamp_ntz")
    rows = ev.incidents(spark, sf_dir).withColumn("batch", hour)
    return ranking.latest_batch(rows, "batch").select("incident_id", "district", "batch")


@query
def batch_volume_per_trigger(spark, sf_dir):
    return batch_volume(ev.incidents(spark, sf_dir), trigger_seconds=600)


# ----------------------------------------------------------------- storage


def _fact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = envelope.stamp_date(ev.incidents(spark, sf_dir))
    return rows.select(
        F.col("incident_id").cast("string").alias("crime_data"),
        F.col("processing_time").cast("timestamp").alias("processing_time"),
        F.col("processing_time").cast("timestamp").alias("kafka_timestamp"),
        "crime_type",
        "cedula_hash",
        "date_partition",
        "district",
    )


def _stored_facts(spark: SparkSession, sf_dir: str) -> str:
    path = work_folder(spark, "facts")
    append_rows(_fact_rows(spark, sf_dir), path)
    return path


@query
def partition_scan(spark, sf_dir):
    """The newest day alone, through its folder."""
    path = _stored_facts(spark, sf_dir)
    newest = list_files(spark, path).agg(F.max("date_partition")).first()[0]
    rows = read_days(spark, path, [newest], FACT_SCHEMA)
    return _plain(rows.select("crime_data", "crime_type", "district", "date_partition"))


@query
def table_scan(spark, sf_dir):
    rows = read_table(spark, _stored_facts(spark, sf_dir), FACT_SCHEMA)
    return _plain(rows.drop("kafka_timestamp"))


@query
def area_discovery(spark, sf_dir):
    return discover_areas(list_files(spark, _stored_facts(spark, sf_dir)))


@query
def area_discovery_default(spark, sf_dir):
    """The areas of the newest stored day, and the default list for the day after it."""
    path = _stored_facts(spark, sf_dir)
    newest = F.max("date_partition").cast("date")
    stored, after = (
        list_files(spark, path)
        .agg(newest.cast("string"), F.date_add(newest, 1).cast("string"))
        .first()
    )
    found = [
        discover_areas(list_files(spark, path, day=day), default=ev.EVENT_AREAS[:3]).select(
            F.lit(day).alias("day"), "district"
        )
        for day in (stored, after)
    ]
    return found[0].unionByName(found[1])


@query
def file_census_by_partition(spark, sf_dir):
    """Files, newest lot and rows of each day and area written in two lots."""
    path = _two_lots(spark, sf_dir)
    files = list_files(spark, path, ("date_partition", "district", "batch_key"))
    lot = F.regexp_extract("newest_file", "batch_key=([^/]*)", 1).alias("newest_lot")
    rows = read_table(spark, path, with_batch_key(FACT_SCHEMA))
    counts = rows.groupBy("date_partition", "district").agg(F.count(F.lit(1)).alias("rows"))
    census = file_census(files).where("total_bytes > 0")
    return census.join(counts, ["date_partition", "district"]).select(
        "date_partition", "district", "file_count", lot, "rows"
    )


def _two_lots(spark: SparkSession, sf_dir: str) -> str:
    """The facts in two files per day and area: first the mornings, then the rest."""
    path = work_folder(spark, "lots")
    rows = _fact_rows(spark, sf_dir)
    morning = F.hour("processing_time") < 12
    write_batch(rows.where(morning), path, "lot-1")
    write_batch(rows.where(~morning), path, "lot-2")
    return path


@query
def latest_files_per_area(spark, sf_dir):
    """Rows of the newest file of each day and area: the afternoons."""
    path = _two_lots(spark, sf_dir)
    keys = ("date_partition", "district", "batch_key")
    newest = latest_files(list_files(spark, path, keys), 1, group=keys[:2])
    rows = read_files(spark, path, newest, with_batch_key(FACT_SCHEMA))
    return rows.select("crime_data", "district", "date_partition", "batch_key")


@query
def latest_files_overall(spark, sf_dir):
    """The rows of the newest files, as many as the second lot has: the afternoons."""
    path = _two_lots(spark, sf_dir)
    files = list_files(spark, path, ("date_partition", "district", "batch_key"))
    newest = latest_files(files, files.where("batch_key = 'lot-2'").count(), group=())
    rows = read_files(spark, path, newest, with_batch_key(FACT_SCHEMA))
    return rows.select("crime_data", "district", "date_partition", "batch_key")


@query
def sample_read_of_table(spark, sf_dir):
    """Count, columns and first record of a table whose files are in order of the id."""
    path = work_folder(spark, "sample")
    ordered = _fact_rows(spark, sf_dir).orderBy(F.col("crime_data").cast("long"))
    ordered.write.parquet(path)
    sample = sample_read(read_table(spark, path, FACT_SCHEMA))
    first = [
        F.get_json_object("first_record", f"$.{name}").alias(name)
        for name in ("crime_data", "crime_type", "district")
    ]
    return sample.select("row_count", "columns", *first)


@query
def replaced_table(spark, sf_dir):
    """Doubled counts, replaced as a whole by the right ones."""
    path = work_folder(spark, "replaced")
    incidents = ev.incidents(spark, sf_dir)
    for records in (incidents.unionByName(incidents), incidents):
        rows = rollups.statistics(cells.day_cells(records)).withColumn(
            "last_updated", F.col("last_updated").cast("timestamp")
        )
        replace_table(rows, path)
    return _plain(read_table(spark, path, STATISTICS_SCHEMA))


@query
def replaced_partitions(spark, sf_dir):
    """Writing the second half twice and the first half once keeps every day once."""
    path = work_folder(spark, "partitions")
    rows = rollups.statistics(_days(spark, sf_dir)).withColumn(
        "last_updated", F.col("last_updated").cast("timestamp")
    )
    first_half = F.col("date_partition") < "2024-01-16"
    for part in (~first_half, first_half, ~first_half):
        replace_partitions(rows.where(part), path)
    return _plain(read_table(spark, path, STATISTICS_SCHEMA))


# ---------------------------------------------------------------- streaming

# The events arrive in lots of about equal size, cut by the clock.
LOTS = 4
FEED_TTL = 4 * DAY


def _lot(spark: SparkSession, sf_dir: str) -> Column:
    """The lot of an event: how many quantiles of the clock, in whole hours, lie before its hour.

    Events without a clock are in the first lot. One row per hour of the data is put in order.
    """
    events = ev.table(spark, sf_dir, "events").where("ts IS NOT NULL")
    hours = events.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    run = hours.select(
        "hour",
        F.sum("n").over(Window.orderBy("hour")).alias("upto"),
        F.sum("n").over(everything).alias("all"),
    )
    quantiles = [
        F.min(F.when(LOTS * F.col("upto") >= i * F.col("all"), F.col("hour"))) for i in range(1, LOTS)
    ]
    cuts = run.agg(*quantiles).first()
    after = [F.date_trunc("hour", "ts") > F.lit(c) for c in cuts if c is not None]
    return sum((F.coalesce(a, F.lit(False)).cast("int") for a in after), F.lit(0))


def _each_lot(
    spark: SparkSession,
    sf_dir: str,
    path: str,
    start: Callable[[], StreamingQuery],
    lots: Iterable[int] = range(LOTS),
) -> list[StreamingQuery]:
    """Add the lots to the folder one by one and let a resumed stream drain each: one micro-batch a
    lot. Lots without rows are left out.

    The events are read once and dealt into their lots, each in as many files of about equal size as
    there are cores, so a micro-batch is decoded by all of them however the events are stored.
    """
    runs = []
    number = _lot(spark, sf_dir).cast("int")
    events = ev.table(spark, sf_dir, "events").withColumn("__lot", number)
    taken = events.where(F.col("__lot").isin(list(lots)))
    with work_folders(spark, "arriving") as [aside]:
        dealt = taken.repartition(spark.sparkContext.defaultParallelism)
        dealt.write.partitionBy("__lot").parquet(aside)
        for i in lots:
            if move_files(spark, f"{aside}/__lot={i}", path, f"lot-{i}-"):
                runs.append(start())
                runs[-1].awaitTermination()
    return runs


def _event_stream(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    return read_file_stream(spark, path, ev.table(spark, sf_dir, "events").schema)


def _record_stream(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    raw = ev.source_rows(ev.as_incidents(_event_stream(spark, sf_dir, path)))
    typed = raw.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return envelope.decode_records(
        typed.select(*SOURCE_SCHEMA.names), clock=F.col(NAMES.source_time)
    )


def _new_job(spark: SparkSession, mode: str, **options) -> streaming_job.Job:
    return streaming_job.Job(
        root=work_folder(spark, "stream"),
        mode=mode,
        thresholds=ev.EVENT_THRESHOLDS,
        universe=ev.EVENT_UNIVERSE,
        fold=2,
        pack_every=2,
        **options,
    )


def _drain(
    spark: SparkSession, sf_dir: str, path: str, job: streaming_job.Job, checkpoint: str = "checkpoint"
) -> StreamingQuery:
    return streaming_job.start(
        _record_stream(spark, sf_dir, path), job, f"{job.root}-{checkpoint}", trigger_seconds=None
    )


def _run_job(spark: SparkSession, sf_dir: str, mode: str, **options) -> streaming_job.Job:
    """A job that has taken all events, a micro-batch for each lot."""
    job = _new_job(spark, mode, **options)
    with work_folders(spark, "lots") as [path]:
        _each_lot(spark, sf_dir, path, partial(_drain, spark, sf_dir, path, job))
    remove_folder(spark, f"{job.root}-checkpoint")
    return job


def _stored(spark: SparkSession, sf_dir: str, table: str, schema, **options) -> DataFrame:
    job = _run_job(spark, sf_dir, streaming_job.CUMULATIVE, **options)
    return _plain(read_table(spark, job.path(table), schema))


@query
def stream_rollup(spark, sf_dir):
    return _stored(spark, sf_dir, STATISTICS, STATISTICS_SCHEMA)


@query
def stream_temporal(spark, sf_dir):
    return _stored(spark, sf_dir, TEMPORAL, TEMPORAL_SCHEMA)


@query
def stream_density(spark, sf_dir):
    rows = _stored(spark, sf_dir, DENSITY, DENSITY_SCHEMA)
    return rows.drop("crime_type_counts").withColumn(
        "crime_types_list", _joined("crime_types_list")
    )


@query
def stream_correlation(spark, sf_dir):
    rows = _stored(spark, sf_dir, CORRELATION, CORRELATION_SCHEMA)
    return rows.withColumn("crime_types_in_area", _joined("crime_types_in_area"))


@query
def stream_alerts(spark, sf_dir):
    """The alerts of every batch on its own; a day cut in two is counted in two parts."""
    return _stored(spark, sf_dir, ALERTS, ALERT_SCHEMA)


@query
def stream_last_batch(spark, sf_dir):
    """Statistics of the last batch alone."""
    job = _run_job(spark, sf_dir, streaming_job.LAST_BATCH)
    return _plain(read_table(spark, job.path(STATISTICS), STATISTICS_SCHEMA))


@query
def stream_facts(spark, sf_dir):
    job = _run_job(spark, sf_dir, streaming_job.LAST_BATCH)
    facts = read_table(spark, job.path(FACTS), FACT_SCHEMA)
    payload = F.get_json_object("crime_data", "$.crime_id").alias("crime_id")
    return _plain(facts.select(payload, *facts.drop("crime_data", "kafka_timestamp").columns))


def _facts_per_day(spark: SparkSession, job: streaming_job.Job) -> DataFrame:
    facts = read_table(spark, job.path(FACTS), FACT_SCHEMA)
    return facts.groupBy("date_partition").agg(F.count(F.lit(1)).alias("facts"))


@query
def stream_resumed_and_replayed(spark, sf_dir):
    """Facts per day after a timed run over two lots, a resumed one over all and a replay
    under a new checkpoint: every row twice, none more."""
    job = _new_job(spark, streaming_job.CUMULATIVE)

    def timed() -> StreamingQuery:
        query = streaming_job.start(
            _record_stream(spark, sf_dir, path), job, f"{job.root}-checkpoint", trigger_seconds=1
        )
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        return query

    with work_folders(spark, "lots") as [path]:
        _each_lot(spark, sf_dir, path, timed, range(LOTS // 2))
        _each_lot(spark, sf_dir, path, partial(_drain, spark, sf_dir, path, job), range(LOTS // 2, LOTS))
        _drain(spark, sf_dir, path, job, "replay").awaitTermination()
    return _facts_per_day(spark, job)


@query
def stream_replay_once(spark, sf_dir):
    """Facts and counted rows per day when a replay under a new checkpoint meets what two lots have
    stored already: only offsets that are not stored are written, so every row is there once."""
    job = _new_job(spark, streaming_job.CUMULATIVE, once=True, topic="incidents")
    with work_folders(spark, "lots") as [path]:
        _each_lot(spark, sf_dir, path, partial(_drain, spark, sf_dir, path, job), range(LOTS // 2))
        replayed = partial(_drain, spark, sf_dir, path, job, "replay")
        _each_lot(spark, sf_dir, path, replayed, range(LOTS // 2, LOTS))
    counted = read_table(spark, job.path(STATISTICS), STATISTICS_SCHEMA).groupBy("date_partition")
    return _facts_per_day(spark, job).join(
        counted.agg(F.sum("crime_count").alias("counted")), "date_partition", "full"
    )


@query
def stream_reporters(spark, sf_dir):
    """Distinct reporters over all batches, from mergeable cells on their exact path."""
    rows = _stored(spark, sf_dir, REPORTERS, REPORTERS_SCHEMA, reporters=streaming_job.EXACT)
    return rows.select("date_partition", "district", "crime_type", "reporters")


def _to_files(
    spark: SparkSession, sf_dir: str, made: Callable[[DataFrame], DataFrame], schema: str
) -> tuple[DataFrame, list[StreamingQuery]]:
    """What a stream over the arrivals writes, append mode, and its runs."""
    out = work_folder(spark, "out")

    def start() -> StreamingQuery:
        stream = made(_event_stream(spark, sf_dir, path))
        sink = stream.writeStream.format("parquet").option("path", out)
        return sink.option("checkpointLocation", f"{out}-checkpoint").trigger(availableNow=True).start()

    with work_folders(spark, "lots") as [path]:
        runs = _each_lot(spark, sf_dir, path, start)
    remove_folder(spark, f"{out}-checkpoint")
    return spark.read.schema(schema).parquet(out) if runs else spark.createDataFrame([], schema), runs


def _as_arrivals(events: DataFrame) -> DataFrame:
    return ev.as_incidents(events).select(
        F.col("user_id").alias("id"), F.col("processing_time").cast("timestamp").alias("added_at")
    )


@query
def stream_live_feed(spark, sf_dir):
    """A reporter is stored on first arrival and again after each time to live of four days."""
    path = work_folder(spark, "feed")

    def start() -> StreamingQuery:
        return start_live_feed(
            _as_arrivals(_event_stream(spark, sf_dir, lots)),
            path,
            f"{path}-checkpoint",
            ttl_seconds=FEED_TTL,
            trigger_seconds=None,
        )

    with work_folders(spark, "lots") as [lots]:
        _each_lot(spark, sf_dir, lots, start)
    remove_folder(spark, f"{path}-checkpoint")
    schema = spark.createDataFrame([], f"id bigint, added_at timestamp, {BUCKET} string").schema
    return _plain(read_table(spark, path, schema).select("id", "added_at"))


@query
def stream_expired(spark, sf_dir):
    """Stays in the live set that a later arrival or the watermark has ended, with their end."""
    rows, _ = _to_files(
        spark,
        sf_dir,
        lambda events: expired_markers(_as_arrivals(events), FEED_TTL),
        "id bigint, added timestamp, expired timestamp",
    )
    return _plain(rows)


@query
def stream_windowed_alerts(spark, sf_dir):
    """Alerts of the six-hour windows that the watermark has finished, each window once."""
    rows, _ = _to_files(
        spark,
        sf_dir,
        lambda events: finished_alerts(ev.as_incidents(events), 6 * HOUR, ev.WINDOW_THRESHOLDS),
        "window_start timestamp, district string, crime_type string, crime_count bigint, "
        "alert_time timestamp, is_critical boolean, alert_level string, alert_message string",
    )
    return _plain(rows)


def _observed(spark: SparkSession, sf_dir: str) -> list[StreamingQuery]:
    """Finished runs over the lots that count what passes."""
    _, runs = _to_files(
        spark,
        sf_dir,
        lambda events: observe_feed(_as_arrivals(events), "feed", expired="hour(added_at) >= 12"),
        "id bigint, added_at timestamp",
    )
    return runs


@query
def observed_feed(spark, sf_dir):
    """Rows that passed and rows of the afternoon, as each batch's own metrics tell."""
    found = [p.observedMetrics["feed"] for run in _observed(spark, sf_dir) for p in run.recentProgress]
    rows = [(int(m["added_count"]), int(m["expired_count"])) for m in found]
    counts = spark.createDataFrame(rows, "added_count bigint, expired_count bigint")
    return counts.where("added_count > 0")


@query
def trigger_volumes(spark, sf_dir):
    """Input rows of every trigger with rows, as the running query reports them."""
    volumes = [v for run in _observed(spark, sf_dir) for v in recent_volume(run)]
    rows = [(v["batch_id"], v["input_rows"]) for v in volumes]
    return spark.createDataFrame(rows, "batch_id bigint, input_rows bigint").where("input_rows > 0")


@query
def stream_dedupe(spark, sf_dir):
    """With a time to live longer than the data each reporter passes once, in its first batch;
    rows without a time are in no window and all pass."""
    rows, _ = _to_files(
        spark,
        sf_dir,
        lambda events: dedupe_live(_as_arrivals(events), ["id"], 1000 * DAY),
        "id bigint, added_at timestamp",
    )
    return rows.select("id")


# ----------------------------------------------------------------- reports


def _report(spark: SparkSession, sf_dir: str) -> tuple[str, Column]:
    """Root of a job that took the events in four batches, and the newest arrival."""
    root = _run_job(spark, sf_dir, streaming_job.CUMULATIVE).root
    feed = _feed(spark, sf_dir).withColumn("added_at", F.col("added_at").cast("timestamp"))
    return root, _newest(feed)


@query
def report_incidents(spark, sf_dir):
    """Map points of the last two days, over two midnights and all stored files."""
    root, now = _report(spark, sf_dir)
    return live_incidents(spark, root, now, ttl_seconds=2 * DAY)


@query
def report_alerts(spark, sf_dir):
    root, now = _report(spark, sf_dir)
    return live_alerts(spark, root, now, ttl_seconds=7 * DAY).drop("id", "alert_time")


@query
def report_density(spark, sf_dir):
    """The ranked report of the newest day."""
    root, now = _report(spark, sf_dir)
    day = spark.range(1).select(F.to_date(now).cast("string")).first()[0]
    ranked, _ = density_report(density_records(spark, root, day, now), ev.EVENT_UNIVERSE)
    return _plain(ranked).select(
        "district",
        "total_crimes",
        F.array_join(F.sort_array("crime_types_list"), ",").alias("crime_types_list"),
        F.round("density_percent", 4).alias("density_percent"),
        "variety_ratio",
        "last_updated",
    )


@query
def rebuild_days(spark, sf_dir):
    """Doubled counts, of which the two newest days are rebuilt from the facts."""
    job = _new_job(spark, streaming_job.CUMULATIVE)
    append_rows(_fact_rows(spark, sf_dir), job.path(FACTS))
    incidents = ev.incidents(spark, sf_dir)
    doubled = rollups.statistics(cells.day_cells(incidents.unionByName(incidents)))
    replace_table(
        doubled.withColumn("last_updated", F.col("last_updated").cast("timestamp")),
        job.path(STATISTICS),
    )
    day = F.col("date_partition")
    days = list_files(spark, job.path(FACTS)).select(day).distinct().orderBy(day.desc()).limit(2)
    rebuild_rollups(spark, job, [r[0] for r in days.collect()])
    return _plain(read_table(spark, job.path(STATISTICS), STATISTICS_SCHEMA))


@query
def quarantine(spark, sf_dir):
    """Every seventh payload has an unreadable latitude; these rows are set aside."""
    records = _records(spark, sf_dir)
    seventh = F.regexp_extract(NAMES.key, "([0-9]+)", 1).cast("bigint") % 7 == 0
    broken = F.regexp_replace(NAMES.payload, '"lat":[-0-9.E]+', '"lat":"x"')
    payload = F.when(seventh, broken).otherwise(F.col(NAMES.payload))
    rows = quarantined_points(records.withColumn(NAMES.payload, payload))
    return rows.select(
        F.get_json_object(NAMES.payload, "$.crime_id").alias("crime_id"), "crime_type", "district"
    )


# ------------------------------------------- commits, compaction and versions

_KEYED = ("date_partition", "district", "batch_key")


def _commit_lots(spark: SparkSession, sf_dir: str, lot: Column, lots: int) -> str:
    """Root of a job whose facts were written and committed in so many batches."""
    root = work_folder(spark, "commits")
    rows = _fact_rows(spark, sf_dir).withColumn("__lot", lot).where("date_partition IS NOT NULL")
    days = [r[0] for r in rows.select("date_partition").distinct().collect()]
    for i in range(lots):
        key = batch_key("lot", i)
        write_batch(rows.where(F.col("__lot") == i).drop("__lot"), f"{root}/{FACTS}", key)
        found = file_rows(spark, root, FACTS, FACT_SCHEMA, NAMES.clock, key, days)
        write_commit(spark, root, key, found)
    return root


def _id_number() -> Column:
    return F.col("crime_data").cast("bigint")


@query
def compacted_facts(spark, sf_dir):
    """Rows, ids and batch keys per day and area before a compaction, after one that was
    interrupted before its commit, after a whole one, and after the old folders are deleted."""
    root = _commit_lots(spark, sf_dir, _id_number() % 4, 4)
    path = f"{root}/{FACTS}"
    days = [r[0] for r in live_files(spark, path).select("date_partition").distinct().collect()]

    def seen(phase: str) -> DataFrame:
        facts = read_table(spark, path, FACT_SCHEMA).groupBy("date_partition", "district")
        keys = live_files(spark, path).groupBy("date_partition", "district")
        return cut_lineage(
            facts.agg(F.count(F.lit(1)).alias("facts"), F.sum(_id_number()).alias("ids"))
            .join(
                keys.agg(F.count_distinct("batch_key").alias("batch_keys")),
                ["date_partition", "district"],
            )
            .withColumn("phase", F.lit(phase))
        )

    def pack(number: int, **options) -> None:
        tables = {FACTS: (FACT_SCHEMA, NAMES.clock)}
        compact(spark, root, tables, days, "lot", number, running=False, **options)

    def interrupt() -> None:
        raise InterruptedError

    phases = [seen("before")]
    try:
        pack(4, before_commit=interrupt)
    except InterruptedError:
        phases.append(seen("interrupted"))
    pack(4)
    phases.append(seen("packed"))
    sweep(spark, path, grace_seconds=0)
    phases.append(seen("swept"))
    return reduce(DataFrame.unionByName, phases)


@query
def manifest_census(spark, sf_dir):
    """Files, newest lot, rows and clock bounds of each day and area, from the commits alone."""
    root = _commit_lots(spark, sf_dir, (F.hour("processing_time") >= 12).cast("int"), 2)
    census = commits.manifest_census(live_files(spark, f"{root}/{FACTS}"))
    newest = F.regexp_extract("newest_file", "batch_key=([^/]*)", 1).alias("newest_key")
    return _plain(
        census.where("total_bytes > 0").select(
            "date_partition", "district", "file_count", "row_count", newest, "least", "greatest"
        )
    )


@query
def manifest_latest_files(spark, sf_dir):
    """Rows of the newest file of each day and area, found in the commits: no folder is listed."""
    root = _commit_lots(spark, sf_dir, (F.hour("processing_time") >= 12).cast("int"), 2)
    path = f"{root}/{FACTS}"
    newest = latest_files(live_files(spark, path), 1, group=_KEYED[:2])
    rows = read_listed(spark, path, newest, with_batch_key(FACT_SCHEMA))
    return rows.select("crime_data", "district", "date_partition", "batch_key")


@query
def manifest_pruned_scan(spark, sf_dir):
    """Facts of the last six hours, of files that can hold some, with the files' lots."""
    root = _commit_lots(spark, sf_dir, F.floor(F.hour("processing_time") / 6).cast("int"), 4)
    path = f"{root}/{FACTS}"
    now = _newest(_feed(spark, sf_dir).withColumn("added_at", F.col("added_at").cast("timestamp")))
    files = live_files(spark, path, since=now - seconds(6 * HOUR), until=now)
    rows = read_listed(spark, path, files, with_batch_key(FACT_SCHEMA))
    live = feeds.live_rows(rows, now, 6 * HOUR, "processing_time")
    opened = files.agg(F.count_distinct(*_KEYED).alias("files_opened"))
    return _plain(
        live.select("crime_data", "district", "processing_time", "batch_key").crossJoin(opened)
    )


@query
def skipped_file_ledger(spark, sf_dir):
    """Of facts in two lots, one file of the newest day is broken and one is deleted: both are
    named with their reason and rows, and rows read and rows skipped add up."""
    root = _commit_lots(spark, sf_dir, (F.hour("processing_time") >= 12).cast("int"), 2)
    path = f"{root}/{FACTS}"
    files = live_files(spark, path)
    newest = files.agg(F.max("date_partition")).first()[0]
    for area, key, content in (("Center", batch_key("lot", 0), b"no footer"), ("North", batch_key("lot", 1), None)):
        hit = files.where(
            (F.col("date_partition") == newest) & (F.col("district") == area) & (F.col("batch_key") == key)
        )
        for row in hit.collect():
            system, where = file_system(spark, row.file_path)
            system.delete(where, False)
            if content:
                out = system.create(where, True)
                out.write(bytearray(content))
                out.close()
    skipped = cut_lineage(skipped_files(spark, path, files, FACT_SCHEMA))
    set_aside(spark, path, skipped)
    read = read_listed(spark, path, files, FACT_SCHEMA, tolerant=True)
    sums = read.agg(F.count(F.lit(1)).alias("rows_left")).crossJoin(
        files.agg(F.sum("row_count").alias("rows_listed"))
    )
    return skipped.select("date_partition", "district", "batch_key", "reason", "row_count").crossJoin(sums)


@query
def snapshot_versions(spark, sf_dir):
    """Doubled counts are replaced, first two days by the right ones, then the whole table; each
    reader sees the version it began with."""
    path = work_folder(spark, "versions")
    incidents = ev.incidents(spark, sf_dir).where("processing_time IS NOT NULL")

    def counted(records: DataFrame) -> DataFrame:
        rows = rollups.statistics(cells.day_cells(records))
        return rows.withColumn("last_updated", F.col("last_updated").cast("timestamp"))

    def reader(phase: str) -> DataFrame:
        rows = read_table(spark, path, STATISTICS_SCHEMA).withColumn("phase", F.lit(phase))
        return rows.select("phase", "date_partition", "district", "crime_type", "crime_count")

    publish(counted(incidents.unionByName(incidents)), path)
    readers = [reader("doubled")]
    day = F.col("date_partition")
    days = counted(incidents).select(day).distinct().orderBy(day.desc()).limit(2)
    publish(counted(incidents), path, [r[0] for r in days.collect()])
    readers.append(reader("two days"))
    publish(counted(incidents), path)
    readers.append(reader("whole"))
    return reduce(DataFrame.unionByName, readers)


@query
def category_lookup_collated(spark, sf_dir):
    """Accents that no list names, in capitals: a collation finds the plain keys."""
    rows = ev.incidents(spark, sf_dir).select(
        "incident_id", F.upper(F.translate("crime_type", "ciehuo", "çïêĥüö")).alias("type")
    )
    return lookups.category_attribute(rows, "type", ev.EVENT_COLORS, collation="UNICODE_CI_AI")


@query
def category_counts_collated(spark, sf_dir):
    """Four spellings of every category count as one."""
    spelt = F.translate("crime_type", "ciehuo", "çïêĥüö")
    turn = F.col("incident_id") % 4
    rows = ev.incidents(spark, sf_dir).select(
        F.when(turn == 0, F.col("crime_type"))
        .when(turn == 1, F.upper("crime_type"))
        .when(turn == 2, spelt)
        .otherwise(F.upper(spelt))
        .alias("type")
    )
    return lookups.collated_counts(rows)


# ------------------------------------------------------- a second vocabulary


@query
def order_statistics(spark, sf_dir):
    return rollups.statistics(cells.day_cells(ev.order_records(spark, sf_dir)))


@query
def order_density(spark, sf_dir):
    rows = rollups.density(cells.day_cells(ev.order_records(spark, sf_dir)))
    return rows.drop("crime_type_counts").withColumn(
        "crime_types_list", _joined("crime_types_list")
    )


@query
def order_correlation(spark, sf_dir):
    days = cells.day_cells(ev.order_records(spark, sf_dir))
    return rollups.correlation(days, 5).withColumn(
        "crime_types_in_area", _joined("crime_types_in_area")
    )
