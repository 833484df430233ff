"""Live sets on streams."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from blotter.functions import seconds
from blotter.operators.feeds import first_per_id, live_rows
from blotter.schema import BATCH_KEY, INCIDENT_TTL_SECONDS
from blotter.session import subfolders, work_folders
from blotter.sinks.keys import batch_key
from blotter.sinks.tables import write_batch
from blotter.sources.tables import read_days
from blotter.streaming.chains import kept_arrivals, kept_rows
from blotter.streaming.job import stream_id_of

_SALTS = 32
# The feed is stored by arrival, in buckets one time to live wide.
BUCKET = "arrival_bucket"
# A batch of more slices than this is a catch-up.
FEW_SLICES = 8


def _bucket(epoch_seconds: int, ttl_seconds: int) -> int:
    return epoch_seconds - epoch_seconds % ttl_seconds


def _slices_after_stored(
    spark: SparkSession, path: str, slices: Sequence[int], key: str
) -> list[int]:
    """The slices later than every bucket that holds rows of another batch."""
    after = slices[0] - 1
    named = (name.partition("=") for name in subfolders(spark, path))
    buckets = [int(value) for name, _, value in named if name == BUCKET and value.lstrip("-").isdigit()]
    for bucket in sorted((b for b in buckets if b >= slices[0]), reverse=True):
        if set(subfolders(spark, f"{path}/{BUCKET}={bucket}")) - {f"{BATCH_KEY}={key}"}:
            after = bucket
            break
    return [at for at in slices if at > after]


def read_live(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    reference: datetime,
    ttl_seconds: int = INCIDENT_TTL_SECONDS,
    clock: str = "added_at",
) -> DataFrame:
    """The stored feed rows alive at the reference time.

    They lie in the reference's own bucket and the one before it; only these two folders
    are listed, however long the feed has been running. ``schema`` is that of the feed
    rows; a reference without a zone is taken as local time, as everywhere in Python.
    """
    epoch = int(reference.timestamp())
    buckets = [str(_bucket(epoch - back, ttl_seconds)) for back in (ttl_seconds, 0)]
    rows = read_days(
        spark, path, dict.fromkeys(buckets), _feed_schema(schema), partition=BUCKET
    )
    return live_rows(rows, F.lit(reference), ttl_seconds, clock)


def _feed_schema(schema: T.StructType) -> T.StructType:
    return T.StructType(
        schema.fields
        + [T.StructField(BUCKET, T.StringType()), T.StructField(BATCH_KEY, T.StringType())]
    )


def write_live_batch(
    batch: DataFrame,
    path: str,
    key: str,
    ids: Sequence[str],
    ttl_seconds: int = INCIDENT_TTL_SECONDS,
    clock: str = "added_at",
    tie: Sequence[str] | None = None,
) -> None:
    """Store the rows of one batch whose id is not live; a rerun replaces its own rows.

    The batch is taken in slices of arrival time one time to live wide, which are the buckets
    of the feed, in their order: a batch of a few seconds is one or two slices. Of a catch-up of
    many, the slices after all that is stored are taken at once (``streaming/chains.py``), with
    the same result, in a number of steps that grows with the logarithm of the slices. In a slice a row counts if no row of its id was kept less than the
    time to live before it, and of those the first one is kept. Kept times of an id are at least
    the time to live apart, so a slice keeps one row per id, and only the slice's own bucket
    and the one before it are read. Equal times are decided by the ``tie`` columns, by default
    all columns, so a rerun keeps the same rows. Rows without an arrival time are left out.
    """
    spark = batch.sparkSession
    epoch = F.unix_seconds(F.col(clock).cast("timestamp"))
    bucket = (epoch - F.pmod(epoch, F.lit(ttl_seconds))).cast("string")
    rows = batch.where(F.col(clock).isNotNull()).withColumn(BUCKET, bucket)
    rows.persist(StorageLevel.MEMORY_AND_DISK)
    order = list(batch.columns if tie is None else tie)
    schema = _feed_schema(batch.schema)
    last = F.max("__kept").alias("__last")
    named = [F.col(i).alias(f"__{i}") for i in ids]
    same = [F.col(i).eqNullSafe(F.col(f"__{i}")) for i in ids]
    try:
        slices = sorted(int(r[0]) for r in rows.select(BUCKET).distinct().collect())
        far = _slices_after_stored(spark, path, slices, key) if len(slices) > FEW_SLICES else []
        for at in slices[: len(slices) - len(far)]:
            near = [str(at - ttl_seconds), str(at)]
            stored = read_days(spark, path, near, schema, partition=BUCKET)
            # An earlier attempt of this batch may lie in this bucket; it is written anew.
            others = stored.where(
                (F.col(BATCH_KEY) != key) | (F.col(BUCKET) != str(at))
            ).withColumn("__kept", F.col(clock))
            kept = others.groupBy(*named).agg(last)
            part = rows.where(F.col(BUCKET) == str(at)).join(kept, same, "left")
            free = F.col("__last").isNull() | (
                F.col(clock) >= F.col("__last") + seconds(ttl_seconds)
            )
            fresh = first_per_id(part.where(free), list(ids), clock, order)
            write_batch(fresh.select(*batch.columns, BUCKET), path, key, (BUCKET,))
        if far:
            stored = read_days(spark, path, [str(far[0] - ttl_seconds)], schema, partition=BUCKET)
            part = rows.where(F.col(BUCKET).cast("long") >= far[0])
            with work_folders(spark, "chains") as [folder]:
                kept = kept_arrivals(part, stored, ids, clock, ttl_seconds, folder)
                fresh = kept_rows(part, kept, ids, clock)
                fresh = first_per_id(fresh, [*ids, BUCKET], clock, order)
                write_batch(fresh.select(*batch.columns, BUCKET), path, key, (BUCKET,))
    finally:
        rows.unpersist()


def start_live_feed(
    points: DataFrame,
    path: str,
    checkpoint: str,
    ids: Sequence[str] = ("id",),
    ttl_seconds: int = INCIDENT_TTL_SECONDS,
    clock: str = "added_at",
    trigger_seconds: int | None = 6,
    tie: Sequence[str] | None = None,
) -> StreamingQuery:
    """Keep the stored feed up to date with a stream of points."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        key = batch_key(stream_id_of(batch), batch_id)
        write_live_batch(batch, path, key, ids, ttl_seconds, clock, tie)

    writer = points.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if trigger_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{trigger_seconds} seconds").start()


def dedupe_live(
    stream: DataFrame, ids: Sequence[str], ttl_seconds: int, clock: str = "added_at"
) -> DataFrame:
    """Drop repeats of an id within the time to live, with Spark's own state.

    Spark may hold an id for up to twice the time to live; ``start_live_feed`` accepts it
    again after exactly one. A first pass drops repeats within salted ids, where the salt
    is the task of the row, so the rows of a hot id spread over tasks; the second pass sees
    at most one row per id and salt. Rows without a time are in no window and all pass.
    """
    typed = stream.withColumn(clock, F.col(clock).cast("timestamp"))
    timed = typed.where(F.col(clock).isNotNull()).withWatermark(clock, f"{ttl_seconds} seconds")
    salted = timed.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(_SALTS)))
    once = (
        salted.dropDuplicatesWithinWatermark([*ids, "__salt"])
        .drop("__salt")
        .dropDuplicatesWithinWatermark(list(ids))
    )
    return once.unionByName(typed.where(F.col(clock).isNull()))


def observe_feed(df: DataFrame, name: str, expired: str | None = None) -> DataFrame:
    """Count the rows that pass, and the expired ones, as query metrics."""
    counts = [F.count(F.lit(1)).alias("added_count")]
    if expired:
        counts.append(F.count_if(F.expr(expired)).alias("expired_count"))
    return df.observe(name, *counts)
