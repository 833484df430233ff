"""Writing commits, and the ledger of the source offsets that are stored.

The offsets of a batch are kept by blocks of 64: a block that is stored in part as a bit mask, whole
ones as runs (topic, partition, first, last). So neither offsets without gaps nor scattered ones
take a row each. A batch of another stream, such as a replay under a new checkpoint, leaves
out the rows whose offsets are stored.
"""

from __future__ import annotations

import json
import time
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.schema import BATCH_KEY, COMMIT_SCHEMA, COMMITS, NAMES
from blotter.session import file_system, write_text
from blotter.sinks.keys import parsed_key, valid_keys
from blotter.sources.commits import (
    FILE,
    GONE,
    SPAN,
    commit_rows,
    committed_keys,
    fold_of,
    without_gone,
)
from blotter.sources.tables import day_pattern, list_files, raw_days

# Offsets in one bucket of the interval joins; runs of offsets are found inside a bucket first.
BUCKET_OFFSETS = 1 << 16
# 2^6 offsets in one block, a bit each.
BLOCK_BITS = 6
_IN_BLOCK = (1 << BLOCK_BITS) - 1

_PLACE = ["topic", "source_partition"]
_SPAN = [*_PLACE, "first_offset", "last_offset", "bits"]


# -------------------------------------------------------------- intervals


def merged_spans(spans: DataFrame) -> DataFrame:
    """Runs of offsets that overlap or touch, as one; rows (topic, source_partition,
    first_offset, last_offset)."""
    order = Window.partitionBy(*_PLACE).orderBy("first_offset", "last_offset")
    before = F.max("last_offset").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (F.col("first_offset") > before + 1), 1).otherwise(0)
    run = F.sum("__opens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = spans.withColumn("__opens", opens).withColumn("__run", run)
    return (
        numbered.groupBy(*_PLACE, "__run")
        .agg(F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"))
        .drop("__run")
    )


def offset_spans(records: DataFrame, topic: str) -> DataFrame:
    """The runs of consecutive source offsets of the records; rows without one are left out.

    Runs are found inside buckets of offsets, so the rows of a hot partition meet in pieces of
    bounded length; only runs, not rows, of a partition are then put in order.
    """
    offset = F.col(NAMES.source_offset)
    taken = (
        records.where(F.col(NAMES.source_partition).isNotNull() & offset.isNotNull())
        .select(
            F.lit(topic).alias("topic"),
            F.col(NAMES.source_partition).alias("source_partition"),
            offset.alias("__at"),
        )
        .distinct()
    )
    return merged_spans(_runs_of(taken))


def _runs_of(numbers: DataFrame) -> DataFrame:
    """The runs of consecutive numbers ``__at`` inside buckets; each number is there once."""
    bucketed = numbers.withColumn("__bucket", F.floor(F.col("__at") / BUCKET_OFFSETS).cast("bigint"))
    rank = F.row_number().over(Window.partitionBy(*_PLACE, "__bucket").orderBy("__at"))
    return (
        bucketed.withColumn("__run", F.col("__at") - rank)
        .groupBy(*_PLACE, "__bucket", "__run")
        .agg(F.min("__at").alias("first_offset"), F.max("__at").alias("last_offset"))
        .select(*_PLACE, "first_offset", "last_offset")
    )


def _cut(spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spans as blocks stored in part (.., block, bits), each once, and runs of whole blocks.

    A span is a run of offsets or, where it has ``bits``, the marked ones of the block it names.
    """
    bits = F.col("bits") if "bits" in spans.columns else F.lit(None).cast("bigint")
    ends = spans.withColumns(
        {
            "bits": bits,
            "__low": F.shiftright("first_offset", BLOCK_BITS),
            "__high": F.shiftright("last_offset", BLOCK_BITS),
        }
    )
    low = F.expr(f"if(block = __low, shiftleft(-1L, cast(first_offset & {_IN_BLOCK} as int)), -1L)")
    high = F.expr(
        f"if(block = __high, shiftrightunsigned(-1L, {_IN_BLOCK} - cast(last_offset & {_IN_BLOCK} as int)), -1L)"
    )
    blocks = (
        ends.withColumn("block", F.explode(F.array_distinct(F.array("__low", "__high"))))
        .select(*_PLACE, "block", F.coalesce("bits", low.bitwiseAND(high)).alias("bits"))
        .groupBy(*_PLACE, "block")
        .agg(F.bit_or("bits").alias("bits"))
    )
    middle = ends.where(F.col("bits").isNull() & (F.col("__high") > F.col("__low") + 1))
    size = 1 << BLOCK_BITS
    first, last = (F.col("__low") + 1) * size, F.col("__high") * size - 1
    return blocks, middle.select(*_PLACE, first.alias("first_offset"), last.alias("last_offset"))


def _packed(blocks: DataFrame, runs: DataFrame) -> DataFrame:
    """Spans of blocks that are each there once, and of runs of whole blocks."""
    size, whole = 1 << BLOCK_BITS, F.col("bits") == -1
    first = (F.col("block") * size).alias("first_offset")
    last = (F.col("block") * size + size - 1).alias("last_offset")
    numbers = blocks.where(whole).select(*_PLACE, F.col("block").alias("__at"))
    full = _runs_of(numbers).select(
        *_PLACE,
        (F.col("first_offset") * size).alias("first_offset"),
        (F.col("last_offset") * size + size - 1).alias("last_offset"),
    )
    part = blocks.where(~whole).select(*_PLACE, first, last, "bits")
    return merged_spans(full.unionByName(runs)).unionByName(part, allowMissingColumns=True)


def packed_offsets(records: DataFrame, topic: str) -> DataFrame:
    """The source offsets of the records as spans; rows without one are left out.

    Only blocks, not rows, are shuffled, and only runs of whole blocks of a partition put in order.
    """
    offset = F.col(NAMES.source_offset)
    blocks = (
        records.where(F.col(NAMES.source_partition).isNotNull() & offset.isNotNull())
        .select(
            F.lit(topic).alias("topic"),
            F.col(NAMES.source_partition).alias("source_partition"),
            F.shiftright(offset, BLOCK_BITS).alias("block"),
            F.expr(f"shiftleft(1L, cast({NAMES.source_offset} & {_IN_BLOCK} as int))").alias("bit"),
        )
        .groupBy(*_PLACE, "block")
        .agg(F.bit_or("bit").alias("bits"))
    )
    none = blocks.select(*_PLACE, F.col("block").alias("first_offset"), F.col("block").alias("last_offset"))
    return _packed(blocks, none.where(F.lit(False)))


def packed_spans(spans: DataFrame) -> DataFrame:
    """Spans of several batches put together, each offset once."""
    return _packed(*_cut(spans))


def without_spans(records: DataFrame, spans: DataFrame, topic: str) -> DataFrame:
    """The records whose source offset lies in no span; rows without an offset stay.

    Rows and runs of whole blocks meet by buckets of offsets, of which a bucket holds few; rows and
    other blocks meet by the block, so a row meets one mask however scattered the offsets are.
    """
    blocks, runs = _cut(spans.where(F.col("topic") == topic))
    low, high = (F.floor(F.col(c) / BUCKET_OFFSETS) for c in ("first_offset", "last_offset"))
    known = runs.select(
        F.col("source_partition").alias("__partition"),
        "first_offset",
        "last_offset",
        F.explode(F.sequence(low, high)).alias("__bucket"),
    )
    masks = blocks.select(F.col("source_partition").alias("__partition"), "block", "bits")
    partition, offset = F.col(NAMES.source_partition), F.col(NAMES.source_offset)
    inside = (
        (partition == F.col("__partition"))
        & (F.floor(offset / BUCKET_OFFSETS) == F.col("__bucket"))
        & offset.between(F.col("first_offset"), F.col("last_offset"))
    )
    marked = (
        (partition == F.col("__partition"))
        & (F.shiftright(offset, BLOCK_BITS) == F.col("block"))
        & F.expr(f"shiftright(bits, cast({NAMES.source_offset} & {_IN_BLOCK} as int)) & 1 = 1")
    )
    return records.join(known, inside, "left_anti").join(masks, marked, "left_anti")


# ---------------------------------------------------------------- commits


# Rows, least and greatest clock (microseconds) of a batch by (day, area).
Bounds = dict[tuple[str, str], tuple[int, int | None, int | None]]


def bounds_of(df: DataFrame, clock: str) -> Bounds:
    """What a batch holds by day and area; as many rows as it writes folders reach the driver."""
    found = df.groupBy(NAMES.date, NAMES.area).agg(
        F.count(F.lit(1)), F.min(F.unix_micros(clock)), F.max(F.unix_micros(clock))
    )
    return {(r[0], r[1]): tuple(r)[2:] for r in found.collect()}


def _listed(spark: SparkSession, root: str, table: str, key: str, days: Sequence[str]) -> list[dict]:
    """The files that a key has on the given days; only its own folders are listed."""
    pattern = day_pattern(f"{root}/{table}", NAMES.date, days, f"/*/{BATCH_KEY}={key}/*.parquet")
    system, where = file_system(spark, pattern)
    found = []
    for status in system.globStatus(where) or []:
        path = status.getPath()
        values = dict(part.split("=", 1) for part in path.toString().split("/") if "=" in part)
        found.append(
            {
                "kind": FILE,
                "table": table,
                "key": key,
                NAMES.date: unquote(values[NAMES.date]),
                NAMES.area: unquote(values[NAMES.area]),
                "file_uri": path.toUri().toString(),
                "modified": status.getModificationTime() * 1000,
                "file_size": status.getLen(),
            }
        )
    return found


def file_rows(
    spark: SparkSession,
    root: str,
    table: str,
    schema,
    clock: str,
    key: str,
    days: Sequence[str],
    bounds: Bounds | None = None,
) -> list[dict]:
    """Commit rows of the files that a key has on the given days.

    With the bounds of the batch no file is opened where each folder has one; else the clock of
    the new files is read, in tasks.
    """
    if not days:
        return []
    files = _listed(spark, root, table, key, days)
    folders = [(f[NAMES.date], f[NAMES.area]) for f in files]
    if bounds is None or len(set(folders)) < len(files) or not set(folders) <= set(bounds):
        if not files:
            return []
        stored = raw_days(spark, f"{root}/{table}", days, schema, below=f"/*/{BATCH_KEY}={key}")
        counted = stored.groupBy(F.col("_metadata.file_path")).agg(
            F.count(F.lit(1)), F.min(F.unix_micros(clock)), F.max(F.unix_micros(clock))
        )
        told = {r[0]: tuple(r)[1:] for r in counted.collect()}
        measured = [told.get(f["file_uri"], (0, None, None)) for f in files]
    else:
        measured = [bounds[folder] for folder in folders]
    for file, (n, least, greatest) in zip(files, measured, strict=True):
        file |= {"row_count": n, "least": least, "greatest": greatest}
    return files


def gone_rows(replaced: Mapping[tuple[str, str], Sequence[str]]) -> list[dict]:
    """Commit rows that take keys out of a table's day."""
    now = int(time.time() * 1_000_000)
    return [
        {"kind": GONE, "table": table, "key": key, NAMES.date: day, "modified": now}
        for (table, day), keys in replaced.items()
        for key in keys
    ]


def span_rows(spans: DataFrame) -> DataFrame:
    return spans.withColumn("kind", F.lit(SPAN))


def write_commit(
    spark: SparkSession, root: str, key: str, rows: Sequence[dict], parts: Sequence[DataFrame] = ()
) -> None:
    """Make a batch count: its rows appear below the commits in one folder, by one rename.

    Rows about the files of a batch are written by the driver; parts that grow with rows, such
    as runs of offsets, by Spark.
    """
    folder = f"{root}/{COMMITS}/{BATCH_KEY}={key}"
    if not parts:
        aside = f"{root}/{COMMITS}/_aside-{key}"
        write_text(spark, f"{aside}/rows.json", "".join(json.dumps(r) + "\n" for r in rows))
        system, old = file_system(spark, aside)
        _, new = file_system(spark, folder)
        system.delete(new, True)
        if not system.rename(old, new):
            raise RuntimeError(f"the commit {key} could not be put in place")
        return
    whole = spark.createDataFrame([tuple(r.get(c) for c in COMMIT_SCHEMA.names) for r in rows], COMMIT_SCHEMA)
    for part in parts:
        whole = whole.unionByName(part, allowMissingColumns=True)
    keyed = whole.select(*COMMIT_SCHEMA.names).withColumn(BATCH_KEY, F.lit(key))
    (
        keyed.write.mode("overwrite")
        .partitionBy(BATCH_KEY)
        .option("partitionOverwriteMode", "dynamic")
        .json(f"{root}/{COMMITS}")
    )


def fold_commits(
    spark: SparkSession, root: str, keys: Sequence[str], key: str, grace_seconds: float
) -> None:
    """Some commits as one: replaced files go, spans of offsets are put together.

    A replaced key stays named while its files are in another block, or until twice the grace
    time has passed and its folders are deleted.
    """
    rows = commit_rows(spark, root, keys).drop(BATCH_KEY)
    files = rows.where(F.col("kind") == FILE)
    gone = rows.where(F.col("kind") == GONE)
    late = F.col("modified") <= int((time.time() - 2 * grace_seconds) * 1_000_000)
    paired = gone.where(late).join(files.select("table", "key", NAMES.date), ["table", "key", NAMES.date], "left_semi")
    needed = gone.join(
        paired.select("table", "key", NAMES.date), ["table", "key", NAMES.date], "left_anti"
    )
    spans = packed_spans(rows.where(F.col("kind") == SPAN).select(*_SPAN))
    kept = without_gone(rows).where(F.col("kind") == FILE)
    write_commit(spark, root, key, [], [kept, needed, span_rows(spans)])


def stored_spans(spark: SparkSession, root: str, stream_id: str) -> DataFrame | None:
    """The offsets that other streams have stored; nothing if there is no other stream."""
    others = [
        k for k in valid_keys(committed_keys(spark, root), fold_of(spark, root)) if parsed_key(k)[0] != stream_id
    ]
    if not others:
        return None
    rows = commit_rows(spark, root, others).where(F.col("kind") == SPAN)
    return rows.select(*_SPAN)


def adopt(spark: SparkSession, root: str, tables: Mapping[str, tuple], cells: str) -> None:
    """Commit what a job has stored before it kept commits; nothing if there is nothing.

    Every file is committed under the key of its folder, and every batch of the count cells
    counts as committed.
    """
    rows, keys = [], set()
    for table, (schema, clock) in tables.items():
        found = list_files(spark, f"{root}/{table}", (NAMES.date, NAMES.area, BATCH_KEY))
        here: dict[str, list[str]] = {}
        for row in found.select(NAMES.date, BATCH_KEY).distinct().collect():
            here.setdefault(row[1], []).append(row[0])
        for key, days in here.items():
            rows += file_rows(spark, root, table, schema, clock, key, days)
        keys |= set(here)
    batches = list_files(spark, f"{root}/{cells}", (NAMES.date, BATCH_KEY))
    keys |= {r[0] for r in batches.select(BATCH_KEY).distinct().collect()}
    if not keys:
        return
    for key in keys - {None}:
        system, where = file_system(spark, f"{root}/{COMMITS}/{BATCH_KEY}={key}")
        system.mkdirs(where)
    write_commit(spark, root, "adopted-000000000000", rows)
