"""The streaming job: one source, one topic and six tables per micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from blotter.operators.alerts import critical_alerts
from blotter.operators.cells import fold_to_days, hour_cells, merge_cells
from blotter.operators.envelope import fact_rows, topic_rows
from blotter.operators.rollups import REPORTERS as REPORTER_COLUMN
from blotter.operators.rollups import (
    correlation,
    count_reporters,
    density,
    merge_reporters,
    reporter_cells,
    statistics,
    temporal_profile,
)
from blotter.schema import (
    ALERT_SCHEMA,
    ALERT_THRESHOLDS,
    ALERTS,
    BATCH_KEY,
    CATEGORY_UNIVERSE,
    CELL_SCHEMA,
    CELLS,
    COMMITS,
    CORRELATION,
    DENSITY,
    FACT_SCHEMA,
    FACTS,
    NAMES,
    REPORTER_CELLS,
    REPORTERS,
    STATISTICS,
    TEMPORAL,
    TRIGGER_SECONDS,
    with_batch_key,
)
from blotter.session import exists, read_text, write_text
from blotter.sinks.commits import (
    Bounds,
    adopt,
    bounds_of,
    file_rows,
    fold_commits,
    packed_offsets,
    span_rows,
    stored_spans,
    without_spans,
    write_commit,
)
from blotter.sinks.compaction import GRACE_SECONDS, TARGET_BYTES, compact
from blotter.sinks.keys import (
    FOLD,
    LEVELS,
    batch_key,
    block_key,
    fold_folders,
    parsed_key,
    stored_keys,
    valid_keys,
)
from blotter.sinks.snapshots import publish
from blotter.sinks.tables import (
    DAY,
    DAY_AREA,
    REBALANCE,
    append_rows,
    replace_days,
    replace_partitions,
    replace_table,
    write_batch,
)
from blotter.sources.commits import FOLD_FILE, committed_keys

CUMULATIVE = "cumulative"
LAST_BATCH = "last-batch"
# How distinct reporters are kept over the batches.
NO_REPORTERS, SKETCH, EXACT = "none", "sketch", "exact"

# Names the session time zone that a job's days and hours were cut in.
ZONE_FILE = "_time_zone"

ROLLUPS = {
    STATISTICS: DAY,
    TEMPORAL: DAY_AREA,
    DENSITY: DAY,
    CORRELATION: DAY,
    REPORTERS: DAY,
}

# The tables that are read through commits: their schema and clock.
COMMITTED_TABLES = {FACTS: (FACT_SCHEMA, NAMES.clock), ALERTS: (ALERT_SCHEMA, "alert_time")}


@dataclass(frozen=True)
class Job:
    """Where and how the micro-batches are written.

    ``cumulative`` keeps every batch: facts, alerts and count cells are written under the
    batch key, so a rerun of a batch replaces its own rows, and the rollups of the days a
    batch touched are rebuilt from the cells. ``last-batch`` appends the facts and replaces
    each rollup table by the rollup of the latest batch alone.

    The cells of ``fold`` batches are folded into one folder, ``fold`` of these into the next,
    and so on, so that a refresh opens a number of folders that grows with the logarithm of
    the batches of a day. ``refresh=False`` leaves the rollup tables to ``refresh_rollups`` on
    a schedule.

    ``fact_layout`` places the facts: the default rebalances them into few files; ``as-is``
    saves that shuffle where every source task fills whole files anyway.

    With ``snapshots`` the rollup tables are kept in versions, so a reader sees either the old or the
    new table; plain readers of their folders then see nothing. ``reporters`` keeps the distinct
    reporters by date, area and category over the batches as well: ``sketch`` within about a percent
    in a few kilobytes a cell, ``exact`` with a row for each.

    A cumulative job commits each batch last, and readers take facts and alerts of committed
    batches only. Every ``pack_every`` batches (0: never) the small files of the batch's days are
    packed into files of up to ``pack_bytes``; what is replaced is deleted ``grace_seconds`` later. With
    ``once`` the source offsets of ``topic`` are remembered, and rows that another stream, such as a
    replay under a new checkpoint, has stored already are left out everywhere; one stream of
    a job runs at a time.
    """

    root: str
    mode: str = CUMULATIVE
    thresholds: Mapping[str, int] = field(default_factory=lambda: dict(ALERT_THRESHOLDS))
    universe: int = CATEGORY_UNIVERSE
    topic_writer: Callable[[DataFrame], None] | None = None
    refresh: bool = True
    compression: str = "gzip"
    fact_layout: str = REBALANCE
    fold: int = FOLD
    snapshots: bool = False
    reporters: str = NO_REPORTERS
    once: bool = False
    topic: str = ""
    pack_every: int = FOLD
    pack_bytes: int = TARGET_BYTES
    grace_seconds: float = GRACE_SECONDS

    def __post_init__(self) -> None:
        if self.mode not in (CUMULATIVE, LAST_BATCH):
            raise ValueError(f"unknown mode {self.mode!r}")
        if self.reporters not in (NO_REPORTERS, SKETCH, EXACT):
            raise ValueError(f"unknown way to count reporters {self.reporters!r}")
        if self.fold < 2:
            raise ValueError("at least two folders are folded into one")
        if self.once and self.mode != CUMULATIVE:
            raise ValueError("only a cumulative job can tell what it has stored")

    @property
    def keeps_commits(self) -> bool:
        return self.mode == CUMULATIVE

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"


def derive_rollups(merged_hours: DataFrame, universe: int) -> dict[str, DataFrame]:
    """The four rollup tables of a set of merged hour cells."""
    days = fold_to_days(merged_hours)
    return {
        STATISTICS: statistics(days),
        TEMPORAL: temporal_profile(merged_hours),
        DENSITY: density(days),
        CORRELATION: correlation(days, universe),
    }


def check_zone(spark: SparkSession, job: Job) -> None:
    """Refuse a session whose time zone is not the one the tables were written in.

    Days and hours of stored rows were cut in that zone; the first writer leaves its name.
    """
    _agree(spark, f"{job.root}/{ZONE_FILE}", spark.conf.get("spark.sql.session.timeZone"), "time zone")


def _agree(spark: SparkSession, path: str, value: str, name: str) -> None:
    """The value that the first writer has left, or leave it."""
    written = read_text(spark, path)
    if written is None:
        write_text(spark, path, value)
    elif written != value:
        raise ValueError(f"the tables were written with the {name} {written}, not {value}")


# ------------------------------------------------------- folders of cells


def cell_tables(job: Job) -> dict[str, tuple]:
    """The tables of mergeable cells: schema, how a batch makes them, how many become one."""
    tables = {CELLS: (CELL_SCHEMA, hour_cells, merge_cells)}
    if job.reporters != NO_REPORTERS:
        exact = job.reporters == EXACT
        kind = T.StringType() if exact else T.BinaryType()
        schema = T.StructType([f for f in CELL_SCHEMA if f.name in (NAMES.area, NAMES.category, NAMES.date)])
        tables[REPORTER_CELLS] = (
            schema.add(REPORTER_COLUMN, kind),
            partial(reporter_cells, exact=exact),
            partial(merge_reporters, exact=exact),
        )
    return tables


def _day_folders(spark: SparkSession, job: Job, day: str, table: str = CELLS) -> list[str]:
    """The batch keys of the cell folders of a day."""
    return stored_keys(spark, f"{job.path(table)}/{NAMES.date}={day}")


def _cells_of(
    spark: SparkSession, job: Job, day: str, keys: Sequence[str], table: str = CELLS
) -> DataFrame | None:
    root = job.path(table)
    paths = [f"{root}/{NAMES.date}={day}/{BATCH_KEY}={key}" for key in keys]
    if not paths:
        return None
    schema = with_batch_key(cell_tables(job)[table][0])
    return spark.read.schema(schema).option("basePath", root).parquet(*paths)


def stored_cells(
    spark: SparkSession, job: Job, days: Sequence[str], table: str = CELLS
) -> DataFrame:
    """The cells of the given days, every batch once; batches without a commit do not count."""
    known = set(committed_keys(spark, job.root)) if job.keeps_commits else None
    parts = []
    for day in days:
        keys = valid_keys(_day_folders(spark, job, day, table), job.fold)
        counting = [k for k in keys if _counts(k, known, job.fold)]
        parts.append(_cells_of(spark, job, day, counting, table))
    empty = spark.createDataFrame([], with_batch_key(cell_tables(job)[table][0]))
    found = [p.select(empty.columns) for p in parts if p is not None]
    return reduce(DataFrame.unionByName, found, empty)


def _counts(key: str, known: set[str] | None, fold: int) -> bool:
    """Whether a batch is committed, alone or in a folded block; blocks of cells always are."""
    if known is None or parsed_key(key)[1] > 0 or key in known:
        return True
    stream, _, block = parsed_key(key)
    ups = (block_key(stream, up, block // fold**up) for up in range(1, LEVELS + 1))
    return any(up in known for up in ups)


def fold_cells(
    spark: SparkSession, job: Job, stream_id: str, batch_id: int, days: Sequence[str]
) -> None:
    """Fold the blocks of cells that ended before this batch, by day."""
    for table, (_, _, merge) in cell_tables(job).items():
        for day in days:

            def write(keys: list[str], key: str, day=day, table=table, merge=merge) -> None:
                cells = _cells_of(spark, job, day, keys, table).drop(BATCH_KEY)
                write_batch(merge(cells), job.path(table), key, DAY, job.compression)

            path = f"{job.path(table)}/{NAMES.date}={day}"
            fold_folders(spark, path, stream_id, batch_id, job.fold, write)


# ----------------------------------------------------------------- commits


def not_stored(spark: SparkSession, job: Job, batch: DataFrame, stream_id: str) -> DataFrame:
    """The rows whose source offset no other stream has stored."""
    spans = stored_spans(spark, job.root, stream_id)
    return batch if spans is None else without_spans(batch, spans, job.topic)


def commit_batch(
    spark: SparkSession, job: Job, batch: DataFrame, key: str, bounds: Mapping[str, Bounds]
) -> None:
    """Make the files of a batch count, and remember the offsets it took."""
    rows = []
    for table, (schema, clock) in COMMITTED_TABLES.items():
        days = sorted({day for day, _ in bounds[table]})
        rows += file_rows(spark, job.root, table, schema, clock, key, days, bounds[table])
    spans = [span_rows(packed_offsets(batch, job.topic))] if job.once else []
    write_commit(spark, job.root, key, rows, spans)


def keep_commits(spark: SparkSession, job: Job, stream_id: str, batch_id: int, days: Sequence[str]) -> None:
    """Fold the commits of ended blocks and pack small files of sealed batches."""

    def write(keys: list[str], key: str) -> None:
        fold_commits(spark, job.root, keys, key, job.grace_seconds)

    fold_folders(spark, job.path(COMMITS), stream_id, batch_id, job.fold, write, job.grace_seconds)
    if job.pack_every and batch_id and batch_id % job.pack_every == 0:
        compact(
            spark,
            job.root,
            COMMITTED_TABLES,
            days,
            stream_id,
            batch_id,
            fan=job.fold,
            target_bytes=job.pack_bytes,
            codec=job.compression,
            grace_seconds=job.grace_seconds,
        )


def _together(spark: SparkSession, writes: Sequence[Callable[[], None]]) -> None:
    """Run independent writes side by side; the first failure is raised after all ended."""
    with ThreadPoolExecutor(max_workers=max(len(writes), 1)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]
    for write in running:
        write.result()


def write_rollups(
    spark: SparkSession,
    job: Job,
    tables: Mapping[str, DataFrame],
    days: Sequence[str] | None = None,
    grown: bool = False,
) -> None:
    """Write the derived rollup tables side by side.

    With ``days`` these days are replaced as a whole and no other one is touched; without, the
    tables are replaced. Cells that have only ``grown`` leave no stale partition to look for.
    """

    def write(table: str, rows: DataFrame) -> None:
        place = job.path(table), ROLLUPS[table]
        if job.snapshots:
            publish(rows, place[0], days, place[1], job.compression, grace_seconds=job.grace_seconds)
        elif days is None:
            replace_table(rows, *place, job.compression)
        elif grown:
            replace_partitions(rows, *place, job.compression)
        else:
            replace_days(rows, place[0], days, place[1], job.compression)

    _together(spark, [partial(write, *item) for item in tables.items()])


def derive_reporters(job: Job, merged: DataFrame) -> dict[str, DataFrame]:
    return {REPORTERS: count_reporters(merged, job.reporters == EXACT)}


def refresh_rollups(
    spark: SparkSession, job: Job, days: Sequence[str], grown: bool = False
) -> None:
    """Rebuild the rollup tables of the given days from the stored cells."""
    merged = merge_cells(stored_cells(spark, job, days)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tables = derive_rollups(merged, job.universe)
        if job.reporters != NO_REPORTERS:
            merge = cell_tables(job)[REPORTER_CELLS][2]
            tables |= derive_reporters(job, merge(stored_cells(spark, job, days, REPORTER_CELLS)))
        write_rollups(spark, job, tables, days, grown)
    finally:
        merged.unpersist()


def write_micro_batch(job: Job, batch: DataFrame, stream_id: str, batch_id: int) -> None:
    """Write one batch of decoded records everywhere; any failure fails the batch.

    The batch is persisted, so the source is read once for all writes.
    """
    spark = batch.sparkSession
    check_zone(spark, job)
    if job.keeps_commits:
        if not exists(spark, job.path(COMMITS)):
            adopt(spark, job.root, COMMITTED_TABLES, CELLS)
        _agree(spark, f"{job.path(COMMITS)}/{FOLD_FILE}", str(job.fold), "fold")
    if job.once:
        batch = not_stored(spark, job, batch, stream_id)
    batch = batch.drop(*_unread(job)).persist(StorageLevel.MEMORY_AND_DISK)
    hours = hour_cells(batch).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        facts = fact_rows(batch)
        alerts = critical_alerts(fold_to_days(hours), job.thresholds)
        paths = job.path(FACTS), job.path(CELLS), job.path(ALERTS)
        codec = job.compression
        writes: list[Callable[[], None]] = []
        if job.topic_writer is not None:
            writes.append(partial(job.topic_writer, topic_rows(batch)))
        if job.mode == CUMULATIVE:
            # The days and areas of one batch: as many as it writes folders of facts.
            bounds = {FACTS: bounds_of(batch, NAMES.clock)}
            days = sorted({day for day, _ in bounds[FACTS]})
            key = batch_key(stream_id, batch_id)
            rerun = any(key in _day_folders(spark, job, day) for day in days)
            writes += [
                partial(write_batch, facts, paths[0], key, DAY_AREA, codec, job.fact_layout),
                partial(write_batch, hours, paths[1], key, DAY, codec),
                *[
                    partial(write_batch, make(batch), job.path(table), key, DAY, codec)
                    for table, (_, make, _) in cell_tables(job).items()
                    if table != CELLS
                ],
                partial(
                    write_batch, alerts, paths[2], key, DAY_AREA, codec, days=days if rerun else ()
                ),
            ]
            writes.append(lambda: bounds.update({ALERTS: bounds_of(alerts, "alert_time")}))
            _together(spark, writes)
            if days:
                commit_batch(spark, job, batch, key, bounds)
            fold_cells(spark, job, stream_id, batch_id, days)
            chores: list[Callable[[], None]] = [
                partial(keep_commits, spark, job, stream_id, batch_id, days)
            ]
            if job.refresh:
                chores.append(partial(refresh_rollups, spark, job, days, not rerun))
            _together(spark, chores)
        else:
            # Both are filled in one pass before the writes share them.
            hours.count()
            writes += [
                partial(append_rows, facts, paths[0], DAY_AREA, codec, job.fact_layout),
                partial(replace_table, alerts, paths[2], DAY_AREA, codec),
                partial(write_rollups, spark, job, _last_batch_tables(job, hours, batch)),
            ]
            _together(spark, writes)
    finally:
        hours.unpersist()
        batch.unpersist()


def _unread(job: Job) -> list[str]:
    """The source columns that no write of the job reads; a batch is persisted without them."""
    if job.topic_writer is not None:
        return []
    return [NAMES.key, *([] if job.once else [NAMES.source_partition, NAMES.source_offset])]


def _last_batch_tables(job: Job, hours: DataFrame, batch: DataFrame) -> dict[str, DataFrame]:
    tables = derive_rollups(hours, job.universe)
    if job.reporters != NO_REPORTERS:
        tables |= derive_reporters(job, cell_tables(job)[REPORTER_CELLS][1](batch))
    return tables


def stream_id_of(batch: DataFrame) -> str:
    """The id Spark keeps in the checkpoint of the running query."""
    stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not stream_id:
        raise RuntimeError("the batch carries no stream id; its rows could not be told apart")
    return stream_id


def start(
    records: DataFrame,
    job: Job,
    checkpoint: str,
    trigger_seconds: int | None = TRIGGER_SECONDS,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start the job on a streaming frame of decoded records.

    ``trigger_seconds=None`` drains what is available and stops. The batch key starts with
    the id Spark keeps in the checkpoint: it survives restarts, and a new checkpoint, whose
    batch ids start again at 0, gets a new one.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        write_micro_batch(job, batch, stream_id_of(batch), batch_id)

    writer = (
        records.writeStream.foreachBatch(on_batch)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if query_name:
        writer = writer.queryName(query_name)
    if trigger_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{trigger_seconds} seconds").start()
