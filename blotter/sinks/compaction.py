"""Putting the small files of sealed batches together.

Batches of a few seconds leave a folder per day, area and batch. Keys of a day whose bytes are of
one size class are packed into one key as soon as there are as many as ``fan`` of them, so a row is
rewritten once per size class and few small folders are left; a key of at least ``target_bytes`` is left
alone. The rows are written under the new key first; one commit then brings the new files and takes
the old keys out, so readers see each row once before, in between and after. Old folders are
deleted a grace time later, for those who have listed them.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from math import log

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.schema import BATCH_KEY, COMMITS, NAMES
from blotter.session import exists, file_system, remove_folder, subfolders
from blotter.sinks.commits import file_rows, gone_rows, write_commit
from blotter.sinks.keys import FOLD, is_pack, pack_key, parsed_key, stored_keys
from blotter.sinks.tables import DAY_AREA, write_batch
from blotter.sources.commits import GONE, commit_rows, job_root, live_files
from blotter.sources.tables import day_pattern, read_listed

TARGET_BYTES = 128 << 20
GRACE_SECONDS = 600.0
# The smallest size class ends here.
_LEAST_BYTES = 1 << 14


def size_class(size: int, fan: int) -> int:
    return 0 if size < _LEAST_BYTES else 1 + int(log(size / _LEAST_BYTES, fan))


def choose_keys(sizes: Mapping[str, int], fan: int) -> list[str]:
    """The keys of a day to be put together: those of all size classes with at least ``fan``.

    What the smaller classes give counts as one more key of the next.
    """
    classes: dict[int, list[str]] = {}
    for key, size in sizes.items():
        classes.setdefault(size_class(size, fan), []).append(key)
    chosen: list[str] = []
    for at in sorted(classes):
        if len(classes[at]) + bool(chosen) >= fan:
            chosen += sorted(classes[at])
    return chosen


def sealed_sizes(files: DataFrame, sealed: Callable[[str], bool], target_bytes: int) -> dict[str, dict[str, int]]:
    """Bytes by key of each day, of sealed keys below the target.

    Their number is bounded by the days times the size classes times the fan, whatever a day holds.
    """
    listed = files.groupBy(NAMES.date, BATCH_KEY).agg(F.sum("file_size").alias("size"))
    sizes: dict[str, dict[str, int]] = {}
    for row in listed.where(F.col("size") < target_bytes).collect():
        if sealed(row[BATCH_KEY]):
            sizes.setdefault(row[NAMES.date], {})[row[BATCH_KEY]] = row["size"]
    return sizes


def is_sealed(stream_id: str, batch_id: int | None) -> Callable[[str], bool]:
    """Keys that are never written again: packs, and batches of the stream before this one; all
    keys of all streams without a running batch."""

    def sealed(key: str) -> bool:
        stream, _, block = parsed_key(key)
        return batch_id is None or is_pack(key) or (stream == stream_id and block < batch_id)

    return sealed


def compact(
    spark: SparkSession,
    root: str,
    tables: Mapping[str, tuple],
    days: Sequence[str],
    stream_id: str,
    number: int,
    running: bool = True,
    fan: int = FOLD,
    target_bytes: int = TARGET_BYTES,
    codec: str = "gzip",
    grace_seconds: float = GRACE_SECONDS,
    before_commit: Callable[[], None] = lambda: None,
) -> dict[tuple[str, str], list[str]]:
    """Pack the given days of the tables {name: (schema, clock)}; the keys replaced by (table, day).

    ``number`` names the pack, mostly the running batch; a number is used once. ``running=False``
    says that no stream writes: all keys are sealed, and all below the target are packed. What an interrupted run has written
    without a commit is deleted first.
    """
    pack = pack_key(stream_id, number)
    if not days or exists(spark, f"{root}/{COMMITS}/{BATCH_KEY}={pack}"):
        return {}
    sealed = is_sealed(stream_id, number if running else None)
    found: list[dict] = []
    replaced: dict[tuple[str, str], list[str]] = {}
    for table, (schema, clock) in tables.items():
        path = f"{root}/{table}"
        remove_key(spark, path, days, pack)
        files = live_files(spark, path, days)
        chosen = {}
        for day, sizes in sealed_sizes(files, sealed, target_bytes).items():
            keys = choose_keys(sizes, fan) if running else sorted(sizes) * (len(sizes) > 1)
            if keys:
                chosen[day] = keys
        if not chosen:
            continue
        pairs = [(day, key) for day, keys in chosen.items() for key in keys]
        named = spark.createDataFrame(pairs, f"{NAMES.date} string, {BATCH_KEY} string")
        rows = read_listed(spark, path, files.join(named, [NAMES.date, BATCH_KEY], "left_semi"), schema)
        write_batch(rows, path, pack, DAY_AREA, codec)
        found += file_rows(spark, root, table, schema, clock, pack, sorted(chosen))
        replaced |= {(table, day): keys for day, keys in chosen.items()}
    if replaced:
        before_commit()
        write_commit(spark, root, pack, found + gone_rows(replaced))
    for table in tables:
        sweep(spark, f"{root}/{table}", grace_seconds)
    return replaced


def remove_key(spark: SparkSession, table_root: str, days: Sequence[str], key: str) -> None:
    """Delete the folders of a key on the given days, in all areas."""
    pattern = day_pattern(table_root, NAMES.date, days, f"/*/{BATCH_KEY}={key}")
    system, where = file_system(spark, pattern)
    for found in system.globStatus(where) or []:
        system.delete(found.getPath(), True)


def sweep(spark: SparkSession, table_root: str, grace_seconds: float) -> None:
    """Delete the folders of keys that were replaced longer than the grace ago."""
    root, table = job_root(table_root)
    gone = commit_rows(spark, root).where((F.col("kind") == GONE) & (F.col("table") == table))
    late = gone.where(F.col("modified") <= int((time.time() - grace_seconds) * 1_000_000))
    replaced: dict[str, set[str]] = {}
    for row in late.select(NAMES.date, "key").distinct().collect():  # named until they are folded
        replaced.setdefault(row[0], set()).add(row[1])
    for day, keys in replaced.items():
        path = f"{table_root}/{NAMES.date}={day}"
        for area in subfolders(spark, path):
            for key in keys.intersection(stored_keys(spark, f"{path}/{area}")):
                remove_folder(spark, f"{path}/{area}/{BATCH_KEY}={key}")
