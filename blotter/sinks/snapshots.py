"""Tables that are replaced as a whole or by days without a moment in which half is new.

A snapshot table is a folder of versions and a folder of pointers. A write puts its rows into a new
version and then names, in a pointer that appears by one rename, the version that each day is
read from. Readers take the newest pointer once and read what it names, so whoever began before a
replace still reads the old table whole. Days that are no longer named are deleted a grace time
later. One writer at a time.
"""

from __future__ import annotations

import json
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from blotter.schema import NAMES
from blotter.session import file_system, remove_folder, subfolders, write_text
from blotter.sinks.tables import DAY, REBALANCE, replace_table
from blotter.sources.snapshots import POINTERS, VERSION, VERSIONS, read_pointer

GRACE_SECONDS = 600.0
# Pointers that are kept for readers that have listed them.
_KEPT_POINTERS = 16


def publish(
    df: DataFrame,
    path: str,
    days: Sequence[str] | None = None,
    partitions: Sequence[str] = DAY,
    compression: str = "gzip",
    layout: str = REBALANCE,
    grace_seconds: float = GRACE_SECONDS,
) -> int:
    """Replace the table, or only the given days of it, by the rows of ``df``; the new version.

    A given day without rows goes; rows of other days are not written. Partitions begin with
    the date. Days that are null are kept under Spark's name for them.
    """
    spark = df.sparkSession
    first = partitions[0]
    number, held = read_pointer(spark, path)
    version = number + 1
    rows = df if days is None else df.where(df[first].isin(list(days)))
    target = f"{path}/{VERSIONS}/{VERSION}={version}"
    replace_table(rows, target, partitions, compression, layout)
    written = {n.partition("=")[2] for n in subfolders(spark, target) if n.startswith(f"{first}=")}
    parts = {} if days is None else {d: v for d, v in held["parts"].items() if d not in set(days)}
    replaced = {d: v for d, v in held["parts"].items() if d not in parts}
    parts |= dict.fromkeys(written, version)
    now = time.time()
    stale = held["stale"] + [[d, v, now] for d, v in replaced.items()]
    due = [s for s in stale if now - s[2] >= grace_seconds]
    left = [s for s in stale if now - s[2] < grace_seconds]
    _point(spark, path, version, {"first": first, "parts": parts, "stale": left})
    for day, old, _ in due:
        remove_folder(spark, f"{path}/{VERSIONS}/{VERSION}={old}/{first}={day}")
    for old in {v for _, v, _ in due}.difference(parts.values(), (v for _, v, _ in left)):
        remove_folder(spark, f"{path}/{VERSIONS}/{VERSION}={old}")
    return version


def _point(spark: SparkSession, path: str, version: int, content: dict) -> None:
    """Write the pointer aside and rename it into place; delete the oldest ones."""
    system, folder = file_system(spark, f"{path}/{POINTERS}")
    system.mkdirs(folder)
    _, aside = file_system(spark, f"{path}/{POINTERS}/.{version:012d}.json")
    _, place = file_system(spark, f"{path}/{POINTERS}/{version:012d}.json")
    write_text(spark, f"{path}/{POINTERS}/.{version:012d}.json", json.dumps(content))
    if not system.rename(aside, place):
        raise RuntimeError(f"version {version} of {path} was written by another writer")
    names = sorted(s.getPath().getName() for s in system.listStatus(folder))
    for name in [n for n in names if n.endswith(".json") and not n.startswith(".")][:-_KEPT_POINTERS]:
        _, old = file_system(spark, f"{path}/{POINTERS}/{name}")
        system.delete(old, False)


def drop_days(spark: SparkSession, path: str, days: Sequence[str], grace_seconds: float = GRACE_SECONDS) -> None:
    """Take days out of a snapshot table, as a replace by nothing."""
    none = spark.createDataFrame([], f"{NAMES.date} string, __none int")
    publish(none, path, days, grace_seconds=grace_seconds)
