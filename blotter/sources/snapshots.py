"""Reading tables that are kept in versions."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import SparkSession

from blotter.session import file_system, read_text

# Folders that begin with an underscore are no data to Spark's own listings.
POINTERS = "_pointers"
VERSIONS = "_versions"
VERSION = "version"


def read_pointer(spark: SparkSession, path: str) -> tuple[int, dict]:
    """The newest pointer of a table and its number; zero and nothing if there is none."""
    system, folder = file_system(spark, f"{path}/{POINTERS}")
    if not system.exists(folder):
        return 0, {"first": None, "parts": {}, "stale": []}
    names = [s.getPath().getName() for s in system.listStatus(folder)]
    newest = max((n for n in names if n.endswith(".json") and not n.startswith(".")), default=None)
    if newest is None:
        return 0, {"first": None, "parts": {}, "stale": []}
    text = read_text(spark, f"{path}/{POINTERS}/{newest}")
    return int(newest.removesuffix(".json")), json.loads(text)


def has_snapshots(spark: SparkSession, path: str) -> bool:
    system, folder = file_system(spark, f"{path}/{POINTERS}")
    return system.exists(folder)


def snapshot_folders(spark: SparkSession, path: str, days: Iterable[str] | None = None) -> list[str]:
    """The folders that the table consists of now, or those of the given days."""
    _, held = read_pointer(spark, path)
    wanted = None if days is None else set(days)
    return [
        f"{path}/{VERSIONS}/{VERSION}={version}/{held['first']}={day}"
        for day, version in sorted(held["parts"].items())
        if wanted is None or day in wanted
    ]
