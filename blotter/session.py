"""Session defaults, the shared work folder and small helper tables."""

from __future__ import annotations

import atexit
import tempfile
import time
import uuid
import zipfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "blotter", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC dates and adaptive execution; pass more settings as keywords.

    Keyword names use ``__`` for dots: ``spark__sql__shuffle__partitions="2000"``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the session names it in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="blotter-")


# Folders of this process that are deleted when it ends, with the session that made them.
_OWNED: dict[str, SparkSession] = {}


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name below the shared folder.

    Whoever asks for it deletes it when nothing reads it any more; what is left, such as the
    tables behind a result that is still to be read, goes when the process ends.
    """
    path = f"{shared_folder(spark)}/blotter-{purpose}-{uuid.uuid4().hex}"
    _OWNED[path] = spark
    return path


@atexit.register
def remove_owned() -> None:
    """Delete all folders that this process made and still owns."""
    for path, spark in list(_OWNED.items()):
        try:
            remove_folder(spark, path)
        except Exception:  # the JVM may be gone already
            _OWNED.pop(path, None)


def cut_lineage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    Whoever names the ``path`` removes it when the result has been used.
    """
    path = path or work_folder(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """The Hadoop file system of a path, and the path as it takes it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and all below it; an absent one is fine."""
    system, where = file_system(spark, path)
    system.delete(where, True)
    _OWNED.pop(path, None)


def folder_age(spark: SparkSession, path: str) -> float:
    """Seconds since a folder was last changed; 0 if it is absent."""
    system, where = file_system(spark, path)
    if not system.exists(where):
        return 0.0
    return max(0.0, time.time() - system.getFileStatus(where).getModificationTime() / 1000)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if it is absent."""
    system, where = file_system(spark, path)
    if not system.exists(where):
        return None
    stream = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, in place of an older one."""
    system, where = file_system(spark, path)
    out = system.create(where, True)
    out.write(bytearray(text, "utf-8"))
    out.close()


def exists(spark: SparkSession, path: str) -> bool:
    system, where = file_system(spark, path)
    return system.exists(where)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders right below a path; none if it is absent."""
    system, where = file_system(spark, path)
    if not system.exists(where):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(where) if s.isDirectory())


def move_files(spark: SparkSession, source: str, target: str, prefix: str) -> int:
    """Move the files right below one folder to another of the same file system; their number.

    The prefix keeps names of several folders apart; an absent folder has no files.
    """
    system, where = file_system(spark, source)
    if not system.exists(where):
        return 0
    _, there = file_system(spark, target)
    system.mkdirs(there)
    files = [s.getPath() for s in system.listStatus(where) if s.isFile()]
    for path in files:
        _, moved = file_system(spark, f"{target}/{prefix}{path.getName()}")
        if not system.rename(path, moved):
            raise RuntimeError(f"{path.getName()} could not be moved to {target}")
    return len(files)


@contextmanager
def work_folders(spark: SparkSession, purpose: str, count: int = 1) -> Iterator[list[str]]:
    """Folder names below the shared folder that are deleted at the end, also on failure."""
    paths = [work_folder(spark, purpose) for _ in range(count)]
    try:
        yield paths
    finally:
        for path in paths:
            remove_folder(spark, path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that a session can be
    started from any folder."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    # The driver serves the file to the executors; the archive itself may lie on its own disk.
    folder = tempfile.mkdtemp(prefix="blotter-package-")
    archive = f"{folder}/{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def lookup_table(
    spark: SparkSession, entries: Mapping[str, str] | Mapping[str, int], key: str, value: str
) -> DataFrame:
    """A two-column table from driver literals; Spark knows its bytes and decides the join."""
    text = any(isinstance(v, str) for v in entries.values())
    return spark.createDataFrame(
        pa.table(
            {
                key: pa.array(entries.keys(), pa.string()),
                value: pa.array(entries.values(), pa.string() if text else pa.int64()),
            }
        )
    )
