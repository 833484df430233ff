"""What the batches of a job have committed: files with their rows, bytes and clock bounds.

A batch writes its folders first and one commit folder last, which appears by a rename. Files of
a batch without a commit do not count, nor do files of keys that a later commit has replaced. The
commits are folded like the count cells, so a reader opens few folders, and none of the data.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.schema import BATCH_KEY, COMMIT_SCHEMA, COMMITS, COMMITTED, NAMES, with_batch_key
from blotter.session import exists, read_text
from blotter.sinks.keys import FOLD, stored_keys, valid_keys

FILE, GONE, SPAN = "file", "gone", "span"
FOLD_FILE = "_fold"


def job_root(table_root: str) -> tuple[str, str]:
    """The root of the job and the name of the table that a path stands for."""
    root, _, table = table_root.rstrip("/").rpartition("/")
    return root, table


def has_commits(spark: SparkSession, table_root: str) -> bool:
    """Whether this is a table whose rows count by commits."""
    root, table = job_root(table_root)
    return table in COMMITTED and exists(spark, f"{root}/{COMMITS}")


def committed_keys(spark: SparkSession, root: str) -> list[str]:
    """All commit keys: of single batches, of folded blocks and of compactions."""
    return stored_keys(spark, f"{root}/{COMMITS}")


def fold_of(spark: SparkSession, root: str) -> int:
    """How many commits a folded block holds: the writer leaves the number beside them."""
    return int(read_text(spark, f"{root}/{COMMITS}/{FOLD_FILE}") or FOLD)


def commit_rows(spark: SparkSession, root: str, keys: Iterable[str] | None = None) -> DataFrame:
    """The rows of the given commits, by default of all, each once."""
    if keys is None:
        keys = valid_keys(committed_keys(spark, root), fold_of(spark, root))
    folders = [f"{root}/{COMMITS}/{BATCH_KEY}={key}" for key in keys]
    schema = with_batch_key(COMMIT_SCHEMA)
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", f"{root}/{COMMITS}")
    return reader.json(folders)


def without_gone(rows: DataFrame) -> DataFrame:
    """File rows whose key was not replaced on their day, and all other rows."""
    gone = rows.where(F.col("kind") == GONE).select(
        F.col("table").alias("__table"), F.col("key").alias("__key"), F.col(NAMES.date).alias("__date")
    )
    same = [
        F.col("table") == F.col("__table"),
        F.col("key") == F.col("__key"),
        F.col(NAMES.date).eqNullSafe(F.col("__date")),
    ]
    files = rows.where(F.col("kind") == FILE).join(gone, same, "left_anti")
    return files.unionByName(rows.where(F.col("kind") != FILE))


def live_files(
    spark: SparkSession,
    table_root: str,
    days: Iterable[str] | None = None,
    since: Column | None = None,
    until: Column | None = None,
) -> DataFrame:
    """One row per file that counts, as a listing of the folders would tell, and more.

    Besides partition values, path, time and size: rows and the least and greatest clock. With
    ``since`` and ``until`` only files that can hold rows after the one and up to the other; a
    file without a clock always can. No folder of the table is listed and no file is opened.
    """
    root, table = job_root(table_root)
    rows = commit_rows(spark, root).where(F.col("table") == table)
    if days is not None:
        rows = rows.where(F.col(NAMES.date).isin(list(days)))
    files = without_gone(rows).where(F.col("kind") == FILE)
    times = ("modified", "least", "greatest")
    files = files.withColumns({c: F.timestamp_micros(c) for c in times})
    if since is not None:
        files = files.where(F.col("greatest").isNull() | (F.col("greatest") > since))
    if until is not None:
        files = files.where(F.col("least").isNull() | (F.col("least") <= until))
    # A URI escapes what a path does not; a plus sign stands for itself in both.
    path = F.url_decode(F.replace("file_uri", F.lit("+"), F.lit("%2B")))
    return files.select(
        NAMES.date,
        NAMES.area,
        F.col("key").alias(BATCH_KEY),
        path.alias("file_path"),
        "file_uri",
        "modified",
        "file_size",
        "row_count",
        "least",
        "greatest",
    )


def manifest_census(files: DataFrame, keys: Iterable[str] = (NAMES.date, NAMES.area)) -> DataFrame:
    """Per partition: number of files, rows, newest file, bytes and clock bounds."""
    return files.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("file_count"),
        F.sum("row_count").alias("row_count"),
        F.max(F.struct("modified", "file_path"))["file_path"].alias("newest_file"),
        F.sum("file_size").alias("total_bytes"),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
    )
