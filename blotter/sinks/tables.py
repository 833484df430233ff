"""Writing the partitioned Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.schema import BATCH_KEY, NAMES
from blotter.session import file_system, remove_folder
from blotter.sources.tables import day_pattern, list_files

DAY = (NAMES.date,)
DAY_AREA = (NAMES.date, NAMES.area)

# How rows are placed on tasks before a partitioned write.
REBALANCE = "rebalance"  # few files; adaptive execution splits hot partitions over tasks
AS_IS = "as-is"  # no shuffle; every task writes its share of every partition


def _placed(df: DataFrame, partitions: Sequence[str], layout: str) -> DataFrame:
    if layout == REBALANCE:
        return df.hint("rebalance", *partitions)
    if layout == AS_IS:
        return df
    raise ValueError(f"unknown layout {layout!r}")


def _write(
    df: DataFrame,
    path: str,
    partitions: Sequence[str],
    mode: str,
    compression: str,
    layout: str,
    **options: str,
) -> None:
    (
        _placed(df, partitions, layout)
        .write.mode(mode)
        .partitionBy(*partitions)
        .option("compression", compression)
        .options(**options)
        .parquet(path)
    )


def append_rows(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = DAY_AREA,
    compression: str = "gzip",
    layout: str = REBALANCE,
) -> None:
    """Add the rows to the table; a repeated write adds them again."""
    _write(df, path, partitions, "append", compression, layout)


def replace_table(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = DAY,
    compression: str = "gzip",
    layout: str = REBALANCE,
) -> None:
    """Replace the whole table, also by nothing."""
    _write(
        df, path, partitions, "overwrite", compression, layout, partitionOverwriteMode="static"
    )


def replace_partitions(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = DAY,
    compression: str = "gzip",
    layout: str = REBALANCE,
) -> None:
    """Replace only the partitions that have rows in ``df``."""
    _write(
        df, path, partitions, "overwrite", compression, layout, partitionOverwriteMode="dynamic"
    )


def _drop_stale(stale: DataFrame) -> None:
    """Delete the folders of listed files; one row per folder is collected."""
    folder = F.regexp_replace("file_path", "/[^/]*$", "").alias("folder")
    for row in stale.select(folder).distinct().collect():
        remove_folder(stale.sparkSession, row.folder)


def _without_rows(files: DataFrame, kept: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Listed files of partitions that have no rows in ``kept``."""
    named = kept.select(*[F.col(p).cast("string").alias(f"__{p}") for p in partitions]).distinct()
    same = [F.col(p).eqNullSafe(F.col(f"__{p}")) for p in partitions]
    return files.join(named, same, "left_anti")


def replace_days(
    df: DataFrame,
    path: str,
    days: Sequence[str],
    partitions: Sequence[str] = DAY,
    compression: str = "gzip",
    layout: str = REBALANCE,
) -> None:
    """Replace whole days: their partitions without rows in ``df`` go, also whole days.

    Rows of other days are not written. New files are in place before old folders go, so that
    a failure in between leaves too much and never too little, and a rerun mends it.
    """
    if not days:
        return
    first = partitions[0]
    rows = df.where(F.col(first).isin(list(days)))
    replace_partitions(rows, path, partitions, compression, layout)
    pattern = day_pattern(path, first, days)
    files = list_files(df.sparkSession, path, partitions, folder=pattern)
    _drop_stale(_without_rows(files, rows, partitions))


def write_batch(
    df: DataFrame,
    path: str,
    batch_key: str,
    partitions: Sequence[str] = DAY_AREA,
    compression: str = "gzip",
    layout: str = REBALANCE,
    days: Sequence[str] = (),
) -> None:
    """Add the rows of one batch under its key; a repeated write replaces them.

    With ``days``, the days the batch touches, folders under its key that an earlier attempt
    filled and this one does not are deleted.
    """
    keyed = df.withColumn(BATCH_KEY, F.lit(batch_key))
    below = "/*" * (len(partitions) - 1) + f"/{BATCH_KEY}={batch_key}"
    pattern = day_pattern(path, partitions[0], days, below)
    system, where = file_system(df.sparkSession, pattern)
    attempted = bool(days) and bool(system.globStatus(where))
    replace_partitions(keyed, path, [*partitions, BATCH_KEY], compression, layout)
    if attempted:
        names = [*partitions, BATCH_KEY]
        files = list_files(df.sparkSession, path, names, folder=pattern)
        _drop_stale(_without_rows(files, keyed, names))
