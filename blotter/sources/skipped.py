"""Which files a tolerant read has left out, and why."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.schema import BATCH_KEY, NAMES, with_batch_key
from blotter.session import file_system
from blotter.sources.tables import day_pattern, list_files, raw_days

VANISHED, CORRUPT, SHORT = "vanished", "corrupt", "short"
ASIDE = "_aside"
_PARTITIONS = (NAMES.date, NAMES.area, BATCH_KEY)


def skipped_files(spark: SparkSession, root: str, files: DataFrame, schema) -> DataFrame:
    """The listed files that cannot be read, with ``reason`` and the rows that were read of them.

    ``files`` is a listing with row counts, as the commits give it. Footers are read in tasks, so a
    file without a sound footer is found without reading its data: it is ``corrupt``. One that
    is not in its folder any more, or has no bytes, is ``vanished``, one with fewer rows than committed
    ``short``.
    """
    days = [r[0] for r in files.select(NAMES.date).distinct().collect()]
    rows = raw_days(spark, root, days, with_batch_key(schema), tolerant=True)
    uri = F.col("_metadata.file_path").alias("__uri")
    try:
        counted = rows.groupBy(uri).agg(F.count(F.lit(1)).alias("rows_read"))
    except AnalysisException:  # no folder is left, so these are rows of no file
        counted = spark.createDataFrame([], "__uri string, rows_read bigint")
    here = list_files(spark, root, _PARTITIONS, folder=day_pattern(root, NAMES.date, days))
    there = here.select(F.col("file_uri").alias("__here")) if days else here.select("file_uri").limit(0).toDF("__here")
    joined = (
        files.join(counted, F.col("file_uri") == F.col("__uri"), "left")
        .join(there, F.col("file_uri") == F.col("__here"), "left")
        .withColumn("rows_read", F.coalesce("rows_read", F.lit(0)))
    )
    reason = (
        F.when(F.col("__here").isNull(), VANISHED)
        .when((F.col("rows_read") == 0) & (F.col("row_count") > 0), CORRUPT)
        .when(F.col("rows_read") < F.col("row_count"), SHORT)
    )
    return joined.withColumn("reason", reason).where("reason IS NOT NULL").select(
        *files.columns, "rows_read", "reason"
    )


def set_aside(spark: SparkSession, root: str, skipped: DataFrame) -> int:
    """Move the corrupt files below a folder that no reader lists; how many were moved.

    Their places in the table are kept below it. As many names reach the driver as files are corrupt.
    """
    moved = 0
    for row in skipped.where(F.col("reason") == CORRUPT).select("file_path").collect():
        name = row[0].rsplit(f"{root.rsplit('/', 1)[-1]}/", 1)[1]
        system, old = file_system(spark, row[0])
        _, new = file_system(spark, f"{root}/{ASIDE}/{name}")
        system.mkdirs(new.getParent())
        moved += bool(system.rename(old, new))
    return moved
