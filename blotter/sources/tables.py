"""Reading the partitioned Parquet tables, and what can be learnt from their files."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.operators.ranking import latest_overall, latest_per_group
from blotter.schema import NAMES, Names
from blotter.sources.commits import has_commits, live_files
from blotter.sources.snapshots import VERSIONS, has_snapshots, snapshot_folders

# The folder name Spark gives to a null partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"

# Listed files are opened by name up to this number; beyond it their folders are scanned.
MOST_PATHS = 10_000

# Fixed by Spark's binaryFile source.
_FILE_FIELDS = [
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
]

_LISTING_FIELDS = [
    T.StructField("file_path", T.StringType()),
    T.StructField("file_uri", T.StringType()),
    T.StructField("modified", T.TimestampType()),
    T.StructField("file_size", T.LongType()),
]


def _or_empty(
    spark: SparkSession, load: Callable[[], DataFrame], schema: T.StructType
) -> DataFrame:
    """Exactly the columns of the schema; no rows where the path does not exist."""
    try:
        return load().select(*schema.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _reader(spark: SparkSession, schema: T.StructType, tolerant: bool) -> DataFrameReader:
    flag = str(tolerant).lower()
    return (
        spark.read.schema(schema)
        .option("ignoreCorruptFiles", flag)
        .option("ignoreMissingFiles", flag)
    )


def read_table(
    spark: SparkSession, root: str, schema: T.StructType, tolerant: bool = False
) -> DataFrame:
    """A whole table with a declared schema; an absent table reads as empty.

    ``tolerant`` skips files that cannot be read and files that vanish during the scan. Of a
    job's table that is kept with commits only what is committed counts, each row once; of a
    table in versions the newest one is read, also after a later one has come.
    """
    if has_commits(spark, root):
        return read_listed(spark, root, live_files(spark, root), schema, tolerant)
    if has_snapshots(spark, root):
        return _read_snapshot(spark, root, None, schema, tolerant)
    reader = _reader(spark, schema, tolerant)
    return _or_empty(spark, partial(reader.parquet, root), schema)


def read_days(
    spark: SparkSession,
    root: str,
    days: Iterable[str],
    schema: T.StructType,
    tolerant: bool = False,
    partition: str = NAMES.date,
) -> DataFrame:
    """Only the given days of a table, or the given values of another first partition.

    Their folders are read by name in one scan, without listing the table. A day without a
    folder has no rows. Tables with commits or versions are read as ``read_table`` reads them.
    """
    days = list(days)
    if partition == NAMES.date and has_commits(spark, root):
        return read_listed(spark, root, live_files(spark, root, days), schema, tolerant)
    if has_snapshots(spark, root):
        return _read_snapshot(spark, root, days, schema, tolerant)
    return raw_days(spark, root, days, schema, tolerant, partition)


def _read_snapshot(
    spark: SparkSession, root: str, days: Iterable[str] | None, schema: T.StructType, tolerant: bool
) -> DataFrame:
    folders = snapshot_folders(spark, root, days)
    if not folders:
        return spark.createDataFrame([], schema)
    reader = _reader(spark, schema, tolerant).option("basePath", f"{root}/{VERSIONS}")
    return _or_empty(spark, partial(reader.parquet, *folders), schema)


def day_pattern(root: str, partition: str, days: Iterable[str], below: str = "") -> str:
    """The folders of some days, or what lies below them, as one pattern."""
    # A slash inside the braces makes this a list of paths instead of a search of the root.
    return f"{root}{{{','.join(f'/{partition}={day}' for day in days)}}}{below}"


def raw_days(
    spark: SparkSession,
    root: str,
    days: Iterable[str],
    schema: T.StructType,
    tolerant: bool = False,
    partition: str = NAMES.date,
    below: str = "",
) -> DataFrame:
    """All that lies in the folders of the given days, committed or not, or below a pattern in them."""
    days = list(days)
    if not days:
        return spark.createDataFrame([], schema)
    reader = _reader(spark, schema, tolerant).option("basePath", root)
    pattern = day_pattern(root, partition, days, below)
    return _or_empty(spark, partial(reader.parquet, pattern), schema)


def read_listed(
    spark: SparkSession, root: str, files: DataFrame, schema: T.StructType, tolerant: bool = False
) -> DataFrame:
    """The rows of listed files, without listing a folder unless they are very many.

    If some are not there any more, as after a folder was dropped, the others count.
    """
    paths = [r[0] for r in files.select("file_path").limit(MOST_PATHS + 1).collect()]
    if not paths:
        return spark.createDataFrame([], schema)
    if len(paths) <= MOST_PATHS:
        reader = _reader(spark, schema, tolerant).option("basePath", root)
        try:
            return reader.parquet(*paths).select(*schema.names)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return read_files(spark, root, files, schema, tolerant)


def list_files(
    spark: SparkSession,
    root: str,
    partitions: Sequence[str] = (NAMES.date, NAMES.area),
    day: str | None = None,
    folder: str | None = None,
) -> DataFrame:
    """One row per Parquet file with its partition values; no file is opened.

    ``file_path`` is the path to open, ``file_uri`` the same file as table scans name it.
    With ``day`` only that day's folder is listed, with ``folder`` only what lies below this
    pattern. An absent folder lists as empty.
    """
    keys = [T.StructField(p, T.StringType()) for p in partitions]
    reader = (
        spark.read.format("binaryFile")
        .schema(T.StructType(_FILE_FIELDS + keys))
        .option("basePath", root)
        .option("pathGlobFilter", "*.parquet")
    )
    path = folder or (f"{root}/{partitions[0]}={day}" if day else root)

    def load() -> DataFrame:
        return reader.load(path).select(
            *partitions,
            F.col("path").alias("file_path"),
            F.col("_metadata.file_path").alias("file_uri"),
            F.col("modificationTime").alias("modified"),
            F.col("length").alias("file_size"),
        )

    return _or_empty(spark, load, T.StructType(keys + _LISTING_FIELDS))


def discover_areas(
    files: DataFrame, default: Sequence[str] = (), names: Names = NAMES
) -> DataFrame:
    """The areas that have files; the default list when there are none."""
    found = files.select(names.area).distinct()
    if not default:
        return found
    fallback = files.sparkSession.createDataFrame([(a,) for a in default], f"{names.area} string")
    return found.unionByName(fallback.where(~files.exists()))


def file_census(files: DataFrame, keys: Sequence[str] = (NAMES.date, NAMES.area)) -> DataFrame:
    """Per partition: number of files, newest file and its time, bytes."""
    return files.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("file_count"),
        F.max(F.struct("modified", "file_path"))["file_path"].alias("newest_file"),
        F.max("modified").alias("newest_time"),
        F.sum("file_size").alias("total_bytes"),
    )


def latest_files(files: DataFrame, k: int, group: Sequence[str] = (NAMES.area,)) -> DataFrame:
    """The ``k`` newest files of each group, or of all with an empty group."""
    order = [F.desc("modified"), F.asc("file_path")]
    if not group:
        return latest_overall(files, order, k)
    return latest_per_group(files, list(group), order, k)


def read_files(
    spark: SparkSession, root: str, files: DataFrame, schema: T.StructType, tolerant: bool = True
) -> DataFrame:
    """The rows of the listed files, by one scan of the folders they lie in.

    The folders are the values of the listing's first partition, such as the days; inside them
    the scan keeps the listed files by name. Files that vanished since are skipped.
    """
    first = files.columns[0]
    days = [r[0] for r in files.select(first).distinct().collect()]
    folders = ",".join(f"/{first}={NULL_FOLDER if d is None else d}" for d in days)
    if not folders:
        return spark.createDataFrame([], schema)
    reader = _reader(spark, schema, tolerant).option("basePath", root)

    def load() -> DataFrame:
        table = reader.parquet(f"{root}{{{folders}}}")
        named = table.select("*", F.col("_metadata.file_path").alias("file_uri"))
        return named.join(files.select("file_uri"), "file_uri", "left_semi")

    return _or_empty(spark, load, schema)


def sample_read(table: DataFrame) -> DataFrame:
    """One row: number of rows, the columns, and the first record as JSON.

    The count and the file whose name comes first need no column, so Parquet answers them from
    its footers. The record is the first one of that file, and only that file is opened for it.
    """
    record = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("first_record")
    counted = table.agg(
        F.count(F.lit(1)).alias("row_count"), F.lit(",".join(table.columns)).alias("columns")
    )
    if not table.inputFiles():
        return counted.withColumn("first_record", F.lit(None).cast("string"))
    name = table.agg(F.min("_metadata.file_path")).first()[0]
    opened = table.where(F.col("_metadata.file_path") == name)
    first = opened.orderBy("_metadata.row_index").limit(1).select(record)
    return counted.withColumn("first_record", first.scalar())
