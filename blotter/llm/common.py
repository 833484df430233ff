"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.session import remove_folder, work_folder

# A fixed vocabulary or model file is sent to the executors only up to this size.
MAX_SHIPPED_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str = "llm", codec: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends at files that outlive
    any executor."""
    path = work_folder(df.sparkSession, purpose)
    df.write.option("compression", codec).parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._stored_below = path
    return found


def discard(*frames: DataFrame) -> None:
    """Delete the folders of stored frames that nothing reads any more."""
    for df in frames:
        remove_folder(df.sparkSession, df._stored_below)


def file_bytes(path: str) -> bytes:
    """A fixed vocabulary file, read once on the driver; its size is checked."""
    with open(path, "rb") as f:
        content = f.read(MAX_SHIPPED_BYTES + 1)
    if len(content) > MAX_SHIPPED_BYTES:
        raise ValueError(f"{path} is larger than {MAX_SHIPPED_BYTES} bytes")
    return content


def fresh_name(taken: Sequence[str], wanted: str) -> str:
    """``wanted``, with underscores until it clashes with no column (case is ignored)."""
    low = {c.lower() for c in taken}
    while wanted.lower() in low:
        wanted += "_"
    return wanted


def hashed_share(df: DataFrame, by: str, about: int, key: str = "doc_id") -> DataFrame:
    """About ``about`` rows of each value of ``by``, chosen by a hash of the key; all of a value
    with fewer. The share follows from counts over all rows, so no task gathers a value's rows."""
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias("_rows"))
    place = F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return df.join(counts, by).where(place * F.col("_rows") < about).drop("_rows")


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under fixed names; extra columns, whatever their names, are left out."""
    return df.select(*[F.col(f"`{c}`").alias(name) for name, c in columns.items()])
