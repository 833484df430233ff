from datetime import datetime
from pathlib import Path
from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from blotter.schema import FACT_SCHEMA, with_batch_key
from blotter.session import remove_folder, shared_folder, subfolders, work_folders
from blotter.sinks.tables import (
    DAY_AREA,
    append_rows,
    replace_days,
    replace_partitions,
    replace_table,
    write_batch,
)
from blotter.sources.tables import (
    discover_areas,
    file_census,
    latest_files,
    list_files,
    read_days,
    read_files,
    read_table,
    sample_read,
)

KEYS = ("date_partition", "district", "batch_key")
AT = datetime(2025, 8, 4, 12)


def facts(spark, data):
    return spark.createDataFrame(
        [(p, AT, AT, "robo", "h", day, area) for p, day, area in data], FACT_SCHEMA
    )


def payloads(df):
    return sorted(r.crime_data for r in df.collect())


@pytest.fixture
def lots(spark, tmp_path):
    """Three lots over two days and three areas, one file per lot and partition."""
    root = str(tmp_path / "facts")
    for lot, data in enumerate(
        [
            [("a0", "2025-08-04", "Norte"), ("b0", "2025-08-04", "Sur")],
            [("a1", "2025-08-04", "Norte"), ("c1", "2025-08-05", "Vía a la Costa")],
            [("a2", "2025-08-04", "Norte"), ("d2", "2025-08-05", "Sur")],
        ]
    ):
        write_batch(facts(spark, data), root, f"lot-{lot}")
    return root


def test_day_scan_prunes_and_tolerates_missing_days(spark, lots):
    schema = with_batch_key(FACT_SCHEMA)
    scan = read_days(spark, lots, ["2025-08-05", "1999-01-01"], schema)
    assert payloads(scan) == ["c1", "d2"]
    assert {r.date_partition for r in scan.collect()} == {"2025-08-05"}
    assert read_days(spark, lots, [], schema).count() == 0
    assert read_table(spark, lots + "-absent", schema).count() == 0


def test_census_and_areas(spark, lots):
    files = list_files(spark, lots, KEYS)
    census = rows(file_census(files), "date_partition", "district")
    assert [(c["date_partition"], c["district"], c["file_count"]) for c in census] == [
        ("2025-08-04", "Norte", 3),
        ("2025-08-04", "Sur", 1),
        ("2025-08-05", "Sur", 1),
        ("2025-08-05", "Vía a la Costa", 1),
    ]
    assert "batch_key=lot-2" in census[0]["newest_file"]
    day = list_files(spark, lots, KEYS, day="2025-08-05")
    assert {r.district for r in discover_areas(day, ["Centro"]).collect()} == {
        "Sur",
        "Vía a la Costa",
    }
    none = list_files(spark, lots, KEYS, day="1999-01-01")
    assert [r.district for r in discover_areas(none, ["Centro", "Sur"]).collect()] == [
        "Centro",
        "Sur",
    ]
    assert discover_areas(none).count() == 0


def test_latest_files(spark, lots):
    schema = with_batch_key(FACT_SCHEMA)
    files = list_files(spark, lots, KEYS)
    newest = latest_files(files, 2, group=["date_partition", "district"])
    found = payloads(read_files(spark, lots, newest, schema))
    assert found == ["a1", "a2", "b0", "c1", "d2"]
    overall = latest_files(files, 2, group=())
    assert payloads(read_files(spark, lots, overall, schema)) == ["a2", "d2"]
    assert read_files(spark, lots, files.where("false"), schema).columns == schema.names


def test_null_areas_and_vanished_files(spark, tmp_path):
    """Rows of a null area are read like any other, and a file removed after the listing is
    skipped."""
    root = str(tmp_path / "facts")
    data = [("a", "2025-08-04", None), ("b", "2025-08-04", "Sur"), ("c", None, "Sur")]
    write_batch(facts(spark, data), root, "lot-0")
    schema = with_batch_key(FACT_SCHEMA)
    files = list_files(spark, root, KEYS).cache()
    assert files.count() == 3
    assert payloads(read_files(spark, root, files, schema)) == ["a", "b", "c"]
    scan = read_files(spark, root, files, schema)
    next(Path(root).glob("date_partition=2025-08-04/district=Sur/*/*.parquet")).unlink()
    assert payloads(read_files(spark, root, files, schema)) == ["a", "c"]
    assert payloads(scan) == ["a", "c"]
    files.unpersist()


def test_batch_rerun_and_whole_days_leave_nothing_stale(spark, tmp_path):
    day, after = "2025-08-04", "2025-08-05"
    root = str(tmp_path / "batch")
    write_batch(facts(spark, [("a", day, "N"), ("b", day, "S")]), root, "s-1", days=[day])
    write_batch(facts(spark, [("z", day, "S")]), root, "s-2", days=[day])
    write_batch(facts(spark, [("a", day, "N")]), root, "s-1", days=[day])
    assert payloads(read_table(spark, root, FACT_SCHEMA)) == ["a", "z"]
    root = str(tmp_path / "days")
    replace_table(facts(spark, [("a", day, "N"), ("b", day, "S"), ("c", after, "N")]), root, DAY_AREA)
    replace_days(facts(spark, [("d", day, "S"), ("e", "2025-08-06", "S")]), root, [day], DAY_AREA)
    assert payloads(read_table(spark, root, FACT_SCHEMA)) == ["c", "d"]
    replace_days(facts(spark, []), root, [after], DAY_AREA)
    assert payloads(read_table(spark, root, FACT_SCHEMA)) == ["d"]


def test_corrupt_file_yields_no_rows(spark, lots):
    victim = next(Path(lots).glob("date_partition=2025-08-05/district=Sur/*/*.parquet"))
    victim.write_bytes(b"not parquet")
    victim.with_name(f".{victim.name}.crc").unlink(missing_ok=True)
    schema = with_batch_key(FACT_SCHEMA)
    readable = ["a0", "a1", "a2", "b0", "c1"]
    assert payloads(read_table(spark, lots, schema, tolerant=True)) == readable
    files = list_files(spark, lots, KEYS)
    assert payloads(read_files(spark, lots, files, schema)) == readable
    with pytest.raises(Exception, match="FAILED_READ_FILE|not a Parquet"):
        read_table(spark, lots, schema).collect()


def test_sample_read(spark, lots):
    sample = sample_read(read_table(spark, lots, FACT_SCHEMA)).first()
    assert sample.row_count == 6
    assert sample.columns.split(",") == FACT_SCHEMA.names
    assert '"crime_data":"' in sample.first_record
    empty = sample_read(read_table(spark, lots + "-absent", FACT_SCHEMA)).first()
    assert (empty.row_count, empty.first_record) == (0, None)


def test_sample_counts_without_reading_columns(spark, lots):
    table = read_table(spark, lots, FACT_SCHEMA)
    text = table.agg(F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in text


def test_append_twice_doubles_and_batch_twice_does_not(spark, tmp_path):
    df = facts(spark, [("a", "2025-08-04", "Norte")])
    for _ in range(2):
        append_rows(df, str(tmp_path / "plain"))
        write_batch(df, str(tmp_path / "keyed"), "s-000000000001")
    assert read_table(spark, str(tmp_path / "plain"), FACT_SCHEMA).count() == 2
    assert read_table(spark, str(tmp_path / "keyed"), FACT_SCHEMA).count() == 1
    files = list(tmp_path.glob("plain/*/*/*.parquet"))
    assert files and all(f.name.endswith(".gz.parquet") for f in files)


def test_whole_and_partial_replacement(spark, tmp_path):
    first = facts(spark, [("a", "2025-08-04", "N"), ("b", "2025-08-05", "N")])
    second = facts(spark, [("c", "2025-08-05", "N")])
    for path, write, kept in (
        ("whole", replace_table, ["c"]),
        ("part", replace_partitions, ["a", "c"]),
    ):
        root = str(tmp_path / path)
        write(first, root)
        write(second, root)
        assert payloads(read_table(spark, root, FACT_SCHEMA)) == kept
    replace_table(first.where("false"), str(tmp_path / "whole"))
    assert read_table(spark, str(tmp_path / "whole"), FACT_SCHEMA).count() == 0
    replace_partitions(first.where("false"), str(tmp_path / "part"))
    assert payloads(read_table(spark, str(tmp_path / "part"), FACT_SCHEMA)) == ["a", "c"]


def test_hot_partition_is_split_over_tasks(spark, tmp_path):
    """A third of the rows and more in one partition are written by several tasks."""
    noise = F.sha2(F.col("id").cast("string"), 512)
    df = spark.range(60_000).select(
        noise.alias("payload"),
        F.lit("2025-08-04").alias("date_partition"),
        F.when(F.col("id") % 4 < 3, F.lit("hot")).otherwise(F.lit("cold")).alias("district"),
    )
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        append_rows(df.repartition(8), str(tmp_path / "t"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert len(list((tmp_path / "t").glob("*/district=hot/*.parquet"))) > 2
    assert spark.read.parquet(str(tmp_path / "t")).distinct().count() == 60_000


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_work_folders_go_also_on_failure(spark):
    with pytest.raises(RuntimeError, match="stop"), work_folders(spark, "x", 2) as paths:
        for path in paths:
            spark.range(3).write.parquet(f"{path}/part=1")
        assert subfolders(spark, paths[0]) == ["part=1"]
        raise RuntimeError("stop")
    assert not any(Path(path).exists() for path in paths)
    assert subfolders(spark, paths[0]) == []
    remove_folder(spark, paths[0])


def test_no_local_folder_on_a_cluster():
    def session(master):
        context = SimpleNamespace(master=master)
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda name, default: default), sparkContext=context
        )

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://host:7077"))
    assert Path(shared_folder(session("local[2]"))).is_dir()
