import random
from collections import Counter
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from blotter.operators import cells, rollups
from blotter.operators.alerts import critical_alerts
from blotter.operators.envelope import decode_records
from blotter.plans.rebuild import rebuild_rollups
from blotter.plans.reports import (
    density_records,
    density_report,
    live_alerts,
    live_incidents,
    report_areas,
)
from blotter.schema import (
    ALERT_SCHEMA,
    ALERTS,
    CELLS,
    CORRELATION,
    CORRELATION_SCHEMA,
    DENSITY,
    DENSITY_SCHEMA,
    FACT_SCHEMA,
    FACTS,
    NAMES,
    SOURCE_SCHEMA,
    STATISTICS,
    STATISTICS_SCHEMA,
    TEMPORAL,
    TEMPORAL_SCHEMA,
)
from blotter.session import remove_folder, shared_folder, subfolders
from blotter.sinks.keys import valid_keys
from blotter.sinks.tables import AS_IS, REBALANCE
from blotter.sources.streams import read_file_stream, topic_options
from blotter.sources.tables import read_table
from blotter.streaming import job as streaming_job
from blotter.streaming.job import (
    CUMULATIVE,
    LAST_BATCH,
    Job,
    start,
    stream_id_of,
    write_micro_batch,
)
from blotter.streaming.live import dedupe_live, observe_feed, read_live, start_live_feed
from blotter.streaming.live import write_live_batch
from blotter.streaming.progress import batch_volume, recent_volume

START = datetime(2025, 8, 4, 23, 59, 30)
THRESHOLDS = {"robo": 3}
TABLES = {
    STATISTICS: STATISTICS_SCHEMA,
    TEMPORAL: TEMPORAL_SCHEMA,
    DENSITY: DENSITY_SCHEMA,
    CORRELATION: CORRELATION_SCHEMA,
}


def message(i, category, area, at):
    value = (
        f'{{"crime_id":"I{i}","timestamp":"{at.isoformat()}","crime_type":"{category}",'
        f'"location":{{"district":"{area}","coordinates":{{"lat":-2.{i},"lon":-79.5}}}},'
        f'"reporter_info":{{"cedula_hash":"h{i % 3}"}}}}'
    )
    return (bytearray(f"I{i}", "utf8"), bytearray(value, "utf8"), "raw", i % 3, i, at)


@pytest.fixture(scope="module")
def lots():
    """Three lots of messages; the second crosses midnight."""
    kinds, areas = ["robo", "robo", "estafa", "extorsión"], ["Norte", "Norte", "Sur"]
    out = []
    for lot in range(3):
        out.append(
            [
                message(n, kinds[n % 4], areas[n % 3], START + timedelta(seconds=n))
                for n in range(lot * 20, lot * 20 + 20)
            ]
        )
    return out


@pytest.fixture
def source(spark, lots, tmp_path):
    path = str(tmp_path / "source")
    for lot in lots:
        spark.createDataFrame(lot, SOURCE_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path


def decoded(df):
    return decode_records(df, clock=F.col("kafka_timestamp"))


def run(spark, source, job, checkpoint, **options):
    stream = read_file_stream(spark, source, max_files_per_batch=1)
    query = start(decoded(stream), job, str(checkpoint), trigger_seconds=None, **options)
    query.awaitTermination()
    return query


def batch_tables(records):
    hours, days = cells.hour_cells(records), cells.day_cells(records)
    return {
        STATISTICS: rollups.statistics(days),
        TEMPORAL: rollups.temporal_profile(hours),
        DENSITY: rollups.density(days),
        CORRELATION: rollups.correlation(days),
    }


def stored(spark, job, table):
    return read_table(spark, job.path(table), TABLES[table])


def assert_same(left, right):
    columns = sorted(right.columns)
    assert rows(left.select(columns)) == rows(right.select(columns))


def test_cumulative_stream_equals_batch(spark, lots, source, tmp_path):
    job = Job(str(tmp_path / "out"), thresholds=THRESHOLDS)
    query = run(spark, source, job, tmp_path / "check")
    volume = recent_volume(query)
    assert [v["batch_id"] for v in volume][:3] == [0, 1, 2]
    # The source is read once, whatever the number of tables.
    assert sum(v["input_rows"] for v in volume) == 60

    whole = decoded(spark.read.schema(SOURCE_SCHEMA).parquet(source))
    for table, expected in batch_tables(whole).items():
        assert_same(stored(spark, job, table), expected)
    assert read_table(spark, job.path(FACTS), FACT_SCHEMA).count() == 60

    # Alerts are those of each batch on its own.
    alerts = read_table(spark, job.path(ALERTS), ALERT_SCHEMA)
    per_lot = None
    for lot in lots:
        batch = critical_alerts(
            cells.day_cells(decoded(spark.createDataFrame(lot, SOURCE_SCHEMA))), THRESHOLDS
        )
        per_lot = batch if per_lot is None else per_lot.unionByName(batch)
    assert per_lot.count() > 2
    assert_same(alerts, per_lot)

    # A second run on the same checkpoint finds nothing new.
    run(spark, source, job, tmp_path / "check")
    assert read_table(spark, job.path(FACTS), FACT_SCHEMA).count() == 60
    # A new checkpoint replays everything under its own batch keys.
    run(spark, source, job, tmp_path / "check2")
    assert read_table(spark, job.path(FACTS), FACT_SCHEMA).count() == 120


def test_last_batch_mode_keeps_only_the_last_batch(spark, lots, source, tmp_path):
    job = Job(str(tmp_path / "out"), mode=LAST_BATCH, thresholds=THRESHOLDS)
    run(spark, source, job, tmp_path / "check")
    facts = read_table(spark, job.path(FACTS), FACT_SCHEMA)
    assert facts.count() == 60
    assert sum(r.crime_count for r in stored(spark, job, STATISTICS).collect()) == 20
    assert sum(r.total_crimes for r in stored(spark, job, DENSITY).collect()) == 20


def test_columns_that_no_write_reads_are_not_persisted(spark, lots, tmp_path, monkeypatch):
    seen = []
    kept = streaming_job.hour_cells
    monkeypatch.setattr(streaming_job, "hour_cells", lambda batch: seen.append(set(batch.columns)) or kept(batch))
    batch = decoded(spark.createDataFrame(lots[0], SOURCE_SCHEMA))
    offsets = {NAMES.source_partition, NAMES.source_offset}
    written = []
    for i, options in enumerate(
        [{"mode": LAST_BATCH}, {}, {"once": True, "topic": "raw"}, {"topic_writer": written.append}]
    ):
        write_micro_batch(Job(str(tmp_path / f"out-{i}"), thresholds=THRESHOLDS, **options), batch, "s", 0)
    everything = set(batch.columns)
    slim = everything - offsets - {NAMES.key}
    assert seen == [slim, slim, slim | offsets, everything] and len(written) == 1


@pytest.mark.parametrize("layout", [REBALANCE, AS_IS])
def test_large_batches_keep_all_rows(spark, lots, tmp_path, layout):
    job = Job(str(tmp_path / "out"), thresholds=THRESHOLDS, fact_layout=layout)
    batch = decoded(spark.createDataFrame(lots[1], SOURCE_SCHEMA)).repartition(4)
    write_micro_batch(job, batch, "s", 0)
    facts = read_table(spark, job.path(FACTS), FACT_SCHEMA)
    assert rows(facts.select("crime_data")) == rows(batch.select("crime_data"))
    assert_same(stored(spark, job, STATISTICS), rollups.statistics(cells.day_cells(batch)))


def test_rerun_of_a_batch_changes_nothing(spark, lots, tmp_path):
    job = Job(str(tmp_path / "out"), thresholds=THRESHOLDS)
    batch = decoded(spark.createDataFrame(lots[0], SOURCE_SCHEMA))
    other = decoded(spark.createDataFrame(lots[1], SOURCE_SCHEMA))
    write_micro_batch(job, batch, "s", 0)
    write_micro_batch(job, other, "s", 1)
    before = {t: rows(stored(spark, job, t)) for t in TABLES}
    write_micro_batch(job, other, "s", 1)
    assert {t: rows(stored(spark, job, t)) for t in TABLES} == before
    assert read_table(spark, job.path(FACTS), FACT_SCHEMA).count() == 40
    # An empty batch has no effect either.
    write_micro_batch(job, other.where("false"), "s", 2)
    assert {t: rows(stored(spark, job, t)) for t in TABLES} == before


def test_failed_batch_is_rerun_with_the_same_key(spark, source, tmp_path):
    calls = []

    def topic_writer(topic):
        calls.append(topic.count())
        if len(calls) == 2:
            raise RuntimeError("broker away")

    job = Job(str(tmp_path / "out"), thresholds=THRESHOLDS, topic_writer=topic_writer)
    with pytest.raises(Exception, match="broker away"):
        run(spark, source, job, tmp_path / "check")
    run(spark, source, job, tmp_path / "check")
    assert calls == [20, 20, 20, 20]
    assert read_table(spark, job.path(FACTS), FACT_SCHEMA).count() == 60
    assert sum(r.crime_count for r in stored(spark, job, STATISTICS).collect()) == 60


def test_scheduled_rebuild_equals_refresh(spark, source, tmp_path):
    job = Job(str(tmp_path / "out"), thresholds=THRESHOLDS, refresh=False)
    run(spark, source, job, tmp_path / "check")
    assert stored(spark, job, STATISTICS).count() == 0
    whole = batch_tables(decoded(spark.read.schema(SOURCE_SCHEMA).parquet(source)))
    rebuild_rollups(spark, job)
    for table, expected in whole.items():
        assert_same(stored(spark, job, table), expected)
    rebuild_rollups(spark, job, ["2025-08-05"])
    for table, expected in whole.items():
        assert_same(stored(spark, job, table), expected)


def test_unknown_mode_is_refused(tmp_path):
    with pytest.raises(ValueError):
        Job(str(tmp_path), mode="sometimes")


def test_reports_over_the_stored_tables(spark, source, tmp_path):
    job = Job(str(tmp_path / "out"), thresholds=THRESHOLDS)
    run(spark, source, job, tmp_path / "check")
    now = START + timedelta(seconds=25)
    points = live_incidents(spark, job.root, now, ttl_seconds=10)
    assert sorted(r.id for r in points.collect()) == sorted(f"I{i}" for i in range(16, 26))

    late = START + timedelta(seconds=59)
    feed = live_alerts(spark, job.root, late, ttl_seconds=300).collect()
    assert feed and all(r.is_critical and r.severity == "CRÍTICA" for r in feed)
    ages = [r.time_ago for r in feed]
    assert ages == sorted(ages)
    poll = live_incidents(spark, job.root, now, ttl_seconds=10, files_per_area=1)
    assert {r.id for r in poll.collect()} <= {r.id for r in points.collect()}

    ranked, summary = density_report(density_records(spark, job.root, "2025-08-05", late))
    ranked, summary = ranked.collect(), summary.first()
    assert summary.hotspot == ranked[0].district and ranked[0].density_percent == 100.0
    assert summary.total_crimes == sum(r.total_crimes for r in ranked) == 30
    assert summary.districts_analyzed == 2

    # A replay under a new checkpoint stores every alert again; the feed shows it once.
    run(spark, source, job, tmp_path / "again")
    assert live_alerts(spark, job.root, late, ttl_seconds=300).count() == len(feed)


def small_batch(spark, first, count, at, **changes):
    """One batch of messages that all arrive at ``at``."""
    found = [message(first + i, "robo", ["Norte", "Sur", "Centro"][i % 3], at) for i in range(count)]
    for old, new in changes.items():
        found = [(k, bytearray(v.replace(old.encode(), new.encode())), *r) for k, v, *r in found]
    return decoded(spark.createDataFrame(found, SOURCE_SCHEMA))


def test_reports_keep_every_live_row_of_many_batches(spark, tmp_path):
    """More batches than a poll would read files, over midnight."""
    job = Job(str(tmp_path / "out"), thresholds={"robo": 2}, refresh=False)
    before = set(Path(shared_folder(spark)).iterdir())
    for b in range(11):
        at = START + timedelta(seconds=6 * b)
        write_micro_batch(job, small_batch(spark, 9 * b, 9, at), "s", b)
    now = START + timedelta(seconds=61)
    found = live_incidents(spark, job.root, now, ttl_seconds=70)
    assert sorted(r.id for r in found.collect()) == sorted(f"I{i}" for i in range(99))
    assert live_alerts(spark, job.root, now, ttl_seconds=300).count() == 33
    rebuild_rollups(spark, job)
    for day in ("2025-08-04", "2025-08-05"):
        ranked, summary = density_report(density_records(spark, job.root, day, now))
        assert ranked.count() == summary.first().districts_analyzed == 3
    assert set(Path(shared_folder(spark)).iterdir()) == before
    assert {r.district for r in report_areas(spark, job.root, "2025-08-04").collect()} == {
        "Norte", "Sur", "Centro",
    }
    assert report_areas(spark, job.root, "1999-01-01").count() == 3


def test_points_without_an_id_are_all_kept(spark, tmp_path):
    job = Job(str(tmp_path / "out"), refresh=False)
    at = START
    none = [decode_records(spark.createDataFrame(
        [(r[0], bytearray(bytes(r[1]).replace(f'"crime_id":"I{i}",'.encode(), own)), *r[2:])
         for i, r in enumerate(message(i, "robo", "Norte", at) for i in range(4))],
        SOURCE_SCHEMA), clock=F.col("kafka_timestamp")) for own in (b"", b'"crime_id":null,')]
    own = small_batch(spark, 50, 2, at)
    write_micro_batch(job, none[0].unionByName(none[1]).unionByName(own).unionByName(own), "s", 0)
    found = live_incidents(spark, job.root, at, ttl_seconds=60).collect()
    assert len(found) == 4 + 4 + 2
    assert len({r.id for r in found if r.id and r.id.startswith("crime_")}) == 4


def test_rebuild_keeps_days_and_drops_stale_rows(spark, lots, tmp_path):
    job = Job(str(tmp_path / "out"), thresholds=THRESHOLDS)
    write_micro_batch(job, decoded(spark.createDataFrame(lots[1], SOURCE_SCHEMA)), "s", 0)
    whole = {t: rows(stored(spark, job, t)) for t in TABLES}
    assert {r["date_partition"] for r in whole[STATISTICS]} == {"2025-08-04", "2025-08-05"}
    rebuild_rollups(spark, job, ["2025-08-05"])
    assert {t: rows(stored(spark, job, t)) for t in TABLES} == whole
    # A session in another zone would cut other days and hours.
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Bogota")
    try:
        with pytest.raises(ValueError, match="UTC"):
            rebuild_rollups(spark, job, ["2025-08-05"])
        days = cells.day_cells(read_table(spark, job.path(FACTS), FACT_SCHEMA))
        counted = {(r.date_partition, r.district, r.crime_type, r.n) for r in days.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert counted == {
        (r["date_partition"], r["district"], r["crime_type"], r["crime_count"])
        for r in whole[STATISTICS]
    }
    # Facts of one area and of one whole day go.
    for gone in (
        f"{job.path(FACTS)}/date_partition=2025-08-04/district=Sur",
        f"{job.path(FACTS)}/date_partition=2025-08-05",
    ):
        remove_folder(spark, gone)
    rebuild_rollups(spark, job, ["2025-08-04", "2025-08-05"])
    for table in TABLES:
        left = {(r["date_partition"], r["district"]) for r in rows(stored(spark, job, table))}
        assert left == {("2025-08-04", "Norte")}


def test_refresh_opens_few_folders_however_many_batches(spark, tmp_path):
    job = Job(str(tmp_path / "out"), fold=3)
    seen = []
    for b in range(31):
        batch = small_batch(spark, b, 2, START.replace(hour=10))
        for _ in range(2 if b in (9, 10, 27) else 1):
            write_micro_batch(job, batch, "s", b)
        folders = subfolders(spark, f"{job.path(CELLS)}/date_partition=2025-08-04")
        seen.append(len(folders))
    assert max(seen) <= 3 * 4 and seen[-1] <= 9
    assert sum(r.crime_count for r in stored(spark, job, STATISTICS).collect()) == 62


def test_folders_of_larger_blocks_hide_smaller_ones():
    keys = ["s-000000000000", "s-000000000004", "s-L1-000000000000", "t-000000000000", "s-L2-000000000001"]
    assert sorted(valid_keys(keys, 4)) == sorted(set(keys) - {"s-000000000000"})
    assert valid_keys(["s-000000000017", "s-L2-000000000001"], 4) == ["s-L2-000000000001"]


def test_batches_without_a_stream_id_are_refused(spark):
    with pytest.raises(RuntimeError, match="stream id"):
        stream_id_of(spark.range(1))


# --------------------------------------------------------------- live feed


def test_live_feed_of_batches_wider_than_the_time_to_live(spark, tmp_path):
    """A catch-up batch keeps what the same rows keep one by one; ties do not depend on order."""
    rng = random.Random(3)
    data = sorted((START + timedelta(seconds=rng.randrange(400)), rng.choice("aabc"), i) for i in range(120))
    expected, last = [], {}
    for at, who, i in data:
        if who not in last or (at - last[who]).total_seconds() >= 60:
            last[who] = at
            expected.append((who, at, i))
    path = str(tmp_path / "feed")
    schema = "id string, added_at timestamp, n long"
    for b, part in enumerate((data[:40], data[40:])):
        lot = [(who, at, i) for at, who, i in part]
        for _ in range(2):  # each batch runs twice, in another order
            rng.shuffle(lot)
            frame = spark.createDataFrame(lot, schema).repartition(3)
            write_live_batch(frame, path, f"s-{b:012d}", ["id"], ttl_seconds=60)
    found = spark.read.schema(schema).parquet(path)
    assert sorted((r.id, r.added_at, r.n) for r in found.collect()) == sorted(expected)


def kept_one_by_one(data, ttl, last=()):
    """(id, time, tie) that a feed keeps, arrival by arrival."""
    kept, last = [], dict(last)
    for at, who, i in sorted(data, key=lambda r: (r[0], str(r[1]), r[2])):
        if who not in last or (at - last[who]).total_seconds() >= ttl:
            last[who] = at
            kept.append((who, at, i))
    return kept


def test_live_feed_catches_up_on_many_slices_at_once(spark, tmp_path):
    """A hot id, a null id, gaps, ties and microseconds; each batch runs twice."""
    rng = random.Random(8)

    def lot(first, last, n):
        times = [START + timedelta(microseconds=rng.randrange(first * 10**6, last * 10**6)) for _ in range(n)]
        return [(at, rng.choice(["hot"] * 4 + ["a", None, f"once{rng.randrange(50)}"]), i) for i, at in enumerate(times)]

    first = lot(0, 500, 400) + [(START + timedelta(seconds=s), "exact", s) for s in range(0, 500, 10)]
    first += [(at, who, 1000) for at, who, _ in first[:60]]
    second = lot(505, 1500, 300) + [(START + timedelta(seconds=5000), "hot", 1), (START + timedelta(seconds=9000), "a", 2)]
    path, schema = str(tmp_path / "feed"), "id string, added_at timestamp, n long"
    for b, part in enumerate((first, second)):
        for _ in range(2):
            rng.shuffle(part)
            frame = spark.createDataFrame([(who, at, i) for at, who, i in part], schema).repartition(4)
            write_live_batch(frame, path, f"s-{b:012d}", ["id"], ttl_seconds=10)
    found = spark.read.schema(schema).parquet(path)
    expected = kept_one_by_one(first + second, 10)
    assert len(expected) > 200
    rows = [(r.id, r.added_at, r.n) for r in found.collect()]
    assert sorted(map(str, rows)) == sorted(map(str, expected))


def test_catch_up_among_stored_slices_goes_through_them_in_order(spark, tmp_path):
    """Rows of another batch in the middle of the catch-up are respected."""
    path, schema = str(tmp_path / "feed"), "id string, added_at timestamp, n long"

    def write(key, times):
        lot = spark.createDataFrame([("a", START + timedelta(seconds=s), s) for s in times], schema)
        write_live_batch(lot, path, key, ["id"], ttl_seconds=10)

    write("s-000000000000", [55])
    write("s-000000000001", range(0, 300, 3))
    kept = sorted(r.n for r in spark.read.schema(schema).parquet(path).collect())
    assert kept[:7] == [0, 12, 24, 36, 48, 55, 66]
    assert kept[7:] == list(range(78, 300, 12))


def arrivals(spark, data):
    return spark.createDataFrame(data, "id string, added_at timestamp")


def test_live_feed_follows_the_time_to_live(spark, tmp_path):
    """Batch by batch against a plain dictionary of live ids."""
    path, live, expected = str(tmp_path / "feed"), {}, []
    for b in range(12):
        at = START + timedelta(seconds=b * 7)
        ids = ["hot"] * 5 + [f"i{(b * k) % 5}" for k in range(1, 4)]
        live = {i: t for i, t in live.items() if (at - t).total_seconds() < 20}
        for i in sorted(set(ids)):
            if i not in live:
                live[i] = at
                expected.append((i, at))
        batch = arrivals(spark, [(i, at) for i in ids])
        for _ in range(2 if b % 3 == 0 else 1):  # some batches run twice
            write_live_batch(batch, path, f"s-{b:012d}", ["id"], ttl_seconds=20)
        shown = read_live(spark, path, batch.schema, at, ttl_seconds=20)
        assert Counter((r.id, r.added_at) for r in shown.collect()) == Counter(live.items())
    stored_rows = spark.read.schema("id string, added_at timestamp").parquet(path)
    assert sorted((r.id, r.added_at) for r in stored_rows.collect()) == sorted(expected)


def file_arrivals(spark, tmp_path, lots_of_ids):
    path = str(tmp_path / "arrivals")
    for n, ids in enumerate(lots_of_ids):
        lot = arrivals(spark, [(i, START + timedelta(seconds=n)) for i in ids])
        lot.repartition(4).write.mode("append").parquet(path)
    return path


def test_live_feed_stream(spark, tmp_path):
    path = file_arrivals(spark, tmp_path, [["a", "a", "b"], ["a", "c"]])
    stream = spark.readStream.schema("id string, added_at timestamp").parquet(path)
    feed = str(tmp_path / "feed")
    start_live_feed(
        stream, feed, str(tmp_path / "check"), trigger_seconds=None
    ).awaitTermination()
    stored_rows = spark.read.schema("id string, added_at timestamp").parquet(feed)
    assert sorted(r.id for r in stored_rows.collect()) == ["a", "b", "c"]


def test_dedupe_stream_with_hot_id(spark, tmp_path):
    path = file_arrivals(spark, tmp_path, [["hot"] * 50 + ["a", "b"], ["hot"] * 50 + ["b", "c"]])
    schema = "id string, added_at timestamp"
    stream = read_file_stream(spark, path, schema, max_files_per_batch=4)
    out = str(tmp_path / "out")
    query = (
        observe_feed(dedupe_live(stream, ["id"], 60), "feed")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", str(tmp_path / "check"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert sorted(r.id for r in spark.read.schema(schema).parquet(out).collect()) == [
        "a", "b", "c", "hot",
    ]


def test_batch_volume(spark):
    df = spark.createDataFrame(
        [(START + timedelta(seconds=s),) for s in (0, 1, 5, 6, 30)], "processing_time timestamp"
    )
    found = {r.trigger_start: r.record_count for r in batch_volume(df).collect()}
    assert found == {
        START: 3,
        START + timedelta(seconds=6): 1,
        START + timedelta(seconds=30): 1,
    }


def test_topic_options():
    assert topic_options("h:9092", "raw") == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "raw",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    assert topic_options("h", "t", max_rows_per_batch=5)["maxOffsetsPerTrigger"] == "5"
    assert CUMULATIVE != LAST_BATCH
