"""Commits, compaction, replays, versions, expiry, windows, reporters and skipped files."""

import random
from collections import Counter
from datetime import datetime, timedelta
from itertools import pairwise

import pytest
from conftest import rows
from pyspark.sql import functions as F

from blotter.operators import rollups
from blotter.operators.envelope import decode_records
from blotter.operators.lookups import category_attribute
from blotter.plans.reports import live_alerts, live_incidents, report_areas
from blotter.schema import (
    ALERTS,
    BATCH_KEY,
    COMMITS,
    FACT_SCHEMA,
    FACTS,
    NAMES,
    REPORTERS,
    REPORTERS_SCHEMA,
    SOURCE_SCHEMA,
    STATISTICS,
    STATISTICS_SCHEMA,
    with_batch_key,
)
from blotter.session import exists, file_system, subfolders
from blotter.sinks import commits as sink
from blotter.sinks.compaction import choose_keys, compact, size_class, sweep
from blotter.sinks.keys import valid_keys
from blotter.sinks.snapshots import drop_days, publish
from blotter.sources.commits import live_files, manifest_census
from blotter.sources.skipped import set_aside, skipped_files
from blotter.sources.snapshots import VERSIONS, snapshot_folders
from blotter.sources.tables import (
    file_census,
    list_files,
    read_days,
    read_listed,
    read_table,
)
from blotter.streaming.expiry import expired_markers
from blotter.streaming.job import (
    COMMITTED_TABLES,
    EXACT,
    LAST_BATCH,
    SKETCH,
    Job,
    refresh_rollups,
    stored_cells,
    write_micro_batch,
)
from blotter.streaming.windows import finished_windows

START = datetime(2025, 8, 4, 10, 0, 0)
DAY = "2025-08-04"


def message(i, at, category="robo", area=None, partition=0):
    area = area or ["Norte", "Sur", "Coast Road + 5%"][i % 3]
    value = (
        f'{{"crime_id":"I{i}","timestamp":"{at.isoformat()}","crime_type":"{category}",'
        f'"location":{{"district":"{area}","coordinates":{{"lat":-2.5,"lon":-79.5}}}},'
        f'"reporter_info":{{"cedula_hash":"h{i % 7}"}}}}'
    )
    return (bytearray(f"I{i}", "utf8"), bytearray(value, "utf8"), "raw", partition, i, at)


def batch_of(spark, ids, step=0, **changes):
    found = [message(i, START + timedelta(seconds=step * i), **changes) for i in ids]
    raw = spark.createDataFrame(found, SOURCE_SCHEMA)
    return decode_records(raw, clock=F.col("kafka_timestamp"))


def ids_of(df):
    return sorted(int(r[0]) for r in df.select(F.regexp_extract("crime_data", "I([0-9]+)", 1)).collect())


def facts(spark, job):
    return read_table(spark, job.path(FACTS), FACT_SCHEMA)


def fact_files(spark, job):
    return list_files(spark, job.path(FACTS), (NAMES.date, NAMES.area, BATCH_KEY))


def run_batches(spark, job, count, stream="s", per_batch=6, first=0, step=1):
    for b in range(count):
        ids = range(first + b * per_batch, first + (b + 1) * per_batch)
        write_micro_batch(job, batch_of(spark, ids, step), stream, b)


# ---------------------------------------------------------- commits, packs


def test_many_batches_leave_few_files_and_every_row_once(spark, tmp_path):
    job = Job(str(tmp_path / "out"), thresholds={"robo": 2}, fold=3, pack_every=3, grace_seconds=0)
    seen = []
    for b in range(14):
        write_micro_batch(job, batch_of(spark, range(b * 6, b * 6 + 6), 1), "s", b)
        assert ids_of(facts(spark, job)) == list(range(b * 6 + 6))
        seen.append(fact_files(spark, job).count())
    # Three areas; without packing there were 42 files.
    assert max(seen) <= 3 * 3 * 3 and seen[-1] <= 3 * 5
    assert len(subfolders(spark, job.path(COMMITS))) <= 3 * 4
    assert ids_of(read_days(spark, job.path(FACTS), [DAY], FACT_SCHEMA)) == list(range(84))
    now = START + timedelta(seconds=83)
    assert live_incidents(spark, job.root, now, ttl_seconds=100).count() == 84
    counted = read_table(spark, job.path(STATISTICS), STATISTICS_SCHEMA)
    assert sum(r.crime_count for r in counted.collect()) == 84
    # Alerts are packed as well and each is shown once.
    assert live_alerts(spark, job.root, now, ttl_seconds=100).count() == 42
    assert report_areas(spark, job.root, DAY).count() == 3


def test_interrupted_packs_change_nothing(spark, tmp_path):
    job = Job(str(tmp_path / "out"), fold=4, pack_every=0)
    run_batches(spark, job, 5)
    before = rows(facts(spark, job))

    def fail():
        raise InterruptedError

    def pack(number, **options):
        return compact(spark, job.root, COMMITTED_TABLES, [DAY], "s", number, fan=2, **options)

    with pytest.raises(InterruptedError):
        pack(5, before_commit=fail)
    assert fact_files(spark, job).where(F.col(BATCH_KEY).endswith("p")).count() == 3
    assert rows(facts(spark, job)) == before
    replaced = pack(5)
    # A batch that may be rerun is not sealed.
    assert sorted(replaced[FACTS, DAY]) == [f"s-{b:012d}" for b in range(5)]
    assert pack(5) == {}
    assert rows(facts(spark, job)) == before
    # A reader that has listed the old files still finds them until they are swept.
    assert fact_files(spark, job).count() == 18
    sweep(spark, job.path(FACTS), grace_seconds=3600)
    assert fact_files(spark, job).count() == 18
    sweep(spark, job.path(FACTS), grace_seconds=0)
    assert fact_files(spark, job).count() == 3
    assert rows(facts(spark, job)) == before
    # The next batches go on as before.
    write_micro_batch(job, batch_of(spark, range(30, 36), 1), "s", 5)
    assert ids_of(facts(spark, job)) == list(range(36))


def test_choice_of_keys_by_size():
    assert size_class(1, 4) == 0 and size_class(1 << 20, 4) > size_class(1 << 16, 4)
    small = {f"s-{i}": 1000 for i in range(5)}
    large = {f"t-{i}": 1 << 24 for i in range(3)}
    assert choose_keys(small | large, 4) == sorted(small) + sorted(large)
    assert choose_keys(large, 4) == [] and choose_keys(small, 6) == []
    many = {f"s-{i}": 1 << (14 + i) for i in range(12)}
    assert choose_keys(many, 40) == []


def test_a_batch_without_a_commit_does_not_count(spark, tmp_path, monkeypatch):
    from blotter.streaming import job as module

    job = Job(str(tmp_path / "out"), fold=3, once=True, topic="raw")
    run_batches(spark, job, 2)

    def lost(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(module, "commit_batch", lost)
        with pytest.raises(RuntimeError, match="executor lost"):
            write_micro_batch(job, batch_of(spark, range(12, 18), 1), "s", 2)
    assert ids_of(facts(spark, job)) == list(range(12))
    # Another stream takes the same rows: neither facts nor counts have them twice.
    write_micro_batch(job, batch_of(spark, range(6, 24), 1), "t", 0)
    assert ids_of(facts(spark, job)) == list(range(24))
    counted = read_table(spark, job.path(STATISTICS), STATISTICS_SCHEMA)
    assert sum(r.crime_count for r in counted.collect()) == 24


def test_older_tables_are_adopted(spark, tmp_path):
    from blotter.sinks.tables import write_batch
    from blotter.operators.cells import hour_cells
    from blotter.operators.envelope import fact_rows
    from blotter.schema import CELLS

    job = Job(str(tmp_path / "out"), fold=3)
    for b in range(2):
        batch = batch_of(spark, range(b * 6, b * 6 + 6))
        write_batch(fact_rows(batch), job.path(FACTS), f"old-{b:012d}")
        write_batch(hour_cells(batch), job.path(CELLS), f"old-{b:012d}", (NAMES.date,))
    write_micro_batch(job, batch_of(spark, range(12, 18)), "s", 0)
    assert ids_of(facts(spark, job)) == list(range(18))
    assert sum(r.n for r in stored_cells(spark, job, [DAY]).collect()) == 18


def test_files_that_were_dropped_leave_the_others(spark, tmp_path):
    job = Job(str(tmp_path / "out"))
    run_batches(spark, job, 2)
    gone = fact_files(spark, job).where("district = 'Norte'").collect()
    for row in gone:
        system, where = file_system(spark, row.file_path)
        system.delete(where, False)
    assert ids_of(facts(spark, job)) == [i for i in range(12) if i % 3]


# --------------------------------------------------------------- manifest


def test_manifest_tells_what_a_listing_tells(spark, tmp_path):
    job = Job(str(tmp_path / "out"), fold=2, pack_every=0)
    run_batches(spark, job, 5)
    known = live_files(spark, job.path(FACTS))
    listed = fact_files(spark, job)
    columns = [NAMES.date, NAMES.area, BATCH_KEY, "file_uri", "modified", "file_size"]
    assert rows(known.select(columns)) == rows(listed.select(columns))
    opened = spark.read.schema(FACT_SCHEMA).parquet(*[r[0] for r in known.select("file_path").collect()])
    assert opened.count() == 30
    census = file_census(listed).select(NAMES.area, "file_count", "total_bytes")
    told = manifest_census(known)
    assert rows(told.select(census.columns)) == rows(census)
    totals = told.agg(F.sum("row_count"), F.min("least"), F.max("greatest")).first()
    assert tuple(totals) == (30, START, START + timedelta(seconds=29))
    # None of this lists the facts: it goes on when they are out of reach.
    before = rows(told)
    system, old = file_system(spark, job.path(FACTS))
    _, new = file_system(spark, f"{job.root}/elsewhere")
    system.rename(old, new)
    assert rows(manifest_census(live_files(spark, job.path(FACTS)))) == before


def test_live_incidents_open_only_files_that_can_match(spark, tmp_path):
    job = Job(str(tmp_path / "out"), pack_every=0)
    run_batches(spark, job, 8, step=10)
    now = START + timedelta(seconds=470)
    window = live_files(
        spark, job.path(FACTS), [DAY], F.lit(now) - F.expr("INTERVAL 60 SECONDS"), F.lit(now)
    )
    read = read_listed(spark, job.path(FACTS), window, with_batch_key(FACT_SCHEMA))
    assert {r[0] for r in window.select(BATCH_KEY).collect()} == {f"s-{b:012d}" for b in (6, 7)} - (
        {"s-000000000006"} if not window.where(F.col(BATCH_KEY) == "s-000000000006").count() else set()
    )
    assert len(read.inputFiles()) == window.count() < fact_files(spark, job).count()
    points = live_incidents(spark, job.root, now, ttl_seconds=60)
    assert sorted(r.id for r in points.collect()) == [f"I{i}" for i in range(42, 48)]


# ----------------------------------------------------------------- ledger


def spans_of(df):
    return sorted(tuple(r) for r in df.select("topic", "source_partition", "first_offset", "last_offset").collect())


def runs(numbers):
    out = []
    for n in sorted(set(numbers)):
        if out and out[-1][1] + 1 == n:
            out[-1][1] = n
        else:
            out.append([n, n])
    return [tuple(r) for r in out]


def test_interval_sets_against_plain_sets(spark, monkeypatch):
    monkeypatch.setattr(sink, "BUCKET_OFFSETS", 8)
    rng = random.Random(3)
    sets = {p: {rng.randrange(200) for _ in range(90)} for p in (0, 1)}
    taken = [(p, o) for p, s in sets.items() for o in s]
    columns = f"{NAMES.source_partition} int, {NAMES.source_offset} long"
    records = spark.createDataFrame([*taken, *taken[:9], (None, 3), (1, None)], columns)
    spans = sink.offset_spans(records, "raw")
    assert spans_of(spans) == [("raw", p, a, b) for p in sets for a, b in runs(sets[p])]
    more = sink.merged_spans(spans.unionByName(spark.createDataFrame([("raw", 0, 10, 60), ("raw", 0, 61, 61), ("x", 0, 0, 0)], spans.schema)))
    joined = sets[0] | set(range(10, 62))
    assert [s for s in spans_of(more) if s[:2] == ("raw", 0)] == [("raw", 0, a, b) for a, b in runs(joined)]
    asked = spark.createDataFrame([(p, o) for p in (0, 1, 2) for o in range(200)] + [(None, 1), (0, None)], columns)
    left = {tuple(r) for r in sink.without_spans(asked, spans, "raw").collect()}
    assert left == {(p, o) for p in (0, 1, 2) for o in range(200) if o not in sets.get(p, ())} | {(None, 1), (0, None)}
    assert sink.without_spans(asked, spans, "other").count() == asked.count()


def test_scattered_offsets_take_a_mask_per_block_and_a_row_meets_one(spark, monkeypatch):
    """Every third offset, a long run and offsets below zero; put together from two halves."""
    monkeypatch.setattr(sink, "BUCKET_OFFSETS", 256)
    taken = {0: set(range(1, 30_000, 3)), 1: set(range(100, 5_000)) | {9_000}, 2: set(range(-130, 70, 2))}
    columns = f"{NAMES.source_partition} int, {NAMES.source_offset} long"
    pairs = [(p, o) for p, s in taken.items() for o in s]
    halves = [
        sink.packed_offsets(spark.createDataFrame([*part, (None, 3), (1, None)], columns), "raw")
        for part in ([q for q in pairs if q[1] % 2], [q for q in pairs if not q[1] % 2])
    ]
    spans = sink.packed_spans(halves[0].unionByName(halves[1])).localCheckpoint()
    # 469 blocks of the first partition; a run, its two ends and one offset; five blocks.
    assert spans.groupBy("source_partition").count().orderBy("source_partition").collect() == [(0, 469), (1, 4), (2, 5)]
    asked = [(p, o) for p in (0, 1, 2, 3) for o in range(-200, 31_000)] + [(None, 1), (0, None)]
    expected = {(p, o) for p, o in asked if o not in taken.get(p, ())}
    runs_ = sink.merged_spans(sink.offset_spans(spark.createDataFrame(pairs, columns), "raw"))
    records = spark.createDataFrame(asked, columns)
    for known in (spans, halves[0].unionByName(halves[1]), runs_):
        left = [tuple(r) for r in sink.without_spans(records, known, "raw").collect()]
        assert len(left) == len(expected) and set(left) == expected


def test_replay_under_a_new_checkpoint_is_stored_once(spark, tmp_path):
    job = Job(str(tmp_path / "out"), fold=2, once=True, topic="raw", pack_every=0)
    run_batches(spark, job, 3)
    for b in range(4):  # the replay cuts its batches elsewhere
        write_micro_batch(job, batch_of(spark, range(b * 7, b * 7 + 7), 1), "replay", b)
    assert ids_of(facts(spark, job)) == list(range(28))
    counted = read_table(spark, job.path(STATISTICS), STATISTICS_SCHEMA)
    assert sum(r.crime_count for r in counted.collect()) == 28
    # Other partitions and other topics are other rows.
    write_micro_batch(job, batch_of(spark, range(3), partition=5), "third", 0)
    assert len(ids_of(facts(spark, job))) == 31
    again = Job(job.root, fold=2, once=True, topic="other", pack_every=0)
    write_micro_batch(again, batch_of(spark, range(3)), "fourth", 0)
    assert len(ids_of(facts(spark, job))) == 34


def test_only_cumulative_jobs_know_what_is_stored(tmp_path):
    with pytest.raises(ValueError):
        Job(str(tmp_path), mode=LAST_BATCH, once=True)


# --------------------------------------------------------------- versions


def table_of(spark, values):
    return spark.createDataFrame([(d, n) for d, n in values], f"{NAMES.date} string, n int")


def test_readers_see_the_version_they_began_with(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = table_of(spark, [("x", 1)]).select("n", NAMES.date).schema

    def now():
        return sorted(tuple(r) for r in read_table(spark, path, schema).collect())

    publish(table_of(spark, [("a", 1), ("b", 1), ("c", 1)]), path)
    begun = read_table(spark, path, schema)
    publish(table_of(spark, [("a", 2), ("z", 9)]), path, ["a", "b"])
    assert now() == [(1, "c"), (2, "a")]
    assert sorted(tuple(r) for r in begun.collect()) == [(1, "a"), (1, "b"), (1, "c")]
    publish(table_of(spark, [("d", 3)]), path)
    assert now() == [(3, "d")] and begun.count() == 3
    assert read_days(spark, path, ["a", "d"], schema).count() == 1
    drop_days(spark, path, ["d"])
    assert now() == [] and snapshot_folders(spark, path) == []
    # After the grace time only what is named is left.
    publish(table_of(spark, [("e", 4)]), path, ["e"], grace_seconds=0)
    publish(table_of(spark, [("e", 5)]), path, ["e"], grace_seconds=0)
    assert now() == [(5, "e")]
    assert len(subfolders(spark, f"{path}/{VERSIONS}")) <= 2


def test_a_version_without_a_pointer_does_not_count(spark, tmp_path, monkeypatch):
    from blotter.sinks import snapshots

    path = str(tmp_path / "table")
    schema = table_of(spark, [("x", 1)]).select("n", NAMES.date).schema
    publish(table_of(spark, [("a", 1)]), path)

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(snapshots, "_point", lost)
        with pytest.raises(RuntimeError):
            publish(table_of(spark, [("a", 2), ("b", 2)]), path)
    assert [tuple(r) for r in read_table(spark, path, schema).collect()] == [(1, "a")]
    publish(table_of(spark, [("c", 3)]), path)
    assert [tuple(r) for r in read_table(spark, path, schema).collect()] == [(3, "c")]


def test_job_with_versioned_rollups(spark, tmp_path):
    job = Job(str(tmp_path / "out"), snapshots=True, fold=2)
    run_batches(spark, job, 2)
    begun = read_table(spark, job.path(STATISTICS), STATISTICS_SCHEMA)
    write_micro_batch(job, batch_of(spark, range(12, 18)), "s", 2)
    assert sum(r.crime_count for r in begun.collect()) == 12
    counted = read_table(spark, job.path(STATISTICS), STATISTICS_SCHEMA)
    assert sum(r.crime_count for r in counted.collect()) == 18
    assert not exists(spark, f"{job.path(STATISTICS)}/{NAMES.date}={DAY}")


# -------------------------------------------------------------- reporters


def test_reporters_over_batches(spark, tmp_path):
    rng = random.Random(6)
    found = {}
    for way in (EXACT, SKETCH):
        job = Job(str(tmp_path / way), reporters=way, fold=2, pack_every=0)
        for b in range(5):
            ids = [rng.randrange(300) for _ in range(60)]
            write_micro_batch(job, batch_of(spark, ids), "s", b)
        refresh_rollups(spark, job, [DAY])
        table = read_table(spark, job.path(REPORTERS), REPORTERS_SCHEMA)
        found[way] = {(r.district, r.crime_type): r.reporters for r in table.collect()}
        stored = facts(spark, job)
        exact = {(r.district, r.crime_type): r.reporters for r in rollups.reporter_counts(stored).collect()}
        assert found[way] == exact  # few reporters: a sketch is exact
    with pytest.raises(ValueError):
        Job(str(tmp_path), reporters="guess")


def test_sketch_stays_within_its_error(spark):
    records = spark.range(60_000).select(
        F.lit(DAY).alias(NAMES.date),
        F.lit("Norte").alias(NAMES.area),
        F.lit("robo").alias(NAMES.category),
        F.concat(F.lit("h"), (F.col("id") % 20_000).cast("string")).alias(NAMES.reporter),
        F.lit(START).alias(NAMES.clock),
        (F.col("id") % 3).alias("part"),
    )
    parts = [rollups.reporter_cells(records.where(F.col("part") == i)) for i in range(3)]
    merged = rollups.merge_reporters(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    estimate = rollups.count_reporters(merged).first().reporters
    assert abs(estimate - 20_000) <= 0.04 * 20_000


def test_reporters_count_by_the_stored_day(spark):
    records = batch_of(spark, range(3)).withColumn(NAMES.date, F.lit("2020-01-01"))
    assert {r[NAMES.date] for r in rollups.reporter_counts(records).collect()} == {"2020-01-01"}


# ------------------------------------------------------------ event times


def drained(spark, stream, tmp_path, name, schema):
    out = str(tmp_path / name)
    sink_ = stream.writeStream.format("parquet").option("path", out)
    sink_.option("checkpointLocation", f"{out}-check").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(schema).parquet(out)


def arrivals(spark, tmp_path, lots):
    path = str(tmp_path / "arrivals")
    schema = spark.createDataFrame([], "id long, added_at timestamp, area string").schema
    for lot in lots:
        spark.createDataFrame(lot, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def some_lots(seed, lots=4, count=120, ids=6):
    rng = random.Random(seed)
    at, out = START, []
    for _ in range(lots):
        lot = []
        for _ in range(count):
            at += timedelta(milliseconds=rng.choice([0, 500, 1500, 9000]))
            lot.append((rng.randrange(ids), at, "ab"[rng.randrange(2)]))
        rng.shuffle(lot)
        out.append(lot)
    return out


def test_expired_markers_against_brute_force(spark, tmp_path):
    lots = some_lots(1)
    lots[0] += [(77, None, "a"), (99, START, "a")]
    everything = sorted((t, i) for lot in lots for i, t, _ in lot if t)
    ttl, newest = timedelta(seconds=40), everything[-1][0]
    expected = []
    for i in {i for _, i in everything}:
        added = None
        for t in (t for t, j in everything if j == i):
            if added is None or t >= added + ttl:
                if added is not None:
                    expected.append((i, added, added + ttl))
                added = t
        if added + ttl <= newest:
            expected.append((i, added, added + ttl))
    stream = expired_markers(arrivals(spark, tmp_path, lots), 40)
    found = drained(spark, stream, tmp_path, "out", "id long, added timestamp, expired timestamp")
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)


@pytest.mark.parametrize("kind", ["long", "string", "timestamp", "struct<a:long,b:string>"])
def test_expired_markers_call_python_per_group_of_ids(spark, tmp_path, kind):
    """2,000 ids of any type, beyond 2^53 and null, in 8 groups: 9 rows of state at most."""
    big, ttl = 1 << 60, timedelta(seconds=40)
    at = [START, START + timedelta(seconds=39), START + timedelta(seconds=40), START + timedelta(seconds=90)]
    path, out = str(tmp_path / "arrivals"), str(tmp_path / "out")
    lots = [[(big + i, t) for i in range(2000)] + [(None, t)] for t in at]
    schema = "id long, added_at timestamp"
    for lot in lots:
        spark.createDataFrame(lot, schema).coalesce(1).write.mode("append").parquet(path)
    named = {
        "long": F.col("id"),
        "string": F.col("id").cast("string"),
        "timestamp": F.timestamp_micros(F.col("id") - big),
        "struct<a:long,b:string>": F.when(F.col("id").isNotNull(), F.struct(F.col("id").alias("a"), F.lit("x").alias("b"))),
    }[kind].alias("id")
    points = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    stream = expired_markers(points.select(named, "added_at"), 40, groups=8)
    sink_ = stream.writeStream.format("parquet").option("path", out)
    query = sink_.option("checkpointLocation", f"{out}-check").trigger(availableNow=True).start()
    query.awaitTermination()
    kept = [p.stateOperators[0].numRowsTotal for p in query.recentProgress]
    assert max(kept) == 9 and kept[-1] == 9
    found = spark.read.schema(f"id {kind}, added timestamp, expired timestamp").parquet(out)
    ids = spark.createDataFrame(lots[0], schema).select(named)
    stays = spark.createDataFrame([(t, t + ttl) for t in (at[0], at[2])], "added timestamp, expired timestamp")
    expected = ids.crossJoin(stays)
    assert found.count() == expected.count() == 4002
    assert found.exceptAll(expected).isEmpty()


def test_windows_come_once_when_the_watermark_has_passed(spark, tmp_path):
    lots = some_lots(2)
    lots[1].append((5, None, "a"))
    stream = arrivals(spark, tmp_path, lots).select(
        F.col("added_at").alias(NAMES.clock), F.col("area").alias(NAMES.area), F.lit("robo").alias(NAMES.category)
    )
    out = drained(
        spark, finished_windows(stream, 60), tmp_path, "windows",
        "window_start timestamp, district string, crime_type string, n long, last_time timestamp",
    )
    times = [(t, a) for lot in lots for _, t, a in lot if t]
    newest = max(t for t, _ in times)
    expected = Counter()
    for t, a in times:
        start = t.replace(second=0, microsecond=0)
        if start + timedelta(seconds=60) <= newest:
            expected[start, a] += 1
    found = out.collect()
    assert len(found) == len(expected)
    assert {(r.window_start, r.district): r.n for r in found} == dict(expected)


# ---------------------------------------------------------- skipped files


def test_skipped_files_have_a_reason_and_totals_add_up(spark, tmp_path):
    job = Job(str(tmp_path / "out"), pack_every=0)
    run_batches(spark, job, 3)
    files = live_files(spark, job.path(FACTS))
    bad = files.orderBy("file_uri").limit(3).collect()
    for how, row in zip(("broken", "empty", "deleted"), bad, strict=True):
        system, where = file_system(spark, row.file_path)
        system.delete(where, False)
        if how != "deleted":
            out = system.create(where, True)
            out.write(bytearray(b"" if how == "empty" else b"PAR1 but no footer PAR1"))
            out.close()
    skipped = skipped_files(spark, job.path(FACTS), files, FACT_SCHEMA).collect()
    told = {r.file_uri: r.reason for r in skipped}
    assert told == {bad[0].file_uri: "corrupt", bad[1].file_uri: "vanished", bad[2].file_uri: "vanished"}
    left = read_table(spark, job.path(FACTS), FACT_SCHEMA, tolerant=True).count()
    assert left + sum(r.row_count for r in skipped) == 18
    frame = skipped_files(spark, job.path(FACTS), files, FACT_SCHEMA)
    assert set_aside(spark, job.path(FACTS), frame) == 1
    assert {r.reason for r in skipped_files(spark, job.path(FACTS), files, FACT_SCHEMA).collect()} == {"vanished"}
    assert read_table(spark, job.path(FACTS), FACT_SCHEMA).count() == left


def test_no_file_is_left(spark, tmp_path):
    job = Job(str(tmp_path / "out"), pack_every=0)
    run_batches(spark, job, 1)
    files = live_files(spark, job.path(FACTS))
    listed = files.count()
    system, where = file_system(spark, job.path(FACTS))
    system.delete(where, True)
    skipped = skipped_files(spark, job.path(FACTS), files, FACT_SCHEMA)
    assert [r.reason for r in skipped.collect()] == ["vanished"] * listed


# ------------------------------------------------------------------- keys


def test_collated_keys_know_letters_no_list_names(spark):
    words = ["Çïêüöâ", "cieuoa", "CIEUOA", "x", None]
    frame = spark.createDataFrame([(w,) for w in words], "type string")
    found = category_attribute(frame, "type", {"cieuoa": "yes"}, "no", collation="UNICODE_CI_AI")
    assert sorted((r.type or "", r.color) for r in found.collect()) == sorted(
        [("Çïêüöâ", "yes"), ("cieuoa", "yes"), ("CIEUOA", "yes"), ("x", "no"), ("", "no")]
    )


def test_packs_fold_with_their_batches():
    keys = ["s-000000000002", "s-000000000002p", "s-000000000003p", "s-L1-000000000000"]
    assert sorted(valid_keys(keys, 3)) == ["s-000000000003p", "s-L1-000000000000"]
    assert all(a != b for a, b in pairwise(sorted(valid_keys(keys, 2))))
    assert ALERTS in COMMITTED_TABLES
