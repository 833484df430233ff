"""Rollups, alerts, density, feeds and rankings against brute force and hand-made cases."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from blotter.functions import age_label, area_from_message, fold_key, minute_bucket
from blotter.operators import alerts, cells, density, feeds, lookups, ranking, rollups
from blotter.schema import Names

START = datetime(2025, 8, 3, 22, 0)
SCHEMA = "district string, crime_type string, cedula_hash string, processing_time timestamp"


@pytest.fixture(scope="module")
def sample():
    """A third of all rows in one cell."""
    rng = random.Random(7)
    out = []
    for i in range(900):
        hot = i % 3 == 0
        out.append(
            (
                "Norte" if hot else rng.choice(["Norte", "Sur", "Durán"]),
                "robo" if hot else rng.choice(["robo", "estafa", "extorsión", "Unknown"]),
                f"r{rng.randrange(40)}",
                START + timedelta(minutes=0 if hot else rng.randrange(60 * 30)),
            )
        )
    return out


@pytest.fixture(scope="module")
def records(spark, sample):
    return spark.createDataFrame(sample, SCHEMA)


def by_day(sample):
    groups = defaultdict(list)
    for area, category, reporter, at in sample:
        groups[(at.strftime("%Y-%m-%d"), area, category)].append((reporter, at))
    return groups


def test_statistics_and_merge(records, sample):
    expected = {k: (len(v), max(at for _, at in v)) for k, v in by_day(sample).items()}
    direct = rollups.statistics(cells.day_cells(records))
    hours = cells.hour_cells(records)
    # Merging the same cells twice doubles the counts.
    folded = rollups.statistics(cells.fold_to_days(cells.merge_cells(hours)))
    doubled = rollups.statistics(cells.fold_to_days(cells.merge_cells(hours.unionByName(hours))))
    for frame, factor in ((direct, 1), (folded, 1), (doubled, 2)):
        found = {
            (r["date_partition"], r["district"], r["crime_type"]): (
                r["crime_count"] / factor,
                r["last_updated"],
            )
            for r in rows(frame)
        }
        assert found == expected


def test_temporal_profile(records, sample):
    expected = Counter(
        (at.strftime("%Y-%m-%d"), area, category, at.hour, at.isoweekday() % 7 + 1)
        for area, category, _, at in sample
    )
    found = rollups.temporal_profile(cells.hour_cells(records)).collect()
    assert {
        (r.date_partition, r.district, r.crime_type, r.hour, r.day_of_week): r.crimes_per_hour
        for r in found
    } == expected
    assert all(r.avg_hour == float(r.hour) for r in found)


def test_density_and_correlation(records, sample):
    bags = defaultdict(Counter)
    for day, area, category in by_day(sample):
        bags[(day, area)][category] += len(by_day(sample)[(day, area, category)])
    days = cells.day_cells(records)
    for r in rows(rollups.density(days)):
        bag = bags[(r["date_partition"], r["district"])]
        assert r["total_crimes"] == sum(bag.values())
        assert r["crime_type_variety"] == len(bag)
        assert r["crime_density_score"] == sum(bag.values()) * len(bag)
        assert r["crime_types_list"] == sorted(bag)
        assert {c["category"]: c["n"] for c in r["crime_type_counts"]} == bag
    for r in rows(rollups.correlation(days)):
        bag = bags[(r["date_partition"], r["district"])]
        assert r["crime_types_in_area"] == sorted(bag)
        assert r["crime_diversity_index"] == pytest.approx(len(bag) / 6)


@pytest.mark.parametrize("chunk", [1, 7, 10_000])
def test_category_bag_is_whole(records, sample, chunk):
    bag = rollups.category_bag(cells.day_cells(records), chunk).collect()
    assert max(len(r.crime_types_list) for r in bag) <= chunk
    found = Counter()
    for r in bag:
        found[(r.date_partition, r.district, r.crime_type)] += len(r.crime_types_list)
        assert set(r.crime_types_list) == {r.crime_type}
    assert found == Counter({k: len(v) for k, v in by_day(sample).items()})


def test_diversity_exceeds_one_with_unknown(spark):
    kinds = ["robo", "extorsión", "sicariato", "asesinato", "secuestro", "estafa", "Unknown"]
    seven = spark.createDataFrame([("A", k, "r", START) for k in kinds], SCHEMA)
    index = rollups.correlation(cells.day_cells(seven)).first().crime_diversity_index
    assert index == pytest.approx(7 / 6)


def test_reporter_counts(records, sample):
    expected = {k: len({r for r, _ in v}) for k, v in by_day(sample).items()}
    found = rollups.reporter_counts(records).collect()
    assert {(r.date_partition, r.district, r.crime_type): r.reporters for r in found} == expected


def test_other_column_names(spark):
    names = Names(area="place", category="kind", clock="at", date="day")
    df = spark.createDataFrame(
        [("x", "a", START), ("x", "b", START)], "place string, kind string, at timestamp"
    )
    days = cells.day_cells(df, names)
    assert rollups.density(days, names).first().crime_density_score == 4
    assert alerts.critical_alerts(days, {"a": 1}, names).first().alert_message == (
        "ALERTA: 1 casos de a en x"
    )


def test_window_cells(records, sample):
    expected = Counter(
        (at.replace(minute=at.minute // 10 * 10), area, category)
        for area, category, _, at in sample
    )
    found = cells.window_cells(records, 600).collect()
    assert {(r.window_start, r.district, r.crime_type): r.n for r in found} == expected


def test_minute_bucket(spark):
    times = [(START + timedelta(minutes=m),) for m in (0, 9, 10, 59)]
    df = spark.createDataFrame(times, "t timestamp")
    buckets = df.select(minute_bucket(F.col("t")).alias("b"))
    assert [r.b for r in buckets.collect()] == [0, 0, 10, 50]


# ------------------------------------------------------------------ alerts


def cell_frame(spark, data):
    return spark.createDataFrame(
        [("2025-08-04", "Norte", kind, n, START) for kind, n in data],
        "date_partition string, district string, crime_type string, n bigint, last_time timestamp",
    )


def test_thresholds(spark):
    cells_in = cell_frame(
        spark, [("robo", 15), ("estafa", 7), ("secuestro", 1), ("Unknown", 10**6), (None, 99)]
    )
    marked = {r.crime_type: r.is_critical for r in alerts.evaluate_thresholds(cells_in).collect()}
    assert marked == {
        "robo": True, "estafa": False, "secuestro": True, "Unknown": False, None: False,
    }
    critical = rows(alerts.critical_alerts(cells_in), "crime_type")
    assert [r["alert_message"] for r in critical] == [
        "ALERTA: 15 casos de robo en Norte",
        "ALERTA: 1 casos de secuestro en Norte",
    ]
    assert {(r["alert_level"], r["is_critical"]) for r in critical} == {("CRITICAL", True)}


def test_threshold_table_gives_the_same(spark):
    cells_in = cell_frame(spark, [("robo", 15), ("estafa", 7)])
    table = spark.createDataFrame([("robo", 15), ("estafa", 8)], "kind string, least int")
    assert rows(alerts.critical_alerts(cells_in, table)) == rows(alerts.critical_alerts(cells_in))


@pytest.mark.parametrize(
    "message, area",
    [
        ("ALERTA: 3 casos de robo en Vía a la Costa", "Vía a la Costa"),
        ("x en Ángel", "Unknown"),
        ("x en Zona 7", "Unknown"),
        ("x en Norte  ", "Norte"),
        ("sin lugar", "Unknown"),
        ("a en b en c", "b en c"),
        ("", "Unknown"),
        (None, None),
    ],
)
def test_area_from_message(spark, message, area):
    df = spark.createDataFrame([(message,)], "m string")
    assert df.select(area_from_message(F.col("m")).alias("a")).first().a == area


def test_normalise_alerts_defaults(spark):
    bare = spark.createDataFrame([("ALERTA: 2 casos de robo en Sur",)], "alert_message string")
    found = alerts.normalise_alerts(bare, F.lit(START)).first()
    assert (found.district, found.crime_type, found.crime_count) == ("Sur", "Unknown", 0)
    assert (found.alert_level, found.is_critical) == ("CRITICAL", True)
    no_message = spark.createDataFrame([("Sur", 3)], "District string, crime_count int")
    found = alerts.normalise_alerts(no_message, F.lit(START)).first()
    assert (found.district, found.alert_message) == ("Sur", "Security alert in Sur")


def test_normalise_alerts_drops_unreadable(spark):
    data = [
        ("Sur", "m", "3"),
        ("Sur", "m", None),
        ("Sur", "m", "many"),
        (None, None, "3"),
        ("", "x en Sur", "4"),
        ("Unknown", "x", "5"),
    ]
    df = spark.createDataFrame(data, "district string, alert_message string, crime_count string")
    found = alerts.normalise_alerts(df, F.lit(START)).collect()
    assert [(r.district, r.crime_count) for r in found] == [("Sur", 3), ("Sur", 4), ("Unknown", 5)]


def test_alert_view_order_and_labels(spark):
    now = START + timedelta(hours=2)
    data = [
        ("a", True, now - timedelta(seconds=59)),
        ("b", False, now),
        ("c", True, now - timedelta(seconds=60)),
        ("d", True, now - timedelta(hours=2)),
    ]
    df = spark.createDataFrame(data, "id string, is_critical boolean, added_at timestamp")
    for name in ("district", "crime_type", "alert_level", "alert_message", "alert_time"):
        df = df.withColumn(name, F.lit("x"))
    view = alerts.alert_view(df.withColumn("crime_count", F.lit(1)), F.lit(now)).collect()
    assert [(r.id, r.time_ago, r.time_ago_label, r.severity) for r in view] == [
        ("a", 59, "59s", "CRÍTICA"),
        ("c", 60, "1m", "CRÍTICA"),
        ("d", 7200, "2h", "CRÍTICA"),
        ("b", 0, "0s", "ALERTA"),
    ]
    counts = alerts.alert_counts(df).first()
    assert (counts["count"], counts["critical_count"]) == (4, 3)


def test_age_label(spark):
    ages = [0, 59, 60, 3599, 3600, 90_000]
    df = spark.createDataFrame([(a,) for a in ages], "a bigint")
    labels = [r.l for r in df.select(age_label(F.col("a")).alias("l")).collect()]
    assert labels == ["0s", "59s", "1m", "59m", "1h", "25h"]


# ----------------------------------------------------------------- density


def density_rows(spark, data):
    return spark.createDataFrame(
        data,
        "district string, total_crimes bigint, crime_type_variety bigint,"
        " crime_density_score bigint, date_partition string",
    )


def test_lists_from_arrays_and_text(spark):
    base = spark.createDataFrame([(["b", "a", "b"],)], "crime_types_list array<string>")
    found = density.normalise_density(base, F.lit(START)).first()
    assert (found.crime_types_list, found.crime_type_variety) == (["b", "a"], 2)
    assert (found.district, found.total_crimes, found.date_partition) == (
        "Unknown", 0, "2025-08-03",
    )
    text = spark.createDataFrame(
        [('["a","b","a"]',), ("a",), ('["a",',), ("[]",), (None,)], "crime_types_list string"
    )
    lists = [r.crime_types_list for r in density.normalise_density(text, F.lit(START)).collect()]
    assert lists == [["a", "b"], ["a"], ['["a",'], []]


def test_ranking_summary_and_percent(spark):
    data = [("S", 4, 2, 8), ("N", 10, 2, 20), ("C", 10, 2, 20), ("Z", 1, 1, 1)]
    df = density_rows(spark, [(*row, "d") for row in data])
    assert [r.district for r in density.rank_density(df).collect()] == ["C", "N", "S", "Z"]
    summary = density.density_summary(df).first().asDict()
    assert summary == {
        "total_crimes": 25,
        "avg_density": 12.25,
        "max_density": 20.0,
        "districts_analyzed": 4,
        "hotspot": "C",
    }
    assert density.hotspot(df).first().district == "C"
    shares = {r.district: r.density_percent for r in density.relative_density(df).collect()}
    assert shares == {"C": 100.0, "N": 100.0, "S": 40.0, "Z": 5.0}
    assert density.relative_density(df).first().variety_ratio == "2/6"


def test_empty_density(spark):
    empty = density_rows(spark, [])
    assert density.density_summary(empty).first().asDict() == {
        "total_crimes": 0,
        "avg_density": 0.0,
        "max_density": 0.0,
        "districts_analyzed": 0,
        "hotspot": "N/A",
    }
    zero = density_rows(spark, [("A", 0, 0, 0, "d")])
    assert density.relative_density(zero).first().density_percent == 0.0


# ------------------------------------------------------------------- feeds


def feed(spark, data):
    return spark.createDataFrame(
        [(i, START + timedelta(seconds=s)) for i, s in data], "id string, added_at timestamp"
    )


def test_expiry_is_strict(spark):
    df = feed(spark, [("old", 0), ("edge", 10), ("young", 11), ("now", 70), ("future", 71)])
    live = feeds.live_rows(df, START + timedelta(seconds=70), 60)
    assert [r.id for r in live.collect()] == ["young", "now"]


def test_live_rows_with_date_partition(spark):
    df = feed(spark, [("a", 0), ("b", 7190), ("c", 7210)]).withColumn(
        "date_partition", F.date_format("added_at", "yyyy-MM-dd")
    )
    now = START + timedelta(seconds=7220)
    plain = feeds.live_rows(df, now, 60)
    dated = feeds.live_rows(df, now, 60, date="date_partition")
    assert rows(plain) == rows(dated) and [r["id"] for r in rows(dated)] == ["b", "c"]


def test_new_expired_and_metrics(spark):
    rng = random.Random(3)
    data = [
        ("hot" if i % 3 == 0 else f"i{rng.randrange(60)}", rng.randrange(200)) for i in range(300)
    ]
    df = feed(spark, data)
    at = {s: START + timedelta(seconds=s) for s in (100, 150)}
    alive = {s: {i for i, t in data if s - 60 < t <= s} for s in at}
    before, now = (feeds.live_rows(df, at[s], 60) for s in (100, 150))

    fresh = feeds.new_rows(now, before, ["id"]).collect()
    assert sorted(r.id for r in fresh) == sorted(alive[150] - alive[100])
    repeats = feeds.new_rows(now, before, ["id"], keep_repeats=True).collect()
    assert sorted(r.id for r in repeats) == sorted(
        i for i, t in data if 90 < t <= 150 and i not in alive[100]
    )
    gone = {r.id for r in feeds.expired_rows(before, now, ["id"]).collect()}
    assert gone == alive[100] - alive[150]
    metrics = feeds.feed_metrics(df, at[100], at[150], 60, ["id"]).first()
    assert (metrics.expired_count, metrics.added_count, metrics.active_count) == (
        len(gone), len(alive[150] - alive[100]), len(alive[150]),
    )


def test_null_ids_match_each_other(spark):
    live, incoming = feed(spark, [(None, 0)]), feed(spark, [(None, 5), ("a", 5)])
    assert [r.id for r in feeds.new_rows(incoming, live, ["id"]).collect()] == ["a"]
    extended = feeds.extend_live(live, feeds.new_rows(incoming, live, ["id"]))
    assert extended.count() == 2


def test_first_per_id_keeps_the_earliest(spark):
    df = feed(spark, [("a", 5), ("a", 3), ("b", 9), ("a", 4)])
    found = {r["id"]: r["added_at"] for r in rows(feeds.first_per_id(df, ["id"]))}
    assert found == {"a": START + timedelta(seconds=3), "b": START + timedelta(seconds=9)}


# ---------------------------------------------------------------- rankings


@pytest.mark.parametrize("k", [1, 8, 1001])
def test_latest_per_group_with_hot_group(spark, k):
    rng = random.Random(11)
    data = [("hot" if i % 3 == 0 else f"g{i % 5}", rng.randrange(10**6), i) for i in range(6000)]
    # Identical copies must not crowd out or merge with other rows.
    data += [("hot", 10**6, -1)] * 3
    df = spark.createDataFrame(data, "g string, t bigint, i bigint").repartition(8)
    expected = []
    for g in {d[0] for d in data}:
        group = sorted((d for d in data if d[0] == g), key=lambda d: (-d[1], d[2]))
        expected += group[:k]
    found = ranking.latest_per_group(df, ["g"], [F.desc("t"), F.asc("i")], k).collect()
    assert sorted(tuple(r) for r in found) == sorted(expected)


def test_latest_batch(spark):
    df = spark.createDataFrame([(1, "b1"), (2, "b2"), (3, "b2")], "x int, batch string")
    assert [r.x for r in ranking.latest_batch(df, "batch").collect()] == [2, 3]


def test_category_attribute(spark):
    df = spark.createDataFrame([("Extorsión",), ("ROBO",), ("otro",), (None,)], "type string")
    folded = [r.color for r in lookups.category_attribute(df).collect()]
    assert folded == ["#ff8800", "#ff4444", "#666666", "#666666"]
    exact = [r.color for r in lookups.category_attribute(df, fold_accents=False).collect()]
    assert exact == ["#666666", "#ff4444", "#666666", "#666666"]
    table = spark.createDataFrame([("robo", "x")], "k string, v string")
    assert [r.color for r in lookups.category_attribute(df, entries=table, default="-").collect()][
        1
    ] == "x"


def test_fold_key(spark):
    df = spark.createDataFrame([("Samborondón ÑANDÚ",)], "t string")
    assert df.select(fold_key(F.col("t")).alias("k")).first().k == "samborondon nandu"
