"""Every registered query against its SQL counterpart."""

import pytest
from compare import oracle_rows, rows_of

from __spark_entry__ import entry, oracle_sql, queries
from blotter.plans.oracles import ORACLES
from blotter.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry_is_lazy_and_ranked(spark):
    scores = [r.crime_density_score for r in entry(spark).collect()]
    assert scores and scores == sorted(scores, reverse=True)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, SF)
    columns, _, expected = oracle_rows(SF, ORACLES[name])
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == expected


@pytest.fixture(scope="module")
def later_events(tmp_path_factory):
    """The events 400 days later, every eleventh without a clock."""
    import datetime as dt

    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tmp_path_factory.mktemp("later")
    events = pq.read_table(f"{SF}/events.parquet").sort_by("event_id")
    at = [
        None if i % 11 == 5 else t + dt.timedelta(days=400)
        for i, t in enumerate(events["ts"].to_pylist())
    ]
    place = events.schema.get_field_index("ts")
    moved = events.set_column(place, events.schema.field(place), pa.array(at, events.schema.field(place).type))
    pq.write_table(moved, folder / "events.parquet")
    return str(folder)


@pytest.mark.parametrize(
    "name",
    [
        "trigger_volumes",
        "observed_feed",
        "stream_dedupe",
        "stream_live_feed",
        "stream_expired",
        "stream_windowed_alerts",
        "stream_rollup",
    ],
)
def test_stream_query_on_events_of_another_year_and_without_clocks(spark, later_events, name):
    df = QUERIES[name](spark, later_events)
    columns, _, expected = oracle_rows(later_events, ORACLES[name])
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == expected
    if name == "trigger_volumes":
        assert len(expected) == 4


def test_lots_are_spread_over_cores_however_the_events_are_stored(spark, tmp_path):
    """One row group of events: each lot is as many files as cores, every event is in one lot."""
    from types import SimpleNamespace

    from blotter.plans import queries as plans

    path, counts = str(tmp_path / "lots"), []

    def start():
        counts.append(len(list((tmp_path / "lots").glob("*.parquet"))))
        return SimpleNamespace(awaitTermination=lambda: None)

    assert len(plans._each_lot(spark, SF, path, start)) == plans.LOTS
    cores = spark.sparkContext.defaultParallelism
    assert counts == [cores * (i + 1) for i in range(plans.LOTS)]
    events = spark.read.parquet(f"{SF}/events.parquet")
    found = spark.read.parquet(path)
    assert found.schema == events.schema
    assert found.count() == events.count() and found.exceptAll(events).isEmpty()
    # The second half alone, behind the first, in files of other names.
    plans._each_lot(spark, SF, path, start, range(plans.LOTS // 2, plans.LOTS))
    assert counts[-1] == cores * (plans.LOTS + plans.LOTS // 2)
