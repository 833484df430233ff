from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from blotter.operators.envelope import (
    decode_envelope,
    decode_records,
    extract_fields,
    fact_rows,
    publish_rows,
    topic_rows,
)
from blotter.operators.points import decode_points, quarantined_points
from blotter.schema import FACT_SCHEMA, SOURCE_SCHEMA

NOON = datetime(2025, 8, 4, 12, 0, 0)


def source(spark, values):
    data = [
        (bytearray(f"k{i}", "utf8"), None if v is None else bytearray(v, "utf8"), "t", 0, i, NOON)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(data, SOURCE_SCHEMA)


def record(category='"robo"', area='"Norte"', reporter='"abc"'):
    return (
        f'{{"crime_type":{category},"location":{{"district":{area}}},'
        f'"reporter_info":{{"cedula_hash":{reporter}}}}}'
    )


CATEGORY_CASES = [
    ('{"a":1}', "Unknown"),
    ('{"crime_type":null}', "Unknown"),
    ('{"crime_type":5}', "5"),
    ('{"crime_type":1.50}', "1.5"),
    ('{"crime_type":true}', "true"),
    ('{"crime_type":{"x":1}}', '{"x":1}'),
    ('{"crime_type":[1, "b"]}', '[1,"b"]'),
    ('{"crime_type":', "Unknown"),
    ('{"crime_type":"robo","x":', "Unknown"),
    ('{"crime_type":NaN}', "Unknown"),
    ('{"crime_type":"tab\there"}', "tab\there"),
    ('[{"crime_type":"a"}]', "Unknown"),
    ('"text"', "Unknown"),
    ("", "Unknown"),
    (None, "Unknown"),
    ('{"Crime_Type":"upper"}', "Unknown"),
    ('{"crime_type":"extorsión"}', "extorsión"),
    ('{"location":"flat","crime_type":"q"}', "q"),
]


@pytest.mark.parametrize("per_path", [False, True])
def test_category_corpus(spark, per_path):
    decoded = decode_envelope(source(spark, [v for v, _ in CATEGORY_CASES]))
    found = extract_fields(decoded, per_path=per_path).orderBy("kafka_offset").collect()
    assert [r.crime_type for r in found] == [want for _, want in CATEGORY_CASES]


def test_repeated_key_takes_last_or_first(spark):
    decoded = decode_envelope(source(spark, ['{"crime_type":"a","crime_type":"b"}']))
    assert extract_fields(decoded).first().crime_type == "b"
    assert extract_fields(decoded, per_path=True).first().crime_type == "a"


@pytest.mark.parametrize("per_path", [False, True])
def test_only_empty_fields_are_filtered(spark, per_path):
    raw = source(
        spark,
        [
            record(),
            record(category='""'),
            record(area='""'),
            record(reporter='""'),
            record(category="null"),
            "not json",
        ],
    )
    kept = decode_records(raw, clock=F.col("kafka_timestamp"), per_path=per_path)
    assert [(r["kafka_offset"], r["crime_type"], r["district"]) for r in rows(kept, "kafka_offset")] == [
        (0, "robo", "Norte"),
        (4, "Unknown", "Norte"),
        (5, "Unknown", "Unknown"),
    ]
    assert {r["date_partition"] for r in rows(kept)} == {"2025-08-04"}


def test_clock_defaults_to_one_batch_time(spark):
    kept = decode_records(source(spark, [record(), record()]))
    assert kept.select("processing_time").distinct().count() == 1


def test_fact_and_topic_rows(spark):
    kept = decode_records(source(spark, [record()]), clock=F.col("kafka_timestamp"))
    facts = fact_rows(kept)
    assert facts.columns == FACT_SCHEMA.names
    topic = topic_rows(kept).first()
    assert topic.key == "k0"
    value = spark.range(1).select(
        F.from_json(
            F.lit(topic.value),
            "crime_data string, processing_time timestamp, kafka_timestamp timestamp,"
            " kafka_partition int, kafka_offset bigint",
        ).alias("v")
    )
    got = value.select("v.*").first()
    assert (got.crime_data, got.processing_time) == (record(), NOON)
    assert (got.kafka_timestamp, got.kafka_partition, got.kafka_offset) == (NOON, 0, 0)


def test_publish_keeps_nulls_and_accents(spark):
    rows_in = spark.createDataFrame(
        [("A-1", "extorsión", None)], "crime_id string, t string, n int"
    )
    out = publish_rows(rows_in).first()
    assert (out.key, out.value) == ("A-1", '{"crime_id":"A-1","t":"extorsión","n":null}')


def facts_of(spark, payloads):
    data = [(p, NOON, NOON, "c", "h", "2025-08-04", "d") for p in payloads]
    return spark.createDataFrame(data, FACT_SCHEMA)


def point(lat="-2.1", lon="-79.9", extra=""):
    return f'{{"location":{{"coordinates":{{"lat":{lat},"lon":{lon}}}{extra}}}}}'


def test_points_defaults_and_nulls(spark):
    full = (
        '{"crime_id":"A","timestamp":"t","crime_type":"robo","location":'
        '{"district":"Sur","coordinates":{"lat":1,"lon":2.5}}}'
    )
    nulls = (
        '{"crime_id":null,"timestamp":null,"crime_type":null,"location":'
        '{"district":null,"coordinates":{"lat":1,"lon":2}}}'
    )
    found = decode_points(facts_of(spark, [full, point(), nulls])).collect()
    assert [(r.id, r.timestamp, r.lat, r.lon, r.type, r.district) for r in found] == [
        ("A", "t", 1.0, 2.5, "robo", "Sur"),
        ("crime_1754308800", "2025-08-04T12:00:00.000000", -2.1, -79.9, "unknown", "unknown"),
        (None, None, 1.0, 2.0, None, None),
    ]


def test_points_quarantine(spark):
    good = [point(), point(lat='"-2.1"'), point(lat='" 3 "')]
    bad = [
        point(lat='"x"'),
        point(lat="null"),
        '{"crime_type":"robo"}',
        '{"location":null}',
        "[]",
        '{"location":',
        None,
    ]
    facts = facts_of(spark, good + bad)
    assert [r.lat for r in decode_points(facts).collect()] == [-2.1, -2.1, 3.0]
    quarantined = quarantined_points(facts)
    assert quarantined.columns == facts.columns
    assert [r.crime_data for r in quarantined.collect()] == bad
