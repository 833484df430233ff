"""Registered corpus queries against SQL, and the pipeline against its rules."""

import pytest
from compare import oracle_rows, rows_of

import corpus_pipeline
from blotter.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, SF)
    columns, _, expected = oracle_rows(SF, ORACLES[name])
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == expected


def test_operators_are_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_pipeline_stages_take_effect(spark):
    from test_links import slow_fingerprint
    from test_text_filters import brute_contamination

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {"": {r["doc_id"]: r for r in docs.collect()}}
    last = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        last = stage(spark, last, SF)
        assert last.columns == docs.columns
        last = spark.createDataFrame(last.collect(), docs.schema)
        kept[name] = {r["doc_id"]: r for r in last.collect()}
        assert len(kept[name]) == last.count()
    before, by_language, by_quality, by_copies, clean = kept.values()
    assert all(any(map(str.isalpha, r["text"])) for r in by_language.values())
    assert len(by_language) >= 0.98 * len(before)
    wrong = [i for i in by_language if i in labels and labels[i] != (i in by_quality)]
    assert len(wrong) <= 0.05 * len(labels)
    fps = {i: slow_fingerprint(r["text"]) for i, r in by_quality.items()}
    for i, f in fps.items():
        smaller = [j for j in fps if j < i and (fps[j] ^ f).bit_count() <= 3]
        if not smaller:
            assert i in by_copies
    heads = sorted(by_copies)
    assert all((fps[a] ^ fps[b]).bit_count() > 3 for a in heads for b in heads if a < b)
    dirty = {i for i, _, n, _ in brute_contamination([(i, r["text"]) for i, r in by_copies.items()], bench) if n}
    assert dirty and set(clean) == set(by_copies) - dirty
    packed = corpus_pipeline.STAGES[-1][1](spark, last, SF).collect()
    assert {r["doc_id"] for r in packed} == set(clean)


def test_whole_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns[:2] == ["doc_id", "piece"] and rows.count() > 100


ODD = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows_and_clashing_columns(spark, name):
    from pyspark.sql import functions as F

    stage = dict(corpus_pipeline.STAGES)[name]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    odd = [
        (None, None, None, None, None), (None, "", None, None, 0), (5001, None, None, None, None),
        (5002, "", "en", None, 0), (5003, "  \n", "en", "s", 3), (5004, "x " * 30_000, "en", "s", 60_000),
        (5005, "twice the same row", "en", "s", 18), (5005, "twice the same row", "en", "s", 18),
        (5005, "another text of this id", "en", "s", 23),
    ]
    frame = docs.unionByName(spark.createDataFrame(odd, ODD))
    clashing = ["head", "mark", "again", "lang_pred", "predicted", "n_words", "hit_spans", "digest", "length", "offset", "rows"]
    frame = frame.withColumns({c: F.lit(7) for c in clashing})
    whole = spark.createDataFrame(frame.collect(), frame.schema)
    out = stage(spark, whole, SF)
    found = out.collect()
    if name == "packing":
        assert {r["doc_id"] for r in found} >= {5001, 5002, 5003, 5004, 5005, None}
    else:
        assert out.columns == whole.columns
        texts = {(r["doc_id"], r["text"]) for r in found}
        assert texts <= {(r["doc_id"], r["text"]) for r in whole.collect()}
        if name == "near_copies":
            assert sum(r["doc_id"] == 5005 for r in found) == 2
    assert stage(spark, whole.limit(0), SF).collect() == []
