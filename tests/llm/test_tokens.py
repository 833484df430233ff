"""Token counts, token files and packing against the tokenizer libraries."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from blotter.llm import huffman, packing, token_files
from blotter.llm.packing import Capacity, best_fit, pack, pack_documents
from blotter.llm.piece_counts import count_tokens, pretoken_counts
from blotter.llm.queries import QUERIES
from blotter.llm.token_files import read_token_files, token_digests, write_token_files
from blotter.llm.word_ids import word_ids

SF = "/root/testdata/sf0.001"
PIECES, WORDS = map(public_tokenizers.path, ("piece_bpe_32k.model", "word_bpe_49k.json"))
TEXTS = st.text(
    st.one_of(st.sampled_from(" \n\t\r▁'<|>.é́ \u0085\u001cßİΣ²ª日🙂aThe1"), st.characters(codec="utf-8")),
    max_size=40,
)
ODD = [None, "", " ", "\n", "  \n ", "a  b ", "<|endoftext|>x", "</s> [INST]", "it's 'RE", "x" * 5000, "▁▁", "\x00"]


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def word_list(words, text):
    return words.encode(text or "", add_special_tokens=False).ids + [1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_piece_counts_equal_the_library(text):
    with open(PIECES, "rb") as f:
        counts = pretoken_counts(f.read())
    assert counts.count(text) == len(counts.tokenizer.encode(text))


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_word_ids_equal_the_library(text):
    with open(WORDS, "rb") as f:
        found = word_ids(f.read())
    assert found.encode(text) == found.library(text)


def test_whole_tokens_are_one_token_alone(pieces):
    with open(PIECES, "rb") as f:
        whole = pretoken_counts(f.read()).whole
    assert len(whole) > 10_000
    sample = random.Random(0).sample(sorted(w for w in whole if w), 500)
    assert all(len(pieces.encode(w)) == 1 for w in sample)


def odd_docs(spark):
    rows = [(i, t) for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, rows[5], (None, "no id")], "doc_id long, text string")


def test_counts_of_odd_texts_and_clashing_columns(spark, pieces):
    docs = odd_docs(spark).withColumn("n_tokens", F.lit("mine"))
    found = count_tokens(docs, PIECES, limit=10)
    assert found.columns == ["doc_id", "n_tokens", "n_bytes", "n_tokens_", "over_limit"]
    expected = [
        (r["doc_id"], "mine", len((r["text"] or "").encode()), len(pieces.encode(r["text"] or "")))
        for r in docs.collect()
    ]
    rows = [tuple(r) for r in found.collect()]
    assert sorted(map(str, rows)) == sorted(str((*e, e[3] > 10)) for e in expected)
    assert count_tokens(docs.limit(0), PIECES).collect() == []


def test_registered_counts(spark, pieces):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op3_token_counts"](spark, SF).collect():
        n = len(pieces.encode(docs[r["doc_id"]]))
        assert tuple(r) == (r["doc_id"], len(docs[r["doc_id"]].encode()), n, n > 4096)


# ---------------------------------------------------------------- huffman


def plain_huffman_cost(counts):
    import heapq

    heap = [c for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        merged = heapq.heappop(heap) + heapq.heappop(heap)
        cost += merged
        heapq.heappush(heap, merged)
    return cost


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=2, max_size=300), st.integers(1, 100))
def test_codes_are_optimal_and_streams_come_back(counts, every):
    counts = np.array(counts, np.int64)
    counts[:2] += 1
    lengths = huffman.code_lengths(counts)
    assert (lengths > 0).tolist() == (counts > 0).tolist()
    assert (2.0 ** -lengths[lengths > 0].astype(float)).sum() <= 1
    if lengths.max() < huffman.MAX_BITS:
        assert int(counts @ lengths.astype(np.int64)) == plain_huffman_cost(counts.tolist())
    ids = np.random.default_rng(0).choice(np.flatnonzero(counts), 777).astype(np.uint16)
    packed, marks = huffman.write_bits(ids, huffman.canonical_codes(lengths), lengths, every)
    numbers = np.full(len(marks), every)
    numbers[-1] = len(ids) - every * (len(marks) - 1)
    raw = np.frombuffer(packed, np.uint8)
    assert huffman.read_bits(raw, marks, numbers, huffman.decode_table(lengths)).tolist() == ids.tolist()


def test_lengths_stay_in_the_limit():
    counts = np.array([1 << min(i, 60) for i in range(40)], np.int64)
    lengths = huffman.code_lengths(counts)
    assert lengths.max() <= huffman.MAX_BITS
    assert (2.0 ** -lengths.astype(float)).sum() <= 1
    assert huffman.code_lengths(np.array([0, 5])).tolist() == [0, 1]
    assert huffman.code_lengths(np.zeros(3, np.int64)).tolist() == [0, 0, 0]


# ------------------------------------------------------------------ files


def test_files_come_back_in_order(spark, tmp_path, words, monkeypatch):
    monkeypatch.setattr(token_files, "LEAST_PART_TOKENS", 300)
    monkeypatch.setattr(token_files, "BLOCK_TOKENS", 100)
    docs = odd_docs(spark).union(
        spark.createDataFrame([(100 + i, "word " * (i % 7) + str(i)) for i in range(200)], "doc_id long, text string")
    )
    path = str(tmp_path / "files")
    write_token_files(docs.repartition(5).withColumn("n", F.lit(1)), path, WORDS)
    blocks = spark.read.parquet(f"{path}/blocks")
    assert blocks.select("part").distinct().count() > 3 and blocks.count() > 6
    rows = sorted(read_token_files(spark, path).collect(), key=lambda r: r["start"])
    expected = sorted(
        ((r["doc_id"], word_list(words, r["text"])) for r in docs.collect()),
        key=lambda e: (e[0] is not None, e[0] or 0, np.array(e[1], "<u2").tobytes()),
    )
    start = 0
    for row, (doc_id, ids) in zip(rows, expected, strict=True):
        assert (row["doc_id"], row["start"], row["n_tokens"]) == (doc_id, start, len(ids))
        assert np.frombuffer(row["ids"], "<u4").tolist() == ids
        start += len(ids)
    digests = {(r["start"], r["ids_crc32"]) for r in token_digests(spark, path).collect()}
    assert digests == {(r["start"], zlib.crc32(r["ids"])) for r in rows}


def test_files_of_no_documents(spark, tmp_path):
    path = str(tmp_path / "files")
    write_token_files(odd_docs(spark).limit(0), path, WORDS)
    assert read_token_files(spark, path).collect() == []


def test_registered_files(spark, words):
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    expected, start = [], 0
    for doc_id, text in docs:
        ids = word_list(words, text)
        expected.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(tuple(r) for r in QUERIES["op4_token_files"](spark, SF).collect()) == expected


# ---------------------------------------------------------------- packing


def one_at_a_time(counts, capacity):
    """Best fit over single pieces, the slow way; the number of sequences."""
    full, weights = capacity.full(), np.array(capacity.weights)
    scale, bins = np.maximum(full, 1), []
    for length in sorted(counts, reverse=True):
        need = capacity.demand(length)
        for _ in range(counts[length]):
            fits = []
            for i, free in enumerate(bins):
                if (free >= need).all():
                    dot = -((free / scale) * (need / scale) * weights).sum()
                    norm = ((((free - need) / scale) ** 2) * weights).sum()
                    fits.append((dot if capacity.rule == "dot" else norm, tuple(free), i))
            if fits:
                i = min(fits)[2]
                bins[i] = bins[i] - need
            else:
                bins.append(full - need)
    return len(bins)


def check_runs(counts, capacity, runs):
    ranks, sequences = {}, {}
    for length, rank, number, first, offset in runs:
        for k in range(number):
            assert (length, rank + k) not in ranks
            ranks[length, rank + k] = True
            sequences.setdefault(first + k, []).append((offset, length))
    assert len(ranks) == sum(counts.values())
    assert all(rank < counts[length] for length, rank in ranks)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity.tokens
        assert len(parts) <= (capacity.documents or at)
        assert capacity.cost is None or sum(n * n for _, n in parts) <= capacity.cost
    assert sorted(sequences) == list(range(len(sequences)))
    return len(sequences)


CAPACITIES = [
    Capacity(100),
    Capacity(100, documents=4),
    Capacity(100, cost=10_000),
    Capacity(100, documents=5, cost=12_000, rule="dot"),
]


@settings(max_examples=25, deadline=None)
@given(st.dictionaries(st.integers(1, 100), st.integers(1, 40), max_size=25), st.sampled_from(CAPACITIES))
def test_grouped_best_fit_equals_one_at_a_time(counts, capacity):
    used = check_runs(counts, capacity, best_fit(counts, capacity))
    assert used == one_at_a_time(counts, capacity)


def test_ordinary_lengths_fill_the_sequences():
    sizes = np.random.default_rng(0).lognormal(6.3, 1, 20_000).clip(2, 4096).astype(int)
    lengths, number = np.unique(sizes, return_counts=True)
    counts = dict(zip(lengths.tolist(), number.tolist(), strict=True))
    used = check_runs(counts, Capacity(), best_fit(counts, Capacity()))
    assert used <= 1.002 * sizes.sum() / 4096 + 1


def test_registered_uses_score_all_capacities(spark, monkeypatch):
    import corpus_pipeline
    from blotter.llm import queries

    used = []
    for module in (queries, corpus_pipeline):
        monkeypatch.setattr(module, "pack_documents", lambda docs, vocabulary, capacity: used.append(capacity))
    QUERIES["op10_packing"](spark, SF)
    corpus_pipeline.packing(spark, None, SF)
    assert len(used) == 2
    for capacity in used:
        assert capacity.tokens == 4096 and capacity.full().all() and capacity.demand(7).all()


@pytest.mark.parametrize("tokens", [100, 4095, 4096, 5000])
def test_documents_and_cost_of_tokens_force_no_sequence(tokens):
    capacity = Capacity.of_tokens(tokens)
    rng = random.Random(tokens)
    splits = [[1] * tokens, [tokens - 1, 1], [tokens], [tokens // 2, tokens - tokens // 2]]
    for _ in range(200):
        cuts = sorted(rng.sample(range(1, tokens), rng.randint(1, 60)))
        splits.append([b - a for a, b in zip([0, *cuts], [*cuts, tokens], strict=True)])
    for lengths in splits:
        assert (sum(capacity.demand(n) for n in lengths) <= capacity.full()).all()


def test_capacities_are_checked():
    for wrong in ({"tokens": 0}, {"rule": "x"}, {"tokens": 10, "cost": 99}, {"documents": 0}):
        with pytest.raises(ValueError):
            Capacity(**wrong)


def test_pieces_of_odd_documents(spark, words):
    docs = odd_docs(spark).withColumn("length", F.lit("x"))
    rows = pack_documents(docs, WORDS, Capacity(64)).collect()
    found = sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=str)
    expected = []
    for r in docs.collect():
        ids = word_list(words, r["text"])
        for k, at in enumerate(range(0, len(ids), 64)):
            part = ids[at : at + 64]
            expected.append((r["doc_id"], k, at, len(part), crc(part)))
    assert found == sorted(expected, key=str)
    filled: dict = {}
    for r in rows:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert pack_documents(docs.limit(0), WORDS).collect() == []


def test_runs_beyond_the_broadcast_bound_are_joined(spark, monkeypatch):
    monkeypatch.setattr(packing, "MAX_BROADCAST_RUNS", 0)
    monkeypatch.setattr(packing, "SLICE_ROWS", 3)  # the pieces of a length fall into slices
    pieces = spark.range(500).select("id", (F.col("id") % 37 + 1).alias("length"))
    rows = pack(pieces, Capacity(40)).collect()
    assert len(rows) == 500 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 500
    with pytest.raises(ValueError):
        pack(pieces, Capacity(30))


def test_registered_packing(spark, words):
    rows = QUERIES["op10_packing"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    ids = {r["doc_id"]: word_list(words, r["text"]) for r in docs}
    assert sum(r["length"] for r in rows) == sum(map(len, ids.values()))
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["start"] == 4096 * r["piece"] and crc(part) == r["ids_crc32"]
    used = len({r["sequence_id"] for r in rows})
    assert used <= 1.02 * sum(map(len, ids.values())) / 4096 + 1
    # Every piece of every document is there once, and sequences have neither gaps nor overlaps.
    assert sorted((r["doc_id"], r["piece"]) for r in rows) == sorted(
        (i, p) for i, found in ids.items() for p in range(-(-len(found) // 4096))
    )
    assert all(r["length"] == min(4096, len(ids[r["doc_id"]]) - r["start"]) for r in rows)
    filled: dict = {}
    for r in rows:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in filled.values():
        ends = [0]
        for offset, length in sorted(parts):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 4096


def test_pieces_may_have_columns_of_the_result(spark):
    from blotter.llm.packing import Capacity, pack

    rows = [(i, 1 + i % 5, 9, 8, 7) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, length long, offset int, sequence_id int, _rank int")
    packed = pack(frame, Capacity.of_tokens(10))
    assert packed.columns == [*frame.columns, "sequence_id_", "offset_"]
    found = packed.collect()
    assert len(found) == 40 and {r["offset"] for r in found} == {9}
    taken = {}
    for r in found:
        for at in range(r["offset_"], r["offset_"] + r["length"]):
            assert taken.setdefault((r["sequence_id_"], at), r["doc_id"]) == r["doc_id"]
    assert pack(frame.limit(0), Capacity.of_tokens(10)).collect() == []
