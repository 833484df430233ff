"""Decontamination, line quality and language identification."""

import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from blotter.llm import byte_language, decontaminate, line_quality
from blotter.llm.byte_language import fold, keep_known_languages, predict_languages
from blotter.llm.decontaminate import Searcher, drop_contaminated, find_contamination, hit_words
from blotter.llm.line_quality import LineField, keep_good, line_features, score_quality
from blotter.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ALPHABET = [b"a", b"b", b"the"]


def word_lists(low, high):
    return st.lists(st.sampled_from(ALPHABET), min_size=low, max_size=high)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 5).flatmap(lambda m: st.tuples(st.just(m), st.lists(word_lists(m, m), min_size=1))), word_lists(0, 40))
def test_search_finds_every_occurrence(case, words):
    m, tests = case
    searcher = Searcher(m)
    for i, test in enumerate(tests):
        searcher.add(test, 0, i)
    found = {(s, i) for s, items in searcher.hits(words) for i in items}
    assert found == {
        (s, i) for i, t in enumerate(tests) for s in range(len(words) - m + 1) if words[s : s + m] == t
    }


# -------------------------------------------------------- decontamination


def plain_words(text):
    words, word = [], ""
    for c in (text or "") + " ":
        if c.isascii() and not c.isalnum():
            if word:
                words.append(word)
            word = ""
        else:
            word += c.lower() if c.isascii() else c
    return words


def brute_contamination(docs, items):
    tests = []
    for item, text in items:
        words = plain_words(text)
        m = min(10, len(words))
        tests += [(item, words[s : s + m]) for s in range(len(words) - m + 1) if m]
    for doc_id, text in docs:
        words, hit, named = plain_words(text), set(), set()
        for item, test in tests:
            for s in range(len(words) - len(test) + 1):
                if words[s : s + len(test)] == test:
                    hit.update(range(s, s + len(test)))
                    if item is not None:
                        named.add(str(item))
        yield doc_id, len(words), len(hit), sorted(named)


@pytest.mark.parametrize("shard_bytes", [1 << 20, 200])
def test_contamination_matches_brute_force(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 12)
    rng = random.Random(2)
    vocabulary = ["the", "of", "Ä", "x1", "日本", *(f"w{i}" for i in range(30))]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([3, 10, 11, 40])))) for i in range(25)]
    items += [(25, None), (26, " .,! "), (27, "w1"), (None, "w2 w3"), (3, "w4 w5"), (10, items[9][1])]
    docs = [(i, " ".join(rng.choices(vocabulary, k=50))) for i in range(30)]
    for i in range(30, 60):
        item = rng.choice(items)[1] or ""
        docs.append((i, f"Foo, {item.upper()}-bar {item}\n{item[5:]}"))
    docs += [(60, None), (61, ""), (62, "..."), (63, "w1"), (63, "w1"), (None, "w2, w3"), (64, "w1 " * 30_000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_words", F.lit("mine"))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit(0))
    found = find_contamination(frame, bench, shard_bytes=shard_bytes)
    assert found.columns == ["doc_id", "text", "n_words", "n_words_", "hit_spans", "hit_items"]
    rows = found.select("doc_id", "n_words_", hit_words("hit_spans"), "hit_items").collect()
    # The long document is checked by its rule: every word is an item of its own.
    expected = list(brute_contamination([d for d in docs if d[0] != 64], items))
    expected.append((64, 30_000, 30_000, ["27"]))
    assert sorted(map(str, (tuple(r) for r in rows))) == sorted(map(str, expected))
    kept = drop_contaminated(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(str(r[0]) for r in kept.collect()) == sorted(str(e[0]) for e in expected if not e[2])


def test_contamination_of_and_by_nothing(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert find_contamination(docs.limit(0), bench).collect() == []
    assert find_contamination(docs, bench.limit(0)).first()["hit_items"] == []


# ------------------------------------------------------------------ quality


def slow_chances(odds, move):
    """P(bad) per line by summing over all labellings."""
    n = len(odds)
    total, bad = 0.0, np.zeros(n)
    for labels in range(1 << n):
        y = [labels >> i & 1 for i in range(n)]
        weight = np.exp(sum(odds[i] * y[i] for i in range(n)) + sum(move[a, b] for a, b in zip(y, y[1:], strict=False)))
        total += weight
        bad += weight * np.array(y)
    return bad / total


def test_marginals_match_enumeration():
    rng = np.random.default_rng(0)
    field = LineField()
    field.move = rng.normal(size=(2, 2))
    numbers = np.array([3, 1, 6, 2])
    odds = rng.normal(size=numbers.sum()) * 2
    chance, moves = field.chances(odds, numbers)
    at = 0
    for n in numbers:
        assert np.allclose(chance[at : at + n], slow_chances(odds[at : at + n], field.move))
        at += n
    assert np.isclose(moves.sum(), (numbers - 1).sum())


def test_features_do_not_depend_on_company():
    texts = [b"", b"One line.", b"A | B\nA | B\n\nC!!", "é ünï 12".encode(), b"x" * 3000]
    together, size, numbers = line_features(texts)
    alone = [line_features([t]) for t in texts]
    assert np.allclose(together, np.concatenate([a[0] for a in alone]))
    assert size.tolist() == [s for a in alone for s in a[1].tolist()]
    assert numbers.tolist() == [1, 1, 4, 1, 1]


def labelled(spark):
    good = [(i, f"This is a plain text with number {i}.\nIt has some quiet lines.", 1) for i in range(60)]
    bad = [(100 + i, f"BUY!! NOW!! {i}!! | | |\n$$$ ### BUY!! NOW!!", 0) for i in range(60)]
    return spark.createDataFrame(good + bad, "doc_id long, text string, quality int")


def test_quality_of_clear_and_odd_texts(spark):
    rows = labelled(spark)
    odd = [(900, None), (901, ""), (902, "\n\n\n"), (903, "plain " * 50_000), (903, "x\n" * 3000), (None, "Quiet line.")]
    docs = rows.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))
    docs = docs.withColumn("predicted", F.lit("mine"))
    labels = rows.where("doc_id % 5 <> 0").select("doc_id", "quality", F.lit(0).alias("good"))
    labels = labels.unionByName(labels.limit(1)).union(
        spark.createDataFrame([(100, 1, 0), (100, 0, 0), (None, 1, 0), (101, None, 0)], "d long, q int, g int")
    )
    found = score_quality(docs, labels)
    assert found.columns == ["doc_id", "text", "predicted", "quality_score", "predicted_"]
    result = found.collect()
    assert len(result) == docs.count() and all(0 <= r["quality_score"] <= 1 for r in result)
    assert all(r["predicted_"] == (r["doc_id"] < 100) for r in result if r["doc_id"] is not None and r["doc_id"] < 900)
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns
    empty = score_quality(docs.limit(0), labels)
    assert empty.collect() == []
    blank = score_quality(docs, labels.where("quality = 1")).select("quality_score").distinct().collect()
    assert [r[0] for r in blank] == [0.5]


def test_registered_quality_on_held_out_rows(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = QUERIES["op6_line_quality"](spark, "/root/testdata/sf0.01")
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95


def plain_line(line, seen):
    """The features of one line, counted byte by byte."""
    upper = sum(0x41 <= b <= 0x5A for b in line)
    digit = sum(0x30 <= b <= 0x39 for b in line)
    symbols, points = b"#$%&*+/<=>@[\\]^_`{}~", b"\"'(),-.:;?"
    kinds = [
        upper, digit, line.count(b" ") + line.count(b"\t"), line.count(b"|"), line.count(b"!"),
        sum(b in symbols for b in line), sum(b in points for b in line), sum(b >= 0x80 for b in line),
    ]
    words = line.split()
    few = 1 - min(1.0, len(set(words)) / max(len(words), 1) ** 0.9)
    shares = [math.sqrt(k / max(len(line), 1)) for k in kinds]
    return [1.0, math.log(1 + len(line)) / 5, *shares, few, float(len(line) < 20), float(line in seen)]


def plain_quality(field, text):
    """The score of one text: log-space passes over one line after the other."""
    lines = (text or "").encode().split(b"\n")
    rows = [plain_line(line, lines[:i]) for i, line in enumerate(lines)]
    nothing = [0.0] * len(rows[0])
    odds = []
    for i, row in enumerate(rows):
        wide = row + (rows[i - 1] if i else nothing) + (rows[i + 1] if i + 1 < len(rows) else nothing)
        raw = sum((x - m) / s * w for x, m, s, w in zip(wide, field.mean, field.spread, field.emit, strict=True))
        odds.append([0.0, min(30.0, max(-30.0, raw))])
    n = len(odds)
    ahead, behind = [odds[0]], [[0.0, 0.0]]
    for i in range(1, n):
        ahead.append([odds[i][y] + np.logaddexp(*(ahead[-1][x] + field.move[x, y] for x in (0, 1))) for y in (0, 1)])
    for i in range(n - 1, 0, -1):
        behind.append([np.logaddexp(*(field.move[x, y] + odds[i][y] + behind[-1][y] for y in (0, 1))) for x in (0, 1)])
    behind.reverse()
    both = [(f[0] + b[0], f[1] + b[1]) for f, b in zip(ahead, behind, strict=True)]
    bad = [1 / (1 + math.exp(min(700.0, good - worse))) for good, worse in both]
    weight = [len(line) + 1 for line in lines]
    goodness = 1 - sum(b * w for b, w in zip(bad, weight, strict=True)) / sum(weight)
    goodness = min(1 - 1e-3, max(1e-3, goodness))
    return 1 / (1 + math.exp(-(field.slope * math.log(goodness / (1 - goodness)) + field.level)))


def kept_result(monkeypatch, module):
    """The models that the module's ``train`` gives from now on."""
    learnt, train = [], module.train
    monkeypatch.setattr(module, "train", lambda *a: learnt.append(train(*a)) or learnt[-1])
    return learnt


def test_registered_quality_equals_one_line_after_the_other(spark, monkeypatch):
    learnt = kept_result(monkeypatch, line_quality)
    rows = QUERIES["op6_line_quality"](spark, SF).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    wanted = {i: plain_quality(learnt[0], text) for i, text in docs.items()}
    assert max(abs(r["score"] - wanted[r["doc_id"]]) for r in rows) < 1e-9
    assert all(r["predicted"] == (wanted[r["doc_id"]] >= 0.3) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_odd_texts_equal_one_line_after_the_other(spark, monkeypatch):
    learnt = kept_result(monkeypatch, line_quality)
    rows = labelled(spark)
    texts = [None, "", "\n", "a\n\na\n", "Ünï | 12!!\t$ (x)\n" * 40, "word " * 9_000, "| |\nplain words here\n| |"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["quality_score"] for r in score_quality(rows.select("doc_id", "text").union(
        docs.select(F.col("doc_id") - 100, "text")), rows.select("doc_id", "quality")).collect()}
    for i, text in enumerate(texts):
        assert abs(found[i - 100] - plain_quality(learnt[0], text)) < 1e-9


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(line_quality, "PER_LABEL", 10)
    rows = labelled(spark)
    sample = line_quality.training_sample(
        rows.select("doc_id", F.col("text").cast("binary").alias("body")), rows.select("doc_id", "quality")
    )
    found = [r["good"] for r in sample.collect()]
    assert all(2 <= found.count(label) <= 25 for label in (0, 1))


# ----------------------------------------------------------------- language


def spoken(spark, n=60):
    lines = {"en": "the quick brown fox and the lazy dog", "de": "über die straße läuft der schöne hund", "fr": "où est le café près du château français"}
    rows = [
        (k * 1000 + i, " ".join(np.random.default_rng(i).permutation(text.split())) * 3, lang)
        for k, (lang, text) in enumerate(lines.items())
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_windows_cover_the_whole_text():
    widest = max(byte_language.WIDTHS)
    for n in (1, 3, 255, 256, 257, 508, 509, 510, 5000):
        text = np.random.default_rng(n).integers(1, 256, n).astype(np.uint8).tobytes()
        found, sizes = byte_language.windows(text)
        grams = {bytes(row[i : i + widest]) for row in found for i in range(len(row) - widest + 1)}
        assert all(text[i : i + widest] in grams for i in range(n - widest + 1))
        assert sizes.min() >= 1 and len(found) == len(sizes)


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    network = byte_language.ByteNetwork(["a", "b", "c"])
    batch = rng.integers(0, 256, (4, byte_language.WINDOW)).astype(np.uint8)
    label, weight = np.array([0, 2, 1, 0]), np.array([1.0, 2.0, 1.0, 0.5])

    def loss():
        chances = byte_language.softmax(network._forward(batch)[-1].astype(np.float64))
        return -(np.log(chances[np.arange(4), label]) * weight).sum() / weight.sum()

    gradients = network._gradients(batch, label, weight)
    values = [network.embed, *network.filters, network.shift, network.dense, network.bias]
    for value, gradient in zip(values, gradients, strict=True):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        old, step = value[at], 1e-2
        value[at] = old + step
        high = loss()
        value[at] = old - step
        low = loss()
        value[at] = old
        assert np.isclose((high - low) / (2 * step), gradient[at], rtol=0.1, atol=1e-3)


def test_tables_equal_the_network():
    network = byte_language.ByteNetwork(["a", "b"])
    batch = np.random.default_rng(1).integers(0, 256, (70, byte_language.WINDOW)).astype(np.uint8)
    assert np.allclose(network.tables().scores(batch), network._forward(batch)[-1], atol=1e-4)


def test_languages_of_clear_and_odd_texts(spark):
    docs = spoken(spark)
    odd = [(9000, None, "en"), (9001, "", "en"), (9002, "12 + 34 !", "de"), (9003, "the dog " * 40_000, None), (9003, "ü", None)]
    docs = docs.union(spark.createDataFrame(odd, docs.schema)).withColumn("lang_pred", F.lit("mine"))
    found = predict_languages(docs, F.col("doc_id") % 4 != 2)
    assert found.columns == ["doc_id", "text", "lang", "lang_pred", "lang_pred_", "lang_score"]
    rows = found.collect()
    assert len(rows) == docs.count() and all(0 <= r["lang_score"] <= 1 for r in rows)
    assert all(r["lang_pred_"] == r["lang"] for r in rows if r["doc_id"] < 9000)
    named = {r["doc_id"]: r["lang_pred_"] for r in rows}
    assert [named[i] for i in (9000, 9001, 9002)] == ["und"] * 3 and named[9003] != "und"
    kept = keep_known_languages(docs)
    assert kept.columns == docs.columns
    assert not {9000, 9001, 9002} & {r["doc_id"] for r in kept.collect()}


@pytest.mark.parametrize("few", [True, False])
def test_gibberish_goes_and_clean_documents_stay(spark, few):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.where("lang IN ('en', 'de')") if few else docs
    rng, rows = random.Random(3), []
    for i in range(40):
        dumps = ["".join(rng.choices("0123456789abcdef", k=600))]
        dumps += ["".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=600))]
        dumps += [" ".join("".join(rng.choices("абвгдежзиклмнопрст", k=rng.randint(2, 9))) for _ in range(80))]
        rows += [(-1 - 3 * i - k, dump, None) for k, dump in enumerate(dumps)]
    kept = keep_known_languages(docs.union(spark.createDataFrame(rows, docs.schema))).collect()
    assert not [r["doc_id"] for r in kept if r["doc_id"] < 0]
    clean = [r["doc_id"] for r in docs.collect() if any(map(str.isalpha, r["text"] or ""))]
    assert len(clean) > 90 and len([r for r in kept if r["doc_id"] >= 0]) >= 0.99 * len(clean)


def test_nothing_to_learn_from(spark):
    docs = spoken(spark, 2)
    found = predict_languages(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True)).collect()
    assert {(r["lang_pred"], r["lang_score"]) for r in found} == {("und", 0.0)}
    assert predict_languages(docs.limit(0), F.lit(True)).collect() == []


def many_spoken(spark, languages, n):
    """Invented languages of nine letters each; the later ones have fewer documents."""
    rows = []
    for k in range(languages):
        rng = np.random.default_rng(1000 + k)
        letters = rng.permutation(list("abcdefghijklmnopqrstuvwxyz"))[:9]
        words = ["".join(rng.choice(letters, rng.integers(2, 8))) for _ in range(40)]
        rows += [(len(rows) + i, " ".join(rng.choice(words, 60)), f"l-{k}") for i in range(n + (k < 64))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_every_language_is_learnt(spark):
    docs = many_spoken(spark, 80, 12)
    rows = predict_languages(docs, F.col("doc_id") % 4 != 2).where("doc_id % 4 = 2").collect()
    assert {r["lang"] for r in rows} == {f"l-{k}" for k in range(80)}
    wrong = [r for r in rows if r["lang_pred"] != r["lang"]]
    assert len(wrong) <= 0.02 * len(rows)


def test_sample_is_shared_over_the_languages(spark, monkeypatch):
    monkeypatch.setattr(byte_language, "SAMPLE_ROWS", 100)
    monkeypatch.setattr(byte_language, "LEAST_ROWS", 3)
    docs = many_spoken(spark, 20, 40).selectExpr("doc_id", "CAST(text AS BINARY) AS body", "lang")
    once = docs.where("lang <> 'l-0'").union(docs.where("lang = 'l-0'").limit(1))
    repeated = once.crossJoin(spark.range(3)).drop("id")
    sample = byte_language.training_windows(repeated).collect()
    assert {r["lang"] for r in sample} == {f"l-{k}" for k in range(20)}
    # About five texts of two windows each for a language, and repeated rows teach once.
    assert len({(r["lang"], bytes(r["window"])) for r in sample}) == len(sample) < 2 * 100 * 2


def test_registered_language_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op7_language_id"](spark, sf)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    lang = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = found.join(lang, "doc_id").where("held_out").collect()
    assert len(rows) > 150
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.97


def plain_language(network, text):
    """Language and score of one text: windows and filters moved on byte by byte."""
    raw = text.encode()
    step = byte_language.WINDOW - max(byte_language.WIDTHS) + 1
    total, start = 0.0, 0
    while True:
        part = raw[start : start + byte_language.WINDOW]
        vectors = network.embed[list(part.ljust(byte_language.WINDOW, b"\0"))].astype(float)
        peaks = []
        for width, weights in zip(byte_language.WIDTHS, network.filters, strict=True):
            grams = [vectors[i : i + width].ravel() for i in range(byte_language.WINDOW - width + 1)]
            peaks += (np.array(grams) @ weights.astype(float)).max(0).tolist()
        total = total + np.maximum(np.array(peaks) + network.shift, 0) * len(part)
        if start + byte_language.WINDOW >= len(raw):
            break
        start += step
    # Windows overlap, so their bytes are counted as often as they occur.
    sizes = sum(len(raw[s : s + byte_language.WINDOW]) for s in range(0, start + 1, step))
    height = total / sizes @ network.dense.astype(float) + network.bias
    chances = np.exp(height - height.max())
    chances /= chances.sum()
    return network.languages[int(chances.argmax())], float(chances.max())


def test_registered_language_equals_one_byte_after_the_other(spark, monkeypatch):
    learnt = kept_result(monkeypatch, byte_language)
    rows = QUERIES["op7_language_id"](spark, SF).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        text = docs[r["doc_id"]] or ""
        if not any(map(str.isalpha, text)):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        language, score = plain_language(learnt[0], text)
        assert (r["lang_pred"], r["score"]) == (language, pytest.approx(score, abs=1e-4))
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_odd_texts_equal_one_byte_after_the_other(spark, monkeypatch):
    learnt = kept_result(monkeypatch, byte_language)
    texts = ["a", "Ü", "the dog " * 3_000, *("x y" * n for n in (84, 85, 86, 170, 171))]
    odd = spark.createDataFrame([(9000 + i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    found = predict_languages(spoken(spark).union(odd), F.col("doc_id") < 9000).where("doc_id >= 9000").collect()
    assert len(found) == len(texts)
    for r in found:
        language, score = plain_language(learnt[0], r["text"])
        assert (r["lang_pred"], r["lang_score"]) == (language, pytest.approx(score, abs=1e-4))


def test_folds_follow_crc32(spark):
    rows = spark.range(50).select("id", fold(F.col("id"), 5).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in rows)


def test_fifty_shards_match_brute_force_without_stacked_passes(spark):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(25)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([3, 10, 14])))) for i in range(120)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([0, 4, 60]))) for _ in range(60)]
    texts += [f"a b {items[i][1]} c {items[i + 1][1]}" for i in range(0, 100, 7)]
    rows = [(i % 70, t) for i, t in enumerate([*texts, None, "", texts[3], texts[60], texts[60]])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    frame = frame.withColumns({"digest": F.lit(1), "spans": F.lit("x"), "items": F.lit(2)})
    bench = spark.createDataFrame(items, "item_id long, text string")
    total = sum(len(t) + 24 for _, t in items)
    found = find_contamination(frame, bench, shard_bytes=-(-total // 50))
    assert found.columns == [*frame.columns, "n_words", "hit_spans", "hit_items"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") <= 2
    got = found.select("doc_id", "n_words", decontaminate.hit_words("hit_spans").alias("n"), "hit_items").collect()
    expected = [(i, n, hit, named) for i, n, hit, named in brute_contamination(rows, items)]
    assert sorted(map(tuple, got)) == sorted(expected)
