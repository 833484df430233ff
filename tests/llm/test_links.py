"""Embedding links and SimHash groups against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from blotter.llm import embedding_links, simhash_links
from blotter.llm.components import connected_components

SF = "/root/testdata/sf0.001"


def closure(nodes, links):
    """Smallest reachable node by node."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# ------------------------------------------------------------ components


def test_components_of_paths_stars_and_repeats(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    edges = [*path, *star, (5, 5), (7, 6), (None, 3), (160, 161), (161, 160)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r["node"]: r["component"] for r in connected_components(frame).collect()}
    assert found == closure([*range(41), *range(100, 162)], [e for e in edges if None not in e])
    assert connected_components(frame.limit(0)).collect() == []


# ------------------------------------------------------------ embeddings

VECTORS = "vec_id long, embedding array<float>, label int"


def brute_links(rows, bound):
    good = [
        (i, np.array(v, float), label)
        for i, v, label in rows
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links = [
        (i, j)
        for k, (i, v, a) in enumerate(good)
        for j, w, b in good[k + 1 :]
        if a == b and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= bound
    ]
    count = {i: 0 for i, _, _ in rows}
    for i, j in links:
        count[i] += 1
        count[j] += 1
    return count, closure([i for i, _, _ in rows], links)


def check_links(spark, rows, **options):
    frame = spark.createDataFrame(rows, VECTORS).repartition(3)
    found = {r["vec_id"]: r for r in embedding_links.link_vectors(frame, **options).collect()}
    count, least = brute_links(rows, options.get("cosine", embedding_links.COSINE))
    assert {i: (r["n_links"], r["component_id"], r["kept"]) for i, r in found.items()} == {
        i: (count[i], least[i], least[i] == i) for i in count
    }


def near(rng, base, spread):
    v = base + spread * rng.standard_normal(len(base)) / np.sqrt(len(base)) * np.linalg.norm(base)
    return [float(np.float32(x)) for x in v]


def test_links_of_clusters_copies_and_chains(spark, monkeypatch):
    monkeypatch.setattr(embedding_links, "CELL_ROWS", 16)  # crowded cells fall into pieces
    rng = np.random.default_rng(1)
    rows, at = [], 0
    for label in (0, 1):
        for _ in range(6):
            base = rng.standard_normal(24)
            for _ in range(rng.integers(1, 30)):
                rows.append((at, near(rng, base, 0.15), label))
                at += 1
    rows += [(1000 + i, rows[3][1], rows[3][2]) for i in range(40)]
    random.Random(0).shuffle(rows)
    check_links(spark, rows)


def test_links_of_odd_vectors(spark):
    v = [0.5, 0.25, -1.0]
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, v, 1), (2, [2 * x for x in v], 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [], 1),
        (7, [0.0, 0.0, 0.0], 1), (8, [nan, 1.0, 1.0], 1), (9, [inf, 1.0, 1.0], 1), (10, [None, 1.0, 1.0], 1),
        (11, [0.5, 0.25], 1), (12, [0.5, 0.25], 1), (13, [0.0, 0.0, 0.0], 1), (14, [-x for x in v], 1),
    ]
    check_links(spark, rows)


def test_links_of_repeated_rows_extra_columns_and_nothing(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.0, 1.0], 1)]
    frame = spark.createDataFrame(rows, VECTORS).withColumns({"node": F.lit(1), "n_links": F.lit("x")})
    found = sorted(tuple(r) for r in embedding_links.link_vectors(frame).collect())
    assert found == [(1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)]
    assert embedding_links.link_vectors(frame.limit(0)).collect() == []


def test_recall_on_pairs_at_the_bound(spark):
    """Pairs of cosine just above the bound, the worst case of the windows."""
    rng = np.random.default_rng(5)
    rows, bound = [], 0.98
    for i in range(400):
        u = rng.standard_normal(64)
        u /= np.linalg.norm(u)
        w = rng.standard_normal(64)
        w -= (w @ u) * u
        w /= np.linalg.norm(w)
        cos = bound + 1e-4
        rows += [(2 * i, u.tolist(), 0), (2 * i + 1, (cos * u + np.sqrt(1 - cos**2) * w).tolist(), 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    linked = embedding_links.link_vectors(frame).where("n_links > 0").count()
    assert linked >= 0.97 * len(rows)


def test_candidates_per_row_stay_level_as_a_label_grows(spark, monkeypatch):
    """Random vectors link with nothing: what is counted is the work of the candidate search."""
    monkeypatch.setattr(embedding_links, "CELL_ROWS", 256)
    rng = np.random.default_rng(9)
    vectors = rng.standard_normal((20_000, 16)).astype("f4").tolist()
    per_row = []
    for n in (5_000, 20_000):
        rows = [("0", i, 1, v) for i, v in enumerate(vectors[:n])]
        classes = spark.createDataFrame(rows, "label string, node long, copies long, embedding array<float>")
        found = embedding_links._neighbours(classes, 0.98, 0.9999)
        pairs = found.where("a is null and b is null").agg(F.sum("n")).first()[0]
        per_row.append(pairs / n)
    assert 0 < per_row[1] < 2 * per_row[0]


def test_met_pairs_are_all_that_collide_on_every_lead():
    rng = np.random.default_rng(3)
    lead, half = rng.standard_normal((300, 4)), 0.4
    homes, queries = np.arange(200), np.arange(100, 300)
    found = [
        (int(q), int(h))
        for a, b in embedding_links.met_pairs(lead, homes, queries, half)
        for q, h in zip(a, b, strict=True)
    ]
    wanted = {(q, h) for q in queries for h in homes if (np.abs(lead[q] - lead[h]) <= half).all()}
    assert len(found) == len(set(found))
    assert set(found) == wanted
    assert list(embedding_links.met_pairs(lead, homes[:0], queries, half)) == []


def test_projections_do_not_depend_on_the_batch():
    unit = embedding_links.scaled(np.random.default_rng(4).standard_normal((50, 768)))
    whole = embedding_links.projected(unit, 12, 1)
    parts = [embedding_links.projected(unit[i : i + 1], 5, 1) for i in range(50)]
    assert (whole[:, :5] == np.concatenate(parts)).all()


def test_needed_collisions_is_calibrated():
    loose = embedding_links.needed_collisions(16, 0.9999)
    assert loose <= embedding_links.needed_collisions(16, 0.9) <= 16
    assert loose >= 8


# --------------------------------------------------------------- simhash

DOCS = "doc_id long, text string"
BLANKS = "\t\n\x0b\x0c\r "


def slow_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in BLANKS:
        low = low.replace(blank, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def check_groups(spark, rows, schema=DOCS):
    frame = spark.createDataFrame(rows, schema).repartition(3)
    found = sorted(tuple(r) for r in simhash_links.simhash_groups(frame).collect())
    fps = [slow_fingerprint(r[1]) for r in rows]
    links = [
        (i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3
    ]
    heads = closure(range(len(rows)), links)
    least: dict = {}
    for i, h in heads.items():
        least[h] = min(least.get(h, rows[i][0]), rows[i][0])
    expected = sorted((rows[i][0], f"{fps[i]:016x}", least[heads[i]]) for i in range(len(rows)))
    assert found == expected


def some_docs(seed, n):
    rng = random.Random(seed)
    words = ["the", "of", "Añb", "ẞx", "日本", "x" * 40, *(f"w{i}" for i in range(300))]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.4:
            old = rng.choice(rows)[1].split(" ")
            old[rng.randrange(len(old))] = rng.choice(words)
            rows.append((i, " ".join(old)))
        else:
            rows.append((i, " ".join(rng.choices(words, k=rng.choice([1, 2, 3, 5, 80, 400])))))
    return rows


def test_groups_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash_links, "BUCKET_ROWS", 8)  # buckets are split again and again
    odd = [(900, None), (901, ""), (902, " \t\n"), (903, "A\x1cb"), (904, "a\x1cB"), (905, "ok"), (906, "OK ")]
    docs = some_docs(3, 150)
    check_groups(spark, [*docs, *odd, docs[0], (907, "long " * 200_000)])


def test_groups_of_nothing_and_extra_columns(spark):
    frame = spark.createDataFrame([(1, "a b c", "x")], "doc_id long, text string, fp string")
    assert [r["component_id"] for r in simhash_links.simhash_groups(frame).collect()] == [1]
    assert simhash_links.simhash_groups(frame.limit(0)).collect() == []


def test_large_and_small_links_with_every_allocation(spark):
    """Fingerprints with planted distances are found whatever thresholds the programme chooses."""
    rng = random.Random(4)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for f in list(fps):
        flips = rng.sample(range(64), rng.randint(1, 5))
        fps.append(f ^ sum(1 << b for b in flips))
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in sorted(set(fps))]
    frame = spark.createDataFrame(signed, "fp long")
    for partitions in (3, 4):
        edges = simhash_links.link_fingerprints(frame, 3, partitions).collect()
        links = [(a & (1 << 64) - 1, b & (1 << 64) - 1) for a, b in edges]
        assert all((a ^ b).bit_count() <= 3 for a, b in links)
        every = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3]
        assert closure(set(fps), links) == closure(set(fps), every)


def test_allocation_has_the_needed_sum_and_least_cost():
    counts = np.array([[10.0, 90], [500, 4000], [20, 30], [15, 100]])
    chosen = simhash_links.allocate(counts, 3)
    assert sum(chosen) == 0 and min(chosen) >= -1
    assert chosen == [0, -1, 1, 0]


def test_one_per_group_keeps_columns_and_rows_without_id(spark):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(3, text, "a"), (2, text, "b"), (2, text, "b"), (9, "other words here", "c"), (None, text, "d")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, head string")
    kept = simhash_links.keep_one_per_group(frame)
    assert kept.columns == frame.columns
    assert sorted((r[0] or -1, r[2]) for r in kept.collect()) == [(-1, "d"), (2, "b"), (9, "c")]


def test_one_per_group_of_a_repeated_id_with_two_texts(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(200)) for x in "ab")
    rows = [(3, a, 1), (5, b, 2), (5, a, 3), (7, "", 4), (8, None, 5), (7, "", 6), (None, b, 7)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, mark long")
    kept = simhash_links.keep_one_per_group(frame).collect()
    texts = sorted((r[0] or -1, r[1]) for r in kept)
    assert texts == [(-1, b), (3, a), (5, b), (7, "")]
    assert simhash_links.keep_one_per_group(frame.limit(0)).collect() == []


def dealt_work(spark, fps):
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    frame = spark.createDataFrame(signed, "fp long").repartition(8)
    dealt, _ = simhash_links.deal_buckets(frame, 3)
    sizes = [r["count"] for r in dealt.groupBy("bucket").count().collect()]
    assert max(sizes) <= simhash_links.BUCKET_ROWS
    return frame, sum(sizes) / len(fps), sum(n * (n - 1) // 2 for n in sizes) / len(fps)


def reached(fps):
    """Smallest fingerprint of the component of every fingerprint, breadth first."""
    left, root = np.array(sorted(fps), np.uint64), {}
    while len(left):
        head, todo, left = int(left[0]), [left[0]], left[1:]
        while todo:
            at = todo.pop()
            root[int(at)] = head
            close = np.bitwise_count(left ^ at) <= 3
            todo += list(left[close])
            left = left[~close]
    return root


def test_work_on_one_group_of_near_copies_grows_in_proportion(spark, monkeypatch):
    """20,000 distinct fingerprints around one centre, beside as many that are alone."""
    monkeypatch.setattr(simhash_links, "BUCKET_ROWS", 1024)
    rng = random.Random(7)
    centre, made = rng.getrandbits(64), {}
    for n in (5_000, 20_000):
        near = set()
        while len(near) < n:
            near.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 4]))))
        made[n] = sorted(near) + [rng.getrandbits(64) for _ in range(n)]
    _, few_rows, few_pairs = dealt_work(spark, made[5_000])
    frame, rows, pairs = dealt_work(spark, made[20_000])
    # Few differing bits split little, but few fingerprints have them: rows stay bounded. The links
    # of a fingerprint grow fourfold here, the pairs compared less.
    assert few_rows < rows <= 16 and pairs <= 2.5 * few_pairs
    edges = simhash_links.link_fingerprints(frame).collect()
    links = [(a & (1 << 64) - 1, b & (1 << 64) - 1) for a, b in edges]
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    assert closure(made[20_000], links) == reached(made[20_000])


@pytest.mark.parametrize("name", ["op5_simhash_groups"])
def test_registered_groups_match_brute_force(spark, name):
    from blotter.llm.queries import QUERIES

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES[name](spark, SF).collect()}
    fps = {i: slow_fingerprint(t) for i, t in rows}
    links = [(i, j) for i in fps for j in fps if i < j and (fps[i] ^ fps[j]).bit_count() <= 3]
    least = closure(fps, links)
    assert found == {i: (f"{fps[i]:016x}", least[i]) for i in fps}
