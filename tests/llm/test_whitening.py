"""Embedding whitening against exact sums and a dense eigensolver."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.llm import whitening
from blotter.llm.queries import QUERIES
from blotter.llm.rank_one import Spectrum, rank_one_update, secular_roots

SF = "/root/testdata/sf0.001"


def scatter(rows):
    apart = rows - rows.mean(0)
    return apart.T @ apart


@pytest.mark.parametrize("kind", ["random", "equal", "one direction", "repeated", "huge and tiny"])
def test_spectrum_of_rows_and_of_parts(kind):
    rng = np.random.default_rng(3)
    for d, n in ((1, 7), (2, 9), (7, 5), (24, 300)):
        rows = rng.integers(-90, 90, (n, d)).astype(float)
        if kind == "equal":
            rows[:] = rows[0]
        elif kind == "one direction":
            rows = rows[:, :1] * np.arange(1, d + 1)
        elif kind == "repeated":
            rows = np.repeat(rows[: n // 3 + 1], 3, axis=0)[:n]
        elif kind == "huge and tiny":
            rows *= 10.0 ** rng.integers(-6, 6, d)
        parts = [Spectrum(d) for _ in range(4)]
        whole = Spectrum(d)
        for i, row in enumerate(rows):
            whole.add_row(row)
            parts[i % 3].add_row(row)
        joined = Spectrum(d)
        for part in parts:  # the last one is empty
            joined.add(part)
        expected = scatter(rows)
        size = max(np.abs(expected).max(), 1.0)
        for found in (whole, joined):
            assert found.n == n and np.allclose(found.mean, rows.mean(0), rtol=1e-12, atol=1e-9)
            assert (np.diff(found.values) >= 0).all()
            again = found.vectors * found.values @ found.vectors.T
            assert np.abs(again - expected).max() <= 1e-11 * size
            assert np.abs(found.vectors.T @ found.vectors - np.eye(d)).max() <= 1e-11


def test_secular_roots_lie_between_the_poles():
    rng = np.random.default_rng(1)
    for k in (1, 2, 3, 40):
        poles = np.cumsum(10.0 ** rng.uniform(-9, 2, k))
        weights = 10.0 ** rng.uniform(-12, 0, k)
        origin, shift = secular_roots(poles, weights, 2.5)
        roots = poles[origin] + shift
        assert (roots >= poles).all() and (roots[:-1] <= poles[1:]).all()
        expected = np.linalg.eigvalsh(np.diag(poles) + 2.5 * np.outer(np.sqrt(weights), np.sqrt(weights)))
        assert np.allclose(roots, expected, rtol=1e-12, atol=1e-12 * poles[-1])


def test_an_update_that_reaches_nothing():
    values, vectors = np.array([1.0, 2.0]), np.eye(2)
    for vector, weight in ((np.zeros(2), 1.0), (np.ones(2), 0.0)):
        same, basis = rank_one_update(values, vectors, vector, weight)
        assert (same == values).all() and (basis == vectors).all()


def brute(rows, most=16):
    """(vec_id, component) -> (n, deviation, |whitened|, explained), plainly."""
    good = []
    for i, v in rows:
        if v is not None and all(c is not None and np.isfinite(c) for c in v):
            good.append((i, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]))
    fit = sorted({tuple(x) for _, x in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    d = len(sums)
    exact = [[Fraction(x) - Fraction(s, n) for x, s in zip(row, sums, strict=True)] for row in fit]
    centred = np.array([[float(c) for c in row] for row in exact])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for i, x in good:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        apart = np.array([float(Fraction(a) - Fraction(s, n)) for a, s in zip(x, sums, strict=True)])
        for c in range(min(most, d)):
            if values[c] > 1e-12 * values[0]:
                white = apart @ vectors[:, c] / np.sqrt(values[c])
                out[i, c + 1] = (n, deviation, white, values[c] / values.sum())
    return out


def check(found, rows):
    expected = brute(rows)
    assert {(r["vec_id"], r["component"]) for r in found} == set(expected)
    assert len(found) == len(expected)
    signs: dict = {}
    for r in found:
        n, deviation, white, explained = expected[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, deviation)
        if abs(white) > 1e-3:
            signs.setdefault(r["component"], set()).add(np.sign(white) == np.sign(r["whitened"]))
        assert abs(abs(r["whitened"]) - abs(white)) <= 1e-8
        assert abs(r["explained"] - explained) <= 1e-10
        assert r["identity_error"] <= 1e-10
    assert all(len(s) == 1 for s in signs.values())


def test_registered_query_matches_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(QUERIES["op11_embedding_whitening"](spark, SF).collect(), rows)


def some_vectors(n, d, seed=2):
    rng = np.random.default_rng(seed)
    spread = np.linspace(3, 0.5, d)
    return [(i, (spread * rng.standard_normal(d)).tolist()) for i in range(n)]


def test_odd_vectors_repeats_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)  # several rounds of combining
    rows = some_vectors(150, 5)
    rows += [(200 + i, rows[3][1]) for i in range(70)]  # a group of copies
    odd = [
        (300, None), (301, [None, 1.0, 1.0, 1.0, 1.0]), (302, [float("nan")] * 5),
        (303, [float("inf"), 0.0, 0.0, 0.0, 0.0]),
    ]
    other = [(304, []), (305, [1.0, 2.0]), (306, [1e300] * 5)]  # no five numbers that become whole ones
    frame = spark.createDataFrame(rows + odd + other, "vec_id long, embedding array<double>").repartition(9)
    frame = frame.withColumns({"x": F.lit(1), "component": F.lit("a"), "v": F.lit(2.0)})
    check(whitening.whiten(frame).collect(), rows + odd)


def test_nothing_one_vector_and_too_few_directions(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []
    flat = [(i, [float(i), 2.0 * i, 0.0]) for i in range(12)]
    found = whitening.whiten(spark.createDataFrame(flat, schema)).collect()
    assert {r["component"] for r in found} == {1} and len(found) == 12
    assert all(abs(r["explained"] - 1) < 1e-12 for r in found)


def test_deviations_beyond_64_bits():
    x = np.array([[5, 1], [1 << 40, 3]], np.int64)
    sums = [int(x[:, 0].sum()), 4]
    exact = [sum((2 * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    assert whitening.deviations(x, 2, sums) == [e if e < 1 << 63 else None for e in exact]
    assert whitening.deviations(x[:1], 1, [5, 1]) == [0]
