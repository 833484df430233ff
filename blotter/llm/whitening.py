"""Whitening of embeddings by an incremental eigendecomposition.

Vectors become whole numbers; the fit list holds each distinct one once. Every partition of the fit
list keeps the spectrum of its own scatter matrix by centred rank-one updates (``rank_one``); spectra
are combined in a tree, each into another by successive rank-one updates. The basis they give is
refined by one Rayleigh-Ritz step: covariances of all rows in that basis are summed over the tasks,
and the eigenvectors of this small matrix turn the basis. A second pass measures the whitened
covariance of the final components.

Sums, counts and deviations are exact. What reaches the driver are d x d numbers, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import discard, only, stored
from blotter.llm.rank_one import Spectrum

COMPONENTS = 16
SCALE = 64
SHIFT = 1_000_000
# Spectra that one task combines into one.
FAN = 16
# Eigenvalues below this share of the largest are no direction to whiten.
LEAST_SHARE = 1e-12
_BOUND = float(1 << 61)
_SPECTRUM = "node long, n long, mean binary, eigenvalues binary, eigenvectors binary"


# --------------------------------------------------------- whole vectors


def common_length(vectors: DataFrame, vector: str) -> int:
    """The most frequent length of the vectors, the greater of equals; 0 without any."""
    sizes = vectors.select(F.size(f"`{vector}`").alias("long")).where("long > 0")
    found = sizes.groupBy("long").count().orderBy(F.desc("count"), F.desc("long")).first()
    return found["long"] if found else 0


def whole_vectors(vectors: DataFrame, vec_id: str, vector: str, long: int) -> DataFrame:
    """(vec_id, x): the vectors as whole numbers, four bytes each, or eight where one needs them.

    Vectors that are null, of another length or hold entries that are null, not finite or beyond
    2^55 are left out.
    """
    rows = only(vectors, vec_id=vec_id, v=vector)
    rows = rows.where(F.size("v") == long).withColumn("v", F.col("v").cast("array<double>"))

    def run(batches):
        for batch in batches:
            ids, values = batch.columns
            flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null: nan
            grid = SCALE * flat.reshape(len(ids), long)
            good = (np.isfinite(grid) & (np.abs(grid) < _BOUND)).all(1)
            x = np.floor(np.where(good[:, None], grid, 0)).astype(np.int64) + SHIFT
            small = (np.abs(x) < 1 << 31).all(1)
            packed = [
                (row.astype("<i4") if s else row.astype("<i8")).tobytes() if g else None
                for row, s, g in zip(x, small.tolist(), good.tolist(), strict=True)
            ]
            kept = pa.RecordBatch.from_arrays([ids, pa.array(packed, pa.binary())], ["vec_id", "x"])
            yield kept.filter(pa.array(good))

    return rows.mapInArrow(run, f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, x binary")


def unpacked(column: pa.Array, long: int) -> np.ndarray:
    """Packed vectors as a matrix of 64-bit numbers."""
    raw = column.to_pylist()
    if all(len(r) == 4 * long for r in raw):
        return np.frombuffer(b"".join(raw), "<i4").reshape(len(raw), long).astype(np.int64)
    kinds = {4 * long: "<i4", 8 * long: "<i8"}
    return np.array([np.frombuffer(r, kinds[len(r)]) for r in raw], np.int64).reshape(len(raw), long)


# --------------------------------------------------------------- the fit


def _summed(fit: DataFrame, run: Callable, kind: str) -> dict[int, float]:
    """Numbers by place, added up per task by ``run`` and then over the tasks."""
    added = fit.mapInArrow(run, f"at long, n {kind}").groupBy("at").agg(F.sum("n").alias("n"))
    return {r["at"]: r["n"] for r in added.collect()}  # as many as ``run`` has places


def row_sums(fit: DataFrame, long: int) -> tuple[int, list[int]]:
    """Rows and exact sums by dimension."""

    def run(batches):
        low, high, n = np.zeros(long, np.int64), np.zeros(long, np.int64), 0
        for batch in batches:
            x = unpacked(batch.column(0), long)
            n += len(x)
            low += (x & 0xFFFFFFFF).sum(0)
            high += (x >> 32).sum(0)
        sums = np.concatenate([low, high, [n]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums))), pa.array(sums)], ["at", "n"])

    found = _summed(fit, run, "long")
    sums = [found.get(i, 0) + (found.get(long + i, 0) << 32) for i in range(long)]
    return found.get(2 * long, 0), sums


def _centre(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The mean as the nearest whole numbers and what they leave, both without rounding errors
    of large numbers."""
    whole = [(2 * s + n) // (2 * n) for s in sums]
    return np.array(whole, np.int64), np.array([(s - n * w) / n for s, w in zip(sums, whole, strict=True)])


def _packed(node: int, spectrum: Spectrum) -> pa.RecordBatch:
    columns = [[node], [spectrum.n], *[[a.tobytes()] for a in (spectrum.mean, spectrum.values, spectrum.vectors)]]
    kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 3]
    names = [c.split()[0] for c in _SPECTRUM.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _restored(row: dict) -> Spectrum:
    values = np.frombuffer(row["eigenvalues"])
    spectrum = Spectrum(len(values))
    spectrum.n, spectrum.mean, spectrum.values = row["n"], np.frombuffer(row["mean"]), values
    spectrum.vectors = np.frombuffer(row["eigenvectors"]).reshape(len(values), len(values))
    return spectrum


def partition_spectra(fit: DataFrame, long: int, whole: np.ndarray) -> DataFrame:
    """One spectrum per partition that has rows, relative to the whole centre."""

    def run(batches):
        spectrum = Spectrum(long)
        for batch in batches:
            for row in (unpacked(batch.column(0), long) - whole).astype(np.float64):
                spectrum.add_row(row)
        if spectrum.n:
            yield _packed(TaskContext.get().partitionId(), spectrum)

    return fit.mapInArrow(run, _SPECTRUM)


def combine_spectra(spectra: DataFrame) -> Spectrum:
    """All spectra as one, ``FAN`` at a time in each of as many rounds as their logarithm."""

    def together(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["node"])
        first = _restored(rows[0])
        for row in rows[1:]:
            first.add(_restored(row))
        return pa.Table.from_batches([_packed(rows[0]["node"] // FAN, first)])

    most = spectra.agg(F.max("node")).first()[0]
    rounds = spectra
    while most > 0:
        rounds = rounds.groupBy((F.col("node") / FAN).cast("long")).applyInArrow(together, _SPECTRUM)
        most //= FAN
    return _restored(rounds.first().asDict())


def projected_covariance(
    fit: DataFrame, basis: np.ndarray, n: int, whole: np.ndarray, rest: np.ndarray
) -> np.ndarray:
    """Covariance of all rows in the columns of ``basis``, centred before multiplying."""
    long, k = basis.shape

    def run(batches):
        total = np.zeros((k, k))
        for batch in batches:
            y = ((unpacked(batch.column(0), long) - whole) - rest) @ basis
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k)), pa.array(total.ravel())], ["at", "n"])

    found = _summed(fit, run, "double")
    total = np.array([found.get(i, 0.0) for i in range(k * k)]).reshape(k, k)
    return (total + total.T) / (2 * n)


def principal_components(
    fit: DataFrame, long: int, n: int, whole: np.ndarray, rest: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns, the largest entry positive)."""
    spectra = stored(partition_spectra(fit, long, whole), "spectra")
    basis, _ = np.linalg.qr(combine_spectra(spectra).vectors)
    discard(spectra)
    values, turn = np.linalg.eigh(projected_covariance(fit, basis, n, whole, rest))
    vectors = (basis @ turn)[:, ::-1]
    vectors = vectors / np.sqrt((vectors * vectors).sum(0))
    largest = np.abs(vectors).argmax(0)
    return values[::-1], vectors * np.sign(vectors[largest, np.arange(long)])


def whiten(
    vectors: DataFrame,
    components: int = COMPONENTS,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained,
    identity_error.

    Rows are left out whose vector is null or holds entries that are null, not finite or beyond
    2^55, or that has another length than most vectors have. Repeated rows are all answered and
    count once in the fit; a null vec_id is kept. Fewer components are returned where the vectors span
    fewer directions, none if all are equal; an empty table gives an empty result. A deviation beyond
    a long is null. Other columns are ignored, whatever their names.
    """
    spark = vectors.sparkSession
    long = common_length(vectors, vector)
    rows = whole_vectors(vectors, vec_id, vector, long)
    kind = rows.schema["vec_id"].dataType.simpleString()
    answer = (
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double"
    )
    fit = stored(rows.select("x").distinct(), "fit")
    n, sums = row_sums(fit, long) if long else (0, [])
    if not n:
        return spark.createDataFrame([], answer)
    whole, rest = _centre(n, sums)
    values, axes = principal_components(fit, long, n, whole, rest)
    wide = int((values > LEAST_SHARE * max(values[0], 0.0)).sum())
    k = min(components, wide if values[0] > 0 else 0)
    if not k:
        return spark.createDataFrame([], answer)
    scaled = axes[:, :k] / np.sqrt(values[:k])
    error = float(np.abs(projected_covariance(fit, scaled, n, whole, rest) - np.eye(k)).max())
    discard(fit)
    explained = values[:k] / values.sum()
    return rows.mapInArrow(_answers(n, sums, whole, rest, scaled, explained, error, kind), answer)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sums over the dimensions of (n x - S)^2, exact; None beyond a long."""
    ends = np.array([[int(x[:, i].min()), int(x[:, i].max())] for i in range(x.shape[1])], object)
    most = max(abs(n * int(e) - s) for row, s in zip(ends, sums, strict=True) for e in row)
    if most * most * x.shape[1] < 1 << 63 and n * int(np.abs(x).max()) < 1 << 62:
        apart = n * x - np.array(sums, np.int64)
        return (apart * apart).sum(1).tolist()
    found = [sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [f if f < 1 << 63 else None for f in found]


def _answers(n, sums, whole, rest, scaled, explained, error, kind) -> Callable:
    long, k = scaled.shape

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unpacked(batch.column(1), long)
            white = ((x - whole) - rest) @ scaled
            m = len(x)
            own = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(own)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n, np.int64)),
                    pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(own)),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run
