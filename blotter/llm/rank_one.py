"""Spectra of scatter matrices, kept up to date by symmetric rank-one updates.

A spectrum is the number of rows, their mean, and the eigenvalues (ascending) and eigenvectors
(columns) of the sum of their centred outer products. Adding a row is one rank-one update, adding
a spectrum one for each of its eigenpairs and one for the distance of the means.

An update turns into a diagonal matrix plus an outer product. Entries that the product does not
reach and pairs of equal eigenvalues (after a rotation) are deflated; the other eigenvalues are the
roots of the secular equation, one between each two poles, found for all of them together
by a rational iteration inside shrinking brackets. Eigenvectors come from the product that
has exactly these roots, which keeps them orthogonal also where eigenvalues are close.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
_MOST_STEPS = 80


class Spectrum:
    """Number of rows, mean, eigenvalues and eigenvectors of their scatter matrix."""

    def __init__(self, dimensions: int) -> None:
        self.n = 0
        self.mean = np.zeros(dimensions)
        self.values = np.zeros(dimensions)
        self.vectors = np.eye(dimensions)

    def add_row(self, row: np.ndarray) -> None:
        apart = row - self.mean
        self.n += 1
        if self.n > 1:
            self._update(apart, (self.n - 1) / self.n)
        self.mean = self.mean + apart / self.n

    def add(self, other: Spectrum) -> None:
        if not other.n:
            return
        apart = other.mean - self.mean
        both = self.n + other.n
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self._update(vector, value)
        if self.n:
            self._update(apart, self.n * other.n / both)
        self.mean = self.mean + apart * (other.n / both)
        self.n = both

    def _update(self, vector: np.ndarray, weight: float) -> None:
        self.values, self.vectors = rank_one_update(self.values, self.vectors, vector, weight)


def rank_one_update(
    values: np.ndarray, vectors: np.ndarray, vector: np.ndarray, weight: float
) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors after adding weight * vector vector^T, weight > 0."""
    z = vectors.T @ vector
    size = float(z @ z)
    if not size or not weight:
        return values, vectors
    z /= np.sqrt(size)
    rho = weight * size
    tolerance = 8 * EPS * max(abs(values[-1]), rho)
    reached = np.flatnonzero(rho * np.abs(z) > tolerance)
    vectors = vectors.copy()
    active = _rotate_equal(values, vectors, z, reached, tolerance)
    if not len(active):
        return values, vectors
    poles, weights = values[active], z[active]
    origin, shift = secular_roots(poles, weights**2, rho)
    values = values.copy()
    values[active] = poles[origin] + shift
    vectors[:, active] = vectors[:, active] @ _inner_vectors(poles, weights, origin, shift, rho)
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


def _rotate_equal(
    values: np.ndarray, vectors: np.ndarray, z: np.ndarray, reached: np.ndarray, tolerance: float
) -> np.ndarray:
    """Turn pairs of (nearly) equal eigenvalues so that one of them is not reached; what is left."""
    if len(reached) < 2:
        return reached
    gaps = np.diff(values[reached])
    if gaps.min() > tolerance:
        # A pair further apart can be turned only if one entry is tiny; then it does no harm.
        return reached
    active = [reached[0]]
    for j in reached[1:]:
        i = active[-1]
        if values[j] - values[i] > tolerance:
            active.append(j)
            continue
        length = np.hypot(z[i], z[j])
        c, s = z[j] / length, z[i] / length
        vectors[:, [i, j]] = np.column_stack(
            [c * vectors[:, i] - s * vectors[:, j], s * vectors[:, i] + c * vectors[:, j]]
        )
        z[i], z[j] = 0.0, length
        active[-1] = j
    return np.array(active)


def secular_roots(poles: np.ndarray, weights: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 / rho + sum of weights / (poles - root), as the closest pole and the
    distance from it, for ascending distinct poles."""
    k = len(poles)
    at = np.arange(k)
    top = rho * float(weights.sum())
    if k == 1:
        return np.zeros(1, np.intp), np.array([top])
    gap = np.append(np.diff(poles), top)
    middle = poles + gap / 2
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        half = 1 / rho + (weights[:, None] / (poles[:, None] - middle)).sum(0)
        left = half >= 0
        left[-1] = True  # the last root has a pole on one side only
        origin = np.where(left, at, np.minimum(at + 1, k - 1))
        away = poles[:, None] - poles[origin]
        low = np.where(left, 0.0, -gap / 2)
        high = np.where(left, gap / 2, 0.0)
        low[-1], high[-1] = (0.0, gap[-1] / 2) if half[-1] >= 0 else (gap[-1] / 2, gap[-1])
        # Of the two poles that the iteration models, the last root has both below it.
        first = np.minimum(at, k - 2)
        below = (at[:, None] <= first).astype(np.float64)
        shift = _first_guess(poles, weights, half, gap, left, low, high)
        open_ = np.ones(k, bool)
        for _ in range(_MOST_STEPS):
            delta = away - shift
            terms = weights[:, None] / delta
            from_low = np.einsum("ij,ij->j", terms, below)
            from_high = terms.sum(0) - from_low
            value = 1 / rho + from_low + from_high
            error = EPS * k * (1 / rho + np.abs(from_low) + np.abs(from_high))
            low = np.where(value < 0, shift, low)
            high = np.where(value < 0, high, shift)
            open_ &= (np.abs(value) > error) & (high - low > 2 * EPS * np.abs(shift))
            if not open_.any():
                break
            slopes = terms / delta
            slope_low = np.einsum("ij,ij->j", slopes, below)
            slope_high = slopes.sum(0) - slope_low
            d1, d2 = delta[first, at], delta[first + 1, at]
            a = (d1 + d2) * value - d1 * d2 * (slope_low + slope_high)
            b = d1 * d2 * value
            c = value - d1 * slope_low - d2 * slope_high
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            # Beyond the last pole the other solution of the same quadratic is the root.
            step[-1] = (a[-1] + root[-1]) / (2 * c[-1]) if a[-1] >= 0 else 2 * b[-1] / (a[-1] - root[-1])
            tried = shift + step
            inside = np.isfinite(tried) & (tried > low) & (tried < high)
            tried = np.where(inside, tried, (low + high) / 2)
            shift = np.where(open_, tried, shift)
    return origin, shift


def _first_guess(poles, weights, half, gap, left, low, high) -> np.ndarray:
    """Roots of the two nearest terms with all others as they are in the middle of the gap."""
    own, other = weights, np.append(weights[1:], 0.0)
    rest = half + 2 * (own - other) / gap
    a = np.where(left, 1, -1) * rest * gap + own + other
    b = np.where(left, own, -other) * gap
    root = np.sqrt(np.maximum(a * a - 4 * b * rest, 0.0))
    guess = np.where(left, 2 * b / (a + root), (a - root) / (2 * rest))
    mirrored = 2 * b / (a + root)
    guess = np.where(left & (a <= 0), (a - root) / (2 * rest), guess)
    guess = np.where(~left & (a > 0), mirrored, guess)
    inside = np.isfinite(guess) & (guess > low) & (guess < high)
    return np.where(inside, guess, (low + high) / 2)


def _inner_vectors(
    poles: np.ndarray, z: np.ndarray, origin: np.ndarray, shift: np.ndarray, rho: float
) -> np.ndarray:
    """Eigenvectors (columns) of diag(poles) + rho z z^T with the given roots."""
    # poles[i] - root[j], from the pole that is closest to the root
    delta = (poles[:, None] - poles[origin]) - shift
    between = poles - poles[:, None]
    np.fill_diagonal(between, -1.0)
    ratio = -delta / between  # (root j - pole i) / (pole j - pole i)
    np.fill_diagonal(ratio, -np.diag(delta))
    exact = np.sqrt(np.abs(ratio.prod(1)) / rho)
    inner = np.copysign(exact, z)[:, None] / delta
    return inner / np.sqrt((inner * inner).sum(0))
