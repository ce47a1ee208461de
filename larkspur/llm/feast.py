"""Eigenpairs of a symmetric matrix on an interval by contour integration, counted by inertia.

The matrix is a statistic of bounded size (dimensions squared). A circle around the wanted part
of the spectrum is integrated with Gauss-Legendre nodes; each node is a solve with the complex
shifted matrix, and their sum projects a block of vectors onto the eigenvectors inside. A
Rayleigh-Ritz step on that block gives eigenpairs; both are repeated until the residuals are at
rounding level. Sylvester's law counts the eigenvalues above any shift from the signs of a
symmetric factorisation, which finds the interval's borders and proves that no pair is missing.
"""

from __future__ import annotations

import numpy as np

NODES = 16
ROUNDS = 60
#: Residual norm, relative to the matrix, at which a pair counts as found.
TOLERANCE = 2e-14
#: Gap between neighbouring eigenvalues, relative to the matrix, in which a border may lie.
GAP = 1e-9
_PIVOT = (1 + 17**0.5) / 8


def above(matrix: np.ndarray, shift: float) -> int:
    """Number of eigenvalues greater than ``shift``: positive pivots of a symmetric factorisation.

    Pivots are single entries or two-by-two blocks, whichever keeps the growth bounded; a block
    is taken for a dominant entry off the diagonal, so it has one eigenvalue of either sign.
    """
    rest = matrix - shift * np.eye(len(matrix))
    positive = 0
    while len(rest):
        sizes = np.abs(rest)
        single = int(np.argmax(np.diagonal(sizes)))
        i, j = divmod(int(np.argmax(sizes)), len(rest))
        if sizes[i, j] == 0:
            break
        if sizes[single, single] >= _PIVOT * sizes[i, j]:
            chosen = [single]
            positive += int(rest[single, single] > 0)
        else:
            chosen = [i, j]
            positive += 1
        keep = np.setdiff1d(np.arange(len(rest)), chosen)
        side = rest[np.ix_(keep, chosen)]
        rest = rest[np.ix_(keep, keep)] - side @ np.linalg.solve(rest[np.ix_(chosen, chosen)], side.T)
        rest = (rest + rest.T) / 2
    return positive


def _nth(matrix: np.ndarray, n: int, low: float, high: float, width: float) -> tuple[float, float]:
    """An interval no wider than ``width`` that holds the n-th largest eigenvalue."""
    while high - low > width:
        middle = (low + high) / 2
        if above(matrix, middle) >= n:
            low = middle
        else:
            high = middle
    return low, high


def interval(matrix: np.ndarray, wanted: int) -> tuple[float, float, int]:
    """Borders around at least the ``wanted`` largest eigenvalues, and how many lie inside.

    The lower border lies in a gap; eigenvalues too close to the last wanted one come in with it.
    """
    size = len(matrix)
    bound = float(np.abs(matrix).sum(axis=1).max())  # no eigenvalue lies outside of this
    low, high = -bound * 1.01, bound * 1.01
    step = bound * GAP / 8
    _, top = _nth(matrix, 1, low, high, step)
    count = min(wanted, size)
    while count < size:
        here, _ = _nth(matrix, count, low, top, step)
        _, below = _nth(matrix, count + 1, low, here, step)
        if here - below > bound * GAP:
            low = (here + below) / 2
            break
        count += 1
    high = top + max((top - low) / 16, bound * GAP)
    return low, high, above(matrix, low) - above(matrix, high)


def _projected(matrix: np.ndarray, block: np.ndarray, low: float, high: float) -> np.ndarray:
    centre, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(NODES)
    total = np.zeros_like(block)
    for angle, weight in zip(np.pi / 2 * (1 + points), weights):
        turn = radius * np.exp(1j * angle)
        solved = np.linalg.solve((centre + turn) * np.eye(len(matrix)) - matrix, block)
        total += weight / 2 * (turn * solved).real
    return total


def eigenpairs(matrix: np.ndarray, wanted: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues (all, if fewer), falling, and their unit eigenvectors as columns."""
    size = len(matrix)
    scale = float(np.abs(matrix).max()) if size else 0.0
    if scale == 0 or not wanted:
        return np.zeros(0), np.zeros((size, 0))
    scaled = matrix / scale
    low, high, count = interval(scaled, wanted)
    norm = float(np.abs(scaled).sum(axis=1).max())
    width = min(size, 2 * count + 4)
    while True:
        block = np.random.default_rng(seed).standard_normal((size, width))
        last = np.inf
        for _ in range(ROUNDS):
            basis, _ = np.linalg.qr(_projected(scaled, block, low, high))
            values, turns = np.linalg.eigh(basis.T @ scaled @ basis)
            block = basis @ turns
            inside = (values > low) & (values < high)
            errors = np.linalg.norm(scaled @ block[:, inside] - block[:, inside] * values[inside], axis=0)
            worst = float(errors.max(initial=0.0))
            if inside.sum() == count and (worst <= TOLERANCE * norm or (worst <= 64 * TOLERANCE * norm and worst > last / 2)):
                order = np.argsort(-values[inside])[:wanted]
                return values[inside][order] * scale, block[:, inside][:, order]
            last = worst
        if width == size:
            raise ArithmeticError(f"{int(inside.sum())} of {count} eigenvalues found, residual {worst}")
        width = min(size, 2 * width)  # too narrow a block for what lies just outside
