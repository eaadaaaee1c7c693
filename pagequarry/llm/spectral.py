"""Eigenvectors of a symmetric matrix by spectral divide and conquer.

The polar factor of ``a - shift`` is the matrix sign of it, found by dynamically weighted
Halley steps; half of sign plus identity projects on the eigenvectors above the shift. An
orthonormal basis of that subspace and of its complement splits the matrix in two, and each
half is split again until a block is a number times the identity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

EPS = np.finfo(float).eps
SEED = 1
SPLIT = 100 * EPS  # what may be left between two halves, as a share of the matrix
BY_QR = 100.0  # weights above which a step is taken by QR instead of Cholesky


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal factor of a square matrix: singular values go to one, vectors stay."""
    size = len(a)
    x = a / (np.linalg.norm(a) or 1.0)
    low = EPS  # below every singular value but those that are zero in double precision
    for _ in range(30):
        gamma = np.cbrt(4 * (1 - low**2) / low**4)
        root = np.sqrt(1 + gamma)
        weight = root + np.sqrt(8 - 4 * gamma + 8 * (2 - low**2) / (low**2 * root)) / 2
        b = (weight - 1) ** 2 / 4
        c = weight + b - 1
        before = x
        if c > BY_QR:
            q = np.linalg.qr(np.vstack([np.sqrt(c) * x, np.eye(size)]))[0]
            turned = q[:size] @ q[size:].T / np.sqrt(c)
        else:
            half = np.linalg.cholesky(np.eye(size) + c * (x.T @ x))
            turned = np.linalg.solve(half.T, np.linalg.solve(half, x.T)).T
        x = b / c * x + (weight - b / c) * turned
        low = min(low * (weight + b * low**2) / (1 + c * low**2), 1.0)
        if 1 - low < 10 * EPS and np.linalg.norm(x - before) <= (5 * EPS) ** (1 / 3) * np.sqrt(size):
            break
    return x


def _shifts(a: np.ndarray) -> Iterator[float]:
    """Where to cut the spectrum: the median first, then around the mean, which always has
    eigenvalues on both sides, moved a little in case one of them lies on it."""
    size = len(a)
    yield float(np.median(np.diag(a)))
    mean = np.trace(a) / size
    spread = np.linalg.norm(a - mean * np.eye(size)) / np.sqrt(size)
    for k in range(20):
        yield mean + spread * (-1) ** k * k / 40
    for value in np.sort(np.diag(a)):
        yield float(value) + spread / 100


def _split(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of two invariant subspaces, the one of larger eigenvalues first."""
    size = len(a)
    start = np.random.default_rng(SEED).normal(size=(size, size))
    best, left = None, np.inf
    for shift in _shifts(a):
        projector = (polar_factor(a - shift * np.eye(size)) + np.eye(size)) / 2
        rank = round(float(np.trace(projector)))
        if not 0 < rank < size:
            continue
        basis = np.linalg.qr(projector @ start[:, :rank])[0]
        whole = np.linalg.qr(projector @ basis, mode="complete")[0]
        above, below = whole[:, :rank], whole[:, rank:]
        error = np.linalg.norm(below.T @ a @ above)
        if error < left:
            best, left = (above, below), error
        if error <= SPLIT * scale:
            break
    return best


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, largest first, and unit eigenvectors as columns, their largest entry
    positive."""
    a = (a + a.T) / 2
    scale = np.linalg.norm(a)

    def vectors(block: np.ndarray) -> np.ndarray:
        size = len(block)
        even = block - np.trace(block) / max(size, 1) * np.eye(size)
        if size < 2 or np.linalg.norm(even) <= 2 * EPS * scale:
            return np.eye(size)
        halves = _split(block, scale)
        if halves is None:
            return np.eye(size)
        return np.hstack([h @ vectors((h.T @ block @ h + (h.T @ block @ h).T) / 2) for h in halves])

    found = vectors(a)
    values = np.einsum("ij,ij->j", found, a @ found)
    order = np.argsort(-values, kind="stable")
    found = found[:, order]
    top = found[np.abs(found).argmax(axis=0), np.arange(found.shape[1])] if found.size else 1.0
    return values[order], found * np.where(np.asarray(top) < 0, -1.0, 1.0)
