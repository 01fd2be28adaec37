"""Eigenvectors of a symmetric matrix by spectral divide and conquer with polar decompositions.

Nakatsukasa and Higham, "Stable and efficient spectral divide and conquer algorithms" (2013).
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps


def polar(matrix: np.ndarray) -> np.ndarray:
    """The unitary polar factor by dynamically weighted Halley steps (QDWH)."""
    size = len(matrix)
    x = matrix / np.linalg.norm(matrix)
    try:
        low = 1 / (np.linalg.norm(np.linalg.inv(x)) * np.sqrt(size))
    except np.linalg.LinAlgError:
        low = EPS
    low = min(max(low, EPS), 1.0)
    for _ in range(30):
        square = low * low
        d = np.cbrt(4 * (1 - square) / square**2)
        a = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * np.sqrt(1 + d)))
        b = (a - 1) ** 2 / 4
        c = a + b - 1
        q, _ = np.linalg.qr(np.concatenate([np.sqrt(c) * x, np.eye(size)]))
        following = b / c * x + (a - b / c) / np.sqrt(c) * q[:size] @ q[size:].T
        moved = np.linalg.norm(following - x)
        x = (following + following.T) / 2
        low = min(low * (a + b * square) / (1 + c * square), 1.0)
        if moved < np.cbrt(EPS) and 1 - low < 10 * EPS:
            break
    return x


def halves(matrix: np.ndarray, shift: float, random: np.random.Generator) -> tuple[np.ndarray, int]:
    """An orthogonal matrix whose first k columns span the eigenvalues above ``shift``, and k.

    The polar factor of the shifted matrix has the eigenvalues 1 and -1, and so gives the projector on either side.
    """
    size = len(matrix)
    projector = (polar(matrix - shift * np.eye(size)) + np.eye(size)) / 2
    k = int(round(np.trace(projector)))
    if not 0 < k < size:
        return np.eye(size), k
    basis = np.linalg.qr(projector @ random.standard_normal((size, k)))[0]
    return np.linalg.qr(projector @ basis, mode="complete")[0], k


def leading_components(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    An invariant subspace is split at the median of its diagonal until it has one dimension or the
    matrix on it is diagonal up to rounding; subspaces beyond ``count`` are not looked at.
    """
    matrix = (matrix + matrix.T) / 2
    scale, random = np.linalg.norm(matrix), np.random.default_rng(42)

    def below(part: np.ndarray, basis: np.ndarray, count: int) -> np.ndarray:
        diagonal = np.diag(part)
        if np.linalg.norm(part - np.diag(diagonal)) <= 4 * EPS * scale:
            return basis[:, np.argsort(-diagonal, kind="stable")[:count]]
        for shift in (np.median(diagonal), diagonal.mean(), (diagonal.max() + diagonal.min()) / 2, *np.sort(diagonal)):
            turned, k = halves(part, shift, random)
            if 0 < k < len(part):
                break
        else:
            return basis[:, np.argsort(-diagonal, kind="stable")[:count]]
        inner = turned.T @ part @ turned
        inner = (inner + inner.T) / 2
        found = below(inner[:k, :k], basis @ turned[:, :k], count)
        if count > k:
            found = np.concatenate([found, below(inner[k:, k:], basis @ turned[:, k:], count - k)], axis=1)
        return found

    vectors = below(matrix, np.eye(len(matrix)), min(count, len(matrix)))
    vectors = vectors / np.linalg.norm(vectors, axis=0)
    values = np.einsum("ij,ij->j", vectors, matrix @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]
