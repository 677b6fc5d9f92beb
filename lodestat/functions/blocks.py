"""Arrow helpers used inside tasks: list columns to NumPy matrices and back."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def as_matrix(column: pa.Array) -> np.ndarray:
    """A list column whose rows all have the same length, as a (rows, length) float64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    if rows == 0:
        return np.zeros((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if flat.size % rows:
        raise ValueError("vectors differ in length")
    return flat.reshape(rows, -1)


def as_lists(matrix: np.ndarray) -> pa.Array:
    """A matrix as an Arrow list<double> column."""
    rows, width = matrix.shape
    offsets = pa.array(np.arange(0, rows * width + 1, width, dtype=np.int32)) if width else pa.array(
        np.zeros(rows + 1, dtype=np.int32)
    )
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix).ravel()))


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared Euclidean distances between the rows of two blocks, by one matrix product."""
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.maximum(d, 0.0)


def smallest_k(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Column positions of the k smallest entries per row, ties to the smaller id; order not kept.

    The (k)-th value is found by partition, then every entry up to and including that value is a
    candidate, so a tie at the cut is decided by id and not by chance.
    """
    k = min(k, scores.shape[1])
    cut = np.partition(scores, k - 1, axis=1)[:, k - 1]
    out = np.empty((scores.shape[0], k), dtype=np.int64)
    for r in range(scores.shape[0]):
        at = np.flatnonzero(scores[r] <= cut[r])
        if at.size > k:
            at = at[np.lexsort((ids[at], scores[r][at]))[:k]]
        out[r] = at
    return out
