"""Blocks of vectors: rows of an embedding table packed into matrices (operators 6 and 10)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def vectors_of(column: pa.Array) -> list[np.ndarray | None]:
    """Each list as doubles; None for a null list, a null component or a non-finite one."""
    out: list[np.ndarray | None] = []
    for value in column.to_pylist():
        if value is None or None in value:
            out.append(None)
            continue
        vector = np.asarray(value, np.float64)
        out.append(vector if np.isfinite(vector).all() else None)
    return out


def stacked(vectors: list[np.ndarray], width: int | None = None) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    width = max([width or 0, *(len(v) for v in vectors)], default=0)
    if all(len(v) == width for v in vectors):
        return np.array(vectors).reshape(len(vectors), width)
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out
