"""Cosine arithmetic: column expressions, and matrix helpers for Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

ZERO_NORM = 1e-10  # stands in for the norm of a zero vector
SIM_DIGITS = 9  # similarities equal to this many digits are ties


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two array columns; 0 where one of them is all zeros."""
    guard = F.lit(ZERO_NORM)
    return dot(a, b) / (F.greatest(norm(a), guard) * F.greatest(norm(b), guard))


def matrix(vectors) -> np.ndarray:
    """One row per list of a list array without NULLs, in double precision."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    n = len(vectors)
    if n == 0:
        return np.zeros((0, 0))
    lengths = pc.min_max(pc.list_value_length(vectors)).as_py()
    if lengths["min"] != lengths["max"]:
        raise ValueError(f"vectors of mixed length: {lengths['min']} and {lengths['max']}")
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows stay zero."""
    length = np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]
    return rows / np.where(length == 0, ZERO_NORM, length)


def angles(units: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Angles between unit rows.  A zero row is at a right angle to everything."""
    return np.arccos(np.clip(units @ others.T, -1.0, 1.0))


def plain_cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows with rows, entry after entry in double precision, to the last bit as SQL works them out."""
    total = lambda x: np.cumsum(x, axis=1)[:, -1]
    return total(a * b) / np.sqrt(total(a * a) * total(b * b))
