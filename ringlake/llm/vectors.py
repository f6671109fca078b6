"""Vectors as integers: what the operators on embeddings share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components of a batch's piece, so that memory is bounded however wide the vectors are.
PIECE = 1 << 20


def usable(vec: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    bad = F.exists(vec, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    return vec.isNotNull() & ~bad


def extent(df: DataFrame, vec: str, scale: int) -> tuple[int, int]:
    """The longest vector's length and the largest magnitude of an integer component; 0 and 0 of an empty table."""
    far = F.aggregate(vec, F.lit(0.0), lambda m, v: F.greatest(m, F.abs(v.cast("double"))))
    dim, top = df.agg(F.max(F.size(vec)), F.max(far)).first()
    return dim or 0, int(np.ceil((top or 0.0) * scale)) + 1


def matrix(vectors: pa.Array, dim: int, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of each component; vectors shorter than ``dim`` end in zeros."""
    size = np.diff(vectors.offsets.to_numpy())
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale).astype(np.int64)
    if (size == dim).all():
        return flat.reshape(len(vectors), dim)
    out = np.zeros((len(vectors), dim), np.int64)
    out[np.arange(dim) < size[:, None]] = flat
    return out


def pieces(batches, dim: int, most: int = PIECE):
    """Batches cut to at most ``most`` components."""
    rows = max(1, most // max(1, dim))
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
