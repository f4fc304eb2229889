"""Embeddings as vectors of integers, for the operators that need exact arithmetic."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256
#: Integers are smaller than this, so that squares and products of any usual number of components stay exact in 64 bits.
LARGEST = 1 << 26


def integers(embedding: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, x as double."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * scale))


def finite(embedding: Column) -> Column:
    """Whether there is a vector and none of its components is null or not finite."""
    return embedding.isNotNull() & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def vectors(rows: DataFrame, *keys: str | Column, size: int | None = None) -> DataFrame:
    """keys and ``v``, the integers of rows that have a finite ``embedding``, of exactly size components where that is given. Other columns, whatever their names, are left out."""
    e = F.col("embedding")
    kept = finite(e) if size is None else finite(e) & (F.size(e) == size)
    return rows.where(F.coalesce(kept, F.lit(False))).select(*keys, integers(e).alias("v"))


def checked(m: np.ndarray) -> np.ndarray:
    """m, or an error where an integer is too large for exact arithmetic."""
    if m.size and (m.max() >= LARGEST or m.min() <= -LARGEST):
        raise ValueError(f"components must be smaller than {LARGEST // SCALE} in size")
    return m


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of an Arrow list column as rows; one with fewer components than width counts as followed by zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return checked(flat.astype(np.int64, copy=False).reshape(len(lengths), width))
    out = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return checked(out)
