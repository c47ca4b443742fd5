"""Vectors as rows of integers, for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components must stay below this size, so that squared distances of 64 of them fit 64 bits.
LARGEST = 1 << 27


def finite(column: str = "embedding") -> Column:
    """True for a vector without null, NaN and infinite components (null vectors: null)."""
    return F.forall(F.col(column), lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                    & (F.abs(x.cast("double")) != F.lit(float("inf"))))


def integers(embeddings: DataFrame, scale: int, *others: str, column: str = "embedding") -> DataFrame:
    """``others`` and ``v``, each component's floor(scale * x), of the rows whose vectors are finite."""
    whole = F.transform(F.col(column), lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("bigint"))
    return embeddings.where(finite(column)).select(*others, whole.alias("v"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of lists of ``width`` integers as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, width)


def checked(rows: np.ndarray) -> np.ndarray:
    if rows.size and max(int(rows.max()), -int(rows.min())) >= LARGEST:
        raise ValueError(f"a scaled vector component reaches {LARGEST}; distances would not fit 64 bits")
    return rows
