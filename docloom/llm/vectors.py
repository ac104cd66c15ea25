"""Checks and forms of embedding columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(embedding: Column) -> Column:
    """True for a vector with finite components only, one of them not zero."""
    value = embedding.cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(value, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of a list column whose lists all have ``size`` numbers, in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), size)


def units(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, safe for very large and very small components."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def rotation(size: int, seed: int = 11) -> np.ndarray:
    """A fixed random rotation."""
    basis, upper = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return basis * np.sign(np.diag(upper))
