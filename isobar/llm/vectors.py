"""Vectors as exact integers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Integer components stay within this bound, so that sums of squares are exact in 64 bits.
BOUND = 1 << 24


def usable(vector: str) -> Column:
    """A vector that is there and has only finite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(F.col(vector), finite), F.lit(False))


def integers(vector: str, scale: int = 256) -> Column:
    """floor(scale * x) of each component x, taken as double; beyond ``BOUND`` the bound itself."""
    bounded = lambda x: F.least(F.greatest(x.cast("double") * scale, F.lit(-float(BOUND))), F.lit(float(BOUND)))
    return F.transform(F.col(vector), lambda x: F.floor(bounded(x)).cast("int"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A row of ``width`` integers per vector; shorter ones end in zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    rows = np.zeros((len(sizes), width), dtype=np.int64)
    rows[np.arange(width)[None, :] < sizes[:, None]] = flat
    return rows
