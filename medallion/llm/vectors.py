"""Vectors as numpy matrices inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(name: str = "embedding") -> Column:
    """The vector is not null and has no null or non-finite component."""
    bad = F.exists(name, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(name).isNotNull() & ~bad


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)
