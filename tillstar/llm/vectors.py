"""Vectors in tasks: arrays from Arrow, and which vectors take part."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(col: str) -> Column:
    """Neither null nor empty nor zero, all components there and finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf"))
    return F.coalesce((F.size(col) > 0) & F.forall(col, finite) & F.exists(col, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of one length as a double-precision matrix."""
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def dimension(df: DataFrame, col: str) -> int | None:
    """The vectors' length; vectors of other lengths are an error, as no measure is defined across lengths."""
    low, high = df.agg(F.min(F.size(col)), F.max(F.size(col))).first()
    if low != high:
        raise ValueError(f"{col} holds vectors of {low} to {high} components")
    return low
