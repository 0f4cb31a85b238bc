"""Vectors as lists of whole numbers: the form in which the vector operators can be exact."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column, largest: float) -> Column:
    """Whether a vector is there, has entries, and every entry is a number of at most ``largest`` either way.

    Null, NaN and infinite entries fail; so do entries whose whole numbers the exact arithmetic could not hold.
    """
    fits = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) <= largest, F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & fits, F.lit(False))


def whole(vector: Column, scale: int, kind: str = "long") -> Column:
    """``floor(scale * c)`` of every entry, computed in double."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast(kind))


def common_length(df: DataFrame, vector: str) -> int:
    """The length that most vectors have, the smaller on a tie; 0 without rows."""
    lengths = df.groupBy(F.size(vector).alias("n")).count()
    best = lengths.agg(F.max(F.struct("count", (-F.col("n")).alias("m"))).alias("b")).first()["b"]
    return -best["m"] if best else 0


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """A list column without nulls as a matrix, a row for each list."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
