"""Embedding rows as scaled integer vectors, shared by the vector operators of this package."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Squared distances of up to 128 components below this fit a long.
LARGEST = 2**27


def usable(vector: Column) -> Column:
    """Whether a vector is there, has components, and none of them is NULL, NaN or infinite."""
    v = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce((F.size(v) > 0) & ~bad, F.lit(False))


def scaled(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component; a vector beyond ``LARGEST`` is an error."""
    out = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    far = F.exists(vector, lambda x: F.abs(x.cast("double")) * scale > LARGEST)
    return F.when(far, F.raise_error(F.lit(f"a component is over {LARGEST} / {scale}")).cast("array<bigint>")).otherwise(out)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a list column of one width as an int64 matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, width)


def summed(rows: DataFrame, keys: list[str], width: int, *more: Column) -> DataFrame:
    """Partial rows (keys, n, sums) added up to one row a key."""
    total = F.array(*(F.sum(F.col("sums")[i]) for i in range(width)))
    return rows.groupBy(*keys).agg(F.sum("n").alias("n"), total.alias("sums"), *more)
