"""Feature selection by correlation groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP_THRESHOLD = 0.8
_SUMS = ("n", "x", "y", "xx", "yy", "xy")


def pair_moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per pair of columns (i, j), i < j: number of rows that have both, and their sums and products.

    One aggregate over the rows: every task adds up all pairs of its rows as matrix products, with
    missing values (NULL, NaN) left out of exactly the pairs they belong to. Values are taken from the
    column's mean, so large means cost no digits.
    """
    numbers = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"_{i}") for i, c in enumerate(cols)]
    plain = df.select(*numbers)
    means = [m or 0.0 for m in plain.agg(*[F.avg(f"_{i}") for i in range(len(cols))]).first()]
    first, second = np.triu_indices(len(cols), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(_SUMS), len(cols), len(cols)))
        for batch in batches:
            x = np.stack([batch.column(i).to_numpy(zero_copy_only=False) - m for i, m in enumerate(means)], axis=1)
            has = ~np.isnan(x)
            x, has = np.where(has, x, 0.0), has.astype(float)
            total += (has.T @ has, x.T @ has, has.T @ x, (x * x).T @ has, has.T @ (x * x), x.T @ x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(first.astype(np.int32)), pa.array(second.astype(np.int32)), *(pa.array(t[first, second]) for t in total)], names=["i", "j", *_SUMS]
        )

    parts = plain.mapInArrow(run, "i int, j int, " + ", ".join(f"{s} double" for s in _SUMS))
    return parts.groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in _SUMS])


def correlation_matrix(df: DataFrame, cols: list[str]) -> list[list[float]]:
    """Pearson matrix over the rows that have both values of a pair; NaN where a pair has no spread.

    The driver gets one row a pair, as many as the feature list squared.
    """
    out = np.full((len(cols), len(cols)), np.nan)
    for r in pair_moments(df, cols).collect():
        if r.n > 1:
            spread = (r.xx - r.x * r.x / r.n) * (r.yy - r.y * r.y / r.n)
            if spread > 0:
                out[r.i, r.j] = out[r.j, r.i] = (r.xy - r.x * r.y / r.n) / spread**0.5
    np.fill_diagonal(out, 1.0)
    return out.tolist()


def correlation_groups(matrix: list[list[float]], threshold: float = GROUP_THRESHOLD) -> list[int]:
    """Group number per feature: connected by pairs with ``|r| > threshold``; the number is
    the smallest member's index."""
    parent = list(range(len(matrix)))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, row in enumerate(matrix):
        for j in range(i):
            if abs(row[j]) > threshold:  # never for NaN
                low, high = sorted((top(i), top(j)))
                parent[high] = low
    return [top(i) for i in range(len(matrix))]


def correlation_select(df: DataFrame, features: list[str], target: str, threshold: float = GROUP_THRESHOLD) -> DataFrame:
    """Per feature: its group, its correlation with the target, and whether it is kept (the
    strongest of its group)."""
    matrix = correlation_matrix(df, [*features, target])
    inner = [row[:-1] for row in matrix[:-1]]
    with_target = [0.0 if row[-1] != row[-1] else row[-1] for row in matrix[:-1]]
    groups = correlation_groups(inner, threshold)
    best: dict[int, int] = {}
    for i, g in enumerate(groups):
        if g not in best or abs(with_target[i]) > abs(with_target[best[g]]):
            best[g] = i
    rows = [(f, features[g], float(r), best[g] == i) for i, (f, g, r) in enumerate(zip(features, groups, with_target))]
    return df.sparkSession.createDataFrame(
        rows, "feature string, group_of string, target_correlation double, kept boolean"
    )
