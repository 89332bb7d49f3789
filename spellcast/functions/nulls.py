"""Null- and zero-aware helpers shared by the SQL layer and the feature formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_propagating_least(a: Column, b: Column) -> Column:
    """NULL when either side is NULL (Spark's ``least`` skips NULLs)."""
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def zero_as(col: Column, value) -> Column:
    """Replace a zero divisor by ``value``; NULL stays NULL."""
    return F.when(col == 0, F.lit(value)).otherwise(col)


def ratio(num: Column, den: Column, zero: float = 1) -> Column:
    """``num / den`` in double arithmetic with zero divisors replaced by ``zero``."""
    return num.cast("double") / zero_as(den.cast("double"), float(zero))


def cents(col: Column) -> Column:
    """A money sum, rounded to whole cents so it does not depend on summation order."""
    return F.rint(col * 100) / 100
