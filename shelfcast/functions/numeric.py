"""Numeric scalar functions (ops I9-I11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def numeric_cast(df: DataFrame, cols: list[str], to: str = "short") -> DataFrame:
    """Narrowing casts (ANSI mode raises on overflow; values are checked
    by ``encode.narrow_types`` when the target is chosen from the data)."""
    return df.select(*[F.col(c).cast(to).alias(c) if c in cols else F.col(c) for c in df.columns])


def round_half_even(col: str | Column, places: int = 2) -> Column:
    """pandas/numpy rounding (banker's), i.e. ``bround``, not ``round``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.bround(c, places)


def abs_error(pred: str | Column, actual: str | Column) -> Column:
    """Absolute difference."""
    p = F.col(pred) if isinstance(pred, str) else pred
    a = F.col(actual) if isinstance(actual, str) else actual
    return F.abs(p - a)
