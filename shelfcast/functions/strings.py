"""String scalar functions (ops I5-I8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def suffix_key(col: str | Column, n: int) -> Column:
    """Last ``n`` characters as a number (NULL when not numeric)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.right(c, F.lit(n)).try_cast("short")


def extract_day_number(col: str | Column) -> Column:
    """``d_1913`` -> 1913."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract(c, r"^d_(\d+)$", 1).try_cast("int")


def rewrite_suffix(col: str | Column, pattern: str = "validation$",
                   replacement: str = "evaluation") -> Column:
    """Regular-expression rewrite of the id suffix."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, pattern, replacement)


def format_label(prefix: str, n: Column) -> Column:
    """I8: ``F{n}``, ``d_{n}``, ``lag_{n}`` style labels."""
    return F.concat(F.lit(prefix), n.cast("string"))
