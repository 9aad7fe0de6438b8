"""Small SQL text builders for the DuckDB oracle queries."""

from __future__ import annotations


def over(k: int | None = None, shift: int = 0, part: str = "id", order: str = "d_num") -> str:
    base = f"PARTITION BY {part} ORDER BY {order}"
    if k is None:
        return f"OVER ({base})"
    lo = k - 1 + shift
    hi = "CURRENT ROW" if shift == 0 else f"{shift} PRECEDING"
    return f"OVER ({base} ROWS BETWEEN {lo} PRECEDING AND {hi})"


def rolling(col: str, agg: str, k: int, shift: int = 0, part: str = "id",
            order: str = "d_num") -> str:
    f = over(k, shift, part, order)
    return f"(CASE WHEN count({col}) {f} = {k} THEN {agg}({col}) {f} END)"


def rolling_moment(col: str, fn: str, k: int, shift: int = 0, part: str = "id",
                   order: str = "d_num") -> str:
    """DuckDB's skewness/kurtosis are already the bias-corrected sample ones."""
    f = over(k, shift, part, order)
    return (f"(CASE WHEN count({col}) {f} = {k} AND max({col}) {f} <> min({col}) {f} "
            f"THEN {fn}({col}) {f} END)")
