"""Projections, filters, predicates and set operations (ops C1-C17, H1-H3).

All of these are narrow except ``set_difference`` (EXCEPT: one shuffle on
the key) and the left join in ``conditional_update``.  Filters on scan
columns are pushed into the Parquet reader by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """C1."""
    return df.drop(*cols)


def select_except(df: DataFrame, stop: list[str]) -> DataFrame:
    """Every column but the stop list, in table order."""
    return df.select(*[c for c in df.columns if c not in set(stop)])


def select_named(df: DataFrame, cols: list[str]) -> DataFrame:
    """C3."""
    return df.select(*cols)


def rename_columns(df: DataFrame, mapping: dict[str, str] | None = None,
                   prefix: str | None = None, cols: list[str] | None = None) -> DataFrame:
    """C4: explicit renames, or a prefix added to ``cols`` (all by default)."""
    if mapping:
        return df.withColumnsRenamed(mapping)
    targets = set(cols or df.columns)
    return df.select(*[F.col(c).alias(f"{prefix}{c}") if c in targets else F.col(c)
                       for c in df.columns])


def filter_history_window(df: DataFrame, day: str, max_lags: int,
                          date_col: str = "date") -> DataFrame:
    """Rows dated within [day - max_lags, day]."""
    d = F.lit(day).cast("date")
    return df.where(F.col(date_col).between(F.date_sub(d, max_lags), d))


def filter_day(df: DataFrame, day: str, cols: list[str] | None = None,
               date_col: str = "date") -> DataFrame:
    """Rows of one day."""
    out = df.where(F.col(date_col) == F.lit(day).cast("date"))
    return out.select(*cols) if cols else out


def filter_from_date(df: DataFrame, day: str, cols: list[str] | None = None,
                     date_col: str = "date") -> DataFrame:
    """Rows on or after a date."""
    out = df.where(F.col(date_col) >= F.lit(day).cast("date"))
    return out.select(*cols) if cols else out


def filter_equal(df: DataFrame, col: str, value) -> DataFrame:
    """C8."""
    return df.where(F.col(col) == F.lit(value))


def filter_contains(df: DataFrame, col: str, *needles: str) -> DataFrame:
    """Every needle must occur (chained filters)."""
    for s in needles:
        df = df.where(F.col(col).contains(s))
    return df


def filter_suffix(df: DataFrame, col: str, suffix: str) -> DataFrame:
    """C10."""
    return df.where(F.col(col).endswith(suffix))


def filter_not_equal(df: DataFrame, col: str, value) -> DataFrame:
    """C11 (NULLs are dropped too, as with any SQL comparison)."""
    return df.where(F.col(col) != F.lit(value))


def drop_nulls(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop a row if any (subset) column is NULL."""
    return df.na.drop("any", subset=subset)


def fill_nulls(df: DataFrame, value: float = 0.0, cols: list[str] | None = None) -> DataFrame:
    """C13."""
    return df.na.fill(value, subset=cols)


def is_not_null(col: str) -> Column:
    """C14."""
    return F.col(col).isNotNull()


def conditional_update(df: DataFrame, updates: DataFrame, keys: list[str],
                       target: str = "sales", value: str = "pred",
                       where: Column | None = None) -> DataFrame:
    """Overwrite ``target`` with ``updates.value`` on matching keys (and
    only where ``where`` holds); other rows keep their value."""
    joined = df.join(updates.select(*keys, F.col(value).alias("_new")), keys, "left")
    cond = F.col("_new").isNotNull() if where is None else (F.col("_new").isNotNull() & where)
    return joined.withColumn(target, F.when(cond, F.col("_new")).otherwise(F.col(target))) \
                 .drop("_new")


def copy_column(df: DataFrame, src: str, dst: str) -> DataFrame:
    """C16."""
    return df.withColumn(dst, F.col(src))


def time_cutoff_split(df: DataFrame, cutoff: str, date_col: str = "date"):
    """C17: (train = date <= cutoff, test = the rest)."""
    mask = F.col(date_col) <= F.lit(cutoff).cast("date")
    return df.where(mask), df.where(~mask | F.col(date_col).isNull())


# --- set operations -----------------------------------------------------------

def union_all_by_name(*dfs: DataFrame) -> DataFrame:
    """H1: stack by column name, duplicates kept."""
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def set_difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """H2: distinct keys of ``a`` absent from ``b`` (SQL EXCEPT)."""
    return a.select(*keys).subtract(b.select(*keys))


def replicate_with_new_id(df: DataFrame, id_col: str = "id", pattern: str = "validation$",
                          replacement: str = "evaluation") -> DataFrame:
    """H3: the frame plus a copy with rewritten ids.  An id that the pattern
    does not change would appear twice, so it raises."""
    new = F.regexp_replace(F.col(id_col), pattern, replacement)
    copy = df.withColumn(id_col, F.when(F.col(id_col).isNull() | (new != F.col(id_col)), new).otherwise(
        F.raise_error(F.concat(F.lit(f"id without {pattern}: "), F.col(id_col)))))
    return df.unionByName(copy)
