"""Aggregations, data-quality checks, sorts and top-k (ops E1-E10, G1-G4).

Every aggregate here is a partial + final hash aggregation, so a hot key is
pre-reduced inside each map task before the shuffle.  Checks return
one-row DataFrames; nothing is collected by the library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes per value used by the memory estimate (fixed-width types).
TYPE_WIDTH = {
    "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8,
    "boolean": 1, "date": 4, "timestamp": 8, "timestamp_ntz": 8,
}


def profile_table(df: DataFrame, date_col: str = "date", id_col: str = "id") -> DataFrame:
    """Shape and span of a table in one aggregation: rows, columns,
    first and last date, distinct series."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_cols"),
                  F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"),
                  F.count_distinct(id_col).alias("n_series"))


def group_mean_multi(df: DataFrame, keys: list[str], col: str, out: str) -> DataFrame:
    """Mean per group (NULLs skipped)."""
    return df.groupBy(*keys).agg(F.avg(col).alias(out))


def daily_mean_compare(df: DataFrame, cols: dict[str, str], date_col: str = "date") -> DataFrame:
    """Per date, the mean of each column (name -> output name)."""
    return df.groupBy(date_col).agg(*[F.avg(c).alias(o) for c, o in cols.items()])


def column_min_max(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Min and max of each numeric column, one pass, one row."""
    cols = cols or [f.name for f in df.schema.fields
                    if isinstance(f.dataType, T.NumericType)]
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return df.agg(*aggs)


def count_distinct_ids(df: DataFrame, col: str = "id") -> DataFrame:
    """Exact distinct count (two-phase: distinct per partition first)."""
    return df.agg(F.count_distinct(col).alias("n_distinct_ids"))


def count_matching(df: DataFrame, col: str, regex: str, out: str = "n_matching") -> DataFrame:
    """E5."""
    return df.agg(F.count_if(F.col(col).rlike(regex)).alias(out))


def count_nulls(df: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    """Total NULL cells over all (non-excluded) columns; 0 passes."""
    cols = [c for c in df.columns if c not in set(exclude or [])]
    total = sum((F.sum(F.col(c).isNull().cast("long")) for c in cols), F.lit(0).cast("long"))
    return df.agg(total.alias("n_nulls"))


def check_id_alignment(a: DataFrame, b: DataFrame, col: str = "id") -> DataFrame:
    """Ids of ``a`` equal ids of ``b`` as multisets (Spark keeps no row
    order).  Each side tags its ids +1 / -1, one aggregation by id nets them
    out; one row results: ids only on the left, only on the right, and an
    ``aligned`` flag."""
    tagged = a.select(col, F.lit(1).alias("_s")).unionByName(b.select(col, F.lit(-1).alias("_s")))
    net = tagged.groupBy(col).agg(F.sum("_s").alias("_d"))
    out = net.agg(
        F.coalesce(F.sum(F.when(F.col("_d") > 0, F.col("_d"))), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(F.when(F.col("_d") < 0, -F.col("_d"))), F.lit(0)).alias("only_right"))
    return out.withColumn("aligned", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def rmse_mse(df: DataFrame, y: str, p: str, keys: list[str] | None = None) -> DataFrame:
    """Mean squared error and its root, overall or per key."""
    sq = F.pow(F.col(y) - F.col(p), 2)
    aggs = [F.avg(sq).alias("mse"), F.sqrt(F.avg(sq)).alias("rmse"),
            F.count(sq).alias("n")]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def _width(dtype_name: str, col: str):
    if dtype_name in TYPE_WIDTH:
        return F.lit(TYPE_WIDTH[dtype_name]).cast("long")
    if dtype_name == "string":
        return F.coalesce(F.octet_length(col), F.lit(0)).cast("long")
    return F.lit(8).cast("long")


def memory_estimate(df: DataFrame, narrowed_types: dict[str, str] | None = None) -> DataFrame:
    """Size in MB of the table (type width x rows; strings by UTF-8
    length), and with ``narrowed_types`` (column -> type, e.g. from
    ``encode.narrow_plan``) the size after narrowing and the per cent saved.

    One aggregation pass over the rows computes both sizes.
    """
    fields = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    before = sum((_width(t, c) for c, t in fields), F.lit(0).cast("long"))
    aggs = [(F.sum(before) / 1024 ** 2).alias("mb_before")]
    if narrowed_types is not None:
        after = sum((_width(narrowed_types.get(c, t), c) for c, t in fields),
                    F.lit(0).cast("long"))
        aggs.append((F.sum(after) / 1024 ** 2).alias("mb_after"))
    out = df.agg(*aggs)
    if narrowed_types is not None:
        out = out.withColumn("pct_saved", F.lit(100.0) * (F.col("mb_before") - F.col("mb_after"))
                             / F.col("mb_before"))
    return out


# --- sorts / top-k ---------------------------------------------------------------

def sort_by_key(df: DataFrame, *cols: str) -> DataFrame:
    """G1: range-partitioned global sort; use only at a sink."""
    return df.orderBy(*cols)


def head_n(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First n rows in key order (TakeOrderedAndProject: top-n per
    partition, then n per partition merged)."""
    return df.orderBy(*order).limit(n)


def top_importances(imp: DataFrame, n: int = 30, feature_col: str = "feature",
                    value_col: str = "importance") -> DataFrame:
    """The n features with the highest mean importance."""
    mean = imp.groupBy(feature_col).agg(F.avg(value_col).alias(value_col))
    return mean.orderBy(F.desc(value_col), feature_col).limit(n)


def best_trial(trials: DataFrame, score_col: str = "rmse", key_col: str = "trial") -> DataFrame:
    """The trial with the lowest score (ties: smallest key)."""
    return trials.orderBy(F.col(score_col).asc_nulls_last(), key_col).limit(1)
