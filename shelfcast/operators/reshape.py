"""Wide <-> long reshaping and horizon scaffolding (ops B1-B10).

``unpivot`` is a narrow Expand (no shuffle); ``pivot`` with listed values is
one hash aggregation keyed by id (partial aggregation before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.strings import extract_day_number
from shelfcast.operators.ordering import global_row_number


def day_columns(df: DataFrame, prefix: str = "d_") -> list[str]:
    """B2: value columns chosen by name prefix, in day order."""
    cols = [c for c in df.columns if c.startswith(prefix) and c[len(prefix):].isdigit()]
    return sorted(cols, key=lambda c: int(c[len(prefix):]))


def unpivot_days(df: DataFrame, id_cols: list[str], value_cols: list[str] | None = None,
                 var_name: str = "d", value_name: str = "sales") -> DataFrame:
    """B1 (B2 when ``value_cols`` is None): wide day columns -> (d, value) rows.

    NULL cells are kept (pandas ``melt`` keeps NaN).
    """
    values = value_cols or day_columns(df)
    return df.unpivot(id_cols, values, var_name, value_name)


def with_day_number(df: DataFrame, d_col: str = "d", out: str = "d_num") -> DataFrame:
    return df.withColumn(out, extract_day_number(d_col))


def extend_horizon_wide(df: DataFrame, last_day: int, horizon: int = 28,
                        prefix: str = "d_") -> DataFrame:
    """B3 (wide form): append ``horizon`` empty day columns after ``last_day``."""
    new = [F.lit(None).cast("double").alias(f"{prefix}{d}")
           for d in range(last_day + 1, last_day + horizon + 1)]
    return df.select("*", *new)


def extend_horizon_long(series: DataFrame, id_cols: list[str], last_day: int,
                        horizon: int = 28, value_name: str = "sales") -> DataFrame:
    """B3 (long form): one NULL row per series and future day.

    A generator per series (``explode(sequence)``), not a cross join.
    """
    days = F.explode(F.sequence(F.lit(last_day + 1), F.lit(last_day + horizon)))
    return (series.select(*id_cols).distinct()
                  .select(*id_cols, days.alias("d_num"))
                  .withColumn("d", F.concat(F.lit("d_"), F.col("d_num").cast("string")))
                  .withColumn(value_name, F.lit(None).cast("double")))


def training_window(df: DataFrame, tr_last: int, max_lags: int, first_day: int,
                    is_train: bool, day_col: str = "d_num") -> DataFrame:
    """First day = max(1 if training else tr_last - max_lags, first_day)."""
    start = max(1 if is_train else tr_last - max_lags, first_day)
    return df.where(F.col(day_col) >= start)


def pivot_horizon(df: DataFrame, id_col: str = "id", label_col: str = "F",
                  value_col: str = "sales", horizon: int = 28,
                  prefix: str = "F") -> DataFrame:
    """Long (id, F{n}, value) -> wide id x F1..F{horizon}.

    The pivot values are listed, so no extra job collects them.
    """
    labels = [f"{prefix}{i}" for i in range(1, horizon + 1)]
    return df.groupBy(id_col).pivot(label_col, labels).agg(F.max(value_col))


def pivot_dates(df: DataFrame, id_col: str = "id", date_col: str = "date",
                value_col: str = "demand", horizon: int = 28) -> DataFrame:
    """Long by date -> wide, columns renamed F1.. in date order.

    The F label is the rank of the date among the distinct forecast dates:
    a ``dense_rank`` over the distinct dates (at most ``horizon`` rows, so
    the un-partitioned window is tiny) broadcast back.
    """
    dates = (df.select(date_col).distinct()
               .select(date_col, F.concat(F.lit("F"), F.dense_rank().over(
                   Window.orderBy(date_col)).cast("string")).alias("F")))
    labelled = df.join(F.broadcast(dates), date_col)
    return pivot_horizon(labelled, id_col, "F", value_col, horizon)


def template_to_days(wide: DataFrame, suffix: str, first_day: int,
                     horizon: int = 28, id_col: str = "id") -> DataFrame:
    """Rows whose id ends in ``suffix``, F1..F{h} renamed d_{first_day}..."""
    part = wide.where(F.col(id_col).endswith(suffix))
    cols = [F.col(f"F{i}").alias(f"d_{first_day + i - 1}") for i in range(1, horizon + 1)]
    return part.select(id_col, *cols)


def label_parts(parts: dict[str, DataFrame], col: str = "part") -> DataFrame:
    """Tag each frame with its part name and stack them by column name."""
    out = None
    for name, df in parts.items():
        tagged = df.withColumn(col, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def tail_after_n(df: DataFrame, n: int, day_col: str = "d_num", id_col: str = "id") -> DataFrame:
    """Drop the first ``n`` rows in (day, id) order; keep the rest.

    No global sort of the table: rows per day are counted (one row per day),
    cumulative counts find the cut day; whole days before it are dropped by
    a plain filter and only the cut day's rows are numbered, with the
    distributed ``global_row_number``.
    """
    per_day = df.groupBy(day_col).agg(F.count(F.lit(1)).alias("_n"))
    # One row per day: the un-partitioned running sum is bounded by the
    # number of days, not by the data volume.
    cum = per_day.select(day_col, F.sum("_n").over(Window.orderBy(day_col).rowsBetween(
        Window.unboundedPreceding, 0)).alias("_cum"))
    # Whole days inside the first n rows are dropped; the first day whose
    # running count passes n is cut, losing its first r rows in id order.
    # Both values from one scalar subquery: the cut day and the rows before it.
    cut = cum.agg(F.struct(
        F.min(F.when(F.col("_cum") > n, F.col(day_col))).alias("day"),
        F.coalesce(F.max(F.when(F.col("_cum") <= n, F.col("_cum"))), F.lit(0)).alias("before")
    )).scalar()
    tagged = df.withColumn("_cut", cut)
    after = tagged.where(F.col(day_col) > F.col("_cut.day")).drop("_cut")
    on_cut = tagged.where(F.col(day_col) == F.col("_cut.day"))
    numbered = global_row_number(on_cut, [id_col], out="_rn")
    kept = numbered.where(F.col("_rn") > F.lit(n) - F.col("_cut.before")).drop("_rn", "_cut")
    return after.unionByName(kept)


def zip_columns(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Put two frames side by side, aligned on explicit keys (Spark has
    no row position; the reference's index alignment becomes a key join)."""
    return left.join(right, keys, "inner")
