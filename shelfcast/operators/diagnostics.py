"""Time-series diagnostics per series (ops M1, M2).

M1: the autocorrelation of every series for lags 0..n as one Spark job:
centre by the series mean (window over the series), take n+1 lags in one
Window operator, sum the products per series (partial + final aggregate) and
unpivot.  No self-join, no pairs.

M2: the partial autocorrelation from the n+1 ACF values of a series by the
Durbin-Levinson recursion, as one fold over the array of those values; the
array never leaves the row, so there is no second shuffle and no Python.

A constant series has no variance: its ACF and PACF are NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _acf_arrays(df: DataFrame, nlags: int, id_col: str, order_col: str, value_col: str) -> DataFrame:
    """(id, acf): array of the autocorrelations of lags 0..nlags."""
    ordered = Window.partitionBy(id_col).orderBy(order_col)
    # The mean over the whole series, on the same spec as the lags (one sort).
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    centred = df.select(id_col, order_col,
                        (F.col(value_col) - F.avg(value_col).over(whole)).alias("_x"))
    lagged = centred.select(id_col, "_x", *[F.lag("_x", k).over(ordered).alias(f"_l{k}")
                                            for k in range(nlags + 1)])
    sums = lagged.groupBy(id_col).agg(
        F.sum(F.col("_x") * F.col("_x")).alias("_den"),
        *[F.sum(F.col("_x") * F.col(f"_l{k}")).alias(f"_n{k}") for k in range(nlags + 1)])
    return sums.select(id_col, F.array(*[F.try_divide(F.col(f"_n{k}"), F.col("_den"))
                                         for k in range(nlags + 1)]).alias("acf"))


def _by_lag(df: DataFrame, id_col: str, values: str, nlags: int) -> DataFrame:
    lags = F.sequence(F.lit(0).cast("long"), F.lit(nlags).cast("long"))
    return df.select(id_col, F.inline(F.arrays_zip(lags.alias("lag"), F.col(values).alias(values))))


def acf(df: DataFrame, nlags: int = 40, id_col: str = "id", order_col: str = "d_num",
        value_col: str = "sales") -> DataFrame:
    """(id, lag, acf) with acf_k = sum_t x_t x_{t-k} / sum_t x_t^2, x centred;
    NULL for a constant series."""
    return _by_lag(_acf_arrays(df, nlags, id_col, order_col, value_col), id_col, "acf", nlags)


def durbin_levinson(r: str, nlags: int) -> Column:
    """PACF array of lags 0..nlags from the array column of autocorrelations.

    The state holds phi (coefficients of the current order), the PACF so far
    and the remaining variance; a NULL anywhere, or no variance left, makes
    the rest NULL.
    """
    arr = F.col(r)
    zero = F.array().cast("array<double>")
    start = F.struct(zero.alias("phi"), F.array(arr[0]).alias("out"), F.lit(1.0).alias("var"))

    def dot(a: Column, k: Column) -> Column:  # sum of phi_j * r_(k-j), j = 1..k-1
        prod = F.transform(a, lambda x, i: x * F.get(arr, k - 1 - i))
        return F.aggregate(prod, F.lit(0.0), lambda s, x: s + x)

    def step(st: Column, k: Column) -> Column:
        phi = st["phi"]
        a = F.try_divide(F.get(arr, k) - dot(phi, k), st["var"])
        turned = F.reverse(phi)
        new = F.concat(F.transform(phi, lambda x, i: x - a * F.get(turned, i)), F.array(a))
        return F.struct(new.alias("phi"), F.concat(st["out"], F.array(a)).alias("out"),
                        (st["var"] * (F.lit(1.0) - a * a)).alias("var"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(nlags)), start, step, lambda st: st["out"])


def pacf(df: DataFrame, nlags: int = 40, id_col: str = "id", order_col: str = "d_num",
         value_col: str = "sales") -> DataFrame:
    """M2: (id, lag, pacf) of every series."""
    arrays = _acf_arrays(df, nlags, id_col, order_col, value_col)
    return _by_lag(arrays.select(id_col, durbin_levinson("acf", nlags).alias("pacf")), id_col, "pacf", nlags)
