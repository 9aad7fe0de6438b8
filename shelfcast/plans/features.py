"""Feature pipelines built from the operators (the reference's create_fea)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import windows as W

DEFAULT_LAGS = (7, 28)
DEFAULT_WINS = (7, 28)


def demand_features(df: DataFrame, lags=DEFAULT_LAGS, wins=DEFAULT_WINS,
                    id_col: str = "id", order_col: str = "d_num",
                    col: str = "sales", integral: bool = True) -> DataFrame:
    """lag_{L} and rmean_{L}_{k} for the cross product, one window group.

    Units sold are whole numbers, so by default the rolling means use the
    exact running-total form (O(rows) instead of O(rows x window))."""
    w = W.series_window(id_col, order_col)
    out = W.lag_features(df, lags, col=col, w=w)
    return W.rolling_mean_of_lag(out, lags, wins, col=col, w=w, integral=integral)


def feature_summary(df: DataFrame, lags=DEFAULT_LAGS, wins=DEFAULT_WINS) -> DataFrame:
    """Flagship: features of v_sales, NULL warm-up rows dropped, then the
    per-series mean of every feature (partial + final hash aggregate on the
    partitioning the window already produced: no second exchange)."""
    feats = demand_features(df, lags, wins).na.drop("any")
    names = [f"lag_{l}" for l in lags] + [f"rmean_{l}_{k}" for l in lags for k in wins]
    return feats.groupBy("id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("sales").alias("sum_sales"),
        *[F.round(F.avg(n), 6).alias(f"avg_{n}") for n in names])
