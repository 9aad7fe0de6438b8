"""Joins of the panel to its dimensions and between forecasts (ops D1-D9).

Broadcast is used only for the calendar (one row per day by construction).
Everything else is left to the planner; with AQE on, a side measured small at
run time still becomes a broadcast, and skewed sort-merge partitions are split
(``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRICE_KEYS = ["store_id", "item_id", "wm_yr_wk"]


def join_calendar(panel: DataFrame, calendar: DataFrame, how: str = "inner",
                  on: str = "d") -> DataFrame:
    """D1 (inner) / D3 (left): panel x calendar on ``d``.

    ``calendar`` should come from ``views.calendar_for_join`` (broadcast).
    Columns of the calendar that the panel already carries are taken from
    the panel.
    """
    cal_cols = [c for c in calendar.columns if c == on or c not in panel.columns]
    return panel.join(calendar.select(*cal_cols), on, how)


def join_prices(panel: DataFrame, prices: DataFrame, how: str = "inner") -> DataFrame:
    """D2 (inner: days without a price row vanish) / D4 (left: they stay, NULL).

    Prices grow with (items x stores x weeks), so this is a shuffle join on
    the three keys unless AQE measures the price side small.
    """
    return panel.join(prices, PRICE_KEYS, how)


#: Columns that make a series, its price history and the layout of both.
SERIES_KEYS = ["item_id", "store_id"]


def join_series_prices(panel: DataFrame, prices: DataFrame, how: str = "inner") -> DataFrame:
    """D2 / D4 on the layout that the price features need.

    The prices of a series are one row, a map from week to price (at most one
    entry per calendar week; a week given twice raises).  Panel and prices
    then meet on (item, store) alone, so a window over the same keys
    (``W.series_window(SERIES_KEYS)``) reuses the join's exchange and, in a
    sort-merge join, its order: the panel is shuffled once for the join and
    all price features (F10-F13).  ``join_prices`` on the three keys needs a
    second exchange, but splits a series over many tasks.
    """
    week, price = PRICE_KEYS[-1], "sell_price"
    by_series = prices.groupBy(*SERIES_KEYS).agg(
        F.map_from_entries(F.collect_list(F.struct(week, price))).alias("_prices"))
    # Merge, not broadcast: the window above reuses its partitioning and sort.
    out = panel.join(by_series.hint("merge"), SERIES_KEYS, how)
    if how == "inner":
        out = out.where(F.map_contains_key("_prices", F.col(week)))
    return out.withColumn(price, F.col("_prices")[F.col(week)]).drop("_prices")


def join_product_left(ids: DataFrame, product: DataFrame, id_col: str = "id",
                      suffix_from: str = "_evaluation$", suffix_to: str = "_validation") -> DataFrame:
    """Evaluation ids take the attributes of their validation twin."""
    key = F.regexp_replace(F.col(id_col), suffix_from, suffix_to)
    left = ids.withColumn("_key", key)
    right = product.withColumnRenamed(id_col, "_key")
    return left.join(right, "_key", "left").drop("_key")


def join_template_inner(template_ids: DataFrame, preds: DataFrame, on: str = "id") -> DataFrame:
    """Keep the predictions of the template ids only."""
    return template_ids.select(on).join(preds, on, "inner")


def join_full_outer(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join on the key columns (merged key columns)."""
    return a.join(b, keys, "full")


def join_group_stat_back(df: DataFrame, keys: list[str], col: str, out: str,
                         agg=F.avg) -> DataFrame:
    """A per-group statistic attached to every detail row.

    Written as a partial + final aggregation joined back on the keys, not as
    a window partitioned by the group: a group holding a large share of the
    rows is pre-reduced inside each map task, the aggregated side has one
    row per group (AQE broadcasts it when small), and a skewed join
    partition is split by AQE.  Rows with a NULL key get NULL (pandas drops
    NULL group keys as well).
    """
    stat = df.groupBy(*keys).agg(agg(col).alias(out))
    return df.join(stat, keys, "left")


def anti_keys(rows: DataFrame, holdout: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are not in the holdout."""
    return rows.join(holdout.select(*keys), keys, "left_anti")
