"""Registered queries for the window features (F1-F16) and the flagship."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.operators import joins as J
from shelfcast.operators import windows as W
from shelfcast.plans import features as FE
from shelfcast.plans.oracle_views import with_views
from shelfcast.plans.registry import register
from shelfcast.plans.sqlfrag import over, rolling, rolling_moment
from shelfcast.session import cut_lineage
from shelfcast.sources import views as V

# Fixed forecast origin used by the horizon labels (28 days before the last
# shipping day in the test data).
FDAY = "2001-10-08"


def _priced_panel(spark, sf_dir):
    """v_panel inner-joined to weekly prices (drops unpriced days, §1.4.1), on
    the layout of the price windows."""
    panel, prices = V.panel_and_prices(spark, sf_dir)
    rows = panel.select("id", *J.SERIES_KEYS, "d_num", V.wm_yr_wk(F.col("d_num")).alias("wm_yr_wk"))
    return J.join_series_prices(rows, prices, how="inner")




_PRICED_PANEL_SQL = """priced AS (
  SELECT p.*, pr.sell_price FROM
    (SELECT *, CAST(floor(d_num / 7) + 1 AS INTEGER) AS wm_yr_wk FROM v_panel) p
  JOIN v_prices pr USING (item_id, store_id, wm_yr_wk))"""


# -- flagship (entry) --------------------------------------------------------

_FS_COLS = ["lag_7", "lag_28", "rmean_7_7", "rmean_7_28", "rmean_28_7", "rmean_28_28"]
_FS_SQL = with_views("v_sales", extra=[f"""feats AS (
  SELECT id, d_num, sales,
    lag(sales, 7) {over()} AS lag_7, lag(sales, 28) {over()} AS lag_28,
    {rolling('sales', 'avg', 7, 7)} AS rmean_7_7,
    {rolling('sales', 'avg', 28, 7)} AS rmean_7_28,
    {rolling('sales', 'avg', 7, 28)} AS rmean_28_7,
    {rolling('sales', 'avg', 28, 28)} AS rmean_28_28
  FROM v_sales)"""]) + f"""
SELECT id, count(*) AS n_rows, sum(sales) AS sum_sales,
  {', '.join(f'round(avg({c}), 6) AS avg_{c}' for c in _FS_COLS)}
FROM feats
WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _FS_COLS)}
GROUP BY id"""


@register("feature_summary", _FS_SQL)
def q_feature_summary(spark, sf_dir):
    return FE.feature_summary(V.v_sales(spark, sf_dir))


# -- F1 -------------------------------------------------------------------------

@register("lag_sales", with_views("v_sales") + f"""
SELECT id, d_num, sales,
  lag(sales, 1) {over()} AS lag_1, lag(sales, 2) {over()} AS lag_2,
  lag(sales, 7) {over()} AS lag_7, lag(sales, 28) {over()} AS lag_28
FROM v_sales""")
def q_lag_sales(spark, sf_dir):
    df = V.v_sales(spark, sf_dir).select("id", "d_num", "sales")
    return W.lag_features(df, (1, 2, 7, 28))


# -- F2 / F3 / F4 -----------------------------------------------------------------

@register("rolling_mean_of_lag", with_views("v_sales") + f"""
SELECT id, d_num,
  {rolling('sales', 'avg', 7, 7)} AS rmean_7_7,
  {rolling('sales', 'avg', 28, 7)} AS rmean_7_28,
  {rolling('sales', 'avg', 7, 28)} AS rmean_28_7,
  {rolling('sales', 'avg', 28, 28)} AS rmean_28_28
FROM v_sales""")
def q_rolling_mean_of_lag(spark, sf_dir):
    df = V.v_sales(spark, sf_dir).select("id", "d_num", "sales")
    return W.rolling_mean_of_lag(df, (7, 28), (7, 28), integral=True).drop("sales")


@register("rolling_mean_rounded", with_views("v_sales") + f"""
SELECT id, d_num,
  round_even({rolling('sales', 'avg', 7, 1)}, 2) AS rmean_1_7,
  round_even({rolling('sales', 'avg', 28, 1)}, 2) AS rmean_1_28,
  round_even({rolling('sales', 'avg', 7, 7)}, 2) AS rmean_7_7,
  round_even({rolling('sales', 'avg', 28, 7)}, 2) AS rmean_7_28
FROM v_sales""")
def q_rolling_mean_rounded(spark, sf_dir):
    df = V.v_sales(spark, sf_dir).select("id", "d_num", "sales")
    return W.rolling_mean_of_lag(df, (1, 7), (7, 28), round_to=2, integral=True).drop("sales")


@register("rolling_std_of_lag", with_views("v_sales") + f"""
SELECT id, d_num,
  round({rolling('sales', 'stddev_samp', 7, 1)}, 6) AS rstd_1_7,
  round({rolling('sales', 'stddev_samp', 30, 1)}, 6) AS rstd_1_30
FROM v_sales""")
def q_rolling_std_of_lag(spark, sf_dir):
    df = V.v_sales(spark, sf_dir).select("id", "d_num", "sales")
    out = W.rolling_std_of_lag(df, 1, (7, 30), integral=True)
    return out.select("id", "d_num", *[F.round(c, 6).alias(c) for c in ("rstd_1_7", "rstd_1_30")])


# -- F5-F9 on the panel (demand = daily units) ------------------------------------

def _panel_demand(spark, sf_dir):
    return V.v_panel(spark, sf_dir).select("id", "d_num", F.col("sales").alias("demand"))


_PANEL_DEMAND = "pd AS (SELECT id, d_num, sales AS demand FROM v_panel)"


@register("shift_horizon", with_views("v_panel", extra=[_PANEL_DEMAND]) + f"""
SELECT id, d_num, demand,
  lag(demand, 28) {over()} AS shift_t28,
  lag(demand, 29) {over()} AS shift_t29,
  lag(demand, 30) {over()} AS shift_t30
FROM pd""")
def q_shift_horizon(spark, sf_dir):
    return W.shift_horizon(_panel_demand(spark, sf_dir), 28, (0, 1, 2))


_MEAN_WINS = (7, 30, 60, 90, 180)


@register("rolling_mean_horizon", with_views("v_panel", extra=[_PANEL_DEMAND]) + """
SELECT id, d_num, """ + ",\n  ".join(
    f"{rolling('demand', 'avg', k, 28)} AS rolling_mean_t{k}" for k in _MEAN_WINS) + """
FROM pd""")
def q_rolling_mean_horizon(spark, sf_dir):
    out = W.rolling_horizon_features(_panel_demand(spark, sf_dir), 28, _MEAN_WINS, (), None,
                                     integral=True)
    return out.drop("demand")


@register("rolling_std_horizon", with_views("v_panel", extra=[_PANEL_DEMAND]) + """
SELECT id, d_num, """ + ",\n  ".join(
    f"round({rolling('demand', 'stddev_samp', k, 28)}, 6) AS rolling_std_t{k}"
    for k in _MEAN_WINS) + """
FROM pd""")
def q_rolling_std_horizon(spark, sf_dir):
    out = W.rolling_horizon_features(_panel_demand(spark, sf_dir), 28, (), _MEAN_WINS, None,
                                     integral=True)
    return out.select("id", "d_num", *[F.round(f"rolling_std_t{k}", 6).alias(f"rolling_std_t{k}")
                                       for k in _MEAN_WINS])


@register("rolling_skew_horizon", with_views("v_panel", extra=[_PANEL_DEMAND]) + f"""
SELECT id, d_num, round({rolling_moment('demand', 'skewness', 30, 28)}, 6) AS rolling_skew_t30
FROM pd""")
def q_rolling_skew_horizon(spark, sf_dir):
    out = W.rolling_horizon_features(_panel_demand(spark, sf_dir), 28, (), (), 30, integral=True)
    return out.select("id", "d_num", F.round("rolling_skew_t30", 6).alias("rolling_skew_t30"))


@register("rolling_kurt_horizon", with_views("v_panel", extra=[_PANEL_DEMAND]) + f"""
SELECT id, d_num, round({rolling_moment('demand', 'kurtosis', 30, 28)}, 6) AS rolling_kurt_t30
FROM pd""")
def q_rolling_kurt_horizon(spark, sf_dir):
    out = W.rolling_horizon_features(_panel_demand(spark, sf_dir), 28, (), (), 30, integral=True)
    return out.select("id", "d_num", F.round("rolling_kurt_t30", 6).alias("rolling_kurt_t30"))


# -- F10-F13 price features -----------------------------------------------------

@register("price_delta", with_views("v_panel", "v_prices", extra=[_PRICED_PANEL_SQL]) + f"""
SELECT id, d_num, sell_price, lag(sell_price, 1) {over()} - sell_price AS delta_price
FROM priced""")
def q_price_delta(spark, sf_dir):
    df = _priced_panel(spark, sf_dir)
    return W.price_delta(df, w=W.series_window(J.SERIES_KEYS)).select("id", "d_num", "sell_price", "delta_price")


@register("price_change_rel", with_views("v_panel", "v_prices", extra=[_PRICED_PANEL_SQL]) + f"""
SELECT id, d_num,
  (lag(sell_price, 1) {over()} - sell_price) / lag(sell_price, 1) {over()} AS price_change_t1
FROM priced""")
def q_price_change_rel(spark, sf_dir):
    df = _priced_panel(spark, sf_dir)
    return W.price_change_features(df, std_wins=(), w=W.series_window(J.SERIES_KEYS)).select("id", "d_num", "price_change_t1")


@register("price_change_year", with_views("v_panel", "v_prices", extra=[_PRICED_PANEL_SQL]) + f"""
SELECT id, d_num,
  ({rolling('sell_price', 'max', 365, 1)} - sell_price) / {rolling('sell_price', 'max', 365, 1)}
    AS price_change_t365
FROM priced""")
def q_price_change_year(spark, sf_dir):
    df = _priced_panel(spark, sf_dir)
    return W.price_change_features(df, std_wins=(), w=W.series_window(J.SERIES_KEYS)).select("id", "d_num", "price_change_t365")


@register("rolling_price_std", with_views("v_panel", "v_prices", extra=[_PRICED_PANEL_SQL]) + f"""
SELECT id, d_num,
  round({rolling('sell_price', 'stddev_samp', 7)}, 6) AS rolling_price_std_t7,
  round({rolling('sell_price', 'stddev_samp', 30)}, 6) AS rolling_price_std_t30
FROM priced""")
def q_rolling_price_std(spark, sf_dir):
    df = _priced_panel(spark, sf_dir)
    out = W.price_change_features(df, std_wins=(7, 30), w=W.series_window(J.SERIES_KEYS))
    return out.select("id", "d_num", *[F.round(f"rolling_price_std_t{k}", 6)
                                       .alias(f"rolling_price_std_t{k}") for k in (7, 30)])


# -- F14 -------------------------------------------------------------------------

_GROUP_KEYS = ["dept_id", "store_id", "cat_id", "state_id", "date"]


@register("group_mean_rolling", with_views("v_panel") + f"""
, lagged AS (SELECT *, lag(sales, 1) {over()} AS lag_1 FROM v_panel)
, grouped AS (SELECT *, avg(lag_1) OVER (PARTITION BY {', '.join(_GROUP_KEYS)}) AS Sales_1 FROM lagged)
SELECT id, d_num, Sales_1, round_even({rolling('Sales_1', 'avg', 7)}, 2) AS rmean_Sales_1_7
FROM grouped""")
def q_group_mean_rolling(spark, sf_dir):
    # Written once: the group means and the rows they join back to read it.
    panel = V.v_panel(spark, sf_dir).select("id", "d_num", "sales", *_GROUP_KEYS)
    df = cut_lineage(W.lag_features(panel, (1,)))
    out = W.group_mean_rolling(df, _GROUP_KEYS, "lag_1")
    return out.select("id", "d_num", "Sales_1", "rmean_Sales_1_7")


# -- F15 / F16 --------------------------------------------------------------------

@register("horizon_rank", with_views("v_sales") + f"""
SELECT id, d_num, 'F' || CAST(row_number() {over()} AS VARCHAR) AS F, sales
FROM v_sales WHERE date >= DATE '{FDAY}'""")
def q_horizon_rank(spark, sf_dir):
    df = V.v_sales(spark, sf_dir).where(F.col("date") >= F.lit(FDAY).cast("date"))
    return W.horizon_rank(df).select("id", "d_num", "F", "sales")


@register("head_per_group", with_views("v_sales") + f"""
SELECT id, d_num, sales FROM (
  SELECT id, d_num, sales, row_number() {over()} AS rn FROM v_sales) WHERE rn <= 20""")
def q_head_per_group(spark, sf_dir):
    df = V.v_sales(spark, sf_dir).select("id", "d_num", "sales")
    return W.head_per_group(df, 20)
