"""Registered queries: reshaping (B*), projections/filters (C*), joins (D*),
set operations (H*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.operators import joins as J
from shelfcast.operators import project as P
from shelfcast.operators import reshape as R
from shelfcast.operators import split as K
from shelfcast.operators import windows as W
from shelfcast.plans.oracle_views import with_views
from shelfcast.plans.registry import register
from shelfcast.plans.sqlfrag import over, rolling
from shelfcast.sources import tables as TB
from shelfcast.session import cut_lineage
from shelfcast.sources import views as V

# Fixed run parameters (the reference's tr_last / fday / max_lags / first_day).
TR_LAST = 2500            # d_num of the last shipping day, 2001-11-04
FDAY = "2001-10-08"       # forecast origin for the horizon operators
FDAY_NUM = 2473
MAX_LAGS = 57
FIRST_DAY = 1200
HORIZON = 28
EV_DAYS = V.EVENTS_DAYS


def _unpivot_sql(view: str, days: range, extra: str = "") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT id, 'd_{d}' AS d, d_{d} AS sales{extra} FROM {view}" for d in days)


# -- A2 / A3 / A5 / B1-B3 on the wide tables --------------------------------------

@register("scan_pruned", with_views("v_wide_user") +
          f"SELECT id, {', '.join(f'd_{d}' for d in range(5, 21))} FROM v_wide_user")
def q_scan_pruned(spark, sf_dir):
    return TB.scan_pruned(V.v_wide(spark, sf_dir, "user_id"), ["id"], first_day=5, last_day=20)


@register("scan_limited", with_views("v_wide_user") +
          "SELECT * FROM v_wide_user ORDER BY id LIMIT 10")
def q_scan_limited(spark, sf_dir):
    return TB.scan_limited(V.v_wide(spark, sf_dir, "user_id"), ["id"], 10)


_TEMPLATE_SQL = """template AS (
  SELECT DISTINCT id FROM v_panel
  UNION ALL
  SELECT DISTINCT regexp_replace(id, 'validation$', 'evaluation') FROM v_panel)"""


def _template_ids(spark, sf_dir):
    ids = V.v_panel(spark, sf_dir).select("id").distinct()
    return P.replicate_with_new_id(ids)


@register("scan_template", with_views("v_panel", extra=[_TEMPLATE_SQL]) + "SELECT id FROM template")
def q_scan_template(spark, sf_dir):
    return TB.scan_template(_template_ids(spark, sf_dir))


@register("unpivot_days", with_views("v_wide_user") + _unpivot_sql("v_wide_user", range(1, EV_DAYS + 1)))
def q_unpivot_days(spark, sf_dir):
    wide = V.v_wide(spark, sf_dir, "user_id")
    return R.unpivot_days(wide, ["id"], [f"d_{d}" for d in range(1, EV_DAYS + 1)])


@register("unpivot_by_prefix", with_views("v_wide") + "SELECT id, d, sales, "
          "CAST(substr(d, 3) AS INTEGER) AS d_num FROM (" + _unpivot_sql("v_wide", range(1, EV_DAYS + 1)) + ")")
def q_unpivot_by_prefix(spark, sf_dir):
    wide = V.v_wide(spark, sf_dir, "event_type")
    return R.with_day_number(R.unpivot_days(wide, ["id"]))


@register("extend_horizon", with_views("v_wide") + "SELECT id, d, sales FROM (" +
          _unpivot_sql("v_wide", range(1, EV_DAYS + 1)) + "\nUNION ALL\n" +
          "\nUNION ALL\n".join(f"SELECT id, 'd_{d}' AS d, CAST(NULL AS DOUBLE) AS sales FROM v_wide"
                               for d in range(EV_DAYS + 1, EV_DAYS + HORIZON + 1)) + ")")
def q_extend_horizon(spark, sf_dir):
    wide = R.extend_horizon_wide(V.v_wide(spark, sf_dir, "event_type"), EV_DAYS, HORIZON)
    return R.unpivot_days(wide, ["id"])


@register("extend_horizon_long", with_views("v_sales") + f"""
SELECT id, d_num, sales FROM v_sales
UNION ALL
SELECT id, CAST(unnest(range({TR_LAST + 1}, {TR_LAST + HORIZON + 1})) AS INTEGER) AS d_num,
       CAST(NULL AS DOUBLE) AS sales
FROM (SELECT DISTINCT id FROM v_sales)""")
def q_extend_horizon_long(spark, sf_dir):
    hist = V.v_sales(spark, sf_dir).select("id", "d_num", "sales")
    fut = R.extend_horizon_long(hist, ["id"], TR_LAST, HORIZON).select("id", "d_num", "sales")
    return hist.unionByName(fut)


@register("training_window", with_views("v_sales") + f"""
SELECT id, d_num, sales FROM v_sales WHERE d_num >= {max(TR_LAST - MAX_LAGS, FIRST_DAY)}""")
def q_training_window(spark, sf_dir):
    # The day bound reaches the scan as a filter on the ship timestamp.
    df = V.v_sales(spark, sf_dir, max(TR_LAST - MAX_LAGS, FIRST_DAY)).select("id", "d_num", "sales")
    return R.training_window(df, TR_LAST, MAX_LAGS, FIRST_DAY, is_train=False)


# -- B5-B7 pivots ----------------------------------------------------------------

_H_LABELS = ", ".join(f"max(sales) FILTER (WHERE F = 'F{i}') AS F{i}" for i in range(1, HORIZON + 1))
_LABELLED_SALES = f"""lab AS (
  SELECT id, sales, 'F' || CAST(row_number() {over()} AS VARCHAR) AS F
  FROM v_sales WHERE date >= DATE '{FDAY}')"""


@register("pivot_horizon", with_views("v_sales", extra=[_LABELLED_SALES]) +
          f"SELECT id, {_H_LABELS} FROM lab GROUP BY id")
def q_pivot_horizon(spark, sf_dir):
    df = V.v_sales(spark, sf_dir).where(F.col("date") >= F.lit(FDAY).cast("date"))
    return R.pivot_horizon(W.horizon_rank(df), "id", "F", "sales", HORIZON)


_LABELLED_DATES = f"""lab AS (
  SELECT id, sales, 'F' || CAST(dense_rank() OVER (ORDER BY date) AS VARCHAR) AS F
  FROM v_sales WHERE date >= DATE '{FDAY}')"""


@register("pivot_dates", with_views("v_sales", extra=[_LABELLED_DATES]) +
          f"SELECT id, {_H_LABELS} FROM lab GROUP BY id")
def q_pivot_dates(spark, sf_dir):
    df = V.v_sales(spark, sf_dir).where(F.col("date") >= F.lit(FDAY).cast("date"))
    return R.pivot_dates(df, "id", "date", "sales", HORIZON)


def _panel_wide(spark, sf_dir):
    df = V.v_panel(spark, sf_dir).where(F.col("date") >= F.lit(FDAY).cast("date"))
    return R.pivot_horizon(W.horizon_rank(df), "id", "F", "sales", HORIZON)


_PANEL_WIDE = f"""pw AS (
  SELECT id, {_H_LABELS} FROM (
    SELECT id, sales, 'F' || CAST(row_number() {over()} AS VARCHAR) AS F
    FROM v_panel WHERE date >= DATE '{FDAY}') GROUP BY id)"""


@register("template_to_days", with_views("v_panel", extra=[_PANEL_WIDE]) + f"""
SELECT id, {', '.join(f'F{i} AS d_{TR_LAST + HORIZON + i}' for i in range(1, HORIZON + 1))}
FROM (SELECT * FROM pw UNION ALL
      SELECT * REPLACE (regexp_replace(id, 'validation$', 'evaluation') AS id) FROM pw)
WHERE id LIKE '%evaluation'""")
def q_template_to_days(spark, sf_dir):
    wide = P.replicate_with_new_id(_panel_wide(spark, sf_dir))
    return R.template_to_days(wide, "evaluation", TR_LAST + HORIZON + 1, HORIZON)


# -- B8-B10 ----------------------------------------------------------------------

_PARTS_SQL = f"""parts AS (
  SELECT id, d_num, sales, 'train' AS part FROM v_sales WHERE d_num <= {TR_LAST - HORIZON}
  UNION ALL
  SELECT id, d_num, sales, 'validation' AS part FROM v_sales WHERE d_num > {TR_LAST - HORIZON}
  UNION ALL
  SELECT id, CAST(unnest(range({TR_LAST + 1}, {TR_LAST + HORIZON + 1})) AS INTEGER) AS d_num,
         CAST(NULL AS DOUBLE) AS sales, 'evaluation' AS part
  FROM (SELECT DISTINCT id FROM v_sales))"""


def _parts(spark, sf_dir):
    s = V.v_sales(spark, sf_dir).select("id", "d_num", "sales")
    fut = R.extend_horizon_long(s, ["id"], TR_LAST, HORIZON).select("id", "d_num", "sales")
    return R.label_parts({"train": s.where(F.col("d_num") <= TR_LAST - HORIZON),
                          "validation": s.where(F.col("d_num") > TR_LAST - HORIZON),
                          "evaluation": fut})


@register("label_parts", with_views("v_sales", extra=[_PARTS_SQL]) + "SELECT * FROM parts")
def q_label_parts(spark, sf_dir):
    return _parts(spark, sf_dir)


@register("tail_after_n", with_views("v_sales") + """
SELECT id, d_num, sales FROM (
  SELECT id, d_num, sales, row_number() OVER (ORDER BY d_num, id) AS rn FROM v_sales)
WHERE rn > 1000""")
def q_tail_after_n(spark, sf_dir):
    return R.tail_after_n(cut_lineage(V.v_sales(spark, sf_dir).select("id", "d_num", "sales")), 1000)


@register("zip_columns", with_views("v_sales") + f"""
SELECT id, d_num, lag(sales, 7) {over()} AS lag_7, {rolling('sales', 'avg', 7, 7)} AS rmean_7_7
FROM v_sales""")
def q_zip_columns(spark, sf_dir):
    s = V.v_sales(spark, sf_dir).select("id", "d_num", "sales")
    lags = W.lag_features(s, (7,)).select("id", "d_num", "lag_7")
    means = W.rolling_mean_of_lag(s, (7,), (7,)).select("id", "d_num", "rmean_7_7")
    return R.zip_columns(lags, means, ["id", "d_num"])


# -- C* --------------------------------------------------------------------------

@register("drop_columns", with_views("v_panel") +
          "SELECT id, item_id, store_id, state_id, d, d_num, date, sales FROM v_panel")
def q_drop_columns(spark, sf_dir):
    return P.drop_columns(V.v_panel(spark, sf_dir), ["dept_id", "cat_id"])


_USELESS = ["id", "date", "sales", "d", "wm_yr_wk", "weekday"]


@register("select_except", with_views("v_panel", "v_calendar") + """
SELECT p.item_id, p.dept_id, p.cat_id, p.store_id, p.state_id, p.d_num,
       c.wday, c.month, c.year, c.event_name_1, c.event_type_1, c.event_name_2, c.event_type_2,
       c.snap_CA, c.snap_TX, c.snap_WI
FROM v_panel p JOIN v_calendar c USING (d)""")
def q_select_except(spark, sf_dir):
    joined = J.join_calendar(V.v_panel(spark, sf_dir), V.calendar_for_join(spark))
    return P.select_except(joined, _USELESS)


@register("select_named", with_views("v_panel") + "SELECT id, date, sales FROM v_panel")
def q_select_named(spark, sf_dir):
    return P.select_named(V.v_panel(spark, sf_dir), ["id", "date", "sales"])


@register("rename_columns", with_views("v_panel") +
          "SELECT id, dept_id AS dept_dept_id, cat_id AS dept_cat_id, sales FROM v_panel")
def q_rename_columns(spark, sf_dir):
    df = V.v_panel(spark, sf_dir).select("id", "dept_id", "cat_id", "sales")
    return P.rename_columns(df, prefix="dept_", cols=["dept_id", "cat_id"])


@register("filter_history_window", with_views("v_sales") + f"""
SELECT * FROM v_sales WHERE date BETWEEN DATE '{FDAY}' - INTERVAL {MAX_LAGS} DAY AND DATE '{FDAY}'""")
def q_filter_history_window(spark, sf_dir):
    return P.filter_history_window(V.v_sales(spark, sf_dir), FDAY, MAX_LAGS)


@register("filter_day", with_views("v_sales") + f"SELECT id, sales FROM v_sales WHERE date = DATE '{FDAY}'")
def q_filter_day(spark, sf_dir):
    return P.filter_day(V.v_sales(spark, sf_dir), FDAY, ["id", "sales"])


@register("filter_from_date", with_views("v_sales") +
          f"SELECT id, sales FROM v_sales WHERE date >= DATE '{FDAY}'")
def q_filter_from_date(spark, sf_dir):
    return P.filter_from_date(V.v_sales(spark, sf_dir), FDAY, ["id", "sales"])


@register("filter_equal", with_views("v_sales") + "SELECT * FROM v_sales WHERE id = 'Brand#13'")
def q_filter_equal(spark, sf_dir):
    return P.filter_equal(V.v_sales(spark, sf_dir), "id", "Brand#13")


@register("filter_contains", with_views("v_panel") +
          "SELECT * FROM v_panel WHERE contains(id, 'Brand#1') AND contains(id, 'STORE_2')")
def q_filter_contains(spark, sf_dir):
    return P.filter_contains(V.v_panel(spark, sf_dir), "id", "Brand#1", "STORE_2")


@register("filter_suffix", with_views("v_panel", extra=[_TEMPLATE_SQL]) +
          "SELECT id FROM template WHERE suffix(id, 'validation')")
def q_filter_suffix(spark, sf_dir):
    return P.filter_suffix(_template_ids(spark, sf_dir), "id", "validation")


@register("filter_not_equal", with_views("v_sales", extra=[_PARTS_SQL]) +
          "SELECT * FROM parts WHERE part <> 'evaluation'")
def q_filter_not_equal(spark, sf_dir):
    return P.filter_not_equal(_parts(spark, sf_dir), "part", "evaluation")


_FEATS_SQL = f"""feats AS (
  SELECT id, d_num, sales, lag(sales, 7) {over()} AS lag_7, lag(sales, 28) {over()} AS lag_28,
         {rolling('sales', 'avg', 7, 7)} AS rmean_7_7
  FROM v_sales)"""


def _feats(spark, sf_dir):
    s = V.v_sales(spark, sf_dir).select("id", "d_num", "sales")
    w = W.series_window()
    return W.rolling_mean_of_lag(W.lag_features(s, (7, 28), w=w), (7,), (7,), w=w)


@register("drop_nulls", with_views("v_sales", extra=[_FEATS_SQL]) +
          "SELECT * FROM feats WHERE lag_7 IS NOT NULL AND lag_28 IS NOT NULL AND rmean_7_7 IS NOT NULL")
def q_drop_nulls(spark, sf_dir):
    return P.drop_nulls(_feats(spark, sf_dir))


@register("fill_nulls", with_views("v_sales", extra=[_FEATS_SQL]) +
          "SELECT id, d_num, sales, coalesce(lag_7, 0.0) AS lag_7, coalesce(lag_28, 0.0) AS lag_28, "
          "coalesce(rmean_7_7, 0.0) AS rmean_7_7 FROM feats")
def q_fill_nulls(spark, sf_dir):
    return P.fill_nulls(_feats(spark, sf_dir), 0.0, ["lag_7", "lag_28", "rmean_7_7"])


@register("is_not_null", with_views("v_sales", "v_calendar") + """
SELECT s.id, s.date, s.sales, c.event_name_1 FROM v_sales s JOIN v_calendar c ON s.date = c.date
WHERE c.event_name_1 IS NOT NULL""")
def q_is_not_null(spark, sf_dir):
    cal = V.calendar_for_join(spark).select("date", "event_name_1")
    s = V.v_sales(spark, sf_dir).select("id", "date", "sales")
    return s.join(cal, "date").where(P.is_not_null("event_name_1")).select("id", "date", "sales", "event_name_1")


@register("conditional_update", with_views("v_sales", extra=[_FEATS_SQL]) + f"""
SELECT id, d_num,
  CASE WHEN d_num = {FDAY_NUM} AND rmean_7_7 IS NOT NULL THEN rmean_7_7 ELSE sales END AS sales,
  sales AS sales_original
FROM feats""")
def q_conditional_update(spark, sf_dir):
    feats = _feats(spark, sf_dir)
    base = P.copy_column(feats.select("id", "d_num", "sales"), "sales", "sales_original")
    preds = feats.where(F.col("d_num") == FDAY_NUM).select("id", "d_num", F.col("rmean_7_7").alias("pred"))
    return P.conditional_update(base, preds, ["id", "d_num"], "sales", "pred")


@register("copy_column", with_views("v_sales") + "SELECT id, d_num, sales, sales AS sales_original FROM v_sales")
def q_copy_column(spark, sf_dir):
    return P.copy_column(V.v_sales(spark, sf_dir).select("id", "d_num", "sales"), "sales", "sales_original")


@register("time_cutoff_split", with_views("v_sales") + f"""
SELECT id, d_num, CASE WHEN date <= DATE '{FDAY}' THEN 'train' ELSE 'test' END AS part FROM v_sales""")
def q_time_cutoff_split(spark, sf_dir):
    s = V.v_sales(spark, sf_dir).select("id", "d_num", "date")
    train, test = P.time_cutoff_split(s, FDAY)
    return (train.select("id", "d_num", F.lit("train").alias("part"))
                 .unionByName(test.select("id", "d_num", F.lit("test").alias("part"))))


# -- D* --------------------------------------------------------------------------

@register("join_calendar_inner", with_views("v_panel", "v_calendar") + """
SELECT p.id, p.d, p.sales, c.wm_yr_wk, c.wday, c.event_name_1, c.snap_CA
FROM v_panel p JOIN v_calendar c USING (d)""")
def q_join_calendar_inner(spark, sf_dir):
    p = V.v_panel(spark, sf_dir).select("id", "d", "sales")
    cal = V.calendar_for_join(spark).select("d", "wm_yr_wk", "wday", "event_name_1", "snap_CA")
    return J.join_calendar(p, cal, "inner")


_PANEL_DAYS_SQL = f"""pdays AS (
  SELECT id, 'd_' || CAST(d_num AS VARCHAR) AS d, sales FROM v_sales
  UNION ALL
  SELECT id, 'd_' || CAST(unnest(range({TR_LAST + 1}, {TR_LAST + HORIZON + 1})) AS VARCHAR) AS d,
         CAST(NULL AS DOUBLE) AS sales
  FROM (SELECT DISTINCT id FROM v_sales))"""


@register("join_calendar_left", with_views("v_sales", "v_calendar", extra=[_PANEL_DAYS_SQL]) + """
SELECT p.id, CAST(substr(p.d, 3) AS INTEGER) AS d_num, p.sales, c.wday, c.event_name_1
FROM pdays p LEFT JOIN v_calendar c USING (d)""")
def q_join_calendar_left(spark, sf_dir):
    s = V.v_sales(spark, sf_dir).select("id", "d_num", "sales")
    fut = R.extend_horizon_long(s, ["id"], TR_LAST, HORIZON).select("id", "d_num", "sales")
    days = s.unionByName(fut).select(
        "id", F.concat(F.lit("d_"), F.col("d_num").cast("string")).alias("d"), "sales")
    cal = V.calendar_for_join(spark).select("d", "wday", "event_name_1")
    out = R.with_day_number(J.join_calendar(days, cal, "left"))
    return out.select("id", "d_num", "sales", "wday", "event_name_1")


_PANEL_WK = "pw AS (SELECT *, CAST(floor(d_num / 7) + 1 AS INTEGER) AS wm_yr_wk FROM v_panel)"


def _panel_and_prices(spark, sf_dir):
    panel, prices = V.panel_and_prices(spark, sf_dir)
    return panel.withColumn("wm_yr_wk", V.wm_yr_wk(F.col("d_num"))), prices


@register("join_prices_inner", with_views("v_panel", "v_prices", extra=[_PANEL_WK]) + """
SELECT id, d_num, sales, sell_price FROM pw JOIN v_prices USING (store_id, item_id, wm_yr_wk)""")
def q_join_prices_inner(spark, sf_dir):
    out = J.join_prices(*_panel_and_prices(spark, sf_dir), "inner")
    return out.select("id", "d_num", "sales", "sell_price")


@register("join_prices_left", with_views("v_panel", "v_prices", extra=[_PANEL_WK]) + """
SELECT id, d_num, sales, sell_price FROM pw LEFT JOIN v_prices USING (store_id, item_id, wm_yr_wk)""")
def q_join_prices_left(spark, sf_dir):
    out = J.join_prices(*_panel_and_prices(spark, sf_dir), "left")
    return out.select("id", "d_num", "sales", "sell_price")


_PRODUCT_SQL = """product AS (
  SELECT DISTINCT id, item_id, dept_id, cat_id, store_id, state_id FROM v_panel)"""


@register("join_product_left", with_views("v_panel", extra=[_TEMPLATE_SQL, _PRODUCT_SQL]) + """
SELECT t.id, p.item_id, p.dept_id, p.cat_id, p.store_id, p.state_id
FROM template t LEFT JOIN product p ON regexp_replace(t.id, '_evaluation$', '_validation') = p.id""")
def q_join_product_left(spark, sf_dir):
    product = V.v_panel(spark, sf_dir).select(
        "id", "item_id", "dept_id", "cat_id", "store_id", "state_id").distinct()
    return J.join_product_left(_template_ids(spark, sf_dir), product)


@register("join_template_inner", with_views("v_panel", extra=[_TEMPLATE_SQL]) + f"""
SELECT t.id, p.d_num, p.sales FROM template t JOIN v_panel p ON t.id = p.id
WHERE p.date >= DATE '{FDAY}'""")
def q_join_template_inner(spark, sf_dir):
    preds = V.v_panel(spark, sf_dir).where(F.col("date") >= F.lit(FDAY).cast("date")) \
        .select("id", "d_num", "sales")
    return J.join_template_inner(_template_ids(spark, sf_dir), preds)


@register("join_full_outer", with_views("v_sales", extra=[_FEATS_SQL]) + f"""
SELECT id, d_num, a.pred1, b.pred2 FROM
  (SELECT id, d_num, rmean_7_7 AS pred1 FROM feats WHERE rmean_7_7 < sales) a
FULL OUTER JOIN
  (SELECT id, d_num, lag_7 AS pred2 FROM feats WHERE lag_7 < sales) b
USING (id, d_num)""")
def q_join_full_outer(spark, sf_dir):
    """The days on which either forecast was too low, over all rows."""
    feats = _feats(spark, sf_dir)
    a = feats.where("rmean_7_7 < sales").select("id", "d_num", F.col("rmean_7_7").alias("pred1"))
    b = feats.where("lag_7 < sales").select("id", "d_num", F.col("lag_7").alias("pred2"))
    return J.join_full_outer(a, b, ["id", "d_num"])


_GROUP_KEYS = ["dept_id", "store_id", "cat_id", "state_id", "date"]


@register("join_group_stat_back", with_views("v_panel") + f"""
SELECT id, d_num, sales, avg(sales) OVER (PARTITION BY {', '.join(_GROUP_KEYS)}) AS group_mean
FROM v_panel""")
def q_join_group_stat_back(spark, sf_dir):
    # Written once: the means and the rows they join back to read it.
    p = cut_lineage(V.v_panel(spark, sf_dir).select("id", "d_num", "sales", *_GROUP_KEYS))
    out = J.join_group_stat_back(p, _GROUP_KEYS, "sales", "group_mean")
    return out.select("id", "d_num", "sales", "group_mean")


_HASH = "CAST(('0x' || substr(md5({k}), 1, 8)) AS BIGINT)"


def hash_sql(*cols: str) -> str:
    key = " || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return _HASH.format(k=key)


@register("anti_keys", with_views("v_panel") + f"""
SELECT id, d_num FROM v_panel
WHERE NOT ({hash_sql('id', 'd_num')} % 100 < 25)""")
def q_anti_keys(spark, sf_dir):
    p = V.v_panel(spark, sf_dir).select("id", "d_num")
    holdout = K.holdout_fraction(p, 25, ["id", "d_num"]).where("is_holdout")
    return J.anti_keys(p, holdout, ["id", "d_num"])


# -- H* --------------------------------------------------------------------------

@register("union_all_by_name", with_views("v_sales", extra=[_PARTS_SQL]) +
          "SELECT id, d_num, sales FROM parts WHERE part = 'train' UNION ALL "
          "SELECT id, d_num, sales FROM parts WHERE part = 'train'")
def q_union_all_by_name(spark, sf_dir):
    parts = _parts(spark, sf_dir).where(F.col("part") == "train").select("id", "d_num", "sales")
    return P.union_all_by_name(parts, parts.select("sales", "d_num", "id"))


@register("set_difference", with_views("v_panel") + f"""
SELECT DISTINCT id FROM v_panel
EXCEPT
SELECT DISTINCT id FROM v_panel WHERE {hash_sql('id')} % 100 < 25""")
def q_set_difference(spark, sf_dir):
    p = V.v_panel(spark, sf_dir).select("id")
    return P.set_difference(p, K.holdout_fraction(p, 25, ["id"]).where("is_holdout"), ["id"])


@register("replicate_with_new_id", with_views("v_panel", extra=[_PANEL_WIDE]) + """
SELECT * FROM pw UNION ALL
SELECT * REPLACE (regexp_replace(id, 'validation$', 'evaluation') AS id) FROM pw""")
def q_replicate_with_new_id(spark, sf_dir):
    return P.replicate_with_new_id(_panel_wide(spark, sf_dir))
