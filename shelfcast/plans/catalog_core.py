"""Registered queries: scans (A1, A4, A9), aggregates and checks (E*), sorts
(G1, G2) and scalar functions (I*)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions import dates as D
from shelfcast.functions import numeric as N
from shelfcast.functions import strings as S
from shelfcast.operators import aggs as A
from shelfcast.operators import encode as E
from shelfcast.operators import windows as W
from shelfcast.plans.catalog_reshape import (
    _FEATS_SQL, _TEMPLATE_SQL, FDAY, FDAY_NUM, HORIZON, _feats, _template_ids)
from shelfcast.plans.oracle_views import with_views
from shelfcast.plans.registry import register
from shelfcast.plans.sqlfrag import over, rolling
from shelfcast.session import cut_lineage
from shelfcast.sources import sinks as SK
from shelfcast.sources import tables as TB
from shelfcast.sources import views as V

LINEITEM_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()),
    T.StructField("l_partkey", T.LongType()),
    T.StructField("l_quantity", T.DoubleType()),
    T.StructField("l_shipdate", T.TimestampNTZType()),
])


# -- A1 / A4 / A9 -----------------------------------------------------------------

@register("scan_typed", """
SELECT l_orderkey, l_partkey, l_quantity, CAST(l_shipdate AS DATE) AS ship_date FROM lineitem""")
def q_scan_typed(spark, sf_dir):
    # The table as a delimited file, read back with the declared schema.
    cols = [f.name for f in LINEITEM_SCHEMA.fields]
    path = SK.output_path(spark, "lineitem-csv")
    TB.read_table(spark, sf_dir, "lineitem", cols).write.option("header", True).csv(path)
    df = TB.scan_typed(spark, path, LINEITEM_SCHEMA)
    return df.select("l_orderkey", "l_partkey", "l_quantity",
                     F.to_date("l_shipdate").alias("ship_date"))


def _narrow_plan_sql(table: str, cols: list[tuple[str, str]]) -> str:
    parts = []
    for c, kind in cols:
        lo, hi = f"CAST(min({c}) AS DOUBLE)", f"CAST(max({c}) AS DOUBLE)"
        if kind == "float":
            choice = (f"CASE WHEN {lo} > -3.4028234663852886e38 AND {hi} < 3.4028234663852886e38 "
                      "THEN 'float' ELSE 'double' END")
        else:
            choice = (f"CASE WHEN {lo} > -128 AND {hi} < 127 THEN 'tinyint' "
                      f"WHEN {lo} > -32768 AND {hi} < 32767 THEN 'smallint' "
                      f"WHEN {lo} > -2147483648 AND {hi} < 2147483647 THEN 'int' ELSE 'bigint' END")
        parts.append(f"SELECT '{c}' AS \"column\", {lo} AS min_value, {hi} AS max_value, "
                     f"{choice} AS narrow_type FROM {table}")
    return "\nUNION ALL\n".join(parts)


_ORDERS_NUM = [("o_orderkey", "int"), ("o_custkey", "int"), ("o_totalprice", "float")]


@register("scan_inferred", _narrow_plan_sql("orders", _ORDERS_NUM))
def q_scan_inferred(spark, sf_dir):
    path = SK.output_path(spark, "orders-csv")
    TB.read_table(spark, sf_dir, "orders", [c for c, _ in _ORDERS_NUM]).write.option("header", True).csv(path)
    df = TB.scan_inferred(spark, path)
    return E.narrow_plan(df, [c for c, _ in _ORDERS_NUM])


@register("profile_table", with_views("v_sales") + """
SELECT count(*) AS n_rows, 4 AS n_cols, min(date) AS min_date, max(date) AS max_date,
       count(DISTINCT id) AS n_series FROM v_sales""")
def q_profile_table(spark, sf_dir):
    return A.profile_table(V.v_sales(spark, sf_dir))


# -- E* ---------------------------------------------------------------------------

_GROUP_KEYS = ["dept_id", "store_id", "cat_id", "state_id", "date"]


@register("group_mean_multi", with_views("v_panel") + f"""
SELECT {', '.join(_GROUP_KEYS)}, avg(lag_1) AS Sales_1 FROM (
  SELECT *, lag(sales, 1) {over()} AS lag_1 FROM v_panel) GROUP BY ALL""")
def q_group_mean_multi(spark, sf_dir):
    df = W.lag_features(V.v_panel(spark, sf_dir), (1,))
    return A.group_mean_multi(df, _GROUP_KEYS, "lag_1", "Sales_1")


@register("daily_mean_compare", with_views("v_sales", extra=[_FEATS_SQL]) + f"""
SELECT d_num, avg(rmean_7_7) AS mean_recursive, avg(lag_7) AS mean_one_step, avg(sales) AS mean_actual
FROM feats GROUP BY d_num""")
def q_daily_mean_compare(spark, sf_dir):
    return A.daily_mean_compare(_feats(spark, sf_dir), {"rmean_7_7": "mean_recursive", "lag_7": "mean_one_step",
                                        "sales": "mean_actual"}, date_col="d_num")


@register("column_min_max", with_views("v_panel") + """
SELECT min(d_num) AS d_num_min, max(d_num) AS d_num_max, min(sales) AS sales_min,
       max(sales) AS sales_max FROM v_panel""")
def q_column_min_max(spark, sf_dir):
    return A.column_min_max(V.v_panel(spark, sf_dir))


@register("count_distinct_ids", with_views("v_panel") +
          "SELECT count(DISTINCT id) AS n_distinct_ids FROM v_panel")
def q_count_distinct_ids(spark, sf_dir):
    return A.count_distinct_ids(V.v_panel(spark, sf_dir))


@register("count_matching", with_views("v_panel", extra=[_TEMPLATE_SQL]) +
          "SELECT count(*) FILTER (WHERE regexp_matches(id, 'validation$')) AS n_matching FROM template")
def q_count_matching(spark, sf_dir):
    return A.count_matching(_template_ids(spark, sf_dir), "id", "validation$")


@register("count_nulls", with_views("v_wide_user") + "SELECT " + " + ".join(
    f"count(*) FILTER (WHERE d_{d} IS NULL)" for d in range(1, V.EVENTS_DAYS + 1)) +
    " AS n_nulls FROM v_wide_user")
def q_count_nulls(spark, sf_dir):
    return A.count_nulls(V.v_wide(spark, sf_dir, "user_id"), exclude=["id"])


@register("check_id_alignment", with_views("v_panel", extra=[_TEMPLATE_SQL]) + f"""
, sub AS (SELECT DISTINCT id FROM v_panel WHERE date >= DATE '{FDAY}')
, net AS (SELECT id, sum(s) AS d FROM (
    SELECT id, 1 AS s FROM template UNION ALL SELECT id, -1 AS s FROM sub) GROUP BY id)
SELECT CAST(coalesce(sum(CASE WHEN d > 0 THEN d END), 0) AS BIGINT) AS only_left,
       CAST(coalesce(sum(CASE WHEN d < 0 THEN -d END), 0) AS BIGINT) AS only_right,
       coalesce(sum(CASE WHEN d > 0 THEN d END), 0) = 0
         AND coalesce(sum(CASE WHEN d < 0 THEN -d END), 0) = 0 AS aligned
FROM net""")
def q_check_id_alignment(spark, sf_dir):
    sub = V.v_panel(spark, sf_dir).where(F.col("date") >= F.lit(FDAY).cast("date")) \
        .select("id").distinct()
    return A.check_id_alignment(_template_ids(spark, sf_dir), sub)


@register("rmse_mse", with_views("v_sales", extra=[_FEATS_SQL]) + """
SELECT id, round(avg(power(sales - rmean_7_7, 2)), 6) AS mse,
       round(sqrt(avg(power(sales - rmean_7_7, 2))), 6) AS rmse,
       count(power(sales - rmean_7_7, 2)) AS n
FROM feats GROUP BY id""")
def q_rmse_mse(spark, sf_dir):
    out = A.rmse_mse(_feats(spark, sf_dir), "sales", "rmean_7_7", keys=["id"])
    return out.select("id", F.round("mse", 6).alias("mse"), F.round("rmse", 6).alias("rmse"), "n")


@register("absolute_error", with_views("v_sales", extra=[_FEATS_SQL]) +
          "SELECT id, d_num, abs(rmean_7_7 - sales) AS abs_error FROM feats")
def q_absolute_error(spark, sf_dir):
    f = _feats(spark, sf_dir)
    return f.select("id", "d_num", N.abs_error("rmean_7_7", "sales").alias("abs_error"))




@register("memory_estimate", with_views("v_panel") + f"""
SELECT round(sum(w_before) / 1048576.0, 9) AS mb_before, round(sum(w_after) / 1048576.0, 9) AS mb_after,
       round(100.0 * (sum(w_before) - sum(w_after)) / sum(w_before), 9) AS pct_saved
FROM (SELECT strlen(id) + strlen(item_id) + strlen(dept_id) + strlen(cat_id) + strlen(store_id)
             + strlen(state_id) + strlen(d) + 4 + 4 + 8 AS w_before,
             strlen(id) + strlen(item_id) + strlen(dept_id) + strlen(cat_id) + strlen(store_id)
             + strlen(state_id) + strlen(d) + 2 + 4 + 4 AS w_after
      FROM v_panel)""")
def q_memory_estimate(spark, sf_dir):
    panel = cut_lineage(V.v_panel(spark, sf_dir))
    narrow = {r["column"]: r["narrow_type"] for r in E.narrow_plan(panel).collect()}  # a row per column
    out = A.memory_estimate(panel, narrow)
    return out.select(*[F.round(c, 9).alias(c) for c in out.columns])


# -- G1 / G2 ------------------------------------------------------------------------

@register("sort_by_key", with_views("v_sales") + "SELECT id, d_num, sales FROM v_sales ORDER BY id, d_num")
def q_sort_by_key(spark, sf_dir):
    return A.sort_by_key(V.v_sales(spark, sf_dir).select("id", "d_num", "sales"), "id", "d_num")


@register("head_n", with_views("v_sales") +
          "SELECT id, d_num, sales FROM v_sales ORDER BY id, d_num LIMIT 10")
def q_head_n(spark, sf_dir):
    return A.head_n(V.v_sales(spark, sf_dir).select("id", "d_num", "sales"), 10, "id", "d_num")


# -- I* ---------------------------------------------------------------------------

@register("parse_date", """
SELECT DISTINCT strftime(l_shipdate, '%Y-%m-%d') AS date_str,
       CAST(strftime(l_shipdate, '%Y-%m-%d') AS DATE) AS date FROM lineitem""")
def q_parse_date(spark, sf_dir):
    li = TB.read_table(spark, sf_dir, "lineitem", ["l_shipdate"])
    s = li.select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("date_str")).distinct()
    return s.select("date_str", D.parse_date("date_str", "yyyy-MM-dd").alias("date"))


@register("date_parts", with_views("v_sales", "v_calendar") + """
SELECT s.id, s.d_num, CAST(c.wday AS SMALLINT) AS wday, CAST(weekofyear(s.date) AS SMALLINT) AS week,
       CAST(c.month AS SMALLINT) AS month, CAST(quarter(s.date) AS SMALLINT) AS quarter,
       CAST(c.year AS SMALLINT) AS year, CAST(dayofmonth(s.date) AS SMALLINT) AS mday,
       CAST(isodow(s.date) - 1 AS SMALLINT) AS dow_mon0
FROM v_sales s JOIN v_calendar c USING (d_num)""")
def q_date_parts(spark, sf_dir):
    cal = V.calendar_for_join(spark).select("d_num", "wday", "month", "year")
    df = V.v_sales(spark, sf_dir).join(cal, "d_num")
    out = D.date_parts(df, "date", keep_given=True)
    return out.select("id", "d_num", "wday", "week", "month", "quarter", "year", "mday",
                      D.weekday_mon0(F.col("date")).cast("short").alias("dow_mon0"))


_FLAGS_SQL = """
SELECT DISTINCT CAST(l_shipdate AS DATE) AS date,
  CAST(CAST(l_shipdate AS DATE) = date_trunc('year', CAST(l_shipdate AS DATE)) AS TINYINT) AS is_year_start,
  CAST(month(l_shipdate) = 12 AND dayofmonth(l_shipdate) = 31 AS TINYINT) AS is_year_end,
  CAST(CAST(l_shipdate AS DATE) = date_trunc('quarter', CAST(l_shipdate AS DATE)) AS TINYINT) AS is_quarter_start,
  CAST(CAST(l_shipdate AS DATE) = CAST(date_trunc('quarter', CAST(l_shipdate AS DATE)) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS TINYINT) AS is_quarter_end,
  CAST(dayofmonth(l_shipdate) = 1 AS TINYINT) AS is_month_start,
  CAST(CAST(l_shipdate AS DATE) = last_day(CAST(l_shipdate AS DATE)) AS TINYINT) AS is_month_end,
  CAST(isodow(l_shipdate) IN (6, 7) AS TINYINT) AS is_weekend
FROM lineitem"""


@register("period_flags", _FLAGS_SQL)
def q_period_flags(spark, sf_dir):
    li = TB.read_table(spark, sf_dir, "lineitem", ["l_shipdate"])
    days = li.select(F.to_date("l_shipdate").alias("date")).distinct()
    return D.period_flags(days).withColumn("is_weekend", D.is_weekend(F.col("date")))


@register("is_weekend", with_views("v_sales") + """
SELECT id, d_num, CAST(isodow(date) IN (6, 7) AS TINYINT) AS is_weekend FROM v_sales""")
def q_is_weekend(spark, sf_dir):
    return V.v_sales(spark, sf_dir).select("id", "d_num", D.is_weekend(F.col("date")).alias("is_weekend"))


@register("suffix_keys", with_views("v_panel") + """
SELECT DISTINCT id, TRY_CAST(right(store_id, 1) AS SMALLINT) AS store_num,
       TRY_CAST(right(dept_id, 1) AS SMALLINT) AS dept_num,
       TRY_CAST(right(item_id, 2) AS SMALLINT) AS item_num FROM v_panel""")
def q_suffix_keys(spark, sf_dir):
    p = V.v_panel(spark, sf_dir).select("id", "store_id", "dept_id", "item_id").distinct()
    return p.select("id", S.suffix_key("store_id", 1).alias("store_num"),
                    S.suffix_key("dept_id", 1).alias("dept_num"),
                    S.suffix_key("item_id", 2).alias("item_num"))


@register("extract_day_number", with_views("v_panel") +
          "SELECT id, d, CAST(regexp_extract(d, '^d_(\\d+)$', 1) AS INTEGER) AS day_number FROM v_panel")
def q_extract_day_number(spark, sf_dir):
    p = V.v_panel(spark, sf_dir)
    return p.select("id", "d", S.extract_day_number("d").alias("day_number"))


@register("rewrite_suffix", with_views("v_panel") + """
SELECT DISTINCT regexp_replace(id, 'validation$', 'evaluation') AS id FROM v_panel""")
def q_rewrite_suffix(spark, sf_dir):
    return V.v_panel(spark, sf_dir).select(S.rewrite_suffix("id").alias("id")).distinct()


@register("format_labels", with_views("v_sales") + f"""
SELECT id, d_num, 'd_' || CAST(d_num AS VARCHAR) AS d_label,
       'F' || CAST((d_num - 1) % {HORIZON} + 1 AS VARCHAR) AS f_label,
       'lag_' || CAST(7 AS VARCHAR) AS lag_label
FROM v_sales""")
def q_format_labels(spark, sf_dir):
    s = V.v_sales(spark, sf_dir)
    return s.select("id", "d_num", S.format_label("d_", F.col("d_num")).alias("d_label"),
                    S.format_label("F", (F.col("d_num") - 1) % HORIZON + 1).alias("f_label"),
                    S.format_label("lag_", F.lit(7)).alias("lag_label"))


@register("numeric_cast", with_views("v_panel", "v_calendar") + """
SELECT p.id, p.d_num, CAST(c.snap_CA AS SMALLINT) AS snap_CA, CAST(c.snap_TX AS SMALLINT) AS snap_TX,
       CAST(c.snap_WI AS SMALLINT) AS snap_WI
FROM v_panel p JOIN v_calendar c USING (d)""")
def q_numeric_cast(spark, sf_dir):
    cal = V.calendar_for_join(spark).select("d", "snap_CA", "snap_TX", "snap_WI")
    df = V.v_panel(spark, sf_dir).select("id", "d", "d_num").join(cal, "d").drop("d")
    return N.numeric_cast(df, ["snap_CA", "snap_TX", "snap_WI"], "short")


@register("round_half_even", with_views("v_sales") + f"""
SELECT id, d_num, round_even({rolling('sales', 'avg', 28, 7)}, 1) AS rmean_7_28_r1,
       round_even({rolling('sales', 'avg', 7, 7)}, 2) AS rmean_7_7_r2
FROM v_sales""")
def q_round_half_even(spark, sf_dir):
    s = V.v_sales(spark, sf_dir).select("id", "d_num", "sales")
    w = W.series_window()
    return s.select("id", "d_num",
                    N.round_half_even(W.rolling("sales", F.avg, 28, w, 7), 1).alias("rmean_7_28_r1"),
                    N.round_half_even(W.rolling("sales", F.avg, 7, w, 7), 2).alias("rmean_7_7_r2"))


@register("abs_sqrt", with_views("v_sales", extra=[_FEATS_SQL]) + """
SELECT id, d_num, abs(sales - lag_7) AS abs_diff, round(sqrt(sales), 9) AS sqrt_sales FROM feats""")
def q_abs_sqrt(spark, sf_dir):
    f = _feats(spark, sf_dir)
    return f.select("id", "d_num", F.abs(F.col("sales") - F.col("lag_7")).alias("abs_diff"),
                    F.round(F.sqrt("sales"), 9).alias("sqrt_sales"))


@register("date_offset", with_views("v_sales") + f"""
SELECT id, CAST(DATE '{FDAY}' + INTERVAL (h) DAY AS DATE) AS date,
       CAST(DATE '{FDAY}' + INTERVAL (h) DAY - INTERVAL 57 DAY AS DATE) AS history_from
FROM (SELECT DISTINCT id FROM v_sales), range({HORIZON}) t(h)""")
def q_date_offset(spark, sf_dir):
    ids = V.v_sales(spark, sf_dir).select("id").distinct()
    days = ids.select("id", F.explode(D.horizon_dates(F.lit(FDAY).cast("date"), HORIZON)).alias("date"))
    return days.withColumn("history_from", D.date_offset(F.col("date"), -57))

