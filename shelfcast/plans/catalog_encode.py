"""Registered queries: encoders (J*), splits (K*), autocorrelation (M1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.operators import diagnostics as M
from shelfcast.operators import encode as E
from shelfcast.operators import split as K
from shelfcast.plans.catalog_reshape import hash_sql
from shelfcast.plans.oracle_views import with_views
from shelfcast.plans.registry import register
from shelfcast.session import cut_lineage
from shelfcast.sources import views as V

_PANEL_CAL = """pc AS (
  SELECT p.id, p.d_num, p.item_id, p.store_id, c.event_name_1
  FROM v_panel p JOIN v_calendar c USING (d))"""


def _panel_cal(spark, sf_dir):
    cal = V.calendar_for_join(spark).select("d", "event_name_1")
    return V.v_panel(spark, sf_dir).select("id", "d", "d_num", "item_id", "store_id") \
        .join(cal, "d").drop("d")


_CODES = """codes_{c} AS (
  SELECT {c}, CAST(row_number() OVER (ORDER BY {c}) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT {c} FROM pc WHERE {c} IS NOT NULL))"""


def _codes_sql(cols):
    return [_CODES.format(c=c) for c in cols]


_J_COLS = ["item_id", "store_id", "event_name_1"]


@register("category_codes", with_views("v_panel", "v_calendar", extra=[_PANEL_CAL] + _codes_sql(_J_COLS)) +
          "SELECT pc.id, pc.d_num, " + ", ".join(
              f"CAST(coalesce(codes_{c}.code, -1) + (SELECT max(CAST({c} IS NULL AS INTEGER)) FROM pc) "
              f"AS INTEGER) AS {c}" for c in _J_COLS) + " FROM pc " + " ".join(
              f"LEFT JOIN codes_{c} ON pc.{c} = codes_{c}.{c}" for c in _J_COLS))
def q_category_codes(spark, sf_dir):
    out = E.category_codes(_panel_cal(spark, sf_dir), _J_COLS)
    return out.select("id", "d_num", *_J_COLS)


@register("label_encode_keep_null", with_views("v_panel", "v_calendar", extra=[_PANEL_CAL] + _codes_sql(_J_COLS)) +
          "SELECT pc.id, pc.d_num, " + ", ".join(f"codes_{c}.code AS {c}" for c in _J_COLS) +
          " FROM pc " + " ".join(f"LEFT JOIN codes_{c} ON pc.{c} = codes_{c}.{c}" for c in _J_COLS))
def q_label_encode_keep_null(spark, sf_dir):
    out = E.label_encode_keep_null(_panel_cal(spark, sf_dir), _J_COLS)
    return out.select("id", "d_num", *_J_COLS)


_STORES = [f"STORE_{i}" for i in range(5)]
_CATS = [f"CAT_{i}" for i in range(3)]


@register("one_hot_prefixed", with_views("v_panel") + "SELECT id, d_num, " + ", ".join(
    f"CAST(store_id = '{s}' AS TINYINT) AS store_{s}" for s in _STORES) + " FROM v_panel")
def q_one_hot_prefixed(spark, sf_dir):
    p = V.v_panel(spark, sf_dir).select("id", "d_num", "store_id")
    return E.one_hot(p, "store_id", prefix="store_", drop=True)


@register("one_hot_plain", with_views("v_panel") + "SELECT id, d_num, " + ", ".join(
    f"CAST(cat_id = '{c}' AS TINYINT) AS {c}" for c in _CATS) + " FROM v_panel")
def q_one_hot_plain(spark, sf_dir):
    p = V.v_panel(spark, sf_dir).select("id", "d_num", "cat_id")
    return E.one_hot(p, "cat_id", drop=True)


@register("one_hot_wide", """
WITH v AS (SELECT CAST(l_partkey AS VARCHAR) AS part FROM lineitem),
c AS (SELECT part, CAST(row_number() OVER (ORDER BY part) - 1 AS INTEGER) AS idx, count(*) OVER () AS size
      FROM (SELECT DISTINCT part FROM v))
SELECT l_orderkey, l_linenumber, CAST(size AS INTEGER) AS size, idx AS one_at
FROM lineitem JOIN c ON part = CAST(l_partkey AS VARCHAR)""")
def q_one_hot_wide(spark, sf_dir):
    """One-hot over all part keys: the size of the sparse row and the place of
    its one; nothing is collected and the schema does not grow."""
    from shelfcast.sources.tables import read_table
    lines = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey"]).select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"))
    rows = E.one_hot_sparse(lines, "part")
    return rows.select("l_orderkey", "l_linenumber", F.col("one_hot.size").alias("size"),
                       F.col("one_hot.index").alias("one_at"))


@register("binary_encode", with_views("v_panel") + "SELECT DISTINCT item_id, " + ", ".join(
    f"CAST((CAST(regexp_extract(item_id, '#(\\d+)$', 1) AS BIGINT) >> {9 - i}) & 1 AS TINYINT) AS item_bin_{i}"
    for i in range(10)) + " FROM v_panel")
def q_binary_encode(spark, sf_dir):
    p = V.v_panel(spark, sf_dir).select("item_id").distinct()
    p = p.withColumn("_n", F.regexp_extract("item_id", r"#(\d+)$", 1).cast("long"))
    return E.binary_encode(p, "_n", 10, prefix="item_bin_").drop("_n")


_FEAT_TABLE = f"""ft AS (
  SELECT d_num, sales, CAST(d_num % 7 AS INTEGER) AS dow, sales * 1000.0 AS sales_k,
         CAST(d_num AS BIGINT) * 100000 AS big
  FROM v_panel)"""


@register("narrow_types", with_views("v_panel", extra=[_FEAT_TABLE]) + """
SELECT CAST(d_num AS SMALLINT) AS d_num, CAST(sales AS FLOAT) AS sales, CAST(dow AS TINYINT) AS dow,
       CAST(sales_k AS FLOAT) AS sales_k, CAST(big AS INTEGER) AS big FROM ft""")
def q_narrow_types(spark, sf_dir):
    """The table cast to the narrowest types that its own ranges allow."""
    p = V.v_panel(spark, sf_dir)
    ft = p.select("d_num", "sales", (F.col("d_num") % 7).cast("int").alias("dow"),
                  (F.col("sales") * 1000.0).alias("sales_k"),
                  (F.col("d_num").cast("long") * 100000).alias("big"))
    return E.narrow_types(cut_lineage(ft))


# -- K* ----------------------------------------------------------------------------

@register("holdout_exact_n", with_views("v_panel") + f"""
SELECT id, d_num, row_number() OVER (ORDER BY {hash_sql('id', 'd_num')}, id, d_num) <= 2000 AS is_holdout
FROM v_panel""")
def q_holdout_exact_n(spark, sf_dir):
    p = V.v_panel(spark, sf_dir).select("id", "d_num")
    return K.holdout_exact_n(p, 2000, ["id", "d_num"])


@register("holdout_fraction", with_views("v_panel") + f"""
SELECT id, d_num, {hash_sql('id', 'd_num')} % 100 < 25 AS is_holdout FROM v_panel""")
def q_holdout_fraction(spark, sf_dir):
    p = V.v_panel(spark, sf_dir).select("id", "d_num")
    return K.holdout_fraction(p, 25, ["id", "d_num"])


@register("split_three_way", with_views("v_panel") + f"""
SELECT id, d_num, CASE WHEN {hash_sql('id', 'd_num')} % 100 < 1 THEN 'check'
                       WHEN {hash_sql('id', 'd_num')} % 100 < 5 THEN 'test' ELSE 'train' END AS part
FROM v_panel""")
def q_split_three_way(spark, sf_dir):
    p = V.v_panel(spark, sf_dir).select("id", "d_num")
    return K.split_three_way(p, ["id", "d_num"], 1, 5)


_CV_N, _CV_TRAIN, _CV_TEST, _CV_STEP = 3, 730, 28, 28


@register("timeseries_cv", with_views("v_sales") + f"""
, b AS (SELECT min(d_num) AS first, max(d_num) - min(d_num) AS dur FROM v_sales)
, folds AS (SELECT CAST(i AS INTEGER) AS fold,
                   dur - {_CV_TRAIN + _CV_TEST} - ({_CV_N} - (i + 1)) * {_CV_STEP} AS s
            FROM b, range({_CV_N}) r(i))
SELECT v.id, v.d_num, f.fold, CASE WHEN v.d_num - b.first > f.s AND v.d_num - b.first <= f.s + {_CV_TRAIN}
                         THEN 'train' ELSE 'test' END AS role
FROM v_sales v, b, folds f
WHERE (v.d_num - b.first > f.s AND v.d_num - b.first <= f.s + {_CV_TRAIN})
   OR (v.d_num - b.first > f.s + {_CV_TRAIN}
       AND (f.fold = {_CV_N - 1} OR v.d_num - b.first <= f.s + {_CV_TRAIN + _CV_TEST}))""")
def q_timeseries_cv(spark, sf_dir):
    s = V.v_sales(spark, sf_dir).select("id", "d_num")
    return K.timeseries_cv(s, _CV_N, _CV_TRAIN, _CV_TEST, _CV_STEP)


@register("systematic_sample", with_views("v_panel") + """
SELECT id, d_num, sales FROM (
  SELECT id, d_num, sales, row_number() OVER (ORDER BY d_num, id) AS rn FROM v_panel)
WHERE (rn - 1) % 1000 = 0""")
def q_systematic_sample(spark, sf_dir):
    p = V.v_panel(spark, sf_dir).select("id", "d_num", "sales")
    return K.systematic_sample(p, 1000, ["d_num", "id"])


# -- M1 ----------------------------------------------------------------------------

_ACF_LAGS = 40


@register("acf", with_views("v_sales") + f"""
, c AS (SELECT id, d_num, sales - avg(sales) OVER (PARTITION BY id) AS x FROM v_sales)
, l AS (SELECT id, x, {', '.join(f'lag(x, {k}) OVER (PARTITION BY id ORDER BY d_num) AS l{k}'
                                 for k in range(_ACF_LAGS + 1))} FROM c)
, s AS (SELECT id, sum(x * x) AS den, {', '.join(f'sum(x * l{k}) AS n{k}' for k in range(_ACF_LAGS + 1))}
        FROM l GROUP BY id)
SELECT id, unnest(range({_ACF_LAGS + 1})) AS lag,
       unnest([{', '.join(f'round(n{k} / den, 6)' for k in range(_ACF_LAGS + 1))}]) AS acf
FROM s""")
def q_acf(spark, sf_dir):
    s = V.v_sales(spark, sf_dir).select("id", "d_num", "sales")
    out = M.acf(s, _ACF_LAGS)
    return out.select("id", "lag", F.round("acf", 6).alias("acf"))
