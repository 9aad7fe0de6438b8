"""Registered queries: forecasts and backtests (L14-L20, oracle-checked with a
fixed-coefficient model), model fitting (L1-L13, K5, G3, G4),
PACF (M2) and sinks (A6-A8).

The learners are checked by value where SQL can fit the same model: least
squares on one feature, shallow trees and boosted stumps (a best split is an
aggregation over candidate thresholds), and a Poisson GLM (a fixed number of
reweighted least-squares steps).  Forests and models above other models are
compared with the mean of their training labels: the oracle computes that
error, and expects the model's own to be smaller."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from shelfcast.operators import diagnostics as M
from shelfcast.operators import neighbors as NB
from shelfcast.operators import project as P
from shelfcast.operators import split as K
from shelfcast.operators import windows as W
from shelfcast.plans import features as FE
from shelfcast.plans import forecast as FC
from shelfcast.plans import job as JOB
from shelfcast.plans import models as ML
from shelfcast.plans.catalog_reshape import TR_LAST, hash_sql
from shelfcast.plans.oracle_views import with_views
from shelfcast.plans.registry import register
from shelfcast.plans.sqlfrag import over, rolling
from shelfcast.sources import sinks as SK
from shelfcast.sources import views as V
from shelfcast.session import cut_lineage

# Fixed values, equal to the reference's run parameters: forecast horizon,
# history bound of the recursion, backtest length, blend multipliers,
# neighbours of the kNN regression, trials of the searches.
H = 28
MAX_LAGS = 57
BT_DAYS = 15
ALPHAS = [1.025, 1.023, 1.0175]
KNN_K = 50
TRIALS = 10

ORIGIN = TR_LAST + 1
MODEL = FC.FIXED_MODEL


# -- SQL text of the recursion (DuckDB recursive CTE over lists) --------------------

def _feat_sql(h: str, day: str) -> dict[str, str]:
    vals = f"[x.s FOR x IN {h} IF x.d >= {day} - {MAX_LAGS}]"
    m = f"len({vals})"
    out = {}
    for lag in FC.DEFAULT_LAGS:
        out[f"lag_{lag}"] = f"(CASE WHEN {m} >= {lag} THEN ({vals})[{m} - {lag} + 1] END)"
        for k in FC.DEFAULT_WINS:
            sl = f"({vals})[{m} - {lag} - {k} + 2 : {m} - {lag} + 1]"
            out[f"rmean_{lag}_{k}"] = (
                f"(CASE WHEN {m} >= {lag + k - 1} AND len([y FOR y IN {sl} IF y IS NOT NULL]) = {k} "
                f"THEN list_reduce(list_prepend(0.0::DOUBLE, {sl}), lambda a, b: a + coalesce(b, 0.0)) / {k} END)")
    return out


def _pred_sql(feats: dict[str, str]) -> str:
    expr = f"{float(MODEL.intercept)!r}::DOUBLE"
    for name, coef in MODEL.coefs.items():
        expr = f"({expr} + {float(coef)!r}::DOUBLE * coalesce({feats[name]}, 0.0))"
    return expr


def _start_sql(active: bool, alphas, act_join: str, alpha_src: str) -> str:
    if active:
        return ("SELECT id, coalesce(hist0.h, CAST([] AS STRUCT(d INTEGER, s DOUBLE)[])) AS h, "
                f"coalesce(a.act, CAST([] AS INTEGER[])) AS act FROM hist0{act_join}")
    return f"SELECT hist0.id, hist0.h{', al.alpha' if alphas else ''} FROM hist0{alpha_src}"


def _rec_sql(origin: int, horizon: int, active: bool = False, alphas: list | None = None,
             exog: bool = False) -> str:
    day = f"({origin} + t)"
    pred = _pred_sql(_feat_sql("h", day))
    if exog:
        pred = f"({pred} + fx[t + 1])"
    alpha = "alpha" if alphas else "1.0::DOUBLE"
    new = f"list_append(h, struct_pack(d := {day}, s := {pred} * {alpha}))"
    if active:
        new = f"CASE WHEN list_contains(act, {day}) THEN {new} ELSE h END"
    act_join = ""
    if active:
        act_join = (f" FULL OUTER JOIN (SELECT id, list(d_num) AS act FROM v_sales WHERE d_num BETWEEN "
                    f"{origin} AND {origin + horizon - 1} GROUP BY id) a USING (id)")
    alpha_src = (f", (SELECT unnest([{', '.join(repr(float(a)) + '::DOUBLE' for a in alphas)}]) AS alpha) al"
                 if alphas else "")
    return f"""hist0 AS (
  SELECT id, list(struct_pack(d := d_num, s := CAST(sales AS DOUBLE)) ORDER BY d_num) AS h
  FROM v_sales WHERE d_num BETWEEN {origin - MAX_LAGS} AND {origin - 1} GROUP BY id),
start AS ({_start_sql(active, alphas, act_join, alpha_src) if not exog else
           "SELECT hist0.id, hist0.h, f.fx FROM hist0 JOIN (SELECT id, list(effect ORDER BY d_num) AS fx "
           "FROM ex GROUP BY id) f USING (id)"}),
rec AS (
  SELECT id, {'alpha, ' if alphas else ''}{'act, ' if active else ''}{'fx, ' if exog else ''}0 AS t, h FROM start
  UNION ALL
  SELECT id, {'alpha, ' if alphas else ''}{'act, ' if active else ''}{'fx, ' if exog else ''}t + 1, {new} FROM rec WHERE t < {horizon}),
fc AS (SELECT id, {'alpha, ' if alphas else ''}x.d AS d_num, x.s AS pred FROM (
  SELECT id, {'alpha, ' if alphas else ''}unnest(h) AS x FROM rec WHERE t = {horizon}) WHERE x.d >= {origin})"""


def _recursive_with(*extra: str, active=False, alphas=None, origin=ORIGIN, horizon=H) -> str:
    return with_views("v_sales", extra=[_rec_sql(origin, horizon, active, alphas), *extra]) \
        .replace("WITH ", "WITH RECURSIVE ", 1)


def _sales(spark, sf_dir, since_day: int | None = None):
    return V.v_sales(spark, sf_dir, since_day).select("id", "d_num", "sales")


def _recent(spark, sf_dir):
    """History the recursive forecast reads: the max_lags days before the origin."""
    return _sales(spark, sf_dir, ORIGIN - MAX_LAGS)


# -- L14-L20 ---------------------------------------------------------------------

@register("recursive_forecast", _recursive_with() + "SELECT id, d_num, round(pred, 6) AS pred FROM fc")
def q_recursive_forecast(spark, sf_dir):
    out = FC.recursive_forecast(_recent(spark, sf_dir), ORIGIN, H, MAX_LAGS, MODEL)
    return out.select("id", "d_num", F.round("pred", 6).alias("pred"))


# Linear terms of features known ahead: calendar parts, events, flags, the
# last known price and the category code.
EXOG = {"wday": 0.2137, "month": -0.0719, "is_event": 1.3193, "snap_CA": 0.4127, "price": 0.0353,
        "cat_code": 0.1171}
_EXOG_SQL = f"""pw AS (SELECT item_id, wm_yr_wk, avg(sell_price) AS price FROM v_prices GROUP BY ALL),
lp AS (SELECT item_id, arg_max(price, wm_yr_wk) AS price FROM pw GROUP BY item_id),
sr AS (SELECT DISTINCT id, CAST(CAST(regexp_extract(id, '#(\\d+)$', 1) AS INTEGER) % 3 AS DOUBLE) AS cat_code
       FROM v_sales WHERE d_num BETWEEN {ORIGIN - MAX_LAGS} AND {ORIGIN - 1}),
ex AS (SELECT sr.id, c.d_num, {' + '.join(f'{w!r}::DOUBLE * coalesce({n}, 0.0)' for n, w in EXOG.items())} AS effect
       FROM sr JOIN (SELECT *, CAST(event_name_1 IS NOT NULL AS DOUBLE) AS is_event FROM v_calendar
                     WHERE d_num BETWEEN {ORIGIN} AND {ORIGIN + H - 1}) c ON true
       LEFT JOIN lp ON lp.item_id = sr.id)"""


def _known_features(spark, sf_dir, series, first: int, last: int):
    """(id, d_num, wday, month, is_event, snap_CA, price, cat_code) of every
    series and day; a week without a price takes the last known one."""
    weekly = V.v_prices(spark, sf_dir).groupBy(F.col("item_id").alias("id"), "wm_yr_wk").agg(
        F.avg("sell_price").alias("p"))
    weekly = cut_lineage(weekly)
    last_known = weekly.groupBy("id").agg(F.max_by("p", "wm_yr_wk").alias("_last"))
    cal = V.calendar_for_join(spark).select(
        "d_num", "wm_yr_wk", "wday", "month", F.col("event_name_1").isNotNull().cast("double").alias("is_event"), "snap_CA")
    days = series.select("id", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("d_num"))
    rows = days.join(cal, "d_num").join(weekly, ["id", "wm_yr_wk"], "left").join(last_known, "id", "left")
    return rows.withColumn("price", F.coalesce("p", "_last")).withColumn(
        "cat_code", (F.regexp_extract("id", r"#(\d+)", 1).cast("int") % 3).cast("double")).drop(
        "p", "_last", "wm_yr_wk")


@register("recursive_forecast_exog", with_views("v_sales", "v_prices", "v_calendar", extra=[
    _EXOG_SQL, _rec_sql(ORIGIN, H, exog=True)]).replace("WITH ", "WITH RECURSIVE ", 1) +
    "SELECT id, d_num, round(pred, 6) AS pred FROM fc")
def q_recursive_forecast_exog(spark, sf_dir):
    """The recursion with day, price and category terms inside the loop."""
    recent = _recent(spark, sf_dir)
    known = _known_features(spark, sf_dir, recent.select("id").distinct(), ORIGIN, ORIGIN + H - 1)
    exog = FC.exog_effects(known, EXOG)
    out = FC.recursive_forecast(recent, ORIGIN, H, MAX_LAGS, MODEL, exog=exog)
    return out.select("id", "d_num", F.round("pred", 6).alias("pred"))


_BT_START = TR_LAST - BT_DAYS + 1


@register("backtest_recursive", _recursive_with(active=True, origin=_BT_START, horizon=BT_DAYS) + f"""
SELECT v.id, v.d_num, v.sales AS sales_original, round(fc.pred, 6) AS sales
FROM v_sales v LEFT JOIN fc USING (id, d_num) WHERE v.d_num BETWEEN {_BT_START} AND {TR_LAST}""")
def q_backtest_recursive(spark, sf_dir):
    # Only the days that the history bound reaches are read.
    s = _sales(spark, sf_dir, _BT_START - MAX_LAGS)
    out = FC.backtest_recursive(s, TR_LAST, BT_DAYS, MAX_LAGS, MODEL)
    return out.select("id", "d_num", "sales_original", F.round("sales", 6).alias("sales"))


def _one_step_sql() -> str:
    feats = {}
    for lag in FC.DEFAULT_LAGS:
        feats[f"lag_{lag}"] = f"lag(sales, {lag}) {over()}"
        for k in FC.DEFAULT_WINS:
            feats[f"rmean_{lag}_{k}"] = rolling("sales", "avg", k, lag)
    return f"""one AS (SELECT id, d_num, sales_2 FROM (
  SELECT id, d_num, {_pred_sql(feats)} AS sales_2 FROM v_sales)
  WHERE d_num BETWEEN {_BT_START} AND {TR_LAST})"""


@register("backtest_one_step", with_views("v_sales", extra=[_one_step_sql()]) +
          "SELECT id, d_num, round(sales_2, 6) AS sales_2 FROM one")
def q_backtest_one_step(spark, sf_dir):
    out = FC.backtest_one_step(_sales(spark, sf_dir), TR_LAST, BT_DAYS, MODEL)
    return out.select("id", "d_num", F.round("sales_2", 6).alias("sales_2"))


_CMP_FROM = TR_LAST - 9


@register("backtest_compare", _recursive_with(_one_step_sql(), active=True, origin=_BT_START,
                                              horizon=BT_DAYS) + f"""
, rec_bt AS (SELECT v.id, v.d_num, v.sales AS sales_original, fc.pred AS sales
             FROM v_sales v LEFT JOIN fc USING (id, d_num) WHERE v.d_num BETWEEN {_BT_START} AND {TR_LAST})
SELECT d_num, round(avg(sales), 6) AS mean_recursive, round(avg(sales_2), 6) AS mean_one_step,
       round(avg(sales_original), 6) AS mean_actual
FROM rec_bt FULL OUTER JOIN one USING (id, d_num)
WHERE d_num >= {_CMP_FROM} AND sales IS NOT NULL AND sales_2 IS NOT NULL AND sales_original IS NOT NULL
GROUP BY d_num""")
def q_backtest_compare(spark, sf_dir):
    # The recursion reads a bounded history; the one-step lags count rows, not
    # days, so they see the whole series.
    rec = FC.backtest_recursive(_sales(spark, sf_dir, _BT_START - MAX_LAGS), TR_LAST, BT_DAYS, MAX_LAGS, MODEL)
    one = FC.backtest_one_step(_sales(spark, sf_dir), TR_LAST, BT_DAYS, MODEL)
    out = FC.backtest_compare(rec, one, _CMP_FROM)
    return out.select("d_num", *[F.round(c, 6).alias(c) for c in ("mean_recursive", "mean_one_step",
                                                                 "mean_actual")])


_FACTOR = FC.blend_factor(ALPHAS)


@register("multiplier_blend", _recursive_with() +
          f"SELECT id, d_num, round(pred * {_FACTOR!r}::DOUBLE, 6) AS pred_blend FROM fc")
def q_multiplier_blend(spark, sf_dir):
    preds = FC.recursive_forecast(_recent(spark, sf_dir), ORIGIN, H, MAX_LAGS, MODEL)
    out = FC.multiplier_blend(preds, ALPHAS)
    return out.select("id", "d_num", F.round("pred_blend", 6).alias("pred_blend"))


@register("multiplier_in_loop", _recursive_with(alphas=ALPHAS) +
          "SELECT id, d_num, round(avg(pred), 6) AS pred FROM fc GROUP BY id, d_num")
def q_multiplier_in_loop(spark, sf_dir):
    out = FC.multiplier_in_loop(_recent(spark, sf_dir), ORIGIN, ALPHAS, H, MAX_LAGS, MODEL)
    return out.select("id", "d_num", F.round("pred", 6).alias("pred"))


_F_COLS = [f"F{i}" for i in range(1, H + 1)]
_WIDE_SQL = f"""wide AS (
  SELECT id || '_validation' AS id, {', '.join(f"round(coalesce(max(pred) FILTER (WHERE F = 'F{i}'), 0.0) * {_FACTOR!r}::DOUBLE, 6) AS F{i}"
                        for i in range(1, H + 1))}
  FROM (SELECT id, pred, 'F' || CAST(row_number() OVER (PARTITION BY id ORDER BY d_num) AS VARCHAR) AS F
        FROM fc) GROUP BY id)"""
_SUBMISSION_SQL = _recursive_with(_WIDE_SQL) + """
SELECT * FROM wide UNION ALL
SELECT * REPLACE (regexp_replace(id, 'validation$', 'evaluation') AS id) FROM wide"""


def _submission(spark, sf_dir):
    """Forecast of the validation ids, blended, with the evaluation copy."""
    preds = FC.recursive_forecast(_recent(spark, sf_dir), ORIGIN, H, MAX_LAGS, MODEL)
    named = preds.withColumn("id", F.concat("id", F.lit("_validation")))
    out = FC.submission_build(named, ORIGIN, H, ALPHAS)
    return out.select("id", *[F.round(c, 6).alias(c) for c in _F_COLS])


@register("submission_build", _SUBMISSION_SQL)
def q_submission_build(spark, sf_dir):
    return _submission(spark, sf_dir)


# -- model layer (rows-only checks) ----------------------------------------------------

FEATURES = ["lag_7", "lag_28", "rmean_7_7", "rmean_7_28", "rmean_28_7", "rmean_28_28", "wday", "month"]


def _feature_rows(spark, sf_dir):
    """Features of the daily brand series with key-hash holdout flags, written
    once: every fit and every scoring of a query reads this copy."""
    s = V.v_sales(spark, sf_dir)
    feats = FE.demand_features(s)
    feats = feats.withColumn("wday", F.dayofweek("date").cast("double")) \
                 .withColumn("month", F.month("date").cast("double"))
    flat = P.drop_nulls(feats.select("id", "d_num", "sales", *FEATURES), subset=FEATURES + ["sales"])
    flat = K.holdout_fraction(flat, 25, ["id", "d_num"])
    return cut_lineage(flat.withColumn("is_val", K.key_bucket(100, "id", "d_num") % 4 == 1))


def _training_rows(spark, sf_dir, features=None):
    rows = _feature_rows(spark, sf_dir)
    return ML.assemble_features(rows, list(features or FEATURES), "sales",
                                keep=["id", "d_num", "is_holdout", "is_val"])


# The SQL twin of the feature rows; dayofweek counts from 1 = Sunday in Spark.
_BUCKET = hash_sql("id", "d_num")
_ROWS_SQL = f"""raw AS (
  SELECT id, d_num, sales,
    lag(sales, 7) {over()} AS lag_7, lag(sales, 28) {over()} AS lag_28,
    {rolling('sales', 'avg', 7, 7)} AS rmean_7_7, {rolling('sales', 'avg', 28, 7)} AS rmean_7_28,
    {rolling('sales', 'avg', 7, 28)} AS rmean_28_7, {rolling('sales', 'avg', 28, 28)} AS rmean_28_28,
    CAST(dayofweek(date) + 1 AS DOUBLE) AS wday, CAST(month(date) AS DOUBLE) AS month
  FROM v_sales),
tr AS (SELECT *, CAST(sales AS DOUBLE) AS label, {_BUCKET} % 100 < 25 AS is_holdout, {_BUCKET} AS kh
       FROM raw WHERE {' AND '.join(f'{c} IS NOT NULL' for c in FEATURES)})"""


def _rows_sql(*extra: str) -> str:
    return with_views("v_sales", extra=[_ROWS_SQL, *extra])


# The error of the training mean on the training rows, and a model's below it.
_BETTER_SQL = _rows_sql("b AS (SELECT round(stddev_pop(label), 4) AS mean_rmse FROM tr WHERE NOT is_holdout)") + (
    "SELECT id, d_num, label, mean_rmse, true AS better FROM tr, b WHERE is_holdout")


def _compared(model, train, holdout, col: str = "prediction"):
    """Scored holdout rows with the error of the training mean (by value in
    SQL) and whether the model's training error is below it: false for a
    constant or failed model.  Two numbers reach the driver."""
    fit = model.transform(train).agg(
        F.stddev_pop("label").alias("mean"),
        F.sqrt(F.avg(F.pow(F.col("label") - F.col(col), 2))).alias("own")).first()
    out = model.transform(holdout)
    finite = F.col(col).isNotNull() & ~F.isnan(col) & (F.abs(col) < float("inf"))
    return out.select("id", "d_num", "label", F.round(F.lit(fit["mean"]), 4).alias("mean_rmse"),
                      (finite & F.lit(fit["own"] < 0.999 * fit["mean"])).alias("better"))


@register("assemble_features", _rows_sql() + "SELECT id, d_num, label, " +
          ", ".join(f"round({c}, 6) AS {c}" for c in FEATURES) + " FROM tr")
def q_assemble_features(spark, sf_dir):
    rows = _training_rows(spark, sf_dir).withColumn("f", vector_to_array("features"))
    return rows.select("id", "d_num", "label", *[F.round(F.col("f")[i], 6).alias(n)
                                                 for i, n in enumerate(FEATURES)])


# -- categorical features (L1) --

# Codes are learnt on the holdout split's training rows of the first years, so
# later rows hold values that were never seen.
CAT_NUMERIC, CATEGORICAL = ["wday"], ["id", "event_name_1"]
SEEN_UNTIL = 1500
_CAT_SQL = f"""cr AS (
  SELECT v.id, v.d_num, CAST(v.sales AS DOUBLE) AS label, CAST(c.wday AS DOUBLE) AS wday,
         coalesce(c.event_name_1, chr(0)) AS event_name_1, v.d_num <= {SEEN_UNTIL} AND c.month <> 7 AS fitted
  FROM v_sales v JOIN v_calendar c USING (d_num)),
ids AS (SELECT id, CAST(row_number() OVER (ORDER BY id) - 1 AS DOUBLE) AS code, count(*) OVER () AS k
        FROM (SELECT DISTINCT id FROM cr WHERE fitted)),
evs AS (SELECT event_name_1, CAST(row_number() OVER (ORDER BY event_name_1) - 1 AS DOUBLE) AS code, count(*) OVER () AS k
        FROM (SELECT DISTINCT event_name_1 FROM cr WHERE fitted)),
coded AS (
  SELECT cr.id, d_num, label, wday, fitted, coalesce(ids.code, (SELECT max(k) FROM ids)) AS id_code,
         coalesce(evs.code, (SELECT max(k) FROM evs)) AS event_code
  FROM cr LEFT JOIN ids ON cr.id = ids.id LEFT JOIN evs ON cr.event_name_1 = evs.event_name_1)"""


def _categorical_rows(spark, sf_dir):
    """(rows with a features vector, the coder): brand and event as categories,
    learnt on days up to ``SEEN_UNTIL`` outside July, so one event is unseen."""
    cal = V.calendar_for_join(spark).select("d_num", F.col("wday").cast("double").alias("wday"), "month", "event_name_1")
    rows = cut_lineage(_sales(spark, sf_dir).join(cal, "d_num").select(
        "id", "d_num", F.col("sales").cast("double").alias("label"), "wday", "event_name_1",
        ((F.col("d_num") <= SEEN_UNTIL) & (F.col("month") != 7)).alias("fitted")))
    coder = ML.NominalFeatures(CAT_NUMERIC, CATEGORICAL).fit(rows.where("fitted"))
    return coder.transform(rows), coder


@register("assemble_features_categorical", with_views("v_sales", "v_calendar", extra=[_CAT_SQL]) + """
SELECT id, d_num, label, wday, id_code, event_code,
       CAST((SELECT max(k) + 1 FROM ids) AS INTEGER) AS id_categories,
       CAST((SELECT max(k) + 1 FROM evs) AS INTEGER) AS event_categories FROM coded""")
def q_assemble_features_categorical(spark, sf_dir):
    """L1 with nominal metadata: the codes, and the number of categories that
    the vector's metadata gives each coded feature."""
    from shelfcast.plans import compiled as C
    rows, _ = _categorical_rows(spark, sf_dir)
    arity = C.nominal_arity(rows)
    f = vector_to_array("features")
    return rows.select("id", "d_num", "label", f[0].alias("wday"), f[1].alias("id_code"), f[2].alias("event_code"),
                       F.lit(arity[1]).alias("id_categories"), F.lit(arity[2]).alias("event_categories"))


# A regression tree orders a feature's categories by their mean label and
# splits that order, so one aggregation per feature finds the best split.
@register("fit_tree_categorical", with_views("v_sales", "v_calendar", extra=[_CAT_SQL, """
long AS (SELECT label, 0 AS f, wday AS x FROM coded WHERE fitted
         UNION ALL SELECT label, 1, id_code FROM coded WHERE fitted UNION ALL SELECT label, 2, event_code FROM coded WHERE fitted),
v AS (SELECT f, x, count(*) AS n, sum(label) AS s, CASE f WHEN 0 THEN x ELSE avg(label) END AS o FROM long GROUP BY f, x),
p AS (SELECT *, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER (PARTITION BY f) AS nt,
             sum(s) OVER (PARTITION BY f) AS st FROM v WINDOW w AS (PARTITION BY f ORDER BY o)),
best AS (SELECT f, o, sl / nl AS l, (st - sl) / (nt - nl) AS r FROM p WHERE nl < nt
         ORDER BY sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) DESC, f LIMIT 1)"""]) + """
SELECT c.id, c.d_num, c.label, round(CASE WHEN v.o <= best.o THEN best.l ELSE best.r END, 6) AS prediction
FROM coded c CROSS JOIN best LEFT JOIN v ON v.f = best.f
 AND v.x = CASE best.f WHEN 0 THEN wday WHEN 1 THEN id_code ELSE event_code END WHERE NOT fitted""")
def q_fit_tree_categorical(spark, sf_dir):
    """A tree on nominal features splits by category sets; the bins follow the
    measured number of categories."""
    rows, coder = _categorical_rows(spark, sf_dir)
    model = ML.fit_tree(rows.where("fitted"), 1, max_bins=coder.max_bins())
    return model.transform(rows.where("not fitted")).select(
        "id", "d_num", "label", F.round("prediction", 6).alias("prediction"))


# -- Poisson GLM (L2): reweighted least squares in SQL --

_IRLS = """start AS (SELECT ln(avg(label)) AS a FROM tr WHERE NOT is_holdout),
it AS (
  SELECT 0 AS step, a, CAST(0 AS DOUBLE) AS b FROM start
  UNION ALL
  SELECT step + 1, (sz - (sw * sxz - sx * sz) / (sw * sxx - sx * sx) * sx) / sw, (sw * sxz - sx * sz) / (sw * sxx - sx * sx)
  FROM (SELECT step, sum(mu) AS sw, sum(mu * x) AS sx, sum(mu * x * x) AS sxx,
               sum(mu * (eta + (label - mu) / mu)) AS sz, sum(mu * x * (eta + (label - mu) / mu)) AS sxz
        FROM (SELECT step, label, lag_7 AS x, a + b * lag_7 AS eta, exp(a + b * lag_7) AS mu
              FROM it, tr WHERE NOT is_holdout AND step < 12) GROUP BY step)),
glm AS (SELECT a, b FROM it WHERE step = 12)"""


def _poisson(spark, sf_dir):
    rows = _training_rows(spark, sf_dir, ["lag_7"])
    return rows, ML.fit_poisson(rows.where(~F.col("is_holdout")))


@register("fit_poisson", _rows_sql(_IRLS).replace("WITH ", "WITH RECURSIVE ", 1) +
          "SELECT id, d_num, label, round(exp(a + b * lag_7), 3) AS prediction FROM tr, glm WHERE is_holdout")
def q_fit_poisson(spark, sf_dir):
    """Log-link Poisson model on one lag; SQL fits the same by reweighted
    least squares, so predictions are checked by value."""
    rows, model = _poisson(spark, sf_dir)
    return model.transform(rows.where("is_holdout")).select(
        "id", "d_num", "label", F.round("prediction", 3).alias("prediction"))


def _deviance(mu) -> F.Column:
    y = F.col("label")
    return 2 * F.sum(F.when(y > 0, y * F.ln(y / mu)).otherwise(F.lit(0.0)) - (y - mu))


_DEV_SQL = "2 * sum(CASE WHEN label > 0 THEN label * ln(label / {0}) ELSE 0 END - (label - {0}))"


@register("poisson_deviance", _rows_sql(_IRLS).replace("WITH ", "WITH RECURSIVE ", 1) + f"""
SELECT round(a, 4) AS intercept, round(b, 6) AS coefficient,
       round(CAST({_DEV_SQL.format('exp(a + b * lag_7)')} AS DOUBLE), 2) AS deviance,
       round(CAST({_DEV_SQL.format('m')} AS DOUBLE), 2) AS null_deviance
FROM tr, glm, (SELECT avg(label) AS m FROM tr WHERE NOT is_holdout) WHERE NOT is_holdout GROUP BY a, b""")
def q_poisson_deviance(spark, sf_dir):
    """Coefficients and the Poisson deviance of the fit against that of the mean."""
    rows, model = _poisson(spark, sf_dir)
    train = model.transform(rows.where(~F.col("is_holdout")))
    mean = train.agg(F.avg("label")).first()[0]
    return train.agg(_deviance(F.col("prediction")).alias("d"), _deviance(F.lit(mean)).alias("n")).select(
        F.lit(round(model.intercept, 4)).alias("intercept"), F.lit(round(float(model.coefficients[0]), 6)).alias("coefficient"),
        F.round("d", 2).alias("deviance"), F.round("n", 2).alias("null_deviance"))


# -- boosted stumps in SQL (L3, L5, L14) --

# Few distinct values, fewer than bins: every threshold is a candidate.
STUMP_FEATURES = ["lag_7", "lag_28", "wday", "month"]
BINS, ROUNDS, STEP = 4096, 5, 0.1


def _chosen(alias: str, features) -> str:
    return f"CASE {alias}.f " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(features)) + " END"


def _stump_value(alias: str, features) -> str:
    return f"CASE WHEN {_chosen(alias, features)} <= {alias}.t THEN {alias}.l ELSE {alias}.r END"


def _stumps_sql(rounds: int, train: str, features=None, src: str = "tr", name: str = "s") -> str:
    """CTEs ``s1..`` (feature, threshold, left, right value) and ``sg1..``: the
    rows with the prediction ``p1..`` after every round.  Round 1 fits the
    label, later rounds twice the residual with the step as weight."""
    features = features or STUMP_FEATURES
    out = [f"{name}g0 AS (SELECT * FROM {src})"]
    for r in range(1, rounds + 1):
        y = "label" if r == 1 else f"2 * (label - p{r - 1})"
        union = " UNION ALL ".join(f"SELECT {i} AS f, {c} AS x, {y} AS y FROM {name}g{r - 1} WHERE {train}"
                                   for i, c in enumerate(features))
        value = _stump_value(f"{name}{r}", features)
        p = value if r == 1 else f"p{r - 1} + {STEP!r}::DOUBLE * ({value})"
        out.append(f"""{name}{r} AS (SELECT f, (x + nx) / 2 AS t, sl / nl AS l, (st - sl) / (nt - nl) AS r FROM (
  SELECT f, x, lead(x) OVER w AS nx, sum(n) OVER w AS nl, sum(s) OVER w AS sl,
         sum(n) OVER (PARTITION BY f) AS nt, sum(s) OVER (PARTITION BY f) AS st
  FROM (SELECT f, x, count(*) AS n, sum(y) AS s FROM ({union}) GROUP BY f, x) WINDOW w AS (PARTITION BY f ORDER BY x))
  WHERE nx IS NOT NULL ORDER BY sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) DESC, f, t LIMIT 1),
{name}g{r} AS (SELECT {name}g{r - 1}.*, {p} AS p{r} FROM {name}g{r - 1}, {name}{r})""")
    return ",\n".join(out)


@register("fit_gbt_early_stop", _rows_sql(_stumps_sql(ROUNDS, "NOT is_holdout"), "e AS (" + " UNION ALL ".join(
    f"SELECT {r} AS round, avg(power(label - p{r}, 2)) AS error FROM sg{ROUNDS} WHERE is_holdout"
    for r in range(1, ROUNDS + 1)) + ")") +
    "SELECT CAST(round AS INTEGER) AS round, round(error, 4) AS error, "
    "round = (SELECT arg_min(round, error) FROM e) AS is_best FROM e")
def q_fit_gbt(spark, sf_dir):
    """L3: the validation error of every boosting round, and the round kept."""
    rows = _training_rows(spark, sf_dir, STUMP_FEATURES)
    fit = ML.fit_gbt_rounds(rows.where(~F.col("is_holdout")), rows.where("is_holdout"),
                            max_iter=ROUNDS, max_depth=1, step=STEP, max_bins=BINS)
    return fit.history(spark).withColumn("error", F.round("error", 4))


@register("fit_gbt_best_round", _rows_sql(_stumps_sql(ROUNDS, "NOT is_holdout"), "k AS (SELECT arg_min(round, error) AS best FROM (" +
    " UNION ALL ".join(f"SELECT {r} AS round, avg(power(label - p{r}, 2)) AS error FROM sg{ROUNDS} WHERE is_holdout"
                       for r in range(1, ROUNDS + 1)) + "))") +
    "SELECT id, d_num, label, round(CASE best " + " ".join(f"WHEN {r} THEN p{r}" for r in range(1, ROUNDS + 1)) +
    f" END, 4) AS prediction FROM sg{ROUNDS}, k WHERE is_holdout")
def q_fit_gbt_best_round(spark, sf_dir):
    """Holdout rows scored with the kept rounds, as one compiled expression."""
    rows = _training_rows(spark, sf_dir, STUMP_FEATURES)
    fit = ML.fit_gbt_rounds(rows.where(~F.col("is_holdout")), rows.where("is_holdout"),
                            max_iter=ROUNDS, max_depth=1, step=STEP, max_bins=BINS)
    f = vector_to_array("features")
    held = rows.where("is_holdout").select("id", "d_num", "label", *[f[i].alias(c) for i, c in enumerate(STUMP_FEATURES)])
    return held.select("id", "d_num", "label", F.round(fit.column(STUMP_FEATURES), 4).alias("prediction"))


@register("fit_random_forest", _BETTER_SQL)
def q_fit_random_forest(spark, sf_dir):
    rows = _training_rows(spark, sf_dir)
    train = rows.where(~F.col("is_holdout"))
    return _compared(ML.fit_random_forest(train), train, rows.where("is_holdout"))


@register("fit_tree", _rows_sql(_stumps_sql(1, "NOT is_holdout")) +
          "SELECT id, d_num, label, round(p1, 6) AS prediction FROM sg1 WHERE is_holdout")
def q_fit_tree(spark, sf_dir):
    """L5 of depth one on features with fewer values than bins: SQL finds the
    same split, so predictions are checked by value."""
    rows = _training_rows(spark, sf_dir, STUMP_FEATURES)
    m = ML.fit_tree(rows.where(~F.col("is_holdout")), max_depth=1, max_bins=BINS)
    return m.transform(rows.where("is_holdout")).select("id", "d_num", "label", F.round("prediction", 6).alias("prediction"))


# Least squares on one feature has a closed form, so SQL checks its values.
_OLS = "regr_slope(label, lag_7) AS b, regr_intercept(label, lag_7) AS a"


@register("fit_linear", _rows_sql(f"m AS (SELECT {_OLS} FROM tr WHERE NOT is_holdout)") +
          "SELECT id, d_num, label, round(a + b * lag_7, 2) AS prediction FROM tr, m WHERE is_holdout")
def q_fit_linear(spark, sf_dir):
    rows = _training_rows(spark, sf_dir, ["lag_7"])
    m = ML.fit_linear(rows.where(~F.col("is_holdout")), reg=0.0)
    return m.transform(rows.where("is_holdout")).select(
        "id", "d_num", "label", F.round("prediction", 2).alias("prediction"))


@register("vote_mean", _rows_sql(
    f"m1 AS (SELECT {_OLS} FROM tr WHERE NOT is_holdout)",
    "m2 AS (SELECT regr_slope(label, lag_28) AS b, regr_intercept(label, lag_28) AS a FROM tr WHERE NOT is_holdout)") +
    "SELECT id, d_num, label, round((m1.a + m1.b * lag_7 + m2.a + m2.b * lag_28) / 2, 2) AS pred_vote "
    "FROM tr, m1, m2 WHERE is_holdout")
def q_vote_mean(spark, sf_dir):
    """Mean of two linear models, each on its own lag; chained, without a join."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    rows = _feature_rows(spark, sf_dir).withColumn("label", F.col("sales").cast("double"))
    train, out = rows.where(~F.col("is_holdout")), rows.where("is_holdout")
    for lag in ("lag_7", "lag_28"):
        model = Pipeline(stages=[
            VectorAssembler(inputCols=[lag], outputCol=f"f_{lag}"),
            LinearRegression(featuresCol=f"f_{lag}", predictionCol=f"p_{lag}")]).fit(train)
        out = model.transform(out)
    return ML.vote_mean(out, ["p_lag_7", "p_lag_28"]).select(
        "id", "d_num", "label", F.round("pred_vote", 2).alias("pred_vote"))


def _stack_sql() -> str:
    """Two base models on one lag, per fold and on all training rows, and two
    boosted stumps over their out-of-fold predictions."""
    parts = []
    for f in ("0", "1", "all"):
        rows = "NOT is_holdout" + (f" AND kh % 2 <> {f}" if f != "all" else "")
        parts.append(f"lin{f} AS (SELECT {_OLS} FROM tr WHERE {rows})")
        parts.append(_stumps_sql(1, rows, ["lag_7"], name=f"b{f}_"))

    def base(f: str, where: str) -> str:
        stump = _stump_value(f"b{f}_1", ["lag_7"])
        return (f"SELECT tr.id, d_num, label, is_holdout, lin{f}.a + lin{f}.b * lag_7 AS p_lin, {stump} AS p_tree "
                f"FROM tr, lin{f}, b{f}_1 WHERE {where}")

    meta = " UNION ALL ".join([base("0", "NOT is_holdout AND kh % 2 = 0"), base("1", "NOT is_holdout AND kh % 2 = 1"),
                               base("all", "is_holdout")])
    return _rows_sql(*parts, f"meta AS ({meta})", _stumps_sql(2, "NOT is_holdout", ["p_lin", "p_tree"], "meta", "f"))


@register("stack_models", _stack_sql() + "SELECT id, d_num, label, round(p2, 4) AS prediction FROM fg2 WHERE is_holdout")
def q_stack_models(spark, sf_dir):
    """Base models' out-of-fold predictions feed a boosted final model, which
    then scores the holdout that none of them saw; checked by value."""
    from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression
    rows = _training_rows(spark, sf_dir, ["lag_7"]).withColumn("fold", K.key_bucket(2, "id", "d_num"))
    stack = ML.stack_models(
        rows.where(~F.col("is_holdout")), "fold",
        {"p_lin": lambda: LinearRegression(), "p_tree": lambda: DecisionTreeRegressor(maxDepth=1, maxBins=BINS)},
        lambda: GBTRegressor(maxIter=2, maxDepth=1, stepSize=STEP, maxBins=BINS), 2)
    return stack.transform(rows.where("is_holdout")).select(
        "id", "d_num", "label", F.round("prediction", 4).alias("prediction"))


@register("two_stage_model", _rows_sql() + f"""
SELECT id, d_num, label, true AS better, (SELECT round(stddev_pop(label), 4) FROM tr WHERE is_holdout AND {_BUCKET} % 2 = 0) AS mean_rmse
FROM tr WHERE is_holdout AND {_BUCKET} % 2 = 1""")
def q_two_stage_model(spark, sf_dir):
    """Stage 2 is fitted on half of stage 1's holdout with category and
    calendar context, and scored on the other half."""
    flat = _feature_rows(spark, sf_dir).withColumn("label", F.col("sales").cast("double"))
    number = F.regexp_extract("id", r"#(\d+)$", 1).cast("int")
    flat = flat.withColumn("dept", (number % 6).cast("double")).withColumn("cat", (number % 3).cast("double"))
    held = flat.where("is_holdout").withColumn("half", K.key_bucket(2, "id", "d_num"))
    first, second = ML.two_stage(flat.where(~F.col("is_holdout")), held.where("half = 0"),
                                 FEATURES, ["dept", "cat", "wday", "month"])
    def stage1(part):
        return first.transform(held.where(f"half = {part}")).withColumnRenamed("prediction", "pred1").drop("features")

    return _compared(second, stage1(0), stage1(1))


@register("random_search", _rows_sql() + f"""
SELECT CAST(range AS INTEGER) AS trial, round(d, 3) AS spread, true AS plausible
FROM range({TRIALS}), (SELECT stddev_pop(label) AS d FROM tr WHERE NOT is_holdout)""")
def q_random_search(spark, sf_dir):
    """Trials on deterministic key-hash folds; a trial's cross-validated error
    must lie near the spread of the labels (by value in SQL), and trials differ."""
    rows = _training_rows(spark, sf_dir).where(~F.col("is_holdout")).withColumn(
        "fold", K.key_bucket(2, "id", "d_num").cast("int"))
    trials = ML.random_search(rows, n_iter=TRIALS, folds=2, parallelism=4, fold_col="fold")
    spread = rows.agg(F.stddev_pop("label")).first()[0]
    differ = trials.agg(F.count_distinct("rmse")).first()[0] > 1
    near = (F.col("rmse") > 0.5 * spread) & (F.col("rmse") < 1.2 * spread) & F.lit(differ)
    return trials.select("trial", F.round(F.lit(spread), 3).alias("spread"), near.alias("plausible"))


# One trial per candidate window: the error of predicting the value by the
# mean of the window that ends a week earlier.
_TRIAL_WINS = ["lag_7", "lag_28", "rmean_7_7", "rmean_7_28", "rmean_28_7", "rmean_28_28"]


@register("best_trial", _rows_sql("t AS (" + " UNION ALL ".join(
    f"SELECT {i} AS trial, '{c}' AS feature, sqrt(avg(power(label - {c}, 2))) AS rmse FROM tr WHERE is_holdout"
    for i, c in enumerate(_TRIAL_WINS)) + ")") +
    "SELECT CAST(trial AS INTEGER) AS trial, feature, round(rmse, 4) AS rmse FROM t ORDER BY t.rmse, trial LIMIT 1")
def q_best_trial(spark, sf_dir):
    from shelfcast.operators.aggs import best_trial
    rows = _feature_rows(spark, sf_dir).where("is_holdout")
    one = rows.agg(*[F.sqrt(F.avg(F.pow(F.col("sales") - F.col(c), 2))).alias(c) for c in _TRIAL_WINS])
    trials = one.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("trial"), F.lit(c).alias("feature"), F.col(c).alias("rmse"))
        for i, c in enumerate(_TRIAL_WINS)])))
    return best_trial(trials).withColumn("rmse", F.round("rmse", 4))


_CV_ROLES = """folds AS (SELECT CAST(i AS INTEGER) AS fold,
  (SELECT max(d_num) - min(d_num) FROM tr) - 758 - (2 - i) * 28 AS s FROM range(3) r(i)),
cv AS (SELECT tr.*, fold, CASE WHEN t > s AND t <= s + 730 THEN 'train'
         WHEN t > s + 730 AND (fold = 2 OR t <= s + 758) THEN 'test' END AS role
       FROM (SELECT *, d_num - (SELECT min(d_num) FROM tr) AS t FROM tr) tr, folds)"""


def _time_folds(spark, sf_dir, features=None):
    """Feature rows tagged with three rolling-origin folds (K4)."""
    return cut_lineage(K.timeseries_cv(_training_rows(spark, sf_dir, features), 3, 730, 28, 28))


# The first split's feature and gain per time fold: a depth-one tree's whole importance.
@register("top_importances", _rows_sql(_CV_ROLES, """lv AS (""" + " UNION ALL ".join(
    f"SELECT fold, {i} AS f, '{c}' AS feature, {c} AS x, count(*) AS n, sum(label) AS s FROM cv WHERE role = 'train' GROUP BY fold, {c}"
    for i, c in enumerate(["lag_7", "lag_28", "wday", "month"])) + """),
pf AS (SELECT fold, f, feature, x, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER (PARTITION BY fold, f) AS nt,
              sum(s) OVER (PARTITION BY fold, f) AS st FROM lv WINDOW w AS (PARTITION BY fold, f ORDER BY x)),
bf AS (SELECT fold, feature FROM pf WHERE nl < nt
       QUALIFY row_number() OVER (PARTITION BY fold ORDER BY sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) DESC, f, x) = 1)""") +
    "SELECT v.feature, round(count(bf.fold) / 3.0, 6) AS importance FROM (VALUES " +
    ", ".join(f"('{c}')" for c in ["lag_7", "lag_28", "wday", "month"]) +
    ") v(feature) LEFT JOIN bf USING (feature) GROUP BY v.feature")
def q_top_importances(spark, sf_dir):
    """Features by mean importance over the time folds' trees (G3); the trees
    have one split, so SQL computes each feature's share."""
    from shelfcast.operators.aggs import top_importances
    folds = _time_folds(spark, sf_dir, STUMP_FEATURES)
    imps = None
    for f in range(3):
        m = ML.fit_tree(folds.where((F.col("fold") == f) & (F.col("role") == "train")), 1, max_bins=BINS)
        imp = ML.importances(m, STUMP_FEATURES, spark, f)
        imps = imp if imps is None else imps.unionByName(imp)
    return top_importances(imps, 30).select("feature", F.round("importance", 6).alias("importance"))


@register("fold_mean_predictions", _rows_sql(_CV_ROLES,
    "m AS (SELECT fold, " + _OLS + " FROM cv WHERE role = 'train' GROUP BY fold)") +
    "SELECT id, d_num, round(avg(a + b * lag_7), 2) AS pred FROM tr, m WHERE is_holdout GROUP BY id, d_num")
def q_fold_mean_predictions(spark, sf_dir):
    """The models of the three time folds, averaged over the holdout rows."""
    folds = _time_folds(spark, sf_dir, ["lag_7"])
    test = _training_rows(spark, sf_dir, ["lag_7"]).where("is_holdout")
    preds = None
    for f in range(3):
        train = folds.where((F.col("fold") == f) & (F.col("role") == "train"))
        p = ML.fit_linear(train, reg=0.0).transform(test).select(
            "id", "d_num", F.col("prediction").alias("pred"))
        preds = p if preds is None else preds.unionByName(p)
    out = ML.fold_mean_predictions(preds, ["id", "d_num"])
    return out.select("id", "d_num", F.round("pred", 2).alias("pred"))


@register("persist_model", _rows_sql(f"m AS (SELECT {_OLS} FROM tr WHERE NOT is_holdout)") +
          "SELECT id, d_num, label, round(a + b * lag_7, 2) AS prediction FROM tr, m WHERE is_holdout")
def q_persist_model(spark, sf_dir):
    rows = _training_rows(spark, sf_dir, ["lag_7"])
    m = ML.fit_linear(rows.where(~F.col("is_holdout")), reg=0.0)
    loaded = ML.persist_model(m, spark, "linear")
    return loaded.transform(rows.where("is_holdout")).select(
        "id", "d_num", "label", F.round("prediction", 2).alias("prediction"))


@register("kfold_cv", _rows_sql(
    f"m AS (SELECT f, {_OLS} FROM tr, range(2) r(f) WHERE kh % 2 <> f GROUP BY f)",
    "e AS (SELECT f, sqrt(avg(power(label - a - b * lag_7, 2))) AS rmse FROM tr JOIN m ON kh % 2 = f GROUP BY f)") +
    "SELECT CAST(2 AS INTEGER) AS folds, round(avg(rmse), 4) AS rmse FROM e")
def q_kfold_cv(spark, sf_dir):
    rows = _training_rows(spark, sf_dir, ["lag_7"]).withColumn("fold", K.key_bucket(2, "id", "d_num").cast("int"))
    rmse = ML.kfold_cv(rows, "fold")
    return spark.createDataFrame([(2, round(rmse, 4))], "folds int, rmse double")


def _pacf_sql(n: int) -> str:
    """Durbin-Levinson as a recursive CTE: phi holds the current order's coefficients."""
    lags = ", ".join(f"sum(x * l{k}) / nullif(sum(x * x), 0)" for k in range(n + 1))
    return with_views("v_sales", extra=[f"""c AS (
  SELECT id, d_num, sales - avg(sales) OVER (PARTITION BY id) AS x FROM v_sales),
l AS (SELECT id, x, {', '.join(f'lag(x, {k}) OVER (PARTITION BY id ORDER BY d_num) AS l{k}' for k in range(n + 1))} FROM c),
r AS (SELECT id, [{lags}] AS r FROM l GROUP BY id),
d AS (
  SELECT id, r, 0 AS k, CAST([] AS DOUBLE[]) AS phi, CAST(1 AS DOUBLE) AS var, r[1] AS a FROM r
  UNION ALL
  SELECT id, r, k + 1, list_append(list_transform(generate_series(1, k), lambda i: phi[i] - a2 * phi[k + 1 - i]), a2),
         var * (1 - a2 * a2), a2
  FROM (SELECT *, (r[k + 2] - coalesce(list_sum(list_transform(generate_series(1, k),
          lambda i: phi[i] * r[k + 2 - i])), 0)) / nullif(var, 0) AS a2 FROM d WHERE k < {n}))"""]).replace(
        "WITH ", "WITH RECURSIVE ", 1) + "SELECT id, CAST(k AS BIGINT) AS lag, round(a, 6) AS pacf FROM d"


@register("pacf", _pacf_sql(40))
def q_pacf(spark, sf_dir):
    out = M.pacf(_sales(spark, sf_dir), 40)
    return out.select("id", "lag", F.round("pacf", 6).alias("pacf"))


def _stump_rec_sql() -> str:
    """The recursion with two boosted stumps; wday and month of the day ahead."""
    day = f"({ORIGIN} + t)"
    feats = _feat_sql("h", day)
    known = {"lag_7": f"coalesce({feats['lag_7']}, 0.0)", "lag_28": f"coalesce({feats['lag_28']}, 0.0)",
             "wday": "wd[t + 1]", "month": "mo[t + 1]"}

    def value(r):
        x = f"CASE s{r}.f " + " ".join(f"WHEN {i} THEN {known[c]}" for i, c in enumerate(STUMP_FEATURES)) + " END"
        return f"CASE WHEN {x} <= s{r}.t THEN s{r}.l ELSE s{r}.r END"

    return f"""hist0 AS (
  SELECT id, list(struct_pack(d := d_num, s := CAST(sales AS DOUBLE)) ORDER BY d_num) AS h
  FROM v_sales WHERE d_num BETWEEN {ORIGIN - MAX_LAGS} AND {ORIGIN - 1} GROUP BY id),
kn AS (SELECT list(CAST(dayofweek(date) + 1 AS DOUBLE) ORDER BY d_num) AS wd, list(CAST(month(date) AS DOUBLE) ORDER BY d_num) AS mo
       FROM v_calendar WHERE d_num BETWEEN {ORIGIN} AND {ORIGIN + H - 1}),
rec AS (
  SELECT id, wd, mo, 0 AS t, h FROM hist0, kn
  UNION ALL
  SELECT id, wd, mo, rec.t + 1, list_append(h, struct_pack(d := {ORIGIN} + rec.t, s := {value(1).replace('[t + 1]', '[rec.t + 1]').replace('+ t)', '+ rec.t)')}
         + {STEP!r}::DOUBLE * ({value(2).replace('[t + 1]', '[rec.t + 1]').replace('+ t)', '+ rec.t)')})))
  FROM rec, s1, s2 WHERE rec.t < {H}),
fc AS (SELECT id, x.d AS d_num, x.s AS pred FROM (SELECT id, unnest(h) AS x FROM rec WHERE t = {H}) WHERE x.d >= {ORIGIN})"""


@register("recursive_forecast_ml", with_views("v_sales", "v_calendar", extra=[
    _ROWS_SQL, _stumps_sql(2, "true"), _stump_rec_sql()]).replace("WITH ", "WITH RECURSIVE ", 1) +
    "SELECT id, d_num, round(pred, 4) AS pred FROM fc")
def q_recursive_forecast_ml(spark, sf_dir):
    """L14 with a fitted boosted model on lags and on features known ahead,
    compiled into the recursion; SQL fits the same two stumps."""
    from pyspark.ml.regression import GBTRegressor
    model = GBTRegressor(maxIter=2, maxDepth=1, stepSize=STEP, maxBins=BINS).fit(
        _training_rows(spark, sf_dir, STUMP_FEATURES))
    recent = _recent(spark, sf_dir)
    days = V.calendar_for_join(spark).where(F.col("d_num").between(ORIGIN, ORIGIN + H - 1)).select(
        "d_num", F.dayofweek("date").cast("double").alias("wday"), F.month("date").cast("double").alias("month"))
    known = recent.select("id").distinct().join(F.broadcast(days))     # series x horizon days
    out = FC.recursive_forecast_ml(recent, ORIGIN, model, STUMP_FEATURES, H, MAX_LAGS, exog=known)
    return out.select("id", "d_num", F.round("pred", 4).alias("pred"))


# -- sinks -------------------------------------------------------------------------

@register("sink_wide", _SUBMISSION_SQL)
def q_sink_wide(spark, sf_dir):
    return SK.sink_wide(_submission(spark, sf_dir), SK.output_path(spark, "submission"), read_back=True)


@register("sink_per_variant", _recursive_with() + "SELECT id, d_num, round(pred * alpha, 4) AS pred, variant FROM fc, (VALUES " +
          ", ".join(f"({i}, {a!r}::DOUBLE)" for i, a in enumerate(ALPHAS)) + ") v(variant, alpha)")
def q_sink_per_variant(spark, sf_dir):
    preds = FC.recursive_forecast(_recent(spark, sf_dir), ORIGIN, H, MAX_LAGS, MODEL)
    variants = preds.select("*", F.posexplode(F.array(*[F.lit(a) for a in ALPHAS])).alias("variant", "alpha")) \
        .withColumn("pred", F.col("pred") * F.col("alpha")).drop("alpha")
    out = SK.sink_per_variant(variants, SK.output_path(spark, "variants"), read_back=True)
    return out.select("id", "d_num", F.round("pred", 4).alias("pred"), "variant")


@register("sink_training_extract", with_views("v_panel") + "SELECT * FROM v_panel WHERE id LIKE '%STORE_1%'")
def q_sink_training_extract(spark, sf_dir):
    s = V.v_panel(spark, sf_dir)
    extract = s.where(F.col("id").contains("STORE_1"))
    return SK.sink_training_extract(extract, SK.output_path(spark, "extracts"), read_back=True)


# -- the whole job ---------------------------------------------------------------

@register("forecast_job", with_views("v_sales") + f"""
SELECT DISTINCT id || suffix AS id, {H} AS n_days, true AS complete, true AS plausible, spread
FROM (SELECT DISTINCT id FROM v_sales WHERE d_num <= {TR_LAST}) s, (VALUES ('_validation'), ('_evaluation')) v(suffix),
     (SELECT round(stddev_pop(sales), 4) AS spread FROM v_sales WHERE d_num <= {TR_LAST})""")
def q_forecast_job(spark, sf_dir):
    """Train on the brand series, forecast 28 days with the fitted model, and
    return the checked, blended wide submission (validation + evaluation ids)."""
    from shelfcast.operators.project import replicate_with_new_id
    sales = _sales(spark, sf_dir).withColumn("id", F.concat("id", F.lit("_validation")))
    template = replicate_with_new_id(sales.select("id").distinct())
    known = _known_features(spark, sf_dir, V.v_sales(spark, sf_dir).select("id").distinct(), 1, ORIGIN + H - 1)
    known = known.withColumn("id", F.concat("id", F.lit("_validation"))).select(
        "id", "d_num", *[F.col(c).cast("double").alias(c) for c in EXOG])
    result = JOB.train_and_forecast(sales, TR_LAST, template_ids=template, known=known)
    finite = sum((F.abs(c) < float("inf")).cast("int") for c in _F_COLS)
    history = sales.where(F.col("d_num") <= TR_LAST).agg(
        F.stddev_pop("sales").alias("spread"), F.min("sales").alias("low"), F.max("sales").alias("high")).first()
    # The holdout error lies near the spread of the sales (by value in SQL), forecasts within their range.
    near = 0.5 * history["spread"] < result.holdout_rmse < 1.1 * history["spread"]
    inside = sum(F.col(c).between(float(history["low"]) * 0.9, float(history["high"]) * 1.1).cast("int") for c in _F_COLS)
    return result.submission.select(
        "id", F.lit(len(_F_COLS)).alias("n_days"), (finite == H).alias("complete"),
        (F.lit(near) & (inside == H)).alias("plausible"), F.lit(round(float(history["spread"]), 4)).alias("spread"))


@register("panel_job", with_views("v_panel", extra=[f"""h AS (
  SELECT id, d_num, sales FROM v_panel WHERE d_num <= {TR_LAST}
  UNION ALL SELECT id, CAST(unnest(range({ORIGIN}, {ORIGIN + H})) AS INTEGER), NULL
  FROM (SELECT DISTINCT id FROM v_panel WHERE d_num <= {TR_LAST})),
fl AS (SELECT id, d_num, sales, lag(sales, {H}) {over()} AS x FROM h),
tr AS (SELECT id, d_num, sales AS label, x FROM fl WHERE d_num <= {TR_LAST} AND x IS NOT NULL),
folds AS (SELECT CAST(i AS INTEGER) AS fold,
  (SELECT max(d_num) - min(d_num) FROM tr) - 758 - (2 - i) * 28 AS s FROM range(3) r(i)),
m AS (SELECT fold, regr_slope(label, x) AS b, regr_intercept(label, x) AS a
      FROM (SELECT *, d_num - (SELECT min(d_num) FROM tr) AS t FROM tr) tr, folds
      WHERE t > s AND t <= s + 730 GROUP BY fold),
fc AS (SELECT id, d_num, avg(a + b * coalesce(x, 0.0)) AS pred FROM fl, m WHERE d_num > {TR_LAST} GROUP BY id, d_num),
wide AS (SELECT id, {', '.join(f"round(max(pred) FILTER (WHERE d_num = {ORIGIN + i - 1}), 2) AS F{i}" for i in range(1, H + 1))}
         FROM fc GROUP BY id)"""]) + """
SELECT * FROM wide UNION ALL
SELECT * REPLACE (regexp_replace(id, 'validation$', 'evaluation') AS id) FROM wide""")
def q_panel_job(spark, sf_dir):
    """The panel pipeline; fitted on the shifted demand alone, so that SQL can
    check every cell (the job's own feature list has prices and calendar)."""
    panel, prices = V.panel_and_prices(spark, sf_dir)
    sub = JOB.panel_job(panel, prices, V.calendar_for_join(spark), TR_LAST, features=["shift_t28"], reg=0.0)
    return sub.select("id", *[F.round(c, 2).alias(c) for c in _F_COLS])


# -- L7 ------------------------------------------------------------------------------

@register("knn_regress", f"""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label,
                  {hash_sql('vec_id')} % 100 AS b FROM embeddings),
q AS (SELECT vec_id AS query_id, v FROM e WHERE b < 25),
t AS (SELECT vec_id, v, label FROM e WHERE b >= 25),
d AS (SELECT q.query_id, t.vec_id, t.label,
             row_number() OVER (PARTITION BY q.query_id
                                ORDER BY list_distance(q.v, t.v), t.vec_id) AS rn
      FROM q, t)
SELECT query_id, avg(label) AS prediction FROM d WHERE rn <= {KNN_K} GROUP BY query_id""")
def q_knn_regress(spark, sf_dir):
    """Embeddings split by key hash: 25 % are queries, the rest training rows."""
    emb = K.holdout_fraction(V.embeddings(spark, sf_dir), 25, ["vec_id"])
    return NB.knn_regress(emb.where(~F.col("is_holdout")), emb.where("is_holdout"), KNN_K)
