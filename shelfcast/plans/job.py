"""The whole forecasting job in one call, composed from the operators.

train -> holdout score -> 28-day recursive forecast with the fitted model ->
blended wide submission -> checks -> optional write.  Every step is a Spark
job over the partitioned data; the only values brought to the driver are the
model coefficients, the holdout RMSE and the two check counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators import aggs as A
from shelfcast.operators import joins as J
from shelfcast.operators import project as P
from shelfcast.operators import reshape as R
from shelfcast.operators import split as K
from shelfcast.operators import windows as W
from shelfcast.plans import features as FE
from shelfcast.plans import forecast as FC
from shelfcast.plans import models as ML
from shelfcast.session import cut_lineage
from shelfcast.sources import sinks as SK

FEATURES = ["lag_7", "lag_28", "rmean_7_7", "rmean_7_28", "rmean_28_7", "rmean_28_28"]


@dataclass
class JobResult:
    submission: DataFrame
    model: FC.LinearModelSpec
    holdout_rmse: float
    path: str | None = None


def train_and_forecast(sales: DataFrame, tr_last: int, first_day: int = 1,
                       horizon: int = 28, max_lags: int = 57, holdout_pct: int = 25,
                       alphas=(1.025, 1.023, 1.0175), template_ids: DataFrame | None = None,
                       out_path: str | None = None, id_col: str = "id",
                       known: DataFrame | None = None) -> JobResult:
    """``sales``: (id, d_num, sales) daily history up to ``tr_last``.
    ``known``: optional (id, d_num, features...) rows of features known ahead
    (calendar, price, category), for history and horizon days alike; they are
    fitted with the lags and act inside the recursion.

    1. training window (B4), laid out by series (one shuffle, checkpointed),
       and demand features (F1, F2), warm-up rows
       dropped (C12); 2. key-hash holdout (K2); 3. elastic-net linear model
       (L1, L6) and its holdout RMSE (E8); 4. recursive forecast of the next
       ``horizon`` days with the fitted coefficients (L14, one expression);
    5. F labels, pivot, NULL -> 0, blend, evaluation copy (L20); 6. no NULL
       cells and ids equal to the template (E6, E7), else ``ValueError``;
    7. CSV with a header, sorted by id (A6).
    """
    hist = R.training_window(sales.select(id_col, "d_num", "sales"), tr_last, max_lags,
                             first_day, is_train=True).where(F.col("d_num") <= tr_last)
    # Features, history arrays and the series list all key on the series:
    # one shuffle, written once, reused by every step below.
    hist = W.series_layout(hist, id_col)
    feats = FE.demand_features(hist, id_col=id_col)
    ahead = [c for c in known.columns if c not in (id_col, "d_num")] if known is not None else []
    if ahead:
        feats = feats.join(known, [id_col, "d_num"], "left").na.fill(0.0, ahead)
    rows = ML.assemble_features(feats, FEATURES + ahead, "sales", keep=[id_col, "d_num"])
    rows = K.holdout_fraction(rows, holdout_pct, [id_col, "d_num"])
    fitted = ML.fit_linear(rows.where(~F.col("is_holdout")))
    scored = fitted.transform(rows.where("is_holdout"))
    rmse = scored.agg(F.sqrt(F.avg(F.pow(F.col("label") - F.col("prediction"), 2)))).first()[0]
    whole = FC.LinearModelSpec.from_ml(fitted, FEATURES + ahead)
    spec = FC.LinearModelSpec({n: whole.coefs[n] for n in FEATURES}, whole.intercept)
    exog = FC.exog_effects(known.where(F.col("d_num") > tr_last),
                           {n: whole.coefs[n] for n in ahead}, id_col) if ahead else None

    preds = FC.recursive_forecast(hist, tr_last + 1, horizon, max_lags, spec,
                                  id_col=id_col, series=hist.select(id_col).distinct(), exog=exog)
    # Written once: the checks, the sink and the caller read this copy.
    sub = cut_lineage(FC.submission_build(preds, tr_last + 1, horizon, list(alphas), id_col))

    nulls = A.count_nulls(sub, exclude=[id_col]).first()["n_nulls"]
    if nulls:
        raise ValueError(f"submission has {nulls} NULL cells")
    if template_ids is not None:
        check = A.check_id_alignment(sub.select(id_col), template_ids.select(id_col), id_col).first()
        if not check["aligned"]:
            raise ValueError(f"submission ids differ from the template: {check.asDict()}")
    path = SK.sink_wide(sub, out_path) if out_path else None
    return JobResult(sub, spec, float(rmse) if rmse is not None else float("nan"), path)


PANEL_FEATURES = ["shift_t28", "rolling_mean_t7", "wday", "month", "is_event", "sell_price"]


def panel_rows(panel: DataFrame, prices: DataFrame, calendar: DataFrame, tr_last: int,
               horizon: int = 28) -> DataFrame:
    """History and horizon days with calendar, price and demand features:
    the horizon rows are appended (B3), the calendar and the weekly price
    joined left (D3, D4), demand shifted by the horizon (F5, F6) and the last
    known price carried forward.  Written once."""
    keys = ["id", "item_id", "store_id"]
    hist = panel.select(*keys, "d_num", F.col("sales").cast("double").alias("sales")).where(F.col("d_num") <= tr_last)
    ahead = R.extend_horizon_long(hist, keys, tr_last, horizon).select(*hist.columns)
    rows = hist.unionByName(ahead)
    cal = calendar.select("d_num", "wm_yr_wk", F.col("wday").cast("double"), F.col("month").cast("double"),
                          F.col("event_name_1").isNotNull().cast("double").alias("is_event"))
    rows = J.join_prices(rows.join(cal, "d_num", "left"), prices, "left")
    w = W.series_window("id")
    rows = W.rolling_horizon_features(rows.withColumnRenamed("sales", "demand"), horizon, (7,), (), None, w=w)
    seen = w.rowsBetween(Window.unboundedPreceding, 0)
    return cut_lineage(rows.withColumn("shift_t28", F.lag("demand", horizon).over(w)).withColumn(
        "sell_price", F.last("sell_price", ignorenulls=True).over(seen)))


def panel_job(panel: DataFrame, prices: DataFrame, calendar: DataFrame, tr_last: int,
              features: list[str] | None = None, horizon: int = 28, folds: int = 3,
              train_days: int = 730, test_days: int = 28, reg: float = 0.01) -> DataFrame:
    """The panel pipeline as one job: features, time cutoff (C17), rolling-origin
    folds (K4), one linear model per fold on its training days, the mean of
    the fold models over the horizon (L12), and the wide submission with its
    evaluation copy (L20), checked for NULL cells and id alignment (E6, E7)."""
    features = list(features or PANEL_FEATURES)
    rows = panel_rows(panel, prices, calendar, tr_last, horizon)
    train = ML.assemble_features(rows.where(F.col("d_num") <= tr_last), features, "demand", keep=["id", "d_num"])
    tagged = cut_lineage(K.timeseries_cv(train, folds, train_days, test_days, test_days))
    ahead = rows.where(F.col("d_num") > tr_last).na.fill(0.0, features)
    future = ML.assemble_features(ahead.withColumn("demand", F.lit(0.0)), features, "demand", keep=["id", "d_num"])
    preds = None
    for f in range(folds):
        model = ML.fit_linear(tagged.where((F.col("fold") == f) & (F.col("role") == "train")), reg=reg)
        part = model.transform(future).select("id", "d_num", F.col("prediction").alias("pred"))
        preds = part if preds is None else preds.unionByName(part)
    mean = ML.fold_mean_predictions(preds, ["id", "d_num"])
    sub = cut_lineage(FC.submission_build(mean, tr_last + 1, horizon, [1.0]))
    ids = rows.select("id").distinct()
    nulls = A.count_nulls(sub, exclude=["id"]).first()["n_nulls"]
    check = A.check_id_alignment(sub.select("id"), P.replicate_with_new_id(ids)).first()
    if nulls or not check["aligned"]:
        raise ValueError(f"submission: {nulls} NULL cells, ids {check.asDict()}")
    return sub
