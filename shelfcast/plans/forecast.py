"""Recursive and one-step forecasts, backtests, blends, submission.

Recursive forecast (L14) without a 28-iteration plan
----------------------------------------------------
Each series is collapsed to one row holding its recent history as an array
of (d_num, sales) structs, bounded to the ``max_lags`` days before the
forecast origin (the same bound the reference slices by).  The 28 daily steps
then run *inside one expression*: ``aggregate(sequence(0, h-1), hist,
(acc, t) -> append(acc, (day, model(features(acc, day)))))``.  Every step
sees the predictions of earlier steps, exactly as the day-by-day loop does,
but Spark plans a single narrow projection: one shuffle (to build the
arrays), no growing plan, no per-step job.  The per-row array never holds
more than ``max_lags + h`` values.

Features inside a step follow the window semantics of the training
features: the slice is the rows dated within ``[day - max_lags, day)``; lag L
is the L-th row before the day in that slice; ``rmean_{L}_{k}`` is the mean
of the k rows ending L rows back, NULL unless all k exist and are non-NULL.

Models: the fixed-coefficient linear model (``LinearModelSpec``) is written
as column arithmetic, so it stays in the expression.  Fitted ``pyspark.ml``
linear models convert to it with ``LinearModelSpec.from_ml``.  Fitted trees,
forests, boosted trees, linear models and GLMs are compiled to SQL text
(``plans.compiled``) and run inside the same fold (``recursive_forecast_ml``):
no job per day, no vector column, and features known ahead (calendar, price,
categories) stand beside the lags in every step.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import windows as W
from shelfcast.plans import compiled as C

DEFAULT_LAGS = (7, 28)
DEFAULT_WINS = (7, 28)


@dataclass(frozen=True)
class LinearModelSpec:
    """pred = intercept + sum(coef * coalesce(feature, 0))."""
    coefs: dict = field(default_factory=dict)
    intercept: float = 0.0

    @classmethod
    def from_ml(cls, model, feature_names: list[str]) -> "LinearModelSpec":
        """From a fitted LinearRegressionModel (or a GLM with identity link)."""
        coefs = [float(c) for c in model.coefficients]
        return cls(dict(zip(feature_names, coefs)), float(model.intercept))

    def feature_names(self) -> list[str]:
        return list(self.coefs)

    def predict(self, feats: dict[str, Column]) -> Column:
        out = F.lit(float(self.intercept))
        for name, coef in self.coefs.items():
            out = out + F.lit(float(coef)) * F.coalesce(feats[name], F.lit(0.0))
        return out


# Fixed values of the reference-style demo model (lags 7/28 x windows 7/28).
# Four-digit coefficients: predictions do not fall on exact decimal midpoints,
# so rounding for the oracle comparison is stable across engines.
FIXED_MODEL = LinearModelSpec(
    coefs={"lag_7": 0.1537, "lag_28": 0.0519, "rmean_7_7": 0.3461, "rmean_7_28": 0.2473,
           "rmean_28_7": 0.0983, "rmean_28_28": 0.1027},
    intercept=0.4813)


def _features(acc: Column, day: Column, max_lags: int, lags, wins) -> dict[str, Column]:
    """Lag and rolling-mean features of ``day`` from the history array."""
    vals = F.transform(F.filter(acc, lambda x: x["d_num"] >= day - max_lags),
                       lambda x: x["sales"])
    m = F.size(vals)
    feats = {}
    for lag in lags:
        feats[f"lag_{lag}"] = F.when(m >= lag, F.element_at(vals, m - lag + 1))
        for k in wins:
            sl = F.slice(vals, F.greatest(m - lag - k + 2, F.lit(1)), k)
            n_ok = F.size(F.filter(sl, lambda x: x.isNotNull()))
            total = F.aggregate(sl, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
            feats[f"rmean_{lag}_{k}"] = F.when((m >= lag + k - 1) & (n_ok == k), total / k)
    return feats


def history_arrays(df: DataFrame, first_day: int, last_day: int, id_col: str = "id",
                   day_col: str = "d_num", value_col: str = "sales") -> DataFrame:
    """(id, hist): each series' rows with day in [first_day, last_day] as a
    sorted array of (d_num, sales).  The day range bounds the array size."""
    rows = df.where(F.col(day_col).between(first_day, last_day))
    return rows.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct(
        F.col(day_col).cast("int").alias("d_num"),
        F.col(value_col).cast("double").alias("sales")))).alias("hist"))


def _start_rows(df: DataFrame, origin: int, horizon: int, max_lags: int,
                active_days: DataFrame | None, id_col: str, series: DataFrame | None) -> DataFrame:
    """(id, hist, _act): the rows a recursion starts from; ``_act`` lists the
    days a series is forecast on, NULL for all."""
    hist = history_arrays(df, origin - max_lags, origin - 1, id_col)
    if series is not None:
        hist = (series.select(id_col).distinct().join(hist, id_col, "left")
                      .withColumn("hist", F.coalesce("hist", F.array().cast(
                          "array<struct<d_num:int,sales:double>>"))))
    if active_days is not None:
        act = (active_days.where(F.col("d_num").between(origin, origin + horizon - 1))
                          .groupBy(id_col).agg(F.collect_set(F.col("d_num").cast("int")).alias("_act")))
        # A series with active days but no recent history still gets its
        # forecasts (from an empty history: every feature NULL).
        hist = (hist.join(act, id_col, "full")
                    .withColumn("hist", F.coalesce("hist", F.array().cast(
                        "array<struct<d_num:int,sales:double>>")))
                    .withColumn("_act", F.coalesce("_act", F.array().cast("array<int>"))))
    else:
        hist = hist.withColumn("_act", F.lit(None).cast("array<int>"))
    return hist


def recursive_forecast(df: DataFrame, origin: int, horizon: int = 28, max_lags: int = 57,
                       model: LinearModelSpec = FIXED_MODEL, lags=DEFAULT_LAGS,
                       wins=DEFAULT_WINS, active_days: DataFrame | None = None,
                       alphas: list[float] | None = None, id_col: str = "id",
                       series: DataFrame | None = None,
                       exog: DataFrame | None = None) -> DataFrame:
    """(id, d_num, pred) for days origin..origin+horizon-1.

    ``series``: optional id list to forecast; a listed series without recent
    history starts from an empty history.  By default the series with a row
    in the history window are forecast.

    ``active_days``: optional (id, d_num) rows; a series is forecast only on
    its listed days (inner-join semantics of the reference: a series with no
    row that day is skipped and its later lags see no row).  Without it every
    series gets every horizon day.  ``alphas``: multipliers applied to
    each prediction inside the recursion (L19), one forecast per value in
    column ``_alpha``; the variants fan out from one history array per series.
    ``exog``: optional (id, d_num, effect) rows of the horizon, the model's
    terms of day and price features (``exog_effects``), added to the day's
    prediction before it feeds later lags; a missing row adds nothing.
    """
    hist = _start_rows(df, origin, horizon, max_lags, active_days, id_col, series)
    if exog is not None:
        fx = (exog.where(F.col("d_num").between(origin, origin + horizon - 1)).groupBy(id_col)
                  .agg(F.collect_list(F.struct(F.col("d_num").cast("int").alias("d"), "effect")).alias("_fx")))
        hist = hist.join(fx, id_col, "left")
        # One value per horizon day, in day order.
        hist = hist.withColumn("_fx", F.transform(
            F.sequence(F.lit(0), F.lit(horizon - 1)), lambda t: F.coalesce(F.get(F.filter(
                "_fx", lambda x: x["d"] == F.lit(origin) + t), 0)["effect"], F.lit(0.0))))
    if alphas:
        hist = hist.withColumn("_alpha", F.explode(F.array(*[F.lit(float(a)) for a in alphas])))
    alpha = F.col("_alpha") if alphas else F.lit(1.0)

    def step(acc: Column, t: Column) -> Column:
        day = F.lit(origin) + t
        pred = model.predict(_features(acc, day, max_lags, lags, wins))
        if exog is not None:
            pred = pred + F.get(F.col("_fx"), t)
        pred = pred * alpha
        new = F.array_append(acc, F.struct(day.cast("int").alias("d_num"),
                                           pred.cast("double").alias("sales")))
        on = F.col("_act").isNull() | F.array_contains(F.col("_act"), day.cast("int"))
        return F.when(on, new).otherwise(acc)

    final = F.aggregate(F.sequence(F.lit(0), F.lit(horizon - 1)), F.col("hist"), step)
    keep = [id_col] + (["_alpha"] if alphas else [])
    out = hist.select(*keep, F.filter(final, lambda x: x["d_num"] >= origin).alias("_f"))
    return out.select(*keep, F.inline("_f")).withColumnRenamed("sales", "pred")


def _feature_sql(lags, wins) -> dict[str, str]:
    """``_features`` as SQL text over ``vals``, the bound history values."""
    out = {}
    for lag in lags:
        out[f"lag_{lag}"] = f"CASE WHEN size(vals) >= {lag} THEN element_at(vals, size(vals) - {lag - 1}) END"
        for k in wins:
            part = f"slice(vals, size(vals) - {lag + k - 2}, {k})"
            # A NULL among the k values makes the sum NULL, as the window guard asks.
            out[f"rmean_{lag}_{k}"] = (f"CASE WHEN size(vals) >= {lag + k - 1} "
                                       f"THEN aggregate({part}, 0D, (s, z) -> s + z) / {k} END")
    return out


def recursive_forecast_ml(df: DataFrame, origin: int, fitted, feature_names: list[str],
                          horizon: int = 28, max_lags: int = 57, lags=DEFAULT_LAGS,
                          wins=DEFAULT_WINS, id_col: str = "id", exog: DataFrame | None = None,
                          active_days: DataFrame | None = None, alphas: list[float] | None = None,
                          series: DataFrame | None = None, arity: dict[int, int] | None = None) -> DataFrame:
    """L14 with a fitted ``pyspark.ml`` regression model, as one projection.

    ``fitted`` takes a vector of ``feature_names`` in that order; it is
    compiled to an expression (``compiled.model_sql``; ``arity`` for its
    categorical features) and folded over the horizon like the linear form,
    so the plan is one shuffle and one narrow step whatever the horizon and
    the model's size.  ``exog``: (id, d_num, columns) with every feature that
    is not a lag or rolling mean, known ahead for the horizon days.  NULL
    features, and days without an ``exog`` row, are scored as 0 (documented
    fill, so no series loses a day).  ``active_days``, ``alphas`` and
    ``series`` as in ``recursive_forecast``.
    """
    hist = _start_rows(df, origin, horizon, max_lags, active_days, id_col, series)
    made = _feature_sql(lags, wins)
    ahead = [n for n in feature_names if n not in made]
    if ahead:
        missing = [n for n in ahead if exog is None or n not in exog.columns]
        if missing:
            raise ValueError(f"features known ahead need an exog column: {missing}")
        names = {n: f"x{i}" for i, n in enumerate(ahead)}
        rows = exog.where(F.col("d_num").between(origin, origin + horizon - 1)).groupBy(id_col).agg(
            F.map_from_entries(F.collect_list(F.struct(
                F.col("d_num").cast("int"),
                F.struct(*[F.col(n).cast("double").alias(a) for n, a in names.items()])))).alias("_known"))
        hist = hist.join(rows, id_col, "left")
        made |= {n: f"_known[{origin} + t].{a}" for n, a in names.items()}
    if alphas:
        hist = hist.withColumn("_alpha", F.explode(F.array(*[F.lit(float(a)) for a in alphas])))
    scored = C.model_sql(fitted, [f"v[{i}]" for i in range(len(feature_names))], arity)
    vector = "array(" + ", ".join(f"coalesce({made[n]}, 0D)" for n in feature_names) + ")"
    values = f"transform(filter(acc, r -> r.d_num >= {origin} + t - {max_lags}), r -> r.sales)"
    value = C.let("vals", values, C.let("v", vector, scored))
    day = f"CAST({origin} + t AS INT)"
    step = (f"array_append(acc, named_struct('d_num', {day}, "
            f"'sales', CAST({value}{' * _alpha' if alphas else ''} AS DOUBLE)))")
    if active_days is not None:
        step = f"CASE WHEN array_contains(_act, {day}) THEN {step} ELSE acc END"
    final = F.expr(f"aggregate(sequence(0, {horizon - 1}), hist, (acc, t) -> {step})")
    keep = [id_col] + (["_alpha"] if alphas else [])
    out = hist.select(*keep, F.filter(final, lambda x: x["d_num"] >= origin).alias("_f"))
    return out.select(*keep, F.inline("_f")).withColumnRenamed("sales", "pred")


def exog_effects(rows: DataFrame, coefs: dict, id_col: str = "id") -> DataFrame:
    """(id, d_num, effect): the model's linear terms of day, price and category
    features known ahead of the forecast; a NULL feature adds nothing."""
    effect = sum((F.lit(float(c)) * F.coalesce(F.col(n).cast("double"), F.lit(0.0))
                  for n, c in coefs.items()), F.lit(0.0))
    return rows.select(id_col, "d_num", effect.alias("effect"))


def backtest_recursive(df: DataFrame, last_day: int, days: int = 15, max_lags: int = 57,
                       model: LinearModelSpec = FIXED_MODEL, id_col: str = "id") -> DataFrame:
    """Re-forecast the last ``days`` known days recursively, only on the
    days each series has a row; keep the actuals as ``sales_original``."""
    start = last_day - days + 1
    actual = df.where(F.col("d_num").between(start, last_day))
    preds = recursive_forecast(df, start, days, max_lags, model,
                               active_days=actual.select(id_col, "d_num"))
    return (actual.select(id_col, "d_num", F.col("sales").alias("sales_original"))
                  .join(preds.withColumnRenamed("pred", "sales"), [id_col, "d_num"], "left"))


def backtest_one_step(df: DataFrame, last_day: int, days: int = 15,
                      model: LinearModelSpec = FIXED_MODEL, lags=DEFAULT_LAGS,
                      wins=DEFAULT_WINS, id_col: str = "id") -> DataFrame:
    """Same days, features from the actual history (one window pass,
    no feedback): ``sales_2`` per (id, d_num)."""
    w = W.series_window(id_col)
    feats = {}
    for lag in lags:
        feats[f"lag_{lag}"] = F.lag("sales", lag).over(w)
        for k in wins:
            feats[f"rmean_{lag}_{k}"] = W.rolling("sales", F.avg, k, w, shift=lag)
    scored = df.select(id_col, "d_num", model.predict(feats).alias("sales_2"))
    return scored.where(F.col("d_num").between(last_day - days + 1, last_day))


def backtest_compare(rec: DataFrame, one: DataFrame, from_day: int, id_col: str = "id") -> DataFrame:
    """Full join of the two backtests, from ``from_day``, NULL rows
    dropped, then per-day means of both forecasts and the actuals."""
    joined = rec.join(one, [id_col, "d_num"], "full").where(F.col("d_num") >= from_day).na.drop("any")
    return joined.groupBy("d_num").agg(F.avg("sales").alias("mean_recursive"),
                                       F.avg("sales_2").alias("mean_one_step"),
                                       F.avg("sales_original").alias("mean_actual"))


def blend_factor(alphas, weights=None) -> float:
    """Sum of weight * alpha; the scaled copies' sum reduces to this."""
    weights = weights or [1.0 / len(alphas)] * len(alphas)
    return float(sum(w * a for w, a in zip(weights, alphas)))


def multiplier_blend(preds: DataFrame, alphas, weights=None, col: str = "pred",
                     out: str = "pred_blend") -> DataFrame:
    """Weighted mean of k scaled copies = one scalar multiply."""
    return preds.withColumn(out, F.col(col) * F.lit(blend_factor(alphas, weights)))


def multiplier_in_loop(df: DataFrame, origin: int, alphas, horizon: int = 28,
                       max_lags: int = 57, model: LinearModelSpec = FIXED_MODEL,
                       id_col: str = "id") -> DataFrame:
    """The alpha multiplies each prediction inside the recursion (so it
    feeds later lags); one forecast per alpha, averaged per (id, day).

    The history arrays are built once per series; the alphas fan out from
    them, and all variants run in the same single recursive projection.
    """
    preds = recursive_forecast(df, origin, horizon, max_lags, model, alphas=list(alphas), id_col=id_col)
    return preds.groupBy(id_col, "d_num").agg(F.avg("pred").alias("pred"))


def submission_build(preds: DataFrame, origin: int, horizon: int, alphas,
                     id_col: str = "id") -> DataFrame:
    """Forecast rows -> F1..F{h} labels -> wide -> NULL to 0 -> blend
    -> evaluation copy appended.  Sorting is left to the sink."""
    from shelfcast.operators import reshape as R
    from shelfcast.operators import project as P
    lab = preds.where(F.col("d_num") >= origin).withColumn(
        "F", F.concat(F.lit("F"), F.row_number().over(W.series_window(id_col)).cast("string")))
    wide = R.pivot_horizon(lab, id_col, "F", "pred", horizon)
    cols = [f"F{i}" for i in range(1, horizon + 1)]
    factor = F.lit(blend_factor(alphas))
    scaled = wide.select(id_col, *[(F.coalesce(F.col(c), F.lit(0.0)) * factor).alias(c) for c in cols])
    return P.replicate_with_new_id(scaled, id_col)
