"""Model fitting with ``pyspark.ml`` (ops L1-L13, K5, G3, G4).

The reference trains single-machine boosters (LightGBM / XGBoost /
scikit-learn).  Here each user-level step is re-aimed at ``pyspark.ml``,
which trains on the partitioned data:

* Poisson boosting has no Spark counterpart: ``fit_poisson`` is a Poisson
  GLM (log link); ``fit_gbt_early_stop`` is squared-loss GBT with a
  validation column for early stopping.
* Random search is a set of random ``ParamMap``s scored by ``CrossValidator``
  (parallel fits); its result is a trials table (G4 picks the best).

Values of predictions therefore differ from the reference; the structure
(features, splits, early stopping, blending, stacking) is kept.
"""

from __future__ import annotations

import random
import uuid

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor,
                                   GeneralizedLinearRegression, LinearRegression,
                                   RandomForestRegressor)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import project as P
from shelfcast.plans import compiled as C
from shelfcast.session import cut_lineage, ensure_checkpoint_dir


def assemble_features(df: DataFrame, feature_cols: list[str], label_col: str = "sales",
                      keep: list[str] | None = None) -> DataFrame:
    """L1: rows with a NULL feature are dropped (as the reference's dropna
    before training), then the features go into one vector column."""
    clean = P.drop_nulls(df, subset=feature_cols + [label_col])
    vec = VectorAssembler(inputCols=feature_cols, outputCol="features")
    return vec.transform(clean).select(*(keep or []), "features",
                                       F.col(label_col).cast("double").alias("label"))


#: Stands for NULL while values are numbered; it sorts before all others.
_NULL = "\x00"


class NominalFeatures:
    """L1 with categorical features: codes with nominal metadata in the vector.

    ``fit`` numbers every categorical column's values in sorted order (NULL
    first, and only when NULLs exist, as J1 does); ``transform`` writes
    ``features`` with the numeric columns first, then the codes.  A value that
    was not seen in ``fit`` (or a NULL where there was none) gets a code of its
    own, the last one.  The vector's metadata marks the codes as nominal with
    their number of values, so Spark's trees split them by category sets.

    The number of values is measured before any reaches the driver: a tree
    needs a bin per category in every task, so a column above
    ``max_categories`` raises and belongs in a numeric or sparse encoding.
    """

    def __init__(self, numeric: list[str], categorical: list[str], max_categories: int = 4096):
        self.numeric, self.categorical, self.max_categories = list(numeric), list(categorical), max_categories
        self.names = self.numeric + self.categorical
        self.indexer = None

    def _text(self, df: DataFrame) -> DataFrame:
        return df.select("*", *[F.coalesce(F.col(c).cast("string"), F.lit(_NULL)).alias(f"_v_{c}") for c in self.categorical])

    def fit(self, df: DataFrame) -> "NominalFeatures":
        if not self.categorical:
            return self
        text = self._text(df)
        sizes = text.agg(*[F.approx_count_distinct(f"_v_{c}", 0.02).alias(c) for c in self.categorical]).first()
        wide = {c: sizes[c] for c in self.categorical if sizes[c] > self.max_categories}
        if wide:
            raise ValueError(f"more than {self.max_categories} categories: {wide}")
        self.indexer = StringIndexer(inputCols=[f"_v_{c}" for c in self.categorical],
                                     outputCols=[f"_c_{c}" for c in self.categorical],
                                     stringOrderType="alphabetAsc", handleInvalid="keep").fit(text)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` plus ``features``; rows with a NULL numeric feature are dropped."""
        out = P.drop_nulls(df, subset=self.numeric) if self.numeric else df
        if self.categorical:
            out = self.indexer.transform(self._text(out))
        vec = VectorAssembler(inputCols=self.numeric + [f"_c_{c}" for c in self.categorical], outputCol="features")
        return vec.transform(out).select(*df.columns, "features")

    def codes(self, df: DataFrame) -> DataFrame:
        """``df`` with its categorical columns replaced by their codes (for ``exog`` rows)."""
        if not self.categorical:
            return df
        coded = self.indexer.transform(self._text(df))
        return coded.select(*[F.col(f"_c_{c}").alias(c) if c in self.categorical else F.col(c) for c in df.columns])

    def arity(self) -> dict[int, int]:
        """Feature index -> number of categories, the one for unseen values included."""
        labels = self.indexer.labelsArray if self.categorical else []
        return {len(self.numeric) + i: len(v) + 1 for i, v in enumerate(labels)}

    def max_bins(self, least: int = 32) -> int:
        """Bins a tree needs: one per category."""
        return max([least, *self.arity().values()])


def fit_poisson(train: DataFrame, reg: float = 0.0):
    """L2: count regression, Poisson family, log link."""
    return GeneralizedLinearRegression(family="poisson", link="log", maxIter=25,
                                       regParam=reg).fit(train)


def fit_gbt_early_stop(train: DataFrame, validation_col: str = "is_val", max_iter: int = 100,
                       max_depth: int = 5, step: float = 0.1, tol: float = 0.01, seed: int = 7):
    """L3: boosted trees, squared loss, stops when the validation error stops
    improving (``validationIndicatorCol``)."""
    return GBTRegressor(maxIter=max_iter, maxDepth=max_depth, stepSize=step,
                        validationIndicatorCol=validation_col, validationTol=tol,
                        seed=seed).fit(train)


class BoostedRounds:
    """A boosted model with its error per round on validation rows.

    ``history``: (round, error, is_best) with the mean squared error of the
    first ``round`` trees; ``best`` is the round of the smallest error (the
    first of equals), and ``transform`` scores with that many trees.
    """

    def __init__(self, model, errors: list[float]):
        self.model, self.errors = model, errors
        self.best = errors.index(min(errors)) + 1

    def history(self, spark) -> DataFrame:
        return spark.createDataFrame([(i + 1, e, i + 1 == self.best) for i, e in enumerate(self.errors)],
                                     "round int, error double, is_best boolean")

    def column(self, columns: list[str], arity: dict[int, int] | None = None):
        """The kept trees over named columns (compiled, no vector)."""
        return C.model_column(self.model, columns, arity, first=self.best)


def fit_gbt_rounds(train: DataFrame, validation: DataFrame, max_iter: int = 100, max_depth: int = 5,
                   step: float = 0.1, max_bins: int = 32, patience: int | None = None, seed: int = 7) -> BoostedRounds:
    """L3 with its evaluation history: the trees are grown on ``train``, every
    round's error is taken on ``validation``, and the best round is kept.

    ``patience``: rounds without improvement after which boosting ends.  The
    forest grows in steps of ``patience`` rounds, so no more than two such
    steps are grown beyond the best round; a longer forest repeats the trees
    of a shorter one (same rows, same seed), so the result does not depend on
    the steps.
    """
    rounds = min(max_iter, patience or max_iter)
    while True:
        model = GBTRegressor(maxIter=rounds, maxDepth=max_depth, stepSize=step, maxBins=max_bins, seed=seed).fit(train)
        errors = [float(e) for e in model.evaluateEachIteration(validation, "squared")]
        best = errors.index(min(errors)) + 1
        if rounds >= max_iter or (patience and rounds - best >= patience):
            if patience:
                errors = errors[:min(rounds, best + patience)]
            return BoostedRounds(model, errors)
        rounds = min(max_iter, max(rounds * 2, rounds + (patience or 0)))


def fit_random_forest(train: DataFrame, trees: int = 20, max_depth: int = 5, seed: int = 7, max_bins: int = 32):
    """L4: bagged trees."""
    return RandomForestRegressor(numTrees=trees, maxDepth=max_depth, seed=seed, maxBins=max_bins).fit(train)


def fit_tree(train: DataFrame, max_depth: int = 5, max_bins: int = 32):
    """A single regression tree."""
    return DecisionTreeRegressor(maxDepth=max_depth, maxBins=max_bins).fit(train)


def fit_linear(train: DataFrame, reg: float = 0.01, l1_ratio: float = 0.5):
    """Linear model with L1/L2 (elastic net); the parameters are passed."""
    return LinearRegression(regParam=reg, elasticNetParam=l1_ratio).fit(train)


def vote_mean(df: DataFrame, pred_cols: list[str], out: str = "pred_vote") -> DataFrame:
    """Mean of the base models' prediction columns."""
    total = sum((F.col(c) for c in pred_cols[1:]), F.col(pred_cols[0]))
    return df.withColumn(out, total / len(pred_cols))


def predict_as(model, df: DataFrame, name: str) -> DataFrame:
    return model.transform(df).withColumnRenamed("prediction", name)


class Stack:
    """Base models fitted on all training rows and the final model above them."""

    def __init__(self, bases: dict, final):
        self.bases, self.final = bases, final

    def transform(self, rows: DataFrame) -> DataFrame:
        """Score new rows: every base model in a chain, then the final one."""
        for name, model in self.bases.items():
            rows = model.setPredictionCol(name).transform(rows)
        vec = VectorAssembler(inputCols=list(self.bases), outputCol="base_preds")
        return self.final.transform(vec.transform(rows))


def stack_models(train: DataFrame, fold_col: str, base_factories: dict, final_factory,
                 folds: int) -> Stack:
    """The final model learns from out-of-fold predictions.

    Per fold, the base models fitted on the other folds score the fold's rows
    in a chain, so their predictions are columns of one row and nothing is
    joined; the folds' rows are stacked and written once.
    """
    vec = VectorAssembler(inputCols=list(base_factories), outputCol="base_preds")
    meta = None
    for f in range(folds):
        rows = train.where(F.col(fold_col) == f)
        for name, factory in base_factories.items():
            model = factory().setPredictionCol(name).fit(train.where(F.col(fold_col) != f))
            rows = model.transform(rows)
        part = vec.transform(rows).select("base_preds", "label")
        meta = part if meta is None else meta.unionByName(part)
    final = final_factory().setFeaturesCol("base_preds").fit(cut_lineage(meta))
    return Stack({n: fac().fit(train) for n, fac in base_factories.items()}, final)


def random_search(train: DataFrame, n_iter: int = 10, folds: int = 2, seed: int = 767,
                  parallelism: int = 4, fold_col: str = "fold") -> DataFrame:
    """L11 (with K5): ``n_iter`` random GBT parameter sets, each scored by
    ``folds``-fold cross-validation on the given fold column (0..folds-1), so
    scores do not depend on partitioning; returns the trials table
    (trial, max_depth, step_size, max_iter, rmse)."""
    rng = random.Random(seed)
    gbt = GBTRegressor(seed=seed)
    grid = []
    for _ in range(n_iter):
        pm = (ParamGridBuilder()
              .addGrid(gbt.maxDepth, [rng.choice([3, 4, 5, 6])])
              .addGrid(gbt.stepSize, [round(rng.uniform(0.05, 0.3), 4)])
              .addGrid(gbt.maxIter, [rng.choice([5, 10, 15])]).build())
        grid += pm
    cv = CrossValidator(estimator=gbt, estimatorParamMaps=grid, numFolds=folds,
                        evaluator=RegressionEvaluator(metricName="rmse"),
                        parallelism=parallelism, seed=seed, foldCol=fold_col)
    fitted = cv.fit(train)
    spark = train.sparkSession
    rows = [(i, pm[gbt.maxDepth], float(pm[gbt.stepSize]), pm[gbt.maxIter], float(score))
            for i, (pm, score) in enumerate(zip(grid, fitted.avgMetrics))]
    return spark.createDataFrame(rows, "trial int, max_depth int, step_size double, "
                                       "max_iter int, rmse double")


def kfold_cv(train: DataFrame, fold_col: str, estimator=None, folds: int = 2) -> float:
    """K5: ``folds``-fold CV on a key-hash fold column (deterministic folds,
    values 0..folds-1)."""
    est = estimator or LinearRegression()
    cv = CrossValidator(estimator=est, estimatorParamMaps=ParamGridBuilder().build(),
                        evaluator=RegressionEvaluator(metricName="rmse"), foldCol=fold_col,
                        numFolds=folds)
    return float(cv.fit(train).avgMetrics[0])


def importances(model, feature_names: list[str], spark, fold: int = 0) -> DataFrame:
    """Feature importances of a tree model as rows (fold, feature, importance)."""
    imp = model.featureImportances.toArray().tolist()
    return spark.createDataFrame([(fold, n, float(v)) for n, v in zip(feature_names, imp)],
                                 "fold int, feature string, importance double")


def fold_mean_predictions(preds: DataFrame, keys: list[str], col: str = "pred") -> DataFrame:
    """Mean over the fold models' predictions per key."""
    return preds.groupBy(*keys).agg(F.avg(col).alias(col))


def model_path(spark, name: str) -> str:
    """A new folder under the shared checkpoint directory (never machine-local
    on a cluster); every call names another one, so jobs do not meet."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/models/{name}-{uuid.uuid4().hex}"


def persist_model(model, spark, name: str):
    """Save and load back (Pipeline models keep their stages)."""
    path = model_path(spark, name)
    model.write().save(path)
    return type(model).load(path)


def two_stage(train: DataFrame, holdout: DataFrame, first_cols: list[str],
              second_cols: list[str]):
    """A second model on (context columns, first prediction), fit on
    the first model's holdout."""
    first = Pipeline(stages=[VectorAssembler(inputCols=first_cols, outputCol="features"),
                             GBTRegressor(maxIter=10, maxDepth=4, seed=7)]).fit(train)
    stage1 = first.transform(holdout).withColumnRenamed("prediction", "pred1") \
        .drop("features")
    second = Pipeline(stages=[VectorAssembler(inputCols=second_cols + ["pred1"],
                                              outputCol="features"),
                              GBTRegressor(maxIter=10, maxDepth=4, seed=7)]).fit(stage1)
    return first, second

