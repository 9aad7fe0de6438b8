"""Compiled models, categorical features, boosting history, rolling moments, exact selection, kNN bounds."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, GeneralizedLinearRegression, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfcast.operators import encode as E
from shelfcast.operators import neighbors as NB
from shelfcast.operators import split as K
from shelfcast.operators import windows as W
from shelfcast.plans import compiled as C
from shelfcast.plans import features as FE
from shelfcast.plans import forecast as FC
from shelfcast.plans import models as ML
from shelfcast.sources import views as V

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def nominal(spark):
    r = random.Random(1)
    rows = [(float(r.randrange(50)), r.random() * 10, r.choice(["p", "q", "r", "s", "t", None]), r.choice("xyz")) for _ in range(1500)]
    rows = [(*x, x[0] + (30 if x[2] == "q" else 0) + (20 if x[3] == "z" else 0) + r.random() * 40) for x in rows]
    df = spark.createDataFrame(rows, "a double, b double, c string, d string, label double")
    coder = ML.NominalFeatures(["a", "b"], ["c", "d"]).fit(df)
    odd = spark.createDataFrame([(1.0, 2.0, "new", "x", 0.0), (9.0, 7.0, None, "w", 0.0), (3.0, 1.0, "t", None, 0.0)], df.schema)
    return df, coder, coder.transform(df).cache(), coder.transform(df.unionByName(odd)).cache()


@pytest.mark.parametrize("learner", [
    lambda: DecisionTreeRegressor(maxDepth=5), lambda: RandomForestRegressor(numTrees=7, maxDepth=4, seed=3),
    lambda: GBTRegressor(maxIter=12, maxDepth=3), lambda: LinearRegression(),
    lambda: GeneralizedLinearRegression(family="poisson", link="log")])
def test_compiled_model_equals_transform(nominal, learner):
    _, coder, train, test = nominal
    model = learner().fit(train)
    if hasattr(model, "toDebugString"):
        assert " in {" in model.toDebugString          # category sets were split
    flat = model.transform(test).select("prediction", *[vector_to_array("features")[i].alias(n) for i, n in enumerate(NAMES)])
    rows = flat.withColumn("own", C.model_column(model, NAMES, coder.arity())).collect()
    assert len({round(r.own, 9) for r in rows}) > 3
    for r in rows:
        assert r.own == pytest.approx(r.prediction, rel=1e-9, abs=1e-9)


def test_nominal_metadata_and_unseen_values(nominal):
    df, coder, train, test = nominal
    assert C.nominal_arity(train) == coder.arity() == {2: 7, 3: 4}     # NULL is a value of c; one more for unseen
    code = {(r.c, r.d): tuple(r.v[2:]) for r in test.select("c", "d", vector_to_array("features").alias("v")).collect()}
    assert {c: v[0] for (c, _), v in code.items()} == {None: 0, "p": 1, "q": 2, "r": 3, "s": 4, "t": 5, "new": 6}
    assert {d: v[1] for (_, d), v in code.items()} == {"x": 0, "y": 1, "z": 2, "w": 3, None: 3}
    with pytest.raises(ValueError):
        ML.NominalFeatures([], ["c"], max_categories=3).fit(df)
    model = ML.fit_tree(train, 4, max_bins=coder.max_bins(40))
    assert coder.max_bins(2) == 7 and model.depth >= 1


def test_recursion_with_boosted_trees_equals_a_day_by_day_loop(spark):
    s = V.v_sales(spark, SF_SMALL).select("id", "d_num", "sales")
    lagged = ["lag_7", "lag_28", "rmean_7_7", "rmean_7_28"]
    rows = FE.demand_features(s).withColumn("wday", (F.col("d_num") % 7).cast("double"))
    names = [*lagged, "wday"]
    model = GBTRegressor(maxIter=8, maxDepth=3).fit(ML.assemble_features(rows, names, "sales"))
    origin, horizon = 2501, 12
    known = s.select("id").distinct().select("id", F.explode(F.sequence(F.lit(origin), F.lit(origin + horizon - 1))).alias("d_num"))
    known = known.withColumn("wday", (F.col("d_num") % 7).cast("double"))
    out = FC.recursive_forecast_ml(s, origin, model, names, horizon, exog=known)
    got = {(r.id, r.d_num): r.pred for r in out.collect()}
    hist = {}
    for r in s.where(F.col("d_num").between(origin - 57, origin - 1)).orderBy("d_num").collect():
        hist.setdefault(r.id, []).append((r.d_num, float(r.sales)))
    for day in range(origin, origin + horizon):
        feats = []
        for key, h in hist.items():
            x = [v for d, v in h if d >= day - 57]
            lag = lambda n: x[-n] if len(x) >= n else 0.0
            mean = lambda n, k: float(np.mean(x[len(x) - n - k + 1:len(x) - n + 1])) if len(x) >= n + k - 1 else 0.0
            feats.append((key, lag(7), lag(28), mean(7, 7), mean(7, 28), float(day % 7)))
        day_rows = spark.createDataFrame(feats, "id string, lag_7 double, lag_28 double, rmean_7_7 double, rmean_7_28 double, wday double")
        for r in model.transform(ML.assemble_features(day_rows.withColumn("sales", F.lit(0.0)), names, "sales", ["id"])).collect():
            hist[r.id].append((day, r.prediction))
            assert got[r.id, day] == pytest.approx(r.prediction, rel=1e-9)
    assert len(got) == len(hist) * horizon
    with pytest.raises(ValueError):
        FC.recursive_forecast_ml(s, origin, model, names, horizon)


def test_recursion_plan_does_not_grow_with_the_horizon(spark):
    s = V.v_sales(spark, SF_SMALL).select("id", "d_num", "sales")
    names = ["lag_7", "rmean_7_7"]
    model = DecisionTreeRegressor(maxDepth=3).fit(ML.assemble_features(FE.demand_features(s), names, "sales"))
    text = [FC.recursive_forecast_ml(s, 2501, model, names, h)._jdf.queryExecution().executedPlan().toString() for h in (2, 28)]
    assert text[0].count("Exchange") == text[1].count("Exchange") and "Python" not in text[1]


def test_boosting_history_and_patience(nominal):
    _, _, train, test = nominal
    full = ML.fit_gbt_rounds(train, test, max_iter=12, max_depth=2)
    assert len(full.errors) == 12 and full.best == int(np.argmin(full.errors)) + 1
    part = ML.fit_gbt_rounds(train, test, max_iter=12, max_depth=2, patience=3)
    assert part.errors == pytest.approx(full.errors[:len(part.errors)])
    rows = full.history(train.sparkSession).collect()
    assert sum(r.is_best for r in rows) == 1 and min(rows, key=lambda r: r.error).is_best


def test_rolling_moments_equal_pandas(spark):
    r = np.random.default_rng(2)
    parts = {"a": r.normal(0, 1, 150), "b": r.normal(1e9, 3, 150), "c": np.repeat([2.5, 2.5, 7.0], 50), "d": r.random(40)}
    parts["a"][60] = np.nan
    pdf = pd.concat([pd.DataFrame({"id": k, "d_num": range(len(v)), "x": v}) for k, v in parts.items()])
    df = spark.createDataFrame([(a, int(b), None if np.isnan(c) else float(c)) for a, b, c in pdf.values.tolist()],
                               "id string, d_num int, x double")
    specs = [("s7", "std", 7, 0), ("s30", "std", 30, 3), ("w30", "skew", 30, 3), ("k30", "kurt", 30, 3), ("k5", "kurt", 5, 0),
             ("w64", "skew", 64, 1)]
    out = W.rolling_moments(df, "x", specs, W.series_window())
    assert out.columns == ["id", "d_num", "x"] + [s[0] for s in specs]
    got = out.toPandas().sort_values(["id", "d_num"]).reset_index(drop=True)
    for name, kind, k, shift in specs:
        want = pdf.groupby("id")["x"].transform(lambda x: getattr(x.shift(shift).rolling(k), kind)()).reset_index(drop=True)
        # Exact per-window values; pandas' own running sums drift on the large totals.
        exact = pdf.groupby("id")["x"].transform(lambda x: x.shift(shift).rolling(k).apply(
            lambda v: getattr(pd.Series(v), kind)() if kind == "std" or np.ptp(v) else np.nan, raw=True)).reset_index(drop=True)
        assert (got[name].isna() == exact.isna()).all(), name
        np.testing.assert_allclose(got[name].dropna(), exact.dropna(), rtol=1e-6, atol=1e-6, err_msg=name)
        assert len(want) == len(got)


def test_exact_holdout_of_repeated_keys(spark):
    rows = [(i if i % 3 else 7, i % 5, "x" * (i % 2)) for i in range(900)] + [(None, 1, None)] * 40
    df = spark.createDataFrame(rows, "k long, v int, t string")
    by_key = {(r.k): r.h for r in df.select("k", K.key_hash("k").alias("h")).distinct().collect()}
    for n in (0, 1, 150, 200, 311, 450, 500, 939, 940, 2000):
        out = K.holdout_exact_n(df, n, ["k"])
        got = out.where("is_holdout")
        assert out.count() == 940 and got.count() == min(n, 940)
        assert out.drop("is_holdout").exceptAll(df).count() == 0
        inside = {by_key[r.k] for r in got.select("k").distinct().collect()}
        outside = {by_key[r.k] for r in out.where("not is_holdout").select("k").distinct().collect()}
        assert not inside or not outside or max(inside) <= min(outside)


def test_exact_holdout_writes_nothing(spark, monkeypatch):
    monkeypatch.setattr(K, "cut_lineage", lambda *a, **k: pytest.fail("the input is written"))
    df = spark.range(5000).withColumnRenamed("id", "k")
    assert K.holdout_exact_n(df, 1234, ["k"]).where("is_holdout").count() == 1234


def test_equal_rows_are_cut_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(K, "COPIES", 10)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    df = spark.range(500).select(F.lit(3).alias("k"), F.lit("same").alias("t"))
    out = K.holdout_exact_n(df, 123, ["k"])
    assert out.count() == 500 and out.where("is_holdout").count() == 123
    assert out.where("is_holdout").select(F.spark_partition_id().alias("p")).distinct().count() > 1
    spark.conf.set(key, before)


def test_systematic_sample_with_a_hot_day(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "211")
    try:
        rows = [(5 if i % 3 == 0 else i % 17, i) for i in range(6000)] + [(None, 6000 + i) for i in range(700)]
        df = spark.createDataFrame(rows, "d int, id int").repartition(40)
        want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))[::13]
        for hot in (10_000, 600, 100):
            got = K.systematic_sample(df, 13, ["d", "id"], hot_rows=hot).collect()
            assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    finally:
        spark.conf.set(key, before)


def test_one_hot_vector_and_width_guard(spark, monkeypatch):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "x string")
    rows, names = E.one_hot_vector(df, "x")
    got = sorted((r.x or "", r.v) for r in rows.select("x", vector_to_array("one_hot").alias("v")).collect())
    assert got == [("", [0, 0, 0]), ("a", [1, 0, 0]), ("a", [1, 0, 0]), ("b", [0, 1, 0]), ("c", [0, 0, 1])]
    assert {(r["index"], r["value"]) for r in names.collect()} == {(0, "a"), (1, "b"), (2, "c")}
    monkeypatch.setattr(E, "MAX_COLUMNS", 2)
    with pytest.raises(ValueError):
        E.one_hot(df, "x")
    assert E.one_hot(df, "x", values=["a", "b", "c"]).columns == ["x", "a", "b", "c"]


def test_knn_sends_bounded_frames():
    """A batch of queries that visits every block is not held with a vector for each visit."""
    r = np.random.default_rng(3)
    n, names = 300, [f"{i}/0/0" for i in range(400)]
    table = pd.DataFrame({"block": names, "cell": range(400), "ring": 0, "n": 5, "low": 0.0, "high": 100.0})
    blocks = NB.Blocks(r.normal(0, 1, (400, 64)), table)
    q = pd.DataFrame({"query_id": range(n), "v": list(r.normal(0, 1, (n, 64))), "reach": 9.0})

    class Sent:
        value = blocks

    class Queries:
        def mapInPandas(self, run, schema):
            return list(run(iter([q])))

    for visits, each in ((NB._first_visits(Queries(), Sent, 12), 3), (NB._other_visits(Queries(), Sent, 12), 397)):
        assert max(len(f) for f in visits) * 64 <= 1_000_000 and not any(f.empty for f in visits)
        rows = pd.concat(visits)
        assert len(rows) == n * each == len(rows[["query_id", "block"]].drop_duplicates())
        assert all((v == q["v"][i]).all() for i, v in zip(rows["query_id"][::50], rows["v"][::50]))


def test_knn_cuts_rows_at_one_distance(spark):
    """Copies of a vector have one distance to every pivot and still fill no block above its size."""
    df = spark.range(3000).select(F.col("id").alias("vec_id"), F.array(*[F.when(F.col("id") < 2500, 1.0).otherwise(
        F.col("id") * i) for i in (1, 2)]).alias("v"), (F.col("id") % 3).cast("double").alias("label"))
    rows, blocks = NB.training_blocks(df, 4, 100)
    assert sum(blocks.size) == rows.count() == 3000 and max(blocks.size) < 250


def test_knn_prunes_clustered_rows_and_stays_exact(spark):
    r = np.random.default_rng(6)
    centre = r.normal(0, 100, (12, 6))
    v = np.round(centre[r.integers(0, 12, 1500)] + r.normal(0, 1, (1500, 6)), 1)
    v[700:760] = v[700]                                  # ties
    df = spark.createDataFrame([(i, x.tolist(), int(i % 4)) for i, x in enumerate(v)], "vec_id long, embedding array<double>, label int")
    train, queries = df.where("vec_id % 5 > 0"), df.where("vec_id % 5 = 0")
    t = [i for i in range(1500) if i % 5]
    want = {}
    for q in range(0, 1500, 5):
        d = ((v[t] - v[q]) ** 2).sum(1)
        near = np.lexsort((t, d))[:10]
        want[q] = np.mean([t[i] % 4 for i in near])
    got = {r.query_id: r.prediction for r in NB.knn_regress(train, queries, 10, block_rows=40, pivots=12).collect()}
    assert got == pytest.approx(want)
    visits = NB.knn_visits(train, queries, 10, block_rows=40, pivots=12).collect()
    assert sum(x.visits for x in visits) < 0.4 * visits[0]["all"]
