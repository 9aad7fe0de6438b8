"""Literal-row tests for the semantic traps (FIXTURES.md §3)."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.functions import numeric as N
from shelfcast.functions import strings as S
from shelfcast.operators import encode as E
from shelfcast.operators import joins as J
from shelfcast.operators import reshape as R
from shelfcast.operators import windows as W


def _codes(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    out = E.category_codes(df, ["c"]).orderBy("i")
    return [r["c"] for r in out.collect()]


def test_category_codes_null_aware(spark):
    assert _codes(spark, ["b", None, "a", "c", "a"]) == [2, 0, 1, 3, 1]
    assert _codes(spark, ["b", "a", "c", "a"]) == [1, 0, 2, 0]


def test_label_encode_keeps_null(spark):
    df = spark.createDataFrame([(0, "b"), (1, None), (2, "a")], "i int, c string")
    out = E.label_encode_keep_null(df, ["c"]).orderBy("i")
    assert [r["c"] for r in out.collect()] == [1, None, 0]


def _series(n=80, null_at=20, seed=3):
    rng = np.random.default_rng(seed)
    vals = rng.poisson(4, n).astype(float)
    vals[null_at] = np.nan
    return vals


def _pd_col(s):
    return [None if (v is None or (isinstance(v, float) and math.isnan(v))) else v for v in s]


@pytest.mark.parametrize("integral", [False, True])
def test_rolling_guard_matches_pandas(spark, integral):
    vals = _series()
    rows = [("s", i + 1, None if np.isnan(v) else float(v)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "id string, d_num int, sales double")
    out = W.rolling_mean_of_lag(df, (7,), (7,), integral=integral).orderBy("d_num")
    got = [r["rmean_7_7"] for r in out.collect()]
    exp = _pd_col(pd.Series(vals).shift(7).rolling(7).mean())
    assert [g is None for g in got] == [e is None for e in exp]
    for g, e in zip(got, exp):
        if e is not None:
            assert abs(g - e) < 1e-12


@pytest.mark.parametrize("integral", [False, True])
def test_moments_match_pandas(spark, integral):
    rng = np.random.default_rng(11)
    vals = rng.poisson(5, 80).astype(float)
    rows = [("s", i + 1, float(v)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "id string, d_num int, demand double")
    out = W.rolling_horizon_features(df, 0, (), (30,), 30, integral=integral).orderBy("d_num")
    got = out.collect()
    ps = pd.Series(vals)
    for name, exp in [("rolling_std_t30", ps.rolling(30).std()),
                      ("rolling_skew_t30", ps.rolling(30).skew()),
                      ("rolling_kurt_t30", ps.rolling(30).kurt())]:
        for r, e in zip(got, exp):
            if math.isnan(e):
                assert r[name] is None
            else:
                assert abs(r[name] - e) < 1e-9, (name, r[name], e)


def test_flat_window_moments_are_null(spark):
    rows = [("s", i + 1, 2.0) for i in range(40)]
    df = spark.createDataFrame(rows, "id string, d_num int, demand double")
    for integral in (False, True):
        out = W.rolling_horizon_features(df, 0, (), (), 30, integral=integral)
        assert out.where(F.col("rolling_kurt_t30").isNotNull()).count() == 0


def test_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.135,)], "x double")
    got = [r[0] for r in df.select(N.round_half_even("x", 2)).collect()]
    assert got == [0.12, 0.14]


def test_day_number_and_binary(spark):
    df = spark.createDataFrame([("d_1913", 5)], "d string, n long")
    assert df.select(S.extract_day_number("d")).first()[0] == 1913
    bits = E.binary_encode(df, "n", 10, prefix="b").first()
    assert "".join(str(bits[f"b{i}"]) for i in range(10)) == "0000000101"


def test_unpivot_keeps_null(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", 3.0, 4.0)], "id string, d_1 double, d_2 double")
    out = R.unpivot_days(df, ["id"])
    assert out.count() == 4
    assert out.where(F.col("sales").isNull()).count() == 1


def test_price_gap_inner_vs_left(spark):
    panel = spark.createDataFrame(
        [("s", "i", "st", w, d, float(d)) for d, w in [(1, 1), (2, 1), (8, 2), (15, 3)]],
        "id string, item_id string, store_id string, wm_yr_wk int, d_num int, sales double")
    prices = spark.createDataFrame([("i", "st", 1, 2.0), ("i", "st", 3, 2.5)],
                                   "item_id string, store_id string, wm_yr_wk int, sell_price double")
    inner = J.join_prices(panel, prices, "inner")
    left = J.join_prices(panel, prices, "left")
    assert inner.count() == 3 and left.count() == 4
    lagged = W.lag_features(inner, (1,)).where("d_num = 15").first()
    assert lagged["lag_1"] == 2.0  # the unpriced day 8 is skipped by the row lag


def test_narrow_types_strict_limits(spark):
    df = spark.createDataFrame([(0, 127), (1, 5)], "a int, b int")
    plan = {r["column"]: r["narrow_type"] for r in E.narrow_plan(df).collect()}
    assert plan == {"a": "tinyint", "b": "smallint"}
    narrowed = E.narrow_types(df)
    assert dict(narrowed.dtypes) == {"a": "tinyint", "b": "smallint"}


@pytest.mark.parametrize("largest", [True, False])
@pytest.mark.parametrize("k,shift", [(7, 0), (30, 1), (365, 1), (5, 3)])
def test_rolling_extreme_matches_frame(spark, largest, k, shift):
    rng = np.random.default_rng(k + shift)
    rows = []
    for s in range(3):
        for d in range(1, 420):
            v = None if rng.random() < 0.01 else float(rng.normal(10, 3))
            rows.append((f"s{s}", d, v))
    df = spark.createDataFrame(rows, "id string, d_num int, x double")
    w = W.series_window()
    agg = F.max if largest else F.min
    exp = df.select("id", "d_num", W.rolling("x", agg, k, w, shift).alias("m"))
    got = W.rolling_extreme(df, "x", k, w, shift, "m", largest).select("id", "d_num", "m")
    assert exp.exceptAll(got).count() == 0 and got.exceptAll(exp).count() == 0


def test_running_total_means_equal_frame_means(spark):
    rng = np.random.default_rng(5)
    rows = [(f"s{s}", d, None if rng.random() < 0.02 else float(rng.integers(0, 50)))
            for s in range(4) for d in range(1, 300)]
    df = spark.createDataFrame(rows, "id string, d_num int, sales double")
    a = W.rolling_mean_of_lag(df, (0, 7, 28), (7, 28, 90), integral=True)
    b = W.rolling_mean_of_lag(df, (0, 7, 28), (7, 28, 90), integral=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_group_stat_back_equals_window(spark):
    from pyspark.sql import Window
    rows = [(i, f"g{i % 3}", float(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "i int, g string, x double")
    got = J.join_group_stat_back(df, ["g"], "x", "m").select("i", "m")
    exp = df.select("i", F.avg("x").over(Window.partitionBy("g")).alias("m"))
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_pacf_matches_yule_walker(spark):
    from shelfcast.operators.diagnostics import durbin_levinson
    rng = np.random.default_rng(2)
    x = np.cumsum(rng.normal(size=400)) * 0.1 + rng.normal(size=400)
    x = x - x.mean()
    n = len(x)
    r = np.array([np.dot(x[k:], x[:n - k]) / np.dot(x, x) for k in range(11)])
    one = spark.createDataFrame([([float(x) for x in r],)], "r array<double>")
    got = one.select(durbin_levinson("r", len(r) - 1)).first()[0]
    for k in range(1, 11):
        toeplitz = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        phi = np.linalg.solve(toeplitz, r[1:k + 1])
        assert abs(got[k] - phi[-1]) < 1e-10


def test_running_totals_refuse_fractional_input(spark):
    df = spark.createDataFrame([("s", i, 1.5) for i in range(1, 10)], "id string, d_num int, sales double")
    with pytest.raises(Exception):
        W.rolling_mean_of_lag(df, (1,), (3,), integral=True).collect()


def test_one_hot_wide_sets(spark):
    df = spark.range(0, 2000).select(F.col("id").cast("string").alias("c"))
    assert len(E.one_hot(df, "c", prefix="c_").columns) == 2001
    out = E.one_hot(df.where("id < 3"), "c", prefix="c_")
    assert [c for c in out.columns if c.startswith("c_")] == ["c_0", "c_1", "c_2"]
    sparse = E.one_hot_sparse(spark.createDataFrame([("b",), (None,), ("a",)], "c string"), "c")
    assert {r.c: tuple(r.one_hot) for r in sparse.collect()} == {"a": (2, 0), "b": (2, 1), None: (2, None)}


def test_id_alignment_is_multiset(spark):
    from shelfcast.operators import aggs as A
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "id string")
    b = spark.createDataFrame([("x",), ("y",), ("z",)], "id string")
    r = A.check_id_alignment(a, b).first()
    assert (r["only_left"], r["only_right"], r["aligned"]) == (1, 1, False)
    assert A.check_id_alignment(a, a).first()["aligned"]


def test_narrow_plan_floats(spark):
    df = spark.createDataFrame([(1.5, 1e39), (-2.0, 0.0)], "a double, b double")
    plan = {r["column"]: r["narrow_type"] for r in E.narrow_plan(df).collect()}
    assert plan == {"a": "float", "b": "double"}


def test_category_codes_any_size(spark):
    vals = ["b", None, "a", "c", "a", "d", "e", None, "b"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, c string")
    assert [r["c"] for r in E.category_codes(df, ["c"]).orderBy("i").collect()] == [2, 0, 1, 3, 1, 4, 5, 0, 2]
    many = spark.range(0, 40_000).select(F.format_string("v%05d", "id").alias("c"), "id")
    got = E.category_codes(many, ["c"])
    assert got.where("c <> id").count() == 0 and dict(got.dtypes)["c"] == "int"
    gap = E.label_encode_keep_null(df, ["c"]).orderBy("i").collect()
    assert [r["c"] for r in gap] == [1, None, 0, 2, 0, 3, 4, None, 1]


def test_moments_of_large_totals(spark):
    import pandas as pd
    x = [float((i * 7919 % 13) * 10**9 + i) for i in range(60)]
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate(x)], "id string, d_num int, demand double")
    got = W.rolling_horizon_features(df, 0, (), (30,), 30, integral=True).orderBy("d_num").collect()
    s = pd.Series(x).rolling(30)
    for r, sd, sk, ku in zip(got, s.std(), s.skew(), s.kurt()):
        if sd == sd:
            assert abs(r.rolling_std_t30 / sd - 1) < 1e-9
            assert abs(r.rolling_skew_t30 - sk) < 1e-6 and abs(r.rolling_kurt_t30 - ku) < 1e-6


def test_constant_series_has_no_autocorrelation(spark):
    from shelfcast.operators import diagnostics as M
    df = spark.createDataFrame([("flat", i, 3.0) for i in range(20)] + [("x", i, float(i % 5)) for i in range(20)],
                               "id string, d_num int, sales double")
    for out, col in ((M.acf(df, 4), "acf"), (M.pacf(df, 4), "pacf")):
        rows = out.collect()
        assert all(r[col] is None for r in rows if r.id == "flat")
        assert all(r[col] is not None for r in rows if r.id == "x")


def test_day_outside_the_calendar_raises(spark):
    from shelfcast.sources import views as V
    df = spark.sql("SELECT DATE'2002-06-01' AS date")
    with pytest.raises(Exception, match="outside the calendar"):
        df.select(V.in_calendar("date")).collect()


def test_replicate_refuses_unchanged_ids(spark):
    from shelfcast.operators import project as P
    df = spark.createDataFrame([("a_validation",), ("b",)], "id string")
    with pytest.raises(Exception, match="id without"):
        P.replicate_with_new_id(df).collect()
    got = P.replicate_with_new_id(df.where("id <> 'b'")).collect()
    assert sorted(r.id for r in got) == ["a_evaluation", "a_validation"]


def test_knn_true_differences(spark):
    from shelfcast.operators.neighbors import knn_regress
    base = 1e8
    train = spark.createDataFrame([(i, [base + i, base - i, base], float(i)) for i in range(20)],
                                  "vec_id long, embedding array<double>, label double")
    query = spark.createDataFrame([(100, [base + 14.2, base - 13.9, base])], "vec_id long, embedding array<double>")
    assert knn_regress(train, query, 1).first().prediction == 14.0
