"""Invariants: splits, folds, reshaping, forecast modes, ordering."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.operators import ordering as O
from shelfcast.operators import reshape as R
from shelfcast.operators import split as K
from shelfcast.plans import forecast as FC
from shelfcast.sources import views as V

from conftest import SF_SMALL


def test_three_way_split_disjoint_and_complete(spark):
    p = V.v_panel(spark, SF_SMALL).select("id", "d_num")
    parts = K.split_three_way(p, ["id", "d_num"])
    assert parts.count() == p.count()
    assert parts.groupBy("id", "d_num").count().where("count > 1").count() == 0


def test_holdout_exact_n(spark):
    p = V.v_panel(spark, SF_SMALL).select("id", "d_num")
    out = K.holdout_exact_n(p, 100, ["id", "d_num"])
    assert out.where("is_holdout").count() == 100
    assert out.count() == p.count()


def test_global_row_number_matches_window(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"), "id")
    got = O.global_row_number(df, ["k", "id"], num_partitions=7)
    exp = df.withColumn("rn", F.row_number().over(Window.orderBy("k", "id")))
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_tail_after_n_brute_force(spark):
    s = V.v_sales(spark, SF_SMALL).select("id", "d_num", "sales")
    got = R.tail_after_n(s, 777)
    exp = (s.withColumn("rn", F.row_number().over(Window.orderBy("d_num", "id")))
            .where("rn > 777").drop("rn"))
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_timeseries_folds_do_not_overlap(spark):
    s = V.v_sales(spark, SF_SMALL).select("id", "d_num")
    folds = K.timeseries_cv(s, 3, 365, 28)
    bounds = folds.groupBy("fold", "role").agg(F.min("d_num").alias("lo"), F.max("d_num").alias("hi"))
    rows = {(r["fold"], r["role"]): (r["lo"], r["hi"]) for r in bounds.collect()}
    for f in range(3):
        assert rows[(f, "train")][1] < rows[(f, "test")][0]


def test_pivot_unpivot_round_trip(spark):
    df = spark.createDataFrame([("a", f"F{i}", float(i)) for i in range(1, 29)] +
                               [("b", "F1", 5.0)], "id string, F string, sales double")
    wide = R.pivot_horizon(df, "id", "F", "sales", 28)
    back = R.unpivot_days(wide, ["id"], [f"F{i}" for i in range(1, 29)], "F", "sales") \
        .where(F.col("sales").isNotNull())
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_multiplier_in_loop_with_unit_alpha_equals_forecast(spark):
    s = V.v_sales(spark, SF_SMALL).select("id", "d_num", "sales")
    a = FC.recursive_forecast(s, 2501, 10).select("id", "d_num", F.round("pred", 9).alias("p"))
    b = FC.multiplier_in_loop(s, 2501, [1.0], 10).select("id", "d_num", F.round("pred", 9).alias("p"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_horizon_one_equals_one_step_on_dense_history(spark):
    # Dense synthetic series: the 57-day slice holds every lagged row needed.
    rows = [("s%d" % j, d, float((d * (j + 3)) % 11)) for j in range(3) for d in range(1, 200)]
    df = spark.createDataFrame(rows, "id string, d_num int, sales double")
    rec = FC.recursive_forecast(df.where("d_num < 199"), 199, 1).select("id", "d_num", "pred")
    one = FC.backtest_one_step(df, 199, 1).select("id", "d_num", F.col("sales_2").alias("pred"))
    diff = rec.join(one, ["id", "d_num"]).where(F.abs(rec.pred - one.pred) > 1e-9)
    assert rec.count() == 3 and diff.count() == 0


def test_forecast_job_checks_template(spark):
    import pytest
    from shelfcast.operators.project import replicate_with_new_id
    from shelfcast.plans.job import train_and_forecast
    sales = V.v_sales(spark, SF_SMALL).select(
        F.concat("id", F.lit("_validation")).alias("id"), "d_num", "sales")
    template = replicate_with_new_id(sales.select("id").distinct())
    res = train_and_forecast(sales, 2500, first_day=1200, template_ids=template)
    assert res.submission.count() == 2 * sales.select("id").distinct().count()
    assert res.holdout_rmse > 0 and set(res.model.coefs) == {
        "lag_7", "lag_28", "rmean_7_7", "rmean_7_28", "rmean_28_7", "rmean_28_28"}
    with pytest.raises(ValueError):
        train_and_forecast(sales, 2500, first_day=1200,
                           template_ids=template.where(~F.col("id").startswith("Brand#1_")))


def test_holdout_exact_n_matches_brute_force(spark):
    df = spark.range(0, 3000).select(F.col("id").cast("string").alias("k"))
    ranked = df.withColumn("_h", K.key_hash("k")).withColumn(
        "rn", F.row_number().over(Window.orderBy("_h", "k")))
    for n in (0, 1, 1234, 3000, 5000):
        got = K.holdout_exact_n(df, n, ["k"]).where("is_holdout").select("k")
        exp = ranked.where(F.col("rn") <= n).select("k")
        assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
        assert K.holdout_exact_n(df, n, ["k"]).count() == 3000


def test_ml_recursion_equals_expression_recursion_for_linear_model(spark):
    from pyspark.ml.regression import LinearRegression
    from shelfcast.plans import features as FE
    from shelfcast.plans import models as ML
    s = V.v_sales(spark, SF_SMALL).select("id", "d_num", "sales")
    names = ["lag_7", "lag_28", "rmean_7_7", "rmean_7_28", "rmean_28_7", "rmean_28_28"]
    rows = ML.assemble_features(FE.demand_features(s), names, "sales")
    model = LinearRegression(regParam=0.1).fit(rows)
    a = FC.recursive_forecast_ml(s, 2501, model, names, horizon=10)
    b = FC.recursive_forecast(s, 2501, 10, model=FC.LinearModelSpec.from_ml(model, names))
    joined = a.join(b.withColumnRenamed("pred", "p2"), ["id", "d_num"])
    assert joined.count() == a.count() == b.count()
    assert joined.where(F.abs(F.col("pred") - F.col("p2")) > 1e-9).count() == 0


def test_sink_wide_round_trip(spark):
    from shelfcast.sources import sinks as SK
    s = V.v_sales(spark, SF_SMALL).select(F.concat("id", F.lit("_validation")).alias("id"), "d_num", "sales")
    sub = FC.submission_build(FC.recursive_forecast(s, 2501, 28), 2501, 28, [1.0])
    back = SK.sink_wide(sub, SK.output_path(spark, "test-sub"), read_back=True)
    assert back.exceptAll(sub).count() == 0 and sub.exceptAll(back).count() == 0


def test_knn_batches_agree(spark):
    from shelfcast.operators.neighbors import knn_regress
    emb = K.holdout_fraction(V.embeddings(spark, SF_SMALL), 25, ["vec_id"])
    train, queries = emb.where(~F.col("is_holdout")), emb.where("is_holdout")
    one = knn_regress(train, queries, 50)
    many = knn_regress(train, queries, 50, block_rows=30)
    assert one.count() == queries.count()
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


def test_csv_scans_typed_and_inferred(spark, tmp_path):
    from pyspark.sql import types as T
    from shelfcast.operators import encode as E
    from shelfcast.sources import tables as TB
    src = TB.read_table(spark, SF_SMALL, "lineitem", ["l_orderkey", "l_partkey", "l_quantity"])
    path = str(tmp_path / "li_csv")
    src.write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("l_orderkey", T.LongType()),
                           T.StructField("l_partkey", T.LongType()),
                           T.StructField("l_quantity", T.DoubleType())])
    typed = TB.scan_typed(spark, path, schema)
    assert dict(typed.dtypes) == {"l_orderkey": "bigint", "l_partkey": "bigint", "l_quantity": "double"}
    assert typed.exceptAll(src).count() == 0 and src.exceptAll(typed).count() == 0
    inferred = TB.scan_inferred(spark, path)
    narrowed = E.narrow_types(inferred)
    assert dict(narrowed.dtypes)["l_quantity"] == "float"   # 1..50 fits float (float16 in pandas)
    assert narrowed.count() == src.count()


def test_sink_per_variant_layout(spark):
    import os
    from shelfcast.sources import sinks as SK
    s = V.v_sales(spark, SF_SMALL).select("id", "d_num", "sales")
    preds = FC.recursive_forecast(s, 2501, 5)
    variants = preds.select("*", F.posexplode(F.array(F.lit(1.0), F.lit(1.02))).alias("variant", "alpha"))
    path = SK.output_path(spark, "test-variants")
    back = SK.sink_per_variant(variants, path, read_back=True)
    local = path.replace("file:", "")
    assert sorted(d for d in os.listdir(local) if d.startswith("variant=")) == ["variant=0", "variant=1"]
    assert back.count() == 2 * preds.count()
