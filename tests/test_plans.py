"""Plan-shape tests: one exchange per window group, pruned scans, a
recursion without per-step shuffles."""

from pyspark.sql import functions as F

from shelfcast.operators import windows as W
from shelfcast.plans import features as FE
from shelfcast.plans import forecast as FC
from shelfcast.sources import tables as T
from shelfcast.sources import views as V

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _count(plan: str, op: str) -> int:
    return plan.count(op)


def test_window_features_share_one_exchange(spark, monkeypatch):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        s = V.v_sales(spark, SF_SMALL)
        feats = FE.demand_features(s)
        plan = _plan(feats)
        # one exchange for the brand x day aggregation, one for the window group
        assert _count(plan, "Exchange hashpartitioning(id") == 1
        assert plan.count("Window [") >= 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_scan_is_pruned_and_filter_pushed(spark):
    li = T.read_table(spark, SF_SMALL, "lineitem", ["l_partkey", "l_quantity", "l_shipdate"])
    q = li.where(F.col("l_quantity") > 10).select("l_partkey")
    plan = _plan(q)
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan or \
        "struct<l_partkey:bigint,l_quantity:double>" in plan
    assert "GreaterThan(l_quantity,10.0)" in plan


def test_recursive_forecast_has_no_per_step_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        s = V.v_sales(spark, SF_SMALL).select("id", "d_num", "sales")
        plan = _plan(FC.recursive_forecast(s, 2501, 28))
        # the brand x day aggregation + the per-series array build only
        assert _count(plan, "Exchange") <= 3
        assert "aggregate(" in plan.lower() or "Generate" in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_series_layout_removes_window_exchange(spark):
    from shelfcast.operators import windows as W
    s = V.v_sales(spark, SF_SMALL).select("id", "d_num", "sales")
    laid = W.series_layout(s)
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    feats = FE.demand_features(laid)
    feats.write.format("noop").mode("overwrite").save()
    plan = _plan(feats)
    assert "Exchange" not in plan and "Sort [" not in plan
    # same rows as without the layout
    plain = FE.demand_features(s)
    assert feats.exceptAll(plain).count() == 0 and plain.exceptAll(feats).count() == 0


def test_rolling_strategies_keep_one_exchange(spark):
    from shelfcast.operators import windows as W
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = V.v_panel(spark, SF_SMALL).select("id", "d_num", F.col("sales").alias("demand"))
        w = W.series_window()
        out = W.rolling_horizon_features(p, 28, (7, 30), (7, 30), 30, integral=True)
        out = W.rolling_extreme(out, "demand", 365, w, 1, "mx")
        plan = _plan(out)
        # one exchange for the panel aggregation, one for all window work
        assert plan.count("Exchange hashpartitioning(id") == 1
        assert len([l for l in plan.split("\n") if "Sort [id" in l]) == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_price_queries_read_lineitem_once(spark):
    from shelfcast.plans import registry
    for key in ("price_change_year", "join_prices_left", "group_mean_rolling", "join_group_stat_back"):
        plan = _plan(registry.queries()[key](spark, SF_SMALL))
        # The daily table was written once; the query itself reads that copy.
        assert "lineitem" not in plan and "Scan ExistingRDD" in plan


def test_price_join_and_features_share_one_exchange(spark):
    """The panel is shuffled once for the price join and all price windows."""
    from shelfcast.operators import joins as J
    panel, prices = V.panel_and_prices(spark, SF_SMALL)
    rows = panel.select("id", *J.SERIES_KEYS, "d_num", V.wm_yr_wk(F.col("d_num")).alias("wm_yr_wk"))
    joined = J.join_series_prices(rows, prices)
    out = W.price_change_features(W.price_delta(joined, w=W.series_window(J.SERIES_KEYS)), w=W.series_window(J.SERIES_KEYS))
    plan = out._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    # One of the panel; the other two sum and lay out the prices.
    assert sum("item_id" in x and "store_id" in x for x in exchanges) <= 3, exchanges
    assert plan.count("Window [") >= 5
    below_windows = plan[plan.rindex("Window ["):]
    assert "SortMergeJoin" in below_windows
    head = plan[:plan.index("SortMergeJoin")]
    assert "Exchange" not in head, head


def test_series_price_join_equals_the_three_key_join(spark):
    from shelfcast.operators import joins as J
    panel, prices = V.panel_and_prices(spark, SF_SMALL)
    rows = panel.select("id", *J.SERIES_KEYS, "d_num", V.wm_yr_wk(F.col("d_num")).alias("wm_yr_wk"))
    cols = ["id", "d_num", "sell_price"]
    for how in ("inner", "left"):
        a = J.join_prices(rows, prices, how).select(*cols)
        b = J.join_series_prices(rows, prices, how).select(*cols)
        assert a.count() == b.count() and a.exceptAll(b).count() == 0
