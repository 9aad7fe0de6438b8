"""Driver contract and a DuckDB oracle smoke check at sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "avg_rmean_7_7" in df.columns


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 100


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)),
                        key=repr)


SMOKE = ["feature_summary", "rolling_mean_horizon", "rolling_kurt_horizon", "price_change_year",
         "category_codes", "pivot_horizon", "recursive_forecast", "backtest_compare",
         "timeseries_cv", "acf", "tail_after_n", "join_prices_left"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("key", SMOKE)
def test_query_matches_oracle(spark, duck, key):
    got = E.queries()[key](spark, SF_SMALL).toPandas()
    exp = duck.sql(E.oracle_sql()[key]).to_arrow_table().to_pandas()
    assert _rows(got) == _rows(exp)


def test_every_oracle_sql_plans_in_duckdb(duck):
    bad = []
    for key, sql in E.oracle_sql().items():
        try:
            duck.execute("EXPLAIN " + sql)
        except Exception as e:  # noqa: BLE001
            bad.append((key, str(e)[:200]))
    assert not bad
