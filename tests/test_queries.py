"""Every registered query against its SQL, and the contract around them."""

import os

import pytest
from compare import difference, duck

import __spark_entry__ as entry
from tidemark.plans.queries import QUERIES as CORE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = {n: s for n, s in entry.oracle_sql().items() if n in CORE}
QUERIES = {n: q for n, q in entry.queries().items() if n in CORE}
FITS = {"volume_forecast", "volume_backtest", "dashboard_forecast", "user_segments"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_but_the_fits_has_sql():
    assert set(QUERIES) - set(SQL) == FITS
    assert set(SQL) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert not entry.entry(spark).isEmpty()


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, SQL[name], 1e-12) is None


def test_retention_invariant(spark):
    out = QUERIES["cohort_retention"](spark, SF_DIR)
    assert out.where("ret_0 <> user_count").isEmpty()


@pytest.mark.parametrize("name,order", [("cohort_retention", ["cohort_month"]), ("weather_json_rows", ["ds", "region"])])
def test_sorted_results_come_in_order(spark, name, order):
    got = [tuple(r[c] for c in order) for r in QUERIES[name](spark, SF_DIR).collect()]
    assert got == sorted(got) and len(got) > 1


def test_volume_backtest_covers_its_cutoffs(spark):
    out = QUERIES["volume_backtest"](spark, SF_DIR).toPandas()
    assert (out["days"] <= 60).all() and (out["rmse"] >= out["mae"] - 1e-6).all() and out["inside"].between(0, 1).all()
    assert out.groupby("series_id")["cutoff"].nunique().max() == 4


def test_volume_forecast_shape(spark):
    out = QUERIES["volume_forecast"](spark, SF_DIR)
    per_series = {r["series_id"]: r["n"] for r in out.groupBy("series_id").count().toDF("series_id", "n").collect()}
    assert set(per_series.values()) == {60}
    assert out.where("yhat is null or yhat_lower > yhat or yhat > yhat_upper").isEmpty()


def test_segments_cover_all_users(spark):
    out = QUERIES["user_segments"](spark, SF_DIR)
    features = QUERIES["rfm_features"](spark, SF_DIR)
    assert out.count() == features.count() == out.select("user_id").distinct().count()
    assert out.where("`cluster 1` is null or `cluster 2` is null or `cluster 3` is null").isEmpty()
