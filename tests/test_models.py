"""Forecast and segments: exact parts exactly, fitted parts by what they must reach."""

import datetime as dt
import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import forecast, segments

START = dt.date(2021, 1, 1)


@pytest.fixture(scope="module")
def synthetic(spark):
    """Two series of 1,100 days with trend, weekly and yearly terms and trigger effects."""
    rng = np.random.default_rng(7)
    out, clean, trig = [], {}, []
    flags = rng.random(1160) < 0.15
    for i in range(1160):
        trig.append((START + dt.timedelta(days=i), int(flags[i]), 0, 0))
    for name, level in (("a", 500.0), ("b", 80.0)):
        for i in range(1160):
            day = START + dt.timedelta(days=i)
            signal = level * (
                1 + 0.0004 * i + 0.1 * math.sin(2 * math.pi * i / 7) + 0.2 * math.cos(2 * math.pi * i / 365.25)
                + 0.15 * flags[i]
            )
            clean[name, day] = signal
            if i < 1100:
                out.append((name, day, float(signal + rng.normal(0, 0.02 * level))))
    series = spark.createDataFrame(out, "series_id string, ds date, y double")
    triggers = spark.createDataFrame(
        trig, "ds date, temp_trigger_1deg int, temp_trigger_2deg int, temp_trigger_3deg int"
    )
    return series, triggers, clean


def test_forecast_recovers_a_known_series(spark, synthetic):
    series, triggers, clean = synthetic
    holidays = forecast.holiday_frame(spark, ["2021-05-05", "2022-05-05"])
    out = forecast.train_and_forecast(series, triggers, holidays, 60)
    ahead = forecast.last_days(out, 60).collect()
    assert len(ahead) == 120 and min(r["ds"] for r in ahead) == START + dt.timedelta(days=1100)
    for name, level in (("a", 500.0), ("b", 80.0)):
        errors = [abs(r["yhat"] - clean[name, r["ds"]]) for r in ahead if r["series_id"] == name]
        assert np.mean(errors) < 0.03 * level
    history = out.join(series, ["series_id", "ds"])
    inside = history.where(F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper"))).count() / history.count()
    assert 0.72 < inside < 0.88


def test_interval_widens_with_the_horizon(spark, synthetic):
    series, _, _ = synthetic
    fitted = forecast.fit_series(series, forecast.TEMPERATURE_MODEL)
    out = forecast.predict_series(forecast.history_and_future(series, 60), fitted, forecast.TEMPERATURE_MODEL)
    rows = out.where("series_id = 'a'").orderBy("ds").collect()
    widths = [r["yhat_upper"] - r["yhat_lower"] for r in rows]
    assert max(widths[:1100]) - min(widths[:1100]) < 1e-6
    assert all(a < b for a, b in zip(widths[1100:], widths[1101:], strict=False)) and widths[1100] > widths[1099]


def test_holidays_follow_the_data(spark):
    days = spark.sql("select date '2023-12-31' as ds union all select date '2024-11-30'")
    got = [str(r["ds"]) for r in forecast.yearly_holidays(days, ("01-01", "12-25"), 60).orderBy("ds").collect()]
    assert got == ["2023-01-01", "2023-12-25", "2024-01-01", "2024-12-25", "2025-01-01", "2025-12-25"]
    assert forecast.yearly_holidays(days.where("false"), ("01-01",), 60).isEmpty()


def test_quantiles_of_hard_values(spark):
    df = spark.range(0, 20_000, 1, 4).select(F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.sqrt("id")).alias("a"))
    values = np.array([r["a"] for r in df.collect()])
    got = segments.exact_quantiles(df, ["a"], (0.25, 0.5, 0.75))["a"]
    assert got == pytest.approx(np.quantile(values, [0.25, 0.5, 0.75]), rel=1e-12)
    values = [-1e308, -3.5, -0.0, 0.0, 5e-324, 2.0**-1074, 1.0, 1.0 + 2**-52, 7e200]
    hard = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "a double")
    places = [i / (len(values) - 1) for i in range(len(values))]
    assert segments.exact_quantiles(hard, ["a"], places)["a"] == sorted(values)
    with pytest.raises(ValueError):
        segments.exact_quantiles(hard.where("a is null"), ["a"])


def test_quantiles_sort_nothing(spark):
    counts = segments._digit_counts(spark.range(9).selectExpr("cast(id as double) as a"), {("a", 0): 0}, 0)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort " not in plan


def test_fit_equals_one_dense_solve(spark, synthetic):
    series, _, _ = synthetic
    spec = replace(forecast.TEMPERATURE_MODEL, sparse_changes=False)
    fitted = {r["series_id"]: r for r in forecast.fit_series(series, spec).collect()}
    scaled = series.join(forecast.series_scales(series), "series_id")
    rows = scaled.where("series_id = 'b'").orderBy("ds").select(forecast.design_row(spec).alias("x"), (F.col("y") / F.col("y_scale")).alias("y")).collect()
    x, y = np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows])
    assert x.shape[1] == len(spec.penalties()) and fitted["b"]["n"] == len(rows)
    beta = np.linalg.solve(x.T @ x + np.diag(spec.penalties()), x.T @ y)
    assert np.allclose(fitted["b"]["beta"], beta, atol=1e-7)
    spent = np.trace(np.linalg.solve(x.T @ x + np.diag(spec.penalties()), x.T @ x))
    spread = np.sum((y - x @ beta) ** 2) / (len(y) - spent)
    assert fitted["b"]["sigma"] == pytest.approx(float(np.sqrt(spread)), rel=1e-4)


def _broken_line(rows, n=1000, at=400, noise=0.01):
    """A line whose slope changes once, at the knot after day ``at``."""
    rng = np.random.default_rng(11)
    y = [100 + 0.05 * i + 0.3 * max(i - at, 0) + rng.normal(0, noise * 100) for i in range(n)]
    return rows("series_id string, ds date, y double", *[("s", START + dt.timedelta(days=i), float(v)) for i, v in enumerate(y)])


def test_one_break_is_found_and_the_others_stay_near_zero(rows):
    # 20 knots in the first 80 % of 999 days: the knot of day 400 is number 10.
    spec = forecast.ModelSpec(seasons=(), changepoints=20, noise_scale=0.05)
    series = _broken_line(rows, at=400)
    sparse = np.array(forecast.fit_series(series, spec).first()["beta"])[2:]
    dense = np.array(forecast.fit_series(series, replace(spec, sparse_changes=False)).first()["beta"])[2:]
    near = np.abs(sparse[[8, 9, 10]]).sum()
    others = np.abs(np.delete(sparse, [8, 9, 10]))
    assert near > 0.9 * np.abs(sparse).sum() and others.max() < 0.02 * near
    assert np.abs(np.delete(dense, [8, 9, 10])).sum() > 5 * others.sum()


def test_sparse_changes_solve_the_laplace_problem(rows):
    """The conditions of the minimum: gradient equal to the penalty's slope where a change stands, less where it is 0."""
    spec = forecast.ModelSpec(seasons=((7.0, 2),), changepoints=10)
    series = _broken_line(rows, n=300, at=120, noise=0.05)
    row = forecast.fit_series(series, spec).first()
    scaled = series.join(forecast.series_scales(series), "series_id")
    made = scaled.select(forecast.design_row(spec).alias("x"), (F.col("y") / F.col("y_scale")).alias("y")).collect()
    x, y, beta = np.array([r["x"] for r in made]), np.array([r["y"] for r in made]), np.array(row["beta"])
    pull = x.T @ (y - x @ beta)
    changes, others = slice(2, 12), np.r_[0:2, 12:16]
    assert np.allclose(pull[others], np.array(spec.penalties())[others] * beta[others], atol=1e-6)
    edge = spec.noise_scale**2 / spec.changepoint_scale
    stands = np.abs(beta[changes]) > 1e-3
    assert stands.any() and not stands.all()
    assert np.allclose(pull[changes][stands], edge * np.sign(beta[changes][stands]), rtol=0.02)
    assert (np.abs(pull[changes]) <= edge * 1.02).all()


def _fit_before(series, spec, last, back, y_scale, reach):
    """Dense solve of one cut-off: days up to ``back`` days before the last, changes up to ``reach``."""
    t0 = series[0][0]
    span = (last - t0).days
    days = [(d, y) for d, y in series if (last - d).days >= back]

    def design(d):
        t = (d - t0).days / span
        day = (d - dt.date(1970, 1, 1)).days
        waves = [f(day * 2 * math.pi * n / p) for p, order in spec.seasons for n in range(1, order + 1) for f in (math.sin, math.cos)]
        return [1.0, t, *[max(t - k, 0.0) if k <= reach else 0.0 for k in spec.knots()], *waves]

    x, y = np.array([design(d) for d, _ in days]), np.array([v for _, v in days]) / y_scale
    beta = np.linalg.solve(x.T @ x + np.diag(spec.penalties()), x.T @ y)
    return lambda d: float(np.array(design(d)) @ beta * y_scale)


def test_backtest_equals_a_fit_per_cutoff(spark, rows, synthetic):
    spec = replace(forecast.ModelSpec(seasons=((7.0, 2),), changepoints=6), sparse_changes=False)
    series = synthetic[0].where("series_id = 'b'").unionByName(synthetic[0].where("series_id = 'a' and ds < '2021-02-01'"))
    made = forecast.backtest(series, spec, folds=3, step=50, horizon=80).collect()
    whole = [(r["ds"], r["y"]) for r in synthetic[0].where("series_id = 'b'").orderBy("ds").collect()]
    last, t0 = whole[-1][0], whole[0][0]
    span = (last - t0).days
    scale = max(abs(y) for d, y in whole if (last - d).days >= 150)
    by_cut = {c: sorted(r["ds"] for r in made if r["cutoff"] == c) for c in {r["cutoff"] for r in made if r["series_id"] == "b"}}
    assert {(last - c).days: len(v) for c, v in by_cut.items()} == {50: 50, 100: 80, 150: 80}
    for fold in (1, 2, 3):
        cut = last - dt.timedelta(days=50 * fold)
        predict = _fit_before(whole, spec, last, 50 * fold, scale, 0.8 * (cut - t0).days / span + 1e-9)
        got = {r["ds"]: r["yhat"] for r in made if r["series_id"] == "b" and r["cutoff"] == cut}
        assert all(abs(got[d] - predict(d)) < 1e-6 for d in got) and min(got) == cut + dt.timedelta(days=1)
    # A short series has no days before its cut-offs, so nothing is held out from a fit.
    assert not [r for r in made if r["series_id"] == "a"]
    errors = {(last - r["cutoff"]).days: r for r in forecast.backtest_errors(forecast.backtest(series, spec, 3, 50, 80)).collect()}
    misses = np.array([r["y"] - r["yhat"] for r in made if (last - r["cutoff"]).days == 100 and r["series_id"] == "b"])
    assert errors[100]["mae"] == pytest.approx(np.abs(misses).mean()) and errors[100]["rmse"] == pytest.approx(np.sqrt((misses**2).mean()))


def test_backtest_does_not_see_the_held_out_days(spark, synthetic):
    series = synthetic[0].where("series_id = 'a'")
    spec = forecast.ModelSpec(seasons=(), changepoints=5)
    wild = series.withColumn("y", F.when(F.col("ds") > F.lit(START + dt.timedelta(days=1039)), 1e6).otherwise(F.col("y")))
    one, two = ({r["ds"]: r["yhat"] for r in forecast.backtest(s, spec, 1, 60, 60).collect()} for s in (series, wild))
    assert len(one) == 60 and all(abs(one[d] - two[d]) < 1e-9 for d in one)


def test_design_width_matches_penalties(spark):
    spec = forecast.VOLUME_MODEL
    assert len(spec.penalties()) == 2 + 25 + 20 + 6 + 10 + 3 + 3


def test_short_and_constant_series(spark, rows):
    df = rows("series_id string, ds date, y double", ("one", START, 5.0), ("zero", START, 0.0), ("zero", START + dt.timedelta(days=1), 0.0))
    fitted = forecast.fit_series(df, forecast.TEMPERATURE_MODEL)
    out = forecast.predict_series(forecast.history_and_future(df, 3), fitted, forecast.TEMPERATURE_MODEL)
    assert out.count() == 9 and out.where("yhat is null or isnan(yhat)").isEmpty()


def test_overlapping_holiday_windows(spark, rows):
    days = rows("ds date", *[(dt.date(2024, 1, d),) for d in range(1, 6)])
    out = forecast.with_holidays(days, forecast.holiday_frame(spark, ["2024-01-02", "2024-01-03"])).orderBy("ds")
    assert [tuple(r)[1:] for r in out.collect()] == [(1, 0, 0), (1, 1, 0), (0, 1, 1), (0, 0, 1), (0, 0, 0)]


def test_totals_are_cut_toward_zero_and_need_every_plan(rows):
    d1, d2 = dt.date(2024, 1, 5), dt.date(2024, 11, 6)
    df = rows(
        "series_id string, ds date, yhat double, yhat_lower double, yhat_upper double",
        ("a", d1, 1.4, -2.4, 3.0), ("b", d1, 0.5, 0.5, 0.9), ("a", d2, 1.0, 1.0, 1.0),
    )
    out = forecast.forecast_totals(df, ["a", "b"], 60).collect()
    assert [tuple(r)[1:] for r in out] == [("2024. 1. 5", 1, -1, 3)]
    assert forecast.forecast_totals(df, None, 60).count() == 1


def test_frozen_pick_ignores_later_runs(rows):
    d = dt.date
    df = rows("series_id string, ds date, yhat double, as_of_date date", ("a", d(2024, 2, 1), 1.0, d(2024, 1, 1)), ("a", d(2024, 2, 1), 2.0, d(2024, 1, 8)), ("a", d(2024, 2, 1), 3.0, d(2024, 1, 15)))
    assert forecast.frozen_pick(df, "2024-01-08").first()["yhat"] == 2.0
    assert forecast.frozen_pick(df, "2023-12-31").isEmpty()


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 25_000])
def test_exact_quantiles(spark, n):
    rng = np.random.default_rng(n)
    values = np.round(rng.exponential(3.0, n), 3)
    values[: n // 3] = 1.5  # a third of all rows share one value
    df = spark.createDataFrame([(float(v), float(-v)) for v in values], "a double, b double")
    got = segments.exact_quantiles(df, ["a", "b"])
    assert np.allclose(got["a"], np.quantile(values, [0.25, 0.5, 0.75]))
    assert np.allclose(got["b"], np.quantile(-values, [0.25, 0.5, 0.75]))


def test_scaling_of_missing_and_constant_features(rows):
    df = rows("user_id int, f double, c int", *[(i, float(i) if i else None, 5) for i in range(9)])
    out = segments.robust_scaled(df).orderBy("user_id").collect()
    logs = np.log1p(np.arange(9.0))
    low, mid, high = np.quantile(logs, [0.25, 0.5, 0.75])
    assert np.allclose([r["f"] for r in out], (logs - mid) / (high - low))
    assert {r["c"] for r in out} == {0.0}
    assert segments.fill_missing(df).where("f is null").isEmpty()


def test_aic_formula():
    assert segments.aic(-100.0, 3, 2) == 2 * (3 * 2 + 3 * 3 + 2) + 200.0


def test_elbow_takes_the_smallest_of_equal_bends(rows):
    scores = rows("k int, aic double", (10, 100.0), (11, 50.0), (12, 50.0), (13, 0.0), (14, 0.0))
    assert segments.elbow(scores).first()["k"] == 11


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(3)
    centers = [(0.0, 0.0), (8.0, 8.0), (0.0, 9.0)]
    rows = [(i, *map(float, rng.normal(centers[i % 3], 0.5))) for i in range(600)]
    return spark.createDataFrame(rows, "user_id bigint, x double, y double")


def _vectors(blobs, partitions=2):
    return blobs.select("user_id", F.array("x", "y").alias("scaled")).repartition(partitions, "user_id").cache()


def test_mixture_finds_separate_groups(blobs):
    vectors = _vectors(blobs)
    labelled = segments.cluster_users(vectors, blobs, 3)
    pairs = labelled.select(F.pmod("user_id", F.lit(3)).alias("g"), "classification").distinct()
    assert pairs.count() == 3 and labelled.count() == 600
    scores = {r["k"]: r["aic"] for r in segments.aic_scores(vectors, 2, 4).collect()}
    assert set(scores) == {2, 3, 4} and scores[3] < scores[2]
    summary = segments.cluster_summary(labelled)
    assert summary.agg(F.sum("members")).first()[0] == 600


def test_mixtures_do_not_depend_on_partitions(blobs):
    found = []
    for partitions in (1, 7):
        vectors = _vectors(blobs, partitions)
        models = segments.fit_mixtures(vectors, [2, 5])
        found.append({k: sorted(tuple(r) for r in segments.labels(vectors, m).collect()) for k, m in models.items()})
    assert found[0] == found[1]


def test_log_likelihood_is_that_of_the_mixture(blobs):
    model = segments.fit_mixtures(_vectors(blobs), [3])[3]
    x = np.array([[r["x"], r["y"]] for r in blobs.collect()])
    parts = []
    for w, m, c in zip(model.weights, model.means, model.covariances, strict=True):
        miss = x - m
        far = np.einsum("ni,ij,nj->n", miss, np.linalg.inv(c), miss)
        parts.append(w * np.exp(-0.5 * far) / (2 * math.pi * math.sqrt(np.linalg.det(c))))
    assert model.log_likelihood == pytest.approx(np.log(np.sum(parts, axis=0)).sum(), rel=1e-9)
    assert model.weights.sum() == pytest.approx(1.0)


def test_each_pass_gains_likelihood(blobs):
    models, last = {4: segments._start(np.array([[r["x"], r["y"]] for r in blobs.limit(200).collect()]), 4)}, -math.inf
    for _ in range(8):
        sums, likelihood = segments._expectations(_vectors(blobs), models)[4]
        assert likelihood >= last - 1e-6
        last, models = likelihood, {4: models[4].updated(sums, likelihood, 600)}


def test_mixture_of_few_and_equal_users(spark):
    same = spark.range(40).select(F.col("id").alias("user_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("scaled"))
    model = segments.fit_mixtures(same, [3])[3]
    assert np.isfinite(model.log_likelihood) and segments.labels(same, model).count() == 40


def test_waterfall_gives_one_tag(rows):
    df = rows("v int", (1,), (5,), (None,))
    tag = segments.waterfall([(F.col("v") < 3, "low"), (F.col("v") < 9, "mid")], "rest")
    assert [r[0] for r in df.select(tag).collect()] == ["low", "mid", "rest"]


def test_no_features_is_an_error(rows):
    with pytest.raises(ValueError):
        segments.segment_users(rows("user_id bigint, x double"), k=2)
