"""Additive daily forecasts for many series at once.

The model follows the published formulation of Taylor and Letham, "Forecasting at
Scale" (2018): a piecewise linear trend, Fourier terms for the seasons, holiday
and regressor effects. The priors are Gaussian, but for the changes of the trend,
which have a Laplace prior: most of them are near 0, a few are large. A fit is a
penalized least-squares problem per series, solved again with new weights until the
changes stay:

* every design column is a Spark expression on ``(ds, regressors)``;
* partial ``X'X``, ``X'y`` are built per (series, block of days) and summed per
  series, so Python holds one block of at most ``BLOCK_DAYS`` rows;
* prediction is a native dot product of the design row and the coefficients.

Rows are daily and unique per (series, day), so a series is bounded by the
calendar however much raw data stands behind it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import dashboard_day, whole_part
from tidemark.operators.weather import actual_over_forecast, temperature_triggers
from tidemark.session import materialize

BLOCK_DAYS = 365
YEAR_DAYS = 365.25
EPOCH = date(1970, 1, 1)

# Horizon, season orders and the holiday window.
PREDICT_DAYS = 60
YEARLY_ORDER, WEEKLY_ORDER = 10, 3
MONTH_DAYS, MONTHLY_ORDER = 30.5, 5
HOLIDAY_WINDOW = (-1, 1)
CHANGEPOINTS, CHANGEPOINT_RANGE = 25, 0.8
INTERVAL_Z = 1.28
# Rounds of new weights at most; below this share of the prior's scale a change counts as 0 for its weight;
# coefficients that move less are settled.
REWEIGHTINGS, LEAST_CHANGE, STILL = 200, 1e-4, 1e-7
# Cut-offs of a rolling hold-out, and the days between them.
FOLDS, FOLD_DAYS = 4, 60
# What the sums of a series carry along.
CARRIED = ("reach", "reach_step", "t0", "span", "y_scale")


@dataclass(frozen=True)
class ModelSpec:
    """Columns and prior scales of one additive model."""

    seasons: tuple[tuple[float, int], ...] = ((YEAR_DAYS, YEARLY_ORDER), (7.0, WEEKLY_ORDER))
    regressors: tuple[str, ...] = ()
    holidays: bool = False
    changepoints: int = CHANGEPOINTS
    changepoint_range: float = CHANGEPOINT_RANGE
    changepoint_scale: float = 0.05
    season_scale: float = 10.0
    regressor_scale: float = 10.0
    noise_scale: float = 0.1
    #: A Laplace prior on the changes of the trend; Gaussian if False.
    sparse_changes: bool = True

    def knots(self) -> np.ndarray:
        """Where the trend may change, as shares of a series' span."""
        return np.array([self.changepoint_range * (i + 1) / self.changepoints for i in range(self.changepoints)])

    def penalties(self) -> list[float]:
        """Noise variance over prior variance, in design-column order."""

        def weight(scale: float) -> float:
            return (self.noise_scale / scale) ** 2

        waves = sum(2 * order for _, order in self.seasons)
        extra = len(self.regressors) + (HOLIDAY_WINDOW[1] - HOLIDAY_WINDOW[0] + 1 if self.holidays else 0)
        return (
            [weight(5.0)] * 2
            + [weight(self.changepoint_scale)] * self.changepoints
            + [weight(self.season_scale)] * waves
            + [weight(self.regressor_scale)] * extra
        )


TEMPERATURE_MODEL = ModelSpec()
VOLUME_MODEL = ModelSpec(
    seasons=((YEAR_DAYS, YEARLY_ORDER), (7.0, WEEKLY_ORDER), (MONTH_DAYS, MONTHLY_ORDER)),
    regressors=("temp_trigger_1deg", "temp_trigger_2deg", "temp_trigger_3deg"),
    holidays=True,
    changepoint_scale=0.1,
)


def clean_series(series: DataFrame) -> DataFrame:
    return series.na.drop(subset=["ds", "y"])


def plans_to_series(volume: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A wide frame (first column the day, then one column per plan) as long series."""
    renamed = volume.toDF("ds", *columns)
    return renamed.unpivot(["ds"], list(columns), "series_id", "y")


def holiday_days(holidays: DataFrame) -> DataFrame:
    """Each holiday spread over its window as plain rows, for an equi join by day."""
    spread = F.explode(F.sequence(F.col("lower_window"), F.col("upper_window")))
    return (
        holidays.select("holiday", "ds", spread.alias("day_offset"))
        .select("holiday", F.date_add("ds", F.col("day_offset")).alias("ds"), "day_offset")
        .dropDuplicates()
    )


def with_holidays(days: DataFrame, holidays: DataFrame) -> DataFrame:
    """Add one 0/1 column per window offset. Windows that overlap set several.

    The flags have one row per day, which bounds the broadcast.
    """
    low, high = HOLIDAY_WINDOW
    flags = (
        holiday_days(holidays)
        .groupBy("ds")
        .agg(*[F.max((F.col("day_offset") == o).cast("int")).alias(f"holiday_{o - low}") for o in range(low, high + 1)])
    )
    names = [f"holiday_{i}" for i in range(high - low + 1)]
    return days.join(F.broadcast(flags), "ds", "left").na.fill(0, subset=names)


def history_and_future(series: DataFrame, days: int = PREDICT_DAYS) -> DataFrame:
    """The days of every series and the ``days`` days after its last one."""
    last = series.groupBy("series_id").agg(F.max("ds").alias("last"))
    future = last.select(
        "series_id", F.explode(F.expr(f"sequence(date_add(last, 1), date_add(last, {int(days)}))")).alias("ds")
    )
    return series.select("series_id", "ds").unionByName(future)


def _day_number(name: str = "ds") -> Column:
    return F.datediff(F.col(name), F.lit(EPOCH))


def series_scales(series: DataFrame) -> DataFrame:
    """Per series: first day, span in days, and the value scale."""
    return series.groupBy("series_id").agg(
        F.min(_day_number()).alias("t0"),
        F.greatest(F.max(_day_number()) - F.min(_day_number()), F.lit(1)).alias("span"),
        F.max(F.abs("y")).alias("peak"),
    ).withColumn("y_scale", F.when(F.col("peak") > 0, F.col("peak")).otherwise(F.lit(1.0))).drop("peak")


def design_row(spec: ModelSpec) -> Column:
    """The design vector of a row that carries ``ds, t0, span`` and the extra columns."""
    day = _day_number().cast("double")
    t = (day - F.col("t0")) / F.col("span")
    knots = spec.knots()
    speeds = np.array([2.0 * math.pi * n / period for period, order in spec.seasons for n in range(1, order + 1)])
    extra = list(spec.regressors)
    if spec.holidays:
        extra += [f"holiday_{i}" for i in range(HOLIDAY_WINDOW[1] - HOLIDAY_WINDOW[0] + 1)]
    # Array functions keep the plan short; one column per term would outgrow codegen.
    parts = [F.array(F.lit(1.0), t)]
    if len(knots):
        parts.append(F.transform(F.lit(knots), lambda k: F.greatest(t - k, F.lit(0.0))))
    if len(speeds):
        parts.append(F.flatten(F.transform(F.lit(speeds), lambda w: F.array(F.sin(day * w), F.cos(day * w)))))
    if extra:
        parts.append(F.array(*[F.col(name).cast("double") for name in extra]))
    return F.concat(*parts)


# The two functions below run in Python workers. They are made inside functions,
# so they travel by value and workers need not have this package installed.


def _block_summer():
    carried = list(CARRIED)

    def block_sums(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.array(pdf["x"].tolist())
        y = pdf["y"].to_numpy()
        sums = {"gram": [(x.T @ x).ravel()], "moment": [x.T @ y], "yy": [float(y @ y)], "n": [len(y)]}
        return pdf[["series_id", "fold", *carried]].head(1).reset_index(drop=True).assign(**sums)

    return block_sums


def _solver(spec: ModelSpec, folds: Sequence[int]):
    ridge, changes = np.array(spec.penalties()), slice(2, 2 + spec.changepoints)
    sparse, scale, knots = spec.sparse_changes and spec.changepoints > 0, spec.changepoint_scale, spec.knots()
    rounds, least, still, scales = REWEIGHTINGS, LEAST_CHANGE, STILL, ["t0", "span", "y_scale"]

    def fitted(gram, moment, yy: float, n: int, reach: float):
        """Coefficients and residual spread; changes after ``reach`` (a share of the span) are 0."""
        used = np.ones(len(ridge), bool)
        used[changes] = knots <= reach + 1e-9
        at = np.flatnonzero(used[changes]) + 2  # the first ones are used, so they keep their places
        gram, moment, weights = gram[np.ix_(used, used)], moment[used], ridge[used].copy()
        beta = np.linalg.solve(gram + np.diag(weights), moment)
        for _ in range(rounds if sparse and len(at) else 0):
            # |d| / s as a square through its present value: the Gaussian weight, times s / |d|.
            weights[at] = ridge[at] * scale / np.maximum(np.abs(beta[at]), least * scale)
            before, beta = beta, np.linalg.solve(gram + np.diag(weights), moment)
            if np.abs(beta - before).max() < still:
                break
        spent = float(np.trace(np.linalg.solve(gram + np.diag(weights), gram)))
        error = max(yy - 2.0 * beta @ moment + beta @ gram @ beta, 0.0)
        whole = np.zeros(len(ridge))
        whole[used] = beta
        return whole, math.sqrt(error / max(n - spent, 1.0))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        """A fit for each fold, on that fold and all older ones: one step through the sums."""
        p, out = len(ridge), []
        gram, moment, yy, n = np.zeros((p, p)), np.zeros(p), 0.0, 0
        first = pdf.iloc[0]
        for fold in folds:
            part = pdf[pdf["fold"] == fold]
            if len(part):
                gram += np.sum(np.stack(part["gram"].to_list()), axis=0).reshape(p, p)
                moment += np.sum(np.stack(part["moment"].to_list()), axis=0)
                n, yy = n + int(part["n"].sum()), yy + float(part["yy"].sum())
            if n:
                beta, sigma = fitted(gram, moment, yy, n, first["reach"] - fold * first["reach_step"])
                out.append((first["series_id"], fold, beta, sigma, n, *first[scales]))
        return pd.DataFrame(out, columns=["series_id", "fold", "beta", "sigma", "n", *scales])

    return solve


def fit_series(series: DataFrame, spec: ModelSpec) -> DataFrame:
    """Coefficients per series: ``series_id, beta, sigma, n, t0, span, y_scale``.

    ``series`` has ``series_id, ds, y`` and the spec's regressor columns, one row per
    day. Python sees the design rows of one block at a time, then one matrix per block.
    """
    scales = series_scales(series)
    one = {"fold": F.lit(0), "reach": F.lit(spec.changepoint_range), "reach_step": F.lit(0.0)}
    return _solved(series.join(scales, "series_id").withColumns(one), spec, [0]).drop("fold")


def _solved(rows: DataFrame, spec: ModelSpec, folds: Sequence[int]) -> DataFrame:
    """Coefficients per series and fold, in the given order of folds, each on all rows of the folds so far.

    Rows carry their ``fold`` and their series' scales, which the result has too, and how far trend changes reach
    in fold 0 and less per fold.
    """
    kind = rows.schema["series_id"].dataType.simpleString()
    designed = rows.select(
        "series_id",
        "fold",
        *[F.col(c).cast("double").alias(c) for c in CARRIED],
        F.floor(_day_number() / BLOCK_DAYS).alias("block"),
        design_row(spec).alias("x"),
        (F.col("y").cast("double") / F.col("y_scale")).alias("y"),
    )
    sums = designed.groupBy("series_id", "fold", "block").applyInPandas(
        _block_summer(),
        f"series_id {kind}, fold int, {', '.join(f'{c} double' for c in CARRIED)}, "
        "gram array<double>, moment array<double>, yy double, n bigint",
    )
    return sums.groupBy("series_id").applyInPandas(
        _solver(spec, folds),
        f"series_id {kind}, fold int, beta array<double>, sigma double, n bigint, t0 double, span double, y_scale double",
    )


def drift_variance(spec: ModelSpec, end: Column | None = None) -> Column:
    """Variance of the scaled trend past the last fitted day, which stands at the share ``end`` (all) of the span.

    Slopes go on changing as often and as much as before. With changes of mean size m,
    Laplace distributed, and c of them a span, a distance of h spans adds 2 m^2 c h^3 / 3.
    The prior counts as one more change of its size, so that a straight past still leaves some doubt.
    """
    if not spec.changepoints:
        return F.lit(0.0)
    end = F.lit(1.0) if end is None else end
    ahead = F.greatest((_day_number().cast("double") - F.col("t0")) / F.col("span") - end, F.lit(0.0))
    changes = F.slice(F.col("beta"), 3, spec.changepoints)
    total = F.aggregate(changes, F.lit(0.0), lambda acc, v: acc + F.abs(v)) + spec.changepoint_scale
    size = total / (end * spec.changepoints + 1.0)
    return 2.0 * size * size * (spec.changepoints / spec.changepoint_range) * ahead * ahead * ahead / 3.0


def predict_series(days: DataFrame, fitted: DataFrame, spec: ModelSpec, z: float = INTERVAL_Z) -> DataFrame:
    """``yhat`` with its interval for every (series, day), wider the further ahead; a native dot product."""
    return _predicted(days.join(fitted, "series_id"), spec, z).select("series_id", "ds", "yhat", "yhat_lower", "yhat_upper")


def _predicted(rows: DataFrame, spec: ModelSpec, z: float, end: Column | None = None) -> DataFrame:
    """Rows that carry their fit, with ``yhat`` and its interval."""
    dot = F.aggregate(
        F.zip_with(design_row(spec), F.col("beta"), lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v
    )
    half = F.lit(z) * F.sqrt(F.col("sigma") * F.col("sigma") + drift_variance(spec, end)) * F.col("y_scale")
    return rows.withColumn("yhat", dot * F.col("y_scale")).withColumns(
        {"yhat_lower": F.col("yhat") - half, "yhat_upper": F.col("yhat") + half}
    )


def forecast_temperature(weather: DataFrame, days: int = PREDICT_DAYS) -> DataFrame:
    """Per-region temperatures: observed ones kept, the future filled by the model."""
    series = clean_series(weather.select(F.col("region").alias("series_id"), "ds", F.col("temp").alias("y")))
    fitted = fit_series(series, TEMPERATURE_MODEL)
    predicted = predict_series(history_and_future(series, days), fitted, TEMPERATURE_MODEL)
    actual = series.select(F.col("series_id").alias("region"), "ds", F.col("y").alias("temp"))
    return actual_over_forecast(actual, predicted.withColumnRenamed("series_id", "region"))


def training_days(series: DataFrame, triggers: DataFrame) -> DataFrame:
    """Days of the series that have triggers. These have one row per day, which bounds the broadcast."""
    return clean_series(series).join(F.broadcast(triggers), "ds")


def days_with_triggers(train: DataFrame, triggers: DataFrame, days: int = PREDICT_DAYS) -> DataFrame:
    """The training days of every series and the ``days`` after them, a missing trigger as 0."""
    names = [c for c in triggers.columns if c != "ds"]
    return history_and_future(train, days).join(F.broadcast(triggers), "ds", "left").na.fill(0, subset=names)


def train_and_forecast(
    series: DataFrame, triggers: DataFrame, holidays: DataFrame, days: int = PREDICT_DAYS, spec: ModelSpec = VOLUME_MODEL
) -> DataFrame:
    """Fit on days that have triggers; predict history and future, no trigger meaning 0."""
    # Fit, scales and history read it, so it is written once.
    train = materialize(with_holidays(training_days(series, triggers), holidays), "train")
    fitted = fit_series(train, spec)
    return predict_series(with_holidays(days_with_triggers(train, triggers, days), holidays), fitted, spec)


def forecast_volume(
    series: DataFrame, weather: DataFrame, holidays: DataFrame, days: int = PREDICT_DAYS
) -> DataFrame:
    """Weather model, triggers, then the volume model, for all series at once.

    Both daily inputs are read several times, and so are the triggers. They are
    small next to the raw data behind them, so each is written once instead of being
    derived again for every use.
    """
    weather, series = materialize(weather), materialize(clean_series(series))
    temps = materialize(forecast_temperature(weather, days))
    triggers = materialize(temperature_triggers(temps))
    return train_and_forecast(series, triggers, holidays, days)


def last_days(forecast: DataFrame, n: int = PREDICT_DAYS, key: str = "series_id") -> DataFrame:
    """The last ``n`` rows by day of every series.

    One row per day makes the cut a date comparison only if days have no gaps, so
    rows are counted; a series' partition is bounded by the calendar.
    """
    w = Window.partitionBy(key).orderBy(F.col("ds").desc())
    return forecast.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def forecast_totals(forecast: DataFrame, plans: Sequence[str] | None = None, n: int = PREDICT_DAYS) -> DataFrame:
    """Sum of all plans by day, cut to whole numbers, with the dashboard's day text.

    Plans are matched by date. A day counts only when every plan has it, so a total
    never misses a plan in silence.
    """
    recent = last_days(forecast, n)
    if plans is not None:
        recent = recent.where(F.col("series_id").isin(*plans))
    totals = recent.groupBy("ds").agg(
        F.count(F.lit(1)).alias("_plans"),
        *[whole_part(F.sum(c), "int").alias(f"total_{c.replace('yhat_', '')}") for c in ("yhat", "yhat_lower", "yhat_upper")],
    )
    if plans is not None:
        needed = F.lit(len(plans))
    else:  # one row, joined to the days, so that the count is part of the plan
        number = recent.agg(F.countDistinct("series_id").alias("_needed"), F.lit(1).alias("_one"))
        totals, needed = totals.withColumn("_one", F.lit(1)).join(F.broadcast(number), "_one"), F.col("_needed")
    return totals.where(F.col("_plans") >= needed).select(
        F.col("ds").alias("day"), dashboard_day("ds").alias("ds"), "total_yhat", "total_lower", "total_upper"
    )


def dashboard_forecast(
    series: DataFrame, weather: DataFrame, holidays: DataFrame, days: int = PREDICT_DAYS
) -> DataFrame:
    """From daily inputs to the dashboard: weather model, triggers, volume models, totals of all series."""
    return forecast_totals(materialize(forecast_volume(series, weather, holidays, days)), n=days)


def mean_absolute_error(actual: DataFrame, forecast: DataFrame) -> DataFrame:
    """Mean of |y - yhat| per series over the days that both have."""
    return (
        actual.select("series_id", "ds", "y")
        .join(forecast.select("series_id", "ds", "yhat"), ["series_id", "ds"])
        .groupBy("series_id")
        .agg(F.avg(F.abs(F.col("y") - F.col("yhat"))).alias("mae"), F.count(F.lit(1)).alias("days"))
    )


def backtest(
    series: DataFrame, spec: ModelSpec, folds: int = FOLDS, step: int = FOLD_DAYS, horizon: int = FOLD_DAYS, z: float = INTERVAL_Z
) -> DataFrame:
    """Hold-out predictions from rolling origins: ``series_id, cutoff, ds, y, yhat, yhat_lower, yhat_upper``.

    The cut-offs of a series lie ``step``, 2 ``step``, ... days before its last day. Each one's model is fitted to
    the days up to it and predicts the ``horizon`` days after it. The series is read once: rows are summed by
    the fold between two cut-offs, and the solver adds one fold after the other, from the oldest on, so that a fit
    costs one solve and no scan.

    All fits share one grid of trend changes and a value scale taken from the days before the first cut-off; a fit
    uses the changes in the first part (``changepoint_range``) of its own days. Series without days before a
    cut-off have no fit there. ``series`` has ``series_id, ds, y`` and the spec's regressor columns.
    """
    clean = materialize(clean_series(series), "backtest")
    day, last = _day_number(), F.col("t0") + F.col("days")
    scales = clean.groupBy("series_id").agg(F.min(day).alias("t0"), (F.max(day) - F.min(day)).alias("days"))
    first = last - folds * step
    early = clean.join(scales, "series_id").where(day <= first).groupBy("series_id").agg(F.max(F.abs("y")).alias("peak"))
    scales = scales.join(early, "series_id", "left").select(
        "series_id", "t0", last.alias("last"), F.greatest("days", F.lit(1)).alias("span"),
        F.when(F.col("peak") > 0, F.col("peak")).otherwise(F.lit(1.0)).alias("y_scale"),
    )
    scales = materialize(scales, "backtest-scales")
    dated = clean.join(scales, "series_id")
    # Fold i holds the days that cut-off i is the latest to include.
    fold = F.least(F.floor((F.col("last") - day) / step), F.lit(folds)).cast("int")
    reach = {"reach": F.lit(spec.changepoint_range), "reach_step": F.lit(step * spec.changepoint_range) / F.col("span")}
    past = dated.withColumn("fold", fold).where("fold > 0").withColumns(reach)
    fits = _solved(past, spec, range(folds, 0, -1)).drop("t0", "span", "y_scale")
    behind = F.col("last") - day
    # A day is held out from each cut-off before it that lies within the horizon.
    lowest, highest = F.floor(behind / step) + 1, F.least(F.floor((behind + horizon) / step), F.lit(folds))
    held = dated.where(lowest <= highest).withColumn("fold", F.explode(F.sequence(lowest.cast("int"), highest.cast("int"))))
    cut = F.col("last") - F.col("fold") * step
    predicted = _predicted(held.join(fits, ["series_id", "fold"]), spec, z, (cut - F.col("t0")) / F.col("span"))
    return predicted.select(
        "series_id", F.date_add(F.lit(EPOCH), cut.cast("int")).alias("cutoff"), "ds", "y",
        "yhat", "yhat_lower", "yhat_upper",
    )


def backtest_errors(held_out: DataFrame) -> DataFrame:
    """Per series and cut-off: days, mean absolute error, root mean square error, share inside the interval."""
    miss = F.col("y") - F.col("yhat")
    inside = F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper"))
    return held_out.groupBy("series_id", "cutoff").agg(
        F.count(F.lit(1)).alias("days"),
        F.avg(F.abs(miss)).alias("mae"),
        F.sqrt(F.avg(miss * miss)).alias("rmse"),
        F.avg(inside.cast("double")).alias("inside"),
    )


def volume_backtest(series: DataFrame, triggers: DataFrame, holidays: DataFrame, spec: ModelSpec = VOLUME_MODEL, **folds) -> DataFrame:
    """Hold-out errors of the volume model, on days that have triggers."""
    return backtest_errors(backtest(with_holidays(training_days(series, triggers), holidays), spec, **folds))


def frozen_pick(predictions: DataFrame, cutoff: str | date) -> DataFrame:
    """Per series and day the prediction made last on or before ``cutoff``.

    ``max_by`` keeps one candidate per key and map task; no sort of the history.
    """
    limit = F.lit(cutoff).cast("date")
    return (
        predictions.where(F.col("as_of_date") <= limit)
        .groupBy("series_id", "ds")
        .agg(F.max("as_of_date").alias("as_of_date"), F.max_by("yhat", "as_of_date").alias("yhat"))
    )


def holiday_frame(spark: SparkSession, days: Sequence[str], name: str = "event") -> DataFrame:
    low, high = HOLIDAY_WINDOW
    rows = [(name, date.fromisoformat(d), low, high) for d in days]
    return spark.createDataFrame(rows, "holiday string, ds date, lower_window int, upper_window int")


def yearly_holidays(series: DataFrame, dates: Sequence[str], days: int = PREDICT_DAYS, name: str = "event") -> DataFrame:
    """Holidays on the same ``MM-dd`` dates of every year that the series, its horizon and their windows touch."""
    low, high = HOLIDAY_WINDOW
    first, last = F.date_add(F.min("ds"), -high), F.date_add(F.max("ds"), days - low)
    years = series.agg(F.sequence(F.year(first), F.year(last)).alias("years")).select(F.explode("years").alias("year"))
    dated = F.explode(F.array(*[F.concat_ws("-", F.col("year").cast("string"), F.lit(d)) for d in dates]))
    return years.select(dated.alias("day")).select(
        F.lit(name).alias("holiday"),
        F.to_date("day").alias("ds"),
        F.lit(low).alias("lower_window"),
        F.lit(high).alias("upper_window"),
    )
