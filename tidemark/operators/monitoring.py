"""Run summaries and drift checks on results that did finish."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.quality import rows_check, union_all, volume_check
from tidemark.sources.registry import select_targets

SUMMARY_SCHEMA = "target string, status string, row_count bigint, message string"


def run_summary(
    spark: SparkSession,
    targets: Mapping[str, Callable[[], DataFrame]],
    wanted: str = "all",
    min_rows: Mapping[str, int] | None = None,
    metrics: Mapping[str, str] | None = None,
    parallelism: int = 4,
) -> DataFrame:
    """Run every target on its own; one failing target does not stop the others.

    Each target is one aggregation, and only its one result row comes back. Status
    is ``ok``, ``anomaly`` (finished, but the result looks wrong) or ``failed``.
    """
    chosen = select_targets(targets, wanted)

    def run(name: str) -> tuple:
        try:
            check = volume_check(chosen[name](), name, (min_rows or {}).get(name, 1), (metrics or {}).get(name))
            row = check.first()
        except Exception as exc:  # a target's failure is its result
            return (name, "failed", None, f"{type(exc).__name__}: {exc}")
        return (name, "ok" if row["status"] == "pass" else "anomaly", row["row_count"], row["message"])

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        lines = list(pool.map(run, chosen))
    return spark.createDataFrame(lines, SUMMARY_SCHEMA)


def is_bad_run(summary: DataFrame) -> bool:
    return not summary.where(F.col("status") != "ok").isEmpty()


def against_recent_mean(series: DataFrame, n: int, value: str = "y", key: str = "series_id") -> DataFrame:
    """Value against the mean of the ``n`` rows before it, per daily series.

    A series has one row per day, so its window partition is bounded by the calendar.
    """
    before = Window.partitionBy(key).orderBy("ds").rowsBetween(-n, -1)
    return (
        series.withColumn("recent_mean", F.avg(value).over(before))
        .withColumn("ratio", F.try_divide(F.col(value), F.col("recent_mean")))
    )


def spikes(series: DataFrame, n: int, factor: float, value: str = "y", key: str = "series_id") -> DataFrame:
    """Rows at least ``factor`` times the recent mean; any rise from a mean of 0 is one, without a ratio."""
    rise = (F.col("recent_mean") == 0) & (F.col(value) > 0)
    return against_recent_mean(series, n, value, key).where((F.col("ratio") >= F.lit(float(factor))) | rise)


def count_drops(runs: DataFrame, share: float) -> DataFrame:
    """Runs whose row count fell by ``share`` or more against the target's previous run."""
    w = Window.partitionBy("target").orderBy("run_ts")
    return (
        runs.withColumn("previous", F.lag("row_count").over(w))
        .withColumn("drop_share", F.try_divide(F.col("previous") - F.col("row_count"), F.col("previous")))
        .where(F.col("drop_share") >= F.lit(float(share)))
    )


def forecast_checks(
    forecast: DataFrame, regions_seen: DataFrame, expected_regions: DataFrame, n: int, factor: float
) -> DataFrame:
    """A region without data, negative predictions, and jumps against the recent mean."""
    missing = expected_regions.join(regions_seen.select("region").dropDuplicates(), "region", "left_anti")
    return union_all(
        [
            rows_check(missing, "missing_region", "weather"),
            rows_check(forecast.where(F.col("yhat") < 0), "negative_forecast", "forecast"),
            rows_check(spikes(forecast, n, factor, "yhat"), "forecast_jump", "forecast", "warn"),
        ]
    )


def cluster_shares(labels: DataFrame, label: str = "classification") -> DataFrame:
    """Members and share per cluster; the window runs over one row per cluster."""
    counted = labels.groupBy(label).agg(F.count(F.lit(1)).alias("members"))
    return counted.withColumn("share", F.col("members") / F.sum("members").over(Window.partitionBy()))


def segment_checks(
    labels: DataFrame,
    runs: DataFrame,
    k: int,
    k_range: Sequence[int] | None = None,
    max_share: float = 0.5,
    max_drop: float = 0.3,
    label: str = "classification",
) -> DataFrame:
    """Fewer users than last time, k at the edge of the search, one cluster too large.

    The elbow never returns the first or last k searched, so the edge is one inside.
    """
    crowded = cluster_shares(labels, label).where(F.col("share") >= F.lit(max_share))
    results = [
        rows_check(count_drops(runs, max_drop), "user_drop", "segments", "warn"),
        rows_check(crowded, "cluster_concentration", "segments", "warn"),
    ]
    if k_range:
        at_edge = k <= min(k_range) + 1 or k >= max(k_range) - 1
        one = labels.sparkSession.range(1).where(F.lit(at_edge))
        results.append(rows_check(one, "k_at_search_edge", "segments", "warn"))
    return union_all(results)
