"""Cohort retention by first pickup month."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import DAYS_PER_PERIOD, month_label, period_index


def first_day_per_user(pickups: DataFrame, user: str = "user_id", day: str = "wash_date") -> DataFrame:
    return pickups.groupBy(user).agg(F.min(day).alias("first_wash_date"))


def with_first_day(pickups: DataFrame, user: str = "user_id", day: str = "wash_date") -> DataFrame:
    """Distinct (user, day) pairs with the user's first day.

    The distinct step reduces each map task's rows first, so a user's group is
    bounded by the days of the calendar, however many pickups the user has.
    """
    days = pickups.select(user, day).dropDuplicates()
    return days.withColumn("first_wash_date", F.min(day).over(Window.partitionBy(user)))


def retention_cohorts(
    pickups: DataFrame, periods: int = 2, period_days: float = DAYS_PER_PERIOD, ordered: bool = True
) -> DataFrame:
    """Users per cohort month, and users seen in each period after their first day.

    Two phases instead of several distinct counts: one flag row per user, then
    sums. The per-user grouping reuses the window's partitioning by user.
    """
    seen = with_first_day(pickups).withColumn(
        "seq", period_index("first_wash_date", "wash_date", period_days)
    )
    flags = [F.max(F.when(F.col("seq") == n, 1).otherwise(0)).alias(f"ret_{n}") for n in range(periods)]
    per_user = seen.groupBy("user_id", "first_wash_date").agg(*flags)
    out = per_user.groupBy(month_label("first_wash_date").alias("cohort_month")).agg(
        F.count(F.lit(1)).alias("user_count"),
        *[F.sum(f"ret_{n}").cast("bigint").alias(f"ret_{n}") for n in range(periods)],
    )
    return out.orderBy("cohort_month") if ordered else out
