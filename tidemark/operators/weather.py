"""Forecast slots and daily summaries from category/value rows.

Input rows: ``region, fcst_date (yyyyMMdd), fcst_time (HHmm), category, fcst_value
(text), seq`` where the highest ``seq`` is the last one written.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.predicates import from_current_hour, wall_time
from tidemark.functions.scalars import (
    PRECIPITATION_CODES,
    SKY_CODES,
    compact_day,
    compact_slot,
    decode,
    forecast_issue,
    to_number,
)

# The feed's categories.
FORECAST_CATEGORIES = ("TMP", "TMN", "TMX", "POP", "PTY", "PCP", "SNO", "REH", "WSD", "SKY")
OBSERVATION_CATEGORIES = ("T1H", "RN1", "PTY", "REH", "WSD")
DEFAULT_HOURS, MAX_HOURS = 24, 72


def slots_wide(rows: DataFrame, categories: tuple[str, ...] = FORECAST_CATEGORIES) -> DataFrame:
    """One row per region and slot, one text column per category, last value wins.

    The pivot values are given, so Spark needs no extra job to find them. Slot texts
    are parsed after the grouping, once per slot instead of once per row.
    """
    wide = (
        rows.groupBy("region", "fcst_date", "fcst_time")
        .pivot("category", list(categories))
        .agg(F.max_by("fcst_value", "seq"))
    )
    return wide.select("region", compact_slot("fcst_date", "fcst_time").alias("slot"), *categories)


def clamp_hours(hours: int | None) -> int:
    return DEFAULT_HOURS if hours is None else max(1, min(MAX_HOURS, int(hours)))


def upcoming_slots(wide: DataFrame, now: str | datetime, hours: int | None = None) -> DataFrame:
    """The first ``hours`` slots per region from the current hour onward.

    One row per region and hour, so a region's window partition is bounded by the
    forecast's reach.
    """
    w = Window.partitionBy("region").orderBy("slot")
    return (
        wide.where(from_current_hour("slot", now))
        .withColumn("rn", F.row_number().over(w))
        .where(F.col("rn") <= clamp_hours(hours))
        .drop("rn")
    )


def issued_at(now: str | datetime) -> Column:
    """When the forecast that is current at ``now`` was issued, as text to the minute."""
    return F.date_format(forecast_issue(wall_time(now)), "yyyy-MM-dd HH:mm").alias("issued_at")


def hourly_forecast(rows: DataFrame, now: str | datetime, hours: int | None = None) -> DataFrame:
    slots = upcoming_slots(slots_wide(rows), now, hours)
    # The names of the served fields.
    return slots.select(
        "region",
        issued_at(now),
        F.substring(F.col("slot").cast("string"), 6, 11).alias("time"),
        to_number("TMP").alias("temperature_c"),
        to_number("POP").alias("precip_prob_pct"),
        decode("PTY", PRECIPITATION_CODES).alias("precip_type"),
        F.col("PCP").alias("precip_mm"),
        F.col("SNO").alias("snow_cm"),
        to_number("REH").alias("humidity_pct"),
        to_number("WSD").alias("wind_speed_ms"),
        decode("SKY", SKY_CODES).alias("sky"),
    )


def daily_forecast(rows: DataFrame, now: str | datetime | None = None) -> DataFrame:
    """Daily low and high, highest rain chance, mean humidity; with ``now`` the issue time beside them.

    The feed's own daily low and high win; where one is missing, the hourly
    temperatures fill it, and the flag says so if either was missing. The last
    value of a category wins even if it is not a number.
    """
    number = to_number("fcst_value")

    def of(category: str):
        return F.when(F.col("category") == category, number)

    def last(category: str):
        mine = F.col("category") == category
        return F.max_by(F.struct(number.alias("v")), F.when(mine, F.col("seq")))["v"]

    days = rows.groupBy("region", "fcst_date").agg(
        last("TMN").alias("low"),
        last("TMX").alias("high"),
        F.min(of("TMP")).alias("tmp_min"),
        F.max(of("TMP")).alias("tmp_max"),
        F.max(of("POP")).alias("precip_prob_max_pct"),
        F.bround(F.avg(of("REH")), 0).cast("bigint").alias("humidity_avg_pct"),
    )
    return days.select(
        "region",
        *([] if now is None else [issued_at(now)]),
        compact_day("fcst_date").alias("date"),
        F.coalesce("low", "tmp_min").alias("temp_min_c"),
        F.coalesce("high", "tmp_max").alias("temp_max_c"),
        (F.col("low").isNull() | F.col("high").isNull()).alias("temp_from_hourly"),
        "precip_prob_max_pct",
        "humidity_avg_pct",
    )


def current_weather(rows: DataFrame) -> DataFrame:
    """Observation rows ``region, observed_at, category, obsr_value, seq`` as one row per region and time."""
    wide = (
        rows.groupBy("region", "observed_at")
        .pivot("category", list(OBSERVATION_CATEGORIES))
        .agg(F.max_by("obsr_value", "seq"))
    )
    return wide.select(
        "region",
        F.substring(F.col("observed_at").cast("string"), 1, 16).alias("observed_at"),
        to_number("T1H").alias("temperature_c"),
        to_number("RN1").alias("precip_1h_mm"),
        decode("PTY", PRECIPITATION_CODES).alias("precip_type"),
        to_number("REH").alias("humidity_pct"),
        to_number("WSD").alias("wind_speed_ms"),
    )


def actual_over_forecast(actual: DataFrame, forecast: DataFrame) -> DataFrame:
    """Observed value where there is one, else the prediction, over the union of days."""
    return (
        actual.select("region", "ds", F.col("temp").alias("_actual"))
        .join(forecast.select("region", "ds", F.col("yhat").alias("_yhat")), ["region", "ds"], "full_outer")
        .select("region", "ds", F.coalesce("_actual", "_yhat").alias("temp"))
    )


def weekly_change(temps: DataFrame, lag_days: int = 7) -> DataFrame:
    """Absolute change against the row ``lag_days`` earlier on the shared calendar.

    The calendar is every day that any region has. Days are numbered once, and each
    region looks back by that number, so a gap in one region does not shift it. A
    missing value on either side gives NULL. The numbering window and the broadcast
    hold distinct days only, a few million at most for the whole DATE range.
    """
    days = temps.select("ds").dropDuplicates()
    calendar = F.broadcast(days.withColumn("pos", F.row_number().over(Window.orderBy("ds"))))
    back = Window.partitionBy("region").orderBy("pos").rangeBetween(-lag_days, -lag_days)
    return (
        temps.join(calendar, "ds")
        .withColumn("change", F.abs(F.col("temp") - F.max("temp").over(back)))
        .drop("pos")
    )


def temperature_triggers(temps: DataFrame, degrees: tuple[int, ...] = (1, 2, 3), min_regions: int = 2) -> DataFrame:
    """Per day and threshold: 1 if enough regions changed by at least that much."""
    change = weekly_change(temps)
    return change.groupBy("ds").agg(
        *[
            (F.count_if(F.col("change") >= F.lit(float(d))) >= min_regions).cast("int").alias(f"temp_trigger_{d}deg")
            for d in degrees
        ]
    )
