"""Scalar rules as Spark expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import quote

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code tables and texts of the weather feed and of the service.
SKY_CODES = {"1": "맑음", "3": "구름많음", "4": "흐림"}
PRECIPITATION_CODES = {
    "0": "없음",
    "1": "비",
    "2": "비/눈",
    "3": "눈",
    "4": "소나기",
    "5": "빗방울",
    "6": "빗방울눈날림",
    "7": "눈날림",
}
COVERED_BY_PLAN = "정기결제 차감"
FIRST_USE, REPEAT_USE = "첫이용", "기존이용"
MASKED_NAME = "탈퇴회원"
MASKED_PHONE = "01000000000"
DAYS_PER_PERIOD = 30.5
PLAN_CATEGORY_PRIORITY = ("laundry_count", "shirt_count", "cleaning_count", "bedding_count", "launX_count")
DEFAULT_ITEM_CATEGORY = "cleaning_count"
CLOCK_ZONE = "Asia/Seoul"


def _col(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def zero_as_null(name: str | Column, default: str | Column) -> Column:
    """0 marks a missing parent; read it as NULL and fall back."""
    return F.coalesce(F.nullif(_col(name), F.lit(0)), _col(default))


def signed_by_type(amount: str | Column, payment_type: str | Column = "payment_type") -> Column:
    return F.when(_col(payment_type) == 0, _col(amount)).otherwise(-_col(amount))


def amount_or_label(amount: str | Column, label: str = COVERED_BY_PLAN) -> Column:
    """The number as text, or a label; the cast comes before the mixed coalesce."""
    return F.coalesce(_col(amount).cast("string"), F.lit(label))


def first_use_label(flag: str | Column) -> Column:
    """A NULL flag counts as repeat use."""
    return F.when(_col(flag), F.lit(FIRST_USE)).otherwise(F.lit(REPEAT_USE))


def month_label(day: str | Column) -> Column:
    return F.date_format(_col(day), "yyyy-MM")


def period_index(first_day: str | Column, day: str | Column, days: float = DAYS_PER_PERIOD) -> Column:
    return F.floor(F.datediff(_col(day), _col(first_day)) / F.lit(float(days))).cast("int")


def keyed_token(key: str | Column, salt: str) -> Column:
    """Repeatable unique token per row: a keyed SHA-256."""
    return F.sha2(F.concat(_col(key).cast("string"), F.lit(salt)), 256)


def random_token() -> Column:
    return F.expr("uuid()")


def log1p_or_zero(name: str | Column) -> Column:
    """ln(1+x) with missing values and values at or below -1 read as 0."""
    value = F.nanvl(F.coalesce(_col(name).cast("double"), F.lit(0.0)), F.lit(0.0))
    return F.when(value > -1.0, F.log1p(value)).otherwise(F.lit(0.0))


def to_number(name: str | Column) -> Column:
    """Bad or missing text becomes NULL, as do texts that spell NaN or infinity."""
    number = _col(name).try_cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def to_day(name: str | Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(_col(name), pattern)


def blank_as(name: str | Column, default: str) -> Column:
    return F.coalesce(F.nullif(_col(name), F.lit("")), F.lit(default))


def one_zone(text: str | Column, pattern: str = "yyyy-MM-dd HH:mm:ss Z", zone: str = CLOCK_ZONE) -> Column:
    """Texts with mixed offsets to one wall clock, so month borders agree.

    The instant is read with its own offset and counted from 1970, so the session's
    time zone and its clock changes have no part in the result.
    """
    instant = F.try_to_timestamp(_col(text), F.lit(pattern))
    seconds = (F.unix_micros(instant) / F.lit(1_000_000)).cast("decimal(18,6)")
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def whole_part(name: str | Column, kind: str = "int") -> Column:
    """Truncation toward zero."""
    return _col(name).cast(kind)


def dashboard_day(day: str | Column) -> Column:
    return F.date_format(_col(day), "yyyy. M. d")


def decode(name: str | Column, codes: Mapping[str, str]) -> Column:
    """Known codes become their text, unknown ones pass through."""
    pairs = [F.lit(x) for item in codes.items() for x in item]
    text = _col(name).cast("string")
    return F.coalesce(F.try_element_at(F.create_map(*pairs), text), text)


def compact_day(text: str | Column) -> Column:
    return F.try_to_date(_col(text), "yyyyMMdd")


def compact_slot(day_text: str | Column, time_text: str | Column) -> Column:
    """``yyyyMMdd`` + ``HHmm`` to a zone-free timestamp; bad text gives NULL."""
    joined, digits = F.concat(_col(day_text), _col(time_text)), r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})$"
    iso = F.regexp_replace(joined, digits, "$1-$2-$3 $4:$5:00")
    return F.when(joined.rlike(digits), iso.try_cast("timestamp_ntz"))


def hour_floor(name: str | Column) -> Column:
    """The full hour of a wall time. ``date_trunc`` would pass through the session's zone."""
    t = _col(name)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0))


def observation_issue(now: str | Column) -> Column:
    """Hourly observations are served 45 minutes after the hour."""
    return hour_floor(_col(now) - F.expr("INTERVAL 45 MINUTES"))


def forecast_issue(now: str | Column) -> Column:
    """Latest of the 02, 05, ..., 23 o'clock issues, served 15 minutes later.

    Shifted back by 02:15 the issues fall on multiples of three hours from
    midnight, and a time before 02:15 falls on the previous day's last one.
    """
    shifted = (_col(now) - F.expr("INTERVAL 135 MINUTES")).cast("timestamp_ntz")
    midnight = shifted.cast("date").cast("timestamp_ntz")
    hours = (F.floor(F.hour(shifted) / 3) * 3 + 2).cast("int")
    return midnight + F.make_dt_interval(F.lit(0), hours)


def service_clock(instant: str | Column, zone: str = CLOCK_ZONE) -> Column:
    """UTC wall time to the service's wall time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(instant).cast("timestamp_ntz"))


def redact(text: str | Column, secrets: Sequence[str], mark: str = "***") -> Column:
    """Replace every secret, written plainly or percent-encoded, by ``mark``."""
    out = _col(text)
    for secret in secrets:
        if not secret:
            continue
        for form in dict.fromkeys((secret, quote(secret, safe=""))):
            out = F.replace(out, F.lit(form), F.lit(mark))
    return out


def plan_category(
    counts: Mapping[str, str] | None = None, priority: Sequence[str] = PLAN_CATEGORY_PRIORITY
) -> Column:
    """First category of the fixed priority whose count is not zero."""
    counts = counts or {name: name for name in priority}
    return F.coalesce(*[F.when(F.col(counts[name]) != 0, F.lit(name)) for name in priority])


def plan_unit_price(discounted: str | Column, original: str | Column) -> Column:
    """Below half of the original price, the price cut itself is the unit price."""
    low, full = _col(discounted), _col(original)
    return F.when(low < full * F.lit(0.5).cast("decimal(2,1)"), full - low).otherwise(low)


def deducted_count(kind: str | Column, quantity: str | Column) -> Column:
    """Only SUBTRACT rows use up plan units; a NULL kind counts 0."""
    return F.when(_col(kind) == "SUBTRACT", _col(quantity)).otherwise(F.lit(0))
