"""Reusable row filters. Each returns a Column, so filters reach the scan.

Date bounds are compared as ``col >= start`` and ``col < end + 1 day`` on the raw
column. A cast around the column would hide it from parquet statistics.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.scalars import hour_floor

# Fixed values of the service's records.
CANCELLED_PICKUP_STATUSES = (4, 17)
COMPLETED = "COMPLETED"
DEAD_ORDER_STATUSES = ("CANCELLED", "REFUNDED")
NOT_WASHABLE_ITEM = "세탁불가 부속품"
RETENTION_YEARS = 5


def _col(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def parse_base_date(text: str) -> date:
    """Strict ``YYYY-MM-DD``; anything else is an error before a query is built."""
    try:
        return datetime.strptime(text, "%Y-%m-%d").date()
    except (TypeError, ValueError) as exc:
        raise ValueError(f"expected a YYYY-MM-DD date, got {text!r}") from exc


def _as_date(value: str | date) -> date:
    if isinstance(value, datetime):
        return value.date()
    return value if isinstance(value, date) else parse_base_date(value)


def wall_time(value: str | datetime | date) -> Column:
    """A clock reading as a zone-free timestamp literal; never shifted."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ") if isinstance(value, datetime) else str(value)
    return F.lit(text).cast("timestamp_ntz")


def is_succeeded(name: str | Column = "succeeded") -> Column:
    return _col(name) == 1


def is_payment(name: str | Column = "payment_type") -> Column:
    return _col(name) == 0


def is_cancellation(name: str | Column = "payment_type") -> Column:
    return _col(name).isin(1, 2)


def is_valid_pickup(
    status: str | Column = "status", excluded: Iterable[int] = CANCELLED_PICKUP_STATUSES
) -> Column:
    """Cancelled and not-collected pickups drop out; so does a NULL status."""
    return ~_col(status).isin(*excluded)


def is_own_channel(name: str | Column = "laundry_pgi") -> Column:
    return _col(name).isNull()


def is_valid_item(
    status: str | Column = "status",
    channel: str | Column = "channel_pgi",
    item_name: str | Column = "item_name",
    excluded: Iterable[int] = CANCELLED_PICKUP_STATUSES,
    accessory: str = NOT_WASHABLE_ITEM,
) -> Column:
    return is_valid_pickup(status, excluded) & is_own_channel(channel) & (_col(item_name) != accessory)


def is_completed(name: str | Column = "order_status") -> Column:
    return _col(name) == COMPLETED


def is_live_order(name: str | Column = "status", dead: Sequence[str] = DEAD_ORDER_STATUSES) -> Column:
    return ~_col(name).isin(*dead)


def on_days(name: str | Column, start: str | date, end: str | date) -> Column:
    """Calendar days start..end, the whole end day included."""
    first, last = _as_date(start), _as_date(end)
    return (_col(name) >= F.lit(first)) & (_col(name) < F.lit(last + timedelta(days=1)))


def between_instants(name: str | Column, start: str | date, end: str | date) -> Column:
    """Timestamp comparison: on the end day only midnight itself is inside."""
    return _col(name).between(F.lit(_as_date(start)), F.lit(_as_date(end)))


def on_base_date(name: str | Column, target_date: str) -> Column:
    return _col(name) == F.lit(parse_base_date(target_date))


def is_withdrawn(name: str | Column = "deleted_at") -> Column:
    return _col(name).isNotNull()


def retention_cutoff(base_time: str | datetime, years: int = RETENTION_YEARS) -> Column:
    return wall_time(base_time) - F.expr(f"INTERVAL {int(years)} YEARS")


def is_retained(name: str | Column, base_time: str | datetime, years: int = RETENTION_YEARS) -> Column:
    return _col(name) >= retention_cutoff(base_time, years)


def is_expired(name: str | Column, base_time: str | datetime, years: int = RETENTION_YEARS) -> Column:
    return _col(name) < retention_cutoff(base_time, years)


def from_current_hour(slot: str | Column, now: str | datetime) -> Column:
    return _col(slot) >= hour_floor(wall_time(now))


def known_values(name: str | Column, wanted: Sequence[str], known: Sequence[str]) -> Column:
    """``isin`` after refusing names that the dimension does not have."""
    unknown = sorted(set(wanted) - set(known))
    if unknown:
        raise ValueError(f"unknown values {unknown}; expected some of {list(known)}")
    return _col(name).isin(*wanted)
