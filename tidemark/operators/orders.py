"""Order report: main orders with store purchases and membership payments."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.predicates import between_instants, is_completed, is_live_order, is_own_channel, on_days
from tidemark.functions.scalars import amount_or_label, first_use_label

# Report headings.
REPORT_HEADINGS = {
    "order_date": "주문 일자",
    "order_id": "주문 번호",
    "user_id": "고객 번호",
    "membership_amount": "멤버십 이용 금액",
    "store_amount": "스토어 결제 금액",
    "first_use": "첫 이용 여부",
}


def store_purchases(store: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """Positive net store amount per user and order; rows are reduced before any join."""
    net = F.sum(F.col("pay_amount") - F.col("cancel_amount"))
    return (
        store.where(is_completed() & on_days("created_at", start, end))
        .groupBy("user_id", "order_id")
        .agg(net.alias("net_pay_amount"))
        .where(F.col("net_pay_amount") > 0)
    )


def order_report(
    main: DataFrame,
    store: DataFrame,
    membership: DataFrame,
    start: str | date,
    end: str | date,
    whole_end_day: bool = True,
    headings: dict[str, str] | None = None,
) -> DataFrame:
    """Live own-channel orders of a period with their store and membership amounts.

    ``whole_end_day=False`` compares timestamps, which leaves out the end day after
    midnight. Joins are by order only, as the report is read per order: an order
    with purchases of two users gives two rows.
    """
    in_period = on_days if whole_end_day else between_instants
    orders = main.where(
        is_live_order() & is_own_channel("external_channel_pgi") & in_period("created_at", start, end)
    )
    bought = store_purchases(store, start, end).select("order_id", "net_pay_amount")
    report = (
        orders.join(bought, "order_id", "left")
        .join(membership, "order_id", "left")
        .select(
            F.to_date("created_at").alias("order_date"),
            "order_id",
            "user_id",
            amount_or_label("membership_price").alias("membership_amount"),
            F.coalesce("net_pay_amount", F.lit(0)).alias("store_amount"),
            first_use_label("is_first_order").alias("first_use"),
        )
    )
    return report.withColumnsRenamed(headings) if headings else report
