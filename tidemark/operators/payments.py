"""Payment staging, net payments per original payment, and their checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.predicates import is_cancellation, is_payment, is_succeeded
from tidemark.functions.scalars import month_label, signed_by_type, zero_as_null

# The staging contract. ``id`` is renamed, the parent key is carried
# because the mart groups by it, and the receipt order has no brand prefix.
STAGED_COLUMNS = (
    "payment_id",
    "parent_payment_id",
    "new_subscription_order_id",
    "old_subscription_order_id",
    "subscription_order_id",
    "user_id",
    "wash_id",
    "receipt_order_id",
    "payment_type",
    "payment_reason_type",
    "order_name",
    "order_price",
    "paid_price",
    "point_price",
    "coupon_price",
    "total_paid_price",
    "succeeded",
    "cancelled",
    "approved_at",
    "created_at",
    "created_date",
)


def stage_payments(raw: DataFrame, columns: Sequence[str] = STAGED_COLUMNS) -> DataFrame:
    """Rename and prune to the contract; keep succeeded payments only."""
    return raw.where(is_succeeded()).withColumnRenamed("id", "payment_id").select(*columns)


def net_payments(staged: DataFrame) -> DataFrame:
    """Net amount per original payment and user, whatever day a cancellation fell on.

    One pass: the four conditional sums share one partial and final aggregation.
    """

    def total(condition, amount: str):
        return F.sum(F.when(condition, F.col(amount)).otherwise(F.lit(0)))

    sums = staged.groupBy(
        zero_as_null("parent_payment_id", "payment_id").alias("original_payment_id"), "user_id"
    ).agg(
        F.min("created_date").alias("created_date"),
        F.min("approved_at").alias("approved_at"),
        total(is_payment(), "paid_price").alias("gross_paid_price"),
        total(is_payment(), "point_price").alias("gross_point_price"),
        total(is_cancellation(), "paid_price").alias("cancelled_price"),
        total(is_cancellation(), "point_price").alias("cancelled_point_price"),
    )
    gross = F.col("gross_paid_price") + F.col("gross_point_price")
    returned = F.col("cancelled_price") + F.col("cancelled_point_price")
    return sums.withColumn("net_paid_price", gross - returned)


def negative_net_payments(
    net: DataFrame, limit: float = -2000, exempt_years: Sequence[int] = (2019,)
) -> DataFrame:
    """Offending rows; none means the check passes.

    Documented exceptions: the exempt years precede parent tracking; rows whose
    gross and cancelled sums are all zero carry only a negative point amount; and
    small differences above ``limit`` are tolerated.
    """
    only_points = (
        (F.col("gross_paid_price") == 0) & (F.col("cancelled_price") == 0) & (F.col("cancelled_point_price") == 0)
    )
    bad = net.where((F.col("net_paid_price") < 0) & (F.col("net_paid_price") <= F.lit(limit)))
    if exempt_years:
        bad = bad.where(~F.year("created_date").isin(*exempt_years))
    return bad.where(~only_points)


def count_by_year(rows: DataFrame, day: str = "created_date") -> DataFrame:
    return rows.groupBy(F.year(day).alias("year")).agg(F.count(F.lit(1)).alias("violations"))


def worst_offenders(rows: DataFrame, n: int = 5) -> DataFrame:
    """Top-k of the lowest net amounts; the id settles ties."""
    return rows.orderBy("net_paid_price", "original_payment_id", "user_id").limit(n)


def signed_points(payments: DataFrame) -> DataFrame:
    """Each succeeded payment with its signed points and its original payment.

    Originals have parent 0, most of the table. They cannot match, so they skip
    the join: only cancellations are shuffled against the originals, and the
    value 0 never becomes a hot join key.
    """
    kept = payments.where(is_succeeded())
    base = kept.select(
        F.col("id"),
        F.col("user_id"),
        F.col("payment_type"),
        signed_by_type("point_price").alias("signed_point_price"),
        F.nullif(F.col("parent_payment_id"), F.lit(0)).alias("parent_id"),
    )
    no_parent = base.where(F.col("parent_id").isNull()).select(
        "*",
        F.lit(None).cast("bigint").alias("original_id"),
        F.lit(None).cast(payments.schema["paid_price"].dataType).alias("original_paid_price"),
    )
    originals = payments.select(F.col("id").alias("original_id"), F.col("paid_price").alias("original_paid_price"))
    with_parent = base.where(F.col("parent_id").isNotNull())
    matched = with_parent.join(originals, F.col("parent_id") == F.col("original_id"), "left")
    return no_parent.unionByName(matched)


def monthly_amount(rows: DataFrame, when: str, amount: str, name: str) -> DataFrame:
    return rows.groupBy(month_label(when).alias("month")).agg(F.sum(amount).alias(name))


def reconcile(model: DataFrame, reference: DataFrame, tolerance: float) -> DataFrame:
    """Month by month: model value against operating value, relative error, verdict.

    A month that only one side has is out of tolerance, and so is a value against 0; 0 against 0 is none.
    """
    joined = model.join(reference, "month", "full_outer")
    gap = F.abs(F.col("model_value") - F.col("reference_value"))
    error = F.when(gap == 0, F.lit(0.0)).otherwise(F.try_divide(gap, F.abs(F.col("reference_value"))))
    return joined.withColumn("relative_error", error).withColumn(
        "within_tolerance", F.coalesce(F.col("relative_error") <= F.lit(tolerance), F.lit(False))
    )
