"""User lists and averages that are asked for again and again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.predicates import on_base_date
from tidemark.functions.scalars import month_label


def users_with_item(users: DataFrame, items: DataFrame, condition: Column, user: str = "user_id") -> DataFrame:
    """Users who handed in an item; the item side is reduced to its users first."""
    return users.join(items.where(condition).select(user).dropDuplicates(), user, "left_semi")


def users_without_item(users: DataFrame, items: DataFrame, condition: Column, user: str = "user_id") -> DataFrame:
    return users.join(items.where(condition).select(user).dropDuplicates(), user, "left_anti")


def buyers_average(buyers: DataFrame, activity: DataFrame, user: str = "user_id") -> DataFrame:
    """Average length in days, paid amount and pickups over the users of one coupon.

    ``activity`` has one row per event (``day``, ``paid_price``); it is reduced to a
    row per user before the semi join, and the averages come from exact sums.
    """
    per_user = activity.groupBy(user).agg(
        F.datediff(F.max("day"), F.min("day")).cast("bigint").alias("days"),
        F.sum("paid_price").alias("paid"),
        F.count(F.lit(1)).alias("pickups"),
    )
    chosen = per_user.join(buyers.select(user).dropDuplicates(), user, "left_semi")

    def mean(name: str) -> Column:
        return F.try_divide(F.sum(name).cast("double"), F.count(F.lit(1)).cast("double"))

    return chosen.agg(
        F.count(F.lit(1)).alias("users"),
        mean("days").alias("avg_days"),
        mean("paid").alias("avg_paid"),
        mean("pickups").alias("avg_pickups"),
    )


def channel_class(channel: str, paid: Sequence[str]) -> Column:
    """``paid`` for the listed channels; own and unclassified ones are ``organic``."""
    return F.when(F.col(channel).isin(*paid), F.lit("paid")).otherwise(F.lit("organic"))


def channel_counts(events: DataFrame, paid: Sequence[str], kinds: Mapping[str, str]) -> DataFrame:
    """Sign-ups, installs and removals by month and channel class.

    ``kinds`` maps event types to their report names; other types are not counted.
    """
    wanted = events.where(F.col("event_type").isin(*kinds))
    name = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in kinds.items()])
    return wanted.groupBy(
        month_label("ts").alias("month"),
        channel_class("channel", paid).alias("channel_class"),
        name.alias("event"),
    ).agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("total_value"))


def rfm_features(orders: DataFrame, base_date: str, user: str = "user_id") -> DataFrame:
    """Recency, frequency and amount per user up to a base date.

    ``base_date`` is checked before use. Later orders do not count, so recency is
    never negative.
    """
    day = F.to_date(F.lit(base_date), "yyyy-MM-dd")
    features = (
        orders.where(F.col("day") <= day)
        .groupBy(user)
        .agg(
            F.datediff(day, F.max("day")).alias("recency"),
            F.count(F.lit(1)).alias("frequency"),
            F.sum("amount").alias("monetary"),
            F.datediff(F.max("day"), F.min("day")).alias("tenure"),
            F.max("amount").alias("max_amount"),
        )
    )
    return features.withColumn("base_date", day)


def features_on(features: DataFrame, target_date: str) -> DataFrame:
    """The feature rows of one base date; a partition filter when so partitioned."""
    return features.where(on_base_date("base_date", target_date)).drop("base_date")
