"""Keeping and masking payments of withdrawn members."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.predicates import RETENTION_YEARS, is_expired, is_retained, is_withdrawn
from tidemark.functions.scalars import MASKED_NAME, MASKED_PHONE, keyed_token, random_token
from tidemark.sources.keyed import KeyedTable


def transfer_rows(
    members: DataFrame, payments: DataFrame, base_time: str | datetime, years: int = RETENTION_YEARS
) -> DataFrame:
    """Payments of withdrawn members inside the retention window.

    Only payment columns are kept and member ids are unique, so a semi join is
    enough. The window filter runs at the payment scan. A member with very many
    payments makes a skewed join partition, which adaptive execution splits.
    """
    gone = members.where(is_withdrawn()).select(F.col("id").alias("user_id"))
    return payments.where(is_retained("created_at", base_time, years)).join(gone, "user_id", "left_semi")


def needs_mask(name: str = "user_name", parity: bool = False) -> Column:
    """Not masked yet. The plain comparison (``parity``) skips rows without a name."""
    if parity:
        return F.col(name) != MASKED_NAME
    return ~F.col(name).eqNullSafe(MASKED_NAME)


def _masked(rows: DataFrame, due: Column, salt: str | None) -> DataFrame:
    token = keyed_token("id", salt) if salt is not None else random_token()
    values = {"user_name": F.lit(MASKED_NAME), "user_email": token, "user_phone_number": F.lit(MASKED_PHONE)}
    return rows.withColumns({c: F.when(due, v).otherwise(F.col(c)) for c, v in values.items()})


def mask_main(
    payments: DataFrame,
    members: DataFrame,
    base_time: str | datetime,
    salt: str | None = "retention",
    years: int = RETENTION_YEARS,
    parity: bool = False,
) -> DataFrame:
    """All payments, with expired ones of withdrawn members masked.

    Rows that cannot be due, recent or already masked ones, pass through without a
    shuffle. Only the rest meets the withdrawn members. ``salt=None`` uses random
    tokens, which differ from run to run.
    """
    # The plain condition reaches the scan of the due side; its null-safe negation takes the rest.
    candidate = is_expired("created_at", base_time, years) & needs_mask(parity=parity)
    gone = members.where(is_withdrawn()).select(F.col("id").alias("user_id"), F.lit(True).alias("_gone"))
    checked = payments.where(candidate).join(gone, "user_id", "left")
    masked = _masked(checked, F.col("_gone").isNotNull(), salt).select(*payments.columns)
    return payments.where(~F.coalesce(candidate, F.lit(False))).unionByName(masked)


def mask_store(
    stored: DataFrame,
    base_time: str | datetime,
    salt: str | None = "retention",
    years: int = RETENTION_YEARS,
    parity: bool = False,
) -> DataFrame:
    """The retention store, masked by age alone: it holds withdrawn members only."""
    due = is_expired("created_at", base_time, years) & needs_mask(parity=parity)
    return _masked(stored, F.coalesce(due, F.lit(False)), salt)


def rows_due(
    payments: DataFrame,
    members: DataFrame | None,
    base_time: str | datetime,
    years: int = RETENTION_YEARS,
    parity: bool = False,
) -> DataFrame:
    """Rows that masking would change, to be counted before anything is written."""
    due = payments.where(is_expired("created_at", base_time, years) & needs_mask(parity=parity))
    if members is None:
        return due
    return due.join(members.where(is_withdrawn()).select(F.col("id").alias("user_id")), "user_id", "left_semi")


def run_retention(
    members: DataFrame,
    payments: DataFrame,
    store_path: str,
    masked_main_path: str,
    masked_store_path: str,
    base_time: str | datetime,
    salt: str | None = "retention",
) -> dict[str, int]:
    """Transfer, mask the main table, mask the store; return the three row counts.

    Masked tables go to new paths, to be swapped in by ``publish_snapshot``. Each
    step can be run again: transfer adds unseen ids only, as the store is a ``KeyedTable``, and masking skips masked
    rows.
    """
    store = KeyedTable(payments.sparkSession, store_path, "id")
    moved = store.append(transfer_rows(members, payments, base_time), ["created_at"])
    stored = store.read(payments.schema)
    counts = {
        "transferred": moved.rows,
        "masked_main": rows_due(payments, members, base_time).count(),
        "masked_store": rows_due(stored, None, base_time).count(),
    }
    mask_main(payments, members, base_time, salt).write.mode("errorifexists").parquet(masked_main_path)
    mask_store(stored, base_time, salt).write.mode("errorifexists").parquet(masked_store_path)
    return counts
