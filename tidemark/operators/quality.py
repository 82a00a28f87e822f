"""Declared checks. Each gives one row:
``(check, target, status, failures, severity, message)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.predicates import wall_time

RESULT_COLUMNS = ("check", "target", "status", "failures", "severity", "message")
SEVERITY_RANK = {"pass": 0, "warn": 1, "error": 2}


def _verdict(counted: DataFrame, failures: str, check: str, target: str, severity: str) -> DataFrame:
    bad = F.coalesce(F.col(failures).cast("bigint"), F.lit(0).cast("bigint"))
    status = F.when(bad > 0, F.lit(severity)).otherwise(F.lit("pass"))
    return counted.select(
        F.lit(check).alias("check"),
        F.lit(target).alias("target"),
        status.alias("status"),
        bad.alias("failures"),
        F.lit(severity).alias("severity"),
        F.concat(F.lit(f"{check} on {target}: "), bad.cast("string"), F.lit(" failing")).alias("message"),
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def unique_check(df: DataFrame, columns: Sequence[str] | str, target: str, severity: str = "error") -> DataFrame:
    """Number of keys that occur more than once; keys with a NULL part are not counted."""
    names = [columns] if isinstance(columns, str) else list(columns)
    present = df.dropna(subset=names)
    doubled = present.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return _verdict(doubled.agg(F.count(F.lit(1)).alias("f")), "f", f"unique({','.join(names)})", target, severity)


def row_rules(
    df: DataFrame,
    target: str,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence] | None = None,
    conditions: Mapping[str, Column] | None = None,
    severity: str = "error",
) -> DataFrame:
    """All row-level rules of a table from a single aggregation over it.

    ``conditions`` maps a rule name to a Column that is true for a bad row.
    """
    rules: dict[str, Column] = {f"not_null({c})": F.col(c).isNull() for c in not_null}
    for name, values in (accepted or {}).items():
        rules[f"accepted_values({name})"] = F.col(name).isNotNull() & ~F.col(name).isin(*values)
    rules.update(conditions or {})
    sums = df.agg(*[F.count_if(bad).alias(f"r{i}") for i, bad in enumerate(rules.values())])
    stacked = sums.select(
        F.explode(
            F.array(
                *[F.struct(F.lit(rule).alias("check"), F.col(f"r{i}").alias("f")) for i, rule in enumerate(rules)]
            )
        ).alias("x")
    ).select("x.*")
    status = F.when(F.col("f") > 0, F.lit(severity)).otherwise(F.lit("pass"))
    return stacked.select(
        "check",
        F.lit(target).alias("target"),
        status.alias("status"),
        F.col("f").alias("failures"),
        F.lit(severity).alias("severity"),
        F.concat("check", F.lit(f" on {target}: "), F.col("f").cast("string"), F.lit(" failing")).alias("message"),
    )


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent, with their row counts; NULL keys are skipped.

    Children are counted per key first, so a hot key is one row in the join.
    """
    keys = child.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return keys.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")


def relationship_check(
    child: DataFrame, key: str, parent: DataFrame, parent_key: str, target: str, severity: str = "error"
) -> DataFrame:
    lost = orphans(child, key, parent, parent_key).agg(F.sum("n").alias("f"))
    return _verdict(lost, "f", f"relationships({key})", target, severity)


def rows_check(bad_rows: DataFrame, check: str, target: str, severity: str = "error") -> DataFrame:
    """A query that returns offending rows; zero rows pass."""
    return _verdict(bad_rows.agg(F.count(F.lit(1)).alias("f")), "f", check, target, severity)


def negative_service_amounts(items: DataFrame) -> DataFrame:
    """Negative service amounts on rows that use up plan units."""
    return items.where((F.col("service_total_price") < 0) & (F.col("subtract_type") != "NONE"))


def freshness_check(
    df: DataFrame, loaded_at: str, target: str, as_of: str, warn_hours: int = 24, error_hours: int = 48
) -> DataFrame:
    """Age of the newest row; an empty table is an error."""
    newest = df.agg(F.max(loaded_at).alias("newest"))
    age = wall_time(as_of) - F.col("newest").cast("timestamp_ntz")
    aged = newest.withColumn("hours", F.date_part(F.lit("DAY"), age) * 24 + F.date_part(F.lit("HOUR"), age))
    status = (
        F.when(F.col("newest").isNull() | (age > F.make_dt_interval(hours=F.lit(error_hours))), "error")
        .when(age > F.make_dt_interval(hours=F.lit(warn_hours)), "warn")
        .otherwise("pass")
    )
    return aged.select(
        F.lit(f"freshness({loaded_at})").alias("check"),
        F.lit(target).alias("target"),
        status.alias("status"),
        F.when(status == "pass", 0).otherwise(1).cast("bigint").alias("failures"),
        F.when(status == "pass", F.lit("error")).otherwise(status).alias("severity"),
        F.concat(
            F.lit(f"freshness on {target}: "),
            F.coalesce(F.concat(F.col("hours").cast("string"), F.lit(" hours old")), F.lit("no rows")),
        ).alias("message"),
    )


def volume_check(df: DataFrame, target: str, min_rows: int = 1, metric: str | None = None) -> DataFrame:
    """Zero rows, fewer rows than expected, or key metric values at or below zero."""
    metric_bad = F.count_if(F.col(metric) <= 0) if metric else F.lit(0).cast("bigint")
    counted = df.agg(F.count(F.lit(1)).alias("row_count"), metric_bad.alias("bad"))
    message = (
        F.when(F.col("row_count") == 0, F.lit("no rows"))
        .when(F.col("row_count") < min_rows, F.lit("fewer rows than expected"))
        .when(F.col("bad") > 0, F.lit("key metric at or below zero"))
        .otherwise(F.lit("ok"))
    )
    return counted.select(
        F.lit("volume").alias("check"),
        F.lit(target).alias("target"),
        F.when(message == "ok", "pass").otherwise("warn").alias("status"),
        F.when(message == "ok", 0).otherwise(1).cast("bigint").alias("failures"),
        F.lit("warn").alias("severity"),
        message.alias("message"),
        F.col("row_count"),
    )


def parity_check(reconciled: DataFrame, target: str, severity: str = "error") -> DataFrame:
    return rows_check(reconciled.where(~F.col("within_tolerance")), "parity", target, severity)


def worst_status(results: DataFrame) -> DataFrame:
    """One row: the worst status of all results and how many were not a pass."""
    pairs = [F.lit(x) for item in SEVERITY_RANK.items() for x in item]
    rank = F.element_at(F.create_map(*pairs), F.col("status"))
    back = [F.lit(x) for k, v in SEVERITY_RANK.items() for x in (v, k)]
    return results.agg(
        F.element_at(F.create_map(*back), F.coalesce(F.max(rank), F.lit(0))).alias("status"),
        F.count(F.lit(1)).alias("checks"),
        F.count_if(F.col("status") != "pass").alias("not_passed"),
    )
