"""Publishing, snapshots and appends that may be run again."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import folder_exists, materialize, remove_folder

TARGET_SCHEMAS = {"dev": "dev_sandbox", "prod": "analytics_mart"}
#: Records of one payload.
PAYLOAD_ROWS = 10_000
#: Versions of a snapshot that stay readable.
VERSIONS_KEPT = 7
VERSION_SCHEMA = "number bigint, version string"


def qualified_name(model: str, target: str = "dev", schemas: dict[str, str] | None = None) -> str:
    """Table name in the target's schema; the default target is the safe one."""
    schemas = schemas or TARGET_SCHEMAS
    if target not in schemas:
        raise ValueError(f"unknown target {target!r}; known: {list(schemas)}")
    return f"{schemas[target]}.{model}"


def publish_table(
    df: DataFrame, model: str, target: str = "dev", partition_by: Sequence[str] = (), schemas=None, root: str | None = None
) -> str:
    """Write a model as a table of the target's schema; ``root`` places a new schema elsewhere than in the warehouse."""
    name = qualified_name(model, target, schemas)
    schema = name.split(".")[0]
    place = f" LOCATION '{os.path.join(root, schema)}'" if root else ""
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {schema}{place}")
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return name


def publish_snapshot(df: DataFrame, root: str, version: str, view: str | None = None, keep: int = VERSIONS_KEPT) -> str:
    """Write a new version folder below ``root``, then make it the current one for every session and application.

    ``_versions`` is a log of versions, one row per publication, appended as one small file: a reader sees the old
    version or the new one, nothing between. ``view`` is a view of the catalog besides, replaced in one step. Readers of an
    old version go on with it, as no file they use changes: the ``keep`` versions published last stay.
    """
    spark = df.sparkSession
    path, log = os.path.join(root, f"version={version}"), os.path.join(root, "_versions")
    df.write.mode("errorifexists").parquet(path)
    before = snapshot_versions(spark, root)
    number = before[-1][0] + 1 if before else 1
    spark.createDataFrame([(number, version)], VERSION_SCHEMA).coalesce(1).write.mode("append").parquet(log)
    if view:
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{path}`")
    for _, old in before[: len(before) + 1 - max(1, keep)]:
        remove_folder(spark, os.path.join(root, f"version={old}"))
    return path


def snapshot_versions(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """Number and name of all versions ever published, the current one last."""
    log = read_or_empty(spark, os.path.join(root, "_versions"), StructType.fromDDL(VERSION_SCHEMA))
    return [tuple(r) for r in log.orderBy("number").collect()]


def read_snapshot(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """The current version, or the named one, as long as it is kept."""
    if version is None:
        versions = snapshot_versions(spark, root)
        if not versions:
            raise FileNotFoundError(f"nothing was published below {root}")
        version = versions[-1][1]
    return spark.read.parquet(os.path.join(root, f"version={version}"))


def write_csv_snapshot(df: DataFrame, path: str, snapshot_date: str) -> None:
    """CSV for the CRM import, one folder per snapshot date; a rerun replaces its day."""
    (
        df.withColumn("snapshot_date", F.lit(snapshot_date))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy("snapshot_date")
        .csv(path)
    )


def write_json_records(df: DataFrame, path: str) -> None:
    """One JSON record per line, any size, written by all tasks."""
    df.write.mode("overwrite").json(path)


def json_payload(df: DataFrame, target: str, order_by: Sequence[str], rows: int = PAYLOAD_ROWS) -> DataFrame:
    """Numbered payloads ``(target, part, row_count, payload)`` of ``rows`` records each, in order.

    Tasks sort ranges of the rows; the counts of the ranges give each row its place, so no task holds more
    than a range, and a payload never more than ``rows`` records. An empty frame gives one empty payload.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(*order_by).withColumn("_range", F.spark_partition_id())
    held = materialize(ranged, "payload")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    heads = held.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_head")
    )
    within = Window.partitionBy("_range").orderBy(*order_by)
    numbered = held.withColumn("_nth", F.row_number().over(within) - 1).join(heads, "_range")
    place = F.col("_head") + F.col("_nth")
    record = F.struct(place.alias("k"), F.struct(*df.columns).alias("r"))
    parts = numbered.groupBy((F.floor(place / rows) + 1).cast("int").alias("part")).agg(F.sort_array(F.collect_list(record)).alias("s"))
    if held.isEmpty():
        kind = f"part int, s {parts.schema['s'].dataType.simpleString()}"
        parts = spark.createDataFrame([(1, [])], kind)
    data = parts.select("part", F.transform("s", lambda x: x["r"]).alias("data"))
    return data.select(
        F.lit(target).alias("target"),
        "part",
        F.size("data").cast("bigint").alias("row_count"),
        F.to_json(F.struct(F.lit(target).alias("target"), F.col("data")), {"ignoreNullFields": "false"}).alias("payload"),
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written at ``path`` (an empty folder raises when it is read)."""
    if not folder_exists(spark, path):
        return False
    try:
        spark.read.parquet(path).schema
    except Exception as exc:
        if "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return False
        raise
    return True


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def first_per_key(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """One row per key, the lowest by ``order_by``.

    ``min_by`` keeps one candidate per key and map task, so copies of a hot key
    never meet in one place before they have been reduced.
    """
    row = F.struct(*df.columns)
    return df.groupBy(key).agg(F.min_by(row, F.struct(*order_by)).alias("r")).select("r.*")


def absent(rows: DataFrame, held: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``held``; a null key is a key like others."""
    seen = held.select(F.col(key).alias("_held"))
    return rows.join(seen, F.col(key).eqNullSafe(F.col("_held")), "left_anti")


def new_rows(batch: DataFrame, target: DataFrame, key: str, order_by: Sequence[str] | None = None) -> DataFrame:
    """Rows whose key the target lacks, each key once; a null key is a key like others.

    Only the key column of the target is read. The key is unique on the target
    and made unique in the batch, so this join has no hot key.
    """
    return absent(first_per_key(batch, key, order_by or batch.columns), target, key)


def append_new(batch: DataFrame, path: str, key: str, order_by: Sequence[str] | None = None) -> int:
    """Append unseen rows to the table at ``path``; a second run appends none."""
    spark = batch.sparkSession
    target, seen = read_or_empty(spark, path, batch.schema), Observation()
    new = new_rows(batch, target, key, order_by).select(*batch.columns)
    new.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return seen.get["rows"]


def freeze_forecast(forecast: DataFrame, path: str, as_of_date: str) -> None:
    """Keep this run's predictions under its own date; a rerun replaces only that date."""
    (
        forecast.withColumn("as_of_date", F.lit(as_of_date).cast("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("as_of_date")
        .parquet(path)
    )
