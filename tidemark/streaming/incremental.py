"""Loads that process only what is new since the last run."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StructType, TimestampNTZType, TimestampType

from tidemark.sources.keyed import Appended, KeyedTable
from tidemark.sources.sinks import new_rows, read_or_empty

REFRESH_INTERVAL = "15 minutes"
#: How far before the newest loaded row a later load still looks for unseen ones.
LOOKBACK = "3 days"


class Load(NamedTuple):
    """Rows appended, and unseen rows that were too late for it (lazy)."""

    loaded: int
    missed: DataFrame


def _edge(target: DataFrame, ts: str, lookback: str) -> Column | None:
    """The target's newest time less the lookback, as a literal of the column's type; None without rows.

    A zoned time travels as microseconds, so no session or system zone takes part.
    """
    kind = target.schema[ts].dataType
    newest = F.max(ts)
    mark = target.agg((F.unix_micros(newest) if isinstance(kind, TimestampType) else newest.cast("string")).alias("m")).first()["m"]
    if mark is None:
        return None
    edge = F.timestamp_micros(F.lit(mark)) if isinstance(kind, TimestampType) else F.lit(mark).cast(kind)
    return (edge - F.expr(f"interval {lookback}")).cast(kind) if isinstance(kind, (TimestampType, TimestampNTZType, DateType)) else edge


def rows_after(
    source: DataFrame, target: DataFrame, ts: str, key: str, lookback: str | None = LOOKBACK
) -> tuple[DataFrame, DataFrame]:
    """(source rows to load, unseen rows that are too old for it); of a key that comes twice, the earliest.

    Rows from ``lookback`` before the target's newest on are compared by key, and so are rows without a
    time. Both ranges are filters on literals that reach the scans. Without a lookback all rows are compared.
    A null key is a key like others.
    """
    edge = _edge(target, ts, lookback) if lookback else None
    if edge is None:
        return _unseen(source, target, ts, key), source.limit(0)
    fresh, old = (F.col(ts) >= edge) | F.col(ts).isNull(), F.col(ts) < edge
    # A key among the old rows may have come again since, so these are compared with all of the target.
    return _unseen(source.where(fresh), target.where(fresh), ts, key), _unseen(source.where(old), target, ts, key)


def _unseen(rows: DataFrame, target: DataFrame, ts: str, key: str) -> DataFrame:
    return new_rows(rows, target, key, [ts, *[c for c in rows.columns if c != ts]]).select(*rows.columns)


def load_increment(source: DataFrame, path: str, ts: str, key: str, lookback: str | None = LOOKBACK) -> Load:
    """Append new rows to the table at ``path``. The first run loads all, a rerun 0.

    ``lookback=None`` compares all keys, and so loads what earlier runs have missed.
    """
    spark = source.sparkSession
    new, missed = rows_after(source, read_or_empty(spark, path, source.schema), ts, key, lookback)
    seen = Observation()
    new.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return Load(seen.get["rows"], missed)


def read_files_stream(
    spark: SparkSession, path: str, schema: StructType, glob: str | None = None, files_per_trigger: int = 1000
) -> DataFrame:
    """New files below ``path``. A pattern also takes a table that is one single file."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def _trigger(interval: str | None) -> dict:
    return {"processingTime": interval} if interval else {"availableNow": True}


def stream_append(stream: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Append a stream to parquet. Without an interval it takes what is there and stops.

    The checkpoint remembers the files taken, so a restart adds nothing twice. Pass
    ``REFRESH_INTERVAL`` for a copy that is refreshed every 15 minutes.
    """
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**_trigger(interval))
        .start()
    )


def _by_batch(stream: DataFrame, table: KeyedTable, order_by: Sequence[str] | None, checkpoint: str, interval: str | None) -> StreamingQuery:
    """Append each micro-batch's unseen keys. A batch that is replayed finds its keys there and adds none."""

    def append(batch: DataFrame, batch_id: int) -> None:
        KeyedTable(batch.sparkSession, table.path, table.key, table.folders).append(batch, order_by)

    return stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(**_trigger(interval)).start()


def stream_transfer(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    key: str = "id",
    order_by: Sequence[str] | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Append each micro-batch's unseen keys to a ``KeyedTable``, whose filters spare it most of the key column."""
    return _by_batch(stream, KeyedTable(stream.sparkSession, path, key), order_by, checkpoint, interval)


def stream_once(
    stream: DataFrame, path: str, checkpoint: str, ts: str, key: str, delay: str = LOOKBACK, interval: str | None = None
) -> StreamingQuery:
    """Load every key once: repeats within ``delay`` are dropped by the state store, older ones by the table's keys.

    The state holds the keys of the last ``delay`` of event time and no more. Rows behind the watermark are late:
    the state cannot judge them and drops them, ``late_count`` tells how many, and ``load_late`` loads them. Rows
    without a time pass by the state. ``fate`` tells which way a row came: timely, undated or late.
    """
    timed = stream.where(F.col(ts).isNotNull()).withColumn("_event_time", F.col(ts).cast("timestamp"))
    timely = timed.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark([key]).drop("_event_time")
    undated = stream.where(F.col(ts).isNull())
    rows = timely.withColumn("fate", F.lit("timely")).unionByName(undated.withColumn("fate", F.lit("undated")))
    order = ["fate", ts, *[c for c in stream.columns if c != ts]]
    return _by_batch(rows, KeyedTable(stream.sparkSession, path, key), order, checkpoint, interval)


def late_count(query: StreamingQuery) -> int:
    """Rows behind the watermark (late ones, and repeats of old ones) in the progress that the query remembers."""
    return sum(o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators)


def load_late(source: DataFrame, path: str, ts: str, key: str) -> Appended:
    """Load what the stream has dropped as late: the source's rows whose key the table of ``stream_once`` lacks."""
    table = KeyedTable(source.sparkSession, path, key)
    return table.append(source.withColumn("fate", F.lit("late")), [ts, *[c for c in source.columns if c != ts]])
