"""What the operators share: reading the tables, bounded Arrow batches, Arrow helpers."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows and bytes of one Arrow batch at most, so that long texts do not fill a worker.
ARROW_ROWS, ARROW_BYTES = 1000, 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small: a batch of long texts must fit beside others in one worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished steps.

    It does so for plans that the driver no longer refers to, once that is noticed by a garbage collection.
    """
    for _ in range(2):  # the first round frees what Python held in the driver's JVM
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


class Memory(dict):
    """Results of a function for its latest arguments, in two generations of ``size`` entries.

    When the young generation is full it becomes the old one; what is asked for again moves back. Arguments of more
    than ``LONGEST`` characters are not kept, so that bytes are bounded too.
    """

    LONGEST = 64

    def __init__(self, function: Callable, size: int = 200_000) -> None:
        super().__init__()
        self.function, self.size, self.old = function, size, {}

    def __missing__(self, key):
        if len(key) > self.LONGEST:
            return self.function(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.function(key)
        self[key] = value
        return value


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(
    df: DataFrame, rows: Callable[[pa.RecordBatch], Iterator[dict]], schema: StructType | str
) -> DataFrame:
    """``mapInArrow`` for a function that gives dicts of columns for each batch."""
    bound_batches(df.sparkSession)
    parsed = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    names = parsed.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in rows(batch):
                yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    return df.mapInArrow(run, parsed)


def whole_row(docs: DataFrame) -> Column:
    """All columns as one struct, so that none can clash with an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def unpacked(joined: DataFrame, names: list[str], row: str, new: dict[str, Column]) -> DataFrame:
    """The columns of a packed row again; ``new`` columns replace those of the same name or follow."""
    old = [new.get(n, F.col(row)[n]).alias(n) for n in names]
    return joined.select(*old, *[c.alias(n) for n, c in new.items() if n not in names])


def digest16(text: Column) -> Column:
    """MD5 as 16 bytes."""
    return F.unhex(F.md5(text))


def dealt_blocks(rows: DataFrame, size: Column, by: tuple[str, ...], most: int) -> tuple[DataFrame, list[int]]:
    """(rows with a ``block``, the blocks that have rows): the sizes of a block add up to ``most`` at most, or it has one row.

    Blocks are dealt by a hash of the columns ``by``, over twice as many blocks until every one is small enough;
    rows that are equal in ``by`` stay together.
    """
    sized = rows.select("*", size.cast("double").alias("_size"))
    n = max(1, -int(-(sized.agg(F.sum("_size")).first()[0] or 0) // most))
    while True:
        dealt = sized.withColumn("block", F.pmod(F.xxhash64(*by), F.lit(n)))
        sums = dealt.groupBy("block").agg(F.sum("_size").alias("s"), F.count(F.lit(1)).alias("c"))
        if sums.where((F.col("s") > most) & (F.col("c") > 1)).isEmpty():
            return dealt.drop("_size"), sorted(r["block"] for r in sums.select("block").collect())
        n *= 2
