"""Declared sources: where a table lies, its schema, and how fresh it must be."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Freshness:
    loaded_at: str
    warn_after_hours: int = 24
    error_after_hours: int = 48


@dataclass(frozen=True)
class Source:
    name: str
    path: str
    format: str = "parquet"
    schema: StructType | str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    freshness: Freshness | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.format(self.format).options(**self.options)
        if self.schema is not None:
            reader = reader.schema(self.schema)
        return reader.load(self.path)


class SourceRegistry:
    """Named sources of one schema."""

    def __init__(self, sources: Iterable[Source] = ()):
        self._sources: dict[str, Source] = {}
        for source in sources:
            self.add(source)

    @classmethod
    def from_folder(cls, folder: str, names: Iterable[str], suffix: str = ".parquet") -> SourceRegistry:
        return cls(Source(name, os.path.join(folder, name + suffix)) for name in names)

    def add(self, source: Source) -> None:
        if source.name in self._sources:
            raise ValueError(f"source {source.name!r} is declared twice")
        self._sources[source.name] = source

    def names(self) -> list[str]:
        return list(self._sources)

    def source(self, name: str) -> Source:
        if name not in self._sources:
            raise ValueError(f"unknown source {name!r}; declared: {self.names()}")
        return self._sources[name]

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return self.source(name).read(spark)

    def create_views(self, spark: SparkSession) -> None:
        for name in self.names():
            self.read(spark, name).createOrReplaceTempView(name)


def select_targets(targets: Mapping[str, Callable], wanted: str = "all") -> dict[str, Callable]:
    """``all`` or one named target; an unknown name is an error."""
    if wanted == "all":
        return dict(targets)
    if wanted not in targets:
        raise ValueError(f"unknown target {wanted!r}; known: {list(targets)}")
    return {wanted: targets[wanted]}


def read_seed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Static CSV mapping with a declared schema; load seeds before the models."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def read_recent(spark: SparkSession, path: str, since: str, format: str = "parquet", schema=None) -> DataFrame:
    """Only files changed after ``since``; older ones are never opened."""
    reader = spark.read.format(format).option("modifiedAfter", since)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def jdbc_options(
    url: str,
    table: str,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    fetch_size: int = 1000,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a parallel range scan of an operational database.

    Rows outside lower..upper are still read, by the first and last partition;
    the bounds only set the stride. ``fetch_size`` bounds the rows in flight.
    """
    if partitions < 1 or upper <= lower:
        raise ValueError("need upper > lower and at least one partition")
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": partition_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
        **(properties or {}),
    }


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()
