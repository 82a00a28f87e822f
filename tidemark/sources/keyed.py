"""A table with a unique key that finds out cheaply which keys it holds already.

Rows are dealt to folders by a hash of the key. Each folder has a Bloom filter: words of 64 bits, of which a key
sets four bits in one word (a blocked filter), held as rows of (folder, word, bits) that a load appends to. A batch
meets the filter in one join; keys whose bits are not all set are new, and only the folders of the others are
opened. A filter may say yes to a key that is not there, never no to one that is, so results do not depend on it;
a table that has outgrown its filters is still right, but opens more folders.

The bits of a load are written before its rows: a run that fails in between leaves bits too many, and the next one
opens a folder in vain. There is one writer at a time. A null key is a key like others.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import discard, folder_exists, materialize
from tidemark.sources.sinks import absent, first_per_key, path_exists

#: Folders of a table, keys of a folder that its filter is made for, and bits of the filter for each of them.
FOLDERS, FOLDER_KEYS, KEY_BITS = 64, 100_000, 16
#: Columns of the layout; their names must not be a row's.
_FOLDER, _WORD, _MASK = "key_folder", "key_word", "key_mask"


class Appended(NamedTuple):
    """Rows appended, and the folders and files that were opened to find out which."""

    rows: int
    folders: int
    files: int


class KeyedTable:
    """The table at ``path``, unique by ``key``. Its layout is fixed when it is first written."""

    def __init__(self, spark: SparkSession, path: str, key: str, folders: int = FOLDERS, folder_keys: int = FOLDER_KEYS) -> None:
        self.spark, self.path, self.key = spark, path, key
        self._layout, self._filter = (os.path.join(path, "_keys", n) for n in ("layout", "filter"))
        self.folders, self.words = folders, max(1, folder_keys * KEY_BITS // 64)
        if path_exists(spark, self._layout):
            self.folders, self.words = spark.read.parquet(self._layout).select("folders", "words").first()

    def read(self, schema: StructType) -> DataFrame:
        """The rows, without the column of their folders."""
        if path_exists(self.spark, self.path):
            return self.spark.read.schema(schema).parquet(self.path).select(*schema.names)
        return self.spark.createDataFrame([], schema)

    def append(self, batch: DataFrame, order_by: Sequence[str] | None = None) -> Appended:
        """Append rows whose key the table lacks, of each key the lowest by ``order_by`` (all columns if None)."""
        once = materialize(self._dealt(first_per_key(batch, self.key, order_by or batch.columns)), "keyed-batch")
        tested = self._tested(once)
        folders = sorted(r[0] for r in tested.where("_maybe").select(_FOLDER).distinct().collect())  # FOLDERS at most
        held, files = self._keys_in(folders, batch.schema)
        new = tested
        if held is not None:
            new = tested.where("not _maybe").unionByName(absent(tested.where("_maybe"), held, self.key))
        new = materialize(new.select(*once.columns), "keyed-new")
        n = new.count()
        if n:
            if not path_exists(self.spark, self._layout):
                layout = self.spark.createDataFrame([(self.folders, self.words)], "folders int, words int")
                layout.coalesce(1).write.parquet(self._layout)
            bits = new.groupBy(_FOLDER, _WORD).agg(F.bit_or(_MASK).alias(_MASK))
            bits.write.mode("append").parquet(self._filter)
            new.drop(_WORD, _MASK).repartition(_FOLDER).write.mode("append").partitionBy(_FOLDER).parquet(self.path)
        discard(once, new)
        return Appended(n, len(folders), files)

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """The rows with folder, word and mask of their key."""
        second = F.xxhash64(F.lit("word"), F.col(self.key))
        masks = [F.expr(f"shiftleft(1L, cast(shiftright(_second, {6 * i}) & 63 as int))") for i in range(4)]
        return rows.withColumns(
            {_FOLDER: F.pmod(F.xxhash64(self.key), F.lit(self.folders)).cast("int"), "_second": second}
        ).withColumns(
            {
                _WORD: F.pmod(F.shiftrightunsigned("_second", 24), F.lit(self.words)).cast("int"),
                _MASK: masks[0].bitwiseOR(masks[1]).bitwiseOR(masks[2]).bitwiseOR(masks[3]),
            }
        ).drop("_second")

    def _tested(self, rows: DataFrame) -> DataFrame:
        """The rows with ``_maybe``: whether all bits of their key are set."""
        if not path_exists(self.spark, self._filter):
            return rows.withColumn("_maybe", F.lit(False))
        words = self.spark.read.parquet(self._filter).groupBy(_FOLDER, _WORD).agg(F.bit_or(_MASK).alias("_bits"))
        whole = F.col("_bits").bitwiseAND(F.col(_MASK)) == F.col(_MASK)
        joined = rows.join(words, [_FOLDER, _WORD], "left")
        return joined.select(*rows.columns, F.coalesce(whole, F.lit(False)).alias("_maybe"))

    def _keys_in(self, folders: list[int], schema: StructType) -> tuple[DataFrame | None, int]:
        """(keys of the folders that hold rows, number of their files)."""
        paths = [os.path.join(self.path, f"{_FOLDER}={f}") for f in folders]
        paths = [p for p in paths if folder_exists(self.spark, p)]
        if not paths:
            return None, 0
        rows = self.spark.read.schema(schema).parquet(*paths).select(self.key)
        return rows, len(rows.inputFiles())
