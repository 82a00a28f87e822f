"""Session settings, the shared scratch folder, and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution does the physical work that must follow the data: it
# coalesces small shuffle partitions, splits skewed join partitions and turns a
# sort-merge join into a broadcast join when the measured side is small.
SESSION_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_local_dirs: dict[str, str] = {}


def build_session(
    app_name: str = "tidemark", master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    """Return a session with the library's settings; ``settings`` win over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster a
    missing setting is an error, since machine-local paths are lost with the
    machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; name a folder shared by all executors")
    if sc.applicationId not in _local_dirs:
        _local_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_dirs[sc.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(shared_dir(spark), "tidemark", f"{label}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write a frame as parquet in the shared folder and read it from there.

    For frames that several later steps read: they are derived once, each reader
    takes only its columns, and a lost executor costs no recomputation.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _located(spark: SparkSession, path: str) -> tuple:
    """A path and the file system it lies in."""
    located = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return located, located.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, path: str) -> bool:
    located, files = _located(spark, path)
    return files.exists(located)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system it lies; none is no error."""
    located, files = _located(spark, path)
    files.delete(located, True)


def discard(*frames: DataFrame) -> None:
    """Delete the folders of frames that ``materialize`` wrote and nothing reads any more."""
    for df in frames:
        sc = df.sparkSession.sparkContext
        own = os.path.join(shared_dir(df.sparkSession), "tidemark")
        path = sc._jvm.org.apache.hadoop.fs.Path
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            if path(folder).getParent().toUri().getPath() == path(own).toUri().getPath():
                remove_folder(df.sparkSession, folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint that keeps partitions and row order, unlike ``materialize``."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
