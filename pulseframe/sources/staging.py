"""Intermediate tables in the folder that driver and executors share.

Lineage is cut by writing Parquet, which outlives lost executors. The folder is the
session's ``spark.checkpoint.dir``; only where that is unset in a local session (tests,
trials) a temporary folder of this machine is used. Staged tables belong to the session:
those of a ``scratch`` block go when it ends, all others when the driver's JVM ends.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}
_scratch: list[list[str]] = []


class NoSharedFolderError(RuntimeError):
    """A cluster session names no folder that driver and executors share."""


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; in a local session without one, a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise NoSharedFolderError("set spark.checkpoint.dir to a folder that driver and executors share")
    if "folder" not in _local:
        _local["folder"] = "file://" + tempfile.mkdtemp(prefix="pulseframe-")
    return _local["folder"]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses; what is written there goes with the block or the session."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _scratch:
        _scratch[-1].append(path)
    _delete_on_exit(spark, path)
    return path


def session_folder(spark: SparkSession, name: str) -> str:
    """A folder by name that lives as long as the session's application."""
    path = f"{shared_folder(spark)}/{name}-{spark.sparkContext.applicationId}"
    _delete_on_exit(spark, path)
    return path


def stage(df: DataFrame, name: str, compression: str = "snappy", **options: object) -> DataFrame:
    """Write ``df`` to the shared folder, with the writer's ``options``, and read it back."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.options(compression=compression, **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables staged inside are deleted at the end, but for what the block stages with the function it is given."""
    _scratch.append([])

    def keep(df: DataFrame, name: str) -> DataFrame:
        mine = _scratch.pop()
        try:
            return stage(df, name)
        finally:
            _scratch.append(mine)

    try:
        yield keep
    finally:
        for path in _scratch.pop():
            _delete(spark, path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def discard(df: DataFrame) -> None:
    """Delete a staged table that nothing will read again."""
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        _delete(df.sparkSession, folder)


def release(spark: SparkSession) -> None:
    """Let Spark clean up the shuffles of finished steps: it does so once the driver's JVM has collected its garbage."""
    gc.collect()
    spark._jvm.System.gc()
