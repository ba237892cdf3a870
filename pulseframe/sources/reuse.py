"""Derived tables under the fingerprint of what they derive from."""

from __future__ import annotations

import hashlib
import logging
import os
import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import Any, BinaryIO

import pandas as pd
import pyarrow.fs
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.sources.staging import stage
from pulseframe.sources.tables import write_tables

WEEK = 7 * 24 * 3600
#: A builder that hasn't published after so long counts as dead.
LEASE = 6 * 3600
#: Published versions that stay, so readers of the one before aren't cut off.
KEPT = 2
#: Files over this are hashed in chunks as they are read; smaller ones are rows.
WHOLE = 100_000_000
CHUNK = 1 << 22
#: Parts of a digest that are added up, and hexadecimal digits of each: sums of any number of files are exact in a decimal.
PARTS, DIGITS = 4, 15


def _open(path: str) -> BinaryIO:
    if path.startswith("file:"):
        return open("/" + path.removeprefix("file:").lstrip("/"), "rb")
    system, inside = pyarrow.fs.FileSystem.from_uri(path)
    return system.open_input_stream(inside)


def file_digests(spark: SparkSession, folder: str, suffix: str = ".parquet", which: Column | None = None) -> DataFrame:
    """path, name and SHA-256 of the bytes of each file of a folder, hashed where it is read; ``which`` picks files by length and time of change."""

    def streamed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            digests = []
            for path in b["path"]:
                digest = hashlib.sha256()
                with _open(path) as f:
                    while chunk := f.read(CHUNK):
                        digest.update(chunk)
                digests.append(digest.hexdigest())
            yield pd.DataFrame({"path": b["path"], "name": b["name"], "digest": digests})

    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder)
    files = files if which is None else files.where(which)
    name = F.element_at(F.split("path", "/"), -1)
    large = files.where(F.col("length") > WHOLE).select("path", name.alias("name")).mapInPandas(streamed, "path string, name string, digest string")
    return files.where(F.col("length") <= WHOLE).select("path", name.alias("name"), F.sha2("content", 256).alias("digest")).unionByName(large)


def remembered_digests(spark: SparkSession, folder: str, store: str, suffix: str = ".parquet") -> DataFrame:
    """name and digest of each file of a folder; only files that ``store`` doesn't know are read.

    ``store`` is a Parquet table of earlier digests by path, length and time of change, to
    which those of new and changed files are appended; it is made if need be. Files are
    listed without their bytes; the scan for new ones skips, by time of change, all files
    outside the span in which they changed.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder).select("path", "modificationTime", "length")
    same = ["path", "modificationTime", "length"]
    schema = "path string, modificationTime timestamp, length long, digest string"

    def known() -> DataFrame:
        try:
            return spark.read.schema(schema).parquet(store).dropDuplicates(same)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    new = stage(files.join(known(), same, "left_anti"), "new-files")
    span = new.agg(F.min("modificationTime").alias("first"), F.max("modificationTime").alias("last")).first()
    if span["first"] is not None:
        read = file_digests(spark, folder, suffix, F.col("modificationTime").between(F.lit(span["first"]), F.lit(span["last"])))
        new.join(read.drop("name"), "path").select(*same, "digest").write.mode("append").parquet(store)
    name = F.element_at(F.split("path", "/"), -1)
    return files.join(known(), same).select(name.alias("name"), "digest")


def fingerprint_of(parts: Sequence[object]) -> str:
    return hashlib.sha256(repr(list(parts)).encode()).hexdigest()


def set_digest(files: DataFrame) -> str:
    """One digest for files (name, digest) in any order: their number and the sums of four parts of each one's SHA-256.

    Spark adds them up, so no row a file comes to the driver.
    """
    one = F.sha2(F.concat_ws("\n", "digest", "name"), 256)
    parts = [F.conv(F.substring(one, 1 + DIGITS * k, DIGITS), 16, 10).cast("decimal(38,0)") for k in range(PARTS)]
    total = files.agg(F.count(F.lit(1)).alias("n"), *[F.sum(p).alias(f"s{k}") for k, p in enumerate(parts)]).first()
    return fingerprint_of([str(x) for x in total])


def fingerprint(spark: SparkSession, folder: str, settings: str, suffix: str = ".parquet", store: str | None = None) -> str:
    """Changes when a matching file's name or bytes change, or the settings do. ``folder`` may also be one file.

    With a ``store`` of digests only files that changed since are read; see ``remembered_digests``.
    """
    files = file_digests(spark, folder, suffix) if store is None else remembered_digests(spark, folder, store, suffix)
    return fingerprint_of([set_digest(files), settings])


class _Folder:
    """A folder of published versions in any file system that Spark writes to."""

    def __init__(self, spark: SparkSession, folder: str):
        self.path = folder.rstrip("/")
        self._jvm = spark._jvm
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str) -> Any:
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def named(self, start: str) -> list[str]:
        """Entries whose name starts so, in order."""
        if not self._fs.exists(self._path("")):
            return []
        return sorted(name for f in self._fs.listStatus(self._path("")) if (name := f.getPath().getName()).startswith(start))

    def changed(self, name: str) -> float:
        """When an entry last changed; now if it has gone meanwhile."""
        try:
            return self._fs.getFileStatus(self._path(name)).getModificationTime() / 1000
        except Py4JJavaError:
            return time.time()

    def claim(self, name: str) -> bool:
        """Make a file that nobody else has made; False if somebody has."""
        self._fs.mkdirs(self._path(""))
        if self._fs.getUri().getScheme() == "file":
            # Hadoop looks and then creates; the operating system does both at once
            try:
                os.close(os.open(self._path(name).toUri().getPath(), os.O_CREAT | os.O_EXCL))
            except FileExistsError:
                return False
            return True
        try:
            self._fs.create(self._path(name), False).close()
        except Py4JJavaError as e:
            if self._fs.exists(self._path(name)) or "AlreadyExists" in str(e.java_exception):
                return False
            raise
        return True

    def rename(self, name: str, to: str) -> bool:
        return bool(self._fs.rename(self._path(name), self._path(to)))

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)


@contextmanager
def _lease(folder: _Folder, longest: float, ready: Callable[[], str | None], wait: float) -> Iterator[str | None]:
    """Hold the folder's lease, or give what another builder has published meanwhile."""
    while (found := ready()) is None and not folder.claim("_lease"):
        if time.time() - folder.changed("_lease") > longest:
            # of all who see that it is old one can take it away
            stale = f"_stale-{uuid.uuid4().hex}"
            if folder.rename("_lease", stale):
                logging.getLogger(__name__).warning("took over the lease of %s", folder.path)
                folder.delete(stale)
        else:
            time.sleep(wait)
    if found is not None:
        yield found
        return
    try:
        # somebody may have published between the look and the lease
        yield ready()
    finally:
        folder.delete("_lease")


def published(spark: SparkSession, folder: str, most_age: float = WEEK) -> str | None:
    """The folder's latest version that is whole and at most so old."""
    place = _Folder(spark, folder)
    for name in reversed(place.named("version-")):
        if time.time() - place.changed(f"{name}/_PUBLISHED") <= most_age:
            return f"{place.path}/{name}"
    return None


def reuse_or_write(spark: SparkSession, folder: str, write: Callable[[str], None], most_age: float = WEEK, lease: float = LEASE, wait: float = 1.0) -> tuple[str, bool]:
    """The latest version in ``folder``, written unless one is there and at most a week old; and whether it was there.

    A version is written to a folder of its own attempt and renamed when it is whole, so
    nobody reads half of one, and a version that is being read is never written over: the
    one before the latest stays. One builder at a time holds a lease, which the store
    grants to the first who asks (as local file systems and HDFS do); others wait for what it publishes. A builder that fails
    gives the lease back and its attempt goes; a lease older than ``lease`` seconds is
    taken over. Renaming a folder has to be atomic, as in HDFS and local file systems.
    """
    place = _Folder(spark, folder)
    with _lease(place, lease, lambda: published(spark, folder, most_age), wait) as found:
        if found is not None:
            return found, True
        attempt = f"_attempt-{uuid.uuid4().hex}"
        try:
            write(f"{place.path}/{attempt}")
            place.claim(f"{attempt}/_PUBLISHED")
        except BaseException:
            place.delete(attempt)
            raise
        # names sort as the versions came, and no two builders ever choose the same
        last = place.named("version-")
        number = 1 + max([int(name.split("-")[1]) for name in last], default=0)
        version = f"version-{number:012d}-{uuid.uuid4().hex}"
        if not place.rename(attempt, version):
            place.delete(attempt)
            raise RuntimeError(f"{version} of {place.path} could not be published")
        for name in last[: max(0, len(last) + 1 - KEPT)]:
            place.delete(name)
        for name in place.named("_attempt-"):  # of builders that were killed
            if time.time() - place.changed(name) > lease:
                place.delete(name)
        return f"{place.path}/{version}", False


def build_or_reuse(spark: SparkSession, root: str, key: str, build: Callable[[], Mapping[str, DataFrame]], most_age: float = WEEK) -> tuple[str, bool]:
    """The folder of tables with this fingerprint, built unless it is there whole and at most a week old; and whether it was there."""
    return reuse_or_write(spark, f"{root.rstrip('/')}/{key}", lambda folder: write_tables(build(), folder), most_age)
