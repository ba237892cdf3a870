"""Tables in and out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseframe.functions.naming import free_names, q
from pulseframe.operators.ordering import ranked
from pulseframe.sources.staging import stage


#: Bytes of a row group of features: a lookup reads a few of these.
ROW_GROUP = 16 << 20
#: A file as Spark names it: the task's number in 5 digits and the number of the task's file in 3, or more where those don't do.
_SPARKS = r"^(.*/part-)([0-9]{5,})(-[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}[-.]c)([0-9]{3,})([^/]*)$"


class GeometryMissingError(ValueError):
    """There are no sensor positions."""


def concatenate(pieces: Sequence[DataFrame]) -> DataFrame:
    """All rows of tables with the same columns; each piece keeps its order within ``_ord``, pieces by number.

    ``_ord`` becomes a struct of the piece's number and its own ``_ord``; columns go by name
    and one that a piece lacks is null there. No pieces are an error.
    """
    if not pieces:
        raise ValueError("nothing to concatenate")
    numbered = [p.withColumn("_ord", F.struct(F.lit(k).alias("piece"), F.col("_ord").alias("at"))) for k, p in enumerate(pieces)]
    out = numbered[0]
    for piece in numbered[1:]:
        out = out.unionByName(piece, allowMissingColumns=True)
    return out


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing is null from here on: NaN in any float column becomes null."""
    kinds = dict(df.dtypes)
    return df.select(*[F.nanvl(q(c), F.lit(None)).alias(c) if kinds[c] in ("double", "float") else q(c) for c in df.columns])


def _in_order(file: Column) -> Column:
    """What sorts as files go: the path, but a number of Spark's with more digits than usual comes after all that have fewer."""
    part = lambda k: F.regexp_extract(file, _SPARKS, k)
    number = lambda k, digits: F.concat(F.repeat(F.lit("~"), F.length(part(k)) - digits), part(k))
    return F.when(file.rlike(_SPARKS), F.concat(part(1), number(2, 5), part(3), number(4, 3), part(5))).otherwise(file)


def _file_ranks(spark: SparkSession, source: str, suffix: str | None, path: str, rank: str) -> DataFrame:
    """The files of a folder, by a hash of their path, with their rank by path; they are listed and not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix or ''}").load(source)
    ranks = ranked(files.select(F.lit(0).alias("all"), F.col("_metadata.file_path").alias("file")), "all", [_in_order(F.col("file")), F.col("file")], rank, "file-order")
    ranks = stage(ranks.select(F.xxhash64("file").alias(path), rank), "file-ranks")
    n, distinct, last = ranks.agg(F.count(F.lit(1)), F.countDistinct(path), F.max(rank)).first()
    if n and (distinct < n or last >= 1 << 24):
        raise ValueError(f"{source}: {n} files can't be told apart by hash, or are more than 2^24")
    return ranks


def read_table(spark: SparkSession, source: str, format: str = "parquet", schema: T.StructType | str | None = None, order: str | None = None, suffix: str | None = None) -> DataFrame:
    """A whole table by path (parquet, csv, json, orc) or, with format ``table``, by name.

    Of a folder only its own files are read, those with ``suffix`` if one is given. Input
    order, which later steps need, becomes ``_ord``: the column ``order`` as a number, or
    else what sorts as the rows stand, files by path (Spark's own by their numbers, so a job's
    files go as it wrote them), then place in the file. Files are ranked from their listing, and 24 bits of rank and 40 of place make a number; formats
    without places of rows add one for the row to it. A table by name has no files to go
    by, so its rows count by partition. NaN becomes null.
    """
    if format == "table":
        df = spark.table(source)
    else:
        reader = spark.read.format(format)
        reader = reader.schema(schema) if schema is not None else reader
        reader = reader.option("header", True) if format == "csv" else reader
        df = (reader.option("pathGlobFilter", f"*{suffix}") if suffix else reader).load(source)
    if order is not None:
        return nan_to_null(df).withColumn("_ord", q(order).cast("bigint"))
    if format == "table":
        return nan_to_null(df).withColumn("_ord", F.monotonically_increasing_id())
    path, rank, place, row = free_names(df, "_path", "_rank", "_place", "_row")
    ranks = _file_ranks(spark, source, suffix, path, rank)
    # a task reads a piece of a file from front to back, so its own numbers keep the rows' order
    at = F.col("_metadata.row_index") if format == "parquet" else F.col("_metadata.file_block_start")
    rows = nan_to_null(df).select("*", F.xxhash64("_metadata.file_path").alias(path), at.alias(place), F.monotonically_increasing_id().alias(row))
    number = F.shiftleft(F.col(rank), 40) + F.col(place)
    order_ = number if format == "parquet" else F.struct(number.alias("place"), F.col(row).alias("row"))
    # two numbers a file, of at most 2^24 files
    return rows.join(F.broadcast(ranks), path).select(*[q(c) for c in df.columns], order_.alias("_ord"))


def select_streams(df: DataFrame, streams: Sequence[str], column: str = "SubEventStream") -> DataFrame:
    """Only rows of the listed sub-event streams."""
    return df.where(q(column).isin(*streams))


def write_tables(tables: Mapping[str, DataFrame], folder: str, group_bytes: int = ROW_GROUP) -> None:
    """Each table as Parquet under its name.

    Features are clustered by event for lookups of some events: in row groups of about
    ``group_bytes`` whose statistics are narrow, each with a Bloom filter of its event ids.
    """
    for name, df in tables.items():
        writer = df.write
        if {"event_id", "dom_id"} <= set(df.columns):
            writer = df.repartitionByRange("event_id").sortWithinPartitions("event_id", "dom_id").write
            writer = writer.options(**{"parquet.bloom.filter.enabled#event_id": True, "parquet.bloom.filter.adaptive.enabled": True, "parquet.block.size": group_bytes, "parquet.page.size": min(group_bytes, 1 << 20)})
        writer.mode("overwrite").parquet(f"{folder}/{name}")


def read_features(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Keys and the mapped features in map order; a feature that the files lack is null."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("event_id", "dom_id")] + [T.StructField(n, T.DoubleType()) for n in names])
    return spark.read.schema(schema).parquet(path)


def read_geometry(spark: SparkSession, path: str) -> DataFrame:
    """Sensor positions (string, om, pmt, x, y, z); an empty table is an error."""
    geometry = spark.read.parquet(path)
    if geometry.isEmpty():
        raise GeometryMissingError(f"no geometry in {path}")
    return geometry
