"""Telling rows apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.llm.text import free_names
from pulseframe.sources.staging import stage


def numbered_rows(docs: DataFrame, name: str, stored: bool = False) -> tuple[DataFrame, str]:
    """``docs`` with a number (long) for each row that stays the same however often it is read, and the number's column.

    If ``docs`` is a ``stored`` Parquet table, read as it is or filtered, a row goes by the
    number of its file and its place there, and nothing is copied. Otherwise the rows are
    numbered as they come and staged with their numbers.
    """
    row, path, number = free_names(docs, "_row", "_path", "_file")
    if not stored:
        return stage(docs.withColumn(row, F.monotonically_increasing_id()), name), row
    # one row for each file
    files = docs.select(F.col("_metadata.file_path").alias(path)).distinct().withColumn(number, F.row_number().over(Window.orderBy(path)))
    files = stage(files, "files")
    placed = docs.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(row)).join(files, path)
    return placed.withColumn(row, F.shiftleft(F.col(number).cast("long"), 40) + F.col(row)).drop(path, number), row
