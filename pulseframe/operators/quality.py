"""Reports on what would otherwise go missing in silence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.keys import event_number


def duplicate_truth(truth: DataFrame) -> DataFrame:
    """Events with several truth rows."""
    return truth.groupBy("event_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def bad_event_ids(truth: DataFrame, anchored: bool = True) -> DataFrame:
    """Truth rows without an event number: in no split."""
    return truth.where(event_number(F.col("event_id"), anchored).isNull())


def unmapped_positions(features: DataFrame, positions: int) -> DataFrame:
    """Readings at positions that the feature map doesn't name."""
    return features.groupBy("vector_index").agg(F.count(F.lit(1)).alias("n")).where(F.col("vector_index").isNull() | (F.col("vector_index") < 0) | (F.col("vector_index") >= positions))
