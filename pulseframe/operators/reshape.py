"""Long sensor readings to wide features, and truth with event keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.keys import EVENT_COLUMNS, SENSOR_COLUMNS, TypedKey, with_event_key
from pulseframe.functions.naming import q


def _first_readings(rows: DataFrame, keys: Sequence[str], positions: int) -> DataFrame:
    used = rows.where(F.col("item").isNotNull())
    return used.groupBy(*keys).pivot("vector_index", list(range(positions))).agg(F.min_by("item", "_ord"))


def pivot_first(features: DataFrame, positions: int) -> DataFrame:
    """One row for each event and sensor, a column for each position, named 0, 1, ...

    A cell is the first reading, by ``_ord``, that isn't missing; ``_ord`` should tell a
    cell's readings apart, as ``read_table`` makes it, for of equal ones any may be taken.
    Sensors without any reading disappear; a position without any stays as nulls. Positions
    are given, so no job looks for them.
    """
    return _first_readings(features, ["event_id", "dom_id"], positions)


def pivot_typed(features: DataFrame, positions: int, event: TypedKey, sensor: TypedKey, by_event: bool = False) -> DataFrame:
    """``pivot_first`` over typed keys: their parts, then the positions; no key text is made or exchanged.

    ``by_event`` deals readings out by event, so that an event's sensors can be put
    together where they are; else what a task has of a cell is one reading before it moves.
    """
    rows = features.select(*event.parts(), *sensor.parts(), "vector_index", "item", "_ord")
    rows = rows.where(F.col("item").isNotNull()).repartition(*event.names) if by_event else rows
    return _first_readings(rows, [*event.names, *sensor.names], positions)


def name_columns(wide: DataFrame, names: Sequence[str]) -> DataFrame:
    """Positions renamed by the feature map."""
    return wide.select("event_id", "dom_id", *[q(str(k)).alias(n) for k, n in enumerate(names)])


def reshape_features(features: DataFrame, names: Sequence[str], event_columns: Sequence[str] = EVENT_COLUMNS, sensor_columns: Sequence[str] = SENSOR_COLUMNS) -> DataFrame:
    """Long readings (ids, vector_index, item, _ord) to wide named features under string keys, made once the features are."""
    event, sensor = TypedKey.of(features, event_columns, "_e"), TypedKey.of(features, sensor_columns, "_s")
    wide = pivot_typed(features, len(names), event, sensor)
    return name_columns(wide.select(event.text().alias("event_id"), sensor.text().alias("dom_id"), *[q(str(k)) for k in range(len(names))]), names)


def reshape_truth(truth: DataFrame, event_columns: Sequence[str] = EVENT_COLUMNS) -> DataFrame:
    """Truth with event_id for its id columns; every other column stays."""
    return with_event_key(truth, event_columns)


def long_form(wide: DataFrame, names: Sequence[str]) -> DataFrame:
    """Wide features as event_id, dom_id, vector_index, item; missing items stay as nulls."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("vector_index"), q(n).cast("double").alias("item")) for k, n in enumerate(names)]))
    return wide.select("event_id", "dom_id", pairs.alias("p")).select("event_id", "dom_id", "p.vector_index", "p.item")
