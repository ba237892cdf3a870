"""Sensor positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.keys import SENSOR_COLUMNS, unpack_ids
from pulseframe.functions.naming import inverted, no_clash, q


def with_sensor_ids(features: DataFrame) -> DataFrame:
    """``features`` with string, om and pmt from dom_id."""
    ids = unpack_ids(F.col("dom_id"))
    return features.withColumns({c: ids[k] for k, c in enumerate(SENSOR_COLUMNS)})


def with_coordinates(features: DataFrame, geometry: DataFrame) -> DataFrame:
    """Each sensor row with x, y, z, null where the geometry lacks the sensor.

    The geometry joins as Spark finds best: broadcast while under the session's threshold.
    A sensor that the geometry lists several times comes once for each; columns x, y or z
    in ``features`` are an error.
    """
    no_clash(features, geometry.select("x", "y", "z"), ())
    return features.join(geometry.select(*[q(c).cast("int").alias(c) for c in SENSOR_COLUMNS], "x", "y", "z"), list(SENSOR_COLUMNS), "left")


def sensors_without_geometry(features: DataFrame, geometry: DataFrame) -> DataFrame:
    """The distinct sensors that the geometry lacks."""
    return features.select(*SENSOR_COLUMNS).distinct().join(geometry, list(SENSOR_COLUMNS), "left_anti")


def feature_profile(features: DataFrame, geometry: DataFrame, feature: str, names: Sequence[str]) -> DataFrame:
    """One feature of every sensor with its position, for all events: event_id, dom_id, x, y, z, value."""
    if feature not in inverted(names):
        raise KeyError(feature)
    return with_coordinates(with_sensor_ids(features), geometry).select("event_id", "dom_id", "x", "y", "z", q(feature).alias("value"))
