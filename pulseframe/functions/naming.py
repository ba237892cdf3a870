"""Feature names: from configuration to ordered column names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def q(name: str) -> Column:
    """A column by its literal name; feature names contain dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores after it as set it apart from all columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def no_clash(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> None:
    """Joined tables may share the key columns only."""
    both = (set(left.columns) & set(right.columns)) - set(keys)
    if both:
        raise ValueError(f"both tables have the columns {sorted(both)}")


@dataclass(frozen=True)
class Feature:
    """A configured feature: the columns it gives by default, and keyword lists that multiply them."""

    kind: str
    base: tuple[str, ...]
    kwargs: Mapping[str, Sequence[Any]] = field(default_factory=dict)


def vector_map(features: Sequence[Feature]) -> list[str]:
    """Names by position, in the features' order.

    Without keywords a feature gives its base names; else each item of its first keyword
    gives every base name with the item attached, and an empty list gives none. A name
    that comes twice is an error, since the map has to be invertible.
    """
    names = []
    for feature in features:
        if not feature.kwargs:
            names += feature.base
            continue
        items = next(iter(feature.kwargs.values()))
        names += [f"{base}_{item}" for item in items for base in feature.base]
    if len(set(names)) < len(names):
        raise ValueError(f"feature names repeat: {sorted({n for n in names if names.count(n) > 1})}")
    return names


def inverted(names: Sequence[str]) -> dict[str, int]:
    return {name: k for k, name in enumerate(names)}


def vector_map_table(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """The map as a lookup table: vector_index, feature."""
    return spark.createDataFrame([(k, n) for k, n in enumerate(names)], "vector_index int, feature string")
