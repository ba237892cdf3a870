"""Composite keys of events and sensors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.naming import q

EVENT_COLUMNS = ("Run", "Event", "SubEvent", "SubEventStream")
SENSOR_COLUMNS = ("string", "om", "pmt")
_MISSING = -(2**63)
_PLAIN = ("tinyint", "smallint", "int", "bigint", "string")


def composite_key(columns: Sequence[str]) -> Column:
    """``name=value`` pairs joined by ``|`` in the given order; a missing value reads ``nan``."""
    return F.concat_ws("|", *[F.concat(F.lit(f"{c}="), F.coalesce(q(c).cast("string"), F.lit("nan"))) for c in columns])


def checked_ids(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The types of id columns: only integers and strings print alike everywhere, so others are an error."""
    kinds = dict(df.dtypes)
    wrong = [c for c in columns if kinds.get(c) not in _PLAIN]
    if wrong:
        raise TypeError(f"id columns must be integers or strings: {wrong}")
    return {c: kinds[c] for c in columns}


@dataclass(frozen=True)
class TypedKey:
    """A composite key as typed parts: what is grouped, joined and exchanged; the text is made last.

    Parts are named by a prefix and their number and are never null, so that equal keys have
    equal parts: a missing integer is -2^63, which no id may be, and a missing text ``nan``,
    as in the key's text. Integers of any width are alike, as they print alike.
    """

    columns: tuple[str, ...]
    kinds: tuple[str, ...]
    prefix: str

    @staticmethod
    def of(df: DataFrame, columns: Sequence[str], prefix: str) -> TypedKey:
        return TypedKey(tuple(columns), tuple(checked_ids(df, columns).values()), prefix)

    @property
    def names(self) -> list[str]:
        return [f"{self.prefix}{k}" for k in range(len(self.columns))]

    def parts(self) -> list[Column]:
        """The parts from the id columns."""
        missing = lambda c, kind: F.coalesce(q(c), F.lit("nan")) if kind == "string" else F.coalesce(q(c).cast("bigint"), F.lit(_MISSING))
        return [missing(c, kind).alias(name) for c, kind, name in zip(self.columns, self.kinds, self.names, strict=True)]

    def text(self, parts: Sequence[Column] | None = None) -> Column:
        """The key's text from its parts."""
        values = parts or [F.col(n) for n in self.names]
        shown = [v if kind == "string" else F.when(v == _MISSING, F.lit("nan")).otherwise(v.cast("string")) for v, kind in zip(values, self.kinds, strict=True)]
        return F.concat_ws("|", *[F.concat(F.lit(f"{c}="), v) for c, v in zip(self.columns, shown, strict=True)])


def with_key(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Replace id columns by their composite key, which comes first."""
    checked_ids(df, columns)
    return df.select(composite_key(columns).alias(name), *[q(c) for c in df.columns if c not in columns and c != name])


def with_event_key(df: DataFrame, columns: Sequence[str] = EVENT_COLUMNS) -> DataFrame:
    return with_key(df, columns, "event_id")


def with_sensor_key(df: DataFrame, columns: Sequence[str] = SENSOR_COLUMNS) -> DataFrame:
    return with_key(df, columns, "dom_id")


def unpack_ids(key: Column) -> Column:
    """The values of a key as array<int>; text that isn't a number raises."""
    return F.transform(F.split(key, "[|]"), lambda part: F.split(part, "=")[1].cast("int"))


def unpack_map(key: Column) -> Column:
    """A key as map from name to text."""
    return F.str_to_map(key, F.lit("\\|"), F.lit("="))


def event_number(key: Column, anchored: bool = True) -> Column:
    """The number after ``Event=``; null if there is none.

    Anchored, only a part named ``Event`` counts; otherwise the first ``Event=`` in the
    text, even at the end of ``SubEvent=``.
    """
    pattern = r"(?:^|\|)Event=(\d+)" if anchored else r"Event=(\d+)"
    return F.regexp_extract(key, pattern, 1).try_cast("bigint")
