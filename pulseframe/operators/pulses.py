"""Sensor features from pulses."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import Union

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.naming import Feature, free_names, no_clash, q, vector_map
from pulseframe.operators.ordering import HOT, over_keys

#: Charges add up as decimals: double sums depend on the order.
CHARGE = "decimal(12,2)"


def select_series(pulses: DataFrame, key: str) -> DataFrame:
    return pulses.where(F.col("pulse_series") == key)


def exclude_sensors(pulses: DataFrame, bad: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Without the pulses of listed sensors; a sensor with a missing id part is never listed."""
    return pulses.join(bad.select(*columns).distinct(), list(columns), "left_anti")


def exclude_windows(pulses: DataFrame, windows: DataFrame, columns: Sequence[str], partial: bool = True, hot: int | None = HOT) -> DataFrame:
    """Without the pulses in a window start <= time < end of their event and sensor.

    Not ``partial``: without all pulses of such an event and sensor. A window with a missing
    id part excludes nothing, nor does one without start or end or that ends before it
    starts; a pulse without time is in no window.

    Pulses and the starts of windows are swept in order of time: a pulse is in a window if
    the latest end of all windows begun so far is after it. So each pulse and each window is
    looked at once, however many windows overlap, and a sensor of ``hot`` or more of both is
    swept in several tasks.
    """
    known = windows.where(reduce(and_, [q(c).isNotNull() for c in columns]))
    if not partial:
        keys = known.select(*[q(c).alias(f"_key{k}") for k, c in enumerate(columns)]).distinct()
        return pulses.join(keys, [q(c) == F.col(f"_key{k}") for k, c in enumerate(columns)], "left_anti")
    at, end, kind, latest = free_names(pulses, "_at", "_end", "_pulse", "_latest")
    known = known.where("start < end").select(*[q(c) for c in columns], F.col("start").alias(at), F.col("end").alias(end), F.lit(0).alias(kind))
    swept = pulses.withColumns({at: F.col("time"), kind: F.lit(1)}).unionByName(known, allowMissingColumns=True)
    swept = over_keys(swept, columns, [at, kind], {latest: ("max", q(end))}, hot=hot, name="swept-windows")
    return swept.where((q(kind) == 1) & (q(latest).isNull() | q(at).isNull() | (q(latest) <= q(at)))).select(*[q(c) for c in pulses.columns])


def shift_by_mean_time(pulses: DataFrame, event_columns: Sequence[str], origin: int = 0) -> DataFrame:
    """Times less the event's charge-weighted mean time, rounded; without charge they stay.

    A missing id part is a value like any other, as in composite keys, so events with one
    keep their pulses. Pulses without time or charge are left out. ``origin`` is subtracted
    before multiplying, so that the decimal product stays short.
    """
    known = pulses.where("time is not null and charge is not null")
    charge = F.col("charge").cast(CHARGE)
    ids = {c: f"_shift_{k}" for k, c in enumerate(event_columns)}
    mean = known.groupBy(*[q(c).alias(i) for c, i in ids.items()]).agg(F.sum(charge).alias("_q"), F.sum(charge * (F.col("time") - F.lit(origin)).cast("decimal(20,0)")).alias("_qt"))
    shift = F.when(F.col("_q") != 0, F.round(F.col("_qt").cast("double") / F.col("_q").cast("double")).cast("bigint") + F.lit(origin)).otherwise(F.lit(0))
    shifts = mean.select(*ids.values(), shift.alias("_shift"))
    same = [q(c).eqNullSafe(F.col(i)) for c, i in ids.items()]
    return known.join(shifts, same).withColumn("time", F.col("time") - F.col("_shift")).select(*[q(c) for c in pulses.columns])


def _charge() -> Column:
    return F.col("charge").cast(CHARGE)


def total_charge(feature: Feature) -> list[Column]:
    return [F.sum(_charge()).cast("double")]


def first_pulse(feature: Feature) -> list[Column]:
    return [F.min("time").cast("double")]


def time_spread(feature: Feature) -> list[Column]:
    return [(F.max("time") - F.min("time")).cast("double")]


def charge_until(feature: Feature) -> list[Column]:
    """Charge within each time of the sensor's first pulse."""
    times = next(iter(feature.kwargs.values()))
    return [F.coalesce(F.sum(F.when(F.col("time") - F.col("_first") <= t, _charge())), F.lit(0)).cast("double") for t in times]


def time_at_percentile(feature: Feature) -> list[Column]:
    """Earliest time by which each share of the charge has come."""
    shares = next(iter(feature.kwargs.values()))
    return [F.min(F.when(F.col("_running").cast("double") >= F.lit(float(p)) * F.col("_total").cast("double"), F.col("time"))).cast("double") for p in shares]


#: Gives a feature's aggregate columns, or is a ``Vectorised`` kind.
Builder = Union[Callable[[Feature], list[Column]], "Vectorised"]

#: Feature kinds by name; users add their own.
BUILDERS: dict[str, Callable[[Feature], list[Column]]] = {
    "TotalCharge": total_charge,
    "TFirstPulse": first_pulse,
    "ChargeUntilT": charge_until,
    "TSpread": time_spread,
    "TimeAtChargePercentile": time_at_percentile,
}


@dataclass(frozen=True)
class Vectorised:
    """A feature kind of one's own in NumPy, for sums that no built-in function gives.

    ``terms`` turns a batch of pulses, an array for each of ``columns``, into ``width`` whole
    numbers a pulse (pulses by width). They add up exactly beside the built-in aggregates, in the
    same grouping and before anything is exchanged, so a bright sensor is no task of its own.
    ``finish`` turns the sums of a batch of sensors (sensors by width, as Python integers)
    into the feature's columns (a list of numbers or None for each sensor).
    """

    columns: tuple[str, ...]
    width: int
    terms: Callable[..., np.ndarray]
    finish: Callable[[Feature, list[list[int]]], list[list[float | None]]]


def _terms(kind: Vectorised, feature: Feature) -> Column:
    @F.pandas_udf("array<bigint>")
    def terms(*columns: pd.Series) -> pd.Series:
        return pd.Series(list(np.asarray(kind.terms(feature, *[c.to_numpy() for c in columns]), dtype=np.int64).reshape(-1, kind.width)))

    return terms(*[q(c) for c in kind.columns])


def _finished(kind: Vectorised, feature: Feature, sums: Sequence[Column]) -> Column:
    @F.pandas_udf("array<double>")
    def finish(*columns: pd.Series) -> pd.Series:
        return pd.Series(kind.finish(feature, [[int(x) for x in row] for row in zip(*columns, strict=True)]))

    return finish(*sums)


def sensor_features(pulses: DataFrame, features: Sequence[Feature], keys: Sequence[str], builders: Mapping[str, Builder] | None = None, hot: int | None = HOT) -> DataFrame:
    """The configured features of every event and sensor, columns in map order.

    Pulses without time or charge are left out. First time, total and running charge
    (``_first``, ``_total``, ``_running``) come from windows over the same keys as the
    grouping, so one exchange serves all; without a feature that needs them there are none.
    A sensor of ``hot`` or more pulses of an event is summed up in several tasks. Builders
    give aggregate columns or are ``Vectorised``; an unknown kind raises.
    """
    known = {**BUILDERS, **(builders or {})}
    wrong = [f.kind for f in features if f.kind not in known]
    if wrong:
        raise KeyError(f"unknown features: {wrong}")
    rows = pulses.where("time is not null and charge is not null")
    kinds = {f.kind for f in features if not isinstance(known[f.kind], Vectorised)}
    if kinds - {"TotalCharge", "TFirstPulse", "TSpread"}:
        rows = over_keys(rows, keys, ["time", "_ord"], {"_running": ("sum", _charge())}, {"_first": ("min", F.col("time")), "_total": ("sum", _charge())}, hot, "running-charge")
    aggregates, results = [], []
    for k, f in enumerate(features):
        kind, names = known[f.kind], vector_map([f])
        if isinstance(kind, Vectorised):
            rows = rows.withColumn(f"_terms{k}", _terms(kind, f))
            sums = [F.sum(F.col(f"_terms{k}")[i].cast("decimal(38,0)")).alias(f"_sum{k}_{i}") for i in range(kind.width)]
            aggregates += sums
            done = _finished(kind, f, [F.col(f"_sum{k}_{i}") for i in range(kind.width)])
            results += [done[i].alias(name) for i, name in enumerate(names)]
            continue
        columns = kind(f)
        if len(columns) != len(names):
            raise ValueError("a builder gave another number of columns than the feature map")
        aggregates += [c.alias(n) for c, n in zip(columns, names, strict=True)]
        results += [q(n) for n in names]
    vector_map(features)  # names that repeat are an error
    return rows.groupBy(*keys).agg(*aggregates).select(*[q(k) for k in keys], *results)


def attach_labels(events: DataFrame, labels: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Precomputed labels of each event, null where there are none.

    Events with several label rows come once for each; a label named like a column of
    ``events`` is an error. A missing id part matches nothing.
    """
    no_clash(events, labels, columns)
    return events.join(labels, list(columns), "left")


def extract(pulses: DataFrame, features: Sequence[Feature], event_columns: Sequence[str], sensor_columns: Sequence[str], series: str | None = None, streams: Sequence[str] | None = None, bad: DataFrame | None = None, windows: DataFrame | None = None, partial: bool = True, modifiers: Sequence[Callable[[DataFrame], DataFrame]] = (), builders: Mapping[str, Builder] | None = None, hot: int = HOT) -> DataFrame:
    """Pulses to features: select, exclude, modify, summarise, each step if it is configured.

    No step adds pulses, so unless all pulses and windows together come to ``hot`` no key can,
    and none is looked for.
    """
    keys = [*event_columns, *sensor_columns]
    split = hot if pulses.count() + (windows.count() if windows is not None else 0) >= hot else None
    if streams is not None:
        pulses = pulses.where(F.col("SubEventStream").isin(*streams))
    if series is not None:
        pulses = select_series(pulses, series)
    if bad is not None:
        pulses = exclude_sensors(pulses, bad, sensor_columns)
    if windows is not None:
        pulses = exclude_windows(pulses, windows, keys, partial, split)
    for modify in modifiers:
        pulses = modify(pulses)
    return sensor_features(pulses, features, keys, builders, split)
