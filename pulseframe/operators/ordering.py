"""Global running totals over a total order, without a single-task sort."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.functions.naming import free_names, q
from pulseframe.sources.staging import shuffle_partitions, stage

#: Rows from which a key is split over tasks.
HOT = 1_000_000


def prefix_sums(rows: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """Add ``position`` (0-based rank) and ``before`` (sum of ``value`` over all earlier rows).

    The rows are laid out by range of ``order`` and staged with their range number, so
    both passes see the same layout. Each range is totalled on its own; the totals (one
    row a range) become offsets, and the rest is a window within each range, a task each. ``order``
    should end in a unique column, so that no range can outgrow a task; rows equal in all
    of it are ordered arbitrarily, which their own columns can't show. ``value`` must not
    be null. ``rows`` is evaluated twice (ranges are sampled first), so a costly one should
    be staged; the result reads only the laid-out table.
    """
    laid = stage(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), name)
    ranges = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        laid.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_v"))
        .select("_range", F.coalesce(F.sum("_n").over(ranges), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_v").over(ranges), F.lit(0)).alias("_v0"))
    )
    within = Window.partitionBy("_range").orderBy(*order)
    earlier = within.rowsBetween(Window.unboundedPreceding, -1)
    return (
        # one range a task, and one row for each in the broadcast, so their number bounds it
        laid.repartitionById(shuffle_partitions(rows.sparkSession), "_range")
        .join(F.broadcast(offsets), "_range")
        .withColumn("position", F.col("_n0") + F.row_number().over(within) - 1)
        .withColumn("before", F.col("_v0") + F.coalesce(F.sum(value).over(earlier), F.lit(0)))
        .drop("_range", "_n0", "_v0")
    )


def laid_out(rows: DataFrame, order: Sequence[Column], name: str, part: str = "_range", place: str = "_place") -> DataFrame:
    """``rows`` in ranges of ``order``, sorted inside and staged; with the range's number as ``part`` and the row's place (from 0) in it as ``place``.

    A range is one file, so a row's place is where it stands in its file, and no window has
    to number the rows.
    """
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(part, F.spark_partition_id())
    return stage(ranges, name, maxRecordsPerFile=0).select("*", F.col("_metadata.row_index").alias(place))


def ranked(rows: DataFrame, within: str, order: Sequence[Column], rank: str, name: str) -> DataFrame:
    """Add ``rank``: each row's place (from 0) among those with its value of ``within``, in ``order``.

    ``within`` has few values (splits). One exchange lays the rows out; what each range has
    of each value, at most ranges + values rows, is summed up over the ranges and broadcast.
    """
    group, part, place, offset = free_names(rows, "_group", "_range", "_place", "_offset")
    laid = laid_out(rows, [q(within), *order], name, part, place)
    earlier = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    parts = laid.groupBy(q(within).alias(group), part).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    parts = parts.select(group, part, (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias(offset))
    placed = laid.join(F.broadcast(parts), (laid[part] == parts[part]) & q(within).eqNullSafe(q(group)))
    return placed.select(*[q(c) for c in rows.columns if c != rank], (q(place) + q(offset)).alias(rank))


def _merged(how: str, carried: Column, own: Column) -> Column:
    """A running value from what came before the range and what the range has so far; null where neither has any."""
    if how == "sum":
        return F.when(carried.isNull(), own).when(own.isNull(), carried).otherwise(carried + own)
    return (F.least if how == "min" else F.greatest)(carried, own)


_AGGREGATES = {"sum": F.sum, "min": F.min, "max": F.max}


def hot_keys(rows: DataFrame, keys: Sequence[str], hot: int | None) -> DataFrame | None:
    """The keys of at least ``hot`` rows, at most a row in ``hot``; none if there are not even so many rows in all."""
    if hot is None or rows.count() < hot:
        return None
    return stage(rows.groupBy(*[q(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= hot).drop("_n"), "hot-keys")


def over_keys(rows: DataFrame, keys: Sequence[str], order: Sequence[str], running: Mapping[str, tuple[str, Column]] | None = None, whole: Mapping[str, tuple[str, Column]] | None = None, hot: int | None = HOT, name: str = "over-keys") -> DataFrame:
    """Add running and whole aggregates of each key's rows: columns by name, each ``sum``, ``min`` or ``max`` of an expression.

    Running ones take the key's rows up to and with this one in ``order``, which should tell a
    key's rows apart; whole ones all of them. A null key part is a value like any other.

    Keys of fewer than ``hot`` rows (all keys if it is None) are windows over one exchange by key. A key with more is
    laid out by range of key and order, so its rows lie in as many tasks as its size asks
    for; each range adds up its own rows, and what a key's earlier ranges come to is carried
    in from a table with a row for each range and key in it.
    """
    running, whole = running or {}, whole or {}
    mine = [q(k) for k in keys]
    by_key = Window.partitionBy(*mine)
    so_far = by_key.orderBy(*[q(o) for o in order]).rowsBetween(Window.unboundedPreceding, 0)
    plain = {**{c: _AGGREGATES[how](e).over(so_far) for c, (how, e) in running.items()}, **{c: _AGGREGATES[how](e).over(by_key) for c, (how, e) in whole.items()}}
    large = hot_keys(rows, keys, hot)
    if large is None or large.isEmpty():
        return rows.withColumns(plain)
    named = large.select(*[q(k).alias(f"_hot{n}") for n, k in enumerate(keys)])
    is_hot = [q(k).eqNullSafe(F.col(f"_hot{n}")) for n, k in enumerate(keys)]
    some = rows.join(named, is_hot, "left_anti").withColumns(plain)

    part, place = free_names(rows, "_range", "_place")
    # expressions are evaluated before the rows are laid out, and aggregated from their columns after
    values = {f"_value{n}": (c, how, e, c in running) for n, (c, (how, e)) in enumerate([*running.items(), *whole.items()])}
    laid = laid_out(rows.join(named, is_hot, "left_semi").withColumns({v: e for v, (_, _, e, _) in values.items()}), [*mine, *[q(o) for o in order]], name, part, place)
    group = {f"_key{n}": q(k) for n, k in enumerate(keys)}
    totals = laid.groupBy(part, *[e.alias(c) for c, e in group.items()]).agg(*[_AGGREGATES[how](v).alias(v) for v, (_, how, _, _) in values.items()])
    of_key = Window.partitionBy(*group)
    before = of_key.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(F.col(part).alias("_part"), *group, *[_AGGREGATES[how](v).over(before if runs else of_key).alias(f"_carried{v}") for v, (_, how, _, runs) in values.items()])
    here = [q(k).eqNullSafe(F.col(c)) for c, k in zip(group, keys, strict=True)]
    laid = laid.repartitionById(shuffle_partitions(rows.sparkSession), part).join(carried, [F.col(part) == F.col("_part"), *here])
    inside = Window.partitionBy(part, *mine).orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    added = {c: _merged(how, F.col(f"_carried{v}"), _AGGREGATES[how](v).over(inside)) if runs else F.col(f"_carried{v}") for v, (c, how, _, runs) in values.items()}
    return some.unionByName(laid.withColumns(added).select(*[q(c) for c in some.columns]))
