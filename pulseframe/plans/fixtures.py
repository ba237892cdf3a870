"""The given tables seen as readings, truth, geometry and pulses."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.functions.keys import EVENT_COLUMNS, SENSOR_COLUMNS
from pulseframe.functions.naming import Feature, q, vector_map
from pulseframe.operators.pulses import extract, select_series, sensor_features, shift_by_mean_time
from pulseframe.sources.tables import nan_to_null

SERIES, STREAM = "InIceDSTPulses", "InIceSplit"
DAY = 24 * 3600 * 1_000_000
#: Microseconds of 2024-01-01, so charge times time stays short.
ORIGIN = 1_704_067_200_000_000
#: Three positions with fractional items, so names contain dots.
READINGS = [Feature("Level", ("level",)), Feature("Share", ("share",), {"percentiles": [0.01, 0.5]})]
PULSE_FEATURES = [
    Feature("TotalCharge", ("total_charge",)),
    Feature("TFirstPulse", ("t_first_pulse",)),
    Feature("ChargeUntilT", ("charge_until_t",), {"times": [DAY, 3 * DAY, 10 * DAY]}),
    Feature("TSpread", ("t_spread",)),
    Feature("TimeAtChargePercentile", ("time_at_charge_percentile",), {"percentiles": [0.01, 0.5, 0.9]}),
]
LABELS = ["PrimaryNeutrinoEnergy"]
_KIND = "case event_type when 'click' then 0 when 'error' then 1 when 'purchase' then 2 when 'signup' then 3 when 'view' then 4 end"
_EVENT = ["cast(1 as bigint) as Run", "user_id as Event", "cast(0 as int) as SubEvent", f"'{STREAM}' as SubEventStream"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return nan_to_null(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*_EVENT, f"{_KIND} as string", "cast(event_id % 4 as int) as om", "0 as pmt", "cast(event_id % 3 as int) as vector_index", "case when event_id % 7 = 0 then null else value end as item", "event_id as _ord")


def big_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as readings; they have no unique order of their own, so the whole row is it."""
    lines = table(spark, sf_dir, "lineitem").selectExpr("cast(1 as bigint) as Run", "l_orderkey as Event", "cast(0 as int) as SubEvent", f"'{STREAM}' as SubEventStream", "cast(l_suppkey as int) as string", "0 as om", "0 as pmt", "cast(l_linenumber - 1 as int) as vector_index", "l_quantity as item", "struct(l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) as _ord")
    return lines


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr("cast(1 as bigint) as Run", "o_orderkey as Event", "cast(0 as int) as SubEvent", f"'{STREAM}' as SubEventStream", "o_totalprice as PrimaryNeutrinoEnergy", "o_orderstatus", "o_orderpriority", "o_orderkey as _ord")


def repeated_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truth by customer: keys repeat."""
    return table(spark, sf_dir, "orders").selectExpr("cast(1 as bigint) as Run", "o_custkey as Event", "cast(0 as int) as SubEvent", f"'{STREAM}' as SubEventStream", "o_totalprice as PrimaryNeutrinoEnergy", "o_orderstatus", "o_orderkey as _ord")


def geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr("cast(s_suppkey as int) as string", "0 as om", "0 as pmt", "cast(s_nationkey as double) as x", "cast(s_suppkey as double) as y", "s_acctbal as z")


def pulses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*_EVENT, f"{_KIND} as string", "0 as om", "0 as pmt", f"case when event_id % 11 = 0 then 'Other' else '{SERIES}' end as pulse_series", "unix_micros(cast(ts as timestamp)) as time", "cast(value as decimal(12,2)) as charge", "event_id as _ord")


def bad_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where("event_type = 'error'").selectExpr(f"{_KIND} as string", "0 as om", "0 as pmt").distinct()


def exclusion_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = 3_600_000_000
    return pulses(spark, sf_dir).where(F.col("_ord") % 5 == 0).select("Run", "Event", "SubEvent", "SubEventStream", "string", "om", "pmt", (F.col("time") - hour).alias("start"), (F.col("time") + hour).alias("end"))


def bright_pulses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pulses of which every third is one sensor's in one event."""
    bright = "_ord % 3 = 0"
    return pulses(spark, sf_dir).withColumns({"Event": F.expr(f"if({bright}, 0, Event)"), "string": F.expr(f"if({bright}, 0, string)")})


def overlapping_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of up to two days about every 35th of these pulses: most are the bright sensor's, and they overlap."""
    hour = 3_600_000_000
    ends = {"start": F.col("time") - (F.col("_ord") % 25) * hour, "end": F.col("time") + (F.col("_ord") % 24 - 1) * hour}
    return bright_pulses(spark, sf_dir).where(F.col("_ord") % 35 < 3).select("Run", "Event", "SubEvent", "SubEventStream", "string", "om", "pmt", *[e.alias(c) for c, e in ends.items()])


def classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr("cast(1 as bigint) as Run", "o_orderkey as Event", "cast(0 as int) as SubEvent", f"'{STREAM}' as SubEventStream", "cast(substr(o_orderpriority, 1, 1) as int) as classification")


def inputs(sf_dir: str) -> dict[str, str]:
    """The tables that a build of these fixtures reads, by name."""
    return {name: f"{sf_dir}/{name}.parquet" for name in ("events", "orders", "supplier")}


def read_all(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """An extractor: readings, truth and geometry from the tables named in ``inputs``."""
    sf_dir = paths["events"].rpartition("/")[0]
    return {"features": readings(spark, sf_dir), "truth": truth(spark, sf_dir), "geometry": geometry(spark, sf_dir)}


def extract_chain(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """An extractor that does all that extraction can be told to: series, stream, sensors, windows, shift, features."""
    sf_dir = paths["events"].rpartition("/")[0]
    return {"features": _readings_of(configured(spark, sf_dir)), "truth": truth(spark, sf_dir)}


def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(
        pulses(spark, sf_dir), PULSE_FEATURES, EVENT_COLUMNS, SENSOR_COLUMNS, SERIES, [STREAM], bad_sensors(spark, sf_dir), exclusion_windows(spark, sf_dir),
        modifiers=[lambda p: shift_by_mean_time(p, EVENT_COLUMNS, ORIGIN)],
    )


def _readings_of(named: DataFrame) -> DataFrame:
    """Features as readings: a cell has one, so its position is order enough."""
    cells = F.posexplode(F.array(*[q(n) for n in vector_map(PULSE_FEATURES)])).alias("vector_index", "item")
    return named.select(*EVENT_COLUMNS, *SENSOR_COLUMNS, cells).withColumn("_ord", F.col("vector_index").cast("long"))


def extract_all(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """An extractor: the five outputs of an extraction, features summarised from pulses."""
    sf_dir = paths["events"].rpartition("/")[0]
    named = sensor_features(select_series(pulses(spark, sf_dir), SERIES), PULSE_FEATURES, [*EVENT_COLUMNS, *SENSOR_COLUMNS])
    energies = truth(spark, sf_dir).select(*EVENT_COLUMNS, "PrimaryNeutrinoEnergy")
    return {
        "features": _readings_of(named),
        "truth": truth(spark, sf_dir),
        "classification": classification(spark, sf_dir),
        "entry_energy": energies.withColumn("energy", F.col("PrimaryNeutrinoEnergy") / 2).drop("PrimaryNeutrinoEnergy"),
        "deposited_energy": energies.withColumn("energy", F.col("PrimaryNeutrinoEnergy") / 4).drop("PrimaryNeutrinoEnergy"),
    }
