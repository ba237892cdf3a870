"""The operators applied to the given tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulseframe.functions import keys, naming
from pulseframe.functions.keys import EVENT_COLUMNS, SENSOR_COLUMNS
from pulseframe.functions.naming import q
from pulseframe.operators import geometry, pulses, quality, reshape, samples, splits
from pulseframe.operators.ordering import prefix_sums
from pulseframe.plans import fixtures as fx
from pulseframe.plans.build import Built, Settings, Tables, build, convert
from pulseframe.sources import reuse, staging, tables

NAMES = naming.vector_map(fx.READINGS)
PULSE_NAMES = naming.vector_map(fx.PULSE_FEATURES)
KEYS = [*EVENT_COLUMNS, *SENSOR_COLUMNS]


def _truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.reshape_truth(fx.truth(spark, sf_dir))


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.reshape_features(fx.readings(spark, sf_dir), NAMES)


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pulses.select_series(fx.pulses(spark, sf_dir), fx.SERIES)


def _dotless(df: DataFrame) -> DataFrame:
    """Feature names with their dots written as ``p``, for results that SQL has to name too."""
    return df.select(*[q(c).alias(c.replace(".", "p")) for c in df.columns])


def composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = fx.readings(spark, sf_dir)
    return r.select("_ord", keys.composite_key(EVENT_COLUMNS).alias("event_id"), keys.composite_key(SENSOR_COLUMNS).alias("dom_id"))


def unpack_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids, named = keys.unpack_ids(F.col("dom_id")), keys.unpack_map(F.col("dom_id"))
    return composite_key(spark, sf_dir).select("_ord", ids[0].alias("string"), ids[1].alias("om"), ids[2].alias("pmt"), named["om"].alias("om_text"))


def event_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    anchored, first = keys.event_number(F.col("k")), keys.event_number(F.col("k"), anchored=False)
    return fx.truth(spark, sf_dir).select("_ord", F.concat(F.lit("SubEvent=3|"), keys.composite_key(["Event", "Run"])).alias("k")).select("_ord", anchored.alias("event"), first.alias("first_event"))


def pivot_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = keys.with_event_key(keys.with_sensor_key(fx.readings(spark, sf_dir)))
    wide = reshape.pivot_first(keyed, 3)
    return wide.select("event_id", "dom_id", *[q(str(k)).alias(f"p{k}") for k in range(3)])


def pivot_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dotless(_wide(spark, sf_dir))


def pivot_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pivot over order lines, the largest table, in its own order by whole rows."""
    lines = fx.big_readings(spark, sf_dir)
    event, sensor = keys.TypedKey.of(lines, EVENT_COLUMNS, "_e"), keys.TypedKey.of(lines, SENSOR_COLUMNS, "_s")
    wide = reshape.pivot_typed(lines, 7, event, sensor)
    return wide.select(event.text().alias("event_id"), sensor.text().alias("dom_id"), *[q(str(k)).alias(f"p{k}") for k in range(7)])


def truth_reshape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _truth(spark, sf_dir)


def vector_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings named through the map as a lookup table."""
    named = fx.readings(spark, sf_dir).join(F.broadcast(naming.vector_map_table(spark, NAMES)), "vector_index")  # one row a feature
    return named.groupBy("vector_index", "feature").agg(F.count("item").alias("n"), F.min("item").alias("least"), F.max("item").alias("most"))


def split_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.select_split(_truth(spark, sf_dir), "Event % 5 > 1 and PrimaryNeutrinoEnergy > 1000 and not (o_orderstatus <=> 'P')").select("event_id", "PrimaryNeutrinoEnergy")


def split_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.split_all(_truth(spark, sf_dir)).select("split", "event_id")


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.split_counts(splits.split_all(_truth(spark, sf_dir)))


def split_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.split_audit(_truth(spark, sf_dir), {"train": "Event % 5 > 1", "validation": "Event % 4 = 0", "test": "Event % 5 = 1"})


def split_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor rows and the sum of one feature for each split."""
    truth = splits.split_all(_truth(spark, sf_dir)).select("split", "event_id")
    joined = samples.join_features(truth, _wide(spark, sf_dir))
    value = q("share_0.5").cast("decimal(18,2)")
    return joined.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("event_id").alias("n_events"), F.sum(value).cast("double").alias("share"))


def sample_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.sample_index(splits.split_all(_truth(spark, sf_dir)).select("split", "event_id", "_ord")).select("split", "idx", "event_id")


def label_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.labels_last_wins(reshape.reshape_truth(fx.repeated_truth(spark, sf_dir)), [*fx.LABELS, "o_orderstatus"])


def label_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.project_labels(_truth(spark, sf_dir), ["o_orderpriority", *fx.LABELS])


def sample_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dotless(samples.join_features(_truth(spark, sf_dir).select("event_id", *fx.LABELS), _wide(spark, sf_dir)))


def events_without_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    big = keys.with_event_key(fx.big_readings(spark, sf_dir))
    return samples.events_without_features(_truth(spark, sf_dir), big).select("event_id")


def duplicate_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_truth(reshape.reshape_truth(fx.repeated_truth(spark, sf_dir)))


def unmapped_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unmapped_positions(fx.big_readings(spark, sf_dir), 3)


def bad_event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events numbered below zero, here those of odd orders, can't be parsed."""
    odd = fx.truth(spark, sf_dir).withColumn("Event", F.expr("if(Event % 2 = 1, -Event, Event)"))
    return quality.bad_event_ids(reshape.reshape_truth(odd)).select("event_id", "_ord")


def _matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.event_matrices(_wide(spark, sf_dir), NAMES)


def event_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matrices by cell: event_id, row, column, value."""
    rows = _matrices(spark, sf_dir).select("event_id", F.posexplode("features").alias("r", "f"))
    return rows.select("event_id", "r", F.posexplode("f").alias("c", "value"))


def sample_with_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor ids beside their rows of the matrix."""
    rows = _matrices(spark, sf_dir).select("event_id", F.posexplode(F.arrays_zip("dom_ids", "features")).alias("r", "x"))
    return rows.select("event_id", "r", F.col("x.dom_ids.string").alias("string"), F.col("x.dom_ids.om").alias("om"), F.col("x.dom_ids.pmt").alias("pmt"), F.col("x.features")[0].alias("level"))


def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.training_from_ids(fx.truth(spark, sf_dir), fx.readings(spark, sf_dir), NAMES, fx.LABELS)


def training_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _training(spark, sf_dir).select("split", "idx", "event_id", F.size("features").alias("n_sensors"), F.size(F.col("features")[0]).alias("n_features"), F.col("labels")[0].alias("label"))


def _built(spark: SparkSession, sf_dir: str) -> Built:
    """The stored tables of this input: built by the first query of a session that asks, reused by the others."""
    settings = Settings(fx.READINGS, fx.LABELS, recipe="readings of events")
    return build(spark, fx.inputs(sf_dir), staging.session_folder(spark, "builds"), settings, fx.read_all, strict=False)


def one_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored sample at a place of its split, by row of its matrix."""
    one = _built(spark, sf_dir).sample("train", 3)
    return one.select("split", "idx", "event_id", F.posexplode("features").alias("r", "f")).select("split", "idx", "event_id", "r", F.col("f")[0].alias("level"))


def event_point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event's rows from the stored features."""
    return _dotless(_built(spark, sf_dir).event(f"Run=1|Event=7|SubEvent=0|SubEventStream={fx.STREAM}"))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every split's stored samples, from a build that finds its tables there."""
    _built(spark, sf_dir)
    built = _built(spark, sf_dir)
    splits_ = [built.split(name).select("split", "idx", "event_id", F.col("labels")[0].alias("label")) for name in built.settings.predicates]
    return splits_[0].unionByName(splits_[1]).unionByName(splits_[2]).withColumn("reused", F.lit(built.reused))


def stored_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _built(spark, sf_dir).table("truth")


def stored_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored feature by sensor with the stored geometry's positions."""
    return _built(spark, sf_dir).profile("level")


def _halved(tables_: Tables, settings: Settings) -> Tables:
    """A converter of one's own: half the energies, and no geometry."""
    truth = tables_["truth"].withColumn("PrimaryNeutrinoEnergy", F.col("PrimaryNeutrinoEnergy") / 2)
    return convert({"features": tables_["features"], "truth": truth}, settings)


def own_converter(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = Settings(fx.READINGS, fx.LABELS, recipe="half of the energies")
    built = build(spark, fx.inputs(sf_dir), staging.session_folder(spark, "builds"), settings, fx.read_all, _halved, strict=False)
    return built.training.select("split", "idx", "event_id", F.size("features").alias("n_sensors"), F.col("labels")[0].alias("label"))


def extraction_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five outputs of an extractor as a build stores them: output, event_id, sensor and feature if any, value."""
    built = build(spark, fx.inputs(sf_dir), staging.session_folder(spark, "builds"), Settings(fx.PULSE_FEATURES, fx.LABELS, recipe="pulses of events"), fx.extract_all, strict=False)
    long = reshape.long_form(built.table("features"), PULSE_NAMES)
    parts = [long.select(F.lit("features").alias("output"), "event_id", "dom_id", "vector_index", F.col("item").alias("value"))]
    for name, column in {"truth": "PrimaryNeutrinoEnergy", "classification": "classification", "entry_energy": "energy", "deposited_energy": "energy"}.items():
        table = built.table(name)
        table = table if "event_id" in table.columns else keys.with_event_key(table)
        parts.append(table.select(F.lit(name).alias("output"), "event_id", F.lit(None).cast("string").alias("dom_id"), F.lit(None).cast("int").alias("vector_index"), F.col(column).cast("double").alias("value")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _placed(rows: DataFrame, name: str) -> DataFrame:
    """Rows with their place in the order of ``_ord``."""
    return prefix_sums(rows.withColumn("_one", F.lit(1)), [F.col("_ord")], "_one", name).drop("before", "_one", "_ord")


def read_many_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders copied to files of 500 and read in the order of the files."""
    folder = staging.new_folder(spark, "many-files")
    fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey").write.option("maxRecordsPerFile", 500).parquet(folder)
    return _placed(tables.read_table(spark, folder), "many-files-order")


def read_csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as text, which Spark cuts into pieces."""
    folder = staging.new_folder(spark, "csv-files")
    fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").repartitionByRange(3, "o_orderkey").sortWithinPartitions("o_orderkey").write.option("header", True).csv(folder)
    return _placed(tables.read_table(spark, folder, "csv", "o_orderkey bigint, o_orderstatus string"), "csv-order")


def read_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of the catalog, ordered by a column of its own."""
    fx.table(spark, sf_dir, "events").select("event_id", "user_id", "value").createOrReplaceTempView("pulseframe_events")
    return tables.read_table(spark, "pulseframe_events", "table", order="event_id")


def suffix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only files with the suffix, of a folder that holds others."""
    folder = staging.new_folder(spark, "suffixes")
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    for codec, rest in (("snappy", 0), ("gzip", 1)):
        orders.where(F.col("o_orderkey") % 2 == rest).write.mode("append").option("compression", codec).parquet(folder)
    return tables.read_table(spark, folder, suffix=".snappy.parquet", order="o_orderkey")


def geometry_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = staging.new_folder(spark, "geometry")
    tables.write_tables({"geometry": fx.geometry(spark, sf_dir)}, folder)
    return tables.read_geometry(spark, f"{folder}/geometry")


def concatenated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two selections one after the other, each in its order."""
    truth = _truth(spark, sf_dir)
    pieces = [splits.select_split(truth, p).select("event_id", "PrimaryNeutrinoEnergy", "_ord") for p in ("Event % 5 = 1", "Event % 5 = 0")]
    return _placed(tables.concatenate(pieces), "concatenated")


def fingerprint_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of text files of a thousand orders each."""
    folder = staging.new_folder(spark, "digests")
    lines = fx.table(spark, sf_dir, "orders").select(F.expr("o_orderkey div 1000").alias("part"), "o_orderkey", F.format_string("%d %s", "o_orderkey", "o_orderstatus").alias("value"))
    lines.repartition("part").sortWithinPartitions("part", "o_orderkey").select("part", "value").write.partitionBy("part").text(folder)
    return reuse.file_digests(spark, folder, ".txt").select("digest")


def own_builder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feature kind of one's own beside a shipped one."""
    count = naming.Feature("PulseCount", ("n_pulses",))
    return pulses.sensor_features(_series(spark, sf_dir), [count, fx.PULSE_FEATURES[0]], ["Event", "string"], {"PulseCount": lambda f: [F.count(F.lit(1))]})


def _slope_terms(feature: naming.Feature, seconds: np.ndarray, cents: np.ndarray) -> np.ndarray:
    return np.stack([np.ones_like(seconds), seconds, cents, seconds * cents, seconds * seconds], axis=1)


def _slopes(feature: naming.Feature, sums: list[list[int]]) -> list[list[float | None]]:
    spread = [n * tt - t * t for n, t, _, _, tt in sums]
    return [[float(n * tq - t * q) / float(s) if s else None] for s, (n, t, q, tq, _) in zip(spread, sums, strict=True)]


def own_vectorised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A straight line fitted to charge over time (cents an hour), in NumPy, beside a shipped kind; one sensor has a third of all pulses."""
    kind = pulses.Vectorised(("hours", "cents"), 5, _slope_terms, _slopes)
    known = fx.bright_pulses(spark, sf_dir).withColumns({"hours": F.expr(f"(time - {fx.ORIGIN}) div 3600000000"), "cents": (F.col("charge") * 100).cast("bigint")})
    features = [naming.Feature("ChargeSlope", ("charge_slope",)), fx.PULSE_FEATURES[0]]
    return pulses.sensor_features(pulses.select_series(known, fx.SERIES), features, ["Event", "string"], {"ChargeSlope": kind})


def bright_sensor_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Charge by time and times at shares of it, where one sensor of one event has a third of all pulses and is summed up in several tasks."""
    some = [f for f in fx.PULSE_FEATURES if f.kind in ("ChargeUntilT", "TimeAtChargePercentile")]
    return _dotless(pulses.sensor_features(pulses.select_series(fx.bright_pulses(spark, sf_dir), fx.SERIES), some, ["Event", "string"], hot=500))


def overlapping_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pulses outside of windows that overlap by the thousands in one sensor."""
    return pulses.exclude_windows(fx.bright_pulses(spark, sf_dir), fx.overlapping_windows(spark, sf_dir), KEYS, hot=500).select("_ord", "Event", "time")


def extraction_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features that a build has extracted by the whole configured chain, as stored."""
    built = build(spark, fx.inputs(sf_dir), staging.session_folder(spark, "builds"), Settings(fx.PULSE_FEATURES, fx.LABELS), fx.extract_chain, strict=False)
    return _dotless(built.table("features"))


def matrix_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matrices in blocks of four sensors, by cell."""
    blocks = samples.matrix_blocks(_wide(spark, sf_dir), NAMES, 4, hot=50)
    rows = blocks.select("event_id", "block", "first", F.posexplode("features").alias("r", "f"))
    return rows.select("event_id", "block", (F.col("first") + F.col("r")).alias("r"), F.posexplode("f").alias("c", "value"))


def events_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a hundred events from the stored features."""
    return _dotless(_built(spark, sf_dir).events([f"Run=1|Event={k}|SubEvent=0|SubEventStream={fx.STREAM}" for k in range(1, 1000, 10)]))


def training_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the manifest says of each split: samples, the first and the last, and files that don't follow the one before."""
    in_order = Window.partitionBy("split").orderBy("first")
    # a sample without features is in no file, so files may leave gaps but never overlap
    files = _built(spark, sf_dir).manifest.withColumn("overlaps", F.col("first") <= F.lag("last").over(in_order))
    return files.groupBy("split").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"), F.count_if("overlaps").alias("overlaps"))


def rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions published one after the other: a reader of the first keeps it, the next one gets the second."""
    root = staging.new_folder(spark, "versions")
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    first, _ = reuse.build_or_reuse(spark, root, "orders", lambda: {"orders": orders.where("o_orderkey % 2 = 0")})
    reading = spark.read.parquet(f"{first}/orders")
    second, _ = reuse.build_or_reuse(spark, root, "orders", lambda: {"orders": orders}, most_age=-1)
    again, reused = reuse.build_or_reuse(spark, root, "orders", lambda: {})
    latest = spark.read.parquet(f"{again}/orders").withColumn("reused", F.lit(reused and again == second))
    return reading.withColumns({"reused": F.lit(False), "version": F.lit(1)}).unionByName(latest.withColumn("version", F.lit(2)))


def remembered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of text files of a thousand orders each, half of which came after the first look."""
    folder, store = staging.new_folder(spark, "digested"), staging.new_folder(spark, "digests")
    lines = fx.table(spark, sf_dir, "orders").select(F.expr("o_orderkey div 1000").alias("part"), F.struct("o_orderkey", F.format_string("%d %s", "o_orderkey", "o_orderstatus").alias("line")).alias("l"))
    # a row and so a file for each part, however many there are; in a folder for each half, which gets none if it has no rows
    texts = lines.groupBy("part").agg(F.array_sort(F.collect_list("l"))["line"].alias("lines")).select((F.col("part") % 2).alias("half"), F.array_join("lines", "\n").alias("value"))
    for half in (0, 1):
        texts.where(F.col("half") == half).write.mode("append").option("maxRecordsPerFile", 1).partitionBy("half").text(folder)
        found = reuse.remembered_digests(spark, folder, store, ".txt")
    return found.select("digest")


def shift_with_missing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shift where every third user has no number: they are one event."""
    some = fx.pulses(spark, sf_dir).withColumn("Event", F.expr("if(Event % 3 = 0, null, Event)"))
    return pulses.shift_by_mean_time(some, EVENT_COLUMNS, fx.ORIGIN).select("_ord", "Event", "time")


def sensor_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fx.big_readings(spark, sf_dir).select("Event", "vector_index", "item", *SENSOR_COLUMNS)
    return geometry.with_coordinates(lines, fx.geometry(spark, sf_dir))


def feature_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = keys.with_event_key(keys.with_sensor_key(pulses.sensor_features(_series(spark, sf_dir), fx.PULSE_FEATURES, KEYS)))
    return geometry.feature_profile(wide, fx.geometry(spark, sf_dir), "total_charge", PULSE_NAMES)


def sensors_without_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = fx.geometry(spark, sf_dir).where("string % 10 <> 0")
    return geometry.sensors_without_geometry(fx.big_readings(spark, sf_dir), known)


def series_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _series(spark, sf_dir).select("_ord", "Event", "time")


def stream_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    streams = fx.readings(spark, sf_dir).withColumn("SubEventStream", F.expr("if(_ord % 4 = 0, 'NullSplit', SubEventStream)"))
    return tables.select_streams(streams, [fx.STREAM]).select("_ord", "Event", "item")


def exclude_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pulses.exclude_sensors(fx.pulses(spark, sf_dir), fx.bad_sensors(spark, sf_dir), SENSOR_COLUMNS).select("_ord", "Event", "string")


def exclude_windows_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pulses.exclude_windows(fx.pulses(spark, sf_dir), fx.exclusion_windows(spark, sf_dir), KEYS).select("_ord", "Event", "time")


def exclude_windows_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pulses.exclude_windows(fx.pulses(spark, sf_dir), fx.exclusion_windows(spark, sf_dir), KEYS, partial=False).select("_ord", "Event", "time")


def charge_weighted_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pulses.shift_by_mean_time(fx.pulses(spark, sf_dir), EVENT_COLUMNS, fx.ORIGIN).select("_ord", "Event", "time")


def _feature(kind: str) -> Callable[[SparkSession, str], DataFrame]:
    def one(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _dotless(pulses.sensor_features(_series(spark, sf_dir), [f for f in fx.PULSE_FEATURES if f.kind == kind], ["Event", "string"]))

    return one


def _extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that extraction can be told to do, in order."""
    return keys.with_event_key(keys.with_sensor_key(fx.configured(spark, sf_dir)))


def feature_vector_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dotless(_extracted(spark, sf_dir))


def feature_vector_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.long_form(_extracted(spark, sf_dir), PULSE_NAMES)


def classification_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = pulses.sensor_features(_series(spark, sf_dir), [fx.PULSE_FEATURES[0]], EVENT_COLUMNS)
    return pulses.attach_labels(events, fx.classification(spark, sf_dir), EVENT_COLUMNS).select("Event", "total_charge", "classification")


def table_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row's digest, as files are digested."""
    return fx.truth(spark, sf_dir).select("_ord", F.sha2(F.concat_ws("|", keys.composite_key(["Event"]), F.col("o_orderstatus")), 256).alias("digest"))


def file_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reuse.file_digests(spark, sf_dir)


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features written clustered by event, and read again with a column that the files lack."""
    folder = staging.new_folder(spark, "roundtrip")
    tables.write_tables({"features": _wide(spark, sf_dir)}, folder)
    return _dotless(tables.read_features(spark, f"{folder}/features", [*NAMES, "absent"]))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    plain = [
        composite_key, unpack_key, event_number, pivot_first, pivot_named, pivot_lines, truth_reshape, vector_map, split_filter, split_all, split_counts, split_audit, split_features,
        sample_index, label_last_wins, label_projection, sample_join, events_without_features, duplicate_truth, unmapped_positions, bad_event_ids, event_matrix, sample_with_sensors,
        training_table, one_sample, event_point_lookup, sensor_coordinates, feature_profile, sensors_without_geometry, series_select, stream_select, exclude_sensors,
        exclude_windows_partial, exclude_windows_full, charge_weighted_shift, feature_vector_wide, feature_vector_long, classification_join, table_fingerprint, file_fingerprints,
        parquet_roundtrip, registry, stored_truth, stored_profile, own_converter, extraction_outputs, read_many_files, read_csv_files, read_by_name, suffix_filter, geometry_scan,
        concatenated, fingerprint_files, own_builder, shift_with_missing_ids, own_vectorised, bright_sensor_charges, overlapping_windows, extraction_chain, matrix_blocks, events_lookup,
        training_manifest, rebuilt, remembered_files,
    ]
    named = {"total_charge": "TotalCharge", "first_pulse": "TFirstPulse", "charge_until_t": "ChargeUntilT", "t_spread": "TSpread", "time_at_percentile": "TimeAtChargePercentile"}
    return {f.__name__: f for f in plain} | {name: _feature(kind) for name, kind in named.items()}
