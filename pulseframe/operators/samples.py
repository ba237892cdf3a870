"""Events as samples: a matrix of sensors by features, and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulseframe.functions.keys import EVENT_COLUMNS, SENSOR_COLUMNS, TypedKey, unpack_ids
from pulseframe.functions.naming import q
from pulseframe.operators.ordering import HOT, over_keys, ranked
from pulseframe.operators.reshape import pivot_typed
from pulseframe.operators.splits import PREDICATES, with_matches
from pulseframe.sources.staging import scratch, stage


#: A stored training table.
TRAINING = "idx bigint, event_id string, dom_ids array<struct<string:int,om:int,pmt:int>>, features array<array<float>>, labels array<float>, split string"


class EventsWithoutFeaturesError(ValueError):
    """Strict assembly met events that no sensor has features for."""


def project_labels(truth: DataFrame, labels: Sequence[str]) -> DataFrame:
    """event_id and the labels in their given order; an unknown one is an error."""
    return truth.select("event_id", *[q(c) for c in labels])


def labels_last_wins(truth: DataFrame, labels: Sequence[str]) -> DataFrame:
    """One row for each event: its labels in the last row by ``_ord``, even if missing there; of equal ``_ord`` the largest labels."""
    last = truth.groupBy("event_id").agg(F.max(F.struct("_ord", F.struct(*[q(c).alias(f"l{k}") for k, c in enumerate(labels)]).alias("l")))["l"].alias("_l"))
    return last.select("event_id", *[F.col("_l").getField(f"l{k}").alias(c) for k, c in enumerate(labels)])


def join_features(truth: DataFrame, features: DataFrame) -> DataFrame:
    """Each truth row with all sensor rows of its event."""
    return truth.join(features, "event_id")


def events_without_features(truth: DataFrame, features: DataFrame) -> DataFrame:
    return truth.join(features.select("event_id").distinct(), "event_id", "left_anti")


def event_features(features: DataFrame, event_id: str) -> DataFrame:
    """All sensor rows of one event; the predicate reaches the Parquet scan."""
    return features.where(F.col("event_id") == event_id)


def events_features(features: DataFrame, event_ids: Sequence[str]) -> DataFrame:
    """All sensor rows of some events; the set reaches the Parquet scan, whose statistics and Bloom filters rule out row groups."""
    return features.where(F.col("event_id").isin(*event_ids))


def _sensor(dom_id: Column) -> Column:
    parts = unpack_ids(dom_id)
    return F.struct(parts[0].alias("string"), parts[1].alias("om"), parts[2].alias("pmt"))


def event_matrices(features: DataFrame, names: Sequence[str]) -> DataFrame:
    """event_id, dom_ids and features: parallel arrays in the order of the sensor keys as text.

    ``features`` is an array of float32 arrays in map order, missing values kept; dom_ids
    are structs of the ids. One event's sensors bound an array's length.
    """
    row = F.struct("dom_id", F.array(*[q(n).cast("float") for n in names]).alias("f"))
    sorted_ = features.groupBy("event_id").agg(F.array_sort(F.collect_list(row)).alias("s"))

    return sorted_.select("event_id", F.transform("s", lambda x: _sensor(x["dom_id"])).alias("dom_ids"), F.transform("s", lambda x: x["f"]).alias("features"))


def matrix_blocks(features: DataFrame, names: Sequence[str], rows: int = 4096, hot: int | None = HOT) -> DataFrame:
    """event_id, block, first, dom_ids and features: matrices as ``event_matrices`` gives them, in blocks of ``rows`` sensors.

    ``first`` is the matrix row that a block begins with. No value holds more than a block,
    and an event of ``hot`` or more sensor rows is numbered in several tasks, so an event
    may have any number of them. Rows of one sensor are ordered by their values.
    """
    matrix_row = F.array(*[q(n).cast("float") for n in names])
    placed = over_keys(features.select("event_id", "dom_id", matrix_row.alias("_f")).withColumn("_one", F.lit(1)), ["event_id"], ["dom_id", "_f"], {"_r": ("sum", F.col("_one"))}, hot=hot, name="matrix-rows")
    at = F.col("_r") - 1
    blocks = placed.withColumns({"block": F.expr(f"cast((_r - 1) div {rows} as long)"), "_s": F.struct(at.alias("r"), F.col("dom_id"), F.col("_f").alias("f"))})
    sorted_ = blocks.groupBy("event_id", "block").agg(F.array_sort(F.collect_list("_s")).alias("s"))
    return sorted_.select("event_id", "block", (F.col("block") * rows).alias("first"), F.transform("s", lambda x: _sensor(x["dom_id"])).alias("dom_ids"), F.transform("s", lambda x: x["f"]).alias("features"))


def training_table(indexed: DataFrame, truth: DataFrame, features: DataFrame, names: Sequence[str], labels: Sequence[str], strict: bool = False) -> DataFrame:
    """split, idx, event_id, dom_ids, features, labels: every sample, ready for a trainer.

    ``indexed`` has the truth rows by split with their rank; labels are those of the
    event's last truth row. An event without features is left out, or raises if ``strict``.
    """
    if strict and not events_without_features(indexed, features).isEmpty():
        raise EventsWithoutFeaturesError("events without features")
    last = labels_last_wins(truth, labels).select("event_id", F.array(*[q(c).cast("float") for c in labels]).alias("labels"))
    return indexed.select("split", "idx", "event_id").join(last, "event_id").join(event_matrices(features, names), "event_id").select("split", "idx", "event_id", "dom_ids", "features", "labels")


def training_from_ids(
    truth: DataFrame, readings: DataFrame, names: Sequence[str], labels: Sequence[str], predicates: Mapping[str, str] = PREDICATES,
    event_columns: Sequence[str] = EVENT_COLUMNS, sensor_columns: Sequence[str] = SENSOR_COLUMNS, strict: bool = False,
) -> DataFrame:
    """``training_table`` from truth and long readings by their ids, without key text on the way.

    Truth rows are ranked in their splits, then meet their event's last labels and its
    matrix where readings of the event were dealt to: rows are exchanged once for the ranks
    and once for the event, readings once. Rows of equal ``_ord`` are ranked by their ids.
    """
    event, sensor = TypedKey.of(truth, event_columns, "_e"), TypedKey.of(readings, sensor_columns, "_s")
    matched = with_matches(truth.withColumn("event_id", event.text(event.parts())), predicates)
    vector = F.array(*[q(c).cast("float") for c in labels]).alias("labels")
    rows = matched.select(*event.parts(), "_ord", vector, F.explode_outer("matched").alias("split"))
    indexed = ranked(rows, "split", [F.col("_ord"), *[F.col(n) for n in event.names]], "idx", "training-order")
    last = F.max(F.struct("_ord", "labels")).over(Window.partitionBy(*event.names))["labels"]
    labelled = indexed.withColumn("labels", last).where("split is not null")

    wide = pivot_typed(readings, len(names), TypedKey.of(readings, event_columns, "_e"), sensor, by_event=True)
    one = F.struct(*sensor.names, F.array(*[q(str(k)).cast("float") for k in range(len(names))]).alias("f"))
    # text decides the order of sensors, so it is made where the event's rows are
    texts = F.array_sort(F.transform("l", lambda x: F.struct(sensor.text([x[n] for n in sensor.names]).alias("dom_id"), x["f"].alias("f"))))
    matrices = wide.groupBy(*event.names).agg(F.collect_list(one).alias("l")).withColumn("s", texts)
    matrices = matrices.select(*event.names, F.transform("s", lambda x: _sensor(x["dom_id"])).alias("dom_ids"), F.transform("s", lambda x: x["f"]).alias("features"))
    if strict and not labelled.join(matrices, event.names, "left_anti").isEmpty():
        raise EventsWithoutFeaturesError("events without features")
    return labelled.join(matrices, event.names).select("split", "idx", event.text().alias("event_id"), "dom_ids", "features", "labels")


def write_training(training: DataFrame, folder: str) -> None:
    """The hand-off to a trainer: Parquet by split, each split's files in the order of its samples, and a manifest of them."""
    with scratch(training.sparkSession):
        # ranges are sampled first, so the samples are made once and read twice
        laid = stage(training, "training").repartitionByRange("split", "idx").sortWithinPartitions("split", "idx")
        laid.write.mode("overwrite").partitionBy("split").parquet(folder)
    manifest(read_training(training.sparkSession, folder)).write.mode("overwrite").parquet(f"{folder}/_manifest")


def manifest(training: DataFrame) -> DataFrame:
    """split, file, first, last, n: the samples in each file of a stored training table.

    Files of a split hold ranges of samples one after the other, so a trainer opens one for
    an index. The name of a file is taken from below the table's folder.
    """
    file = F.concat(F.lit("split="), F.col("split"), F.lit("/"), F.col("_metadata.file_name"))
    return training.groupBy("split", file.alias("file")).agg(F.min("idx").alias("first"), F.max("idx").alias("last"), F.count(F.lit(1)).alias("n"))


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("split string, file string, first bigint, last bigint, n bigint").parquet(f"{folder}/_manifest")


def read_training(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(TRAINING).parquet(folder)


def one_sample(training: DataFrame, split: str, idx: int) -> DataFrame:
    """The sample at a place of its split; from a stored table only files that may hold it are read."""
    return training.where((F.col("split") == split) & (F.col("idx") == idx))
