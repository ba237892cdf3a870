"""Typed keys give what their texts give, and no text of a key is exchanged."""

import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pulseframe.functions import keys
from pulseframe.operators import reshape, samples, splits
from pulseframe.plans import fixtures as fx
from pulseframe.plans.queries import NAMES
from pulseframe.sources import tables

EVENT, SENSOR = ["Run", "Name"], ["string", "om", "pmt"]


def _data(spark):
    rng = random.Random(4)
    readings = [(rng.choice([None, 1, 2, 10]), rng.choice([None, "nan", "a", "Event=7", "Event=8"]), rng.choice([1, 2, 10]), rng.choice([0, 3]), 0, rng.choice([None, 0, 1, 2, 3]), rng.choice([None, rng.random()]), k) for k in range(900)]
    readings = spark.createDataFrame(readings, "Run int, Name string, string int, om int, pmt int, vector_index int, item double, _ord long").repartition(4)
    # truth's ids are wider integers
    truth = [(rng.choice([None, 1, 2, 10, 11]), rng.choice([None, "nan", "a", "Event=7", "Event=8"]), float(k), k) for k in range(120)]
    return readings, spark.createDataFrame(truth, "Run long, Name string, energy double, _ord long").repartition(3)


def test_reshape_as_by_text(spark):
    readings, _ = _data(spark)
    keyed = keys.with_key(keys.with_key(readings, SENSOR, "dom_id"), EVENT, "event_id")
    want = reshape.name_columns(reshape.pivot_first(keyed, 3), ["a", "b", "c_0.1"])
    got = reshape.reshape_features(readings, ["a", "b", "c_0.1"], EVENT, SENSOR)
    assert got.columns == want.columns and rows(got) == rows(want)
    with pytest.raises(TypeError, match="item"):
        reshape.reshape_features(readings, ["a"], ["item"], SENSOR)


def test_training_as_by_text(spark):
    """Missing ids and ids that read like missing ones, events that repeat, splits that overlap, rows in no split."""
    readings, truth = _data(spark)
    ids = lambda df: df.withColumnRenamed("Run", "Event")
    readings, truth, event = ids(readings), ids(truth), ["Event", "Name"]
    predicates = {"train": "Event > 1", "test": "energy % 2 = 0"}
    keyed = keys.with_key(truth, event, "event_id")
    features = reshape.reshape_features(readings, ["a", "b", "c"], event, SENSOR)
    want = samples.training_table(splits.sample_index(splits.split_all(keyed, predicates).select("split", "event_id", "_ord")), keyed, features, ["a", "b", "c"], ["energy"])
    got = samples.training_from_ids(truth, readings, ["a", "b", "c"], ["energy"], predicates, event, SENSOR)
    assert got.columns == want.columns
    assert rows(got) == rows(want) and got.count() > 20


def test_training_of_fixtures_as_by_text(spark, sf_dir):
    truth, readings = fx.repeated_truth(spark, sf_dir), fx.readings(spark, sf_dir)
    keyed = reshape.reshape_truth(truth)
    predicates = {"train": "Event % 5 > 1", "odd": "Event % 2 = 1", "few": "PrimaryNeutrinoEnergy > 200000"}
    indexed = splits.sample_index(splits.split_all(keyed, predicates).select("split", "event_id", "_ord"))
    want = samples.training_table(indexed, keyed, reshape.reshape_features(readings, NAMES), NAMES, fx.LABELS)
    got = samples.training_from_ids(truth, readings, NAMES, fx.LABELS, predicates)
    assert rows(got) == rows(want) and got.count() > 50
    with pytest.raises(samples.EventsWithoutFeaturesError):
        samples.training_from_ids(truth, readings.where("Event > 20"), NAMES, fx.LABELS, predicates, strict=True)


def exchanged(df):
    """The columns of each exchange of rows in the plan."""
    text = df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return [m[1] for m in re.finditer(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\n]*)\]", text)]


def test_no_text_of_a_key_is_exchanged(spark, sf_dir):
    # ids that aren't constants, which Spark folds away
    varied = lambda df: df.withColumns({"Run": F.col("Event") % 3, "SubEvent": F.expr("cast(Event % 2 as int)"), "SubEventStream": F.expr("concat('s', Event % 2)")})
    lines = varied(fx.big_readings(spark, sf_dir))
    event, sensor = keys.TypedKey.of(lines, keys.EVENT_COLUMNS, "_e"), keys.TypedKey.of(lines, keys.SENSOR_COLUMNS, "_s")
    pivot = reshape.pivot_typed(lines, 7, event, sensor).select(event.text().alias("event_id"), sensor.text().alias("dom_id"), "`0`")
    training = samples.training_from_ids(varied(fx.truth(spark, sf_dir)), varied(fx.readings(spark, sf_dir)), NAMES, fx.LABELS)
    for df, most in ((pivot, 2), (training, 5)):  # and one that lays the ranks out
        found = exchanged(df)
        assert 0 < len(found) <= most
        assert not any(name in columns for columns in found for name in ("event_id", "dom_id"))


def test_order_is_a_number(spark, tmp_path):
    for part in ("k=2", "k=10"):
        (tmp_path / part).mkdir()
        spark.range(50).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / part))
    df = tables.read_table(spark, str(tmp_path))
    assert dict(df.dtypes)["_ord"] == "bigint"
    # files of equal places in other folders come one after the other
    assert [(r["k"], r["id"]) for r in df.orderBy("_ord").collect()] == [(k, i) for k in (10, 2) for i in range(50)]
    (tmp_path / "c.csv").write_text("x\n1\n2\n")
    assert dict(tables.read_table(spark, str(tmp_path / "c.csv"), "csv", "x int").dtypes)["_ord"] == "struct<place:bigint,row:bigint>"
