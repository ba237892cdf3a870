import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulseframe.functions.naming import Feature
from pulseframe.operators import geometry, pulses, quality, reshape, samples, splits

READINGS = "event_id string, dom_id string, vector_index int, item double, _ord long"
QUIRKS = [("e1", "d1", 0, None, 0), ("e1", "d1", 0, 5.0, 1), ("e1", "d1", 1, 6.0, 2), ("e1", "d2", 0, 7.0, 3), ("e2", "d1", 0, 8.0, 4), ("e2", "d1", 2, None, 5), ("e3", "d9", 1, None, 6), ("e1", "d1", 0, 9.0, 7)]


def test_pivot_takes_the_first_that_is_there(spark):
    wide = reshape.pivot_first(spark.createDataFrame(QUIRKS, READINGS), 3)
    assert rows(wide) == sorted([("e1", "d1", 5.0, 6.0, None), ("e1", "d2", 7.0, None, None), ("e2", "d1", 8.0, None, None)], key=repr)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("xy"), st.integers(0, 2), st.none() | st.floats(-9, 9)), max_size=25), st.integers(1, 5), st.randoms())
def test_pivot_and_back(spark, cells, partitions, rng):
    data = [(*c, k) for k, c in enumerate(cells)]
    first = {}
    for e, d, v, x, _ in data:
        if x is not None:
            first.setdefault((e, d, v), x)
    rng.shuffle(data)
    df = spark.createDataFrame(data, READINGS).repartition(partitions)
    back = reshape.long_form(reshape.name_columns(reshape.pivot_first(df, 3), ["p.0", "p.1", "p.2"]), ["p.0", "p.1", "p.2"]).where("item is not null")
    assert {tuple(r)[:3]: r["item"] for r in back.collect()} == first


def test_string_order_in_matrix(spark):
    df = spark.createDataFrame([("e", "string=2|om=1|pmt=0", 1.0), ("e", "string=10|om=1|pmt=0", None)], "event_id string, dom_id string, `a.b` double")
    row = samples.event_matrices(df, ["a.b"]).first()
    assert [x["string"] for x in row["dom_ids"]] == [10, 2]
    assert row["features"] == [[None], [1.0]]


def test_last_label_wins_even_if_missing(spark):
    df = spark.createDataFrame([("a", 1.0, 0), ("a", None, 1), ("b", 2.0, 2)], "event_id string, l double, _ord long")
    assert rows(samples.labels_last_wins(df, ["l"])) == [("a", None), ("b", 2.0)]


TRUTH = [(f"Run=1|Event={k}", float(k) if k % 3 else None, k) for k in range(20)] + [("Run=1", 1.0, 20)]


def test_splits(spark):
    truth = spark.createDataFrame(TRUTH, "event_id string, a double, _ord long")
    assert rows(splits.select_split(truth, "a != 1"), "_ord") == [(k,) for k in sorted([k for k in range(20) if k % 3 and k != 1], key=lambda k: repr((k,)))]
    assert rows(splits.select_split(truth.withColumn("Event", F.lit(0)), "Event = 4"), "_ord", "Event") == [(4, 0)]
    audit = dict(rows(splits.split_audit(truth, {"x": "Event < 10", "y": "Event < 5"})))
    assert audit == {0: 11, 1: 5, 2: 5}
    counts = dict(rows(splits.split_counts(splits.split_all(truth))))
    assert counts == {"train": 12, "validation": 4, "test": 4}
    for bad in ({}, {"x": ""}):
        with pytest.raises(ValueError, match="no selection"):
            splits.split_all(truth, bad)
    assert rows(quality.bad_event_ids(truth), "_ord") == [(20,)]


def test_an_event_number_is_worked_out_once(spark):
    truth = spark.createDataFrame([(f"Run=1|Event={k}", k) for k in range(10)] + [("Run=1", 10)], "event_id string, _ord long")
    out = splits.split_all(truth, {"odd": "Event % 2 = 1", "large": "Event > 7"})
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract") == 1
    assert rows(out, "split", "_ord") == [("large", 8), ("large", 9), ("odd", 1), ("odd", 3), ("odd", 5), ("odd", 7), ("odd", 9)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_sample_index_is_rank_in_order(spark, partitions):
    truth = spark.createDataFrame(TRUTH[:20], "event_id string, a double, _ord long").repartition(partitions)
    indexed = splits.sample_index(splits.split_all(truth))
    got = {}
    for r in indexed.collect():
        got.setdefault(r["split"], {})[r["idx"]] = r["_ord"]
    assert got["validation"] == {0: 0, 1: 5, 2: 10, 3: 15}
    assert [got["train"][k] for k in range(12)] == [k for k in range(20) if k % 5 > 1]
    assert splits.sample_index(splits.split_all(truth).where("false")).count() == 0


def test_training_table_strict(spark):
    truth = spark.createDataFrame(TRUTH[:2], "event_id string, a double, _ord long")
    features = spark.createDataFrame([("Run=1|Event=0", "string=1|om=1|pmt=0", 2.0)], "event_id string, dom_id string, f double")
    indexed = splits.sample_index(splits.split_all(truth))
    assert rows(samples.training_table(indexed, truth, features, ["f"], ["a"]), "split", "idx") == [("validation", 0)]
    with pytest.raises(samples.EventsWithoutFeaturesError):
        samples.training_table(indexed, truth, features, ["f"], ["a"], strict=True)


PULSES = "event long, sensor int, time long, charge decimal(12,2), _ord long"


def test_pulse_features(spark):
    from decimal import Decimal

    data = [(1, 1, 10, Decimal(1), 0), (1, 1, 20, Decimal(2), 1), (1, 1, 40, Decimal(1), 2), (1, 2, 5, None, 3), (1, 3, None, Decimal(1), 4), (1, 4, 7, Decimal(3), 5)]
    features = [
        Feature("TotalCharge", ("q",)), Feature("TFirstPulse", ("t",)), Feature("TSpread", ("s",)), Feature("ChargeUntilT", ("c",), {"times": [0, 10, 99]}),
        Feature("TimeAtChargePercentile", ("p",), {"percentiles": [0.25, 0.26, 1.0]}),
    ]
    got = pulses.sensor_features(spark.createDataFrame(data, PULSES), features, ["event", "sensor"])
    assert rows(got) == [(1, 1, 4.0, 10.0, 30.0, 1.0, 3.0, 4.0, 10.0, 20.0, 40.0), (1, 4, 3.0, 7.0, 0.0, 3.0, 3.0, 3.0, 7.0, 7.0, 7.0)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
    with pytest.raises(KeyError):
        pulses.sensor_features(got, [Feature("Nope", ("n",))], ["event"])


def test_own_builder(spark):
    df = spark.createDataFrame([(1, 1, 10, None, 0)], PULSES).withColumn("charge", F.lit(2).cast("decimal(12,2)"))
    got = pulses.sensor_features(df, [Feature("Count", ("n",))], ["event"], {"Count": lambda f: [F.count(F.lit(1))]})
    assert rows(got) == [(1, 1)]


def test_shift_without_charge(spark):
    from decimal import Decimal

    df = spark.createDataFrame([(1, 1, 10, Decimal(0), 0), (2, 1, 10, Decimal(1), 1), (2, 1, 20, Decimal(3), 2)], PULSES)
    assert rows(pulses.shift_by_mean_time(df, ["event"]), "event", "time") == sorted([(1, 10), (2, -8), (2, 2)], key=repr)


def test_shift_keeps_events_with_missing_ids(spark):
    from decimal import Decimal

    df = spark.createDataFrame([(None, 1, 10, Decimal(1), 0), (None, 2, 30, Decimal(1), 1), (2, 1, 10, Decimal(1), 2), (3, 1, None, Decimal(1), 3)], PULSES)
    out = pulses.shift_by_mean_time(df, ["event"])
    assert out.columns == df.columns
    assert rows(out, "_ord", "time") == [(0, -10), (1, 10), (2, 0)]


def test_joined_tables_may_not_clash(spark):
    events = spark.createDataFrame([(1, 2.0)], "event long, label double")
    with pytest.raises(ValueError, match="both tables"):
        pulses.attach_labels(events, events, ["event"])
    assert pulses.attach_labels(events.select("event"), events.union(events), ["event"]).count() == 2


def test_exclusion(spark):
    from decimal import Decimal

    df = spark.createDataFrame([(1, 1, t, Decimal(1), t) for t in (0, 5, 9, 10)] + [(1, 2, 5, Decimal(1), 50)], PULSES)
    windows = spark.createDataFrame([(1, 1, 5, 10)], "event long, sensor int, start long, end long")
    assert rows(pulses.exclude_windows(df, windows, ["event", "sensor"]), "sensor", "time") == [(1, 0), (1, 10), (2, 5)]
    assert rows(pulses.exclude_windows(df, windows, ["event", "sensor"], partial=False), "sensor", "time") == [(2, 5)]
    bad = spark.createDataFrame([(2,), (2,)], "sensor int")
    assert pulses.exclude_sensors(df, bad, ["sensor"]).count() == 4


def test_profile_of_unknown_feature(spark):
    with pytest.raises(KeyError):
        geometry.feature_profile(spark.range(1), spark.range(1), "x", ["y"])


def test_duplicates_and_unmapped(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "event_id string")
    assert rows(quality.duplicate_truth(df)) == [("a", 2)]
    long = spark.createDataFrame([(0,), (3,), (3,), (-1,), (None,)], "vector_index int")
    assert rows(quality.unmapped_positions(long, 3)) == sorted([(3, 2), (-1, 1), (None, 1)], key=repr)
