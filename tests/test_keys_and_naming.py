import pytest
from conftest import rows
from pyspark.sql import functions as F

from pulseframe.functions import keys
from pulseframe.functions.naming import Feature, inverted, q, vector_map


def test_null_part_reads_nan(spark):
    df = spark.createDataFrame([(1, None, 5)], "Run long, Event long, other int")
    assert rows(keys.with_key(df, ["Run", "Event"], "event_id")) == [("Run=1|Event=nan", 5)]


def test_other_id_types_are_refused(spark):
    with pytest.raises(TypeError):
        keys.with_key(spark.createDataFrame([(1.5,)], "Run double"), ["Run"], "event_id")


@pytest.mark.parametrize(
    ("key", "anchored", "first"),
    [("Run=1|Event=7|SubEvent=0", 7, 7), ("SubEvent=3|Event=9", 9, 3), ("Run=1|Event=-2", None, None), ("Run=1", None, None), (None, None, None)],
)
def test_event_number(spark, key, anchored, first):
    df = spark.createDataFrame([(key,)], "k string")
    assert rows(df.select(keys.event_number(F.col("k")), keys.event_number(F.col("k"), anchored=False))) == [(anchored, first)]


def test_unpack(spark):
    df = spark.createDataFrame([("string=12|om=3|pmt=0",)], "k string")
    assert df.select(keys.unpack_ids(F.col("k"))).first()[0] == [12, 3, 0]
    assert df.select(keys.unpack_map(F.col("k"))).first()[0] == {"string": "12", "om": "3", "pmt": "0"}


def test_unpack_of_text_raises(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("string=x",)], "k string").select(keys.unpack_ids(F.col("k"))).collect()


def test_vector_map():
    c, p = Feature("C", ("c",), {"times": [10, 50, 100]}), Feature("P", ("p",), {"percentiles": [0.01, 0.5]})
    assert vector_map([c, p]) == ["c_10", "c_50", "c_100", "p_0.01", "p_0.5"]
    assert vector_map([Feature("T", ("c", "d"), {"k": ["a", "b"], "ignored": [1]})]) == ["c_a", "d_a", "c_b", "d_b"]
    assert vector_map([Feature("E", ("e",), {"k": []}), Feature("F", ("f",))]) == ["f"]
    assert inverted(["a", "b"]) == {"a": 0, "b": 1}
    with pytest.raises(ValueError, match="repeat"):
        vector_map([Feature("A", ("x",)), Feature("B", ("x",))])


def test_dotted_names(spark):
    df = spark.createDataFrame([(1,)], "`p_0.01` int")
    assert df.select(q("p_0.01")).first()[0] == 1
