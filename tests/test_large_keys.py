"""Keys that hold many rows, columns with names of the library's own, own feature kinds, blocks and lookups."""

import random
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pulseframe.functions.naming import Feature
from pulseframe.operators import ordering, pulses, samples, splits
from pulseframe.sources import tables


@pytest.fixture
def many_tasks(spark):
    """Exchanges keep their partitions, small as they are."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange " in line and "Broadcast" not in line and "Reused" not in line]


def _readings(n=3000, seed=1):
    rng = random.Random(seed)
    key = lambda: rng.choice([(None, "s"), (1, None), (1, "s"), (1, "s"), (1, "s"), (2, "s"), (3, "t")])
    return [(*key(), rng.choice([None, *range(200)]), rng.choice([None, rng.randint(-5, 9)]), k) for k in range(n)]


@pytest.mark.parametrize("hot", [1, 400, 10**6])
def test_running_and_whole_over_keys(many_tasks, hot):
    data = _readings()
    df = many_tasks.createDataFrame(data, "a int, b string, time int, v int, _ord long").repartition(5)
    got = ordering.over_keys(df, ["a", "b"], ["time", "_ord"], {"run": ("sum", F.col("v")), "most": ("max", F.col("v")), "least": ("min", F.col("v"))}, {"all": ("sum", F.col("v")), "first": ("min", F.col("time"))}, hot)
    want, groups = [], defaultdict(list)
    for r in data:
        groups[r[:2]].append(r)
    for group in groups.values():
        group.sort(key=lambda r: (r[2] is not None, r[2] or 0, r[4]))
        seen = []
        for r in group:
            seen += [r[3]] if r[3] is not None else []
            every = [x[3] for x in group if x[3] is not None]
            want.append((r[4], *((sum(seen), max(seen), min(seen)) if seen else (None,) * 3), sum(every), min(x[2] for x in group if x[2] is not None)))
    assert rows(got, "_ord", "run", "most", "least", "all", "first") == sorted(want, key=repr)
    if hot == 400:
        place = got.where("a = 1 and b = 's'").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert len(place) > 1 and max(r["count"] for r in place) < 1000


def test_over_keys_of_nothing(spark):
    assert ordering.over_keys(spark.createDataFrame([], "a int, v int"), ["a"], ["v"], {"run": ("sum", F.col("v"))}).count() == 0


def test_one_exchange_serves_windows_and_groups(spark):
    df = spark.createDataFrame([(1, 1, 5, 1.0, 0)], "Event int, string int, time int, charge double, _ord long")
    plan = pulses.sensor_features(df, [Feature("ChargeUntilT", ("c",), {"times": [1]})], ["Event", "string"])
    assert len(exchanges(plan)) == 1


def test_ranks_take_one_exchange_of_rows(many_tasks):
    data = [(random.Random(k).choice(["train", "test", None]), k % 70, f"e{k}", k, k * 2, "x") for k in range(900)]
    # users' columns keep their names
    split = many_tasks.createDataFrame(data, "split string, _ord int, event_id string, position int, before int, _one string").repartition(6)
    got = splits.sample_index(split)
    assert got.columns == [*split.columns, "idx"]
    # one laid the rows out, two sum up counts by range
    assert len(exchanges(got)) == 2
    want, seen = [], defaultdict(int)
    for r in sorted(data, key=lambda r: (r[1], r[2])):
        want.append((*r, seen[r[0]]))
        seen[r[0]] += 1
    assert rows(got) == sorted(want, key=repr)


def test_a_users_own_event_columns_stay(spark):
    ids = [f"Run=1|Event={k}" for k in range(6)]
    for names in (["_Event"], ["Event"], ["_Event", "Event"], ["EVENT", "_event"], ["event", "_event_"]):
        truth = spark.createDataFrame([(i, *[f"{n}{k}" for n in names]) for k, i in enumerate(ids)], ", ".join(["event_id string", *[f"{n} string" for n in names]]))
        for out in (splits.select_split(truth, "Event % 2 = 1"), splits.split_all(truth, {"odd": "Event % 2 = 1"}).drop("split")):
            assert out.columns == truth.columns
            assert rows(out) == [(ids[k], *[f"{n}{k}" for n in names]) for k in (1, 3, 5)]
    with pytest.raises(ValueError, match="matched"):
        splits.with_matches(spark.createDataFrame([("Event=1", 1)], "event_id string, Matched int"))


def _windows_as_by_hand(pulses_, windows):
    return sorted((p for p in pulses_ if not any(p[0] is not None and p[0] == w[0] and None not in w and p[1] is not None and w[1] <= p[1] < w[2] for w in windows)), key=repr)


@pytest.mark.parametrize("hot", [1, 150, 10**6])
def test_windows_that_overlap(many_tasks, hot):
    rng = random.Random(3)
    p = [(rng.choice([None, 1, 1, 1, 2]), rng.choice([None, rng.randint(0, 500)]), k, "x") for k in range(600)]
    w = [(rng.choice([None, 1, 1, 2, 4]), s, s + rng.randint(-3, 25)) for s in (rng.randint(0, 500) for _ in range(60))] + [(1, None, 5), (1, 5, None), (2, 499, 501), (2, 7, 7)]
    df = many_tasks.createDataFrame(p, "sensor int, time int, _ord int, start string")
    windows = many_tasks.createDataFrame(w, "sensor int, start int, end int")
    got = pulses.exclude_windows(df, windows, ["sensor"], hot=hot)
    assert got.columns == df.columns
    assert rows(got) == _windows_as_by_hand(p, w)


def test_each_window_is_looked_at_once(spark):
    """4,000 pulses of a sensor and 4,000 windows over all of them: no join, and a row for each in the sweep."""
    df = spark.range(4000).select(F.lit(1).alias("sensor"), F.col("id").alias("time"))
    windows = spark.range(4000).select(F.lit(1).alias("sensor"), F.lit(0).alias("start"), (F.col("id") % 3999).alias("end"))
    got = pulses.exclude_windows(df, windows, ["sensor"])
    assert sorted(r["time"] for r in got.collect()) == [3998, 3999]
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_own_kind_in_numpy(spark):
    kind = pulses.Vectorised(("t", "q"), 2, lambda f, t, q: np.stack([t * q, q], axis=1), lambda f, sums: [[s[0] / s[1] if s[1] else None, float(len(f.base))] for s in sums])
    df = spark.createDataFrame([(1, 2, 3, 5.0, 0, 0), (1, 4, 1, 5.0, 1, 0), (2, 9, 0, 1.0, 2, 0), (None, 7, 2, 1.0, 3, 0), (3, 1, 1, None, 4, 0)], "Event int, t long, q long, charge double, _ord long, time int")
    got = pulses.sensor_features(df, [Feature("TotalCharge", ("total",)), Feature("Mean", ("mean", "n"))], ["Event"], {"Mean": kind})
    assert got.columns == ["Event", "total", "mean", "n"]
    assert rows(got) == sorted([(1, 10.0, 2.5, 2.0), (2, 1.0, None, 2.0), (None, 1.0, 7.0, 2.0)], key=repr)


def test_matrix_in_blocks(many_tasks):
    ids = [f"string={k}|om=1|pmt=0" for k in range(23)]
    data = [("e", i, float(k), None) for k, i in enumerate(ids)] + [("f", ids[3], 1.0, 2.0), ("f", ids[3], 0.5, None)]
    wide = many_tasks.createDataFrame(data, "event_id string, dom_id string, a double, `b_0.1` double").repartition(4)
    whole = {r["event_id"]: r for r in samples.event_matrices(wide, ["a", "b_0.1"]).collect()}
    for hot in (10, 10**6):
        blocks = samples.matrix_blocks(wide, ["a", "b_0.1"], 5, hot).orderBy("event_id", "block").collect()
        assert [(r["event_id"], r["block"], r["first"], len(r["features"])) for r in blocks] == [("e", k, 5 * k, 5 if k < 4 else 3) for k in range(5)] + [("f", 0, 0, 2)]
        for e, r in whole.items():
            assert [x for b in blocks if b["event_id"] == e for x in b["dom_ids"]] == r["dom_ids"]
            assert [x for b in blocks if b["event_id"] == e for x in b["features"]] == r["features"]


def test_an_event_of_many_sensors_in_blocks(many_tasks):
    """No value holds more than a block of a million sensors' rows."""
    wide = many_tasks.range(1_000_000).selectExpr("'e' as event_id", "concat('string=', id div 1000, '|om=', id % 1000, '|pmt=0') as dom_id", "double(id) as a")
    blocks = samples.matrix_blocks(wide, ["a"], 8192, hot=300_000)
    sizes = blocks.select("block", "first", F.size("features").alias("n")).orderBy("block").collect()
    assert [r["n"] for r in sizes[:-1]] == [8192] * 122 and sum(r["n"] for r in sizes) == 1_000_000
    assert all(r["first"] == 8192 * r["block"] for r in sizes)


def test_lookups_skip_row_groups(spark, tmp_path):
    wide = spark.range(200_000).selectExpr("concat('Event=', id div 10) as event_id", "concat('string=', id % 10) as dom_id", "rand(1) as a")
    tables.write_tables({"features": wide.coalesce(1)}, str(tmp_path), group_bytes=200_000)
    groups = sum(pq.ParquetFile(f).metadata.num_row_groups for f in (tmp_path / "features").glob("*.parquet"))
    assert groups > 10
    back = tables.read_features(spark, f"{tmp_path}/features", ["a"])

    def scanned(ids):
        found = samples.events_features(back, ids)
        count = len(found.collect())
        leaf = found._jdf.queryExecution().executedPlan().collectLeaves().head()
        return count, leaf.metrics().get("numOutputRows").get().value()

    assert scanned([f"Event={k}" for k in range(500, 600)])[0] == 1000
    found, read = scanned(["Event=777", "Event=12345"])
    assert found == 20 and read < 60_000
    assert scanned(["Event=1_"]) == (0, 0)  # inside the range of some group, but in no Bloom filter


def test_manifest_names_one_file_for_an_index(spark, tmp_path):
    training = spark.range(2000).selectExpr("if(id < 1500, 'train', 'test') as split", "if(id < 1500, id, id - 1500) as idx", "concat('e', id) as event_id", "array(named_struct('string', 1, 'om', 1, 'pmt', 1)) as dom_ids", "array(array(1f)) as features", "array(1f) as labels").repartition(5)
    samples.write_training(training, str(tmp_path))
    manifest = samples.read_manifest(spark, str(tmp_path)).orderBy("split", "first").collect()
    assert sum(r["n"] for r in manifest) == 2000
    for r in manifest:
        file = pq.read_table(tmp_path / r["file"], partitioning=None)
        assert file["idx"].to_pylist() == list(range(r["first"], r["last"] + 1)) and len(file) == r["n"]
    assert samples.read_training(spark, str(tmp_path)).count() == 2000
    with pytest.raises(AnalysisException):
        samples.read_manifest(spark, str(tmp_path / "none")).count()


def test_prefix_sums_have_a_range_a_task(many_tasks):
    rows_ = many_tasks.range(2000).select((F.col("id") * 7919 % 2003).alias("t"), (F.col("id") % 5).alias("v")).repartition(5)
    got = ordering.prefix_sums(rows_, [F.col("t")], "v", "sums")
    assert len([x for x in exchanges(got) if "shufflepartitionid" in x]) == 1 and len(exchanges(got)) == 3
    tasks = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(tasks) == 4 and max(r["count"] for r in tasks) < 1000
    at = {r["t"]: (r["position"], r["before"]) for r in got.collect()}
    before = 0
    for k, (t, v) in enumerate(sorted((i * 7919 % 2003, i % 5) for i in range(2000))):
        assert at[t] == (k, before)
        before += v


def test_samples_are_made_once(spark, tmp_path):
    """Ranges are sampled before samples are laid out, which must not make them twice."""
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            made.add(len(b))
            yield b

    kind = "idx long, event_id string, dom_ids array<struct<string:int,om:int,pmt:int>>, features array<array<float>>, labels array<float>, split string"
    one = spark.range(20).selectExpr("id as idx", "string(id) as event_id", "array(named_struct('string', 1, 'om', 2, 'pmt', 3)) as dom_ids", "array(array(float(id))) as features", "array(float(id)) as labels", "'train' as split")
    samples.write_training(one.mapInPandas(counted, kind), str(tmp_path / "t"))
    assert made.value == 20 and samples.read_training(spark, str(tmp_path / "t")).count() == 20
