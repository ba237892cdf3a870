import hashlib
import os
import threading
import time
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pulseframe.functions.naming import Feature
from pulseframe.operators.samples import EventsWithoutFeaturesError
from pulseframe.plans import fixtures as fx
from pulseframe.plans.build import Settings, build, convert
from pulseframe.sources import reuse, staging, tables


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert [r[0] for r in tables.nan_to_null(df).collect()] == [1.0, None, None]


def test_read_numbers_rows_by_file_name(spark, tmp_path):
    (tmp_path / "b.csv").write_text("x\n3\n4\n")
    (tmp_path / "a.csv").write_text("x\n1\n2\n")
    (tmp_path / "c.txt").write_text("x\n9\n")
    df = tables.read_table(spark, str(tmp_path), "csv", "x int", suffix=".csv")
    assert [r["x"] for r in df.orderBy("_ord").collect()] == [1, 2, 3, 4]
    assert tables.read_table(spark, str(tmp_path), "csv", "x int", order="x", suffix=".csv").where("_ord = x").count() == 4


def test_absent_column_is_null_and_point_filter_is_pushed(spark, tmp_path):
    wide = spark.createDataFrame([("e1", "d1", 1.0), ("e2", "d1", 2.0)], "event_id string, dom_id string, `p_0.01` double")
    tables.write_tables({"features": wide}, str(tmp_path))
    back = tables.read_features(spark, f"{tmp_path}/features", ["gone", "p_0.01"])
    assert rows(back) == [("e1", "d1", None, 1.0), ("e2", "d1", None, 2.0)]
    plan = back.where("event_id = 'e1'").select("event_id", "`p_0.01`")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_id,e1)" in plan
    assert "ReadSchema: struct<event_id:string,p_0.01:double>" in plan


def test_streams(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "SubEventStream string")
    assert rows(tables.select_streams(df, ["a"])) == [("a",)]


def test_geometry_must_be_there(spark, tmp_path):
    spark.createDataFrame([], "string int, om int, pmt int, x double, y double, z double").write.parquet(f"{tmp_path}/g")
    with pytest.raises(tables.GeometryMissingError):
        tables.read_geometry(spark, f"{tmp_path}/g")


def test_fingerprint_follows_names_bytes_and_settings(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.parquet").write_bytes(b"1")
    first = reuse.fingerprint(spark, str(d), "s")
    assert first == reuse.fingerprint(spark, str(d), "s")
    assert first != reuse.fingerprint(spark, str(d), "t")
    (d / "other.txt").write_bytes(b"1")
    assert first == reuse.fingerprint(spark, str(d), "s")
    (d / "a.parquet").rename(d / "b.parquet")
    renamed = reuse.fingerprint(spark, str(d), "s")
    assert renamed != first
    (d / "b.parquet").write_bytes(b"2")
    assert reuse.fingerprint(spark, str(d), "s") != renamed


def test_large_files_are_known_by_their_bytes(spark, tmp_path, monkeypatch):
    (tmp_path / "a b.parquet").write_bytes(b"first bytes")
    (tmp_path / "c.parquet").write_bytes(b"1")
    digests = lambda: rows(reuse.file_digests(spark, str(tmp_path)), "name", "digest")
    whole, key = digests(), reuse.fingerprint(spark, str(tmp_path), "s")
    monkeypatch.setattr(reuse, "WHOLE", 5)
    assert digests() == whole == [(n, hashlib.sha256(b).hexdigest()) for n, b in (("a b.parquet", b"first bytes"), ("c.parquet", b"1"))]
    os.utime(tmp_path / "a b.parquet", (1, 1))
    assert reuse.fingerprint(spark, str(tmp_path), "s") == key
    (tmp_path / "a b.parquet").write_bytes(b"other bytes")
    os.utime(tmp_path / "a b.parquet", (1, 1))
    assert reuse.fingerprint(spark, str(tmp_path), "s") != key


def test_build_is_reused(spark, tmp_path):
    calls = []

    def make():
        calls.append(1)
        return {"t": spark.range(3)}

    root = str(tmp_path / "out")
    assert reuse.build_or_reuse(spark, root, "k", make)[1] is False
    assert reuse.build_or_reuse(spark, root, "k", make)[1] is True
    assert reuse.build_or_reuse(spark, root, "k", make, most_age=-1)[1] is False
    assert len(calls) == 2


def test_builders_and_readers_at_once(spark, tmp_path):
    """Two builders make one version, a reader keeps what it reads, and nothing half-made is ever seen."""
    root, made, got = str(tmp_path / "out"), [], []

    def make():
        made.append(1)
        time.sleep(1.5)
        return {"t": spark.range(len(made) * 10)}

    def run():
        got.append(reuse.build_or_reuse(spark, root, "k", make))

    both = [threading.Thread(target=run) for _ in range(2)]
    [t.start() for t in both]
    while any(t.is_alive() for t in both):
        assert reuse.published(spark, f"{root}/k") in (None, *[g[0] for g in got]) or spark.read.parquet(f"{reuse.published(spark, f'{root}/k')}/t").count() == 10
    [t.join() for t in both]
    assert len(made) == 1 and sorted(reused for _, reused in got) == [False, True] and got[0][0] == got[1][0]
    reading = spark.read.parquet(f"{got[0][0]}/t")
    newer, reused = reuse.build_or_reuse(spark, root, "k", make, most_age=-1)
    assert not reused and newer != got[0][0]
    assert (reading.count(), spark.read.parquet(f"{newer}/t").count()) == (10, 20)
    assert reuse.published(spark, f"{root}/k") == newer
    reuse.build_or_reuse(spark, root, "k", make, most_age=-1)
    assert not os.path.exists(got[0][0]) and os.path.exists(newer)  # the one before the latest stays


def test_a_failed_or_dead_builder_is_no_hindrance(spark, tmp_path):
    folder = str(tmp_path / "out")

    def fail(path):
        spark.range(3).write.parquet(f"{path}/t")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        reuse.reuse_or_write(spark, folder, fail)
    assert [f for f in os.listdir(folder) if not f.startswith(".")] == []
    (tmp_path / "out" / "_attempt-1").mkdir()
    os.utime(tmp_path / "out" / "_attempt-1", (1, 1))
    (tmp_path / "out" / "_lease").write_text("")
    os.utime(tmp_path / "out" / "_lease", (1, 1))
    path, reused = reuse.reuse_or_write(spark, folder, lambda p: spark.range(3).write.parquet(f"{p}/t"))
    assert not reused and spark.read.parquet(f"{path}/t").count() == 3
    assert sorted(f for f in os.listdir(folder) if not f.startswith(".")) == [os.path.basename(path)]


def test_only_new_files_are_read_for_their_digests(spark, tmp_path):
    folder, store = tmp_path / "in", str(tmp_path / "store")
    folder.mkdir()
    for k in range(2000):
        (folder / f"{k:05d}.txt").write_text(f"{k}")
        os.utime(folder / f"{k:05d}.txt", (1_700_000_000 + k, 1_700_000_000 + k))
    digests = lambda: {r["name"]: r["digest"] for r in reuse.remembered_digests(spark, str(folder), store, ".txt").collect()}
    want = {f"{k:05d}.txt": hashlib.sha256(f"{k}".encode()).hexdigest() for k in range(2000)}
    assert digests() == want
    key = reuse.fingerprint(spark, str(folder), "s", ".txt", store)
    assert key == reuse.fingerprint(spark, str(folder), "s", ".txt")
    # an old file whose bytes change behind its back shows that it isn't read again
    (folder / "00007.txt").write_text("X")
    os.utime(folder / "00007.txt", (1_700_000_007, 1_700_000_007))
    for k in range(2000, 2003):
        (folder / f"{k:05d}.txt").write_text(f"{k}")
        want[f"{k:05d}.txt"] = hashlib.sha256(f"{k}".encode()).hexdigest()
    (folder / "01999.txt").unlink()
    del want["01999.txt"]
    assert digests() == want
    assert reuse.fingerprint(spark, str(folder), "s", ".txt", store) != key
    (folder / "00008.txt").write_text("other")
    assert digests()["00008.txt"] == hashlib.sha256(b"other").hexdigest()


def test_whole_build(spark, sf_dir, tmp_path):
    settings = Settings([Feature("Level", ("level",)), Feature("Share", ("share",), {"percentiles": [0.01, 0.5]})], fx.LABELS)
    args = (spark, fx.inputs(sf_dir), str(tmp_path / "out"), settings, fx.read_all)
    built = build(*args, strict=False)
    counts = {k: built.split(k).count() for k in settings.predicates}
    assert counts["train"] > counts["test"] > 0 and not built.reused
    again = build(*args, strict=False)
    assert again.reused and again.folder == built.folder
    assert rows(built.split("test"), "idx", "event_id", "labels") == rows(again.split("test"), "idx", "event_id", "labels")
    assert built.profile("level").count() == built.table("features").count()
    with pytest.raises(KeyError):
        built.split("nope")
    # other predicates draw other samples from the same tables
    other = build(spark, fx.inputs(sf_dir), str(tmp_path / "out"), replace(settings, predicates={"all": "Event >= 0"}), fx.read_all, strict=False)
    assert other.reused and other.split("all").count() == sum(counts.values())
    with pytest.raises(EventsWithoutFeaturesError):
        build(*args)


def test_build_follows_what_it_reads(spark, tmp_path):
    """Other bytes under an input's path, another recipe or another converter never meet old tables."""
    ids = "Run long, Event long, SubEvent int, SubEventStream string"
    readings = lambda item: spark.createDataFrame([(1, 5, 0, "s", 1, 1, 0, 0, item)], f"{ids}, string int, om int, pmt int, vector_index int, item double")
    inputs = {k: str(tmp_path / k) for k in ("features", "truth", "geometry")}
    readings(2.0).write.parquet(inputs["features"])
    spark.createDataFrame([(1, 5, 0, "s", 7.0)], f"{ids}, energy double").write.parquet(inputs["truth"])
    spark.createDataFrame([(1, 1, 0, 1.0, 2.0, 3.0)], "string int, om int, pmt int, x double, y double, z double").write.parquet(inputs["geometry"])
    settings = Settings([Feature("Level", ("level",))], ["energy"])
    run = lambda s=settings, **more: build(spark, inputs, str(tmp_path / "out"), s, **more)
    first = run()
    assert first.sample("validation", 0).first()["features"] == [[2.0]]
    assert tuple(first.profile("level").first())[2:] == (1.0, 2.0, 3.0, 2.0)
    assert run().reused
    assert not run(replace(settings, recipe="other")).reused
    assert not run(converter=lambda tables_, s: convert(tables_, s)).reused
    readings(3.0).write.mode("overwrite").parquet(inputs["features"])
    second = run()
    assert not second.reused and second.sample("validation", 0).first()["features"] == [[3.0]]
    spark.createDataFrame([], "string int, om int, pmt int, x double, y double, z double").write.mode("overwrite").parquet(inputs["geometry"])
    with pytest.raises(tables.GeometryMissingError):
        run()


def test_stored_lookups_reach_the_scan(spark, sf_dir, tmp_path):
    built = build(spark, fx.inputs(sf_dir), str(tmp_path), Settings(fx.READINGS, fx.LABELS), fx.read_all, strict=False)
    plan = built.sample("train", 3)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(idx,3)" in plan and "(split#" in plan.split("PartitionFilters:")[1]
    assert "EqualTo(event_id,e)" in built.event("e")._jdf.queryExecution().executedPlan().toString()


def test_lookups_draw_no_samples(spark, sf_dir, tmp_path):
    """Samples are drawn once, by the first who asks for them."""
    built = build(spark, fx.inputs(sf_dir), str(tmp_path), Settings(fx.READINGS, fx.LABELS), fx.read_all, strict=False)
    drawn = lambda: [n for n in os.listdir(built.folder.removeprefix("file:")) if n.startswith("training-")]
    assert built.events([f"Run=1|Event=1|SubEvent=0|SubEventStream={fx.STREAM}"]).count() > 0
    assert built.table("truth").count() > 0 and drawn() == []
    assert built.split("train").count() > 0 and len(drawn()) == 1
    assert built.training_folder == built.training_folder and built.manifest.count() > 0


def test_more_files_than_a_number_of_few_bits_holds(spark, tmp_path):
    for k in range(8300):
        (tmp_path / f"{k:05d}.csv").write_text(f"x\n{k}\n")
    df = tables.read_table(spark, str(tmp_path), "csv", "x int", suffix=".csv")
    last = df.select("x", "_ord").orderBy(F.desc("_ord")).limit(2).collect()
    assert [r["x"] for r in last] == [8299, 8298]
    assert df.groupBy().agg(F.countDistinct("_ord")).first()[0] == 8300


def test_files_of_a_task_with_more_than_a_thousand_keep_their_order(spark, tmp_path):
    """Spark names the thousand-and-first c1000, which as text comes before c101."""
    spark.range(1100, numPartitions=1).write.option("maxRecordsPerFile", 1).parquet(f"{tmp_path}/t")
    df = tables.read_table(spark, f"{tmp_path}/t")
    assert [r["id"] for r in df.orderBy("_ord").collect()] == list(range(1100))


def test_only_sparks_own_files_go_by_number(spark):
    job = "0a1b2c3d-0123-4567-89ab-0123456789ab"
    own = [f"/d/part-{n}-{job}{c}.parquet" for n, c in (("00000", "-c000"), ("00000", "-c999"), ("00000", "-c1000"), ("00000", "-c10000"), ("99999", ".c000"), ("100000", ".c000"))]
    others = ["/d/a10.parquet", "/d/a9.parquet", "/d/part-100000.parquet", "/d/part-99999.parquet", "/d/run-c1000.txt", "/d/run-c101.txt"]
    order = lambda files: [r[0] for r in spark.createDataFrame([(f,) for f in files], "file string").orderBy(tables._in_order(F.col("file"))).collect()]
    assert order(own[::-1]) == own
    assert order(others[::-1]) == sorted(others)


def test_rows_of_a_file_read_in_pieces_keep_their_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n" + "".join(f"{k}\n" for k in range(30_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        df = tables.read_table(spark, str(tmp_path), "csv", "x int")
        assert df.rdd.getNumPartitions() > 4
        assert [r["x"] for r in df.orderBy("_ord").collect()] == list(range(30_000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_concatenated_pieces_keep_their_order(spark):
    a = spark.createDataFrame([(1, 5), (2, 4)], "x int, _ord long")
    b = spark.createDataFrame([(3, "y", 0)], "x int, y string, _ord long")
    assert [(r["x"], r["y"]) for r in tables.concatenate([a, b]).orderBy("_ord").collect()] == [(2, None), (1, None), (3, "y")]
    with pytest.raises(ValueError, match="nothing"):
        tables.concatenate([])


def test_scratch_tables_go(spark):
    with staging.scratch(spark) as keep:
        inner = staging.stage(spark.range(3), "inner")
        kept = keep(inner.where("id > 0"), "kept")
        paths = inner.inputFiles()
    assert kept.count() == 2
    assert paths and not os.path.exists(paths[0].removeprefix("file://"))


def test_a_cluster_needs_a_shared_folder():
    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: {"spark.master": "spark://host:7077"}.get(key, default))

    with pytest.raises(staging.NoSharedFolderError):
        staging.shared_folder(Session())
