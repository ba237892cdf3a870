"""Mixing, sharding, chat and URL lists: SQL on the given tables, and odd rows."""

import datetime as dt
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import pulseframe.llm.queries as Q
from pulseframe.llm import chat, minhash, mixing, sharding, url_lists
from pulseframe.llm.rows import numbered_rows

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, shard string"
ODD = [
    (1, "a b c", "en", "s1", 5, 7, "x"), (1, "a b c", "en", "s1", 5, 7, "x"), (2, None, None, None, None, None, None), (None, "x y", "en", "s1", 3, 1, "y"), (3, "", "en", "", 0, 0, ""),
    (4, "w " * 50_000, "en", "s2", 100_000, 1, "z"), (5, "ä ö", "de", None, 3, 1, "z"), (6, " \t\n", "de", "s2", 3, 1, "z"),
]


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages"):
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_same_rows_as_sql(spark, sf_dir, duck, name):
    got, want = Q.queries()[name](spark, sf_dir).toArrow(), duck.sql(Q.oracle_sql()[name]).to_arrow_table()
    columns = sorted(want.column_names)
    assert sorted(got.column_names) == columns
    table = lambda t: sorted(map(repr, zip(*[t.column(c).to_pylist() for c in columns])))
    assert table(got) == table(want)


def test_shards_of_odd_rows(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    out = sharding.shard_documents(docs, 3).collect()
    assert len(out) == len(ODD)
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in ODD)
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
        text = next(x[1] for x in ODD if x[0] == r["doc_id"])
        assert r["size"] == len((text or "").encode()) + 16
        assert r["text_crc32"] == (None if text is None else zlib.crc32(text.encode()))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sharding.shard_documents(docs.where("false"), 3).count() == 0


def test_shards_are_balanced_and_contiguous(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same text")).otherwise(F.repeat(F.lit("ab"), (F.col("id") % 97).cast("int"))).alias("text"))
    out = sharding.shard_documents(docs, 7).toPandas()
    sizes = out.groupby("shard")["size"].sum()
    assert len(sizes) == 7 and sizes.max() - sizes.min() <= 2 * out["size"].max()
    ordered = out.sort_values(["text_crc32", "doc_id"])["shard"]
    assert ordered.is_monotonic_increasing


def test_mix_of_odd_rows(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    rows, draws = mixing.mix_sources(docs)
    rows, draws = rows.toPandas(), draws.toPandas()
    assert len(rows) == len(ODD) and rows["row"].is_unique
    assert sorted(rows["size"]) == [0, 0, 0, 1, 2, 3, 3, 50_000]
    assert (draws["size"] > 0).all()
    assert mixing.mix_sources(docs.where("false"))[1].count() == 0
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == len(draws)


def waterfill(sizes, weights, most):
    """Targets by handing on what is over until nobody is above the cap."""
    target, left = dict.fromkeys(sizes, 0.0), float(sum(sizes.values()))
    free = set(sizes)
    while True:
        share = sum(weights[s] for s in free)
        over = {s for s in free if left * weights[s] / share > most * sizes[s]}
        if not over:
            return target | {s: left * weights[s] / share for s in free}
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
        free -= over


def test_mix_follows_targets(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (1 + F.col("id") * 7 % 40).cast("int")).alias("text"),
        F.expr("case when id % 3 = 0 then 'a' when id % 50 = 1 then 'b' when id % 50 = 2 then null else 'c' || id % 4 end").alias("source"),
    )
    rows, draws = mixing.mix_sources(docs)
    rows, draws = rows.toPandas(), draws.toPandas()
    sizes = rows.fillna({"source": "~"}).groupby("source")["size"].sum().to_dict()
    want = waterfill(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes))}, 3)
    targets = rows.fillna({"source": "~"}).groupby("source")["target"].first()
    taken = draws.fillna({"source": "~"}).groupby("source")["size"].sum()
    for s, t in want.items():
        assert targets[s] == pytest.approx(t)
        assert 0 <= t - taken.get(s, 0) <= 40
    assert draws.groupby("row").size().max() <= 3
    assert draws["finish"].max() <= 1
    ordered = draws.sort_values("position")
    assert ordered["finish"].is_monotonic_increasing and (ordered["before"] == ordered["size"].cumsum() - ordered["size"]).all()
    again = mixing.mix_sources(docs.repartition(7))[1].toPandas()
    assert sorted(zip(again["doc_id"], again["copy"], again["position"], strict=True)) == sorted(zip(draws["doc_id"], draws["copy"], draws["position"], strict=True))


TURNS = "conv_id long, turn long, role string, text string, n_turns int"


def test_chat(spark):
    turns = [
        (1, 0, "user", "a", 0), (1, 1, "assistant", "b", 0),
        (2, 0, "user", "a", 0), (2, 1, "assistant", "b", 0), (2, 2, "user", "c", 0),
        (3, 5, "user", "a", 0), (3, 6, "assistant", "b", 0), (3, 7, "user", "c", 0), (3, 7, "user", "c", 0),
        (4, 0, "user", "b", 0), (5, 0, None, None, 0), (5, 1, "user", "", 0), (None, 0, "user", "z", 0), (6, 0, "assistant", "a", 0), (7, 0, "user", "a", 0),
        (8, None, "user", "first", 0), (8, 0, "user", "second", 0),
    ]
    out = {r["conv_id"]: r for r in chat.render_conversations(spark.createDataFrame(turns, TURNS)).collect()}
    assert set(out) == {2, 4, 5, None, 6, 8}
    assert (out[2]["n_turns"], out[2]["n_copies"]) == (3, 2)
    assert out[2]["rendered"] == "<|user|>\na\n<|assistant|>\nb\n<|user|>\nc\n"
    assert out[5]["rendered"] == "<|unknown|>\n\n<|user|>\n\n"
    assert out[8]["rendered"].index("first") < out[8]["rendered"].index("second")
    assert chat.render_conversations(spark.createDataFrame([], TURNS)).count() == 0


def test_long_conversation_is_numbered_over_ranges(spark):
    """One conversation and its prefix, of which the window of a whole conversation would make two tasks."""
    turns = spark.range(3000).selectExpr("explode(array(1, 3, 2)) conv_id", "id turn", "'u' role", "cast(id as string) text").where("conv_id <> 2 or turn < 1200")
    out = chat.prefix_digests(turns.selectExpr("cast(conv_id as long) conv_id", "turn", "role", "text"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_range" in plan
    got = out.toPandas()
    assert (got["k"] == got["turn"] + 1).all() and len(got) == 7200
    assert got.groupby("k")[["a", "b"]].nunique().max().max() == 1 and got["a"].nunique() == 3000
    assert set(got.loc[got["conv_id"] == 2, "n_turns"]) == {1200} and set(got.loc[got["conv_id"] != 2, "n_turns"]) == {3000}


def test_rows_without_conversation_stand_alone(spark):
    """However many there are, they form no group; equal ones are copies, and a longer log takes in its first turn."""
    turns = [(None, k % 7, "user", f"t{k % 7}", 0) for k in range(70)] + [(None, 50, "user", "t3", 0), (4, 0, "user", "t5", 0), (4, 1, "user", "x", 0), (9, 0, "user", "t6", 0)]
    out = chat.render_conversations(spark.createDataFrame(turns, TURNS)).collect()
    got = sorted((r["conv_id"] or 0, r["n_turns"], r["n_copies"], r["rendered"].count("\n")) for r in out)
    # t0 to t4 alone (t3 twice, at two turns), t5 is the beginning of 4, t6 equals 9
    assert got == [(0, 1, 1, 2)] * 4 + [(0, 1, 2, 2), (4, 2, 1, 4), (9, 1, 2, 2)]


def test_whole_documents_with_their_shards(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    out = sharding.sharded_documents(docs, 3)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "size", "text_crc32", "shard", "slot"]
    got = out.collect()
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in got) == Counter((r[0], r[1], r[3]) for r in ODD)
    assert len({(r["shard"], r["slot"]) for r in got}) == len(ODD)


def test_texts_with_equal_crc_lie_apart(spark):
    """plumless and buckeroo have the same CRC-32."""
    assert zlib.crc32(b"plumless") == zlib.crc32(b"buckeroo")
    docs = spark.createDataFrame([(k, "plumless" if k % 2 else "buckeroo") for k in range(40)], "doc_id long, text string")
    out = sharding.shard_documents(docs, 1).orderBy("slot").collect()
    assert len({r["doc_id"] % 2 for r in out[:20]}) == 1


def test_mixed_rows_keep_their_columns(spark):
    """Names that the mix uses itself, maps, and rows that differ in other columns only."""
    docs = spark.range(60).selectExpr("id % 20 as doc_id", "'a b c' as text", "if(id % 3 = 0, 's', 't') as source", "id as _key", "cast(id as string) as _nth", "map('k', id) as _row", "id as _copy", "1 as row")
    once = mixing.mixed_documents(docs).collect()
    assert mixing.mixed_documents(docs).columns == docs.columns
    assert all(r["_nth"] == str(r["_key"]) and r["_row"] == {"k": r["_copy"]} for r in once)
    again = mixing.mixed_documents(docs.repartition(5)).collect()
    assert sorted(map(repr, once)) == sorted(map(repr, again))


def test_stored_rows_go_by_their_place(spark, tmp_path):
    """The same results without a copy of the rows."""
    docs = spark.createDataFrame(ODD, DOCS)
    docs.repartition(3).write.parquet(str(tmp_path / "docs"))
    stored = spark.read.parquet(str(tmp_path / "docs"))
    numbered, row = numbered_rows(stored, "x", stored=True)
    first = sorted(map(repr, numbered.collect()))
    assert len({r[row] for r in numbered.collect()}) == len(ODD) and first == sorted(map(repr, numbered.collect()))
    for f in (lambda d, **k: mixing.mixed_documents(d, **k), lambda d, **k: sharding.sharded_documents(d, 3, **k).drop("slot"), lambda d, **k: minhash.keep_first(d, **k)):
        assert sorted(map(repr, f(stored, stored=True).collect())) == sorted(map(repr, f(docs).collect()))
        assert f(stored.where("false"), stored=True).count() == 0


def test_chat_against_brute_force(spark):
    import random

    rng = random.Random(3)
    convs = {k: tuple((rng.choice("ua"), rng.choice("xy")) for _ in range(rng.randrange(1, 6))) for k in range(150)}
    turns = [(k, n, r, t, 0) for k, c in convs.items() for n, (r, t) in enumerate(c)]
    want = {min(k for k, c in convs.items() if c == whole) for whole in set(convs.values()) if not any(len(o) > len(whole) and o[: len(whole)] == whole for o in convs.values())}
    assert {r["conv_id"] for r in chat.render_conversations(spark.createDataFrame(turns, TURNS)).collect()} == want


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(n)


def test_url_lists(spark):
    entries = [
        ("l", "a.com", day(10), "block"), ("l", "a.com", day(20), "allow"), ("l", "a.com", day(30), "remove"), ("l", "x.a.com", day(12), "allow"), ("m", "x.a.com", day(14), "block"),
        ("l", "b.org/f", day(40), "block"), ("l", "same.net", day(5), "allow"), ("l", "same.net", day(5), "block"), ("l", None, day(1), "block"), ("l", "a.com", None, "block"), ("l", "a.com", day(15), None),
    ]
    captures = [
        (1, "http://a.com/", day(9)), (2, "http://a.com/", day(10)), (3, "https://u:p@A.com:80?q", day(19)), (4, "http://a.com", day(20)), (5, "http://a.com", day(30)), (6, "http://x.a.com", day(12)),
        (7, "http://x.a.com", day(14)), (8, "http://b.org/f/g", day(400)), (9, "http://b.org/g", day(400)), (10, None, day(50)), (11, "nonsense", day(50)), (12, "http://same.net", day(6)), (13, "http://a.com", None),
        (14, "http://aa.com", day(11)), (2, "http://a.com/", day(10)),
    ]
    df = spark.createDataFrame([(*c, "clash") for c in captures], "page_id long, url string, fetched_on date, pattern string")
    out = url_lists.filter_captures(df, spark.createDataFrame(entries, "list_name string, pattern string, dated date, action string")).collect()
    assert len(out) == len(captures)
    got = {r["page_id"]: r["verdict"] for r in out}
    assert got == {1: "none", 2: "block", 3: "block", 4: "allow", 5: "none", 6: "allow", 7: "block", 8: "block", 9: "none", 10: "none", 11: "none", 12: "block", 13: "none", 14: "none"}
    empty = spark.createDataFrame([], "list_name string, pattern string, dated date, action string")
    assert {r["verdict"] for r in url_lists.filter_captures(df, empty).collect()} == {"none"}
    assert url_lists.filter_captures(df.where("false"), empty).count() == 0
