import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import pulseframe.llm.queries as Q
from pulseframe.llm import chroma, decontam

DOCS = "doc_id long, text string, item_id string"


def index_of(items):
    rows = []
    for item, text in items:
        text = decontam.normalized(text)
        last = max(len(text) - decontam.WINDOW, 0)
        rows += [(item, k, text[k : k + decontam.WINDOW]) for k in sorted({*range(0, last, decontam.STEP), last})]
    return decontam.Index.build([r[0] for r in rows], [r[2] for r in rows])


def edits(pattern, text):
    """Least edits of a pattern in any stretch of the text."""
    row = np.arange(len(pattern) + 1)
    best = row[-1]
    for c in text:
        new = np.zeros_like(row)
        for i, p in enumerate(pattern, 1):
            new[i] = min(row[i - 1] + (p != c), row[i] + 1, new[i - 1] + 1)
        row, best = new, min(best, new[-1])
    return best


def test_windows_match_brute_force():
    rng = random.Random(2)
    letters = "abcdefgh "
    items = [(k, "".join(rng.choice(letters) for _ in range(n))) for k, n in enumerate((40, 64, 150, 90))]
    index = index_of(items)
    for trial in range(25):
        text = list(rng.choice(items)[1])
        for _ in range(rng.randrange(0, 12)):
            p = rng.randrange(len(text))
            text[p : p + rng.randrange(2)] = rng.choice(["", "x", "yz"])
        text = decontam.normalized("".join(rng.choice(letters) for _ in range(60)) + "".join(text) + "".join(rng.choice(letters) for _ in range(30 * (trial % 2))))
        want = {int(i) for i, w in zip(index.ids, index.windows, strict=True) if edits([chr(c) for c in w], text) <= decontam.edit_budget(len(w))}
        assert {f[0] for f in decontam.find_passages(text, index)} == want


def test_passages_of_the_benchmark(spark, sf_dir):
    docs, items = (pd.read_parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    want = {(d, i) for d, x in zip(docs["doc_id"], docs["text"], strict=True) for i, y in zip(items["item_id"], items["text"], strict=True) if y in x}
    got = {(r["doc_id"], r["item_id"]) for r in Q.op6_benchmark_passages(spark, sf_dir).collect()}
    assert want and want <= got
    assert len(got) <= len(want) + 3


def test_odd_rows(spark, monkeypatch):
    passage = "the quick brown fox jumps over the lazy dog while forty five wizards quietly vex the jovial quartz sphinx at dawn"
    docs = [(1, None, "x"), (2, "", "x"), (3, f"x {passage.upper()} y", "x"), (4, ("filler " * 30_000) + passage.replace("wizards", "wizzards") + " filler" * 9, "x"), (5, passage[:50], "x"), (6, passage[:100].replace(" ", "\n\t"), "x"), (3, f"x {passage} y", "x"), (None, passage, "x")]
    df = spark.createDataFrame(docs, DOCS)
    bench = spark.createDataFrame([(1, passage), (2, None), (3, ""), (None, passage), (4, "short one"), (5, "filler " * 3)], "item_id long, text string")
    for size in (decontam.SLICE, 70):
        monkeypatch.setattr(decontam, "SLICE", size)
        out = decontam.contaminated(df, bench, shortest=32).collect()
        assert {(r["doc_id"], r["item_id"]) for r in out} == {(3, 1), (4, 1), (6, 1)}
        clean = decontam.keep_clean(df, bench, shortest=32)
        assert clean.columns == df.columns
        assert sorted((r["doc_id"] for r in clean.collect()), key=repr) == [1, 2, 5]
    assert decontam.contaminated(df, bench.where("false")).count() == 0
    assert decontam.keep_clean(df, bench.where("false")).count() == len(docs)
    assert decontam.contaminated(df.where("false"), bench).count() == 0


def test_texts_together_give_what_each_gives():
    rng = random.Random(5)
    items = ["".join(rng.choice("abcdefgh ") for _ in range(64)) for _ in range(20)] + ["sixteen letters!"]
    index = decontam.Index.build(range(21), items)
    texts = [rng.choice(items)[: rng.randrange(8, 65)] + rng.choice(["", " "]) + rng.choice(items) for _ in range(60)] + ["", "x", "sixteen letters!"]
    # bands lie elsewhere, so of equally good places of a window another may be named
    best = lambda hits: {(k, w): min(n for a, b, *_, n in hits if (a, b) == (k, w)) for k, w, *_ in hits}
    together, each = list(decontam.find_in_each(texts, index)), [(k, *x) for k, t in enumerate(texts) for x in decontam.find_passages(t, index)]
    assert len(best(each)) > 60 and best(together) == best(each)
    assert all(0 <= a < b <= len(texts[k]) + 5 for k, _, a, b, _ in together)


def test_short_items_are_found_as_they_are(spark):
    """Between word ends, without edits; the parameter says how short an item still counts."""
    docs = [(1, "So: WHAT is\tgravity? Nobody knows."), (2, "somewhat is gravity? no"), (3, "what is gravitas?"), (4, "what is gravity?"), (5, "x eight ch y"), (6, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, "What is gravity?"), (2, "eight ch"), (None, "eight ch"), (3, "of")], "item_id long, text string")
    found = lambda **more: {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(df, bench, **more).collect()}
    assert found() == {(1, 1), (4, 1)}
    assert found(shortest=1) == {(1, 1), (4, 1), (5, 2)}
    assert sorted(r["doc_id"] for r in decontam.keep_clean(df, bench, shortest=8).collect()) == [2, 3, 6]
    assert sorted(r["doc_id"] for r in decontam.keep_clean(df, bench.where("item_id is null"), shortest=8).collect()) == [1, 2, 3, 4, 6]


def test_items_that_share_a_prompt(spark, monkeypatch):
    """Equal windows are indexed once, and a text full of frequent q-grams is searched in bounded pieces."""
    rng = random.Random(3)
    prompt = "please read the following passage with great care and then answer the question that comes after it in one word "
    items = [(k, prompt + " ".join(rng.choice(["red", "green", "blue", "oak", "elm", "ash"]) + str(rng.randrange(90)) for _ in range(12))) for k in range(1000)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = decontam.benchmark_windows(bench)
    assert windows.count() > 1.4 * decontam.distinct_windows(windows).count()
    docs = spark.createDataFrame([(1, prompt * 60), (2, "nothing of the kind " * 300), (3, items[7][1][len(prompt) :] + " the end")], "doc_id long, text string")
    got = decontam.contaminated(docs, bench).toPandas()
    assert set(got.loc[got["doc_id"] == 1, "item_id"]) == set(range(1000))
    assert 7 in set(got.loc[got["doc_id"] == 3, "item_id"]) and 2 not in set(got["doc_id"])
    monkeypatch.setattr(decontam, "POSTINGS", 500)
    index = decontam.Index.build(range(200), [t[-64:] for _, t in items[:200]])
    text = decontam.normalized(" ".join(t for _, t in items[:40]))
    cut = decontam.find_passages(text, index)
    monkeypatch.setattr(decontam, "POSTINGS", 10**9)
    assert {x[0] for x in cut} == {x[0] for x in decontam.find_passages(text, index)} >= set(range(40))


def test_rows_with_clashing_names_and_repeated_rows(spark):
    passage = "the quick brown fox jumps over the lazy dog while forty five wizards quietly vex the jovial quartz sphinx at dawn"
    df = spark.createDataFrame([(1, "clean", "a", "b"), (1, "clean", "a", "b"), (None, passage, "a", "b"), (2, passage, None, None)], "doc_id long, text string, _a string, _b string")
    bench = spark.createDataFrame([(None, passage)], "item_id long, text string")
    kept = decontam.keep_clean(df, bench)
    assert kept.columns == df.columns and [tuple(r) for r in kept.collect()] == [(1, "clean", "a", "b")] * 2


def test_long_text_in_pieces(monkeypatch):
    passage = "the quick brown fox jumps over the lazy dog while forty five wizards vex"
    index = index_of([(1, passage)])
    monkeypatch.setattr(decontam, "CHUNK", 100)
    for k in range(0, 300, 7):
        assert decontam.find_passages("q " * k + passage + " z" * 90, index)


def tone(classes, silence=0):
    t = np.arange(chroma.RATE // 5) / chroma.RATE
    x = np.concatenate([np.zeros(silence * chroma.HOP), *[np.sin(2 * np.pi * t * 220 * 2 ** (c / 12)) * 8000 for c in classes]]).astype("<i2")
    import io
    import wave

    f = io.BytesIO()
    with wave.open(f, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(chroma.RATE)
        w.writeframes(x.tobytes())
    return f.getvalue()


def test_recordings_align(spark):
    rng = random.Random(4)
    tunes = [[rng.randrange(12) for _ in range(40)] for _ in range(6)]
    recs = [(k, tone(t)) for k, t in enumerate(tunes)] + [(10 + k, tone(t, silence=k)) for k, t in enumerate(tunes)] + [(20, None), (21, b"junk"), (22, tone([])), (23, tone([1])), (None, tone(tunes[0])), (3, tone(tunes[3]))]
    df = spark.createDataFrame([(i, a, "x") for i, a in recs], "rec_id long, audio binary, votes string")
    out = {r["rec_id"]: r for r in chroma.match_recordings(df, F.col("rec_id") < 6).collect()}
    assert set(out) == {*range(6), *range(10, 16), *range(20, 24)}
    assert {(out[10 + k]["query_id"], out[10 + k]["offset"]) for k in range(6)} == {(k, k) for k in range(6)}
    assert all(out[k]["n_links"] == 0 and out[k]["query_id"] is None for k in range(20, 24))
    prints = chroma.fingerprints(df)
    pairs = chroma.align(prints, prints.where("rec_id < 6 or rec_id = 13"))
    assert {(r["query_id"], r["rec_id"], r["offset"]) for r in pairs.collect()} >= {(k, 10 + k, k) for k in range(6)} | {(13, 3, -3)}
    assert chroma.match_recordings(df.where("false"), F.lit(True)).count() == 0
    assert chroma.fingerprints(df).where("n_frames = 0").count() == 4


def test_alignments_match_brute_force(spark):
    """At errors up to the most allowed and overlaps down to the least."""
    rng = np.random.default_rng(7)
    queries = [(k, rng.integers(0, 2**32, n, dtype=np.uint32)) for k, n in enumerate((20, 40, 86, 90, 200, 86))]
    recs = []
    for k, q in queries:
        for error in (0.0, 0.05, 0.1, 0.15, 0.2, 0.22, 0.25):
            for cut in (0, len(q) // 2, len(q) - 31):
                part = q[max(cut, 0) :] ^ np.packbits(rng.random((len(q) - max(cut, 0), 32)) < error, axis=1).view(np.uint32).ravel()
                recs.append((100 + len(recs), np.concatenate([part, rng.integers(0, 2**32, int(rng.integers(0, 80)), dtype=np.uint32)])))

    def brute(a, b):
        least = min(max(min(len(a), len(b)) // 2, 16), 32)
        found = [(n * 32 * (1 - 2 * e), -o, e) for o in range(-len(a), len(b)) for e, n in [chroma._bit_error(a, b, o)] if n >= least and e <= 0.22]
        return -max(found)[1] if found else None

    want = {(i, j, o) for i, a in queries for j, b in recs if (o := brute(a, b)) is not None}
    frame = lambda rows: spark.createDataFrame([(i, bytearray(p.tobytes())) for i, p in rows], "rec_id long, print binary")
    got = chroma.align(frame(recs), frame(queries)).collect()
    assert len(want) > 60 and {(r["query_id"], r["rec_id"], r["offset"]) for r in got} == want
    assert max(r["bit_error"] for r in got) > 0.18


def test_all_partners_of_a_recording_are_named(spark):
    rng = random.Random(6)
    parts = [[rng.randrange(12) for _ in range(40)] for _ in range(3)]
    whole = tone(parts[0] + parts[1] + parts[2])
    recs = [(k + 1, tone(p)) for k, p in enumerate(parts)] + [(7, tone(parts[1])), (10, whole), (11, whole), (12, whole), (13, None)]
    df = spark.createDataFrame(recs, "rec_id long, audio binary")
    out = chroma.match_recordings(df, F.col("rec_id") < 10).collect()
    links = sorted((r["query_id"], r["offset"], r["query_class"], r["n_links"]) for r in out if r["rec_id"] == 10)
    assert [(q, c, n) for q, _, c, n in links] == [(1, 1, 4), (2, 2, 4), (3, 3, 4)]
    assert all(abs(o - 125 * k) <= 1 for k, (_, o, _, _) in enumerate(links))
    rest = {r["rec_id"]: (r["class_id"], r["n_links"], r["query_id"]) for r in out if r["rec_id"] in (2, 7, 11, 12, 13)}
    assert rest == {2: (2, 1, 7), 7: (2, 1, 2), 11: (10, 4, None), 12: (10, 4, None), 13: (13, 0, None)}
    assert len(out) == 10


def test_vectors_alike_sound_alike(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(30, 64)) / 8
    vectors = [(100 * k, [float(x) for x in v]) for k, v in enumerate(base)] + [(100 * k + 1, [float(x) for x in v + rng.normal(size=64) / 100]) for k, v in enumerate(base)]
    recs = Q.vector_recordings(spark.createDataFrame(vectors, "vec_id long, embedding array<float>"))
    out = chroma.match_recordings(recs, F.col("rec_id") % 100 == 0)
    got = {(r["query_id"], r["rec_id"]) for r in out.collect() if r["n_links"]}
    want = {(100 * k, 100 * k + 1) for k in range(30)}
    assert len(got & want) >= 27 and len(got - want) <= 2


def test_replayed_tunes_are_found(spark, sf_dir, monkeypatch):
    """Over the given vectors, with queries in several blocks: each query's later replay, and each replay's query."""
    monkeypatch.setattr(chroma, "BLOCK_BYTES", 500)
    ids = set(pd.read_parquet(f"{sf_dir}/embeddings.parquet")["vec_id"])
    want = {(i - 50, i) for i in ids if i % 100 == 50 and i - 50 in ids}
    got = {(r["query_id"], r["rec_id"]) for r in Q.op7_chroma(spark, sf_dir).where("overlap is not null").collect()}
    assert want and want <= got


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5 and corpus_pipeline.ORACLE_SQL is None
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    one = stages["language"](spark, docs, sf_dir)
    assert one.columns == docs.columns
    assert {r["doc_id"] for r in one.collect()} >= {i for i, t in texts.items() if len(t) > 200 and t.count(" ") > 20}
    items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    three = {r["doc_id"] for r in stages["benchmark_passages"](spark, docs, sf_dir).collect()}
    leaked = {i for i, t in texts.items() if any(x in t for x in items)}
    assert leaked and not leaked & three and len(three) >= len(texts) - len(leaked) - 3
    result = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in result} <= three
    assert {r["shard"] for r in result} <= set(range(40))


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_empty_and_odd_tables(spark, sf_dir, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = spark.createDataFrame([(1, None, None, None, None), (None, "the man", "en", "s", 1), (2, "the man of the house", "en", "s", 1), (2, "the man of the house", "en", "s", 1), (3, "", "en", None, 0)], schema)
    function = dict(corpus_pipeline.STAGES)[stage]
    assert function(spark, odd.where("false"), sf_dir).count() == 0
    out = function(spark, odd, sf_dir)
    assert out.count() >= 1
    if stage != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == odd.columns
