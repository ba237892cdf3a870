"""Language identification, the language model and token counts."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import pulseframe.llm.queries as Q
from pulseframe.llm import langid, pitman_yor, token_counts

DOCS = "doc_id long, text string, lang string, score string, n int"


@pytest.fixture(scope="module")
def documents(sf_dir):
    return pd.read_parquet(f"{sf_dir}/documents.parquet")


def test_language_of_held_out_documents(spark, sf_dir, documents):
    out = Q.op3_language(spark, sf_dir).toPandas().merge(documents, on="doc_id")
    assert len(out) == len(documents)
    assert (out["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in out["doc_id"]]).all()
    held = out[out["held_out"] & out["lang"].notna()]
    assert (held["lang_pred"] == held["lang"]).mean() > 0.97
    assert out["score"].between(0, 1).all()


def test_language_of_odd_rows(spark):
    train = spark.createDataFrame([(k, t, lang, None, 0) for k in range(40) for t, lang in [("the house of the man", "en"), ("das haus von dem mann", "de")]], DOCS)
    model = langid.fit(train)
    odd = spark.createDataFrame([(1, None, "en", "x", 1), (2, "", None, "x", 1), (3, "123 !? ²", None, "x", 1), (4, "the " * 400_000, None, "x", 1), (5, "漢字", None, "x", 1), (None, "dem haus", None, "x", 1)], DOCS)
    out = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(odd, model).collect()}
    assert [out[k][0] for k in (1, 2, 3, 4, None)] == ["und", "und", "und", "en", "de"]
    assert out[5][0] in ("en", "de") and 0 <= out[5][1] <= 1
    assert {r["lang_pred"] for r in langid.predict(odd, None).collect()} == {"und"}
    assert langid.fit(odd.where("lang is null")) is None
    kept = langid.keep_identified(train.unionByName(odd))
    assert kept.columns == train.columns
    assert kept.count() >= 82 and kept.where("text is null or text = ''").count() == 0


def test_weights_are_sparse():
    rng = np.random.default_rng(0)
    rows = [(np.array([*range(y * 5, y * 5 + 5), 20 + rng.integers(1000), langid.DIM]), np.ones(7), y) for y in rng.integers(0, 2, 200)]
    w, _ = langid.ftrl(rows, 2, l1=1.0)
    assert np.count_nonzero(w[:10]) == 20
    assert np.count_nonzero(w[20:1020]) < 200


def test_long_text_in_pieces(monkeypatch):
    text = "abcdefg hij" * 30
    whole = langid.feature_counts(text)
    monkeypatch.setattr(langid, "CHUNK", 50)
    assert langid.feature_counts(text).sum() >= whole.sum()


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({k: k + 32 for k in range(65, 91)})) + [None]


def test_language_model(spark, sf_dir, documents):
    out = Q.op5_language_model(spark, sf_dir).toPandas().set_index("doc_id")
    assert len(out) == len(documents)
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in documents["doc_id"]}
    split = {i: tokens(t) for i, t in zip(documents["doc_id"], documents["text"], strict=True)}
    train = Counter(w for i, ws in split.items() if not held[i] for w in ws)
    total, distinct = sum(train.values()), len(train)
    for i, ws in split.items():
        r = out.loc[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(ws), sum(train[w] > 0 for w in ws), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((train[w] + 1) / (total + distinct + 1)) for w in ws))
    out = out[out["held_out"]]
    assert out["score"].sum() > out["base_score"].sum()
    assert (out["score"] < 0).all()


def seated_scores(train, texts, sweeps, samples, seed=0):
    """log10 probabilities from a plain sampler that seats every customer by itself, with the same discounts and strength."""
    rng = np.random.default_rng(seed)
    pairs = Counter(p for ws in train for p in zip(["<", *ws[:-1]], ws, strict=True))
    contexts = Counter(w for _, w in pairs)
    share = lambda c: min(max(sum(n == 1 for n in c.values()) / max(sum(n == 1 for n in c.values()) + 2 * sum(n == 2 for n in c.values()), 1), 0.1), 0.9)
    d, d0, base = share(pairs), share(contexts), 1 / (len({w for _, w in pairs}) + 1)
    rooms, root = {}, {}

    def root_p(w):
        tables = root.get(w, [])
        total, number = sum(map(sum, root.values())), sum(map(len, root.values()))
        return (sum(tables) - d0 * len(tables) + (1 + d0 * number) * base) / (1 + total)

    def sit(tables, discount, new):
        weight = np.array([n - discount for n in tables] + [new])
        k = rng.choice(len(weight), p=weight / weight.sum())
        if k == len(tables):
            tables.append(0)
        tables[k] += 1
        return tables[k] == 1

    def leave(tables):
        k = rng.choice(len(tables), p=np.array(tables) / sum(tables))
        tables[k] -= 1
        if not tables[k]:
            del tables[k]
            return True
        return False

    def add(u, w):
        room = rooms.setdefault(u, {})
        if sit(room.setdefault(w, []), d, (1 + d * sum(map(len, room.values()))) * root_p(w)):
            sit(root.setdefault(w, []), d0, (1 + d0 * sum(map(len, root.values()))) * base)

    customers = list(pairs.elements())
    for u, w in customers:
        add(u, w)
    p = {}
    asked = {x for ws in texts for x in zip(["<", *ws[:-1]], ws, strict=True)}
    for sweep in range(sweeps + samples):
        for u, w in customers:
            if leave(rooms[u][w]):
                leave(root[w])
            add(u, w)
        if sweep >= sweeps:
            for u, w in asked:
                room = rooms.get(u, {})
                tables = room.get(w, [])
                total, number = sum(map(sum, room.values())), sum(map(len, room.values()))
                p[u, w] = p.get((u, w), 0) + (sum(tables) - d * len(tables) + (1 + d * number) * root_p(w)) / (1 + total) / samples
    return [sum(math.log10(p[x]) for x in zip(["<", *ws[:-1]], ws, strict=True)) for ws in texts]


def test_scores_match_a_plain_seating_sampler(spark):
    rng = np.random.default_rng(11)
    draw = lambda: " ".join(f"w{int(k)}" for k in np.minimum(rng.zipf(1.6, rng.integers(3, 14)), 14))
    texts = [draw() for _ in range(45)]
    docs = spark.createDataFrame([(k, t, k >= 30) for k, t in enumerate(texts)], "doc_id long, text string, held boolean")
    got = {r["doc_id"]: r["score"] / r["n_tokens"] for r in pitman_yor.score_documents(docs, F.col("held"), sweeps=20, samples=40).collect()}
    want = [s / len(tokens(t)) for s, t in zip(seated_scores([tokens(t) for t in texts[:30]], [tokens(t) for t in texts], 20, 40), texts, strict=True)]
    off = np.array([got[k] - w for k, w in enumerate(want)])
    assert np.abs(off).mean() < 0.02 and np.abs(off).max() < 0.08, off
    assert np.corrcoef(want, [got[k] for k in range(45)])[0, 1] > 0.99


def test_hot_words_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(pitman_yor, "HOT", 2)
    w, n = np.arange(1, 6, dtype=np.uint64), np.array([5, 90, 7, 80, 70])
    rows = spark.createDataFrame(pitman_yor._frame([pitman_yor._row("words", 0, -1, w, n)]), pitman_yor.SCHEMA)
    assert list(pitman_yor.hot_words(rows, 6)) == [2, 4]


def test_language_model_sums_to_one(spark):
    """Over one-word texts, all words and the unknown one, P(word) P(end | word) sums with P(end) to at most 1."""
    train = ["a b", "a c", "a", "b a b a b", "c"] * 5
    vocabulary = ["a", "b", "c", "zzz"]
    pairs = [f"{x} {y}" for x in vocabulary for y in vocabulary]
    rows = [(k, t, False) for k, t in enumerate(train)] + [(100 + k, t, True) for k, t in enumerate(["", *vocabulary, *pairs])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held boolean")
    out = {r["doc_id"]: 10 ** r["score"] for r in pitman_yor.score_documents(docs, F.col("held")).collect()}
    p = {t: out[100 + k] for k, t in enumerate(["", *vocabulary, *pairs])}
    # P(x, end) + sum over y of P(x, y, end) / P(end | y) = P(x), so bounds on sums over lengths hold
    assert p[""] + sum(p[w] for w in vocabulary) + sum(p[t] for t in pairs) < 1
    assert p["a"] > p["zzz"] and p["a b"] > p["b c"] and p["b a"] > p["a zzz"]


def test_language_model_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (None, "a b", "x"), (2, "A  b", "x"), (2, "A  b", "x"), (3, "w " * 60_000, "x")], "doc_id long, text string, score string")
    out = pitman_yor.score_documents(docs, F.col("doc_id") == 3).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in out) == [(0, 3), (1, 1), (2, 3), (2, 3), (3, 60_001)]
    assert len({r["score"] for r in out if r["n_tokens"] == 3}) == 1
    assert pitman_yor.score_documents(docs.where("false"), F.lit(False)).count() == 0
    untrained = pitman_yor.score_documents(docs.where("doc_id = 2"), F.lit(True)).first()
    assert (untrained["train_tokens"], untrained["n_known"], untrained["score"], untrained["base_score"]) == (0, 0, 0.0, 0.0)


def test_root_tables_settle(spark):
    """From one table each, the mean tables of words come to that of a long chain."""
    d, n = 0.6, 300
    c = np.random.default_rng(3).integers(1, 60, n)
    words = np.sort(np.random.default_rng(4).integers(0, 2**63, n, dtype=np.uint64)) >> np.uint64(24) << np.uint64(24)
    rng, t, chain = np.random.default_rng(5), np.ones(n), []
    for _ in range(60):
        t = pitman_yor.draw_tables(rng, c, t.sum() - t, np.full(n, 1 / (n + 1)), d, 1.0).astype(float)
        chain.append(t.sum())
    rows = spark.createDataFrame(pitman_yor._frame([pitman_yor._row("multi", 0, 0, pitman_yor.pack(words), c.astype(np.float32))]), pitman_yor.SCHEMA)
    out = pitman_yor.seat_words(rows, True, False, pitman_yor.Level(d, 1.0, 0.0, n, n + 1), 3, 5, 1).where("kind = 'seated'").first()
    assert out["extra"] == c.sum()
    assert out["total"] == pytest.approx(np.mean(chain[20:]), rel=0.08)
    assert pitman_yor.words_seen(rows) == (float((c == 1).sum()), float((c == 2).sum()), float(n))


def test_sweeps_and_samples_are_as_documented():
    import inspect

    given = inspect.signature(pitman_yor.score_documents).parameters
    assert (given["sweeps"].default, given["samples"].default) == (3, 5)


def test_tables_are_drawn_from_their_conditional():
    rng, d, s = np.random.default_rng(1), 0.6, 1.0
    c, others, p = np.full(40_000, 3), np.full(40_000, 2), np.full(40_000, 0.2)
    t = pitman_yor.draw_tables(rng, c, others, p, d, s)
    stirling = {1: (1 - d) * (2 - d), 2: (1 - d) + (2 - 2 * d), 3: 1.0}
    weight = np.array([stirling[k] * 0.2**k * np.prod([s + d * (2 + i) for i in range(k)]) for k in (1, 2, 3)])
    assert np.bincount(t, minlength=4)[1:] / len(t) == pytest.approx(weight / weight.sum(), abs=0.01)
    assert pitman_yor.gammaln(np.array([0.3, 1, 7.5, 40])) == pytest.approx([math.lgamma(x) for x in (0.3, 1, 7.5, 40)], abs=1e-8)


@pytest.mark.parametrize(("others", "p"), [(5.0, 0.01), (30.0, 0.01), (1e9, 0.5)])
def test_multiplied_weights_are_those_of_the_logarithms(others, p):
    """As many tables, on average and in spread, as drawn from the log weights; weights past a double's range too."""
    n = 8000
    for c in (2, 7, 40, pitman_yor.EXACT):
        drawn = pitman_yor.draw_tables(np.random.default_rng(2), np.full(n, c), np.full(n, others), np.full(n, p), 0.7, 1.0)
        weight = pitman_yor._weights(c, np.array([1 / 0.7 + others]), np.array([p]), 0.7)[0]
        share = np.exp(weight - weight.max()) / np.exp(weight - weight.max()).sum()
        tables = np.arange(1, c + 1)
        mean = share @ tables
        assert drawn.mean() == pytest.approx(mean, rel=0.03)
        assert drawn.std() == pytest.approx(np.sqrt(share @ (tables - mean) ** 2), rel=0.1, abs=0.02)


def _conditional(c, discount, r, p, most):
    """Mean and spread of the tables of a dish of ``c`` customers, by the recurrence of Stirling numbers up to ``most`` tables."""
    numbers, t = np.full(most + 1, -np.inf), np.arange(most + 1)
    numbers[0] = 0
    with np.errstate(divide="ignore"):
        for k in range(c):
            numbers[1:] = np.logaddexp(numbers[:-1], np.log(np.maximum(k - discount * t[1:], 0)) + numbers[1:])
            numbers[0] = -np.inf
    weight = numbers[1:] + t[1:] * np.log(discount * p) + np.cumsum(np.log(r + t[1:] - 1))
    share = np.exp(weight - weight.max())
    share /= share.sum()
    mean = share @ t[1:]
    return mean, np.sqrt(share @ (t[1:] - mean) ** 2)


@pytest.mark.parametrize(
    ("c", "discount", "others", "p", "most"),
    [
        (150, 0.3, 1e6, 0.001, 150), (400, 0.3, 1e6, 0.001, 400), (1500, 0.3, 1e6, 0.001, 1500), (1500, 0.6, 1e6, 0.001, 1500), (1500, 0.3, 20, 0.9, 1500), (201, 0.9, 5, 0.3, 201), (1500, 0.1, 10, 0.01, 1500),
        (1500, 0.9, 1e4, 0.01, 1500), (1500, 0.5, 1e7, 0.5, 1500), (20_000, 0.5, 100, 0.2, 3000), (100_000, 0.4, 1000, 0.01, 400), (100_000, 0.7, 10, 1e-4, 300),
    ],
)
def test_many_customers(c, discount, others, p, most):
    """Any number of customers, few or many tables, against the recurrence: the mean within 2 %, the spread within a tenth."""
    n = 20_000
    drawn = pitman_yor.draw_tables(np.random.default_rng(1), np.full(n, c), np.full(n, others), np.full(n, p), discount, 1.0)
    mean, spread = _conditional(c, discount, 1 / discount + others, p, most)
    assert drawn.mean() == pytest.approx(mean, rel=0.02)
    assert drawn.std() == pytest.approx(spread, rel=0.1, abs=0.5)
    assert drawn.min() >= 1 and drawn.max() <= c


def test_fit_matches_dense_tf_idf_and_ftrl(spark):
    """The whole way from texts to probabilities, n-gram by n-gram and weight by weight."""
    import random

    rng = random.Random(5)
    letters = {"de": "aeinrst", "en": "aehotw", "fr": "aeilous"}
    texts = [(k, "".join(rng.choice(letters[lang] + " ") for _ in range(rng.randrange(20, 60))), lang) for k in range(45) for lang in [rng.choice(sorted(letters))]]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    model = langid.fit(docs, max_rows=10**6)
    languages = sorted(letters)

    def number(gram):
        h = ord(gram[0])
        for c in gram[1:]:
            h = (h * 0x01000193 + ord(c)) % 2**32
        return (h ^ (len(gram) - 1)) * (2654435761, 2246822519, 3266489917)[len(gram) - 1] % 2**32 >> 16

    def counts(text):
        text = re.sub(" +", " ", f" {text} ")
        out = np.zeros(langid.DIM)
        for n in (1, 2, 3):
            for k in range(len(text) - n + 1):
                out[number(text[k : k + n])] += 1
        return out

    dense = {k: counts(t) for k, t, _ in texts}
    idf = np.log((1 + len(texts)) / (1 + sum(c > 0 for c in dense.values()))) + 1
    place = {r["doc_id"]: r["p"] for r in docs.select("doc_id", F.xxhash64(F.lit("order"), "doc_id", "text").alias("p")).collect()}
    order = sorted((k for k, *_ in texts), key=place.__getitem__)
    rows = [(np.append(30.0 * idf * dense[k] / dense[k].sum(), 1.0), languages.index(texts[k][2])) for k in order]
    held, train = rows[::5], [r for k, r in enumerate(rows) if k % 5]
    alpha, beta, l1, l2 = 0.5, 0.1, 0.02, 0.01
    z, n = np.zeros((langid.DIM + 1, 3)), np.zeros((langid.DIM + 1, 3))
    leader = lambda: np.where(np.abs(z) > l1, (np.sign(z) * l1 - z) / (l2 + (beta + n**0.5) / alpha), 0)
    for _ in range(4):
        for x, y in train:
            w = leader()
            e = np.exp(x @ w - (x @ w).max())
            g = np.outer(x, e / e.sum() - (np.arange(3) == y))
            z += g - ((n + g**2) ** 0.5 - n**0.5) / alpha * w
            n += g**2
    w = leader()
    logits, y = np.array([x @ w for x, _ in held]), np.array([c for _, c in held])
    loss = lambda t: -np.mean([v[c] / t - np.log(np.exp(v / t).sum()) for v, c in zip(logits, y, strict=True)])
    t = min(np.geomspace(0.5, 20, 241), key=loss)
    assert model.languages == languages
    assert model.bias == pytest.approx(w[-1] / t, abs=1e-9)
    assert model.weights == pytest.approx(30.0 * idf[:, None] * w[:-1] / t, abs=1e-5)
    assert 0 < np.count_nonzero(w[:-1]) < 3 * np.count_nonzero(sum(dense.values()))
    for r in langid.predict(docs, model).collect():
        v = np.append(30.0 * idf * dense[r["doc_id"]] / dense[r["doc_id"]].sum(), 1.0) @ w / t
        p = np.exp(v - v.max()) / np.exp(v - v.max()).sum()
        assert (r["lang_pred"], r["score"]) == (languages[int(p.argmax())], pytest.approx(p.max(), abs=1e-5))


def test_sample_is_bounded_where_rows_repeat(spark, monkeypatch):
    """A third of all rows is one row, and ids say nothing: the rows fitted stay few."""
    docs = spark.range(6000).selectExpr("cast(null as long) doc_id", "if(id % 3 = 0, 'the same text', concat('text ', id)) text", "'en' lang")
    fitted, real = [], langid.ftrl
    monkeypatch.setattr(langid, "ftrl", lambda rows, *a, **k: (fitted.append(len(rows)), real(rows, *a, **k))[1])
    langid.fit(docs, max_rows=200)
    assert 40 < fitted[0] < 300


def test_token_counts(spark, sf_dir, documents):
    from tokenizers import Tokenizer

    out = Q.op8_token_counts(spark, sf_dir).toPandas().set_index("doc_id")
    tokenizer = Tokenizer.from_file(Q.tokenizer_path("word_bpe_49k.json"))
    for i, t in zip(documents["doc_id"], documents["text"], strict=True):
        n = len(tokenizer.encode(t, add_special_tokens=False).ids)
        assert tuple(out.loc[i]) == (len(t.encode()), n, n > 2048)


def test_token_cache(spark, tmp_path, monkeypatch):
    path, cache = Q.tokenizer_path("word_bpe_49k.json"), f"file://{tmp_path}/cache"
    odd = ["don't <|endoftext|>x 1234", "a b\x1cc ́e é é", "", None, "A\tB\n\nC " * 30_000, "漢字 😀 ﬁ"]
    docs = spark.createDataFrame([(k % 5, t, 1) for k, t in enumerate(odd * 2)], "doc_id long, text string, n_tokens int")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    want = sorted((k % 5, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for k, t in enumerate(odd * 2))
    run = lambda: sorted(map(tuple, token_counts.count_tokens(docs, path, cache, token_counts.collapse_white_space, token_counts.count_pieces).collect()))
    assert run() == want
    stored = spark.read.parquet(cache).count()
    assert stored == 5
    assert run() == want
    assert spark.read.parquet(cache).count() == stored
    assert sorted(map(tuple, token_counts.count_tokens(docs, path, f"{cache}2").collect())) == want
    assert token_counts.count_tokens(docs.where("false"), path, cache).count() == 0
    # many misses go another way to the same counts
    monkeypatch.setattr(token_counts, "FEW", 0)
    assert sorted(map(tuple, token_counts.count_tokens(docs, path, f"{cache}3").collect())) == want


def test_full_cache_moves_and_encodes_no_text(spark, tmp_path):
    path, cache = Q.tokenizer_path("word_bpe_49k.json"), f"file://{tmp_path}/cache"
    docs = spark.createDataFrame([(k, f"text number {k % 4}") for k in range(12)], "doc_id long, text string")
    first = sorted(map(tuple, token_counts.count_tokens(docs, path, cache).collect()))

    def never(texts, vocabulary):
        raise AssertionError("encoded")

    again = token_counts.count_tokens(docs, path, cache, count=never)
    assert sorted(map(tuple, again.collect())) == first
    assert "text" not in again._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    with pytest.raises(Exception, match="encoded"):
        token_counts.count_tokens(docs.unionByName(docs.selectExpr("doc_id", "'new' as text")), path, cache, count=never).collect()


def test_vocabulary_is_checked_where_it_is_used():
    path = Q.tokenizer_path("word_bpe_49k.json")
    good = token_counts.Vocabulary.read(path)
    assert token_counts.count_texts(["a b"], good) == [2]
    with pytest.raises(ValueError, match="digest"):
        token_counts.count_texts(["a b"], token_counts.Vocabulary(good.raw + b" ", "0" * 64))


def test_columns_of_the_same_name_in_another_case_are_replaced(spark):
    docs = spark.createDataFrame([("the cat and the dog", "en", 1), ("der Hund und die Katze", "de", 2)] * 20, "text string, lang string, Score int")
    out = langid.predict(docs, langid.fit(docs.withColumn("doc_id", F.lit(1))))
    assert [c.lower() for c in out.columns] == ["text", "lang", "lang_pred", "score"]
    assert out.where("lang_pred is not null and score > 0").count() == 40


def test_more_languages_than_rows_of_the_sample(spark):
    docs = spark.createDataFrame([(k, f"{chr(97 + k % 6) * 8} {chr(98 + k % 6) * 7}", f"l{k % 6}") for k in range(60)], "doc_id long, text string, lang string")
    out = langid.predict(docs, langid.fit(docs, max_rows=3))
    assert out.where("score > 0").count() == 60
