import itertools
import random
import re

import numpy as np
import pytest

from pulseframe.llm import minhash
from pulseframe.llm.components import components
from pulseframe.llm.shingles import shingle_sets, word_hashes

SCHEMA = "doc_id long, text string, n_shingles string, bands int"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({k: k + 32 for k in range(65, 91)}))


def brute(docs, width, percent):
    sets = {}
    for i, t in docs:
        w = words(t)
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(sorted(sets), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def sample(n=160, seed=1):
    rng = random.Random(seed)
    docs = []
    for k in range(n):
        if docs and rng.random() < 0.7:
            w = list(rng.choice(docs)[1].split())
            for _ in range(rng.randrange(0, 5)):
                w[rng.randrange(len(w))] = f"new{rng.randrange(99)}"
        else:
            w = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(12, 60))]
        docs.append((k * 3, rng.choice([" ", "\n\t"]).join(w).upper() if rng.random() < 0.2 else " ".join(w)))
    return docs


@pytest.mark.parametrize("width", [2, 5])
def test_components_match_brute_force(spark, width):
    docs = sample()
    out = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), width=width)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out.collect()} == brute(docs, width, 80)


def test_blocks_match_brute_force(spark, monkeypatch):
    """Without random rounds the blocks have to find the links that the first members miss."""
    docs = sample(seed=5)
    monkeypatch.setattr(minhash, "BLOCK", 3)
    out = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), width=2, rounds=0)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out.collect()} == brute(docs, 2, 80)


def test_rows_of_one_id_are_one_node(spark):
    t, u, v = "a b c d e f", "g h i j k l", "m n o p q r"
    docs = [(1, t), (2, t), (2, u), (3, u), (4, v), (3, ""), (5, None), (None, v)]
    out = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), width=2).collect()
    assert len(out) == len(docs)
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in out} == {(1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (5, 5, True), (None, 4, False)}


def test_kept_rows_with_any_column_names(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "u", 1), (2, "a b c d e f", "v", 2), (3, "x", "w", 3)], "doc_id long, text string, _row string, _at int")
    kept = minhash.keep_first(docs)
    assert kept.columns == docs.columns and sorted(tuple(r) for r in kept.collect()) == [(1, "a b c d e f", "u", 1), (3, "x", "w", 3)]


def test_texts_with_a_template_in_common_are_not_compared(spark, monkeypatch):
    """Thousands of texts that share three fifths with all others land in the same buckets; the prefix filter leaves only real partners."""
    rng = random.Random(9)
    template = [f"t{k}" for k in range(45)]
    docs = [(k, " ".join(template + [f"x{rng.randrange(10**9)}" for _ in range(15)])) for k in range(1500)]
    docs += [(5000 + k, docs[k][1].rsplit(" ", 1)[0] + " other") for k in range(0, 60, 2)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    compared, real = [], minhash._block_links
    monkeypatch.setattr(minhash, "_block_links", lambda rows, percent: (compared.append(rows.select("cid").distinct().count()), real(rows, percent))[1])
    out = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df, width=2).collect()}
    assert out == {k: k for k in range(1500)} | {5000 + k: k for k in range(0, 60, 2)}
    assert compared[0] <= 60


def test_contested_members_include_all_linked_ones(spark):
    docs = sample(seed=8)
    sets = {i: s for i, s in zip([d for d, _ in docs], shingle_sets([t.encode() for _, t in docs], 2), strict=True)}
    held = spark.createDataFrame([(i, i, bytearray(s.tobytes())) for i, s in sets.items()], "cid long, comp long, shingles binary")
    linked = {x for i, j in itertools.combinations(sets, 2) if 100 * (both := len(np.intersect1d(sets[i], sets[j]))) >= 80 * (len(sets[i]) + len(sets[j]) - both) for x in (i, j)}
    got = {r["cid"] for r in minhash.contested(held, 80).collect()}
    assert linked and linked <= got


def test_odd_rows(spark):
    long = "a b " * 40_000
    docs = [(1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one"), (6, "one two"), (7, long), (8, long), (8, long), (9, "é x y"), (10, "É x y"), (None, "one"), (None, None), (11, "one two three")]
    out = minhash.near_duplicates(spark.createDataFrame([(i, t, "clash", 0) for i, t in docs], SCHEMA), width=2).collect()
    assert len(out) == len(docs)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in out if r["doc_id"] is not None}
    assert got == {1: (0, 1, True), 2: (0, 2, True), 3: (0, 3, True), 4: (1, 4, True), 5: (1, 4, False), 6: (1, 6, True), 7: (2, 7, True), 8: (2, 7, False), 9: (1, 9, True), 10: (1, 10, True), 11: (2, 11, True)}
    assert sorted((r["component_id"] or 0, r["kept"]) for r in out if r["doc_id"] is None) == [(0, False), (4, False)]
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_of_each_group_stays(spark):
    docs = spark.createDataFrame([(3, "a b c d e f", "x", 1), (2, "a b c d e f", "y", 2), (2, "a b c d e f", "y", 2), (5, None, None, None)], SCHEMA)
    kept = minhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == [(2, "a b c d e f", "y", 2), (5, None, None, None)]


def test_rows_without_or_with_equal_ids_stay(spark):
    docs = [(None, "only here of all the rows"), (None, "two rows say this much"), (None, "two rows say this much"), (None, "a b c d e f"), (4, "a b c d e f"), (3, "A b c d e f"), (7, "one text of seven here"), (7, "another of seven over there"), (None, None)]
    kept = minhash.keep_first(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(map(repr, [docs[0], docs[1], docs[5], docs[6], docs[7], docs[8]]))


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    errors = []
    for k in range(40):
        a, b = np.sort(pool[:900]), np.sort(np.concatenate([pool[: 300 + 10 * k], pool[1000:1600]]))
        sig = minhash.signatures([a, b])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        errors.append((sig[0] == sig[1]).mean() - true)
    assert abs(np.mean(errors)) < 0.05 and np.std(errors) < 0.05


def test_words_are_split_at_ascii_white_space():
    texts = ["A b c\x0bD", "", "a  b c d "]
    h, bounds = word_hashes([t.encode() for t in texts])
    assert list(bounds) == [0, 3, 3, 6]
    assert list(h[:3]) == list(h[3:])
    assert [len(s) for s in shingle_sets([t.encode() for t in texts], 2)] == [2, 0, 2]


def test_component_of_a_chain_and_a_star(spark):
    edges = [(k + 1, k) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(200, 200)]
    out = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 140)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
