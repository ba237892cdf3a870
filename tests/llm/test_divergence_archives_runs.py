"""Source divergence, WARC archives and periodic runs: odd rows, planted cases and brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import pulseframe.llm.queries as Q
from pulseframe.llm import divergence, periodic, warc

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_divergence(docs, least, top):
    words = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for text, lang, source in docs]
    df, n = defaultdict(Counter), defaultdict(Counter)
    for lang, source, w in words:
        df[lang].update(set(w))
        n[lang, source].update(w)
    out = []
    for lang in {w[0] for w in words}:
        kept = [t for t, k in df[lang].items() if k >= least]
        groups = sorted(s for la, s in n if la == lang)

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(n[lang, s]) for s in groups}
        q = shares(sum((n[lang, s] for s in groups), Counter()))
        for s in groups:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in groups if o != s]
            more = [(t, p[s][t] - q[t]) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", more, top)):
                found = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(found, 1)]
    return sorted(out)


ODD = [
    ("the cat the Dog", "en", "a"), ("cat dog the", "en", "b"), ("THE éÀ cat", "en", None), (None, "en", "a"), ("", "en", "c"), (None, None, None), ("1234 _-[]{}", "de", "x"), ("the cat the Dog", "en", "a"),
    ("internationalisierung internationalisierte internationalis international", "de", "x"), ("internationalisierung internationalisiert", "de", "y"), ("w" * 40 + " " + "w" * 41 + " cat" * 500, "en", "b"), ("end", "en", "a"), ("less", "en", "b"),
]


@pytest.mark.parametrize(("least", "size"), [(1, 1), (2, 60), (2, 1 << 20), (30, 8)])
def test_divergence_of_odd_rows(spark, least, size):
    docs = spark.createDataFrame([(*r, 1, "x") for r in ODD], "text string, lang string, source string, docs long, term string")
    got = divergence.source_divergence(docs, least, 3, slice_bytes=size)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain_divergence(ODD, least, 3)


def test_divergence_in_blocks(spark, monkeypatch):
    rng = random.Random(5)
    docs = [(" ".join("".join(rng.choices("abé", k=rng.randint(1, 3))) for _ in range(rng.randint(0, 30))), rng.choice(["en", "de"]), f"s{rng.randint(0, 9)}") for _ in range(300)]
    monkeypatch.setattr(divergence, "SOURCES", 3)
    monkeypatch.setattr(divergence, "TERMS", 4)
    # tasks compare with the constants of the module as they read it, so blocks are made of the same ones
    monkeypatch.setattr(divergence, "_partial_distances", lambda cells, f=divergence._partial_distances: f(cells, 3))
    frame = spark.createDataFrame(docs, "text string, lang string, source string")
    assert sorted(map(tuple, divergence.source_divergence(frame, 5, 4, slice_bytes=200).collect())) == plain_divergence(docs, 5, 4)


def test_divergence_of_nothing(spark):
    assert divergence.source_divergence(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_pointers_sort_by_eight_bytes():
    rng = random.Random(2)
    terms = [bytes(rng.choices(b"ab", k=rng.randint(1, 30))) for _ in range(3000)]
    letters = b"\0".join(terms)
    starts, lengths = divergence._pointers(np.frombuffer(letters, np.uint8))
    order, fresh = divergence.sort_pointers(letters, starts, lengths)
    assert [bytes(letters[a : a + n]) for a, n in zip(starts, lengths, strict=True)] == terms
    runs = np.cumsum(fresh)
    seen = defaultdict(list)
    for o, r in zip(order, runs, strict=True):
        seen[r].append(int(o))
    assert all(len({terms[o] for o in rows}) == 1 and rows == sorted(rows) for rows in seen.values())
    assert len(seen) == len(set(terms))


FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:capture:7777:1>\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"


def _payloads():
    long = "x" * 3000
    whole = FAKE.format(5, "hello")
    return [
        (1, "http://a/", None), (2, "http://a/", ""), (3, None, "short"), (4, "u\r\nContent-Length: 3", "short"), (5, "u", long), (6, "u", long), (7, "u", long), (7, "u", long), (None, "u", long),
        (8, "u", "WARC/1.1\r\n" * 200), (9, "u", "WARC/1.1\r\n"), (10, "u", "head " + whole + " tail"), (11, "u", whole), (12, "u", whole * 3 + "y" * 2000), (13, "u", FAKE.format(10**7, "far")), (14, "u", FAKE.format(10**17, "farther")),
        (15, "u", "ä" * 700), (16, "u", "ä" * 700), (17, "u", "a\r\n\r\nb"), (18, "u", "WWARC/1.1\rWARC/1.1\r\n" + "é" * 5000 + "WARC/1.1"), (19, "u", FAKE.format(20, "x" * 20) + "WARC/1.1\r\nContent-Length: -5\r\n\r\n"),
    ]


def _captures(spark, rows, parts):
    data = [(i, url, None if p is None else p.encode(), k) for k, (i, url, p) in enumerate(rows)]
    return spark.createDataFrame(data, "id long, url string, payload binary, row long").repartition(parts)


@pytest.mark.parametrize(("parts", "split"), [(1, "128m"), (1, "777"), (3, "5k")])
def test_archives_round_trip(spark, tmp_path, parts, split):
    rows, folder = _payloads(), f"file://{tmp_path}/warc"
    marked = warc.mark_revisits(_captures(spark, rows, parts), "row")
    warc.write_archives(marked, folder)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = warc.read_archives(spark, folder).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    field = lambda r, name: m[1] if (m := re.search(rf"(?:^|\r\n){name}: ([^\r]*)", r["head"])) else None
    by_row = {int(field(r, "WARC-Record-ID").split(":")[-1].rstrip(">")): r for r in got}
    assert len(got) == len(rows) == len(by_row)
    for k, (i, url, payload) in enumerate(rows):
        r, data = by_row[k], (payload or "").encode()
        same = [(i2 if i2 is not None else -1, k2) for k2, (i2, _, p2) in enumerate(rows) if (p2 or "").encode() == data]
        first = max(same)
        assert field(r, "WARC-Payload-Digest") == "sha1:" + hashlib.sha1(data).hexdigest()
        assert field(r, "Payload-Length") == str(len(data))
        if len(data) < 1000 or first[1] == k:
            assert (field(r, "WARC-Type"), bytes(r["payload"]), field(r, "WARC-Refers-To")) == ("response", data, None)
        else:
            assert (field(r, "WARC-Type"), bytes(r["payload"]), field(r, "WARC-Refers-To")) == ("revisit", b"", f"<urn:capture:{first[0]}:{first[1]}>")
    # each record stands where it is said to
    for r in got:
        with open(r["file"].removeprefix("file:").replace("///", "/"), "rb") as f:
            f.seek(r["offset"])
            assert f.read(10 + len(r["head"])) == (warc.MAGIC + r["head"]).encode()


def test_archives_of_nothing_and_damaged(spark, tmp_path):
    folder = f"file://{tmp_path}/none"
    warc.write_archives(warc.mark_revisits(_captures(spark, [], 1), "row"), folder)
    assert warc.read_archives(spark, folder).count() == 0
    (tmp_path / "bad").mkdir()
    record = FAKE.format(5, "hello")
    (tmp_path / "bad" / "a.warc").write_bytes((record + record + "junk" + record).encode())
    with pytest.raises(warc.DamagedArchiveError):
        warc.read_archives(spark, f"file://{tmp_path}/bad")
    (tmp_path / "good").mkdir()
    (tmp_path / "good" / "a.warc").write_bytes((record * 3).encode())
    with pytest.raises(ValueError, match="head"):
        warc.read_archives(spark, f"file://{tmp_path}/good", {"Head": F.octet_length})
    got = warc.read_archives(spark, f"file://{tmp_path}/good", {"bytes": F.octet_length, "start": F.sha1})
    assert [(r["offset"], r["bytes"]) for r in got.orderBy("offset").collect()] == [(k * len(record), 5) for k in range(3)]


def plain_runs(words):
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        a = 0
        while a + q < n:
            b = a
            while b + q < n and words[b] == words[b + q]:
                b += 1
            length = b - a + q
            if b > a and length >= max(6, 4 * q):
                out.setdefault((a, length), q)
            a = b + 1
    return sorted((a, length, q) for (a, length), q in out.items())


def plain_collapse(words, runs):
    dropped = {k for s, n, q in runs for k in range(s + q, s + n)}
    return b" ".join(w for k, w in enumerate(words) if k not in dropped).decode()


def _texts():
    rng = random.Random(11)
    texts = [None, "", " \t\n", "a", "a " * 5, "a " * 6, "a b " * 3, "a b " * 4, "A a " * 4, "a a " * 6, "b " + "a b " * 4 + "a a", "x y z " * 900]
    for _ in range(400):
        texts.append(" ".join(rng.choices("abc"[: rng.randint(1, 3)], k=rng.randint(0, 60))))
    for period in (*range(15, 20), 31, 32, 33, 34, 63, 64, 65, 100, 128, 129, 200, 255, 257):
        for extra in (-1, 0, 1, period // 2):
            unit = rng.choices([f"w{k}" for k in range(max(2, period // rng.choice([1, 3])))], k=period)
            around = lambda: rng.choices("pqrs", k=rng.randint(0, 9))
            texts.append("\n".join(around() + (unit * 6)[: 4 * period + extra] + around()))
            nested = (["a", "b"] * 20 + unit) * 5
            texts.append(" ".join(around() + nested))
    return texts


@pytest.mark.parametrize("size", [50, 5000, 1 << 23])
def test_runs_as_by_brute_force(spark, size):
    texts = _texts()
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)] + [(None, "a " * 7, "x")], "doc_id long, text string, runs string").coalesce(2)
    got = {r["doc_id"]: r for r in periodic.periodic_runs(docs, size).collect()}
    assert len(got) == len(texts) + 1
    assert [tuple(x) for x in got[None]["runs"]] == [(0, 7, 1)]
    for k, t in enumerate(texts):
        words = (t or "").encode().split()
        runs = plain_runs(words)
        assert [tuple(x) for x in got[k]["runs"]] == sorted(runs, key=lambda r: (r[0], r[2])), t
        assert got[k]["collapsed"] == plain_collapse(words, runs)


def test_runs_of_nothing(spark):
    assert periodic.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_of_runs(spark, sf_dir):
    got = {r["doc_id"]: r for r in Q.op13_periodic_runs(spark, sf_dir).collect()}
    docs = pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()
    assert len(got) == len(docs)
    for d in docs:
        words, h = (d["text"] or "").encode().split(), zlib.crc32(str(d["doc_id"]).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
        ids = np.unique(np.array(words, dtype=object), return_inverse=True)[1] if words else []
        runs = sorted(plain_runs(list(ids)), key=lambda r: (r[0], r[2]))
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        want = (len(runs), *((*best, 1000 * best[1] // best[2]) if best else [None] * 4), hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(), hashlib.sha256(plain_collapse(words, runs).encode()).hexdigest())
        assert tuple(got[d["doc_id"]])[1:] == want, d["doc_id"]
    assert sum(r["n_runs"] > 0 for r in got.values()) > 10
