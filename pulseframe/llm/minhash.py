"""Near-duplicate documents by min-max hashing of word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.components import components
from pulseframe.llm.rows import numbered_rows
from pulseframe.llm.shingles import mix64, shingle_sets
from pulseframe.sources.staging import scratch, shuffle_partitions, stage

#: Signature values in a band, and bands. At a similarity of 0.8 a pair shares none with a
#: probability of (1 - 0.8 ** 6) ** 40 = 5e-6.
ROWS, BANDS = 6, 40
PERMUTATIONS = ROWS * BANDS // 2
_rng = np.random.default_rng(20)
_XOR = _rng.integers(0, 2**32, PERMUTATIONS, dtype=np.uint64).astype(np.uint32)
_ODD = (_rng.integers(0, 2**31, PERMUTATIONS, dtype=np.uint64) * 2 + 1).astype(np.uint32)
#: A row of the signature is the minimum or the maximum of one permutation; a band takes
#: its rows from permutations far apart, minima and maxima alike.
_BAND_COLUMNS = np.random.default_rng(21).permutation(2 * PERMUTATIONS).reshape(BANDS, ROWS)
_SALT = mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)).reshape(BANDS, ROWS)
#: Bytes of text that are hashed at a time.
BATCH = 2_000_000
#: Members on each side of a block, columns of its indicator matrices, and members that a task gets at once.
BLOCK, PANEL, PART = 250, 4096, 2000
#: Slots in which shingles are counted to tell rare from frequent ones.
SLOTS = 1 << 18


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Min-max signatures (2 x PERMUTATIONS) of non-empty shingle sets.

    Each permutation is evaluated once and gives two values, its minimum and its maximum.
    """
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    firsts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), 2 * PERMUTATIONS), np.uint32)
    for k in range(PERMUTATIONS):
        h = (x ^ _XOR[k]) * _ODD[k]
        out[:, 2 * k] = np.minimum.reduceat(h, firsts)
        out[:, 2 * k + 1] = np.maximum.reduceat(h, firsts)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """64-bit keys (documents x BANDS) of the bands, different between bands."""
    values = mix64(signature[:, _BAND_COLUMNS].astype(np.uint64) + _SALT)
    keys = np.zeros(values.shape[:2], np.uint64)
    for k in range(ROWS):
        keys = mix64(keys + values[:, :, k])
    return keys.view(np.int64)


def _in_parts(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    a = size = 0
    for k, t in enumerate(texts):
        size += len(t)
        if size > BATCH:
            yield a, k + 1
            a, size = k + 1, 0
    if a < len(texts):
        yield a, len(texts)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, a digest of the shingle set (set_a, set_b) and band keys (none for an empty set)."""

    schema = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            for a, b in _in_parts(texts):
                sets = shingle_sets(texts[a:b], width)
                full = [k for k, s in enumerate(sets) if len(s)]
                bands: list[np.ndarray] = [np.zeros(0, np.int64)] * len(sets)
                if full:
                    for k, keys in zip(full, band_keys(signatures([sets[k] for k in full])), strict=True):
                        bands[k] = keys
                digests = [_digest(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([x for x, _ in digests], pa.int64()),
                        pa.array([x for _, x in digests], pa.int64()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "bands"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def _digest(shingles: np.ndarray) -> tuple[np.int64, np.int64]:
    """Two 64-bit digests of a shingle set; zero for an empty one."""
    if not len(shingles):
        return np.int64(0), np.int64(0)
    return np.bitwise_xor.reduce(shingles).astype(np.int64), mix64(shingles + np.uint64(1)).sum(dtype=np.uint64).astype(np.int64)


def _sets(texts: DataFrame, width: int) -> DataFrame:
    """cid, size and digest of the shingle set as ``sketches`` has them, and the whole set as packed 64-bit hashes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = [t.encode() for t in batch["text"]]
            for a, b in _in_parts(raw):
                sets = shingle_sets(raw[a:b], width)
                digests = [_digest(s) for s in sets]
                yield pd.DataFrame({"cid": batch["cid"].iloc[a:b].array, "n_shingles": list(map(len, sets)), "set_a": [x for x, _ in digests], "set_b": [x for _, x in digests], "shingles": [s.tobytes() for s in sets]})

    return texts.mapInPandas(run, "cid long, n_shingles long, set_a long, set_b long, shingles binary")


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = 0
                if 100 * min(len(s), len(t)) >= percent * max(len(s), len(t)):
                    both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * both >= percent * (len(s) + len(t) - both))
            yield batch.loc[keep, ["a", "b"]]

    held = pairs.join(sets.select(F.col("cid").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("cid").alias("b"), F.col("shingles").alias("y")), "b")
    return held.select("a", "b", "x", "y").mapInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, rounds: int = 2) -> DataFrame:
    """Components of documents (doc_id, text) whose shingle sets have a Jaccard similarity of ``percent``.

    Copies with equal sets become one class, named by its smallest doc_id, so a hot text is
    one row from there on. Classes that share a band are candidates; every link is confirmed
    on whole sets. A band's bucket is not expanded into pairs: first each member is held
    against the bucket's smallest; then, ``rounds`` times, in buckets that still hold several
    components, the members outside the largest against a random member of that. In the end
    what is still apart in one bucket is compared in full, members outside the largest
    component with all others, but for members that a prefix filter shows to have no link;
    so each pair that shares a band is confirmed, refuted or already connected: no candidate
    is dropped.

    Returns one row for each input row: doc_id, n_shingles, component_id (the smallest doc_id
    reachable), kept (doc_id is that). A text of fewer words than ``width`` is one shingle; a
    null text or one without words has none and links with nothing. Rows of one doc_id are
    one node, whatever their texts: they share their component and connect the classes they
    are in. A row without doc_id connects nothing and takes its class's component, or null.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    with scratch(spark) as keep:
        sketched = stage(sketches(docs, width), "sketches")
        key = ["n_shingles", "set_a", "set_b"]
        full = sketched.where("n_shingles > 0")
        classes = stage(full.groupBy(*key).agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "bands"))).alias("m")).select(*key, F.col("m.doc_id").alias("cid"), F.col("m.bands").alias("bands")), "classes")
        rows = classes.where("cid is not null").select("cid", F.explode("bands").alias("bucket"))
        shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("cid").alias("first")).where("n > 1")
        members = stage(rows.join(shared, "bucket").select("bucket", "cid", "first"), "buckets")
        near = members.select("cid").distinct()
        # texts are the most compact form of the sets, so they are what is moved, once
        texts = docs.select(F.col("doc_id").cast("long").alias("cid"), "text").where("text is not null").join(near, "cid").dropDuplicates(["cid", "text"])
        digests = classes.where("cid is not null").select("cid", *key)
        sets = stage(_sets(texts, width).join(digests, ["cid", *key], "left_semi").select("cid", "shingles"), "sets")
        labels = _components(members, sets, percent, rounds)
        named = stage(classes.join(labels.withColumnRenamed("node", "cid"), "cid", "left").select(*key, F.coalesce("component", "cid").alias("component_id")), "named")
        out = sketched.select("doc_id", *key).join(named, key, "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
        result = keep(_one_node_for_each_id(stage(out, "labelled")), "near-duplicates")
    return result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def _one_node_for_each_id(rows: DataFrame) -> DataFrame:
    """Components joined where rows of one doc_id lie in several."""
    apart = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("component_id").alias("a"), F.max("component_id").alias("z")).where("a < z")
    links = stage(rows.join(apart, "doc_id").where("component_id > a").select("a", F.col("component_id").alias("b")).distinct(), "same-ids")
    if links.isEmpty():
        return rows
    joined = components(links).select(F.col("node").alias("component_id"), "component")
    return rows.join(joined, "component_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "component_id").alias("component_id"))


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all left with all right sets, by products of indicator matrices in panels of columns."""
    a, b = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(a, b)
    out = np.zeros((len(left), len(right)), np.int64)
    entries = []
    for values, sets in ((a, left), (b, right)):
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        column = np.searchsorted(both, values)
        column[column == len(both)] = 0
        real = both[column] == values if len(both) else np.zeros(len(values), bool)
        order = np.argsort(column[real], kind="stable")
        entries.append((row[real][order], column[real][order]))
    for k in range(0, len(both), PANEL):
        panels = []
        for (row, column), sets in zip(entries, (left, right), strict=True):
            x, y = np.searchsorted(column, [k, k + PANEL])
            panel = np.zeros((len(sets), PANEL), np.float32)
            panel[row[x:y], column[x:y] - k] = 1
            panels.append(panel)
        out += (panels[0] @ panels[1].T).astype(np.int64)
    return out


def _block_links(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect components within a block, as few as do.

    ``rows``: part (what a task gets at once), kind, g, i, j (the block), own (on the left
    side; a block of i = j is held against itself), cid, comp, shingles.
    """

    def run(part: pd.DataFrame) -> pd.DataFrame:
        found = []
        for (_, _, i, j), block in part.groupby(["kind", "g", "i", "j"]):
            left, right = block[block["own"]].sort_values("cid"), block[block["own"] if i == j and block["own"].all() else ~block["own"]].sort_values("cid")
            if left.empty or right.empty:
                continue
            sets = [[np.frombuffer(x, np.uint64) for x in side["shingles"]] for side in (left, right)]
            both = _shared(*sets)
            total = np.array([len(s) for s in sets[0]])[:, None] + np.array([len(s) for s in sets[1]])
            linked = (100 * both >= percent * (total - both)) & (left["comp"].to_numpy()[:, None] != right["comp"].to_numpy())
            root: dict[int, int] = {}

            def find(x: int, root=root) -> int:
                while root.setdefault(x, x) != x:
                    x = root[x]
                return x

            a, b = left[["cid", "comp"]].to_numpy(), right[["cid", "comp"]].to_numpy()
            for x, y in zip(*np.nonzero(linked), strict=True):
                p, q = find(a[x, 1]), find(b[y, 1])
                if p != q:
                    root[p] = q
                    found.append((a[x, 0], b[y, 0]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return rows.groupBy("part").applyInPandas(run, "a long, b long")


def _slot(shingles: np.ndarray) -> np.ndarray:
    return (shingles & np.uint64(SLOTS - 1)).astype(np.int64)


def contested(held: DataFrame, percent: int) -> DataFrame:
    """Those of ``held`` (cid, comp, shingles) that may be linked with one of another component: cid.

    Two sets that reach the similarity share a shingle within the first n - ceil(n percent)
    + 1 of each, in any common order. Rare shingles go first (counted in SLOTS slots, so
    what is broadcast has one size), so texts that only have a template in common drop out.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(SLOTS, np.int64)
        for b in batches:
            for x in b["shingles"]:
                np.add.at(n, _slot(np.frombuffer(x, np.uint64)), 1)
        used = np.flatnonzero(n)
        yield pd.DataFrame({"slot": used, "n": n[used]})

    found = held.select("shingles").mapInPandas(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()  # SLOTS rows at most
    counts = np.zeros(SLOTS, np.int64)
    counts[found["slot"]] = found["n"]
    shared = held.sparkSession.sparkContext.broadcast(counts)

    def prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            firsts = []
            for x in b["shingles"]:
                s = np.frombuffer(x, np.uint64)
                order = np.lexsort((s, shared.value[_slot(s)]))
                firsts.append(s[order[: len(s) - -(-len(s) * percent // 100) + 1]])
            n = [len(f) for f in firsts]
            yield pd.DataFrame({"token": np.concatenate([np.zeros(0, np.uint64), *firsts]).view(np.int64), "cid": np.repeat(b["cid"].to_numpy(), n), "comp": np.repeat(b["comp"].to_numpy(), n)})

    tokens = stage(held.select("cid", "comp", "shingles").mapInPandas(prefixes, "token long, cid long, comp long"), "prefixes")
    mixed = tokens.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
    return tokens.join(mixed, "token", "left_semi").select("cid").distinct()


def _settle(members: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links between components that still share a bucket, compared in full.

    In each such bucket the members outside its largest component are loose. Loose members
    are held against all of that component, once however many buckets say so, and against
    the bucket's other loose members, on both sides only those that are ``contested``; all
    in blocks of BLOCK by BLOCK, whose pairs are counted by matrix products and never become
    rows.
    """
    cids = stage(members.select("cid").distinct().join(labels, "cid", "left").select("cid", F.coalesce("component", "cid").alias("comp")), "labelled")
    held = members.select("bucket", "cid").join(cids, "cid")
    sizes = held.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("bucket").agg(F.count(F.lit(1)).alias("comps"), F.max(F.struct("n", "comp"))["comp"].alias("main")).where("comps > 1")
    loose = stage(held.join(main, "bucket").where("comp <> main").select("bucket", "cid", "comp", "main", "comps"), "loose")
    # the largest components count as a whole, so that none of their members is left out
    involved = loose.select("comp").union(loose.select(F.col("main").alias("comp"))).distinct()
    open_ = stage(contested(cids.join(involved, "comp", "left_semi").join(sets, "cid"), percent), "contested")
    cids, loose = cids.join(open_, "cid", "left_semi"), loose.join(open_, "cid", "left_semi")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    chunk = lambda n: F.pmod(F.xxhash64("cid"), F.col(n)).cast("int")
    parts = lambda df, name: df.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))
    columns = [F.col(c) for c in ("kind", "g", "i", "j", "own", "cid", "comp")]
    # against the largest component
    outer = loose.select(F.col("main").alias("g"), "cid", "comp").distinct()
    inner = outer.select("g").distinct().join(cids, F.col("g") == F.col("comp"))
    both = parts(outer, "no").join(parts(inner, "ni"), "g")
    left = outer.join(both, "g").withColumns({"kind": F.lit(0), "own": F.lit(True), "i": chunk("no")}).withColumn("j", every("ni"))
    right = inner.join(both, "g").withColumns({"kind": F.lit(0), "own": F.lit(False), "j": chunk("ni")}).withColumn("i", every("no"))
    # among themselves
    alike = loose.where("comps > 2").select(F.col("bucket").alias("g"), "cid", "comp")
    own = alike.join(parts(alike, "n"), "g").withColumn("c", chunk("n")).withColumn("k", every("n"))
    own = own.withColumns({"kind": F.lit(1), "i": F.least("c", "k"), "j": F.greatest("c", "k"), "own": F.col("c") <= F.col("k")})
    blocks = stage(left.select(*columns).union(right.select(*columns)).union(own.select(*columns)), "blocks")
    n = max(-(-blocks.count() // PART), shuffle_partitions(members.sparkSession))
    parted = blocks.withColumn("part", F.pmod(F.xxhash64("kind", "g", "i", "j"), F.lit(n)))
    return stage(_block_links(parted.join(sets, "cid"), percent), "links")


def _components(members: DataFrame, sets: DataFrame, percent: int, rounds: int) -> DataFrame:
    """Components (node, component) of the classes in ``members`` (bucket, cid, first)."""
    tried = stage(members.where("cid <> first").select(F.col("first").alias("a"), F.col("cid").alias("b")).distinct(), "pairs")
    links = stage(_links(tried, sets, percent), "links")
    for k in range(rounds):
        labels = components(links).withColumnRenamed("node", "cid")
        labelled = members.select("bucket", "cid").join(labels, "cid", "left").select("bucket", "cid", F.coalesce("component", "cid").alias("comp"))
        apart = labelled.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("bucket")
        unsettled = stage(labelled.join(apart, "bucket"), "unsettled")
        sizes = unsettled.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64(F.lit(k), "bucket", "cid").alias("h"), "cid")).alias("m"))
        main = sizes.groupBy("bucket").agg(F.max(F.struct("n", "comp", F.col("m.cid").alias("pick"))).alias("m")).select("bucket", F.col("m.comp").alias("main"), F.col("m.pick").alias("pick"))
        outside = unsettled.join(main, "bucket").where("comp <> main")
        new = outside.select(F.least("cid", "pick").alias("a"), F.greatest("cid", "pick").alias("b")).distinct()
        new = stage(new.join(tried, ["a", "b"], "left_anti"), "pairs")
        links = links.union(stage(_links(new, sets, percent), "links"))
        tried = tried.union(new)
    labels = components(links).withColumnRenamed("node", "cid")
    return components(links.union(_settle(members, sets, labels, percent)))


def keep_first(docs: DataFrame, width: int = 5, percent: int = 80, stored: bool = False) -> DataFrame:
    """One row of each group of near duplicates in ``docs``, unchanged: that of the smallest doc_id, one without only if all are.

    Rows are told apart by a number of their own, not by doc_id (see ``numbered_rows`` for
    ``stored``), so rows without doc_id and different texts under one are documents like any
    other; of rows with one doc_id in a group that with the smallest hash of the text stays.
    A row without words is in no group and stays. Any column names may occur.
    """
    numbered, row = numbered_rows(docs, "numbered", stored)
    grouped = near_duplicates(numbered.select(F.col(row).alias("doc_id"), "text"), width, percent).select(F.col("doc_id").alias("_n"), "component_id")
    named = numbered.select(F.col(row).alias("_n"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("_hash"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_hash", "_n"))
    kept = stage(grouped.join(named, "_n").groupBy("component_id").agg(first.alias("m")).select(F.col("m._n").alias(row)), "kept")
    # the rows that stay grow with the documents, so they are never broadcast
    return numbered.join(kept.hint("merge"), row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
