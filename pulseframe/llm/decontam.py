"""Benchmark passages in documents, by the q-gram lemma and banded alignment.

The benchmark is cut into windows, each distinct one indexed once. One pass over the corpus
keeps the stretches of texts that are dense in q-grams of any window, by a bit table of
bounded size; only these stretches meet the windows, a slice of them at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.text import free_names
from pulseframe.sources.staging import stage

#: Characters in a q-gram and in a window of a benchmark item, and from one window to the next.
Q, WINDOW, STEP = 8, 64, 16
#: Edits that a window may have, as a share of its characters. Items of fewer than FUZZY
#: characters may have none, and those of fewer than SHORTEST are no evidence.
EDITS, FUZZY, SHORTEST = 0.08, 32, 16
#: Characters of windows whose index is held at a time, so that what is broadcast stays near 60 MB.
SLICE = 2_000_000
#: Bits of the table of q-grams: 16 for each, within these powers of two (64 MB at most).
FEWEST_BITS, MOST_BITS = 20, 29
#: Characters of a long document that are looked at a time; pieces overlap by more than a region.
CHUNK = 1 << 20
#: Places of q-grams in windows that are held at a time, and candidates aligned at a time.
POSTINGS, ALIGNED = 2_000_000, 20_000
#: Between texts that are searched together: no character.
_GAP = np.full(2 * WINDOW, 0x110000, np.uint32)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BITS = 22


def normalized(text: str) -> str:
    """Lower case, runs of white space as one blank."""
    return " ".join(text.lower().split())


def edit_budget(length: int) -> int:
    """Edits allowed in a window: a share of its length, as long as the lemma still asks for a q-gram; none in a short item."""
    return min(int(EDITS * length), length // Q - 1) if length >= FUZZY else 0


def needed(length: int) -> int:
    """Q-grams that a match has to share with a window."""
    return length + 1 - Q * (edit_budget(length) + 1)


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the q-grams, by doubling."""
    h, p, n = mix(codes.astype(np.uint64)), int(_BASE), 1
    while n < Q:
        h = h[:-n] * np.uint64(p) + h[n:] if len(h) > n else h[:0]
        p, n = p * p % 2**64, 2 * n
    return mix(h)


def mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


@dataclass(frozen=True)
class Index:
    """Windows of benchmark items and the q-grams that occur in them.

    ``grams`` is sorted and distinct; gram k has the postings first[k] to first[k + 1] of
    (window, offset). ``bits`` tells quickly that a q-gram isn't there.
    """

    ids: np.ndarray
    windows: list[np.ndarray]
    bits: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    posted: np.ndarray
    at: np.ndarray
    edits: np.ndarray
    need: np.ndarray

    @staticmethod
    def build(ids: Sequence[int], texts: Sequence[str]) -> Index:
        windows = [codes_of(t) for t in texts]
        hashes = [gram_hashes(w) for w in windows]
        h = np.concatenate(hashes)
        posted = np.repeat(np.arange(len(windows), dtype=np.int32), [len(x) for x in hashes])
        at = np.concatenate([np.arange(len(x), dtype=np.int32) for x in hashes])
        order = np.argsort(h, kind="stable")
        grams, first = np.unique(h[order], return_index=True)
        bits = np.zeros(1 << _BITS, bool)
        bits[(grams >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        edits = np.array([edit_budget(len(w)) for w in windows])
        need = np.array([needed(len(w)) for w in windows])
        return Index(np.array(ids, np.int64), windows, bits, grams, np.append(first, len(h)), posted[order], at[order], edits, need)


def benchmark_windows(benchmark: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """item_id, offset, window: overlapping windows of the normalised items, the last ending with the item."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for item, text in zip(b["item_id"].astype(object).where(b["item_id"].notna(), None), b["text"], strict=True):
                text = normalized(text)
                last = max(len(text) - WINDOW, 0)
                if len(text) >= max(shortest, Q):
                    rows += [(item, k, text[k : k + WINDOW]) for k in sorted({*range(0, last, STEP), last})]
            yield pd.DataFrame(rows, columns=["item_id", "offset", "window"], dtype=object)

    known = benchmark.where("text is not null").select(F.col("item_id").cast("long"), "text")
    return known.mapInPandas(cut, "item_id long, offset long, window string")


def distinct_windows(windows: DataFrame) -> DataFrame:
    """Every window once, numbered (``wid``)."""
    return stage(windows.select("window").distinct().withColumn("wid", F.monotonically_increasing_id()), "windows")


def slices(distinct: DataFrame) -> Iterator[Index]:
    """Indexes over parts of the windows, each bounded by SLICE characters on average; their union is all of them."""
    total = distinct.agg(F.sum(F.length("window"))).first()[0] or 0
    n = -(-total // SLICE)
    for k in range(n):
        part = distinct.where(F.pmod(F.xxhash64("window"), F.lit(n)) == k).toPandas().sort_values("window")
        if len(part):
            yield Index.build(list(part["wid"]), list(part["window"]))


@dataclass(frozen=True)
class Filter:
    """Tells which stretches of a text may hold a window: ``least`` of its q-grams, ``table`` has the bits, in ``span`` places."""

    table: np.ndarray
    power: int
    least: int
    span: int

    def stretches(self, text: str) -> Iterator[tuple[int, str]]:
        """Begin and characters of every stretch of a normalised text, with all that an alignment may reach."""
        codes = codes_of(text)
        for a in range(0, max(len(codes) - Q + 1, 0), CHUNK):
            piece = codes[a : a + CHUNK + 4 * WINDOW]
            slot = gram_hashes(piece) >> np.uint64(64 - self.power)
            p = np.flatnonzero(self.table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1))
            p = p[_crowded(p, self.least, self.span)]
            if not len(p):
                continue
            cuts = np.flatnonzero(np.diff(p) > 4 * WINDOW)
            for x, y in zip(p[np.concatenate([[0], cuts + 1])], p[np.concatenate([cuts, [len(p) - 1]])], strict=True):
                begin, end = max(int(x) - 2 * WINDOW, 0), int(y) + Q + 2 * WINDOW
                # a stretch that begins a piece has its context in the piece before
                begin = max(a + begin - WINDOW, 0) if begin == 0 else a + begin
                yield begin, codes[begin : a + end].tobytes().decode("utf-32-le", "surrogatepass")


def _crowded(p: np.ndarray, least: int, span: int) -> np.ndarray:
    """Which of the sorted places have ``least`` of them within ``span``."""
    dense = np.flatnonzero(p[least - 1 :] - p[: len(p) - least + 1] <= span) if len(p) >= least else p[:0]
    cover = np.zeros(len(p) + 1, np.int64)
    np.add.at(cover, dense, 1)
    np.add.at(cover, dense + least, -1)
    return np.cumsum(cover)[:-1] > 0


def gram_filter(distinct: DataFrame) -> Filter | None:
    """The table over all windows; None if there are none. Its parts are or-ed by Spark, at most 2 ^ (MOST_BITS - 6) rows."""
    lengths = [r[0] for r in distinct.select(F.length("window").alias("n")).distinct().collect()]  # as many as a window has characters
    if not lengths:
        return None
    total = distinct.agg(F.sum(F.length("window"))).first()[0]
    power = min(max((16 * total).bit_length(), FEWEST_BITS), MOST_BITS)

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            slot = np.unique(np.concatenate([np.zeros(0, np.uint64), *[gram_hashes(codes_of(t)) for t in b["window"]]]) >> np.uint64(64 - power))
            word, first = np.unique(slot >> np.uint64(6), return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (slot & np.uint64(63)), first) if len(slot) else slot
            yield pd.DataFrame({"word": word.astype(np.int64), "bits": bits.view(np.int64)})

    found = distinct.mapInPandas(mark, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    table = np.zeros(1 << (power - 6), np.uint64)
    table[found["word"]] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return Filter(table, power, min(map(needed, lengths)), max(n + edit_budget(n) for n in lengths) - Q)


def _postings(codes: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Places of q-grams that are crowded enough, and their numbers in the index."""
    h = gram_hashes(codes)
    p = np.flatnonzero(index.bits[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
    k = np.searchsorted(index.grams, h[p])
    k[k == len(index.grams)] = 0
    real = index.grams[k] == h[p]
    p, k = p[real], k[real]
    # the q-grams of a match lie in one stretch of a window and its edits
    inside = _crowded(p, int(index.need.min()), WINDOW + int(index.edits.max()) - Q)
    return p[inside], k[inside]


def _candidates(p: np.ndarray, k: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Windows and lowest diagonals of the bands that hold enough q-grams.

    A match with e edits keeps to e + 1 adjacent diagonals and shares length + 1 - Q(e + 1)
    q-grams there. Bands are 2(e + 1) wide and overlap by half, so one of them has it whole.
    """
    n = index.first[k + 1] - index.first[k]
    where = np.repeat(index.first[k] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
    w, diagonal = index.posted[where].astype(np.int64), np.repeat(p, n) - index.at[where]
    if not len(w):
        return w, w
    step, need = index.edits + 1, index.need
    # a diagonal lies in the bands that begin at this multiple of the step and at the one before
    band = (diagonal + 4 * WINDOW) // step[w]
    span = int(band.max()) + 2
    keys, counts = np.unique(np.concatenate([w * span + band + 1, w * span + band]), return_counts=True)
    w, band = keys // span, keys % span - 1
    enough = counts >= need[w]
    w, band = w[enough], band[enough]
    return w, band * step[w] - 4 * WINDOW


def _align(codes: np.ndarray, patterns: np.ndarray, low: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of each pattern (a row) within its band of ``width`` diagonals from ``low``, and the diagonal where that ends."""
    diagonals = low[:, None] + np.arange(width)
    slope = np.arange(width, dtype=np.int32)
    over = np.full((len(low), 1), 4 * WINDOW, np.int32)
    cost = np.zeros(diagonals.shape, np.int32)
    for i in range(patterns.shape[1]):
        at = diagonals + i
        same = (at >= 0) & (at < len(codes)) & (codes[np.clip(at, 0, len(codes) - 1)] == patterns[:, i : i + 1])
        # replaced or kept, or left out of the text (from the next diagonal) ...
        cost = np.minimum(cost + ~same, np.concatenate([cost[:, 1:], over], axis=1) + 1)
        # ... or put into it (from the diagonal before, any number of times)
        cost = np.minimum.accumulate(cost - slope, axis=1) + slope
    best = cost.argmin(axis=1)
    return cost[np.arange(len(low)), best], low + best


def find_in(codes: np.ndarray, index: Index) -> set[tuple[int, int, int, int]]:
    """(window, start, end, edits) of every window found; an item without edits counts between word ends only.

    Where a piece's q-grams have too many places in windows it is halved, with an overlap
    longer than a match, so what is held at a time stays bounded.
    """
    found: set[tuple[int, int, int, int]] = set()
    pieces = [(a, min(a + CHUNK + 4 * WINDOW, len(codes))) for a in range(0, max(len(codes) - Q + 1, 0), CHUNK)]
    while pieces:
        a, b = pieces.pop()
        p, k = _postings(codes[a:b], index)
        if b - a > 8 * WINDOW and int((index.first[k + 1] - index.first[k]).sum()) > POSTINGS:
            half = (a + b) // 2
            pieces += [(a, half + 2 * WINDOW), (half, b)]
            continue
        windows, lows = _candidates(p, k, index)
        lengths = np.array([len(index.windows[w]) for w in windows])
        for length in np.unique(lengths):
            e, rows = edit_budget(int(length)), np.flatnonzero(lengths == length)
            for part in (rows[j : j + ALIGNED] for j in range(0, len(rows), ALIGNED)):
                edits, ends = _align(codes[a:b], np.stack([index.windows[w] for w in windows[part]]), lows[part], 2 * (e + 1))
                for w, k_, d in zip(windows[part], edits, ends, strict=True):
                    start, end = a + max(int(d), 0), a + int(d) + int(length)
                    if k_ <= e and (length >= FUZZY or _at_word_ends(codes, start, end)):
                        found.add((int(index.ids[w]), start, end, int(k_)))
    return found


def find_passages(text: str, index: Index) -> list[tuple[int, int, int, int]]:
    """What ``find_in`` finds in one normalised text."""
    return sorted(find_in(codes_of(text), index))


def find_in_each(texts: Sequence[str], index: Index) -> Iterator[tuple[int, int, int, int, int]]:
    """The same for many texts laid end to end with gaps longer than a match: place of the text, window, start, end, edits."""
    parts = [codes_of(t) for t in texts]
    starts = np.cumsum([0, *[len(p) + len(_GAP) for p in parts]])
    for w, start, end, edits in sorted(find_in(np.concatenate([_GAP[:0], *[x for p in parts for x in (p, _GAP)]]), index)):
        # a match may begin some edits before its text
        k = int(np.searchsorted(starts, (start + end) // 2, "right")) - 1
        yield k, w, max(start - int(starts[k]), 0), end - int(starts[k]), edits


def _at_word_ends(codes: np.ndarray, start: int, end: int) -> bool:
    around = [*codes[max(start - 1, 0) : start], *codes[end : end + 1]]
    return not any(c != _GAP[0] and chr(c).isalnum() for c in around)


def passages(docs: DataFrame, keys: Sequence[Column], distinct: DataFrame) -> DataFrame | None:
    """Windows found in ``docs`` (text): the columns ``keys``, wid, start, end, edits; None if there are no windows.

    The corpus is read once; its stretches that may hold a window are staged and searched
    for a slice of the windows at a time.
    """
    bits = gram_filter(distinct)
    if bits is None:
        return None
    context = docs.sparkSession.sparkContext
    shared_bits = context.broadcast(bits)
    rows = docs.where("text is not null").select(*keys, "text")
    names = [c for c in rows.columns if c != "text"]
    kinds = [f"`{c}` {t}" for c, t in rows.dtypes if c != "text"]

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            at = [(k, begin, piece) for k, text in enumerate(b["text"]) for begin, piece in shared_bits.value.stretches(normalized(text))]
            yield b[names].iloc[[k for k, *_ in at]].assign(begin=[x for _, x, _ in at], piece=np.array([x for *_, x in at], dtype=object))

    stretches = stage(rows.mapInPandas(look, ", ".join([*kinds, "begin long", "piece string"])), "stretches")
    schema = ", ".join([*kinds, "wid long", "start long", "end long", "edits long"])
    out = None
    for index in slices(distinct):
        shared = context.broadcast(index)

        def search(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for b in batches:
                begin = b["begin"].to_numpy()
                hits = [(k, w, begin[k] + s, begin[k] + e, n) for k, w, s, e, n in find_in_each(b["piece"], shared.value)]
                yield b[names].iloc[[h[0] for h in hits]].assign(**{c: [h[j] for h in hits] for j, c in enumerate(("wid", "start", "end", "edits"), 1)})

        found = stretches.mapInPandas(search, schema)
        out = found if out is None else out.unionByName(found)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """Benchmark items of which ``docs`` (doc_id, text) hold a passage.

    An item (item_id, text) is cut into overlapping windows; one counts as found where some
    stretch of the text is within its edit budget, so any passage of WINDOW + STEP - 1
    characters with a twelfth of edits is found, and items of fewer characters as a whole;
    those of under FUZZY characters without edits and between word ends only. Texts are
    searched whole. Returns doc_id, item_id, n_windows (places of the item found),
    passage_start, passage_end (hull of the stretches, in the normalised text), edits (of
    the best window), a row for each doc_id and item found; rows of one doc_id count as one
    document. Rows without doc_id, null or empty texts and items and items without item_id
    hold nothing, items under ``shortest`` characters (and any under Q) are no evidence.
    Repeated rows change nothing. Other columns are ignored.
    """
    schema = "doc_id long, item_id long, n_windows long, passage_start long, passage_end long, edits long"
    places = stage(benchmark_windows(benchmark.where("item_id is not null"), shortest), "benchmark")
    distinct = distinct_windows(places)
    found = passages(docs.where("doc_id is not null"), [F.col("doc_id").cast("long").alias("doc_id")], distinct)
    if found is None:
        return docs.sparkSession.createDataFrame([], schema)
    of = places.join(distinct, "window").select("wid", "item_id", "offset")
    return found.join(of, "wid").groupBy("doc_id", "item_id").agg(F.countDistinct("offset").alias("n_windows"), F.min("start").alias("passage_start"), F.max("end").alias("passage_end"), F.min("edits").alias("edits"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """The rows of ``docs`` that hold no passage of the benchmark, as ``contaminated`` finds them, unchanged.

    Rows with null or empty texts stay, and so do all if the benchmark is empty; items
    need no item_id, rows no doc_id. Equal texts share their fate: rows go by two 64-bit
    hashes of the text, a join whose right side has only the texts found.
    """
    distinct = distinct_windows(benchmark_windows(benchmark, shortest))
    text = lambda: [F.xxhash64("text"), F.xxhash64(F.lit("again"), "text")]
    a, b = free_names(docs, "_a", "_b")
    found = passages(docs, [h.alias(n) for h, n in zip(text(), (a, b), strict=True)], distinct)
    if found is None:
        return docs
    hits = stage(found.select(a, b).distinct(), "passages")
    return docs.join(hits, [h == F.col(n) for h, n in zip(text(), (a, b), strict=True)], "left_anti")
