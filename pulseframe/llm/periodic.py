"""Stretches of words that repeat with a period: found by lag scans and multi-scale minimizers."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.shingles import mix64

#: A run is at least so long, and at least so many times its period.
LEAST, TIMES = 6, 4
#: Periods up to this are found by comparing all words at each lag; longer ones by minimizers, a scale for each doubling.
SHORT = 16
#: Bytes of text whose words are numbered and searched together.
SLICE = 1 << 23
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PIECE = 1 << 16
_REST = re.compile(rb"[^\x20\x09-\x0D]*")
_SPANS = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))


def stretches(ids: np.ndarray, lag: int, least: int) -> list[tuple[int, int]]:
    """Maximal stretches (start, length) in which words ``lag`` apart are equal, at least ``least`` long."""
    equal = np.flatnonzero(ids[lag:] == ids[:-lag]) if len(ids) > lag else np.zeros(0, np.int64)
    if len(equal) < least - lag:
        return []
    cuts = np.flatnonzero(np.diff(equal) != 1)
    firsts, lasts = np.concatenate([[0], cuts + 1]), np.append(cuts, len(equal) - 1)
    lengths = lasts - firsts + 1 + lag
    long = np.flatnonzero(lengths >= least)
    return list(zip(equal[firsts[long]].tolist(), lengths[long].tolist(), strict=True))


def _minima(values: np.ndarray, width: int) -> np.ndarray:
    """The places of the leftmost minima of all windows of ``width``, a power of two; they only ever move on."""
    place, have = np.arange(len(values)), 1
    while have < width:
        values, place = np.minimum(values[:-have], values[have:]), np.where(values[have:] < values[:-have], place[have:], place[:-have])
        have *= 2
    return place[np.concatenate([[True], place[1:] != place[:-1]])]


def _equal_until(ids: np.ndarray, a: int, b: int, step: int) -> int:
    """How many words from places ``a`` and ``b`` on, going by ``step`` (1 or -1), are equal."""
    n, size, total = len(ids), 32, 0
    while True:
        if step > 0:
            size_now = min(size, n - max(a, b))
            same = ids[a : a + size_now] == ids[b : b + size_now]
        else:
            size_now = min(size, min(a, b) + 1)
            same = (ids[a - size_now + 1 : a + 1] == ids[b - size_now + 1 : b + 1])[::-1]
        if size_now <= 0:
            return total
        if not same.all():
            return total + int(np.argmin(same))
        total, a, b, size = total + size_now, a + step * size_now, b + step * size_now, min(2 * size, 1 << 16)


def _seeded(ids: np.ndarray, grams: np.ndarray, scale: int) -> list[tuple[int, int, int]]:
    """Stretches (start, length, lag) of lags from scale / 2 + 1 to ``scale``.

    ``grams`` are hashes of ``scale`` words from each place on. In a run of such a period,
    windows of scale / 2 places a period apart pick the same minimum; a gram of a whole
    period doesn't come back sooner, so these two are neighbours among equal minima.
    """
    places = _minima(grams, scale // 2) if len(grams) >= scale // 2 else np.zeros(0, np.int64)
    if not len(places):
        return []
    places = places[np.argsort(grams[places], kind="stable")]
    lags = np.diff(places)
    pairs = np.flatnonzero((grams[places[1:]] == grams[places[:-1]]) & (lags > scale // 2) & (lags <= scale))
    out: list[tuple[int, int, int]] = []
    reached: dict[int, int] = {}
    for place, lag in sorted(zip(places[pairs].tolist(), lags[pairs].tolist(), strict=True)):
        if place < reached.get(lag, -1):
            continue
        after = _equal_until(ids, place, place + lag, 1)
        if not after:
            continue  # only the hashes were equal
        before = _equal_until(ids, place - 1, place + lag - 1, -1)
        reached[lag] = place + after
        if before + after + lag >= TIMES * lag:
            out.append((place - before, before + after + lag, lag))
    return out


def find_runs(ids: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence of parts, longest first, each followed by a separator unlike all else."""
    ends, longest = np.cumsum(lengths + 1), int(lengths[0])
    # only parts that can hold the shortest run are looked at
    upto = lambda least: int(ends[k - 1]) if (k := int(np.searchsorted(-lengths, -least, side="right"))) else 0
    shortest: dict[tuple[int, int], int] = {}
    for lag in range(1, SHORT + 1):
        least = max(LEAST, TIMES * lag)
        for found in stretches(ids[: upto(least)], lag, least):
            shortest.setdefault(found, lag)  # a multiple of a period gives the same stretch
    grams, scale = mix64(ids[: upto(TIMES * (SHORT + 1))].astype(np.uint64)), 1
    while scale < longest // TIMES:
        grams = grams[: upto(TIMES * (scale + 1))]
        grams = mix64(grams[:-scale] * _STEP + grams[scale:])
        scale *= 2
        if scale > SHORT:
            for start, length, lag in _seeded(ids, grams, scale):
                if lag < shortest.get((start, length), lag + 1):
                    shortest[start, length] = lag
    return sorted((start, length, lag) for (start, length), lag in shortest.items())


def _words(text: bytes, numbers: dict[bytes, int], size: int) -> np.ndarray:
    """Each word's number; a long text is split piece by piece, so its words are never all objects at once."""
    parts, at = [], 0
    while at < len(text):
        end = min(at + size, len(text))
        end = _REST.match(text, end).end()  # to the end of the word that the piece ends in
        words = text[at:end].split()
        parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _collapsed(words: np.ndarray, runs: list[tuple[int, int, int]], names: list[bytes]) -> bytes:
    if runs:
        edges = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            edges[start + period] += 1
            edges[start + length] -= 1
        words = words[np.cumsum(edges)[:-1] == 0]
    pieces = (b" ".join(map(names.__getitem__, words[at : at + _PIECE].tolist())) for at in range(0, len(words), _PIECE))
    return b" ".join(pieces)


def _searched(ids: list[int | None], texts: list[bytes], size: int) -> pa.RecordBatch:
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    docs = [_words(t, numbers, size) for t in texts]
    names = list(numbers)
    # longest first, and a number of its own between two
    order = sorted(range(len(docs)), key=lambda k: -len(docs[k]))
    lengths = np.array([len(docs[k]) for k in order])
    sequence = np.concatenate([part for k, d in enumerate(order) for part in (docs[d], [len(names) + k])])
    starts = np.cumsum(lengths + 1) - lengths - 1
    runs: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    for start, length, period in find_runs(sequence, lengths):
        k = int(np.searchsorted(starts, start, side="right")) - 1
        runs[order[k]].append((start - int(starts[k]), length, period))
    spans = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in sorted(rs, key=lambda r: (r[0], r[2]))] for rs in runs]
    collapsed = pa.array([_collapsed(w, r, names) for w, r in zip(docs, runs, strict=True)], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(spans, _SPANS), collapsed], names=["doc_id", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, slice_bytes: int = SLICE) -> DataFrame:
    """All runs of every whole text of ``docs`` (doc_id, text), and the text with its runs collapsed.

    Words are runs of anything but ASCII white space, as they are, numbered from 0. A run is
    a stretch with smallest period q, at least 6 words and 4 q long, that no neighbouring
    word extends. Collapsing drops every word that some run has after its first q words.

    Returns for each row doc_id, runs (start, length, period; by start, then period) and
    collapsed, the kept words joined by one space.

    Every task works on its own texts and nothing is shuffled. Equal grams are told by 64-bit
    hashes; every run is confirmed word by word. A null text has no words and collapses to
    an empty one, repeated rows give repeated rows, an empty table none; other columns are
    ignored. A slice holds about ``slice_bytes`` of text, or one longer text.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, have = [], [], 0
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = b"" if (view := text.as_buffer()) is None else view.to_pybytes()
                if texts and have + len(raw) > slice_bytes:
                    yield _searched(ids, texts, slice_bytes)
                    ids, texts, have = [], [], 0
                ids.append(i)
                texts.append(raw)
                have += len(raw)
            if ids:
                yield _searched(ids, texts, slice_bytes)

    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(search, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))
