"""Chroma fingerprints of recordings, and recordings that align."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.sources.staging import stage

#: Analysis at this rate, in frames of so many samples, one every so many.
RATE, FRAME, HOP = 4000, 1024, 256
#: Frames that a fingerprint looks at.
SPAN = 12
#: Bits at the end of an integer that votes leave out.
LOOSE = np.uint32(12)
#: Frames that an overlap has at least: half of the shorter print, but LEAST of any and ENOUGH of the longest. Of
#: pairs of unlike 86-frame prints 0.03 % align by chance over 32 frames or more, 0.6 % over 16.
LEAST, ENOUGH = 16, 32
#: Queries in one pass over all recordings, each held against all of them, and bytes of their fingerprints.
BLOCK, BLOCK_BYTES = 2000, 8_000_000
#: Frames that are transformed at a time.
CHUNK = 512
#: Frames of queries whose spectra are held at a time, and frames of recordings times queries that meet them.
QUERY_FRAMES, OWN_FRAMES = 20_000, 1_500_000


def _pitch_classes() -> np.ndarray:
    """FFT bins to pitch classes (semitones above A, octaves folded), 55 to 1760 Hz."""
    hz = np.fft.rfftfreq(FRAME, 1 / RATE)
    out = np.zeros((len(hz), 12))
    used = (hz >= 55) & (hz <= 1760)
    out[np.flatnonzero(used), np.round(12 * np.log2(hz[used] / 55)).astype(int) % 12] = 1
    return out


_BINS, _WINDOW = _pitch_classes(), np.hanning(FRAME)
#: Filters: two areas (frames from, to; classes from, to) whose sums are compared. Half
#: against half in time, half against half in pitch, and middle against edges, over bands
#: of pitch of several widths.
_FILTERS = (
    [((0, 6, p, p + 3), (6, 12, p, p + 3)) for p in (0, 3, 6, 9)]
    + [((0, 6, p, p + 6), (6, 12, p, p + 6)) for p in (0, 6)]
    + [((0, 12, p, p + 2), (0, 12, p + 2, p + 4)) for p in (0, 2, 4, 6, 8)]
    + [((3, 9, p, p + 4), (0, 12, p, p + 4)) for p in (0, 4, 8)]
    + [((0, 4, 0, 12), (4, 8, 0, 12)), ((0, 12, 0, 6), (0, 12, 6, 12))]
)
#: Log ratios between which a filter's two bits change, Gray-coded so that neighbours differ in one bit.
_LEVELS, _GRAY = np.array([-0.3, 0.0, 0.3]), np.array([0, 1, 3, 2], dtype=np.uint32)


def samples(audio: bytes | None) -> np.ndarray:
    """Mono samples at RATE of a 16-bit PCM WAV; none for anything else."""
    try:
        with wave.open(io.BytesIO(audio or b"")) as w:
            if w.getsampwidth() != 2:
                return np.zeros(0)
            x = np.frombuffer(w.readframes(w.getnframes()), "<i2").reshape(-1, w.getnchannels()).mean(axis=1)
            n = int(len(x) * RATE / w.getframerate())
            return x if w.getframerate() == RATE else np.interp(np.arange(n) * w.getframerate() / RATE, np.arange(len(x)), x) if n else np.zeros(0)
    except (wave.Error, EOFError, ValueError, ZeroDivisionError):
        return np.zeros(0)


def chroma(x: np.ndarray) -> np.ndarray:
    """Frames x 12: the share of each pitch class in each frame of the whole recording."""
    n = (len(x) - FRAME) // HOP + 1
    if n < 1:
        return np.zeros((0, 12))
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    energy = np.concatenate([np.abs(np.fft.rfft(frames[k : k + CHUNK] * _WINDOW)) ** 2 @ _BINS for k in range(0, n, CHUNK)])
    return energy / np.maximum(np.linalg.norm(energy, axis=1, keepdims=True), 1e-9)


def fingerprint(frames: np.ndarray) -> np.ndarray:
    """A 32-bit integer for each position of SPAN frames: 16 filters of two bits, from an integral image."""
    n = len(frames) - SPAN + 1
    if n < 1:
        return np.zeros(0, np.uint32)
    image = np.zeros((len(frames) + 1, 13))
    image[1:, 1:] = frames.cumsum(axis=0).cumsum(axis=1)

    def mean(t0: int, t1: int, p0: int, p1: int) -> np.ndarray:
        total = image[t1 : t1 + n, p1] - image[t0 : t0 + n, p1] - image[t1 : t1 + n, p0] + image[t0 : t0 + n, p0]
        return total / ((t1 - t0) * (p1 - p0))

    out = np.zeros(n, np.uint32)
    for one, other in _FILTERS:
        ratio = np.log((0.01 + np.abs(mean(*one))) / (0.01 + np.abs(mean(*other))))
        out = (out << np.uint32(2)) | _GRAY[np.searchsorted(_LEVELS, ratio)]
    return out


def fingerprints(recordings: DataFrame) -> DataFrame:
    """rec_id, n_frames and the packed fingerprint of each recording (rec_id, audio as WAV bytes).

    Null, damaged or too short audio has an empty fingerprint. Recordings are taken whole.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            prints = [fingerprint(chroma(samples(a))) for a in b["audio"]]
            yield pd.DataFrame({"rec_id": b["rec_id"], "n_frames": [len(p) for p in prints], "print": [p.tobytes() for p in prints]})

    return recordings.where("rec_id is not null").select(F.col("rec_id").cast("long"), "audio").mapInPandas(run, "rec_id long, n_frames long, print binary")


def _bit_error(a: np.ndarray, b: np.ndarray, offset: int) -> tuple[float, int]:
    """Share of differing bits where frame k of ``a`` meets frame k + offset of ``b``, and the frames that meet."""
    lo, hi = max(0, -offset), min(len(a), len(b) - offset)
    n = hi - lo
    return (int(np.bitwise_count(a[lo:hi] ^ b[lo + offset : hi + offset]).sum()) / (32 * n), n) if n > 0 else (1.0, 0)


def _signs(prints: list[np.ndarray]) -> np.ndarray:
    """Bits of prints as 1 and -1 (32 x prints x frames), and 0 past a print's end."""
    out = np.zeros((32, len(prints), max(map(len, prints))), np.float32)
    for k, p in enumerate(prints):
        out[:, k, : len(p)] = ((p >> np.arange(32, dtype=np.uint32)[:, None]) & 1) * np.float32(2) - 1
    return out


def _spectra(prints: list[np.ndarray], n: int) -> np.ndarray:
    """Frequencies x prints x 32, of ``n`` frames."""
    return np.ascontiguousarray(np.fft.rfft(_signs(prints), n, axis=2).transpose(2, 1, 0))


def _fast_length(n: int) -> int:
    """The least 2^a 3^b 5^c that is at least ``n``."""
    fives = [5**c * 3**b for b in range(12) for c in range(9)]
    return min(x << max(0, (-(-n // x) - 1).bit_length()) for x in fives)


def _of_like_length(prints: list[np.ndarray], most: int) -> Iterator[np.ndarray]:
    """Places of prints in groups of at most ``most`` frames altogether (or one print), whose lengths differ by a tenth at most."""
    lengths = np.array([len(p) for p in prints], np.int64)
    order, a = np.argsort(lengths, kind="stable"), 0
    for k in range(1, len(order) + 1):
        if k == len(order) or 10 * lengths[order[k]] > 11 * lengths[order[a]] or (k + 1 - a) * lengths[order[k]] > most:
            yield order[a:k]
            a = k


def best_offsets(own: list[np.ndarray], queries: list[np.ndarray], most_errors: float, least_frames: int, enough_frames: int) -> Iterator[tuple[int, int, int]]:
    """Places in ``own`` and ``queries`` of all pairs that align, and the offset where most bits are equal, less those that differ.

    A pair's histogram has a bar for every offset, the equal less the different bits of all
    frames that meet there, counted by Fourier transforms: nothing has to agree exactly for
    an offset to count.
    """
    share = 32 * (1 - 2 * most_errors)
    for qs in _of_like_length(queries, QUERY_FRAMES):
        held = [queries[j] for j in qs]
        q_len = np.array([len(p) for p in held])
        spectra: dict[int, np.ndarray] = {}
        for rs in _of_like_length(own, max(OWN_FRAMES // len(qs), 1)):
            mine = [own[i] for i in rs]
            r_len = np.array([len(p) for p in mine])
            if min(q_len[-1], r_len[-1]) < least_frames:
                continue
            least = int(np.clip(min(q_len[0], r_len[0]) // 2, least_frames, enough_frames))
            # shorter than both together: only overlaps of too few frames meet others
            n = _fast_length(int(q_len[-1] + r_len[-1]) - least)
            if n not in spectra:
                spectra = {n: np.ascontiguousarray(np.conj(_spectra(held, n)).transpose(0, 2, 1))}
            offsets = np.arange(-int(q_len[-1] - least), int(r_len[-1] - least) + 1)
            equal = np.fft.irfft(_spectra(mine, n) @ spectra[n], n, axis=0)
            slack = 0.5 + 1e-5 * 32 * min(q_len[-1], r_len[-1])
            fewest = np.minimum(q_len[0], r_len[0] - offsets) - np.maximum(0, -offsets)
            floor = (share * np.maximum(fewest, least) - slack).astype(np.float32)
            at, i, j = np.concatenate([np.stack(np.nonzero(equal[offsets[part] % n] >= floor[part, None, None])) + [[part.start], [0], [0]] for part in (slice(k, k + 32) for k in range(0, len(offsets), 32))], axis=1)
            o = offsets[at]
            frames = np.minimum(q_len[j], r_len[i] - o) - np.maximum(0, -o)
            value = np.rint(equal[o % n, i, j])
            good = (frames >= np.clip(np.minimum(q_len[j], r_len[i]) // 2, least_frames, enough_frames)) & (value >= share * frames - 1e-6)
            o, i, j, value = o[good], i[good], j[good], value[good]
            top = np.lexsort((o, -value, j, i))
            yield from ((int(rs[i[k]]), int(qs[j[k]]), int(o[k])) for k in top[np.concatenate([[True], (i[top][1:] != i[top][:-1]) | (j[top][1:] != j[top][:-1])])[: len(top)]])


def align(recordings: DataFrame, queries: DataFrame, most_errors: float = 0.22, least_frames: int = LEAST, enough_frames: int = ENOUGH) -> DataFrame:
    """Recordings that agree with a query wherever the two meet, both as ``fingerprints`` gives them.

    The overlap's bits are compared at every offset, as a whole: a stretch that lies inside
    of two recordings which are otherwise different counts only if it makes up so much of
    their overlap that the error of all of it stays under the bound. Returns query_id, rec_id, offset
    (frames of the recording before the query begins), votes (integers that agree in all
    but their last bits), n_frames (overlap) and bit_error for each pair with an offset
    where the overlap has at least half of the shorter print's frames, but ``least_frames``
    of any and ``enough_frames`` of the longest, and the error is at most ``most_errors``;
    of several offsets that with most equal bits less different ones, of
    equal ones the smallest. A query doesn't match its own id. Nothing is sampled, so every
    such pair is found, at the price of comparing each query with each recording. The queries
    go in blocks of about BLOCK and BLOCK_BYTES at most, each held against all recordings in
    one pass, so no rows meet in a group. Empty fingerprints and tables align with nothing;
    repeated rows align each by itself; a null fingerprint is an error.
    """
    kinds = [df.schema["rec_id"].dataType.simpleString() for df in (queries, recordings)]
    schema = f"query_id {kinds[0]}, rec_id {kinds[1]}, offset long, votes long, n_frames long, bit_error double"
    spark = recordings.sparkSession
    count, size = queries.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("print")), F.lit(0))).first()
    n = max(-(-count // BLOCK), -(-size // BLOCK_BYTES))
    out = spark.createDataFrame([], schema)
    for k in range(n):
        block = queries.where(F.pmod(F.xxhash64("rec_id"), F.lit(n)) == k).toPandas().sort_values("rec_id")
        shared = spark.sparkContext.broadcast((list(block["rec_id"]), [np.frombuffer(p, np.uint32) for p in block["print"]]))

        def search(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            ids, prints = shared.value
            for b in batches:
                recs, own = list(b["rec_id"]), [np.frombuffer(p, np.uint32) for p in b["print"]]
                rows = []
                for i, j, offset in best_offsets(own, prints, most_errors, least_frames, enough_frames):
                    error, frames = _bit_error(prints[j], own[i], offset)
                    if error <= most_errors and ids[j] != recs[i]:
                        lo = max(0, -offset)
                        votes = (prints[j][lo : lo + frames] >> LOOSE == own[i][lo + offset : lo + offset + frames] >> LOOSE).sum()
                        rows.append((ids[j], recs[i], offset, int(votes), frames, error))
                yield pd.DataFrame(rows, columns=["query_id", "rec_id", "offset", "votes", "n_frames", "bit_error"])

        out = out.unionByName(recordings.select("rec_id", "print").mapInPandas(search, schema))
    return out


def match_recordings(recordings: DataFrame, is_query: Column) -> DataFrame:
    """All alignments of recordings with those that meet the condition ``is_query``.

    All ``recordings`` (rec_id, audio) are fingerprinted once. Equal fingerprints of LEAST
    frames or more are one class, named by its smallest rec_id (class_id), and only classes
    are aligned, so the result doesn't grow with the square of a group of copies. Returns
    rec_id, n_frames (of its fingerprint), class_id, n_links (queries it aligns with, not
    itself), and query_id, query_class, offset, votes, overlap and bit_error of an
    alignment, in these rows:

    - for the recording that names a class, a row for each class of queries that it aligns
      with; query_id is the smallest query of that class;
    - for each recording with a query in its own class, a row with the smallest (not itself);
    - for any other recording one row without alignment.

    A member aligns with what its class's rows name, and with all members of query_class.
    Repeated rows count once; rows without rec_id are left out; different audio under one
    rec_id counts as different recordings.
    """
    prints = stage(fingerprints(recordings).withColumn("key", F.when(F.col("n_frames") >= LEAST, F.sha2("print", 256))), "fingerprints")
    members = prints.select("rec_id", "n_frames", F.coalesce(is_query, F.lit(False)).alias("q"), "key").distinct()
    asks = F.when(F.col("q"), F.col("rec_id"))
    classes = members.where("key is not null").groupBy("key").agg(F.min("rec_id").alias("class_id"), F.count(asks).alias("asking"), F.min(asks).alias("first"))
    # the first query's own row needs the second
    second = members.where("q").join(classes.where("asking > 1").select("key", "first"), "key").where("rec_id <> first").groupBy("key").agg(F.min("rec_id").alias("second"))
    classes = stage(classes.join(second, "key", "left"), "classes")
    distinct = stage(prints.where("key is not null").groupBy("key").agg(F.first("print").alias("print")).withColumnRenamed("key", "rec_id"), "prints")
    asked = distinct.join(classes.where("asking > 0").select(F.col("key").alias("rec_id")), "rec_id", "left_semi")
    query = classes.select(F.col("key").alias("query_id"), F.col("class_id").alias("query_class"), F.col("first").alias("query"), F.col("asking").alias("n"))
    found = align(distinct, asked).join(query, "query_id").select(F.col("rec_id").alias("key"), "query_class", "query", "n", "offset", "votes", F.col("n_frames").alias("overlap"), "bit_error")
    found = stage(found, "alignments")
    others = found.groupBy("key").agg(F.sum("n").alias("others"))
    every = members.join(classes, "key", "left").join(others, "key", "left")
    own = F.when(F.col("rec_id") == F.col("first"), F.col("second")).otherwise(F.col("first"))
    links = F.coalesce("asking", F.lit(0)) - F.when(F.col("q") & F.col("key").isNotNull(), 1).otherwise(0) + F.coalesce("others", F.lit(0))
    every = every.select("rec_id", "n_frames", "key", F.coalesce("class_id", "rec_id").alias("class_id"), links.alias("n_links"), own.alias("own"), F.coalesce(F.col("others").isNotNull() & (F.col("rec_id") == F.col("class_id")), F.lit(False)).alias("names"))
    every = stage(every, "members")
    base = ["rec_id", "n_frames", "class_id", "n_links"]
    linked = every.where("names").join(found, "key").select(*base, F.col("query").alias("query_id"), "query_class", "offset", "votes", "overlap", "bit_error")
    has = F.col("own").isNotNull()
    at = lambda value: F.when(has, value)
    alone = every.where(has | ~F.col("names")).select(
        *base,
        F.col("own").alias("query_id"),
        at(F.col("class_id")).alias("query_class"),
        at(F.lit(0).cast("long")).alias("offset"),
        at(F.col("n_frames")).alias("votes"),
        at(F.col("n_frames")).alias("overlap"),
        at(F.lit(0.0)).alias("bit_error"),
    )
    return linked.unionByName(alone)
