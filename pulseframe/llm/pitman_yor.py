"""A hierarchical Pitman-Yor language model: word bigrams over words over a uniform base.

Every context word is a restaurant whose tables are customers of the one parent they all
share, the restaurant of single words; its tables are served from a uniform base over the
training vocabulary and one unknown word. Seating enters predictions only through the
number of tables of each dish, so that number is what Gibbs sampling draws, given all
others: P(t) is proportional to S(c, t) p^t prod(strength + discount (T + i)), with S the
generalised Stirling numbers of the discount and p the parent's predictive probability.
All dishes of a bucket are drawn at once against the totals of the sweep before.

The corpus is cut into blocks of documents. A block sends each of its distinct word pairs
once to the bucket that owns the pair, and gets the pair's count and mean tables back in
the same order; so what is shuffled are distinct pairs of a block, packed, and no token
rows. A context too frequent for one bucket is split over all of them by the pair.

A word is known by the upper 40 bits of its hash in the tables: of a billion words that
confuses one in two thousand. A block's row for a bucket holds fewer pairs as both grow
more; in the end each row holds one, so rows never outgrow the blocks' distinct pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.shingles import mix64, word_hashes
from pulseframe.sources.staging import discard, release, stage

#: Bytes of text in a block, and about how many fall to a bucket.
BLOCK, BUCKET = 6_000_000, 6_000_000
#: Bytes of text that are hashed at a time.
STEP = 250_000
#: Numbers of seatings are tabulated for counts up to this; tables of larger counts are drawn from so many points, found by coarser grids.
EXACT, GRID, COARSE = 200, 64, 16
#: Terms of the sum for few tables, a bound to what counts as few (to where the saddle point serves), and sums taken at a time.
TERMS, SPARSE, PART = 150, 6.0, 2000
#: Most contexts that are split over all buckets; of a corpus of any size the next one in frequency fits a task.
HOT = 4096
#: Draws that settle the words' tables from one each.
SETTLE = 20
END, BEGIN = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543210)
#: What the phases hand on: packed arrays, for a bucket or a block.
SCHEMA = "kind string, bucket long, block long, a binary, b binary, c binary, d binary, total double, extra double"
COLUMNS = ["kind", "bucket", "block", "a", "b", "c", "d", "total", "extra"]


def _row(kind: str, bucket: int, block: int, *arrays: np.ndarray, total: float = 0.0, extra: float = 0.0) -> tuple:
    packed = [_planes(x) for x in arrays]
    return (kind, int(bucket), int(block), *packed, *[b""] * (4 - len(packed)), float(total), float(extra))


def _planes(x: np.ndarray) -> bytes:
    """Values as one plane for each of their bytes, compressed; single bytes are hashes and stay."""
    if x.dtype.itemsize == 1:
        return x.tobytes()
    planes = np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.dtype.itemsize).T)
    return zstandard.compress(planes.tobytes(), 1)


def read(raw: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8) if raw else np.zeros(0, np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def read_all(column: pd.Series, kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *[read(x, kind) for x in column]])


def _rising(x: np.ndarray) -> np.ndarray:
    """Sorted values as steps; ``np.cumsum`` gives them back."""
    return np.diff(x, prepend=x.dtype.type(0))


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=COLUMNS)


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets in the order of the hashes."""
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def pack(h: np.ndarray) -> np.ndarray:
    """The upper 40 bits of hashes as bytes; of a billion words they confuse one in two thousand."""
    return np.ascontiguousarray((h >> np.uint64(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])


def unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel() << np.uint64(24)


def in_blocks(batches: Iterator[pd.DataFrame], size: int = BLOCK) -> Iterator[pd.DataFrame]:
    """Rows of a partition (text among them) in groups of about ``size`` bytes of text."""
    held, n = [], 0
    for b in batches:
        lengths = b["text"].str.len().to_numpy()
        a = 0
        for k, x in enumerate(lengths):
            n += x + 1
            if n > size:
                held.append(b.iloc[a : k + 1])
                yield pd.concat(held, ignore_index=True)
                held, a, n = [], k + 1, 0
        if a < len(b):
            held.append(b.iloc[a:])
    if held:
        yield pd.concat(held, ignore_index=True)


def tokens_of(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each text's words and then END, and the tokens in each."""
    tokens, lengths = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for part in in_blocks(iter([pd.DataFrame({"text": texts})]), STEP):
        words, bounds = word_hashes([t.encode() for t in part["text"]])
        tokens.append(np.insert(words, bounds[1:], END))
        lengths.append(np.diff(bounds) + 1)
    return np.concatenate(tokens), np.concatenate(lengths)


def merge_words(asked: DataFrame) -> DataFrame:
    """A bucket's words with their training counts (``words``), from what the blocks sent; none of count 0."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        w, place = np.unique(np.concatenate([np.cumsum(read(x, np.uint64), dtype=np.uint64) for x in rows["a"]]), return_inverse=True)
        n = np.bincount(place, read_all(rows["b"], np.int64), len(w)).astype(np.int64)
        return _frame([_row("words", rows["bucket"].iloc[0], -1, w[n > 0], n[n > 0], total=n.sum(), extra=(n > 0).sum())])

    return asked.groupBy("bucket").applyInPandas(run, SCHEMA)


def hot_words(words: DataFrame, least: float) -> np.ndarray:
    """The HOT most frequent words of those with more than ``least`` occurrences."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for x, y in zip(b["a"], b["b"], strict=True):
                n = read(y, np.int64)
                yield pd.DataFrame({"w": read(x, np.uint64)[n > least].view(np.int64), "n": n[n > least]})

    found = [r["w"] for r in words.select("a", "b").mapInPandas(run, "w long, n long").orderBy(F.desc("n"), "w").limit(HOT).collect()]
    return np.array(found, np.int64).view(np.uint64)


@dataclass(frozen=True)
class Pairs:
    """The distinct (context, word) pairs of a block, ordered by owner, and each token's place among them."""

    u: np.ndarray
    w: np.ndarray
    bucket: np.ndarray
    place: np.ndarray

    @staticmethod
    def of(vocabulary: np.ndarray, tokens: np.ndarray, lengths: np.ndarray, hot: np.ndarray, buckets: int) -> Pairs:
        names = np.append(vocabulary, BEGIN)
        before = np.concatenate([[0], tokens[:-1]]).astype(np.int64)
        before[np.cumsum(lengths) - lengths] = len(vocabulary)
        keys, inverse = np.unique(before * len(names) + tokens, return_inverse=True)
        u, w = names[keys // len(names)], names[keys % len(names)]
        bucket = bucket_of(np.where(np.isin(u, hot), mix64(u ^ (w * np.uint64(3))), u), buckets)
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return Pairs(u[order], w[order], bucket[order], rank[inverse])


def _segments(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    edges = np.flatnonzero(np.diff(bucket)) + 1
    for a, b in zip([0, *edges], [*edges, len(bucket)], strict=True):
        if b > a:
            yield int(bucket[a]), slice(a, b)


def cut_blocks(docs: DataFrame, hot: np.ndarray, buckets: int, pairs: bool) -> DataFrame:
    """A block's pairs with training counts by bucket (``pairs``), or its documents (``docs``) and distinct words with training counts by bucket (``ask``).

    Both are cut the same way from the same scan, so nothing but the documents' side has
    to be kept; a block whose answers don't fit is an error in the end.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for number, b in enumerate(in_blocks(batches)):
            block = (int(b["part"].iloc[0]) << 24) + number
            tokens, lengths = tokens_of(b["text"])
            vocabulary, index = np.unique(tokens, return_inverse=True)
            if not pairs:
                counts = np.bincount(index[np.repeat(~b["held_out"].to_numpy(bool), lengths)], minlength=len(vocabulary))
                # by rank of frequency, so that most numbers are small
                order = np.argsort(-np.bincount(index), kind="stable")
                rank = np.empty(len(order), np.int32)
                rank[order] = np.arange(len(order))
                rows = [_row("docs", -1, block, b["id"].to_numpy(np.int64), lengths.astype(np.int32), rank[index], order.astype(np.int32))]
                yield _frame(rows + [_row("ask", k, block, _rising(vocabulary[s]), counts[s].astype(np.int64), total=counts[s].sum()) for k, s in _segments(bucket_of(vocabulary, buckets))])
                continue
            own = Pairs.of(vocabulary, index, lengths, hot, buckets)
            counted = np.repeat(~b["held_out"].to_numpy(bool), lengths)
            counts = np.bincount(own.place[counted], minlength=len(own.u)).astype(np.int32)
            rows = []
            for k, s in _segments(own.bucket):
                u = own.u[s]
                starts = np.concatenate([[0], np.flatnonzero(u[1:] != u[:-1]) + 1])
                rows.append(_row("pairs", k, block, u[starts], np.diff(np.append(starts, len(u))).astype(np.int32), pack(own.w[s]), counts[s]))
            yield _frame(rows)

    return docs.select("id", "held_out", "text", F.spark_partition_id().cast("long").alias("part")).mapInPandas(run, SCHEMA)


def _by_word(kind: str, bucket: int, w: np.ndarray, values: np.ndarray, buckets: int) -> list[tuple]:
    """Sums of ``values`` by word, in a row for each bucket of words; ``block`` names the sender."""
    words, inverse = np.unique(w, return_inverse=True)
    sums = np.bincount(inverse, values, len(words))
    return [_row(kind, k, bucket, pack(words[s]), sums[s].astype(np.float32), total=sums[s].sum()) for k, s in _segments(bucket_of(words, buckets))]


def merge_pairs(lists: DataFrame, buckets: int) -> DataFrame:
    """A bucket's pairs merged over the blocks.

    ``state``: contexts, their customers and pairs seen once; ``many``: of pairs seen twice or
    more the words, counts and contexts; ``where``: which pairs each block asked for and
    all counts; ``single`` and ``multi``: customers for
    the parent from pairs seen once and from the others, one table each to begin with.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        bucket = rows["bucket"].iloc[0]
        u = np.repeat(read_all(rows["a"], np.uint64), read_all(rows["b"], np.int32))
        w = unpack(b"".join(rows["c"]))
        sent = [read(x, np.int32) for x in rows["d"]]
        counts = np.concatenate(sent)
        order = np.lexsort((w, u))
        u, w = u[order], w[order]
        new = np.concatenate([[True], (u[1:] != u[:-1]) | (w[1:] != w[:-1])])
        index = np.empty(len(order), np.int32)
        index[order] = np.cumsum(new) - 1
        firsts = np.flatnonzero(new)
        c = np.add.reduceat(counts[order].astype(np.int64), firsts)
        u, w = u[firsts], w[firsts]
        starts = np.concatenate([[0], np.flatnonzero(u[1:] != u[:-1]) + 1])
        out = [
            _row("state", bucket, -1, u[starts], np.add.reduceat(c, starts), np.add.reduceat((c == 1).astype(np.int64), starts).astype(np.int32), total=(c == 1).sum(), extra=(c == 2).sum()),
            _row("many", bucket, -1, pack(w[c >= 2]), c[c >= 2], np.repeat(np.arange(len(starts), dtype=np.int32), np.diff(np.append(starts, len(u))))[c >= 2]),
            _row("where", bucket, -1, rows["block"].to_numpy(np.int64), np.array([len(x) for x in sent], np.int32), np.diff(index, prepend=np.int32(0)), c.astype(np.float32)),
            *_by_word("single", bucket, w[c == 1], np.ones(int((c == 1).sum())), buckets),
            *_by_word("multi", bucket, w[c >= 2], np.ones(int((c >= 2).sum())), buckets),
        ]
        return _frame(out)

    return lists.groupBy("bucket").applyInPandas(run, SCHEMA)


@cache
def stirling(discount: float) -> np.ndarray:
    """log of the generalised Stirling numbers S(c, t) for c, t up to EXACT."""
    s = np.full((EXACT + 1, EXACT + 1), -np.inf)
    s[0, 0] = 0
    with np.errstate(divide="ignore"):
        for c in range(EXACT):
            s[c + 1, 1:] = np.logaddexp(s[c, :-1], np.log(np.maximum(c - discount * np.arange(1, EXACT + 1), 0)) + s[c, 1:])
    return s


def _weights(c: int, r: np.ndarray, p: np.ndarray, discount: float) -> np.ndarray:
    """log weights of 1, ..., c tables (a row for each of ``r``) for dishes with ``c`` customers, up to EXACT."""
    tables = np.arange(1, c + 1)
    return stirling(discount)[c, 1 : c + 1] + tables * np.log(discount * p)[:, None] + np.cumsum(np.log(r[:, None] + tables - 1), axis=1)


@cache
def _saddle(discount: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By log(c / t): that, A, its slope and log B, where log S(c, t) = log(c!) - log(t!) - t log(discount) + t A - log(2 pi t B) / 2.

    The saddle point of the numbers' generating function (1 - (1 - x)^discount)^t / (t!
    discount^t) depends on c / t alone; it is taken at 1 - x = exp(-w) for many w.
    """
    w = np.geomspace(1e-9, 60 / (1 - discount), 60_000)
    x = -np.expm1(-w)
    inner = np.log(-np.expm1(-discount * w))
    ratio = np.log(discount) + np.log(x) + (1 - discount) * w - inner
    log_x = np.log1p(-np.exp(-w))
    a = inner - np.exp(ratio) * log_x
    curve = ratio + w + np.log(np.maximum((1 - discount) * x + np.exp(-w) - np.exp(ratio - w), 1e-300))
    kept = np.concatenate([[True], np.diff(ratio) > 0])
    return ratio[kept], a[kept], (-np.exp(ratio) * log_x)[kept], curve[kept]


@cache
def _series(discount: float) -> np.ndarray:
    """(-1)^k / (k! Gamma(-k discount)) for k from 1 to TERMS, 0 where Gamma has a pole."""
    with np.errstate(over="ignore"):
        # by Gamma(-x) Gamma(1 + x) = -pi / sin(pi x)
        return np.array([-((-1) ** k) * math.sin(math.pi * k * discount) / math.pi * math.exp(math.lgamma(1 + k * discount) - math.lgamma(k + 1)) for k in range(1, TERMS + 1)])


def _summed(c: np.ndarray, i: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    """log of S(c[i], t) t! discount^t / Gamma(c[i]) by its alternating sum; NaN where too many digits cancel or terms go on.

    Most sums are over after a few terms; the others start again with all.
    """
    out, left = np.full(len(t), np.nan), np.arange(len(t))
    factors = _series(discount)
    for n in (24, TERMS):
        k = np.arange(n)
        # log Gamma(low) - log Gamma(high), without losing digits of large ones
        high = c[:, None] - k * discount
        low = high - discount
        fall = np.exp((low - 0.5) * np.log1p(-discount / high) - discount * np.log(high) + discount + (1 / low - 1 / high) / 12 - (low**-3 - high**-3) / 360)
        unsure = []
        for at in (left[a : a + PART] for a in range(0, len(left), PART)):
            with np.errstate(over="ignore", invalid="ignore"):  # sums that go on
                parts = np.cumprod(np.maximum(t[at, None] - k, 0) * fall[i[at]], axis=1) * factors[:n]
                total, size = parts.sum(axis=1), np.abs(parts)
            # one term may be next to nothing where Gamma has a pole
            over = np.isfinite(total) & (size[:, -6:].max(axis=1) < 1e-9 * total) & (total > 0)
            sure = over & (total > 1e-7 * size.max(axis=1))
            out[at[sure]] = np.log(total[sure])
            unsure.append(at[~over])
        left = np.concatenate(unsure) if unsure else left[:0]
    return out


def _log_weights(c: np.ndarray, t: np.ndarray, r: np.ndarray, p: np.ndarray, discount: float) -> np.ndarray:
    """log weights of ``t`` tables (a row for each dish) for dishes with more than EXACT customers, up to what t doesn't change."""
    ratio, a, slope, curve = _saddle(discount)
    u = np.log(c[:, None] / t)
    k = np.clip(np.searchsorted(ratio, u) - 1, 0, len(ratio) - 2)
    step = ratio[k + 1] - ratio[k]
    y = np.clip((u - ratio[k]) / step, 0, 1)
    # cubic between values and slopes
    smooth = a[k] * (1 + 2 * y) * (1 - y) ** 2 + slope[k] * step * y * (1 - y) ** 2 + a[k + 1] * y * y * (3 - 2 * y) + slope[k + 1] * step * y * y * (y - 1)
    spread = curve[k] * (1 - y) + curve[k + 1] * y
    number = np.log(c)[:, None] - gammaln(t + 1.0) - t * np.log(discount) + t * smooth - 0.5 * (np.log(2 * np.pi * t) + spread)
    # few tables for so many customers: the saddle point is no good, and the sum doesn't cancel
    i, j = np.nonzero(t <= (SPARSE / (1 - discount)) ** (1 - discount) * c[:, None] ** discount)
    exact = _summed(c, i, t[i, j], discount) - gammaln(t[i, j] + 1.0) - t[i, j] * np.log(discount)
    number[i, j] = np.where(np.isnan(exact), number[i, j], exact)
    return number + t * np.log(discount * p)[:, None] + gammaln(r[:, None] + t) - gammaln(r)[:, None]


def _draw_large(rng: np.random.Generator, c: np.ndarray, r: np.ndarray, p: np.ndarray, discount: float) -> np.ndarray:
    """Tables of dishes with more than EXACT customers.

    The weights have one peak. A coarse grid over all numbers of tables closes in on what
    has weight at all; the last grid has every number, or four or so in a standard
    deviation, and then any number between two of them alike.
    """
    low, high = np.ones(len(c)), c.copy()
    open_, share = np.arange(len(c)), np.linspace(0, 1, COARSE)
    for turn in range(12):
        lo, hi = low[open_][:, None], high[open_][:, None]
        grid = np.rint(lo * (hi / lo) ** share if turn == 0 else lo + (hi - lo) * share)
        weight = _log_weights(c[open_], grid, r[open_], p[open_], discount)
        heavy = weight > weight.max(axis=1)[:, None] - 30
        rows = np.arange(len(open_))
        low[open_] = grid[rows, np.maximum(heavy.argmax(axis=1) - 1, 0)]
        high[open_] = grid[rows, np.minimum(COARSE - heavy[:, ::-1].argmax(axis=1), COARSE - 1)]
        width = high[open_] - low[open_]
        open_ = open_[(width > 8) & (width < 0.7 * (hi - lo)[:, 0])]
        if not len(open_):
            break
    t, width = np.empty(len(c)), high - low
    points = np.minimum(2 ** np.ceil(np.log2(width + 1)), GRID)
    for n in np.unique(points):
        rows = np.flatnonzero(points == n)
        grid = np.minimum(low[rows, None] + np.arange(n), high[rows, None]) if n > width[rows].max() else np.rint(low[rows, None] + width[rows, None] * np.linspace(0, 1, int(n)))
        weight = _log_weights(c[rows], grid, r[rows], p[rows], discount)
        weight[:, 1:][grid[:, 1:] == grid[:, :-1]] = -np.inf
        t[rows] = grid[np.arange(len(rows)), (weight + rng.gumbel(size=weight.shape)).argmax(axis=1)]
    apart = width / (points - 1).clip(1)
    return np.clip(np.rint(t + np.where(apart > 1, apart, 0) * (rng.random(len(t)) - 0.5)), 1, c).astype(np.int64)


def _draw(rng: np.random.Generator, c: int, r: np.ndarray, p: np.ndarray, discount: float) -> np.ndarray:
    """Tables of dishes with ``c`` customers each, up to EXACT, by weights multiplied up from one table's; those that overflow go by logarithms."""
    weight = np.ones((len(r), c))
    weight[:, 1:] = (r[:, None] + np.arange(1, c)) * (discount * p)[:, None] * np.exp(np.diff(stirling(discount)[c, 1 : c + 1]))
    with np.errstate(over="ignore", invalid="ignore"):
        share = np.cumsum(np.cumprod(weight, axis=1), axis=1)
        t = 1 + (share[:, :-1] <= (rng.random(len(r)) * share[:, -1])[:, None]).sum(axis=1)
    far = np.flatnonzero(~np.isfinite(share[:, -1]))
    if len(far):
        weight = _weights(c, r[far], p[far], discount)
        t[far] = 1 + (weight + rng.gumbel(size=weight.shape)).argmax(axis=1)
    return t


def draw_tables(rng: np.random.Generator, c: np.ndarray, others: np.ndarray, p: np.ndarray, discount: float, strength: float) -> np.ndarray:
    """Tables of dishes with ``c`` customers, given the restaurants' other tables and the parent's ``p``, from their conditional.

    Up to EXACT customers the numbers of seatings are exact, beyond that summed
    up for few tables and taken at their saddle point for many.
    """
    t = np.ones(len(c), np.int64)
    r = strength / discount + others
    # small numbers sort by their digits, so dishes of a count lie together at little cost
    kind = np.minimum(c, EXACT + 1).astype(np.int16)
    order = np.argsort(kind, kind="stable")
    ends = np.searchsorted(kind[order], np.arange(EXACT + 2), side="right")
    for k in np.flatnonzero(np.diff(ends)) + 1:
        if 2 <= k <= EXACT:
            rows = order[ends[k - 1] : ends[k]]
            t[rows] = _draw(rng, int(k), r[rows], p[rows], discount)
    large = order[ends[EXACT] :]
    for k in range(0, len(large), 1000):
        rows = large[k : k + 1000]
        t[rows] = _draw_large(rng, c[rows].astype(np.float64), r[rows].astype(np.float64), p[rows], discount)
    return t


def gammaln(x: np.ndarray | float) -> np.ndarray:
    """log Gamma for x > 0 by Stirling's series, for less than 8 from 8 further on."""
    x = np.atleast_1d(np.asarray(x, dtype=np.float64))
    low = x < 8
    y = np.where(low, x + 8, x)
    out = (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + (1 / 12 - (1 / 360 - 1 / (1260 * y * y)) / (y * y)) / y
    out[low] -= np.log(np.prod(x[low][:, None] + np.arange(8), axis=1))
    return out


@dataclass(frozen=True)
class Level:
    """The parent restaurant's scalars: discount, strength, customers, tables, words it may serve."""

    discount: float
    strength: float
    customers: float
    tables: float
    words: int

    def probability(self, numerator: np.ndarray) -> np.ndarray:
        return (numerator + (self.strength + self.discount * self.tables) / self.words) / (self.strength + self.customers)


def words_seen(customers: DataFrame) -> tuple[float, float]:
    """Words with one and with two customers (``single`` and ``multi`` together)."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        words, inverse = np.unique(np.concatenate([unpack(x) for x in group["a"]]), return_inverse=True)
        c = np.bincount(inverse, np.concatenate([read(x, np.float32) for x in group["b"]]), len(words))
        return pd.DataFrame({"once": [float((c == 1).sum())], "twice": [float((c == 2).sum())], "words": [float(len(words))]})

    found = customers.groupBy("bucket").applyInPandas(run, "once double, twice double, words double")
    return tuple(found.agg(*[F.coalesce(F.sum(x), F.lit(0.0)) for x in ("once", "twice", "words")]).first())


def discount_of(once: float, twice: float) -> float:
    return float(np.clip(once / max(once + 2 * twice, 1), 0.1, 0.9))


def seat_words(rows: DataFrame, first: bool, last: bool, level: Level, sweeps: int, samples: int, seed: int) -> DataFrame:
    """The parent's seating, a bucket of words at a time: ``sweeps`` draws to settle, SETTLE at first, then the mean of ``samples``.

    Tables carry on from the pass before (``root``) and from draw to draw; so does the total,
    for which the tables of other buckets (``level`` has the sum) are taken to change as
    the bucket's own. In the first pass there is one table for each word.

    ``rows``: ``words`` (hash and training count), ``single`` and ``multi`` customers, and
    in the last pass ``contexts`` (customers and tables by context) and ``ask``. Answers
    each ``multi`` row with the words' numerators c - d t (``served``), or in the end each
    ``ask`` row with training counts, numerators, context customers and tables (``told``).
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        kinds = {k: g.sort_values("block") for k, g in group.groupby("kind")}
        bucket = group["bucket"].iloc[0]
        rng = np.random.default_rng([seed, int(bucket)])
        lists = {k: [(i, unpack(a), read(b, np.float32)) for i, a, b in zip(g["block"], g["a"], g["b"], strict=True)] for k, g in kinds.items() if k in ("single", "multi")}
        both = [x for v in lists.values() for x in v]
        words, inverse = np.unique(np.concatenate([np.zeros(0, np.uint64), *[w for _, w, _ in both]]), return_inverse=True)
        mean = np.bincount(inverse, np.concatenate([np.zeros(0), *[n for *_, n in both]]), len(words))
        c = np.rint(mean).astype(np.int64)
        now, t = np.minimum(mean, 1.0), np.zeros(len(words))
        if "root" in kinds and len(words):
            held = kinds["root"].iloc[0]
            keys, tables = unpack(held["a"]), read(held["b"], np.float32)
            k = np.minimum(np.searchsorted(keys, words), len(keys) - 1)
            now = np.where(keys[k] == words, np.minimum(tables[k], np.maximum(c, 1)), now)
        if len(words):
            began = now.sum()
            burn = max(sweeps, SETTLE) if first else sweeps
            for k in range(burn + samples):
                total = max(level.tables, began) * now.sum() / began
                now = draw_tables(rng, c, np.maximum(total - now, 0), np.full(len(c), 1 / level.words), level.discount, level.strength).astype(np.float64)
                t += (k >= burn) * now / samples
        numerator = mean - level.discount * t
        out = [_row("seated", bucket, -1, total=t.sum(), extra=mean.sum())]
        if not last:
            out.append(_row("root", bucket, -1, pack(words), now.astype(np.float32), total=now.sum()))
        if first and lists.get("single"):
            once, place = np.unique(np.concatenate([w for _, w, _ in lists["single"]]), return_inverse=True)
            n = np.bincount(place, np.concatenate([n for *_, n in lists["single"]]), len(once))
            out.append(_row("single", bucket, -1, pack(once), n.astype(np.float32), total=n.sum()))
        if not last:
            out += [_row("served", i, bucket, pack(w), numerator[np.searchsorted(words, w)].astype(np.float32)) for i, w, _ in lists.get("multi", [])]
            return _frame(out)
        none = pd.DataFrame(columns=COLUMNS)
        known, g = kinds.get("words", none), kinds.get("contexts", none)
        full, count = np.append(read_all(known["a"], np.uint64), np.uint64(2**64 - 1)), np.append(read_all(known["b"], np.int64), 0)
        cu, place = np.unique(read_all(g["a"], np.uint64), return_inverse=True)
        customers, tables = (np.bincount(place, read_all(g[x], np.float64), len(cu)) for x in "bc")
        pick = lambda keys, values, w: np.where((k := np.minimum(np.searchsorted(keys, w), len(keys) - 1), keys[k] == w)[1], values[k], 0) if len(keys) else np.zeros(len(w))
        if (g := kinds.get("ask")) is not None:
            for block, raw in zip(g["block"], g["a"], strict=True):
                w = np.cumsum(read(raw, np.uint64), dtype=np.uint64)
                out.append(_row("told", bucket, block, pick(full, count, w).astype(np.int64), pick(words, numerator, w >> np.uint64(24) << np.uint64(24)).astype(np.float32), pick(cu, customers, w).astype(np.float32), pick(cu, tables, w).astype(np.float32)))
        # the beginning of a text is a context, but no word of any block
        if len(cu) and (cu == BEGIN).any():
            out.append(_row("begin", -1, -1, total=customers[cu == BEGIN][0], extra=tables[cu == BEGIN][0]))
        return _frame(out)

    return rows.groupBy("bucket").applyInPandas(run, SCHEMA)


def seat_pairs(rows: DataFrame, last: bool, parent: Level, discount: float, strength: float, hot: dict[int, tuple[float, float]], buckets: int, sweeps: int, samples: int, seed: int) -> DataFrame:
    """The contexts' seating, a bucket of pairs at a time: ``sweeps`` of Gibbs sampling, the last ``samples`` averaged.

    ``rows``: ``state``, ``served`` and, but for the first pass, ``tables``. Gives ``tables``
    and ``multi`` customers, and totals of hot contexts (``hot``); in the last pass also
    ``contexts`` for the words and each block's counts and mean tables (``answer``).
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        kinds = {k: g.sort_values("block") for k, g in group.groupby("kind")}
        if "state" not in kinds:
            return _frame([])
        s = kinds["state"].iloc[0]
        bucket = int(s["bucket"])
        rng = np.random.default_rng([seed, bucket])
        u, cu, fixed = read(s["a"], np.uint64), read(s["b"], np.int64).astype(np.float64), read(s["c"], np.int32)
        m = kinds["many"].iloc[0]
        w, cm, um = unpack(m["a"]), read(m["b"], np.int64), read(m["c"], np.int32)
        # hot contexts have dishes in other buckets too; their tables are those of the pass before
        elsewhere = np.zeros(len(u))
        tm = np.ones(len(cm)) if "tables" not in kinds else read(kinds["tables"].iloc[0]["a"], np.int32).astype(np.float64)
        mine = np.bincount(um, tm, len(u))
        for k in np.flatnonzero(np.isin(u, np.array(list(hot), np.uint64))) if hot else []:
            elsewhere[k] = max(hot[int(u[k])][1] - fixed[k] - mine[k], 0)
        mean, mean_total = np.zeros(len(cm)), np.zeros(len(u))
        if len(cm):
            keys = np.concatenate([unpack(x) for x in kinds["served"]["a"]])
            order = np.argsort(keys)
            numerator = read_all(kinds["served"]["b"], np.float32)[order].astype(np.float64)
            p = parent.probability(numerator[np.searchsorted(keys[order], w)])
        for k in range(sweeps):
            if len(cm):
                totals = fixed + np.bincount(um, tm, len(u)) + elsewhere
                tm = draw_tables(rng, cm, np.maximum(totals[um] - tm, 0), p, discount, strength).astype(np.float64)
            if k >= sweeps - samples:
                mean += tm / samples
                mean_total += (fixed + np.bincount(um, tm, len(u))) / samples
        out = [_row("tables", bucket, -1, tm.astype(np.int32)), *_by_word("multi", bucket, w, mean if last else tm, buckets)]
        if not last:
            local = fixed + np.bincount(um, tm, len(u))
            out += [_row("hot", -1, -1, u[k : k + 1], total=cu[k], extra=local[k]) for k in (np.flatnonzero(np.isin(u, np.array(list(hot), np.uint64))) if hot else [])]
            return _frame(out)
        seen = cu > 0
        order = np.argsort(bucket_of(u[seen], buckets), kind="stable")
        un, cn, tn = u[seen][order], cu[seen][order], mean_total[seen][order]
        out += [_row("contexts", k, bucket, un[x], cn[x], tn[x]) for k, x in _segments(bucket_of(un, buckets))]
        at = kinds["where"].iloc[0]
        c = read(at["d"], np.float32)
        tables = (c == 1).astype(np.float32)
        tables[c >= 2] = mean
        index = np.cumsum(read(at["c"], np.int32), dtype=np.int64)
        ends = np.cumsum(read(at["b"], np.int32))
        for block, a, b in zip(read(at["a"], np.int64), [0, *ends[:-1]], ends, strict=True):
            out.append(_row("answer", bucket, block, c[index[a:b]], tables[index[a:b]]))
        return _frame(out)

    return rows.groupBy("bucket").applyInPandas(run, SCHEMA)


def score_blocks(rows: DataFrame, parent: Level, discount: float, strength: float, hot: np.ndarray, buckets: int, begin: tuple[float, float], total: int, distinct: int) -> DataFrame:
    """Scores of a block's documents from what its words and pairs were answered."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        kinds = {k: g.sort_values("bucket") for k, g in group.groupby("kind")}
        d, told, answer = kinds["docs"].iloc[0], kinds["told"], kinds["answer"]
        ids, lengths, tokens = read(d["a"], np.int64), read(d["b"], np.int32), read(d["d"], np.int32)[read(d["c"], np.int32)]
        vocabulary = np.concatenate([np.cumsum(read(x, np.uint64), dtype=np.uint64) for x in kinds["ask"]["a"]])
        count, numerator, cu, tu = (read_all(told[x], t) for x, t in (("a", np.int64), ("b", np.float32), ("c", np.float32), ("d", np.float32)))
        pairs = Pairs.of(vocabulary, tokens, lengths, hot, buckets)
        c, t = (read_all(answer[x], np.float32) for x in "ab")
        if len(count) != len(vocabulary) or len(t) != len(pairs.u):
            raise ValueError(f"a block's answers don't fit its questions: {len(count)} for {len(vocabulary)} words, {len(t)} for {len(pairs.u)} pairs")
        c, t = c[pairs.place].astype(np.float64), t[pairs.place].astype(np.float64)
        first = np.cumsum(lengths) - lengths
        before = np.concatenate([[0], tokens[:-1]])
        customers, tables = cu[before].astype(np.float64), tu[before].astype(np.float64)
        customers[first], tables[first] = begin
        p = parent.probability(numerator[tokens].astype(np.float64))
        p = (np.maximum(c - discount * t, 0) + (strength + discount * tables) * p) / (strength + customers)
        n = count[tokens]
        return pd.DataFrame({
            "id": ids,
            "n_tokens": lengths.astype(np.int64),
            "n_known": np.add.reduceat((n > 0).astype(np.int64), first),
            "base_score": np.add.reduceat(np.log10((n + 1) / (total + distinct + 1)), first),
            "score": np.add.reduceat(np.log10(p), first),
        })

    return rows.groupBy("block").applyInPandas(run, "id long, n_tokens long, n_known long, base_score double, score double")


def score_documents(docs: DataFrame, held_out: Column, strength: float = 1.0, sweeps: int = 3, samples: int = 5, seed: int = 5) -> DataFrame:
    """log10 probabilities of all whole texts of ``docs`` (doc_id, text), learned from those not ``held_out``.

    Tokens are the words, A-Z as a-z, and one end for each text. Discounts follow from how
    many pairs, and customers of words, were seen once and twice, for contexts and for words.
    Two passes of ``sweeps`` settle the seating, of words before each and after, then the
    mean of ``samples`` draws predicts.

    Returns one row for each input row: doc_id, n_tokens, n_known (seen in
    training), train_tokens, base_score (add-one unigrams), score. A null text is an empty
    one: its end alone. Other columns are ignored; with nothing to learn from, every token
    has probability 1 (the base is one unknown word). Perplexity is
    10 ** (-score / n_tokens).
    """
    spark = docs.sparkSession
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    # packed ids can't be null
    text = text.withColumn("id", F.coalesce("doc_id", F.lit(-(2**63))))
    size = text.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0))).first()[0]
    buckets = max(1, -(-size // BUCKET))  # by size alone: a block writes to each of them
    blocks = stage(cut_blocks(text, np.zeros(0, np.uint64), buckets, pairs=False), "blocks", "zstd")
    words = stage(merge_words(blocks.where("kind = 'ask'").select(*COLUMNS)), "words", "zstd")
    total, distinct = (int(x) for x in words.agg(F.coalesce(F.sum("total"), F.lit(0.0)), F.coalesce(F.sum("extra"), F.lit(0.0))).first())
    hot = np.append(hot_words(words, total / (4 * buckets)), BEGIN)
    merged = stage(merge_pairs(cut_blocks(text, hot, buckets, pairs=True), buckets), "pairs", "zstd")
    release(spark)
    kind = lambda df, *kinds: df.where(F.col("kind").isin(*kinds))
    n1, n2 = kind(merged, "state").agg(F.coalesce(F.sum("total"), F.lit(0.0)), F.coalesce(F.sum("extra"), F.lit(0.0))).first()
    discount = discount_of(n1, n2)
    single, multi, tables, seated = kind(merged, "single"), kind(merged, "multi"), None, None
    hot_totals: dict[int, tuple[float, float]] = {int(h): (0.0, 0.0) for h in hot}
    *seen, root_state = words_seen(kind(merged, "single", "multi"))
    root_discount = discount_of(*seen)
    for step in range(3):
        last = step == 2
        words_in = single.unionByName(multi)
        if last:
            words_in = words_in.unionByName(words).unionByName(kind(seated, "contexts")).unionByName(kind(blocks, "ask"))
        if step:
            words_in = words_in.unionByName(root)
        served = stage(seat_words(words_in, not step, last, Level(root_discount, strength, 0.0, root_state, distinct + 1), sweeps, samples, seed + step), "served", "zstd")
        if not step:
            single = stage(kind(served, "single"), "single", "zstd")
        else:
            discard(before)  # its seating has gone on, and the pairs have had their answers
        root_tables, customers = kind(served, "seated").agg(F.coalesce(F.sum("total"), F.lit(0.0)), F.coalesce(F.sum("extra"), F.lit(0.0))).first()
        level = Level(root_discount, strength, customers, root_tables, distinct + 1)
        release(spark)
        if last:
            break
        before, root = served, kind(served, "root")
        root_state = root.agg(F.coalesce(F.sum("total"), F.lit(0.0))).first()[0]
        pairs_in = kind(merged, "state", "many", *["where"] * (step == 1)).unionByName(kind(served, "served"))
        if tables is not None:
            pairs_in = pairs_in.unionByName(tables)
        pairs_before, seated = seated, stage(seat_pairs(pairs_in, step == 1, level, discount, strength, hot_totals, buckets, sweeps + samples * (step == 1), samples, seed + step), "seated", "zstd")
        for used in (pairs_before, merged) if step else ():
            discard(used)
        multi, tables = kind(seated, "multi"), kind(seated, "tables")
        sums = kind(seated, "hot").groupBy("a").agg(F.sum("total").alias("c"), F.sum("extra").alias("t")).collect()  # a row for each hot context
        hot_totals = {int(read(r["a"], np.uint64)[0]): (r["c"], r["t"]) for r in sums}
        release(spark)
    begin = kind(served, "begin").agg(F.coalesce(F.sum("total"), F.lit(0.0)), F.coalesce(F.sum("extra"), F.lit(0.0))).first()
    answers = kind(blocks, "docs", "ask").unionByName(kind(served, "told")).unionByName(kind(seated, "answer"))
    scored = score_blocks(answers, level, discount, strength, hot, buckets, tuple(begin), total, distinct)
    return scored.select(
        F.when(F.col("id") != -(2**63), F.col("id")).alias("doc_id"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"
    )
