"""Word and shingle hashes of whole texts, a batch at a time in NumPy."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_BYTE = np.random.default_rng(1).integers(1, 2**63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z hash as a-z
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STEP, _NEXT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_powers = np.ones(1, dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit values whose bits all depend on all bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(2 * n, _STEP)]), dtype=np.uint64)
    return _powers


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, one after the other, and where each text's begin.

    Words are runs of bytes other than ASCII white space; A-Z count as a-z.
    """
    raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    space = _SPACE[raw]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], space]).view(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    firsts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    bounds = np.searchsorted(starts, firsts)
    if not len(starts):
        return np.zeros(0, np.uint64), bounds
    lengths = ends - starts
    inside = ~space
    place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    values = _BYTE[raw[inside]] * _power(int(lengths.max()))[place]
    return mix64(np.add.reduceat(values, np.cumsum(lengths) - lengths) + lengths.astype(np.uint64)), bounds


def shingle_sets(texts: Sequence[bytes], width: int) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes; a text of fewer words is one shingle, an empty one none."""
    words, bounds = word_hashes(texts)
    n = len(words)
    rolled = np.zeros(max(n - width + 1, 0), np.uint64)
    for k in range(width):
        rolled = rolled * _NEXT + words[k : n - width + 1 + k] if n >= width else rolled
    rolled = mix64(rolled)
    sets = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= width:
            sets.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            h = np.uint64(b - a)
            for w in words[a:b]:
                h = np.uint64((int(h) * int(_STEP) + int(w)) % 2**64)
            sets.append(mix64(np.array([h], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
