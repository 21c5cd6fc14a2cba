"""Hashes of words and of word shingles, for whole Arrow batches at a time.

A word is a run of bytes other than ASCII white space, A-Z lower-cased. Its hash is a
polynomial over its bytes, taken from running sums, so the cost is a few vector
operations for each byte and no Python object for a word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RUN = 1 << 21
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
# White space and all other ASCII characters but letters and digits.
MARKS = np.ones(256, dtype=bool)
MARKS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))


class _Powers:
    """Powers of the base and of its inverse, as many as were asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, _RUN + 1)
            one = np.ones(size, dtype=np.uint64)
            one[1:] = np.uint64(_BASE)
            self.up = np.cumprod(one, dtype=np.uint64)
            one[1:] = np.uint64(_UNBASE)
            self.down = np.cumprod(one, dtype=np.uint64)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def _segments(
    data: np.ndarray, offsets: np.ndarray, separators: np.ndarray
) -> Iterator[tuple[int, int, int]]:
    """(document, start, end): documents, long ones cut between words."""
    for doc, (start, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        while end - start > _RUN:
            spaces = np.flatnonzero(separators[data[start : start + _RUN]])
            if len(spaces):
                cut = start + int(spaces[-1]) + 1
            else:
                later = np.flatnonzero(separators[data[start + _RUN : end]])
                cut = start + _RUN + int(later[0]) + 1 if len(later) else end
            yield doc, start, cut
            start = cut
        if end > start:
            yield doc, start, end


def _hash_run(
    data: np.ndarray, firsts: np.ndarray, separators: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a run of bytes and their starts; no word crosses ``firsts``."""
    data = _LOWER[data]
    word = ~separators[data]
    before = np.empty_like(word)
    before[0], before[1:] = False, word[:-1]
    before[firsts] = False
    starts = np.flatnonzero(word & ~before)
    after = np.empty_like(word)
    after[-1], after[:-1] = False, word[1:]
    after[firsts[firsts > 0] - 1] = False
    ends = np.flatnonzero(word & ~after) + 1
    up, down = _POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * up[:-1], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64)), starts


def word_hashes(
    texts: pa.Array, separators: np.ndarray = SPACES
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each text the index of its first word."""
    n = len(texts)
    texts = texts.cast(pa.large_string())
    _, offsets_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offsets_buffer, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    if n == 0 or offsets[-1] == offsets[0]:
        return np.empty(0, dtype=np.uint64), np.zeros(n + 1, dtype=np.int64)
    data = np.frombuffer(data_buffer, dtype=np.uint8)
    hashes: list[np.ndarray] = []
    counts = np.zeros(n, dtype=np.int64)
    run: list[tuple[int, int, int]] = []

    def flush() -> None:
        base = run[0][1]
        firsts = np.array([s - base for _, s, _ in run], dtype=np.int64)
        h, starts = _hash_run(data[base : run[-1][2]], firsts, separators)
        owner = np.searchsorted(firsts, starts, side="right") - 1
        np.add.at(counts, np.array([d for d, _, _ in run])[owner], 1)
        hashes.append(h)
        run.clear()

    for segment in _segments(data, offsets, separators):
        if run and segment[2] - run[0][1] > _RUN:
            flush()
        run.append(segment)
    if run:
        flush()
    index = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(counts, out=index[1:])
    return np.concatenate(hashes), index


def runs_of(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words; ``k`` is part of the hash."""
    rolled = np.full(max(len(words) - k + 1, 0), np.uint64(k) * np.uint64(_BASE % (1 << 60)))
    for i in range(k):
        rolled += words[i : i + len(rolled)] * np.uint64(pow(0xD6E8FEB86659FD93, i + 1, 1 << 64))
    return mix(rolled)


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of ``k`` words.

    A text with fewer words has one shingle, all its words; one without words has none.
    """
    words, index = word_hashes(texts)
    rolled = runs_of(words, k)
    for start, end in zip(index[:-1].tolist(), index[1:].tolist()):
        n = end - start
        if n >= k:
            yield np.unique(rolled[start : end - k + 1])
        elif n:
            yield runs_of(words[start:end], n)
        else:
            yield np.empty(0, dtype=np.uint64)


def set_key(hashes: np.ndarray) -> bytes:
    """A 128-bit name of a set of hashes."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
