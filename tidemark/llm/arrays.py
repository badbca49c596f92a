"""Words of Arrow text batches as numpy arrays, without a Python loop over texts or words."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RNG = np.random.default_rng(20240229)
# Multilinear hashing: a random number per byte value times one per place in the word.
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RNG.integers(1, 1 << 63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LAP = _RNG.integers(1, 1 << 63, dtype=np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Words are runs of anything but ASCII white space.
NOT_SPACE = ~SPACE
#: Words are runs of ASCII digits, ASCII letters and all that is not ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row and the bounds of each; NULL is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(bounds):
        bounds = np.zeros(1, np.int64)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[bounds[0] : bounds[-1]] if buffer is not None else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]


@dataclass
class Words:
    """Words of a run of texts: 64-bit hash of each, where it starts and ends, and the bounds of
    each text's words."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def owner(self) -> np.ndarray:
        """Number of the text each word stands in."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def words(data: np.ndarray, bounds: np.ndarray, sign: np.ndarray) -> Words:
    """Runs of bytes for which ``sign`` holds, A-Z lower-cased; a text's end ends a word."""
    inside = sign[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    heads = bounds[:-1][np.diff(bounds) > 0]
    tails = bounds[1:][np.diff(bounds) > 0] - 1
    first[heads] = inside[heads]
    last[tails] = inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    at = np.searchsorted(starts, bounds)
    if not len(starts):
        return Words(np.zeros(0, np.uint64), starts, ends, at)
    return Words(byte_hashes(LOWER[data[inside]], ends - starts), starts, ends, at)


def byte_hashes(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of each run of ``data``; the runs, none of them empty, follow one another."""
    before = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(before, lengths)
    value = _BYTE[data]
    if lengths.max() > len(_PLACE):
        value *= _PLACE[place % len(_PLACE)] + (place // len(_PLACE)).astype(np.uint64) * _LAP
    else:
        value *= _PLACE[place]
    return mixed(np.add.reduceat(value, before) + lengths.astype(np.uint64))


def runs(hashes: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``n`` words from each place on; ``n - 1`` fewer than there are words."""
    factors = np.random.default_rng(seed + 77).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:m] * factors[0]
    for i in range(1, n):
        out += hashes[i : m + i] * factors[i]
    return mixed(out)


def expanded(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (count numbers) for each pair."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)
