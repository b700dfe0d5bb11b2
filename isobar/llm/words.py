"""Words of many texts at once, as hashes in numpy arrays.

A word is a run of ASCII letters, digits and characters beyond ASCII; A-Z are lower-cased.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from isobar.llm.arrow import text_bytes

_U64 = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly; different numbers stay different."""
    x = (x ^ (x >> _U64(33))) * _U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U64(33))) * _U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U64(33))


def odd_numbers(count: int, seed: int) -> np.ndarray:
    return mixed(np.arange(1, count + 1, dtype=_U64) * _U64(0x9E3779B97F4A7C15) + _U64(seed)) | _U64(1)


def _letter_tables() -> tuple[np.ndarray, np.ndarray]:
    byte = np.arange(256)
    folded = np.where((byte >= 0x41) & (byte <= 0x5A), byte + 32, byte)
    inside = (byte >= 0x80) | ((folded >= 0x61) & (folded <= 0x7A)) | ((byte >= 0x30) & (byte <= 0x39))
    return inside, odd_numbers(256, 5)[folded]


_INSIDE, _LETTER = _letter_tables()
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


@functools.lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def of(base: int) -> np.ndarray:
        factors = np.full(size, base, dtype=_U64)
        factors[0] = 1
        return np.multiply.accumulate(factors)

    return of(_BASE), of(_BASE_INVERSE)


@dataclass(frozen=True)
class Words:
    """``hashes`` of all words in turn; text i has those from ``first[i]`` to ``first[i + 1]``."""

    hashes: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def words_of(texts: pa.Array) -> Words:
    raw, places = text_bytes(texts)
    if not len(raw):
        none = np.empty(0, dtype=np.int64)
        return Words(none.astype(_U64), np.zeros(len(places), dtype=np.int64), none, none)
    inside = _INSIDE[raw]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = places[(places > 0) & (places < len(raw))]
    opens[edges] = inside[edges]  # a word never goes on in the next text
    closes[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    up, down = _powers(1 << max(16, int(len(raw)).bit_length()))
    sums = np.zeros(len(raw) + 1, dtype=_U64)
    np.cumsum(_LETTER[raw] * up[: len(raw)], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U64))
    return Words(hashes, np.searchsorted(starts, places), starts, ends)


def shingles_of(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words, and each text's first; fewer words are one shingle."""
    counts = np.diff(words.first)
    padded = np.append(words.hashes, np.zeros(size, dtype=_U64))
    factors = odd_numbers(size, 77)
    number = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    first = np.concatenate([[0], np.cumsum(number)])
    start = np.repeat(words.first[:-1] - first[:-1], number) + np.arange(first[-1])
    left = np.repeat(words.first[1:], number) - start  # words from here to the end of the text
    total = np.zeros(len(start), dtype=_U64)
    for i in range(size):
        total += np.where(left > i, padded[start + i], _U64(0)) * factors[i]
    return mixed(total + np.minimum(left, size).astype(_U64)), first
