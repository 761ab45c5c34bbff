"""Numpy helpers shared by the text operators: words, word hashes and five-word shingles.

A word is a maximal run of bytes other than space and 0x09-0x0D. Words are hashed from their bytes
with a polynomial over 64-bit random byte values, so a whole batch of documents is hashed with a few
array operations; shingle hashes combine the hashes of consecutive words. Equal words always
hash equal; different ones collide with a chance of about 2**-64.
"""

from __future__ import annotations

import numpy as np

SHINGLE = 5
SEGMENT_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLD = _BYTE.copy()
_FOLD[65:91] = _BYTE[97:123]
_MULT = _rng.integers(1, 2**62, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHORT = _rng.integers(1, 2**62, SHINGLE, dtype=np.uint64)

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(name: str, base: int, n: int) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        step = np.full(max(n, 4096), base, dtype=np.uint64)
        step[0] = 1
        have = _POWERS[name] = np.cumprod(step, dtype=np.uint64)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte offsets of the words of one text."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[np.frombuffer(data, dtype=np.uint8)]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray, fold_case: bool) -> np.ndarray:
    """64-bit hash of each word; ``fold_case`` hashes A-Z as a-z. Works in segments, so the extra
    memory does not grow with the text."""
    buf = np.frombuffer(data, dtype=np.uint8)
    table = _FOLD if fold_case else _BYTE
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(int(np.searchsorted(ends, base + SEGMENT_BYTES, side="right")), i + 1)
        stop = int(ends[j - 1])
        n = stop - base
        run = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(table[buf[base:stop]] * _powers("up", _BASE, n)[:n], out=run[1:], dtype=np.uint64)
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (run[e] - run[s]) * _powers("down", _INVERSE, n)[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


def window_hashes(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words; empty if there are fewer words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    acc = words[:n] * _MULT[0]
    for k in range(1, size):
        acc = acc + words[k:n + k] * _MULT[k]
    return mix(acc)


def shingle_set(data: bytes) -> np.ndarray:
    """Sorted distinct hashes of the case-folded five-word shingles of a text.

    A text with one to four words has one shingle, the whole sequence; one without words has none.
    """
    starts, ends = word_bounds(data)
    if len(starts) == 0:
        return np.empty(0, dtype=np.uint64)
    words = word_hashes(data, starts, ends, True)
    if len(words) < SHINGLE:
        return mix((words * _MULT[:len(words)]).sum(dtype=np.uint64, keepdims=True) + _SHORT[len(words)])
    return np.unique(window_hashes(words))


def repeated_words(data: bytes, starts: np.ndarray, ends: np.ndarray) -> int:
    """Number of words that lie in a five-word window found at least twice in the text."""
    windows = window_hashes(word_hashes(data, starts, ends, False))
    if len(windows) < 2:
        return 0
    order = np.sort(windows)
    twice = order[1:][order[1:] == order[:-1]]
    if len(twice) == 0:
        return 0
    found = np.isin(windows, twice)
    covered = np.zeros(len(starts), dtype=bool)
    for k in range(SHINGLE):
        covered[k:k + len(found)] |= found
    return int(covered.sum())
