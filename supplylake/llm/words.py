"""Words and word shingles of whole texts, a batch at a time in numpy.

A-Z are lower-cased and words are ``[^\\x20\\x09-\\x0D]+``.  A document's set
holds its distinct five-word shingles as 64-bit hashes; with fewer words the
whole sequence is the one element; without words it is empty.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

from .common import text_bytes

SHINGLE_WORDS = 5
#: Words are hashed in stretches of about so many bytes, to bound memory.
STRETCH = 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _letters() -> np.ndarray:
    """A random 64-bit number for each byte, the same for A-Z and a-z."""
    code = np.arange(256, dtype=np.uint64)
    code[65:91] += np.uint64(32)
    return mixed((code + np.uint64(1)) * _ODD)


def exact_letters() -> np.ndarray:
    """As ``_letters``, telling upper from lower case."""
    return mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _ODD)


@lru_cache(maxsize=4)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray,
                letters: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, by prefix sums of a polynomial."""
    base = int(_ODD)
    inverse = pow(base, -1, 1 << 64)
    out = np.empty(len(start), np.uint64)
    need = 1 << 12
    while need < min(STRETCH, len(data)) + 1:
        need *= 2
    up, down = _powers(need, base), _powers(need, inverse)
    i = 0
    while i < len(start):
        lo = start[i]
        j = max(i + 1, int(np.searchsorted(end, lo + need - 1, side="right")))
        n = int(end[j - 1] - lo)
        if n + 1 > len(up):  # one word longer than a stretch
            up, down = _powers(n + 1, base), _powers(n + 1, inverse)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(letters[data[lo:lo + n]] * up[:n], out=total[1:])
        a, b = start[i:j] - lo, end[i:j] - lo
        out[i:j] = (total[b] - total[a]) * down[a]
        i = j
    return mixed(out + (end - start).astype(np.uint64) * _MIX)


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all texts in order, and where each text's words begin."""
    data, cut = text_bytes(column)
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(cut), np.int64)
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(n + 1, bool)
    edge[cut] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last = solid
    last[:-1] &= ~solid[1:] | edge[1:-1]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    return span_hashes(data, start, end, _letters()), np.searchsorted(start, cut)


def _folded(hashes: np.ndarray, width: int) -> np.ndarray:
    x = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for k in range(width):
        x = (x + hashes[k:len(hashes) - width + 1 + k]) * _ODD
        x ^= x >> np.uint64(29)
    return mixed(x)


def shingle_sets(column: pa.Array, width: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Each text's set: ascending distinct unsigned 64-bit shingle hashes."""
    hashes, cut = word_hashes(column)
    every = _folded(hashes, width) if len(hashes) >= width else np.empty(0, np.uint64)
    out = []
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(every[a:b - width + 1]))
        elif b > a:
            out.append(_folded(hashes[a:b], b - a))
        else:
            out.append(np.empty(0, np.uint64))
    return out
