"""Words, word hashes and word shingles of whole texts, for use inside tasks.

A word is a maximal run of bytes other than blank, tab, line feed, vertical tab,
form feed and carriage return; A to Z count as a to z.
"""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 5

# Odd multipliers and mixing constants: fixed values.
_ODD = np.array(
    [
        0x9E3779B97F4A7C15,
        0xC2B2AE3D27D4EB4F,
        0x165667B19E3779F9,
        0xD6E8FEB86659FD93,
        0xA0761D6478BD642F,
    ],
    dtype=np.uint64,
)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * _MIX[0]
    x = (x ^ (x >> np.uint64(33))) * _MIX[1]
    return x ^ (x >> np.uint64(33))


def split_words(text: str | bytes | None) -> list[bytes]:
    data = text.encode("utf-8") if isinstance(text, str) else (text or b"")
    return data.lower().split()


def word_hashes(text: str | bytes | None) -> np.ndarray:
    """One 64-bit hash per word, in order."""
    words = split_words(text)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingles(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words.

    Fewer words make one shingle, the whole sequence; no word makes none.
    """
    count = len(hashes)
    if count == 0:
        return hashes
    width = min(size, count)
    total = np.full(count - width + 1, width, dtype=np.uint64)
    for i in range(width):
        odd = _ODD[i % len(_ODD)] + np.uint64(2 * (i // len(_ODD)))
        total += hashes[i : count - width + 1 + i] * odd
        total = mix(total) if i else total
    return np.unique(mix(total))


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many hashes two sorted distinct arrays have in common."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int(np.count_nonzero(b[at] == a))
