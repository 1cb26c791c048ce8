"""Word and shingle hashes of one text in numpy, in bounded pieces.

Words are maximal runs without the six ASCII white-space characters.
"""

from __future__ import annotations

import numpy as np

PIECE = 1 << 20  # bytes hashed at a time; pieces end at white space

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (the splitmix64 constants)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    p = np.full(n, _BASE, dtype=np.uint64)
    p[0] = 1
    return np.cumprod(p)


def _piece_hashes(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, dtype=np.uint8)
    inside = ~_SPACE[b]
    if not inside.any():
        return np.empty(0, dtype=np.uint64)
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    starts = np.flatnonzero(edge == 1)
    ends = np.flatnonzero(edge == -1)
    pos = np.flatnonzero(inside)
    lengths = ends - starts
    word_at = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    offset = np.arange(len(pos)) - np.repeat(word_at, lengths)
    terms = (b[pos].astype(np.uint64) + np.uint64(1)) * _powers(int(lengths.max()))[offset]
    return mix(np.add.reduceat(terms, word_at) + lengths.astype(np.uint64))


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hash of every word, in order."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if len(data) <= PIECE:
        return _piece_hashes(data)
    out, start = [], 0
    while start < len(data):
        end = min(start + PIECE, len(data))
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        out.append(_piece_hashes(data[start:end]))
        start = end
    return np.concatenate(out)


def shingles(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Hash of each window of k words; a shorter, not empty text is one window."""
    n = len(words)
    if n == 0:
        return words
    if n < k:
        out, m = np.full(1, n, dtype=np.uint64), n
    else:
        out, m = np.full(n - k + 1, k, dtype=np.uint64), k
    mult = 1
    for j in range(m):
        mult = (mult * _BASE + 2 * j + 1) & 0xFFFFFFFFFFFFFFFF | 1
        out = out + words[j : j + len(out)] * np.uint64(mult)
    return mix(out)
