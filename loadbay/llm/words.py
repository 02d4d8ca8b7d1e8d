"""Words and shingles of whole texts as numpy arrays over Arrow buffers.

A word is ``[^\\x20\\x09-\\x0D]+``; A-Z are lower-cased.  Every routine works
on a block of texts at once and its memory is a fixed multiple of the block's
bytes (some 60 times); a block holds ``BLOCK_BYTES`` of text, or one longer
text.  Where rows do not depend on their block, ``SMALL_BLOCK`` is enough: a
worker keeps what its largest block took.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
SMALL_BLOCK = 1 << 18
U64 = np.uint64

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TABLE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)
_MIX = np.random.default_rng(21).integers(1, 1 << 63, 64, dtype=np.uint64) * U64(2) + U64(1)
_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(str(base))
    if have is None or len(have) < n:
        p = np.full(max(n, SMALL_BLOCK + 1, 2 * (0 if have is None else len(have))), base, U64)
        p[0] = 1
        have = _powers[str(base)] = np.cumprod(p, dtype=U64)
    return have[:n]


def scramble(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string array; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64)[texts.offset: texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0]: off[-1]], off - off[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose bytes stay within ``limit`` (or one longer row)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of a block, and each text's range of them."""
    n = len(data)
    if n == 0:
        return np.zeros(0, U64), np.zeros(len(offsets), np.int64)
    word = ~_WHITE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:-1]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(n + 1, U64)
    np.cumsum(_TABLE[_LOWER[data]] * _power(_BASE, n), out=sums[1:])
    h = (sums[e] - sums[s]) * _power(_UNBASE, n + 1)[s]
    return scramble(h + (e - s).astype(U64)), np.searchsorted(s, offsets).astype(np.int64)


def shingle_hashes(words: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each text, in order, repeats kept, and
    each text's range.  A text of 1 to k-1 words has its whole sequence as its
    one shingle; a text without words has none."""
    n = np.diff(at)
    m = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    to = np.concatenate([[0], np.cumsum(m)])
    if to[-1] == 0:
        return np.zeros(0, U64), to
    start = np.repeat(at[:-1] - to[:-1], m) + np.arange(to[-1])
    have = np.repeat(np.minimum(n, k), m)
    out = scramble(have.astype(U64) * _MIX[63])
    for j in range(k):
        src = np.minimum(start + j, len(words) - 1)
        out += np.where(have > j, words[src] * _MIX[j], U64(0))
    return scramble(out), to


def one_space(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block's texts with each white-space run replaced by one space."""
    n = len(data)
    if n == 0:
        return data, offsets
    white = _WHITE[data]
    repeat = np.zeros(n, bool)
    repeat[1:] = white[1:] & white[:-1]
    starts = offsets[:-1][offsets[:-1] < n]
    repeat[starts] = False
    keep = ~repeat
    kept = np.concatenate([[0], np.cumsum(keep)])
    return np.where(white, np.uint8(0x20), data)[keep], kept[offsets]
