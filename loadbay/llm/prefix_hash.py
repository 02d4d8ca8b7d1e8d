"""Document fingerprints from prefix polynomial hashes.

``PrefixHash`` keeps, for every prefix of a text, its code points as a
polynomial modulo two primes.  Differences of two entries give the hash of any
span, so span equality takes constant time, and the longest common prefix or
suffix of two texts is found by binary search.  The fingerprint is the length
and the hash of the whole; the likeness of two fingerprints is the share of
the longer text that their common spans cover: prefix, suffix, and between
edits the spans found anew from anchors, in the same order in both texts.  Any
common span of ``WIDTH + STEP - 1`` code points holds an anchor; shorter ones
count where they touch a prefix, a suffix or an anchor.

``next_document_likeness`` compares every document with an edited copy of
itself and with the next document in order of doc_id.  A null text is empty;
two empty texts are alike (1.0).  Null doc_ids come last in the order; rows
with the same doc_id are ordered by their text.  Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRIMES = (2147483647, 2147483629)
BASES = (131071, 1048583)
#: Text bytes per range of doc_ids, for the next-document pass.
RANGE_BYTES = 16 << 20
LAST_ID = (1 << 63) - 1
#: Code points of an anchor, and from one anchor to the next.
WIDTH = 12
STEP = 4

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(which: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo the prime, doubled up to length."""
    p = _powers[which]
    prime = np.uint64(PRIMES[which])
    while len(p) < n:
        step = np.uint64(pow(BASES[which], len(p), PRIMES[which]))
        p = np.concatenate([p, p * step % prime])
    _powers[which] = p
    return p[:n]


class PrefixHash:
    """Prefix hashes of one text (as an array of code points)."""

    def __init__(self, points: np.ndarray, sums: list[np.ndarray] | None = None):
        self.n = len(points)
        self.points = points
        self.sums = sums
        if sums is None:
            self.sums = []
            for w in (0, 1):
                s = np.zeros(self.n + 1, np.uint64)
                # Terms stay below 2**31, so a sum of 2**32 of them fits.
                np.cumsum((points.astype(np.uint64) + np.uint64(1)) * powers(w, self.n)
                          % np.uint64(PRIMES[w]), out=s[1:])
                self.sums.append(s % np.uint64(PRIMES[w]))

    def span(self, w: int, i: int, j: int) -> int:
        """Hash of code points i to j, still shifted by base**i."""
        return (int(self.sums[w][j]) - int(self.sums[w][i])) % PRIMES[w]

    def equal(self, i: int, other: PrefixHash, k: int, length: int) -> bool:
        """Whether the spans of ``length`` at i here and at k there are equal."""
        for w in (0, 1):
            a, b = self.span(w, i, i + length), other.span(w, k, k + length)
            if i < k:
                a = a * pow(BASES[w], k - i, PRIMES[w]) % PRIMES[w]
            elif k < i:
                b = b * pow(BASES[w], i - k, PRIMES[w]) % PRIMES[w]
            if a != b:
                return False
        return True

    def common(self, i: int, other: PrefixHash, k: int, most: int | None = None) -> int:
        """Longest common extension to the right from i here and k there."""
        low, high = 0, min(self.n - i, other.n - k)
        if most is not None:
            high = min(high, most)
        while low < high:
            mid = (low + high + 1) // 2
            if self.equal(i, other, k, mid):
                low = mid
            else:
                high = mid - 1
        return low

    def common_end(self, other: PrefixHash, i: int | None = None, k: int | None = None,
                   most: int | None = None) -> int:
        """Longest common extension to the left from i here and k there (the ends)."""
        i, k = self.n if i is None else i, other.n if k is None else k
        low, high = 0, min(i, k) if most is None else min(i, k, most)
        while low < high:
            mid = (low + high + 1) // 2
            if self.equal(i - mid, other, k - mid, mid):
                low = mid
            else:
                high = mid - 1
        return low

    def windows(self, at: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the ``WIDTH`` code points at each offset, all shifted to
        base**length, so that they compare between texts."""
        keys = []
        for w in (0, 1):
            prime = np.uint64(PRIMES[w])
            span = (self.sums[w][at + WIDTH] + prime - self.sums[w][at]) % prime
            keys.append(span * powers(w, length + 1)[length - at] % prime)
        return keys[0] << np.uint64(31) | keys[1]

    def fingerprint(self) -> str:
        return f"{self.n:x}-{int(self.sums[0][-1]):08x}{int(self.sums[1][-1]):08x}"

    def cut_and_joined(self, keep: int, other: PrefixHash, take: int) -> PrefixHash:
        """The first ``keep`` code points here followed by ``take`` of the other's,
        its prefix hashes shifted instead of computed anew."""
        sums = []
        for w in (0, 1):
            prime = np.uint64(PRIMES[w])
            shift = np.uint64(pow(BASES[w], keep, PRIMES[w]))
            tail = (self.sums[w][keep] + other.sums[w][1: take + 1] * shift) % prime
            sums.append(np.concatenate([self.sums[w][: keep + 1], tail]))
        return PrefixHash(np.concatenate([self.points[:keep], other.points[:take]]), sums)


def _rising(values: list[int]) -> list[int]:
    """Places of a longest strictly rising subsequence."""
    ends, tops, before = [], [], []
    for r, v in enumerate(values):
        at = bisect.bisect_left(tops, v)
        before.append(ends[at - 1] if at else -1)
        if at == len(ends):
            ends.append(r)
            tops.append(v)
        else:
            ends[at], tops[at] = r, v
    out, r = [], ends[-1] if ends else -1
    while r >= 0:
        out.append(r)
        r = before[r]
    return out[::-1]


def anchors(a: PrefixHash, i0: int, i1: int, b: PrefixHash, k0: int, k1: int) -> list[tuple[int, int]]:
    """Offsets in a and b of equal windows between these bounds, rising in both.

    b is read every ``STEP`` code points and a everywhere.  Windows that a has
    once go first; if there are none, each one of b takes the nearest of a."""
    length = max(a.n, b.n)
    here, there = np.arange(i0, i1 - WIDTH + 1), np.arange(k0, k1 - WIDTH + 1, STEP)
    keys = a.windows(here, length)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    asked = b.windows(there, length)
    low, high = np.searchsorted(keys, asked, "left"), np.searchsorted(keys, asked, "right")
    once = np.flatnonzero(high - low == 1)
    if len(once):
        i, k = here[order[low[once]]], there[once]
    else:
        some = np.flatnonzero(high > low)
        if not len(some):
            return []
        # Offsets rise within a key, so (key, offset) is sorted.
        k, low, high = there[some], low[some], high[some]
        start = np.concatenate([[True], keys[1:] != keys[:-1]])
        number = np.cumsum(start) - 1
        sorted_ = number * len(here) + order
        goal = number[low] * len(here) + np.minimum(k - k0, len(here) - 1)
        right = np.clip(np.searchsorted(sorted_, goal), low, high - 1)
        left = np.maximum(right - 1, low)
        near = np.where(np.abs(sorted_[left] - goal) <= np.abs(sorted_[right] - goal), left, right)
        i = here[order[near]]
    if (np.diff(i) <= 0).any():
        rising = _rising(i.tolist())
        i, k = i[rising], k[rising]
    # The next window on the same diagonal is covered by the extension of the one before.
    first = np.concatenate([[True], (np.diff(k) != STEP) | (np.diff(i) != STEP)])
    return list(zip(i[first].tolist(), k[first].tolist()))


def matched(a: PrefixHash, b: PrefixHash) -> int:
    """Code points of the common spans of both texts, in order."""
    total, boxes = 0, [(0, a.n, 0, b.n)]
    while boxes:
        i0, i1, k0, k1 = boxes.pop()
        head = a.common(i0, b, k0, min(i1 - i0, k1 - k0))
        i0, k0 = i0 + head, k0 + head
        tail = a.common_end(b, i1, k1, min(i1 - i0, k1 - k0))
        i1, k1 = i1 - tail, k1 - tail
        total += head + tail
        if min(i1 - i0, k1 - k0) >= WIDTH:
            found = anchors(a, i0, i1, b, k0, k1)
            if found:
                # A box ends where the next anchor begins: its common suffix is that
                # anchor's extension to the left, the next one's prefix that to the right.
                edges = [(i0, k0), *found, (i1, k1)]
                boxes += [(x[0], y[0], x[1], y[1]) for x, y in zip(edges, edges[1:])]
    return total


def likeness(a: PrefixHash, b: PrefixHash) -> float:
    """Share of the longer text covered by common spans, 0 to 1."""
    if a.n == b.n == 0:
        return 1.0
    return matched(a, b) / max(a.n, b.n)


def _hashed(text: str | None) -> PrefixHash:
    return PrefixHash(np.frombuffer((text or "").encode("utf-32-le"), np.uint32))


def _dealer(bounds: list[int], first: int):
    """Rows to ranges of doc_ids; the first rows of a range also go, marked,
    to the range before, and the very first to the last."""
    edges = np.array(bounds, np.int64)
    heads = {b: k for k, b in enumerate(bounds)}
    heads[first] = len(bounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0))
            own = np.searchsorted(edges, ids, "right").astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own), pa.array(np.zeros(len(ids), bool)), batch.column(0), batch.column(1)],
                names=["range", "after", "id", "text"])
            rows = [r for r, i in enumerate(ids.tolist()) if i in heads]
            if rows:
                part = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([heads[i] for i in part.column(0).to_pylist()], pa.int32()),
                     pa.array(np.ones(len(rows), bool)), part.column(0), part.column(1)],
                    names=["range", "after", "id", "text"])
    return run


_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                  ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                  ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _compared(doc_id: int, own: PrefixHash, after: PrefixHash) -> tuple:
    half = own.n // 2
    edited = own.cut_and_joined(own.n - half, after, min(half, after.n))
    raw = edited.points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return (None if doc_id == LAST_ID else doc_id, own.n,
            hashlib.sha256(raw.encode("utf-8", "surrogatepass")).hexdigest(), own.fingerprint(),
            edited.fingerprint(), likeness(own, edited), likeness(own, after))


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows: each one waits for the next of its range."""
    range_, waiting, out = None, None, []
    for batch in batches:
        for r, after, i, text in zip(*(c.to_pylist() for c in batch.columns)):
            if r != range_:
                range_, waiting = r, None
            hashed = _hashed(text)
            if waiting is not None:
                out.append(_compared(*waiting, hashed))
            waiting = None if after else (i, hashed)
            if len(out) == 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _OUT)],
                                                 schema=_OUT)
                out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _OUT)], schema=_OUT)


def next_document_likeness(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next per document.

    The only shuffle deals the texts by ranges of doc_id, one task a range.  Range bounds are
    doc_ids themselves, so a range's first row is known beforehand and is sent
    to the range before it as well.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"), "text")
    known = rows.agg(F.sum(F.octet_length("text")), F.min("id")).first()
    n = int((known[0] or 0) // RANGE_BYTES) + 1
    bounds: list[int] = []
    if n > 1:
        cut = rows.agg(F.percentile_approx("id", [k / n for k in range(1, n)], 100 * n)).first()[0]
        bounds = [b for b in sorted(set(cut)) if b != known[1]]
    dealt = rows.mapInArrow(_dealer(bounds, known[1] if known[1] is not None else 0),
                            "range int, after boolean, id long, text string")
    return (dealt.repartitionById(len(bounds) + 1, "range")
            .sortWithinPartitions("range", "after", "id", F.coalesce("text", F.lit("")))
            .mapInArrow(_in_order, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                   "edited_fingerprint string, near_edited double, near_next double"))
