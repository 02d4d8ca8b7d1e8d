r"""Resampling documents towards a target distribution by hashed n-gram weights.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower
cased.  A text's words, joined by one space, are scanned once: the running
CRC-32 is kept at every word's end.  The CRC of any span follows from the two
prefixes: ``crc(A + B) = shift(crc(A), len(B)) ^ crc(B)``, where ``shift`` is
the effect of len(B) zero bytes, a linear map over GF(2).  So an n-gram of any
order costs one shift, by powers of two of the map, and one exclusive or.

An n-gram's bucket is its CRC modulo ``buckets``.  The gain of a bucket is the
log ratio of its share in the target to its share in all documents, in
thousandths, rounded down; a document's weight is the sum over its n-grams.
Gumbel noise drawn from a hash of the doc_id turns the weights into a sample
without replacement: the highest scores are drawn.

A null or wordless text has no features and weight 0, and is never drawn.  A
null doc_id draws as if it were the empty string and loses ties.  Rows that
share a doc_id are rows of their own, with the same noise.  A very long text is
scanned in stretches of ``WINDOW`` bytes.  Extra columns are ignored unless
asked for; an empty table gives no rows, an empty target makes all n-grams of
the documents about equally unlikely.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadbay.llm import words as W
from loadbay.llm.common import running_total, stash

BUCKETS = 10_000
NOISE_SEED = 2024
SHARE = 10
LEAST_WORDS = 20
#: Bytes of one text that are held as words at a time.
WINDOW = 1 << 20

_CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_STEP = np.array([crc32(bytes([b])) ^ crc32(b"\0") for b in range(256)], np.uint32)


def _lanes(images: np.ndarray) -> np.ndarray:
    """A linear map given by the images of the 32 unit bits, as four tables by
    the bytes of its argument."""
    values = np.arange(256)
    out = np.zeros((4, 256), np.uint32)
    for bit in range(32):
        out[bit // 8, (values >> bit % 8 & 1) == 1] ^= images[bit]
    return out


def _mapped(lanes: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (lanes[0][c & 255] ^ lanes[1][c >> 8 & 255] ^ lanes[2][c >> 16 & 255] ^ lanes[3][c >> 24])


def _powers(count: int) -> list[np.ndarray]:
    """The effect of 1, 2, 4, ... zero bytes on a CRC."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    images = _STEP[bits & 255] ^ (bits >> 8)
    out = []
    for _ in range(count):
        out.append(_lanes(images))
        images = _mapped(out[-1], images)
    return out


_SHIFTS = _powers(40)


def shift(crc: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRCs after ``size`` zero bytes more, without the effect of the start value."""
    out = crc.copy()
    for b in range(int(size.max(initial=0)).bit_length()):
        on = np.flatnonzero(size >> b & 1)
        out[on] = _mapped(_SHIFTS[b], out[on])
    return out


def _after_space(crc: np.ndarray) -> np.ndarray:
    """The running CRC one separator further."""
    x = ~crc
    return ~(_STEP[(x ^ 0x20) & 255] ^ (x >> 8))


def _stretches(text: bytes, n: int, window: int) -> Iterator[tuple[list[bytes], list[int], int, int]]:
    """(words, running CRC at each one's end, CRC before the first one, how many
    of them the stretch before had): a text's words in stretches of about
    ``window`` bytes that overlap by n - 1 words."""
    clean = text.translate(_CLEAN)
    step = lambda c, w: crc32(w, crc32(b" ", c))
    at, words, ends, crc = 0, [], [], 0
    while at < len(clean):
        end = clean.find(b" ", at + window)
        end = len(clean) if end < 0 else end
        new = clean[at:end].split()
        at = end
        if not new:
            continue
        known = min(n - 1, len(words))
        cut = len(words) - known
        if cut:
            crc = crc32(b" ", ends[cut - 1])
        if known:
            words, ends = words[cut:] + new, ends[cut:] + list(accumulate(new, step, initial=ends[-1]))[1:]
        else:
            words, ends = new, list(accumulate(new[1:], step, initial=crc32(new[0], crc)))
        yield words, ends, crc, known


def gram_crcs(texts: Sequence[bytes], n: int, window: int = WINDOW) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Every n-gram of 1 to n words of the texts, some at a time: the n-grams'
    texts, their CRCs, and the texts of the words counted on the way."""
    ends, sizes, of, first, old = [], [], [], [], []

    def grams():
        e, size, text = np.array(ends, np.uint32), np.array(sizes, np.int64), np.repeat(*np.array(of).T)
        places = np.array([p for p, _ in first])
        start = np.empty_like(e)
        start[1:] = _after_space(e[:-1])
        start[places] = np.array([c for _, c in first], np.uint32)
        stretch = np.zeros(len(e), np.int64)
        stretch[places] = 1
        stretch = np.cumsum(stretch)
        known = np.zeros(len(e), bool)
        for p, k in old:
            known[p: p + k] = True
        total = np.concatenate([[0], np.cumsum(size + 1)])
        who, crc = [], []
        for k in range(1, min(n, len(e)) + 1):
            a, b = np.arange(len(e) - k + 1), np.arange(k - 1, len(e))
            new = (stretch[a] == stretch[b]) & ~known[b]
            a, b = a[new], b[new]
            crc.append(e[b] ^ shift(start[a], total[b + 1] - total[a] - 1))
            who.append(text[b])
        return np.concatenate(who), np.concatenate(crc), text[~known]

    for r, text in enumerate(texts):
        for words, at, crc, known in _stretches(text, n, window):
            first.append((len(ends), crc))
            if known:
                old.append((len(ends), known))
            ends.extend(at)
            sizes.extend(map(len, words))
            of.append((r, len(words)))
            if len(ends) >= window:
                yield grams()
                ends, sizes, of, first, old = [], [], [], [], []
    if ends:
        yield grams()


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of the batch, a block at a time; null is empty."""
    data, off = W.buffers(batch.column(column))
    for i, j in W.blocks(off):
        yield i, [data[off[r]: off[r + 1]].tobytes() for r in range(i, j)]


def _counter(n: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts in _texts(batch, 0):
                for _, crc, _ in gram_crcs(texts, n):
                    counts += np.bincount(crc % buckets, minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["bucket", "n"])
    return run


def bucket_counts(rows: DataFrame, n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: n-grams of all texts per bucket; one row per task and bucket
    is shuffled."""
    return (rows.select("text").mapInArrow(_counter(n, buckets), "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(target: dict[int, int], raw: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket from the counts in the target and in all documents."""
    t_all, s_all = float(sum(target.values()) + buckets), float(sum(raw.values()) + buckets)
    return np.array([
        math.floor(1000 * math.log(float(target.get(b, 0) + 1) * s_all / (float(raw.get(b, 0) + 1) * t_all)))
        for b in range(buckets)], np.int64)


def _weigher(gain: np.ndarray, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, grams, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for i, texts in _texts(batch, 0):
                m = len(texts)
                for who, crc, text in gram_crcs(texts, n):
                    grams[i: i + m] += np.bincount(who, minlength=m)
                    words[i: i + m] += np.bincount(text, minlength=m)
                    # Sums of integers below 2**53 are exact.
                    weight[i: i + m] += np.bincount(who, gain[crc % len(gain)], m).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(words), pa.array(grams), pa.array(weight)],
                names=[*batch.schema.names[1:], "n_words", "n_features", "weight"])
    return run


def resample(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = BUCKETS, share: int = SHARE,
             least_words: int = LEAST_WORDS, seed: int = NOISE_SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_features, weight, score, rank (and the columns in ``carry``) of
    every document; rank is null for a document that is not drawn.

    ``share`` per cent of the documents with ``least_words`` words or more are
    drawn, ties to the smaller doc_id.  The two count tables (one row per
    bucket, a parameter) are all that reaches the driver."""
    raw, wanted = ({r[0]: r[1] for r in bucket_counts(x, n, buckets).collect()} for x in (docs, target))
    gain = gains(wanted, raw, buckets)
    rows = docs.select("text", F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).alias(f"_of_{c}") for c in carry])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    weighed = rows.mapInArrow(_weigher(gain, n), f"{schema}, n_words long, n_features long, weight long")
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(hashed, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = stash(weighed.withColumn("score", (F.col("weight") + noise).cast("long")), "importance-scored")
    able = F.col("n_words") >= least_words
    drawn = scored.where(able).count() * share // 100
    placed = running_total(
        scored.where(able).withColumn("_down", -F.col("score")).withColumn("_no_id", F.col("doc_id").isNull()),
        [], ["_down", "_no_id", "doc_id", "weight"], F.lit(1), "_at")
    rank = F.when(F.col("_at") < drawn, F.col("_at") + 1).cast("long").alias("rank")
    cols = ["doc_id", "n_features", "weight", "score"]
    kept = [F.col(f"_of_{c}").alias(c) for c in carry]
    return placed.select(*cols, rank, *kept).unionByName(
        scored.where(~able).select(*cols, F.lit(None).cast("long").alias("rank"), *kept))
