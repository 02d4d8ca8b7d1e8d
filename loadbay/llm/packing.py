"""Packing documents into token sequences along a space-filling curve.

A document's words are hashed into a signed count vector, which a fixed random
matrix projects to three dimensions; the point's place on a Hilbert curve is
the document's key.  Documents are ordered by (key, doc_id) over range
partitions, their token counts summed along the order, and the stream of
tokens is cut every ``length`` tokens.  The last, shorter stretch is cut into
powers of two, so nothing is padded.

A null text is empty (its tokens are the end id alone).  Null doc_ids sort
first among equal keys; repeated rows are packed once each.  Extra columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadbay.llm import words as W
from loadbay.llm.common import running_total, stash, text_batches
from loadbay.llm.tokens import encoder, text_ids

LENGTH = 4096
END_ID = 2
DIMS = 3
BITS = 10
BUCKETS = 64
#: Text bytes tokenised at a time: the larger, the fewer repeats of a word and
#: the more memory of the worker.
BLOCK = 2 << 20


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of integer points (one row each, coordinates below 2**bits) on
    the Hilbert curve.

    From the highest bit down, a cell's corner order is the Gray code of its
    coordinates' bits; each level reflects or swaps axes for the levels below.
    """
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for d in range(dims):
            bit = (x[d] >> b & 1).astype(bool)
            swap = np.where(bit, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(bit, low, swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> b & 1, (1 << b) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            key = key << 1 | (x[d] >> b & 1)
    return key


def document_points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hashed word vectors of a block's texts, projected to a grid."""
    h, at = W.word_hashes(data, offsets)
    n = len(offsets) - 1
    doc = np.repeat(np.arange(n), np.diff(at))
    sign = 1.0 - 2.0 * (h >> np.uint64(63)).astype(np.float64)
    vec = np.bincount(doc * BUCKETS + (h % np.uint64(BUCKETS)).astype(np.int64), sign,
                      n * BUCKETS).reshape(n, BUCKETS)
    vec /= np.maximum(np.linalg.norm(vec, axis=1, keepdims=True), 1e-9)
    flat = vec @ np.random.default_rng(5).normal(size=(BUCKETS, DIMS))
    return np.clip((np.tanh(flat) + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)


def _tokenised(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = encoder(path).dtype
        end = np.array([end_id], dtype)
        for batch in batches:
            data, off = W.buffers(batch.column(1))
            for i, j in W.blocks(off, BLOCK):
                key = np.concatenate([
                    hilbert_keys(document_points(data[off[i + a]: off[i + b]], off[i + a: i + b + 1] - off[i + a]))
                    for a, b in W.blocks(off[i: j + 1], W.SMALL_BLOCK)])
                ids, at = text_ids(batch.column(1).slice(i, j - i), path)
                each = [np.concatenate([ids[at[r]: at[r + 1]], end]).tobytes() for r in range(j - i)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(key), pa.array(np.diff(at) + 1),
                     pa.array(each, pa.binary())], names=["doc_id", "key", "doc_tokens", "ids"])
    return run


def tail_starts(total: int, length: int) -> list[int]:
    """Where the sequences after the last full one begin: the rest is cut into
    powers of two, largest first."""
    at, starts = total - total % length, []
    while at < total:
        starts.append(at)
        at += 1 << ((total - at).bit_length() - 1)
    return starts


def _cutter(path: str, total: int, length: int):
    tail = np.array(tail_starts(total, length), np.int64)
    full = total // length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = encoder(path).dtype
        for batch in batches:
            doc, first, n, at, seq, crc, sizes = [], [], [], [], [], [], []
            places = batch.column(1).to_pylist()
            for r, blob in enumerate(batch.column(2)):
                ids = np.frombuffer(blob.as_buffer(), dtype).astype("<u4")
                s, e = places[r], places[r] + len(ids)
                cuts = np.concatenate([np.arange(s // length + 1, min((e - 1) // length, full) + 1) * length,
                                       tail[(tail > s) & (tail < e)]])
                edge = np.unique(np.concatenate([[s], cuts[(cuts > s) & (cuts < e)], [e]])).tolist()
                for x, y in zip(edge, edge[1:]):
                    in_tail = x >= full * length
                    k = int(np.searchsorted(tail, x, "right")) - 1 if in_tail else 0
                    doc.append(r)
                    first.append(x - s)
                    n.append(y - x)
                    crc.append(zlib.crc32(ids[x - s: y - s]))
                    sizes.append(len(ids))
                    seq.append(full + k if in_tail else x // length)
                    at.append(x - (int(tail[k]) if in_tail else x // length * length))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc, pa.int64())),
                 *[pa.array(v, pa.int64()) for v in (first, n, crc, sizes, seq, at)]],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    with text_batches(docs.sparkSession):
        coded = stash(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                      .mapInArrow(_tokenised(path, end_id), "doc_id long, key long, doc_tokens long, ids binary")
                      .withColumn("row", F.monotonically_increasing_id()), "pack-ids")
    placed = running_total(coded.select("row", "doc_id", "key", "doc_tokens"), [], ["key", "doc_id", "row"],
                           F.col("doc_tokens"), "place")
    total = coded.agg(F.sum("doc_tokens")).first()[0] or 0
    return (placed.select("row", "place").join(coded.select("row", "doc_id", "ids"), "row")
            .select("doc_id", "place", "ids")
            .mapInArrow(_cutter(path, total, length),
                        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                        "sequence_id long, offset long"))
