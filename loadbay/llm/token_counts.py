"""Token counts from pre-token frequencies.

Pre-tokens are words and the punctuation after them (see ``tokens``).  Each block of
texts gives its distinct pre-tokens, and each text's frequencies of them by
their place in the block.  The distinct pre-tokens of a block are dealt into
shards by a hash and packed, one row per block and shard; all blocks' rows of a
shard meet in one task, where the library counts the pieces of every distinct
pre-token once.  The counts go back to the blocks and are summed by frequency.
No ids are stored.  A frequent pre-token is one entry per block, like any other,
so it makes no group of its own.

A null text counts as empty.  Null and repeated doc_ids are kept, row by row.
A very long text is a block of its own.  Extra columns are ignored, whatever
their names; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadbay.llm import words as W
from loadbay.llm.common import stash
from loadbay.llm.tokens import KEEP, encoder, pre_tokens

#: Text bytes per block: the larger, the fewer repeats of a pre-token.
BLOCK = 24 << 20
LIMIT = 2048

_SCHEMA = pa.schema([
    ("block", pa.int64()), ("shard", pa.int32()), ("words", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
    ("n_bytes", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int32())), ("places", pa.binary()),
    ("times", pa.binary()), ("shards", pa.binary())])
_PARTS = ("block long, shard int, words binary, doc_ids array<long>, n_bytes array<long>, n_words array<int>, "
          "places binary, times binary, shards binary")


def _packed(x: np.ndarray) -> bytes:
    """Numbers below 2**32 as compressed byte planes (mostly small numbers)."""
    planes = np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zlib.compress(planes.tobytes(), 3)


def _unpacked(x: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(x), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _frequencies(shards: int):
    """One row per block with its texts' frequencies, and one per shard with
    the block's pre-tokens of it, the frequent ones first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            _, off = W.buffers(batch.column(1))
            for i, j in W.blocks(off, BLOCK):
                block += 1
                at, code, names = pre_tokens(batch.column(1).slice(i, j - i))
                text = np.repeat(np.arange(j - i), np.diff(at))
                pair, times = np.unique(text * max(len(names), 1) + code, return_counts=True)
                n = np.bincount(pair // max(len(names), 1), minlength=j - i)
                place = pair % max(len(names), 1)
                # Frequent pre-tokens get small numbers.
                order = np.argsort(-np.bincount(place, minlength=len(names)), kind="stable")
                rank = np.empty_like(order)
                rank[order] = np.arange(len(order))
                words = [names[k].encode() for k in order]
                shard = np.array([zlib.crc32(w) % shards for w in words], np.int64)
                yield pa.RecordBatch.from_pydict({
                    "block": [block], "shard": [None], "words": [None],
                    "doc_ids": [batch.column(0).slice(i, j - i).to_pylist()],
                    "n_bytes": [np.diff(off[i: j + 1])], "n_words": [n.astype(np.int32)],
                    "places": [_packed(rank[place])], "times": [_packed(times)], "shards": [_packed(shard)]}, _SCHEMA)
                parts: dict[int, list[bytes]] = {}
                for s, w in zip(shard.tolist(), words):
                    parts.setdefault(s, []).append(w)
                m = len(parts)
                if m:  # pre-tokens hold no white space
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block] * m, pa.int64()), pa.array(list(parts), pa.int32()),
                         pa.array([zlib.compress(b" ".join(x), 6) for x in parts.values()], pa.binary()),
                         *[pa.nulls(m, f.type) for f in list(_SCHEMA)[3:]]], schema=_SCHEMA)
    return run


def _piece_counter(path: str):
    """Rows (block, shard, words), a shard's rows one after the other -> (block,
    shard, counts); the library sees every distinct word of a shard once (more
    often only where a shard has over ``KEEP`` distinct words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, known = None, {}
        for batch in batches:
            out = []
            for shard, packed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if shard != of or len(known) > KEEP:
                    of, known = shard, {}
                words = zlib.decompress(packed).split(b" ")
                new = [w for w in words if w not in known]
                if new:
                    known.update(zip(new, encoder(path).counted([w.decode() for w in new])[1].tolist()))
                out.append(_packed(np.array([known[w] for w in words], np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["block", "shard", "counts"])
    return run


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, size, n_words, places, times, shards, counts = (batch.column(c) for c in range(7))
        for r in range(batch.num_rows):
            shard = _unpacked(shards[r].as_py())
            pieces = np.zeros(len(shard), np.int64)
            if len(shard):
                known = sorted(counts[r].as_py(), key=lambda x: x["shard"])
                pieces[np.argsort(shard, kind="stable")] = np.concatenate([_unpacked(x["counts"]) for x in known])
            n = np.asarray(n_words[r].values, np.int64)
            each = np.concatenate([[0], np.cumsum(pieces[_unpacked(places[r].as_py())] * _unpacked(times[r].as_py()))])
            end = np.concatenate([[0], np.cumsum(n)])
            yield pa.RecordBatch.from_arrays(
                [ids[r].values, size[r].values, pa.array(each[end[1:]] - each[end[:-1]])],
                names=["doc_id", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per document.

    There are as many shards as the session has shuffle partitions, so a
    shard's distinct pre-tokens stay as few as the cluster is wide."""
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = stash(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                  .mapInArrow(_frequencies(shards), _PARTS), "token-parts")
    words = parts.where("words is not null").select("block", "shard", "words")
    pieces = words.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(
        _piece_counter(path), "block long, shard int, counts binary")
    counted = (pieces.groupBy("block")
               .agg(F.collect_list(F.struct("shard", "counts")).alias("counts")))
    blocks = parts.where("words is null").join(counted.hint("merge"), "block", "left")
    return (blocks.select("doc_ids", "n_bytes", "n_words", "places", "times", "shards", "counts")
            .mapInArrow(_sums, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
