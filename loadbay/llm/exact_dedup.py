"""Exact duplicates by composable polynomial fingerprints.

A text (each white-space run replaced by one space) is cut into chunks of
``CHUNK`` bytes.  A chunk's hash is its bytes as a polynomial modulo two
primes.  Hashes compose: ``hash(A + B) = hash(A) * base**len(B) + hash(B)``, so
chunks are hashed on their own, in any order, and joined by length-shifted
sums.  Documents with equal fingerprints are then compared with the group's
first document chunk by chunk, as a stream of chunk rows; one that differs (a
fingerprint collision) is classed by its SHA-256 instead.

A null text counts as empty.  Null doc_ids sort last: they are the keeper only
of a group without any doc_id, and keep_id is then null.  Repeated rows are
separate rows of their group; of rows that share the smallest doc_id (or have
none) exactly one is kept.  A very long text is hashed and compared chunk by
chunk.  Extra columns are ignored, whatever their names; an empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadbay.llm import words as W
from loadbay.llm.common import WHITE, attach_group, stash, text_batches

CHUNK = 1 << 16
PRIMES = (2147483647, 2147483629)
BASES = (1000003, 919393)
#: Copies compared with one copy of their keeper's chunks.
COMPARE = 128
LAST_ID = (1 << 63) - 1

_shift: dict[tuple[int, int], np.ndarray] = {}


def _powers(base: int, prime: int) -> np.ndarray:
    """base**(CHUNK-1) .. base**0 modulo prime."""
    if (base, prime) not in _shift:
        p = [1]
        for _ in range(CHUNK):
            p.append(p[-1] * base % prime)
        _shift[base, prime] = np.array(p[:CHUNK][::-1], np.uint64)
    return _shift[base, prime]


def combine(a: tuple[int, int], b: tuple[int, int], base: int, prime: int) -> tuple[int, int]:
    """(hash, length) of the bytes of ``a`` followed by those of ``b``."""
    return (a[0] * pow(base, b[1], prime) + b[0]) % prime, a[1] + b[1]


def chunk_hashes(data: np.ndarray, base: int, prime: int) -> list[tuple[int, int]]:
    """(hash, length) of each chunk.  A sum of CHUNK products of a byte and a
    residue stays below 2**55, so one reduction per chunk is enough."""
    p = _powers(base, prime)
    out = []
    for s in range(0, len(data), CHUNK):
        c = data[s: s + CHUNK].astype(np.uint64)
        out.append((int(np.dot(c, p[CHUNK - len(c):]) % np.uint64(prime)), len(c)))
    return out


def fingerprint(data: np.ndarray, base: int, prime: int) -> int:
    whole = (0, 0)
    for c in chunk_hashes(data, base, prime):
        whole = combine(whole, c, base, prime)
    return whole[0]


def _clean_texts(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, normalised bytes) of every text, a block at a time."""
    data, off = W.buffers(texts)
    for i, j in W.blocks(off, W.SMALL_BLOCK):
        clean, at = W.one_space(data[off[i]: off[j]], off[i: j + 1] - off[i])
        for r in range(i, j):
            yield r, clean[at[r - i]: at[r - i + 1]]


def _prints(primes: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sha, size, f = [], [], []
            for _, text in _clean_texts(batch.column(1)):
                sha.append(hashlib.sha256(text).hexdigest())
                size.append(len(text))
                f.append(fingerprint(text, BASES[0], primes[0]) << 31 | fingerprint(text, BASES[1], primes[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sha, pa.string()), pa.array(size, pa.int64()), pa.array(f, pa.int64())],
                names=["id", "text_sha256", "n_bytes", "f"])
    return run


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (..., text_sha256, text) -> (..., text_sha256, chunk_no, chunk),
    a few chunks at a time; a row of the same doc_id with another text is not
    the one asked for."""
    for batch in batches:
        rows, nos, parts, held = [], [], [], 0
        wanted = batch.column(batch.num_columns - 2).to_pylist()
        for r, text in _clean_texts(batch.column(batch.num_columns - 1)):
            if hashlib.sha256(text).hexdigest() != wanted[r]:
                continue
            for no, s in enumerate(range(0, max(len(text), 1), CHUNK)):
                parts.append(text[s: s + CHUNK].tobytes())
                rows.append(r)
                nos.append(no)
                held += len(parts[-1])
                if held >= 64 * CHUNK:
                    yield _chunk_batch(batch, rows, nos, parts)
                    rows, nos, parts, held = [], [], [], 0
        if rows:
            yield _chunk_batch(batch, rows, nos, parts)


def _chunk_batch(batch: pa.RecordBatch, rows: list, nos: list, parts: list) -> pa.RecordBatch:
    kept = [batch.column(c).take(pa.array(rows, pa.int64())) for c in range(batch.num_columns - 1)]
    return pa.RecordBatch.from_arrays(
        [*kept, pa.array(nos, pa.int32()), pa.array(parts, pa.binary())],
        names=[*batch.schema.names[:-1], "chunk_no", "chunk"])


def exact_groups(docs: DataFrame, primes: tuple[int, int] = PRIMES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"), "text")
    # Rows are numbered as they are written: the number tells rows of one id apart.
    with text_batches(docs.sparkSession):
        printed = stash(texts.mapInArrow(
            _prints(primes), "id long, text_sha256 string, n_bytes long, f long")
            .select("*", F.monotonically_increasing_id().alias("row"), F.lit(1).alias("one")), "exact-prints")
    group = ["n_bytes", "f"]
    found = {"first": ("min", F.struct("id", "row")), "alike": ("sum", "one")}
    alike = stash(attach_group(printed, group, found, "exact-groups"), "exact-alike")

    # Copies are dealt into parts; each part gets its own copy of the keeper's chunks.
    parts = F.ceil(F.col("alike") / F.lit(COMPARE)).cast("int")
    is_first = F.col("row") == F.col("first.row")
    to_compare = alike.where("alike > 1").select(
        "id", *group, F.col("first.id").alias("first"), is_first.alias("is_first"),
        F.explode(F.when(is_first, F.sequence(F.lit(0), parts - 1))
                  .otherwise(F.array(F.pmod(F.xxhash64("id"), parts).cast("int")))).alias("part"),
        "text_sha256").distinct()
    # A text is found by its id and its SHA-256, so rows that share an id (or
    # have none) do not meet each other's texts.
    clean = F.regexp_replace(F.coalesce("text", F.lit("")), WHITE, " ")
    asked = texts.select("id", F.sha2(clean, 256).alias("text_sha256"), "text")
    with text_batches(docs.sparkSession):
        streamed = stash(
            to_compare.hint("merge").join(asked, ["id", "text_sha256"])
            .select("id", *group, "first", "is_first", "part", "text_sha256", "text")
            .mapInArrow(_chunks, "id long, n_bytes long, f long, first long, is_first boolean, part int, "
                                 "text_sha256 string, chunk_no int, chunk binary"), "exact-chunks")
    keys = ["first", *group, "part", "chunk_no"]
    keeper = streamed.where("is_first").select(*keys, F.col("chunk").alias("kept_chunk")).dropDuplicates(keys)
    odd = stash(streamed.where("not is_first").join(keeper.hint("merge"), keys, "left")
                .where(~F.col("chunk").eqNullSafe(F.col("kept_chunk")))
                .select("id", "text_sha256").distinct(), "exact-odd")
    whole = alike
    if not odd.isEmpty():  # fingerprints collided: those rows are classed by their SHA-256
        classed = printed.join(odd.withColumn("odd", F.col("text_sha256")).hint("merge"), ["id", "text_sha256"], "left")
        classed = classed.withColumn("odd", F.coalesce("odd", F.lit("")))
        whole = attach_group(classed, [*group, "odd"], found, "exact-groups")
    back = lambda c: F.nullif(F.col(c), F.lit(LAST_ID))
    return whole.select(back("id").alias("doc_id"), back("first.id").alias("keep_id"),
                        F.col("alike").alias("group_size"), (F.col("row") == F.col("first.row")).alias("kept"),
                        "text_sha256")
