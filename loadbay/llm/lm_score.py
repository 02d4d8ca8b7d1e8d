"""Masked pseudo-likelihood from a small bidirectional window network.

Words (A-Z lower-cased) become ids: the ``FREQUENT`` most frequent words of the
corpus have one each, every other word shares one of ``SHARED`` ids by its hash.
The network sees the ids of the two words to the left and the two to the
right of a masked word: it adds one embedding per position, applies tanh, and
predicts the word's id in two steps (its group, then its place in the group).
Given a shared id, a word has its share of that id's occurrences, from the full
table of word counts: log P(word | context) = log P(id | context) + log P(word | id).
A document's score is the sum of the log-probabilities of all its words.

All documents are counted and all are trained on: every task makes one pass
of mini-batch gradient descent in numpy over its texts, from the same start,
and the parameters of all tasks are averaged by words seen (in rounds of
``FAN_IN``, slice by slice).  The parameters have a fixed size; the word table
grows with the corpus and is never collected: the words with a shared id are
listed once per ``LOOKUP_BYTES`` of text, joined to their counts, and the shares
go back to the block.

A null or empty text has no words: score 0.0 and a null mean.  Null and
repeated doc_ids are kept, row by row.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadbay.llm import words as W
from loadbay.llm.common import stash

GROUPS = 32
PER_GROUP = 64
IDS = GROUPS * PER_GROUP
SHARED = 256
FREQUENT = IDS - SHARED
DIMS = 16
SIDES = (-2, -1, 1, 2)
BATCH = 8192
RATE = 0.5
SLICES = 32
FAN_IN = 64
#: Text bytes whose words are looked up together (or one longer text).
LOOKUP_BYTES = 16 << 20
#: Words of a block in one row.
LISTED = 1 << 14

_SHAPES = {"near": (len(SIDES), IDS + 1, DIMS), "bias": (DIMS,), "group": (DIMS + 1, GROUPS),
           "place": (GROUPS, DIMS + 1, PER_GROUP)}
_SIZE = sum(int(np.prod(s)) for s in _SHAPES.values())


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    """Named views of one flat parameter vector."""
    out, at = {}, 0
    for name, shape in _SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at: at + n].reshape(shape)
        at += n
    return out


def start(frequency: np.ndarray, seed: int = 1) -> np.ndarray:
    """First parameters: small embeddings, and output biases that give every
    id its corpus frequency."""
    flat = np.zeros(_SIZE, np.float32)
    p = unpack(flat)
    rng = np.random.default_rng(seed)
    p["near"][:] = rng.normal(0, 0.1, p["near"].shape)
    p["group"][:-1] = rng.normal(0, 0.1, (DIMS, GROUPS))
    p["place"][:, :-1] = rng.normal(0, 0.1, (GROUPS, DIMS, PER_GROUP))
    share = (frequency + 0.5).reshape(PER_GROUP, GROUPS).T  # id = place * GROUPS + group
    p["group"][-1] = np.log(share.sum(axis=1) / share.sum())
    p["place"][:, -1] = np.log(share / share.sum(axis=1, keepdims=True))
    return flat


def to_ids(hashes: np.ndarray, known: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Ids of word hashes; ``known`` is sorted."""
    shared = FREQUENT + (hashes % np.uint64(SHARED)).astype(np.int64)
    if not len(known):
        return shared
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, ids[at], shared)


def contexts(ids: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Per side, the neighbour's id of every word, or IDS beyond the text."""
    n = len(ids)
    where = np.arange(n)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    first, last = at[:-1][text], at[1:][text]
    out = []
    for s in SIDES:
        o = where + s
        inside = (o >= first) & (o < last)
        out.append(np.where(inside, ids[np.clip(o, 0, max(n - 1, 0))], IDS))
    return out


def _shift(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``x`` less every row's maximum, in place, and the logarithm of the sum
    of its exponentials.  Maxima are taken over a transposed copy: numpy is slow
    over short rows."""
    x -= np.ascontiguousarray(x.T).max(axis=0)[:, None]
    return x, np.log(np.exp(x).sum(axis=1, keepdims=True))


def step(p: dict[str, np.ndarray], ids: np.ndarray, near: list[np.ndarray], rate: float | None) -> np.ndarray:
    """Log-probability of every word; with a rate, also one gradient step.

    Words are put in order of their group once, so that a group is a slice."""
    n = len(ids)
    total = p["near"][0].take(near[0], axis=0)
    total += p["bias"]
    for s in range(1, len(near)):
        total += p["near"][s].take(near[s], axis=0)
    h = np.tanh(total, out=total)
    group, place = ids % GROUPS, ids // GROUPS
    lg = h @ p["group"][:-1]
    lg += p["group"][-1]
    lg, norm = _shift(lg)
    own = np.arange(n) * GROUPS + group
    if rate is None:
        out = (lg.take(own) - norm[:, 0]).astype(np.float64)
    else:
        lg -= norm
        out = lg.take(own).astype(np.float64)
    order = np.argsort(group.astype(np.uint8), kind="stable")
    edge = np.searchsorted(group[order], np.arange(GROUPS + 1)).tolist()
    more, hs, ps = np.zeros(n, np.float32), h.take(order, axis=0), place[order]
    if rate is not None:
        err = np.exp(lg, out=lg)
        err.reshape(-1)[own] -= 1
        back = err @ p["group"][:-1].T
        grad_group = np.concatenate([h.T @ err, err.sum(axis=0, keepdims=True)]) / n
        sorted_back = back.take(order, axis=0)
    for g in range(GROUPS):
        i, j = edge[g], edge[g + 1]
        if i == j:
            continue
        w = p["place"][g]
        hg = hs[i:j]
        lp = hg @ w[:-1]
        lp += w[-1]
        lp, norm = _shift(lp)
        own = np.arange(j - i) * PER_GROUP + ps[i:j]
        if rate is None:
            more[i:j] = lp.take(own) - norm[:, 0]
            continue
        lp -= norm
        more[i:j] = lp.take(own)
        e = np.exp(lp, out=lp)
        e.reshape(-1)[own] -= 1
        sorted_back[i:j] += e @ w[:-1].T
        w -= rate * np.concatenate([hg.T @ e, e.sum(axis=0, keepdims=True)]) / (j - i)
    out[order] += more
    if rate is not None:
        back[order] = sorted_back
        p["group"] -= rate * grad_group
        back *= 1 - h * h
        p["bias"] -= rate * back.mean(axis=0)
        for s, ctx in enumerate(near):
            o = np.argsort(ctx.astype(np.uint16), kind="stable")
            c = ctx[o]
            cut = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
            sums = np.add.reduceat(back.take(o, axis=0), cut, axis=0)
            seen = np.diff(np.concatenate([cut, [n]]))[:, None]
            p["near"][s][c[cut]] -= rate * sums / np.sqrt(seen) / 4
    return out


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, off = W.buffers(batch.column(0))
        for i, j in W.blocks(off, 4 * W.BLOCK_BYTES):
            h, n = np.unique(W.word_hashes(data[off[i]: off[j]], off[i: j + 1] - off[i])[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["word", "n"])


def vocabulary(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, DataFrame]:
    """Sorted hashes of the most frequent words, their ids, the frequency of
    every id (shared ones included), and the counts of all words (word, n),
    from all documents."""
    counts = stash(docs.select("text").mapInArrow(_word_counts, "word long, n long")
                   .groupBy("word").agg(F.sum("n").alias("n")), "lm-words")
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    frequency = np.zeros(IDS)
    frequency[: len(top)] = [r[1] for r in top]
    shared = F.pmod(F.col("word"), F.lit(SHARED))  # the low bits, as of the unsigned hash
    for place, n in counts.groupBy(shared).agg(F.sum("n")).collect():
        frequency[FREQUENT + place] = n
    known = np.array([r[0] for r in top], np.int64).view(np.uint64)
    for h, n in zip(known.tolist(), frequency[: len(top)].tolist()):
        frequency[FREQUENT + h % SHARED] -= n
    order = np.argsort(known)
    return known[order], order.astype(np.int64), frequency, counts


def _blocks(batch: pa.RecordBatch, column: int, known: np.ndarray, ids: np.ndarray):
    data, off = W.buffers(batch.column(column))
    for i, j in W.blocks(off):
        h, at = W.word_hashes(data[off[i]: off[j]], off[i: j + 1] - off[i])
        yield i, j, to_ids(h, known, ids), at, h


def _trainer(flat: np.ndarray, known: np.ndarray, ids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = flat.copy()
        p, seen = unpack(own), 0
        for batch in batches:
            for _, _, w, at, _ in _blocks(batch, 0, known, ids):
                near = contexts(w, at)
                for s in range(0, len(w), BATCH):
                    step(p, w[s: s + BATCH], [c[s: s + BATCH] for c in near], RATE / (1 + seen / 2e6))
                    seen += len(w[s: s + BATCH])
        if seen:
            parts = np.array_split(own, SLICES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(SLICES, dtype=np.int32)), pa.array(np.full(SLICES, seen, np.float64)),
                 pa.array([x.tobytes() for x in parts], pa.binary())], names=["slice", "weight", "part"])
    return run


def _weighted(table: pa.Table) -> pa.Table:
    """Weighted mean of one slice's vectors (at most a few times FAN_IN)."""
    weight = table.column("weight").to_pylist()
    mean = sum(np.frombuffer(b, np.float32) * w for b, w in zip(table.column("part").to_pylist(), weight))
    return pa.table({"slice": table.column("slice")[:1], "weight": [float(sum(weight))],
                     "part": [(mean / sum(weight)).astype(np.float32).tobytes()]})


def averaged(parts: DataFrame, tasks: int) -> DataFrame:
    """One row per slice: means of means, FAN_IN at a time, so that no task
    holds more than a bounded number of vectors."""
    schema = "slice int, weight double, part binary"
    while True:
        bins = max(1, -(-tasks // FAN_IN))
        parts = (parts.withColumn("bin", F.pmod(F.xxhash64("weight", "part"), F.lit(bins)))
                 .groupBy("slice", "bin").applyInArrow(lambda t: _weighted(t), schema))
        if bins == 1:
            return parts
        parts, tasks = stash(parts, "lm-means"), bins


_SCORED = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
                     ("log_likelihood", pa.float64()), ("places", pa.binary()),
                     ("first", pa.int32()), ("words", pa.list_(pa.int64()))])


def _scorer(flat: np.ndarray, known: np.ndarray, ids: np.ndarray):
    """Rows of two kinds.  A document: its ids' log-likelihood, and the place of
    each of its words with a shared id in the list of its block.  A part of
    that list, from place ``first`` on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = unpack(flat)
        block = (TaskContext.get().partitionId() << 32) - 1
        for batch in batches:
            _, off = W.buffers(batch.column(1))
            for i, j in W.blocks(off, LOOKUP_BYTES):
                block += 1
                part = batch.slice(i, j - i)
                counts, scores, rare, ends = [], [], [], []
                for _, _, w, at, h in _blocks(part, 1, known, ids):
                    near = contexts(w, at)
                    each = [step(p, w[s: s + BATCH], [c[s: s + BATCH] for c in near], None)
                            for s in range(0, len(w), BATCH)]
                    sums = np.concatenate([[0.0], np.cumsum(np.concatenate(each))]) if each else np.zeros(1)
                    counts.append(np.diff(at))
                    scores.append(sums[at[1:]] - sums[at[:-1]])
                    is_rare = w >= FREQUENT
                    rare.append(h[is_rare])
                    ends.append(np.diff(np.concatenate([[0], np.cumsum(is_rare)])[at]))
                words, places = np.unique(np.concatenate(rare), return_inverse=True)
                at = np.concatenate([[0], np.cumsum(np.concatenate(ends))])
                places = places.astype(np.int32)
                n = j - i
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, block, np.int64)), part.column(0), pa.array(np.concatenate(counts)),
                     pa.array(np.concatenate(scores)),
                     pa.array([places[at[r]: at[r + 1]].tobytes() for r in range(n)], pa.binary()),
                     pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int64()))], schema=_SCORED)
                cut = np.arange(0, len(words), LISTED, dtype=np.int32)
                n = len(cut)
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, block, np.int64)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
                         pa.nulls(n, pa.float64()), pa.nulls(n, pa.binary()), pa.array(cut),
                         pa.ListArray.from_arrays(np.append(cut, np.int32(len(words))),
                                                  pa.array(words.view(np.int64)))], schema=_SCORED)
    return run


def _with_shares(scored: pa.Table, shares: pa.Table) -> pa.Table:
    """One block: every document's score with its words' shares of their ids."""
    place = np.asarray(shares.column("place"))
    share = np.full(place.max() + 1 if len(place) else 0, np.nan)
    share[place] = np.asarray(shares.column("share"))
    places = scored.column("places").to_pylist()
    # A word without a count would leave a NaN in the score.
    more = [share[np.frombuffer(b, np.int32)].sum() if b else 0.0 for b in places]
    return pa.table({"doc_id": scored.column("doc_id"), "n_words": scored.column("n_words"),
                     "log_likelihood": pa.array(np.asarray(scored.column("log_likelihood")) + more)})


def fit(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, DataFrame]:
    """Parameters, sorted word hashes and their ids, the frequency of every id
    and the counts of all words, from all documents."""
    known, ids, frequency, counts = vocabulary(docs)
    flat = start(frequency)
    parts = stash(docs.select("text").mapInArrow(
        _trainer(flat, known, ids), "slice int, weight double, part binary"), "lm-parts")
    tasks = parts.count() // SLICES
    if tasks:
        means = averaged(parts, tasks).orderBy("slice").collect()
        flat = np.concatenate([np.frombuffer(r["part"], np.float32) for r in means])
    return flat, known, ids, frequency, counts


def score(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, log_likelihood (summed), mean_log_likelihood per document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    flat, known, ids, frequency, counts = fit(docs)
    scored = stash(docs.mapInArrow(
        _scorer(flat, known, ids), "block long, doc_id long, n_words long, log_likelihood double, "
                                   "places binary, first int, words array<long>"), "lm-scored")
    totals = F.array(*[F.lit(float(n)) for n in frequency[FREQUENT:]])
    shares = (scored.where("words is not null").select("block", "first", F.posexplode("words").alias("pos", "word"))
              .select(F.col("block").alias("of"), (F.col("first") + F.col("pos")).alias("place"), "word")
              .join(counts, "word")
              .select("of", "place", F.log(F.col("n") / F.get(
                  totals, F.pmod(F.col("word"), F.lit(SHARED)).cast("int"))).alias("share")))
    rows = scored.where("places is not null").select("block", "doc_id", "n_words", "log_likelihood", "places")
    return (rows.groupBy("block").cogroup(shares.groupBy("of"))
            .applyInArrow(_with_shares, "doc_id long, n_words long, log_likelihood double")
            .withColumn("mean_log_likelihood",
                        F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words"))))
