"""Language identification by averaged hashed subword embeddings.

A text's features are its byte 1- to 4-grams, lower-cased, with every ASCII
non-letter as a blank, hashed into ``BUCKETS`` rows of an embedding table.  The
average of the rows goes through a linear softmax.  Both are trained by
stochastic gradient descent in numpy on a bounded sample of labelled rows
(``SAMPLE`` documents in all, as many of each language as there are or an
equal share, chosen by a hash of doc_id): each with its whole text and with
short windows of words, so that short texts are met in training too.  A part
of the sample calibrates the softmax (one temperature) and the rejection
threshold (``REJECT`` of the calibration documents lie below it).

Prediction reads whole texts and nothing else.  A null text, or one without a
letter, is ``und`` with score 0.  Without any labelled row, every text is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadbay.llm import words as W

BUCKETS = 1 << 14
DIMS = 16
SAMPLE = 6000
REJECT = 0.001
WINDOWS = 3
UND = "und"
#: Text bytes classified at a time.
BLOCK = 1 << 16

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_CLEAN = np.where(_LETTER, W._LOWER, np.uint8(0x20)).astype(np.uint8)
_GRAM = np.random.default_rng(11).integers(1, 1 << 63, (4, 4), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For n = 1 to 4, the bucket of the n-gram at every byte and whether it
    counts (one of its first two bytes is a letter, and it reaches at most one
    blank beyond its text)."""
    # One blank before every text; it also ends the text before.
    n = len(offsets) - 1
    size = np.diff(offsets)
    out = np.full(len(data) + n + 4, 0x20, np.uint8)
    text = np.repeat(np.arange(n), size)
    out[np.arange(len(data)) + text + 1] = _CLEAN[data]
    start = offsets[:-1] + np.arange(n)
    length = len(data) + n
    letter = out != 0x20
    buckets, counts = [], []
    wide = out.astype(np.uint64)
    end = np.concatenate([start, [length]])
    left = np.repeat(end[1:], np.diff(end)) - np.arange(length)
    for g in range(1, 5):
        h = np.zeros(length, np.uint64)
        for j in range(g):
            h += (wide[j: length + j] + np.uint64(1)) * _GRAM[g - 1, j]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        buckets.append((h >> np.uint64(50)).astype(np.int64))  # 14 bits
        some = letter[:length] | (letter[1: length + 1] if g > 1 else False)
        counts.append(some & (left >= max(g - 1, 1)))
    return buckets, counts


def bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of one text and their frequencies."""
    b, c = grams(np.frombuffer(text, np.uint8), np.array([0, len(text)], np.int64))
    return np.unique(np.concatenate([x[y] for x, y in zip(b, c)]), return_counts=True)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bags of whole sampled texts and of short windows of their words."""
    for batch in batches:
        rows, at, freq = [], [], []
        for r, (i, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            raw = text.encode()
            rng = np.random.default_rng(abs(i))
            tokens = raw.split()
            pieces = [raw]
            for _ in range(WINDOWS if tokens else 0):
                s = int(rng.integers(len(tokens)))
                pieces.append(b" ".join(tokens[s: s + int(rng.integers(1, 9))]))
            for p in pieces:
                b, n = bag(p)
                rows.append(r)
                at.append(b.astype(np.int32))
                freq.append(n.astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows, pa.int64())), batch.column(2).take(pa.array(rows, pa.int64())),
             pa.array([x.tobytes() for x in at], pa.binary()), pa.array([x.tobytes() for x in freq], pa.binary())],
            names=["doc_id", "lang", "at", "freq"])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Model:
    """Languages, one row of weights per bucket, temperature, threshold."""

    def __init__(self, langs: list[str], weights: np.ndarray, bias: np.ndarray,
                 temperature: float, threshold: float):
        self.langs, self.weights, self.bias = langs, weights, bias
        self.temperature, self.threshold = temperature, threshold


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, groups: np.ndarray,
          langs: list[str], epochs: int = 12, batch: int = 32, rate: float = 20.0, seed: int = 3) -> Model:
    """Stochastic gradient descent; every fifth document (by ``groups``) calibrates."""
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (BUCKETS, DIMS)).astype(np.float32)
    out = np.zeros((DIMS, len(langs)), np.float32)
    bias = np.zeros(len(langs), np.float32)
    held = groups % 5 == 0
    if held.all() or not held.any():
        held = np.zeros(len(labels), bool)
    learn = np.flatnonzero(~held & np.array([len(b) > 0 for b, _ in bags], bool))

    def rows_of(idx: np.ndarray) -> np.ndarray:
        x = np.zeros((len(idx), BUCKETS), np.float32)
        for k, i in enumerate(idx):
            at, freq = bags[i]
            x[k, at] = freq / max(freq.sum(), 1)
        return x

    steps = max(1, epochs * len(learn) // batch)
    step = 0
    for _ in range(epochs):
        rng.shuffle(learn)
        for s in range(0, len(learn), batch):
            idx = learn[s: s + batch]
            used = np.unique(np.concatenate([bags[i][0] for i in idx]))
            x = rows_of(idx)[:, used]
            rows = table[used]
            mean = x @ rows
            err = _softmax(mean @ out + bias)
            err[np.arange(len(idx)), labels[idx]] -= 1
            err *= rate * (1 - step / steps) / len(idx)
            step += 1
            back = x.T @ (err @ out.T)
            out -= mean.T @ err
            bias -= 0.01 * err.sum(axis=0)
            table[used] = rows - back
    weights = table @ out
    check = np.flatnonzero(held) if held.any() else np.arange(len(labels))
    check = np.array([i for i in check if len(bags[i][0])], np.int64)
    logits = np.array([np.sum(weights[b] * (f / f.sum())[:, None], axis=0) + bias for b, f in
                       (bags[i] for i in check)]).reshape(len(check), len(langs))
    best, temperature = np.inf, 1.0
    for t in np.geomspace(0.2, 10, 40):
        p = _softmax(logits / t)
        loss = -np.log(np.maximum(p[np.arange(len(check)), labels[check]], 1e-12)).mean() if len(check) else 0.0
        if loss < best:
            best, temperature = loss, float(t)
    score = _softmax(logits / temperature).max(axis=1) if len(check) else np.ones(1)
    # Between an even guess and the lowest scores that labelled texts get.
    low = float(np.quantile(score, REJECT))
    threshold = min(low, 0.5) if len(langs) > 1 else 0.0
    return Model(langs, weights, bias, temperature, threshold)


def _trainer(langs: list[str]):
    """All bags of the sample -> one row with the model, whatever their order."""
    number = {lang: k for k, lang in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))),
                     key=lambda r: (r[0], r[2], r[3]))
        if got:
            model = train([(np.frombuffer(r[2], np.int32), np.frombuffer(r[3], np.float32)) for r in got],
                          np.array([number[r[1]] for r in got], np.int64),
                          np.array([r[0] for r in got], np.int64), langs)
            yield pa.RecordBatch.from_pydict(
                {"weights": [model.weights.tobytes()], "bias": [model.bias.tobytes()],
                 "temperature": [model.temperature], "threshold": [float(model.threshold)]})
    return run


def fit(labelled: DataFrame, sample: int = SAMPLE, seed: int = 17) -> Model | None:
    """Train on a bounded sample of (doc_id, text, lang)."""
    sizes = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return None
    langs = sorted(sizes)
    share = max(sample // len(langs), 1)
    parts = 1 << 30
    place = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(parts))
    keep = F.lit(False)
    for lang in langs:
        rate = min(1.0, share / sizes[lang])
        keep = keep | ((F.col("lang") == lang) & (place < int(rate * parts)))
    # The bags of the sample (bounded by ``sample`` documents and ``BUCKETS``
    # entries a bag) meet in one task; the driver gets the model only.
    got = (labelled.where(keep).select("doc_id", "text", "lang")
           .mapInArrow(_bags, "doc_id long, lang string, at binary, freq binary").repartition(1)
           .mapInArrow(_trainer(langs), "weights binary, bias binary, temperature double, threshold double").collect())
    if not got:
        return None
    weights, bias = (np.frombuffer(got[0][c], np.float32) for c in ("weights", "bias"))
    return Model(langs, weights.reshape(BUCKETS, -1), bias, got[0]["temperature"], got[0]["threshold"])


def classify(texts: pa.Array, lettered: np.ndarray, model: Model | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language, score and rejection of every text."""
    data, off = W.buffers(texts)
    lang = np.full(len(texts), UND, object)
    score = np.zeros(len(texts))
    reject = np.ones(len(texts), bool)
    for i, j in W.blocks(off, BLOCK) if model is not None else ():
        n = j - i
        o = off[i: j + 1] - off[i]
        start = o[:-1] + np.arange(n)
        logits = np.zeros((n, len(model.langs)))
        total = np.zeros(n)
        for b, c in zip(*grams(data[off[i]: off[j]], o)):
            logits += np.add.reduceat(model.weights[b] * c[:, None].astype(np.float32), start, axis=0)
            total += np.add.reduceat(c.astype(np.int64), start)
        p = _softmax((logits / np.maximum(total, 1)[:, None] + model.bias) / model.temperature)
        ok = lettered[i:j] & (total > 0)
        lang[i:j][ok] = np.array(model.langs, object)[p.argmax(axis=1)[ok]]
        score[i:j][ok] = p.max(axis=1)[ok]
        reject[i:j] = ~ok | (score[i:j] < model.threshold)
    return lang, score, reject


def _predictor(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, reject = classify(
                batch.column(1), np.asarray(batch.column(2).to_numpy(zero_copy_only=False), bool), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3), pa.array(lang, pa.string()), pa.array(score), pa.array(reject)],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"])
    return run


def _accepter(model: Model | None, text: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            reject = classify(batch.column(text), np.asarray(
                batch.column(last).to_numpy(zero_copy_only=False), bool), model)[2]
            yield batch.select(list(range(last))).filter(pa.array(~reject))
    return run


def held_out(doc_id: Column) -> Column:
    """Documents never learned from: crc32(doc_id as text) mod 3 is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def learnable(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.col("lang").cast("string").alias("lang")).where(
        "doc_id is not null and text is not null and lang is not null").where(~held_out(F.col("doc_id")))


def _lettered() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected per document."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", _lettered().alias("lettered"),
        held_out(F.col("doc_id")).alias("held_out")).mapInArrow(
        _predictor(model), "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    return docs.select("*", _lettered().alias("_lettered_")).mapInArrow(
        _accepter(model, docs.columns.index("text")), docs.schema)
