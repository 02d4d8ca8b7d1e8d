"""What a Python worker holds: it outlives a stage and keeps its peak."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from loadbay.llm import common, exact_dedup, langid, minmax_dedup, packing, tokens
from loadbay.llm.queries import tokenizer_path


def _texts(n):
    rnd = random.Random(5)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randrange(2, 9))) for _ in range(2000)]
    return [" ".join(rnd.choices(words, k=300)) for _ in range(n)]


def _model():
    weights = np.random.default_rng(0).normal(size=(langid.BUCKETS, 4)).astype(np.float32)
    return langid.Model(list("abcd"), weights, np.zeros(4, np.float32), 1.0, 0.0)


@pytest.mark.parametrize("name", ["langid", "signer", "sets"])
def test_blocks_of_text_take_little_memory(name):
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(1500)), "text": _texts(1500), "letter": [True] * 1500})
    run = {"langid": langid._accepter(_model(), 1), "signer": minmax_dedup._signer(5, 32, 3),
           "sets": minmax_dedup._set_maker(5)}[name]
    assert batch.column(1).nbytes > 2 << 20
    for _ in run(iter([batch.slice(0, 10)])):  # tables are made once
        pass
    tracemalloc.start()
    try:
        for _ in run(iter([batch])):
            pass
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 24 << 20


def test_store_of_pre_tokens_stays_small():
    store = tokens.PieceEncoder(tokenizer_path())
    store.counted = lambda pieces: (np.arange(len(pieces)), np.ones(len(pieces), np.int64))
    for k in range(0, 900_000, 50_000):
        pieces = [f"w{x}" for x in range(k, k + 50_000)]
        at = store.numbers(pieces)
        assert (store.flat[store.edge[at]] == np.arange(50_000).astype(store.dtype)).all()
        assert len(store.known) <= 300_000


def test_full_store_keeps_what_calls_ask_for(monkeypatch):
    monkeypatch.setattr(tokens, "STORED", 100)
    store, asked = tokens.PieceEncoder(tokenizer_path()), []
    encode = store.counted
    store.counted = lambda pieces: (asked.extend(pieces), encode(pieces))[1]
    common = [f"often{'x' * k}" for k in range(30)]
    for k in range(0, 1000, 20):
        pieces = common[:15] + [f"rare{x}" for x in range(k, k + 20)] + common[15:]
        at = store.numbers(pieces)
        for x, i in zip(pieces, at):
            want = store.library.encode(x, add_special_tokens=False).ids
            assert store.flat[store.edge[i]: store.edge[i + 1]].tolist() == want
    assert len(asked) == len(set(asked)) == 1030


def test_texts_go_to_python_in_small_batches(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows]})

    own = spark.conf.get(common._BATCH)
    rows = spark.range(0, 5000, 1, 1).mapInArrow(sizes, "n long")
    with common.text_batches(spark):
        assert [r.n for r in common.stash(rows, "sizes").collect()] == [1000] * 5
    assert [r.n for r in common.stash(rows, "sizes").collect()] == [5000]
    assert spark.conf.get(common._BATCH) == own


def test_blocks_do_not_change_rows(monkeypatch):
    texts = [*_texts(300), "", None, "one", "a  b\tc"]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts, "letter": [True] * len(texts)})

    def rows():
        out = []
        for run in (langid._accepter(_model(), 1), minmax_dedup._signer(5, 32, 3), minmax_dedup._set_maker(5),
                    exact_dedup._prints(exact_dedup.PRIMES), packing._tokenised(tokenizer_path(), packing.END_ID)):
            out.append([r for b in run(iter([batch])) for r in b.to_pylist()])
        return out

    small = rows()
    for module, name in ((minmax_dedup.W, "SMALL_BLOCK"), (langid, "BLOCK"), (packing, "BLOCK")):
        monkeypatch.setattr(module, name, 64 << 20)
    assert rows() == small
