"""Cheaper forms of op5's and op8's inner steps against the plain ones."""

import random

import numpy as np
import pyarrow as pa

from loadbay.llm import lm_score, tokens
from loadbay.llm.queries import tokenizer_path


def test_words_cut_together_are_cut_as_one_by_one():
    rnd = random.Random(3)
    letters = "aB9.,;:!?&$%#*|)<(>İΣßñè漢\x00"
    words = ["".join(rnd.choices(letters, k=rnd.randrange(6))) for _ in range(5000)] + ["", "..", "Ab.,", "漢."]
    for some in (words, words[:1], ["漢."], []):
        kept, at, ends = tokens.cuts(pa.array(some, pa.large_string()))
        after = dict(zip(at.tolist(), ends.to_pylist()))
        assert [(x, after.get(i, "")) for i, x in enumerate(kept.to_pylist())] == [tokens.cut(w) for w in some]


def test_only_words_with_punctuation_at_the_end_are_cut_one_by_one(monkeypatch):
    seen, cut = [], tokens.cut
    monkeypatch.setattr(tokens, "cut", lambda w: (seen.append(w), cut(w))[1])
    tokens.cuts(pa.array(["été", "été,", "a<b", "plain", "plain.", "ñ"], pa.large_string()))
    assert seen == ["été,"]


def test_pieces_asked_together_have_the_ids_of_each_alone():
    rnd = random.Random(4)
    letters = [*"aB9.,<>'İΣßñ漢\x00\u00a0\u0301\u05d9\u05b4가\u1100😀", "<|endoftext|>", "'s"]
    pieces = sorted({"".join(rnd.choices(letters, k=rnd.randrange(8))) for _ in range(3000)}) + ["aé漢" * 4000, "z"]
    store = tokens.PieceEncoder(tokenizer_path())
    each = [store.library.encode(x, add_special_tokens=False).ids for x in pieces]
    lists, encode = [], store.library.encode

    class Library:
        def encode(self, text, **options):
            lists.append(isinstance(text, list))
            return encode(text, **options)

    store.library = Library()
    ids, sizes = store.counted(pieces)
    assert sizes.tolist() == [len(x) for x in each] and ids.tolist() == [k for x in each for k in x]
    assert lists and not any(lists)  # a list takes the library longer
    ids, sizes = store.counted([])
    assert len(ids) == len(sizes) == 0


def _softmax(x):
    e = np.exp(x - x.max())
    return e / e.sum()


def test_step_gives_the_plain_log_probabilities_and_gradient():
    rng = np.random.default_rng(2)
    p = lm_score.unpack(rng.normal(0, 0.5, lm_score._SIZE).astype(np.float32))
    n = 200
    ids = rng.integers(0, lm_score.IDS, n)
    near = [rng.integers(0, lm_score.IDS + 1, n) for _ in lm_score.SIDES]
    old = {k: v.astype(float) for k, v in p.items()}
    want, groups = [], np.zeros((lm_score.GROUPS, lm_score.DIMS + 1, lm_score.PER_GROUP))
    for i in range(n):
        h = np.tanh(old["bias"] + sum(t[c[i]] for t, c in zip(old["near"], near)))
        g, k = ids[i] % lm_score.GROUPS, ids[i] // lm_score.GROUPS
        one = np.append(h, 1.0)
        inside = _softmax(one @ old["place"][g])
        want.append(np.log(_softmax(one @ old["group"])[g]) + np.log(inside[k]))
        inside[k] -= 1
        groups[g] += np.outer(one, inside) / (ids % lm_score.GROUPS == g).sum()
    assert np.allclose(lm_score.step(p, ids, near, None), want, atol=1e-4)
    assert all((p[k] == old[k]).all() for k in p)  # no rate: nothing is learned
    assert np.allclose(lm_score.step(p, ids, near, 0.1), want, atol=1e-4)
    assert np.allclose(p["place"], old["place"] - 0.1 * groups, atol=1e-4)


def test_shift_works_in_place():
    x = np.random.default_rng(1).normal(size=(50, 7)).astype(np.float32)
    whole = x.astype(float)
    y, norm = lm_score._shift(x)
    assert y is x
    assert np.allclose(y - norm, whole - np.log(np.exp(whole).sum(axis=1, keepdims=True)), atol=1e-5)
