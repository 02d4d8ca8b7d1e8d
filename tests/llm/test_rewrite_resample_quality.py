"""Fill-in-the-middle, importance resampling and quality rules against brute
force: nulls, empty and very long texts, ties, repeated rows, empty tables and
extra columns with clashing names."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadbay.llm import fill_middle, importance, quality_rules

SCHEMA = ("doc_id long, text string, n int, form string, h1 int, _words string, _at int, _buckets int, _crcs string, rank int, "
          "n_words int, _trusted int, weight string")
EN = "the quick brown fox jumps over the lazy dog while seven wise men watch from the old stone bridge at noon"


def _rows():
    words = EN.split()
    long_text = " ".join(words[i * 7 % 17] + str(i % 50) for i in range(60_000))
    rows = [(1, EN), (2, EN + "\n\n" + EN + " Größe <P> x"), (3, None), (4, ""), (5, " \n\t"), (6, long_text), (None, EN * 3),
            (None, None), (7, EN), (7, EN), (7, "übung ñ 12\x0b34 a\x00b c"), (8, "### the *** the *** " * 40),
            (9, "é" * 3000 + " a<S"), (10, "abc" * 3000), (11, "< S> <M" + EN * 2)]
    return rows + [(100 + i, " ".join(random.Random(i).choices(words, k=70 + i))) for i in range(30)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, *[None] * 11) for r in _rows()], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(100 + i, 1, 0) for i in range(20)] + [(8, 0, 0), (None, 1, 0), (100, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def _words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _multiset(got):
    return Counter(tuple(r) for r in got)


# Fill in the middle

def _rewritten(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * g: 8 * g + 8], 16) for g in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_rewrite(docs):
    out = fill_middle.rewrite(docs)
    assert _multiset(out.collect()) == _multiset(_rewritten(*r) for r in _rows())
    back = out.select("doc_id", fill_middle.restored(F.col("output"), F.col("form")))
    assert _multiset(back.collect()) == _multiset((i, t or "") for i, t in _rows())
    assert {r.form for r in out.collect()} == {"plain", "psm", "spm"}


@given(st.text(alphabet="aZ é\n<>Ss漢😀1", max_size=200), st.integers(1, 9))
@settings(max_examples=150, deadline=None)
def test_tree_cuts(text, block):
    data = np.frombuffer(text.encode(), np.uint8)
    start, point = fill_middle.unit_starts(data, np.array([0, len(data)]))
    tree = fill_middle.BlockTree(start, point, block)
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    assert tree.units == len(units)
    for k in range(len(units) + 1):
        before = "".join(units[:k])
        assert tree.cut(k) == (len(before.encode()), len(before))


@given(st.lists(st.sampled_from(["<", "P", "S", "M", ">", "<S", "S>", "a", ""]), min_size=3, max_size=3), st.booleans())
@settings(max_examples=100, deadline=None)
def test_marks_stay_findable(parts, suffix_first):
    p, s, m = parts
    if not any(x in p + m + s for x in fill_middle.MARKS):
        out = f"<S>{s}<P>{p}<M>{m}" if suffix_first else f"<P>{p}<S>{s}<M>{m}"
        first, second = ("<S>", "<P>") if suffix_first else ("<P>", "<S>")
        body = out.split(first, 1)[1]
        one, rest = body.split(second, 1)
        two, three = rest.split("<M>", 1)
        assert (one, two, three) == ((s, p, m) if suffix_first else (p, s, m))


# Importance resampling

@given(st.lists(st.text(alphabet="ab éÜ-1\n", max_size=80), min_size=1, max_size=6), st.integers(1, 4),
       st.sampled_from([1, 5, 17, 1 << 20]))
@settings(max_examples=150, deadline=None)
def test_gram_crcs(texts, n, window):
    got, words = Counter(), Counter()
    for who, crc, text in importance.gram_crcs([t.encode() for t in texts], n, window):
        got.update(zip(who.tolist(), crc.tolist()))
        words.update(text.tolist())
    want = Counter()
    for r, t in enumerate(texts):
        w = _words(t)
        assert words[r] == len(w)
        want.update((r, zlib.crc32(" ".join(w[i: i + k]).encode()))
                    for k in range(1, n + 1) for i in range(len(w) - k + 1))
    assert got == want


def _features(text, n):
    w = _words(text or "")
    return len(w), [zlib.crc32(" ".join(w[i: i + k]).encode()) % 97 for k in range(1, n + 1) for i in range(len(w) - k + 1)]


@pytest.mark.parametrize("n", [1, 2])
def test_resample(spark, docs, n):
    target = spark.createDataFrame([(1, EN), (2, None), (3, "")], "item_id long, text string")
    got = importance.resample(docs, target, n=n, buckets=97, share=30, carry=("text",)).collect()
    raw, wanted = Counter(), Counter()
    for _, t in _rows():
        raw.update(_features(t, n)[1])
    wanted.update(_features(EN, n)[1])
    big_s, big_t = raw.total() + 97, wanted.total() + 97
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * big_s / ((raw[b] + 1) * big_t))) for b in range(97)]
    want = []
    for i, t in _rows():
        n_words, f = _features(t, n)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        want.append([i, len(f), weight, score, None, t, n_words])
    able = sorted((w for w in want if w[6] >= 20), key=lambda w: (-w[3], w[0] is None, w[0]))
    for place, w in enumerate(able[:len(able) * 30 // 100]):
        w[4] = place + 1
    assert _multiset(got) == _multiset(w[:6] for w in want)


# Quality rules

def _base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    spans = Counter(tuple(words[i: i + 3]) for i in range(len(words) - 2))
    hit = {p for i in range(len(words) - 2) if spans[tuple(words[i: i + 3])] > 1 for p in (i, i + 1, i + 2)}
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(hit), failed)


def _grams(text):
    crcs = [zlib.crc32(w.encode()) for w in re.findall(quality_rules.TOKEN, text or "")]
    return [x % quality_rules.BUCKETS for x in crcs + [31 * a + b for a, b in zip(crcs, crcs[1:])]]


def test_quality_rules(docs, labels):
    got = quality_rules.judge(docs, labels)
    raw, good = Counter(), Counter()
    for i, t in _rows():
        raw.update(_grams(t))
        if i is not None and 100 <= i < 120:
            good.update(_grams(t))
    b = quality_rules.BUCKETS
    gain = [math.floor(1000 * math.log(float(good[k] + 1) * (raw.total() + b) / (float(raw[k] + 1) * (good.total() + b))))
            for k in range(b)]
    want = []
    for i, t in _rows():
        grams, base = _grams(t), _base(t)
        ratio = sum(gain[k] for k in grams)
        want.append((i, t or "", *base, len(grams), ratio, not base[-1] and ratio >= quality_rules.LEAST * len(grams)))
    assert _multiset(got.collect()) == _multiset(want)
    kept = {r.doc_id: r.kept for r in got.collect()}
    assert all(kept[i] for i in range(100, 130)) and not kept[8]


def test_token_spelling(spark):
    # The tokens of Spark's spelling are those of TOKEN for every character, without its cost.
    chars = [chr(c) for c in range(1 << 16) if not 0xD800 <= c < 0xE000] + [chr(c) for c in range(1 << 16, 1 << 20, 997)]
    texts = ["".join(chars[i: i + 500]) + " ".join(chars[i: i + 500]) for i in range(0, len(chars), 500)]
    cut = lambda p: F.regexp_extract_all("text", F.lit(p), F.lit(0))
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in rows.select("text", cut(quality_rules._SPARK_TOKEN).alias("tokens")).collect():
        assert r.tokens == re.findall(quality_rules.TOKEN, r.text)
    many = spark.range(20_000).select(F.concat_ws(" ", *[F.lit(EN)] * 5, F.col("id").cast("string")).alias("text")).repartition(4)

    def seconds(column):
        begun = time.monotonic()
        many.select(F.sum(F.size(column))).collect()
        return time.monotonic() - begun

    words, buckets = cut(quality_rules.WORD), cut(quality_rules._SPARK_TOKEN)
    assert min(seconds(buckets) for _ in range(3)) < 8 * min(seconds(words) for _ in range(3)) + 0.2


def test_without_trusted_texts_only_the_base_rules_reject(docs, labels):
    got = quality_rules.judge(docs, labels.where("quality = 0")).collect()
    assert all(r.kept == (not r.base_failed) and r.ratio == 0 for r in got)


def test_empty_tables(spark, docs, labels):
    none = docs.limit(0)
    assert fill_middle.rewrite(none).collect() == []
    assert importance.resample(none, none).collect() == []
    assert quality_rules.judge(none, labels).collect() == []
    drawn = importance.resample(docs, none).collect()  # no target: still a defined order
    able = sum(len(_words(t or "")) >= 20 for _, t in _rows())
    assert sorted(r["rank"] for r in drawn if r["rank"]) == list(range(1, able // 10 + 1))
