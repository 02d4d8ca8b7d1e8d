"""The ten operators and the pipeline against brute force on a fixture of edge
cases: nulls in every column, empty and very long texts, ties, repeated rows,
empty tables, and extra columns with clashing names."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loadbay.llm import (exact_dedup, langid, lm_score, minmax_dedup, mixing, packing, pii, prefix_hash, quotes,
                         token_counts, tokens)
from loadbay.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, size int, key string"
EN = "the quick brown fox jumps over the lazy dog while seven wise men watch from the old stone bridge at noon"
DE = "der schnelle braune fuchs springt über den faulen hund während sieben weise männer von der brücke schauen"


def _rows():
    words = EN.split()
    long_text = " ".join(words[i % 17] + str(i) for i in range(40_000))
    rows = [(1, EN, "en", "a"), (2, EN.replace(" ", "\n\t"), "en", "b"), (3, EN + " today", "en", "a"), (4, None, "en", "a"),
            (5, "", None, None), (6, "   \n", "de", "b"), (7, DE, "de", "b"), (8, long_text, "en", "c"),
            (9, long_text + " end", "en", "c"), (10, DE.upper(), "de", None), (11, "12345 67890", "en", "a"),
            (12, "Der Hund", "de", "b"), (13, "write to a.b@c.org or +1 (743) 555-3824 now 10.0.0.256 10.0.0.255", "en", "a"),
            (13, "write to a.b@c.org or +1 (743) 555-3824 now 10.0.0.256 10.0.0.255", "en", "a"),
            (14, "card 4111 1111 1111 1111 tel (743) 555-3824 x<|endoftext|>, y", None, "b")]
    rows += [(20 + i, f"{EN} {DE} number {i}", "en" if i % 2 else "de", "a") for i in range(12)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    extra = [(i, t, lang, s, len(t or ""), True, 7, "k") for i, t, lang, s in _rows()]
    return spark.createDataFrame(extra, SCHEMA).repartition(3).cache()


def _texts():
    return {i: t or "" for i, t, *_ in _rows()}


def _clean(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t)


def _words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def _exact(rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(_clean(t or ""), []).append(i)
    return groups


@pytest.mark.parametrize("primes", [exact_dedup.PRIMES, (7, 5)])
def test_exact_dedup(docs, primes):
    got = exact_dedup.exact_groups(docs, primes).collect()  # (7, 5): nearly every pair of prints collides
    groups = _exact(_rows())
    assert len(got) == len(_rows())
    assert sorted(r.doc_id for r in got if r.kept) == sorted(min(ids) for ids in groups.values())  # one row a group
    for r in got:
        clean = _clean(_texts()[r.doc_id])
        ids = groups[clean]
        assert (r.keep_id, r.group_size) == (min(ids), len(ids)) and (not r.kept or r.doc_id == min(ids))
        assert r.text_sha256 == hashlib.sha256(clean.encode()).hexdigest()


@given(st.binary(max_size=300), st.integers(0, 300))
@settings(max_examples=50, deadline=None)
def test_prints_compose(data, cut):
    a = np.frombuffer(data, np.uint8)
    b, p = exact_dedup.BASES[0], exact_dedup.PRIMES[0]
    parts = [(exact_dedup.fingerprint(x, b, p), len(x)) for x in (a[:cut], a[cut:])]
    assert exact_dedup.combine(*parts, b, p)[0] == exact_dedup.fingerprint(a, b, p)


def _near(rows, k):
    sets = {}
    for i, t, *_ in rows:
        w = _words(t or "")
        sets[i] = {tuple(w)} if 0 < len(w) < k else {tuple(w[j:j + k]) for j in range(len(w) - k + 1)}
    up = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            inter = len(sets[a] & sets[b])
            if a < b and inter and 100 * inter >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((up[a], up[b]))
                up = {i: x if c == y else c for i, c in up.items()}
    return sets, up


def test_near_dedup(docs):
    sets, up = _near(_rows(), 4)
    got = minmax_dedup.near_groups(docs, k=4).collect()
    assert len(got) == len(_rows())
    for r in got:
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), up[r.doc_id], up[r.doc_id] == r.doc_id)


def test_near_dedup_large_bucket(spark, monkeypatch):
    # A family of many near copies, some linked through others only.
    monkeypatch.setattr(minmax_dedup, "SMALL_BUCKET", 2)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        w = list(base)
        for j in range(i % 5):
            w[(7 * i + 11 * j) % 60] = f"x{i}_{j}"
        rows.append((i, " ".join(w), "en", "a"))
    sets, up = _near(rows, 4)
    got = minmax_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), k=4)
    assert {r.doc_id: r.component_id for r in got.collect()} == up


@given(st.text(max_size=60))
@settings(max_examples=200, deadline=None)
def test_pre_tokens_give_the_librarys_ids(text):
    import pyarrow as pa

    path = tokenizer_path()
    ids, at = tokens.text_ids(pa.array([text, None, text + " İ, <|endoftext|>. don't É,"]), path)
    library = tokens.encoder(path).library
    for r, t in enumerate((text, "", text + " İ, <|endoftext|>. don't É,")):
        assert ids[at[r]:at[r + 1]].tolist() == library.encode(t, add_special_tokens=False).ids


def _ids():
    library = tokens.encoder(tokenizer_path()).library
    return {i: library.encode(t, add_special_tokens=False).ids for i, t in _texts().items()}


def test_token_counts(docs):
    want = _ids()
    got = token_counts.count_tokens(docs, tokenizer_path()).collect()
    assert len(got) == len(_rows())
    for r in got:
        n = len(want[r.doc_id])
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(_texts()[r.doc_id].encode()), n > 2048)


def test_packing(docs):
    want = {i: np.array([*x, 2], "<u4") for i, x in _ids().items()}
    got = packing.pack(docs, tokenizer_path()).collect()
    seen, sequences = Counter(), {}
    for r in got:
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
        seen[r.doc_id] += r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    times = Counter(i for i, *_ in _rows())
    assert seen == {i: len(x) * times[i] for i, x in want.items()}
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096 and at & (at - 1) == 0


def test_hilbert_curve_is_one_walk():
    grid = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    key = packing.hilbert_keys(grid, 3)
    assert sorted(key) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


@given(st.text("ab", max_size=40), st.text("ab", max_size=40))
@settings(max_examples=100, deadline=None)
def test_common_extensions(a, b):
    x, y = (prefix_hash._hashed(t) for t in (a, b))
    lcp = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
    assert x.common(0, y, 0) == lcp
    assert x.common_end(y) == prefix_hash._hashed(a[::-1]).common(0, prefix_hash._hashed(b[::-1]), 0)
    assert x.cut_and_joined(len(a) // 2, y, len(b) // 2).fingerprint() == prefix_hash._hashed(
        a[:len(a) // 2] + b[:len(b) // 2]).fingerprint()


def test_prefix_hash_query(docs, monkeypatch):
    monkeypatch.setattr(prefix_hash, "RANGE_BYTES", 1000)  # many ranges
    rows = sorted((i, t or "") for i, t, *_ in _rows())
    want = Counter()
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        want[i, len(t), hashlib.sha256((t[:len(t) - half] + after[:half]).encode()).hexdigest()] += 1
    got = prefix_hash.next_document_likeness(docs).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    prints = {}
    for r in got:
        assert 0 <= r.near_next <= 1 and 0.5 <= r.near_edited <= 1
        assert prints.setdefault(_texts()[r.doc_id], r.fingerprint) == r.fingerprint


def test_likeness_of_scattered_edits():
    rng = np.random.default_rng(3)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(3, 9))) for _ in range(4000)]
    text, other = words[:600], words[2000:2600]
    like = lambda x, y: prefix_hash.likeness(*(prefix_hash._hashed(" ".join(t)) for t in (x, y)))
    ends = ["changed", *text[1:-1], "changed"]
    some = [w if i % 30 else f"new{i}" for i, w in enumerate(text)]
    many = [w if i % 6 else "" for i, w in enumerate(text)]
    longer = text[:200] + other[:50] + text[200:400] + other[50:60] + text[420:]
    for copy, least in ((ends, 0.97), (some, 0.94), (many, 0.8), (longer, 0.85)):
        assert least < like(text, copy) < 1 and least < like(copy, text) < 1
    kept = sum(len(w) + 1 for i, w in enumerate(text) if i % 6)
    assert like(text, many) >= (kept - 1) / len(" ".join(text)) - 0.01
    assert like(text, other) < 0.05
    # Repeated lines have no window of their own.
    lines = (" ".join(text[:8]) + "\n") * 60
    edited = "".join("Z" + c[1:] if i % 100 == 50 else c for i, c in enumerate(lines.splitlines(True) * 2))
    assert prefix_hash.likeness(*(prefix_hash._hashed(t) for t in (lines * 2, "x" + edited + "y"))) > 0.97


@given(st.text("ab", max_size=80), st.text("ab", max_size=80))
@settings(max_examples=100, deadline=None)
def test_matched_spans_are_common(a, b):
    got = prefix_hash.matched(*(prefix_hash._hashed(t) for t in (a, b)))
    row = [0] * (len(b) + 1)  # longest common subsequence: no set of common spans is longer
    for x in a:
        row = _lcs_row(row, x, b)
    ends = prefix_hash._hashed(a).common(0, prefix_hash._hashed(b), 0)
    assert ends <= got <= row[-1]


def _lcs_row(row, x, b):
    out = [0]
    for k, y in enumerate(b):
        out.append(row[k] + 1 if x == y else max(out[k], row[k + 1]))
    return out


def test_mixing(docs):
    size = Counter()
    for i, t, _, s in _rows():
        size[s] += len(_words(t or ""))
    got = mixing.plan_copies(docs).collect()
    assert len(got) == len(_rows())
    source = {i: s for i, _, _, s in _rows()}
    weight = {"a": 5, "b": 2, "c": 1, None: 5}
    capped, total = {}, sum(size.values())
    while True:
        free = {s: w for s, w in weight.items() if s not in capped}
        goal = {s: capped.get(s, (total - sum(capped.values())) * w / max(sum(free.values()), 1)) for s, w in weight.items()}
        over = {s: 3 * size[s] for s in free if goal[s] > 3 * size[s]}
        if not over:
            break
        capped |= over
    taken = Counter()
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == size[s] and abs(r.target - goal[s]) < 1e-6 and r.taken <= 3 * r.size
        taken[s] += r.taken
    biggest = {s: max(len(_words(t or "")) for _, t, _, x in _rows() if x == s) for s in size}
    assert all(abs(taken[s] - goal[s]) <= biggest[s] for s in size)
    assert Counter(r.doc_id for r in mixing.mixed(docs).collect()) == Counter(
        {i: n for i, n in Counter(r.doc_id for r in got for _ in range(r.copies)).items()})


def test_personal_data(docs):
    got = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    r = got[13]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 0, 1)
    text = _texts()[13]
    want = sorted((text.index(x), k, text.index(x) + len(x)) for k, x in (
        ("email", "a.b@c.org"), ("phone", "+1 (743) 555-3824"), ("ip", "10.0.0.255")))
    assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, k, e in want).encode()).hexdigest()
    assert got[14].n_card == 1 and got[14].n_phone == 0 and "card:5:24" in got[14].spans
    for i in (1, 4, 5, 6, 7):
        assert got[i].spans == "" and got[i].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_language(docs):
    model = langid.fit(langid.learnable(docs))
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    for i in (4, 5, 6, 11):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert got[1].lang_pred == "en" and got[7].lang_pred == "de"
    assert got[7].held_out == (zlib.crc32(b"7") % 3 == 1)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_pseudo_likelihood(docs):
    got = {r.doc_id: r for r in lm_score.score(docs).collect()}
    for i, t in _texts().items():
        assert got[i].n_words == len(_words(t))
    assert got[4].log_likelihood == 0.0 and got[4].mean_log_likelihood is None
    assert all(r.mean_log_likelihood < 0 for r in got.values() if r.n_words)


def test_pseudo_likelihood_tells_rare_words_apart(spark, monkeypatch):
    # Few bytes per block, so that one word is looked up by several blocks.
    monkeypatch.setattr(lm_score, "LOOKUP_BYTES", 4096)
    fill = " ".join(f"f{i} " * 12 for i in range(lm_score.FREQUENT))
    hashed = lambda t: lm_score.W.word_hashes(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[0][0]
    place = lambda t: int(hashed(t) % np.uint64(lm_score.SHARED))
    often = "often"
    once = next(f"r{i}" for i in range(100_000) if place(f"r{i}") == place(often))
    rows = [(0, fill)] + [(None, often)] * 9 + [(1, once)]
    got = lm_score.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()
    one = {r.doc_id: r.log_likelihood for r in got}
    assert len(got) == len(rows) and abs(one[None] - one[1] - np.log(9)) < 1e-5
    assert one[1] < np.log(0.1 + 1e-6)


def test_quotes(spark):
    rows = [(1, 0, "user", "Where is the key?\nUnder the mat I think."), (1, 1, "assistant", "Which mat?"),
            (1, 2, "user", "On Monday you wrote:\n> under  the MAT i think.\nNot there."),
            (1, 3, "user", "> > Where is the key?\n> Which mat?\nThe red one."), (1, 4, "user", None),
            (2, 0, "user", "> nobody said this\nhm"), (None, 0, "user", "x"), (2, None, "user", "y")]
    got = {(r.conv_id, r.turn): r for r in quotes.link_replies(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert len(got) == len(rows)
    assert [got[1, t].parent_turn for t in range(5)] == [None, 0, 0, 1, 3]
    assert [got[1, t].quoted_turn for t in range(5)] == [None, None, 0, 1, None]
    assert got[1, 2].clean_text == "Not there." and got[1, 3].n_quoted == 2 and got[1, 4].clean_text == ""
    assert [got[1, t].reply_order for t in range(5)] == [1, 2, 5, 3, 4]
    assert got[2, 0].parent_turn is None and got[None, 0].reply_order is None


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    path = tokenizer_path()
    for out in (exact_dedup.exact_groups(none), minmax_dedup.near_groups(none), mixing.plan_copies(none),
                token_counts.count_tokens(none, path), packing.pack(none, path), pii.find_personal_data(none),
                prefix_hash.next_document_likeness(none), langid.predict(none, langid.fit(langid.learnable(none))),
                lm_score.score(none)):
        assert out.count() == 0


def test_pipeline(docs, tmp_dir, spark):
    import corpus_pipeline

    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    stage, at = {}, spark.read.parquet(f"{tmp_dir}/documents.parquet")
    for name, f in corpus_pipeline.STAGES[:4]:
        at = f(spark, at, tmp_dir).cache()
        assert at.columns == docs.columns
        stage[name] = Counter(r.doc_id for r in at.collect())
    lettered = [r for r in _rows() if any(c.isalpha() for c in r[1] or "")]
    assert set(stage["language ID"]) <= {r[0] for r in lettered} and stage["language ID"][1] == 1
    left = [r for r in lettered if r[0] in stage["language ID"]]
    kept = {min(ids) for ids in _exact(left).values()}
    assert stage["exact dedup"] == {i: 1 for i in kept}
    left = [r for r in left if r[0] in kept]
    kept = {i for i, c in _near(left, 5)[1].items() if i == c}
    assert stage["near dedup"] == {i: 1 for i in kept}
    assert set(stage["mixing"]) <= kept and max(stage["mixing"].values()) <= 3
    pieces = corpus_pipeline.pack(spark, at, tmp_dir).collect()
    whole = Counter()
    for r in pieces:
        whole[r.doc_id] += r.length
    ids = _ids()
    assert whole == {i: n * (len(ids[i]) + 1) for i, n in stage["mixing"].items()}


def test_pipeline_decides_row_by_row(spark):
    import corpus_pipeline

    words = [f"w{i}" for i in range(60)]
    base, near = " ".join(words), " ".join([*words[:-1], "end"])
    alone = {x: f"{x} one two three four five six seven" for x in "abcdef"}
    rows = [(5, base), (None, alone["a"]), (None, alone["b"]), (None, alone["a"].replace(" one", "  one")), (None, near), (7, near),
            (7, alone["c"]), (3, alone["d"]), (3, alone["e"]), (3, alone["d"]), (9, alone["e"]), (9, alone["f"]), (9, base)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string").repartition(3)
    at = corpus_pipeline.exact(spark, docs, "")
    got = Counter((r.doc_id, " ".join(r.text.split())) for r in at.collect())
    left = {(5, base), (None, alone["a"]), (None, alone["b"]), (7, near), (7, alone["c"]),
            (3, alone["d"]), (3, alone["e"]), (9, alone["f"])}
    assert at.columns == docs.columns and got == Counter(left)
    got = Counter((r.doc_id, " ".join(r.text.split())) for r in corpus_pipeline.near(spark, at, "").collect())
    assert got == Counter(left - {(7, near)})
