"""Base spans of the personal data operator against plain patterns."""

import hashlib
import random
import re
import time
from dataclasses import replace

import pytest

from loadbay.llm import pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
PIECES = ["4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1111", "378282246310005", "49927398716", " ", "  ", "-",
          "--", "1", "12", "0", "+1 (743) 555-3824", "743-555-3824", "a.b@c.org", "a(at)b.org", "10.0.0.1", "999.1.1.1",
          "1.2.3.4.5.6.7.8", "1:2:3:4:5:6:7:8", ".", "@", "é", "x", "+", "\n", "call ", "card "]


def _luhn(digits):
    worth = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in worth) % 10 == 0


def _holds(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in hit.split(".")),
            "card": 14 <= len(digits) <= 19 and _luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]


def _base(text):
    spans = [(m.start(), n, m.end(), kind) for n, (kind, pattern) in enumerate(PLAIN.items())
             for m in re.finditer(pattern, text or "") if _holds(kind, m.group())]
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(spans)]


def _sha(spans):
    return hashlib.sha256(",".join(spans).encode()).hexdigest()


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(7)
    return ["".join(rnd.choices(PIECES, k=rnd.randint(0, 25))) for _ in range(800)] + [
        None, "", "1 " * 9, "4111 1111 1111 1111 1", "12 4111111111111111", "5  4111111111111111"]


def test_base_spans_against_plain_patterns(spark, texts):
    schema = "doc_id long, text string, found string, _pairs int, _rest string, kind int, size int"
    rows = [(i, t, *[None] * 5) for i, t in enumerate(texts)] + [(None, "a@b.c", *[None] * 5)] * 2
    got = pii.find_personal_data(spark.createDataFrame(rows, schema).repartition(3)).collect()
    assert len(got) == len(rows) and sum(r.doc_id is None and r.n_email == 1 for r in got) == 2
    for r in got:
        base = _base(texts[r.doc_id] if r.doc_id is not None else "a@b.c")
        assert r.base_sha256 == _sha(base)
        for kind in PLAIN:
            assert r[f"n_{kind}"] == sum(x.startswith(kind) for x in base)
        spans = r.spans.split(",") if r.spans else []
        assert set(base) <= set(spans) and len(spans) == len(base) + r.n_added
        places = [(x.split(":")[0], *map(int, x.split(":")[1:])) for x in spans]
        text = texts[r.doc_id] or "" if r.doc_id is not None else "a@b.c"
        assert all(0 <= a < b <= len(text) for _, a, b in places)


def test_very_many_matches_in_one_text(spark):
    rnd = random.Random(3)
    numbers = " ".join(str(rnd.randrange(10 ** rnd.randint(1, 15))) for _ in range(110_000))
    mails = " ".join(f"a{i}@b.org" for i in range(20_000))
    started = time.monotonic()
    got = {r.doc_id: r for r in pii.find_personal_data(
        spark.createDataFrame([(1, numbers), (2, mails)], "doc_id long, text string")).collect()}
    assert got[1].base_sha256 == _sha(_base(numbers)) and got[2].base_sha256 == _sha(_base(mails))
    assert got[2].n_email == 20_000 and time.monotonic() - started < 120


def test_lists_are_parameters(spark):
    wide = {**pii.PATTERNS, "email": replace(pii.PATTERNS["email"], listed=r"\.example$", said=r"post")}
    docs = spark.createDataFrame([(1, "post a.b@c.example now")], "doc_id long, text string")
    votes = pii.candidates(docs, wide).first().found[0]
    assert (votes.gazetteer, votes.context) == (1, 1)
    votes = pii.candidates(docs).first().found[0]
    assert (votes.gazetteer, votes.context) == (0, -1)


def test_empty_table(spark):
    assert pii.find_personal_data(spark.createDataFrame([], "doc_id long, text string")).collect() == []
