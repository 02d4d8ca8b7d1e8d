"""Rows that share an id or have none, equal rows, and columns named like ours."""

import re
from collections import Counter

from pyspark.sql import functions as F

from loadbay.llm import exact_dedup, mixing, quotes


def test_exact_dedup_without_ids(spark, monkeypatch):
    # 1,000 rows without a doc_id in 500 groups: one row a group is kept, and
    # no row meets another one's text.
    rows = spark.range(1000).select(F.lit(None).cast("long").alias("doc_id"),
                                    F.concat(F.lit("text "), F.col("id") % 500).alias("text"), F.lit(1).alias("row"))
    seen = []
    real = exact_dedup.stash
    monkeypatch.setattr(exact_dedup, "stash", lambda df, name: seen.append((name, real(df, name))) or seen[-1][1])
    got = exact_dedup.exact_groups(rows).collect()
    assert len(got) == 1000 and all(r.group_size == 2 and r.keep_id is None for r in got)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert len(kept) == 500 and set(kept.values()) == {1}
    assert dict(seen)["exact-chunks"].count() <= 2000


def test_exact_dedup_shared_smallest_id(spark):
    rows = [(1, "a  b"), (1, "a b"), (2, "a b"), (1, "c"), (None, "c"), (None, "c")]
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.keep_id, r.group_size, r.kept) for r in got) == Counter(
        {(1, 3, True): 2, (1, 3, False): 4})


def test_mixed_keeps_columns_of_any_name(spark):
    names = "copies string, at int, key string, row string, nth int, copy int, of string"
    rows = [(i if i % 3 else None, " ".join(["w"] * (i % 7 + 1)), f"s{i % 2}", "x", 1, "k", "r", 2, 3, "o") for i in range(60)]
    rows += [(None, "w w", "s0", "x", 1, "k", "r", 2, 3, "o")] * 20  # equal in all columns
    docs = spark.createDataFrame(rows, f"doc_id long, text string, source string, {names}").repartition(4)
    out = mixing.mixed(docs)
    assert out.schema == docs.schema
    plan = Counter()
    for r in mixing.plan_copies(docs).collect():
        plan[r.doc_id, r["size"], r.target] += r.copies
    assert out.count() == sum(plan.values())
    target = {r.target: r.source_size for r in mixing.plan_copies(docs).collect()}
    words = Counter()
    for r in out.collect():
        words[r.source] += len(r.text.split())
    for t in target:
        assert min(abs(w - t) for w in words.values()) <= 7
    assert {tuple(r) for r in out.collect()} <= {tuple(r) for r in docs.collect()}


def test_targets_of_many_sources(spark):
    sizes = [(None if i == 300 else f"s{i:03d}", (i * 37) % 101) for i in range(301)]
    got = {r.source: r.target for r in mixing.targets(
        spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0]))
    weight = {s: (5, 2, 1)[i % 3] for i, (s, _) in enumerate(order)}
    whole, capped = sum(n for _, n in sizes), set()
    while True:  # reshare until no target is above its ceiling
        left = whole - sum(3 * n for s, n in sizes if s in capped)
        share = sum(weight[s] for s, _ in sizes if s not in capped)
        level = left / share
        more = {s for s, n in sizes if s not in capped and level * weight[s] > 3 * n}
        if not more:
            break
        capped |= more
    for s, n in sizes:
        want = 3 * n if s in capped else level * weight[s]
        assert abs(got[s] - want) < 1e-6 * max(want, 1)


def test_quote_of_a_repeated_message(spark):
    first = "line one\nline two is here\nline three"
    rows = [(1, 0, "user", first), (1, 0, "user", first), (1, 0, "user", "another text\nof the same turn"),
            (1, 1, "bot", "what?"),
            (1, 2, "user", "someone wrote:\n> line one line two\n> is here line three\nyes")]
    schema = "conv_id long, turn long, role string, text string, message int, pos int"
    rows = [(*r, 9, 9) for r in rows]
    for repeated in (rows, rows + rows[-1:]):
        got = [r for r in quotes.link_replies(spark.createDataFrame(repeated, schema)).collect() if r.turn == 2]
        assert {r.quoted_turn for r in got} == {0} and len(got) == len(repeated) - 4
    assert re.search("yes", got[0].clean_text) and "line" not in got[0].clean_text
    assert quotes.link_replies(spark.createDataFrame([], schema)).collect() == []
