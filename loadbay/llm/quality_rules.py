r"""Quality rules: strict base rules and a hashed n-gram log-likelihood ratio.

Base figures come from the words (``[^\x20\x09-\x0D]+``) and lines of the whole
text; a text with too few words or mostly repeated three-word windows fails.

The verdict on the others compares two multinomials over hashed n-grams (single
tokens and pairs; a token is a run of ASCII letters, digits and non-ASCII
characters, or a run of other visible ASCII characters, as it stands, so that
shouting and symbols are features; a token's bucket is its CRC-32 modulo
``buckets``, a pair's 31 times the first CRC plus the second): trusted texts
against all documents.  A bucket's gain is the logarithm of the ratio of its shares in
thousandths, rounded down, so a document's sum is an exact integer, whatever
the order.  The sum divided by the number of n-grams is compared with a fixed
threshold, for every document alike.

Only DataFrame functions are used.  All documents give the raw counts; the
trusted counts come from at most ``TRUSTED`` labelled documents (chosen by a
hash of their doc_id), so their ids are a broadcast of bounded size.  The counts
reach the driver as one number per bucket.

A null or empty text has no words and fails the base rules.  A null doc_id is
never a trusted one.  Rows sharing a doc_id are judged row by row (and all are
trusted if the doc_id is).  Without trusted texts nothing is rejected by the
ratio.  A very long text is one row's arrays: its words and n-grams are held at
once.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadbay.llm.common import WORD

#: Labelled documents that the trusted multinomial is learned from, at most.
TRUSTED = 20_000
BUCKETS = 1 << 14
#: Lowest kept log-likelihood ratio, in thousandths of a nat per n-gram.
LEAST = -400
LEAST_WORDS = 50
#: Highest kept share of words in repeated windows, per cent.
MOST_REPEATED = 50
SYMBOLS = "#*$%&|<>"
TOKEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+"
#: TOKEN by the characters it has: Java tests a negated class of ranges some 25 times slower.
_SPARK_TOKEN = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+|[!-/:-@\[-`{-~]+"
_BLANKS = "".join(map(chr, (0x20, *range(9, 14))))


def _windows() -> Column:
    """Hashes of the three-word windows of a text, in order; a word is hashed once."""
    h = F.col("_hashes")
    return F.transform(F.slice(h, 1, F.greatest(F.size(h) - 2, F.lit(0))),
                       lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))


def _covered() -> Column:
    """Words that lie in a window found twice or more.  In ``_sorted`` equal
    windows are neighbours; their places are spread over three words each."""
    def flagged(x: Column, i: Column) -> Column:
        near = lambda j: F.coalesce(F.get(F.col("_sorted"), j)["h"] == x["h"], F.lit(False))
        return near(i - 1) | near(i + 1)

    twice = F.filter("_sorted", flagged)
    return F.size(F.array_distinct(F.flatten(F.transform(
        twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))).cast("long")


def base_rules(docs: DataFrame, least_words: int = LEAST_WORDS, most_repeated: int = MOST_REPEATED) -> DataFrame:
    """doc_id, text, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed per document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(_BLANKS)) != "")
    rows = (rows.withColumn("_words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).withColumn("_lines", lines).withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
            .withColumn("_windows", _windows()))
    # Most texts repeat no window: only the others are sorted.
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    rows = rows.withColumn("_sorted", F.when(repeats, F.sort_array(F.transform(
        "_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    n_words = F.size("_words").cast("long")
    n_repeat = F.when(F.col("_sorted").isNull(), F.lit(0).cast("long")).otherwise(_covered())
    return rows.select(
        "doc_id", "text", n_words.alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        n_repeat.alias("n_repeat_words")).withColumn(
        "base_failed", (F.col("n_words") < least_words)
        | (F.col("n_repeat_words") * 100 > F.col("n_words") * most_repeated))


def with_buckets(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Adds ``_buckets``: the bucket of every n-gram of the text (null: none)."""
    tokens = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(_SPARK_TOKEN), F.lit(0))
    out = rows.withColumn("_crcs", F.transform(tokens, lambda w: F.crc32(w)))
    crcs = F.col("_crcs")
    pairs = F.transform(F.slice(crcs, 2, F.greatest(F.size(crcs) - 1, F.lit(0))),
                        lambda c, i: ((F.get(crcs, i) * 31 + c) % buckets).cast("int"))
    single = F.transform(crcs, lambda c: (c % buckets).cast("int"))
    return out.withColumn("_buckets", F.concat(single, pairs)).drop("_crcs")


def trusted_ids(labels: DataFrame, most: int = TRUSTED) -> DataFrame:
    """doc_id of at most ``most`` documents labelled as good, by a hash."""
    ids = labels.where("quality = 1 and doc_id is not null").select(
        F.col("doc_id").cast("long").alias("_trusted")).distinct()
    return ids.orderBy(F.sha2(F.col("_trusted").cast("string"), 256)).limit(most)


def learn(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> list[int] | None:
    """Gain of every bucket; None without trusted texts.

    ``trusted`` is a frame of ``trusted_ids``.  Counts are summed per task
    before one row per task and bucket is shuffled."""
    flagged = docs.select("doc_id", "text").join(
        F.broadcast(trusted), F.col("doc_id").cast("long") == F.col("_trusted"), "left")
    # explode_outer: for explode, the optimiser adds a filter that works out the arrays again.
    counts = (with_buckets(flagged, buckets).select(F.explode_outer("_buckets").alias("bucket"), "_trusted")
              .where("bucket is not null").groupBy("bucket").agg(F.count(F.lit(1)).alias("s"), F.count("_trusted").alias("t")).collect())
    s_all, t_all = (float(sum(r[c] for r in counts) + buckets) for c in ("s", "t"))
    if t_all == buckets:
        return None
    known = {r["bucket"]: (r["s"], r["t"]) for r in counts}
    out = []
    for b in range(buckets):
        s, t = known.get(b, (0, 0))
        out.append(math.floor(1000 * math.log(float(t + 1) * s_all / (float(s + 1) * t_all))))
    return out


def judge(docs: DataFrame, labels: DataFrame, least: int = LEAST, buckets: int = BUCKETS,
          trusted: int = TRUSTED) -> DataFrame:
    """doc_id, text, the base figures, base_failed, n_grams, ratio (sum of
    gains), kept per document."""
    gains = learn(docs, trusted_ids(labels, trusted), buckets)
    rows = with_buckets(base_rules(docs), buckets)
    if gains is None:
        ratio = F.lit(0).cast("long")
    else:
        table = F.split(F.lit(",".join(map(str, gains))), ",").cast("array<long>")
        ratio = F.aggregate("_buckets", F.lit(0).cast("long"), lambda s, b: s + F.get(table, b))
    n = F.size("_buckets").cast("long")
    return (rows.withColumn("n_grams", n).withColumn("ratio", ratio).drop("_buckets")
            .withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= F.col("n_grams") * least)))
