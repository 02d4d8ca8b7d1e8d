r"""Personal data by weak supervision: labelers, EM, and a span classifier.

Base spans come from strict patterns (email, ip, card, phone); they always
stay.  Looser patterns propose further candidates of the same kinds.  Four
labelers vote on every candidate (1, 0 or no vote):

* strict: whether it is a base span;
* gazetteer: whether its issuer prefix, area code or top-level domain is a
  listed one;
* check: whether its digits pass the kind's check (Luhn, digit count, octets,
  a top-level domain of letters);
* context: 1 where a word that announces this kind stands shortly before it.

Expectation-maximisation over the counts of vote patterns (at most 81 per
kind) estimates every labeler's reliability.  The posteriors are soft labels
for the final span classifier (naive Bayes over form and surroundings), which
decides which candidates are added.

Only DataFrame functions are used.  Patterns are written so that a failing
search does not start again inside a run of the same characters: their cost
stays near linear in the text, however many matches a very long one has.  A
null text is empty; null and repeated doc_ids are kept, row by row; extra columns
are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadbay.llm.common import stash

KINDS = ("email", "ip", "card", "phone")
STEPS = 10
BEFORE = 32


@dataclass(frozen=True)
class Kind:
    strict: str          # strict pattern
    hint: str            # what a text must hold to be searched for it
    loose: str           # pattern of further candidates
    loose_hint: str
    listed: str          # what the gazetteer knows (searched in the span)
    said: str            # words that announce the kind


_LOCAL = r"A-Za-z0-9._%+-"
PATTERNS = {
    # \G: after a match, the rest of the same run of characters may start the next one.
    "email": Kind(
        rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@",
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}"
        r"(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{2,63})+", r"\(at\)|\[at\]",
        r"(?i)(?:com|org|net|edu|gov|io|de|fr|es|uk)$", r"(?i)\b(?:e-?mail|mail|contact|write)\b"),
    "ip": Kind(
        r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]",
        r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])", r"[0-9A-Fa-f]:[0-9A-Fa-f]",
        r"^(?:(?!0\.|127\.|255\.)[0-9]|2[0-9a-f]{3}:|f[ce][0-9a-f]{2}:)", r"(?i)\b(?:ip|host|server|address)\b"),
    # A run of digits from its first to its last, of 14 to 19: others never count.
    "card": Kind(
        r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])", r"[0-9](?:[ -]?[0-9]){13}",
        r"(?<![0-9.])[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])", r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}",
        r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)", r"(?i)\b(?:card|visa|credit|debit|mastercard|amex)\b"),
    "phone": Kind(
        r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]",
        r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-])", r"[0-9]{3}[ .-][0-9]{4}",
        r"^\(?[2-9][0-8][0-9]|^\+[1-9]", r"(?i)\b(?:tel|phone|call|fax|mobile|cell)\b"),
}


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def worth(i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 1, d).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + worth(i)) % 10 == 0


def _holds(kind: str, hit: Column) -> Column:
    """Whether a strict match of the pattern is a base span."""
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return hit.rlike(rf"^{part}(?:\.{part}){{3}}$")
    n = F.length(_digits(hit))
    if kind == "card":
        return F.when(n.between(14, 19), _luhn(_digits(hit))).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


def _checked(kind: str, hit: Column) -> Column:
    """The check labeler's view of any candidate."""
    n = F.length(_digits(hit))
    if kind == "email":
        return hit.rlike(r"[A-Za-z]{2,}$")
    if kind == "ip":
        return ~hit.rlike(r"^[0-9.]+$") | _holds(kind, hit)
    if kind == "card":
        return F.when(n.between(14, 19), _luhn(_digits(hit))).otherwise(F.lit(False))
    return n.between(10, 15)


_PAIRS = "array<struct<gap:string,hit:string,size:int>>"
_FILL = "\u0000"


def _sums(numbers: Column, start: Column) -> Column:
    """``start`` plus the sum of the numbers before each one."""
    return F.aggregate(
        numbers, F.struct(start.alias("sum"), F.array().cast("array<int>").alias("all")),
        lambda s, n: F.struct((s["sum"] + n).alias("sum"), F.concat(s["all"], F.array(s["sum"])).alias("all")),
        lambda s: s["all"])


def _before(sizes: Column) -> Column:
    """Sums of the column's numbers before each one.  Two levels (stretches of
    about the square root of their number) keep the copying of growing arrays
    small, so a text with very many matches stays cheap."""
    step = F.greatest(F.ceil(F.sqrt(F.size(sizes))).cast("int"), F.lit(1))
    stretch = lambda i: F.slice(sizes, i * step + 1, step)
    numbers = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(sizes) / step).cast("int") - 1, F.lit(0)))
    wholes = F.transform(numbers, lambda i: F.aggregate(stretch(i), F.lit(0), lambda s, n: s + n))
    return F.flatten(F.zip_with(numbers, _sums(wholes, F.lit(0)), lambda i, start: _sums(stretch(i), start)))


def _placed(rows: DataFrame, text: str, pattern: str, hint: str) -> DataFrame:
    """Adds ``_pairs`` (every gap with the match after it; the last has none) and
    ``_spans``: all matches with their places in code points, the characters
    before them and the one after.

    Places are running sums of the lengths of gaps and matches, surroundings
    come from the neighbouring gaps and matches: nothing is looked up by its
    place in the text.  The steps are columns of their own, so that none is
    worked out again inside another."""
    t = F.col(text)
    pairs = F.zip_with(F.split(t, pattern, -1), F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), lambda g, h: F.struct(
        g.alias("gap"), h.alias("hit"), (F.length(g) + F.coalesce(F.length(h), F.lit(0))).alias("size")))
    rows = rows.withColumn("_pairs", F.when(t.rlike(hint), pairs).otherwise(F.array().cast(_PAIRS)))
    rows = rows.withColumn("_sizes", F.transform("_pairs", lambda p: p["size"]))
    rows = rows.withColumn("_before", _before(F.col("_sizes")))
    at = lambda i: F.get(F.col("_pairs"), i)
    text_of = lambda c: F.coalesce(c, F.lit(""))

    def span(p: Column, i: Column) -> Column:
        end = F.get(F.col("_before"), i) + p["size"]
        left = F.concat(F.right(text_of(at(i - 1)["gap"]), F.lit(BEFORE)), text_of(at(i - 1)["hit"]), p["gap"])
        right = F.concat(F.left(text_of(at(i + 1)["gap"]), F.lit(1)), F.left(text_of(at(i + 1)["hit"]), F.lit(1)))
        return F.struct((end - F.length(p["hit"])).alias("start"), end.alias("end"), p["hit"].alias("hit"),
                        F.right(left, F.lit(BEFORE)).alias("left"), F.left(right, F.lit(1)).alias("right"))

    spans = F.transform("_pairs", span)
    return rows.withColumn("_spans", F.filter(spans, lambda x: x["hit"].isNotNull())).drop("_sizes", "_before")


def _described(kind: str, k: Kind, c: Column, strict: bool) -> Column:
    """A candidate with its votes and features (small integers)."""
    side = lambda x: (F.when(x == "", 0).when(x.rlike(r"^\s$"), 1).when(x.rlike(r"^[.,;:!?()]$"), 2)
                      .when(x.rlike(r"^\p{L}$"), 3).otherwise(4))
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), c["start"].alias("start"), c["end"].alias("end"),
        F.lit(int(strict)).alias("strict"), c["hit"].rlike(k.listed).cast("int").alias("gazetteer"),
        _checked(kind, c["hit"]).cast("int").alias("check"),
        F.when(c["left"].rlike(k.said), 1).otherwise(-1).alias("context"),
        side(F.right(c["left"], F.lit(1))).alias("left"), side(c["right"]).alias("right"),
        F.least(F.floor(F.length(c["hit"]) / 4), F.lit(8)).cast("int").alias("size"),
        c["hit"].rlike("[ ()-]").cast("int").alias("spaced"))


_FOUND = ("array<struct<kind:int,start:int,end:int,strict:int,gazetteer:int,check:int,context:int,left:int,right:int,"
          "size:int,spaced:int>>")
VOTES = ("strict", "gazetteer", "check", "context")
FEATURES = ("strict", "gazetteer", "check", "context", "left", "right", "size", "spaced")


def candidates(docs: DataFrame, patterns: Mapping[str, Kind] = PATTERNS) -> DataFrame:
    """doc_id, found: all base spans and further candidates of every text.
    Further candidates are searched in what the base spans leave."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       F.array().cast(_FOUND).alias("found"))
    for kind in KINDS:
        k = patterns[kind]
        rows = _placed(rows, "text", k.strict, k.hint)
        base = F.filter("_spans", lambda c: _holds(kind, c["hit"]))
        rest = F.array_join(F.transform("_pairs", lambda p: F.concat(p["gap"], F.when(
            _holds(kind, p["hit"]), F.repeat(F.lit(_FILL), F.length(p["hit"]))).otherwise(F.coalesce(p["hit"], F.lit(""))))), "")
        rows = rows.select("doc_id", "text", F.concat("found", F.transform(base, lambda c: _described(kind, k, c, True))).alias("found"),
                           F.when(F.size("_pairs") > 0, rest).otherwise(F.col("text")).alias("_rest"))
        rows = _placed(rows, "_rest", k.loose, k.loose_hint).select("doc_id", "text", F.concat(
            "found", F.transform("_spans", lambda c: _described(kind, k, c, False))).alias("found"))
    return rows.select("doc_id", "found")


def reliabilities(votes: DataFrame, steps: int = STEPS) -> DataFrame:
    """EM over counts of vote patterns (kind, the four votes, n):
    adds p, the posterior that a candidate with this pattern is real.

    A pattern starts at its share of votes for; each step re-estimates every
    labeler's reliability and the share of real candidates per kind.
    """
    names = VOTES
    every = Window.partitionBy("kind")
    said = [F.col(x) >= 0 for x in names]
    yes = [F.col(x) == 1 for x in names]
    count = sum((F.when(s, 1.0).otherwise(0.0) for s in said), F.lit(0.0))
    out = votes.withColumn("p", (sum((F.when(y, 1.0).otherwise(0.0) for y in yes), F.lit(0.0)) + 0.5) / (count + 1))
    logit = lambda x: F.log(x / (1 - x))
    for _ in range(steps):
        right = [F.when(s, F.when(y, F.col("p")).otherwise(1 - F.col("p"))).otherwise(0.0) * F.col("n")
                 for s, y in zip(said, yes)]
        cast = [F.when(s, F.col("n")).otherwise(0) for s in said]
        held = lambda x: F.greatest(F.lit(0.05), F.least(F.lit(0.95), x))
        out = out.select(
            "kind", *names, "n",
            held((F.sum(F.col("p") * F.col("n")).over(every) + 1) / (F.sum("n").over(every) + 2)).alias("share"),
            *[held((F.sum(r).over(every) + 1) / (F.sum(c).over(every) + 2)).alias(f"r_{x}")
              for x, r, c in zip(names, right, cast)])
        score = logit(F.col("share"))
        for x, s, y in zip(names, said, yes):
            score = score + F.when(s, F.when(y, 1).otherwise(-1) * logit(F.col(f"r_{x}"))).otherwise(0.0)
        out = out.withColumn("p", 1 / (1 + F.exp(-score)))
    return out


def train(found: DataFrame, steps: int = STEPS) -> dict[tuple[int, str, int], float]:
    """Weights of the span classifier: log odds per (kind, feature, value).

    Soft labels are summed per value in one aggregation; the result has one
    row per kind, feature and value, a few hundred at most.
    """
    each = found.select(F.explode("found").alias("c")).select("c.*")
    patterns = each.groupBy("kind", *FEATURES).agg(F.count(F.lit(1)).alias("n"))
    votes = patterns.groupBy("kind", *VOTES).agg(F.sum("n").alias("n"))
    p = reliabilities(votes, steps).select("kind", *VOTES, "p")
    soft = patterns.join(p, ["kind", *VOTES])
    values = soft.select("kind", "n", "p", F.explode(F.array(
        F.struct(F.lit("prior").alias("feature"), F.lit(0).alias("value")),
        *[F.struct(F.lit(x).alias("feature"), F.col(x).alias("value")) for x in FEATURES])).alias("f"))
    summed = values.groupBy("kind", "f.feature", "f.value").agg(
        F.sum(F.col("p") * F.col("n")).alias("real"), F.sum((1 - F.col("p")) * F.col("n")).alias("not_real"))
    whole = Window.partitionBy("kind", "feature")
    odds = F.when(F.col("feature") == "prior", F.log((F.col("real") + 1) / (F.col("not_real") + 1))).otherwise(
        F.log((F.col("real") + 1) / (F.sum("real").over(whole) + 9))
        - F.log((F.col("not_real") + 1) / (F.sum("not_real").over(whole) + 9)))
    return {(r[0], r[1], r[2]): r[3]
            for r in summed.select("kind", "feature", "value", odds).collect()}


def find_personal_data(docs: DataFrame, steps: int = STEPS, patterns: Mapping[str, Kind] = PATTERNS) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans
    (base and added), added per document.

    ``patterns`` gives each kind its listed prefixes and domains (``listed``),
    the words that announce it (``said``) and its looser pattern; the strict
    ones are the contract's."""
    found = stash(candidates(docs, patterns), "pii-found")
    weights = train(found, steps)
    if weights:
        table = F.create_map(*[F.lit(x) for (k, f, v), w in sorted(weights.items())
                               for x in (f"{k}:{f}:{v}", w)])
        weight = lambda c, f, v: F.coalesce(F.element_at(
            table, F.concat_ws(":", c["kind"].cast("string"), F.lit(f), v.cast("string"))), F.lit(0.0))
        score = lambda c: sum((weight(c, f, c[f]) for f in FEATURES), weight(c, "prior", F.lit(0)))
        stays = lambda c: (c["strict"] == 1) | (score(c) > 0)
    else:
        stays = lambda c: c["strict"] == 1
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = lambda a: F.array_sort(F.transform(a, lambda c: F.struct(
        c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))))
    written = lambda a: F.array_join(F.transform(ordered(a), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("found", lambda c: c["strict"] == 1)
    kept = F.filter("found", stays)
    rows = found.select("doc_id", base.alias("base"), kept.alias("kept"))
    return rows.select(
        "doc_id", *[F.size(F.filter("base", lambda c: c["kind"] == n)).cast("long").alias(f"n_{k}")
                    for n, k in enumerate(KINDS)],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("kept")).alias("spans"),
        (F.size("kept") - F.size("base")).cast("long").alias("n_added"))
