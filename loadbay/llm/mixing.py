"""Mixing sources to target shares by systematic sampling.

Every source has a weight and a target number of words; all documents of a
source have the same expected number of copies, target / size of the source.
Expected copies are summed in order of (size, doc_id) inside the source, one
random offset per source is added, and a document is emitted once per integer
boundary its interval crosses.  Ordered by size, the words taken differ from the
target by at most the source's largest document.  The offset is drawn once and
turned to equally spaced places, and the place whose words come nearest the
target is used: nearer targets, at the price that over many seeds a document's
copies are no longer the expected ones, and in small sources some may be zero.

Only DataFrame functions are used, and no task holds all sources or all rows of
one.  A null text has size 0, a null source is a source of its own (last in
order), a null doc_id sorts first inside its source.  Repeated rows are rows of
their own.  A very long text is read once for its size.  Extra columns are
ignored by ``plan_copies`` and kept by ``mixed``, whatever their names; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadbay.llm.common import WORD, running_total, running_totals, stash

WEIGHTS = (5, 2, 1)
MOST = 3
TURNS = 16


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size -> plus target.

    Shares are weight / all weights of the whole size.  A target stops at
    ``most`` times its source's size and the excess goes to the others by
    weight.  With sources in order of ``most * size / weight``, the level at
    which the rest are served is the size left over after the capped ones
    divided by the weight left, so one pass of running sums settles it.  Both
    orders are dealt by range: there may be as many sources as hosts.
    """
    cycle = F.element_at(F.array(*[F.lit(w) for w in weights]),
                         (F.pmod(F.col("nth"), F.lit(len(weights))) + 1).cast("int"))
    named = sizes.withColumn("unnamed", F.col("source").isNull())
    weighed = (running_total(named, [], ["unnamed", "source"], F.lit(1), "nth")
               .withColumn("weight", cycle.cast("double"))
               .withColumn("ceiling", F.col("source_size") * F.lit(most))
               .withColumn("room", F.col("ceiling") / F.col("weight")))
    served = stash(running_totals(weighed, [], ["room", "unnamed", "source"], {
        "ceiling_before": F.col("ceiling"), "weight_before": F.col("weight")}), "mix-levels")
    whole = served.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    level = (F.lit(float(whole["size"] or 0)) - F.col("ceiling_before")) / (
        F.lit(float(whole["weight"] or 0)) - F.col("weight_before"))
    settled = served.agg(F.max(F.when(level <= F.col("room"), level)).alias("level")).first()["level"]
    target = F.col("ceiling").cast("double")
    if settled is not None:
        target = F.when(F.col("room") < settled, target).otherwise(F.lit(settled) * F.col("weight"))
    return served.select("source", "source_size", target.alias("target"))


def offset(source: Column, seed: int) -> Column:
    """One number in [0, 1) per source, the same in every run."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("")))
    return F.conv(F.substring(F.md5(named), 1, 6), 16, 10).cast("double") / F.lit(float(1 << 24))


def _copies(start: Column) -> Column:
    """Integer boundaries crossed by a document's interval of expected copies."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    crossed = F.floor(start + rate * (F.col("at") + 1)) - F.floor(start + rate * F.col("at"))
    # The floor of a rounded product may be one off; never more than the rate rounded up.
    return F.least(crossed, F.ceil(rate)).cast("long")


def plan_copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST,
                seed: int = 1, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken (and ``carry``) per document.

    A source's offset is drawn once, turned to ``TURNS`` equally spaced
    places, and the place whose words come nearest the target is used."""
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), *carry)
    placed = stash(running_total(sized, ["source"], ["size", "doc_id"], F.lit(1), "at"), "mix-placed")
    goal = stash(targets(placed.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most),
                 "mix-targets").withColumnRenamed("source", "of")
    turned = [F.pmod(offset(F.col("source"), seed) + F.lit(k / TURNS), F.lit(1.0)) for k in range(TURNS)]
    of = F.col("source").eqNullSafe(F.col("of"))
    tried = placed.join(goal, of).groupBy("of", "source_size", "target").agg(
        *[F.sum(_copies(u) * F.col("size")).alias(f"taken_{k}") for k, u in enumerate(turned)])
    nearest = F.array_min(F.array(*[
        F.struct(F.abs(F.col(f"taken_{k}") - F.col("target")).alias("miss"), F.lit(k).alias("turn"))
        for k in range(TURNS)]))
    chosen = stash(tried.select("of", "source_size", "target", nearest["turn"].alias("turn")), "mix-turns")
    copies = _copies(F.element_at(F.array(*turned), F.col("turn") + 1))
    return (placed.join(chosen, of)
            .select("doc_id", "size", "source_size", "target", copies.alias("copies"),
                    (copies * F.col("size")).alias("taken"), *carry))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 1) -> DataFrame:
    """The mix itself: each document as often as it is taken, with all its columns.

    Rows find their plan by a hash of all their columns; rows equal in all of
    them are numbered.  Until then a row is one struct, so no column of the
    input meets one of ours."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    key = F.xxhash64(*columns).alias("key")
    same = Window.partitionBy("key").orderBy("doc_id")
    rows = (docs.select(key, F.col("doc_id").cast("long").alias("doc_id"), F.struct(*columns).alias("row"))
            .withColumn("nth", F.row_number().over(same)))
    plan = plan_copies(docs.select("doc_id", "source", "text", key), weights, most, seed, ("key",))
    plan = plan.withColumn("n", F.row_number().over(same)).select(F.col("key").alias("of"), "n", "copies").where(
        "copies > 0")
    # Both sides are dealt by key for their numbers; the join needs no other dealing.
    on = (F.col("key") == F.col("of")) & (F.col("nth") - F.col("n") == 0)
    return (rows.join(plan.hint("merge"), on)
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
            .select("row.*"))
