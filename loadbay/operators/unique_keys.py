"""Load policies over several unique keys at once (K9).

A database applies IGNORE and REPLACE on every unique index of a table, row by
row in load order:

* IGNORE: a row is inserted unless a row that is there (of the target, or an
  earlier row that was inserted) shares any of its keys;
* REPLACE: a row first deletes every row that is there and shares any of its
  keys, then it is inserted.

Both are worked out in parallel.  Under REPLACE a row stays exactly if no later
row shares a key with it, whatever became of that later row: one aggregation
per key value.  Under IGNORE a row's fate depends on the fate of earlier ones,
so it is settled in rounds: an undecided row that is the first undecided one
under each of its keys is taken, and every row that shares a key with a taken
one is rejected.  Each round settles at least the first rows of all key values;
the number of rounds is the length of the longest chain of rows that wait for
each other, and a round only reads the rows that are still undecided.

A key with a NULL in one of its columns conflicts with nothing.  Nothing is
collected but one emptiness check per round; a key value that very many rows
share is one row per task after the partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadbay.operators.policy import POLICIES, all_not_null
from loadbay.session import written

ROW = "_load_row"


def _key_value(columns: Sequence[str]) -> Column:
    """A key's columns as one text; lengths keep their borders apart."""
    texts = [F.col(f"`{c}`").cast("string") for c in columns]
    return F.concat(*[x for t in texts for x in (F.length(t).cast("string"), F.lit(":"), t)])


def _entries(rows: DataFrame, keys: Sequence[Sequence[str]], carry: Sequence[str]) -> DataFrame:
    """(carry..., k, v): one row per row and key without a NULL."""
    each = [F.when(all_not_null(key), F.struct(F.lit(i).alias("k"), _key_value(key).alias("v")))
            for i, key in enumerate(keys)]
    return (rows.select(*carry, F.explode(F.array_compact(F.array(*each))).alias("e"))
            .select(*carry, "e.k", "e.v"))


def first_takers(entries: DataFrame, name: str = "first-takers") -> DataFrame:
    """The rows (``_load_row``) that are taken when rows come in order and one is
    taken if no earlier taken row has any of its (k, v) entries."""
    open_ = written(entries, name)
    taken = None
    while not open_.isEmpty():
        first = open_.groupBy("k", "v").agg(F.min(ROW).alias("first"))
        # A row is next if it is the first one under all its keys; the key
        # values whose first row is next are settled, with all their rows.
        judged = open_.join(first.hint("merge"), ["k", "v"])
        judged = written(judged.groupBy(ROW).agg(
            F.bool_and(F.col("first") == F.col(ROW)).alias("next"), F.collect_list(F.struct("k", "v")).alias("own")), name)
        chosen = judged.where("next").select(ROW)
        closed = judged.where("next").select(F.explode("own").alias("e")).select("e.k", "e.v").distinct()
        waiting = judged.where("not next").select(ROW, F.explode("own").alias("e")).select(ROW, "e.k", "e.v")
        beaten = waiting.join(closed.hint("merge"), ["k", "v"], "left_semi").select(ROW).distinct()
        open_ = written(waiting.join(beaten.hint("merge"), ROW, "left_anti"), name)
        taken = chosen if taken is None else written(taken.unionAll(chosen), name)
    return taken if taken is not None else entries.select(ROW).limit(0)


def load_with_unique_keys(target: DataFrame, incoming: DataFrame, keys: Sequence[Sequence[str]],
                          policy: str = "ignore", order_col: str | None = None) -> DataFrame:
    """The target after loading ``incoming`` when each of ``keys`` (lists of
    columns) is unique.  ``order_col`` gives the load order; equal values are
    ordered by the other columns."""
    policy = policy.lower()
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}")
    if order_col is None:
        raise ValueError("an order column is needed to tell first from last")
    if not keys:
        raise ValueError("at least one unique key is needed")
    cols = target.columns
    rest = [c for c in cols if c != order_col]
    # Numbered in load order as they are written: the numbers stay what they are.
    rows = written(incoming.select(cols).orderBy(order_col, *rest)
                   .withColumn(ROW, F.monotonically_increasing_id()), "unique-keys")
    entries = _entries(rows, keys, [ROW])
    held = _entries(target, keys, [])
    if policy == "ignore":
        barred = entries.join(held.distinct().hint("merge"), ["k", "v"], "left_semi").select(ROW).distinct()
        free = entries.join(barred.hint("merge"), ROW, "left_anti")
        lost = entries.select(ROW).distinct().join(first_takers(free).hint("merge"), ROW, "left_anti")
        return target.unionByName(rows.join(lost.hint("merge"), ROW, "left_anti").select(cols))
    last = entries.groupBy("k", "v").agg(F.max(ROW).alias("last"))
    beaten = (entries.join(last.hint("merge"), ["k", "v"]).where(F.col(ROW) < F.col("last"))
              .select(ROW).distinct())
    stays = target
    for key in keys:  # a target row goes if any of its keys comes in
        came = rows.where(all_not_null(key)).select(*key).distinct()
        stays = (stays.where(all_not_null(key)).join(came, list(key), "left_anti").select(cols)
                 .unionByName(stays.where(~all_not_null(key))))
    return stays.unionByName(rows.join(beaten.hint("merge"), ROW, "left_anti").select(cols))
