"""Shared pieces: lineage cuts in the shared folder, group attributes without
broadcasts, ranks inside groups without hot tasks, connected components."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadbay.session import scratch_path

WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Whole texts that go to Python at a time.  Executor and worker each hold a
#: batch or two, and keep the memory.
TEXTS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def text_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of ``TEXTS`` rows at most inside, the session's own after."""
    own = spark.conf.get(_BATCH)
    if 0 < int(own) <= TEXTS:
        yield
        return
    spark.conf.set(_BATCH, TEXTS)
    try:
        yield
    finally:
        spark.conf.set(_BATCH, own)


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back: the lineage
    is cut there, and a lost executor re-reads files instead of redoing work."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def attach_group(rows: DataFrame, keys: Sequence[str], aggs: dict[str, tuple[str, str | Column]],
                 hot: str | None = None) -> DataFrame:
    """Give every row the aggregates of its group, however large the group.

    ``aggs`` maps an output name to (function, column) with function in min,
    max, sum.  Groups are reduced with partial sums per task, so each is one
    row; rows meet it in a sort-merge join, which streams them past that one
    row.  Never a broadcast: nothing of the size of the data passes through
    the driver.  Where groups may hold a large share of all rows, ``hot`` names
    a table the totals are written to: adaptive execution splits a hot group's
    rows only if both sides of the join come straight from a shuffle.
    """
    fn = {"min": F.min, "max": F.max, "sum": F.sum}
    whole = rows.groupBy(*keys).agg(*[fn[f](c).alias(o) for o, (f, c) in aggs.items()])
    if hot:
        whole = stash(whole, hot)
    return rows.join(whole.hint("merge"), list(keys))


def running_totals(rows: DataFrame, group: Sequence[str], order: Sequence[str],
                   values: dict[str, Column]) -> DataFrame:
    """Sums of ``values`` (integers, by output name) over the rows before each
    row of its group, by ``order``.

    The rows are dealt by range over (group, order), so a group of any size
    is spread over many tasks.  Each (task, group) has one sum; running sums
    of those (one row per task and group) give every task its offset.  The
    dealt rows are written once, so both uses see the same dealing.
    """
    given = [f"_v_{o}" for o in values]
    dealt = stash(
        rows.select("*", *[c.cast("long").alias(v) for v, c in zip(given, values.values())])
        .repartitionByRange(*[F.col(c) for c in (*group, *order)])
        .withColumn("_task", F.spark_partition_id()), "dealt")
    sums = dealt.groupBy("_task", *group).agg(*[F.sum(v).alias(f"_n{v}") for v in given])
    before = Window.partitionBy(*group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("_task").alias("_t"), *[F.col(g).alias(f"_g_{g}") for g in group],
        *[F.coalesce(F.sum(f"_n{v}").over(before), F.lit(0)).alias(f"_b{v}") for v in given])
    inside = (Window.partitionBy("_task", *group).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = dealt.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_i{v}") for v in given])
    on = F.col("_task") == F.col("_t")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return placed.join(offsets, on).select(
        *rows.columns, *[(F.col(f"_b{v}") + F.col(f"_i{v}")).alias(o) for o, v in zip(values, given)])


def running_total(rows: DataFrame, group: Sequence[str], order: Sequence[str],
                  value: Column, out: str) -> DataFrame:
    """One ``running_totals`` column."""
    return running_totals(rows, group, order, {out: value})


def components(links: DataFrame) -> DataFrame:
    """Connected components of undirected links (a, b): rows (node, component)
    with component the smallest node reachable.  Nodes without links are not
    listed.

    Alternates two star steps (each node's larger neighbours, then its
    smaller ones, are hung on its smallest neighbour) until the links no
    longer change; rounds grow with the logarithm of the longest chain.  A
    node with very many links has them reduced to their smallest per task
    first (``attach_group``).
    """
    def smallest(pairs: DataFrame) -> DataFrame:
        return attach_group(pairs, ["u"], {"m": ("min", "v")})

    edges = stash(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .where("u <> v").distinct(), "edges")
    seen = None
    while True:
        both = edges.union(edges.select("v", "u"))
        # Large star: every larger neighbour v of u is hung on min(u, its neighbours).
        large = (smallest(both).where("v > u")
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())
        # Small star: u and its smaller neighbours are hung on the smallest.
        down = smallest(large)
        hung = F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        new = stash(down.select(F.explode(hung).alias("e")).select("e.u", "e.v").where("u <> v").distinct(), "edges")
        state = new.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))).first()
        edges = new
        if state == seen:  # the same links as in the round before
            break
        seen = state
    heads = edges.select("v").distinct()
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(heads.select("v", "v")))
