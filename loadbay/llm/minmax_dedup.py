"""Near-duplicate groups by min-max hashing.

Each document's set of k-word shingles is hashed once per permutation, and
both the smallest and the largest value are kept, so 32 permutations give 64
signature values.  Bands of 3 values make bucket keys: at a similarity of 0.8 a
pair shares one of the 21 bands with probability 1 - 3e-7.  Every pair that is
linked is confirmed on its full sets.

Groups of any size never meet in one task and are never expanded into pairs:

* documents with equal sets are one node;
* in a bucket every node is compared with two nodes only (its smallest and
  its largest id);
* buckets that still hold several components afterwards are searched again:
  those of at most ``SMALL_BUCKET`` nodes pair by pair; in larger ones the
  nodes outside the largest component are compared with the others block by
  block, signatures first and full sets where those allow a link, and a block
  returns one link for every two components it joins, never all links.

Null or empty texts have an empty set and link with nothing.  Rows with a
null doc_id are returned with their set size and link with nothing.  Rows that
share a doc_id are one node.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadbay.llm import words as W
from loadbay.llm.common import attach_group, components, stash, text_batches

PERMUTATIONS = 32
BAND_ROWS = 3
#: A bucket of so many nodes may be expanded into pairs of different components.
SMALL_BUCKET = 16
#: Nodes of a larger bucket that are compared at a time, and the shingles that
#: they may have together (or one larger set).
BLOCK = 512
MASS = 1 << 21


def _signer(k: int, perms: int, rows: int):
    rng = np.random.default_rng(7)
    mult = rng.integers(1, 1 << 63, perms, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    flip = rng.integers(0, 1 << 63, perms, dtype=np.uint64)
    n_bands = 2 * perms // rows
    # Value j of band b is number b + j * n_bands of [minima, maxima], so a
    # band never holds both ends of one permutation.
    pick = [[b + j * n_bands for j in range(rows)] for b in range(n_bands)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = W.buffers(batch.column(1))
            for i, j in W.blocks(off, W.SMALL_BLOCK):
                o = off[i: j + 1] - off[i]
                h, at = W.shingle_hashes(*W.word_hashes(data[off[i]: off[j]], o), k)
                d = j - i
                n = np.zeros(d, np.int64)
                f = np.zeros((2, d), np.uint64)
                for r in range(d):
                    u = np.unique(h[at[r]: at[r + 1]])
                    n[r] = len(u)
                    f[0, r], f[1, r] = W.scramble(u).sum(), W.scramble(u ^ flip[0]).sum()
                sig = np.zeros((2 * perms, d), np.uint64)
                full = np.flatnonzero(n)
                if len(full):
                    starts = at[full]
                    for p in range(perms):
                        v = (h ^ flip[p]) * mult[p]
                        sig[p, full] = np.minimum.reduceat(v, starts)
                        sig[perms + p, full] = np.maximum.reduceat(v, starts)
                bands = np.zeros((d, n_bands), np.uint64)
                for b, idx in enumerate(pick):
                    key = np.full(d, b, np.uint64) * W._MIX[60]
                    for c, s in enumerate(idx):
                        key += sig[s] * W._MIX[c]
                    bands[:, b] = W.scramble(key)
                short = np.ascontiguousarray(((sig >> np.uint64(20)) & np.uint64(255)).astype(np.uint8).T)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, d), pa.array(n), pa.array(f[0].view(np.int64)),
                     pa.array(f[1].view(np.int64)),
                     pa.ListArray.from_arrays(np.arange(0, (d + 1) * n_bands, n_bands, dtype=np.int32),
                                              pa.array(bands.ravel().view(np.int64))),
                     pa.array([row.tobytes() for row in short], pa.binary())],
                    names=["doc_id", "n_shingles", "f1", "f2", "bands", "short"])
    return run


def _set_maker(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = W.buffers(batch.column(1))
            for i, j in W.blocks(off, W.SMALL_BLOCK):
                o = off[i: j + 1] - off[i]
                h, at = W.shingle_hashes(*W.word_hashes(data[off[i]: off[j]], o), k)
                sets = [np.unique(h[at[r]: at[r + 1]]) for r in range(j - i)]
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i),
                     pa.ListArray.from_arrays(ends, pa.array(flat.view(np.int64)))],
                    names=["node", "hashes"])
    return run


def _least(perms: int, percent: int) -> int:
    """Signature values a linked pair shares at least.

    A pair at the threshold shares 2 * perms * percent / 100 on average; this
    is five standard deviations less (one linked pair in three million)."""
    share = percent / 100
    return max(0, int(2 * perms * share - 5 * (2 * perms * share * (1 - share)) ** 0.5))


def _bytes(column: pa.Array | pa.ChunkedArray, rows: int) -> np.ndarray:
    """Binary values of one length as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(rows, -1)


def _alike(least: int):
    """Keep pairs (a, b, sa, sb) whose one-byte signatures agree in ``least`` places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            keep = (_bytes(batch.column(2), n) == _bytes(batch.column(3), n)).sum(axis=1) >= least if n else []
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
    return run


def _promising(pairs: DataFrame, nodes: DataFrame, percent: int, perms: int) -> DataFrame:
    """The pairs (a, b) whose signatures allow a link."""
    a, b = (nodes.select(F.col("doc_id").alias(x), F.col("short").alias(f"s{x}")).hint("merge") for x in "ab")
    return (pairs.join(b, "b").join(a, "a").select("a", "b", "sa", "sb")
            .mapInArrow(_alike(_least(perms, percent)), "a long, b long"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    a, b = (sets.select(F.col("node").alias(x), F.col("hashes").alias(f"h{x}")).hint("merge") for x in "ab")
    both = pairs.join(b, "b").join(a, "a")
    inter = F.size(F.array_intersect("ha", "hb"))
    union = F.size("ha") + F.size("hb") - inter
    return both.where(inter * 100 >= union * percent).select("a", "b")


def near_groups(docs: DataFrame, k: int = 5, percent: int = 80, perms: int = PERMUTATIONS,
                rows: int = BAND_ROWS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest
    doc_id reachable over links), kept (doc_id = component_id)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with text_batches(docs.sparkSession):
        signed = stash(docs.mapInArrow(
            _signer(k, perms, rows),
            "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>, short binary"), "minmax-signed")
    usable = signed.where("n_shingles > 0 and doc_id is not null")

    # Documents with equal sets are one node, named by the smallest doc_id.
    members = stash(attach_group(
        usable.select("doc_id", "f1", "f2"), ["f1", "f2"], {"node": ("min", "doc_id")}, "minmax-equal")
        .select("doc_id", "node").distinct(), "minmax-members")
    named = members.where("doc_id = node").select("doc_id").hint("merge")
    nodes = stash(usable.join(named, "doc_id", "left_semi").select("doc_id", "bands", "short", "n_shingles"),
                  "minmax-nodes")

    keyed = nodes.select(F.col("doc_id").alias("node"), "n_shingles", F.explode("bands").alias("key"))
    buckets = stash(
        attach_group(keyed.withColumn("one", F.lit(1)), ["key"],
                     {"low": ("min", "node"), "high": ("max", "node"), "size": ("sum", "one"), "mass": ("sum", "n_shingles")},
                     "minmax-bucket-sizes").where("low <> high").drop("one", "n_shingles"), "minmax-buckets")
    with text_batches(docs.sparkSession):
        sets = stash(docs.join(buckets.select(F.col("node").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi")
                     .select("doc_id", "text").mapInArrow(_set_maker(k), "node long, hashes array<long>"),
                     "minmax-sets")

    star = (buckets.where("node <> low").select(F.col("low").alias("a"), F.col("node").alias("b"))
            .union(buckets.where("node <> high and low <> node")
                   .select(F.col("node").alias("a"), F.col("high").alias("b"))).distinct())
    links = stash(_confirmed(_promising(star, nodes, percent, perms), sets, percent), "minmax-links")
    found = components(links)

    # Buckets whose nodes do not yet form one component.
    placed = (buckets.select("key", "node", "size", "mass").join(found.hint("merge"), "node", "left")
              .withColumn("component", F.coalesce("component", "node")))
    open_ = stash(attach_group(placed, ["key"], {"c0": ("min", "component"), "c1": ("max", "component")},
                               "minmax-bucket-parts").where("c0 <> c1"), "minmax-open")
    small = open_.where(F.col("size") <= SMALL_BUCKET).select("key", "node", "component")
    pairs = (small.withColumnsRenamed({"node": "a", "component": "ca"})
             .join(small.withColumnsRenamed({"node": "b", "component": "cb"}).hint("merge"), "key")
             .where("ca < cb").select("a", "b").distinct())
    large = open_.where(F.col("size") > SMALL_BUCKET).select("key", "node", "component", "size", "mass")
    more = _confirmed(_promising(pairs, nodes, percent, perms), sets, percent)
    if not large.isEmpty():
        more = more.union(_across(large, nodes, sets, _least(perms, percent), percent))
    more = stash(more, "minmax-links")
    if not more.isEmpty():  # the components found so far are stars already
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))

    placed = members.join(found.hint("merge"), "node", "left").select(
        "doc_id", F.coalesce("component", "node").alias("component_id"))
    # Rows of one doc_id with several sets: its smallest component.
    placed = placed.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    return (signed.select("doc_id", "n_shingles").join(placed.hint("merge"), "doc_id", "left")
            .withColumn("component_id", F.coalesce("component_id", "doc_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def _across(large: DataFrame, nodes: DataFrame, sets: DataFrame, least: int, percent: int) -> DataFrame:
    """Links that join the components of large open buckets.

    Only nodes outside their bucket's largest component ask; they meet the
    bucket's nodes block by block.  A pair is compared in its first common
    bucket only.
    """
    one = large.withColumn("one", F.lit(1))
    held = one.groupBy("key", "component").agg(F.sum("one").alias("n"))
    main = stash(held.groupBy("key").agg(F.max(F.struct("n", "component")).alias("main")), "minmax-main")
    spread = F.xxhash64("node")
    heavy = F.ceil(F.col("mass") / MASS)
    rows = stash(large.join(main.hint("merge"), "key").select(
        "key", "node", "component", (F.col("component") != F.col("main.component")).alias("asks"),
        F.greatest(F.ceil(F.col("size") / BLOCK), heavy).alias("parts"),
        F.greatest(F.ceil((F.col("size") - F.col("main.n")) / BLOCK), heavy).alias("ask_parts")), "minmax-large")
    known = nodes.select(F.col("doc_id").alias("node"), "short", "bands").join(sets.hint("merge"), "node")
    known = stash(known.join(rows.select("node").distinct().hint("merge"), "node", "left_semi"), "minmax-known")
    dealt = [
        rows.where("asks").withColumn("q", F.pmod(spread, "ask_parts")).withColumn(
            "_others", F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)),
        rows.withColumn("p", F.pmod(spread, "parts")).withColumn(
            "_others", F.sequence(F.lit(0).cast("long"), F.col("ask_parts") - 1))]
    cols = ["key", "p", "q", "node", "component", "short", "bands", "hashes"]
    ask, have = (
        side.join(known.hint("merge"), "node").withColumn(other, F.explode("_others"))
        .select(*[F.col(c).alias(f"{other}_{c}") for c in cols])
        .groupBy(f"{other}_key", f"{other}_p", f"{other}_q")
        for side, other in zip(dealt, "pq"))
    return ask.cogroup(have).applyInArrow(_block_links(least, percent), "a long, b long")


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column one after the other, and each row's range."""
    lists = column.combine_chunks()
    at = np.asarray(lists.offsets, np.int64)
    return np.asarray(lists.values)[at[0]: at[-1]], at - at[0]


def _block_links(least: int, percent: int):
    def run(ask: pa.Table, have: pa.Table) -> pa.Table:
        ask, have = (t.rename_columns([c[2:] for c in t.column_names]) for t in (ask, have))
        out_a, out_b = [], []
        if ask.num_rows and have.num_rows:
            key = ask.column("key")[0].as_py()
            node, asking = (np.asarray(t.column("node")) for t in (have, ask))
            comp, own_comp = (np.asarray(t.column("component")).copy() for t in (have, ask))
            short, shorts = (_bytes(t.column("short"), t.num_rows) for t in (have, ask))
            bands, asked = (_lists(t.column("bands"))[0].reshape(t.num_rows, -1) for t in (have, ask))
            flat, at = _lists(have.column("hashes"))
            own_flat, own_at = _lists(ask.column("hashes"))
            size = np.diff(at)
            for r in range(len(asking)):
                apart = np.flatnonzero(comp != own_comp[r])  # components joined in this block are one by now
                apart = apart[(short[apart] == shorts[r]).sum(axis=1) >= least]
                same = bands[apart] == asked[r]
                some = apart[bands[apart, same.argmax(axis=1)] == key]
                if not len(some):
                    continue
                own = np.sort(own_flat[own_at[r]: own_at[r + 1]])
                n = size[some]
                start = np.cumsum(n) - n
                other = flat[np.repeat(at[some] - start, n) + np.arange(n.sum())]
                hit = own[np.minimum(np.searchsorted(own, other), len(own) - 1)] == other
                inter = np.add.reduceat(hit.astype(np.int64), start)
                linked = some[inter * 100 >= (n + len(own) - inter) * percent]
                joined, first = np.unique(comp[linked], return_index=True)
                out_a += [int(asking[r])] * len(joined)
                out_b += node[linked[first]].tolist()
                comp[np.isin(comp, joined)] = own_comp[r]
                own_comp[np.isin(own_comp, joined)] = own_comp[r]
        a, b = np.array(out_a, np.int64), np.array(out_b, np.int64)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})
    return run
