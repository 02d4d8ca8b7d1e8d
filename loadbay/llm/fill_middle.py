r"""Fill-in-the-middle rewriting of whole texts, cut at units by a Fenwick tree.

A unit is a run of ASCII letters or any other single code point.  A text's
UTF-8 bytes are divided into blocks of ``BLOCK`` bytes; each block has its
number of unit starts and of code points.  A Fenwick tree holds both counts, so
a binary-lifting descent finds the block in which unit k starts and the code
points before that block; the boundary is then located inside the one block.
A text of any length is cut with two descents and two block scans.

Prefix and middle are put into one of two orders (``psm``, ``spm``) between
marks, or the text stays ``plain``; all choices are drawn from a hash of the
doc_id, so reruns agree.  ``restored`` rebuilds the text from output and form
alone: a plain text may hold the marks, a rewritten one never does.

A null text counts as empty (plain, no units).  A null doc_id draws as if it
were the empty string.  Repeated rows, and rows sharing a doc_id, are rewritten
row by row.  A very long text needs a few copies of its own bytes.  Extra
columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadbay.llm import words as W

#: Bytes of a text block: one entry of the tree each.
BLOCK = 4096
#: Marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: Per cent of the texts that may be rewritten, and of those that put the suffix first.
REWRITTEN = 90
SUFFIX_FIRST = 20

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags of the bytes that start a unit and of those that start a code
    point, for texts that lie one after the other."""
    letter = _LETTER[data]
    point = (data & 0xC0) != 0x80
    start = point.copy()
    start[1:] &= ~(letter[1:] & letter[:-1])
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[first] = True
    return start, point


class BlockTree:
    """Fenwick tree over the blocks of one text: unit starts and code points."""

    def __init__(self, start: np.ndarray, point: np.ndarray, block: int = BLOCK):
        self.start, self.point, self.block = start, point, block
        edges = np.arange(0, len(start), block)
        sums = np.zeros((len(edges) + 1, 2), np.int64)
        if len(edges):
            sums[1:, 0] = np.cumsum(np.add.reduceat(start, edges, dtype=np.int64))
            sums[1:, 1] = np.cumsum(np.add.reduceat(point, edges, dtype=np.int64))
        self.units, self.points = (int(x) for x in sums[-1])
        # Node i covers the blocks after i without its lowest bit, up to i.
        i = np.arange(len(edges) + 1)
        self.tree = (sums - sums[i & np.maximum(i - 1, 0)]).tolist()

    def cut(self, k: int) -> tuple[int, int]:
        """Bytes and code points before unit k (all of them where k is the
        number of units)."""
        at, points = 0, 0
        step = 1 << max(len(self.tree) - 1, 1).bit_length() - 1
        while step:
            node = at + step
            if node < len(self.tree) and self.tree[node][0] <= k:
                at = node
                k -= self.tree[node][0]
                points += self.tree[node][1]
            step >>= 1
        here = at * self.block
        if here >= len(self.start):
            return len(self.start), points
        inside = int(np.flatnonzero(self.start[here: here + self.block])[k])
        return here + inside, points + int(np.count_nonzero(self.point[here: here + inside]))


def _rewriter(marks: tuple[str, str, str], rewritten: int, suffix_first: int):
    p, s, m = (x.encode() for x in marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            draws = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(2, 6)]
            data, off = W.buffers(batch.column(1))
            for i, j in W.blocks(off):
                o = off[i: j + 1] - off[i]
                held = data[off[i]: off[j]]
                start, point = unit_starts(held, o)
                n, form, chars, out = [], [], [], []
                for r in range(j - i):
                    tree = BlockTree(start[o[r]: o[r + 1]], point[o[r]: o[r + 1]])
                    text = held[o[r]: o[r + 1]].tobytes()
                    h1, h2, h3, h4 = (int(d[i + r]) for d in draws)
                    n.append(tree.units)
                    if not text or h3 % 100 >= rewritten or p in text or s in text or m in text:
                        form.append("plain")
                        chars.append((None, None))
                        out.append(text)
                        continue
                    low, high = sorted((h1 % (tree.units + 1), h2 % (tree.units + 1)))
                    (a, before), (b, upto) = tree.cut(low), tree.cut(high)
                    form.append("spm" if h4 % 100 < suffix_first else "psm")
                    chars.append((before, upto - before))
                    parts = ((s, text[b:], p, text[:a]) if form[-1] == "spm" else (p, text[:a], s, text[b:]))
                    out.append(b"".join((*parts, m, text[a:b])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                     pa.array([c[0] for c in chars], pa.int64()), pa.array([c[1] for c in chars], pa.int64()),
                     pa.array(out, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def rewrite(docs: DataFrame, seed: int = 1, marks: tuple[str, str, str] = MARKS, rewritten: int = REWRITTEN,
            suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (code points, null if
    plain), output (the rewritten text) per document."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))), 256)
    group = lambda g: F.conv(F.substring(drawn, 8 * g + 1, 8), 16, 10).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"),
                       *[group(g).alias(f"h{g + 1}") for g in range(4)])
    return rows.mapInArrow(
        _rewriter(marks, rewritten, suffix_first),
        "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that ``rewrite`` got, from its output and form.

    A mark first occurs where it was put: the texts between hold none, and no
    mark ends with the start of another."""
    p, s, m = (rf"\Q{x}\E" for x in marks)

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.get(F.split(output, first, 2), 1)
        halves = F.split(body, second, 2)
        tail = F.split(F.get(halves, 1), m, 2)
        return F.get(halves, 0), F.get(tail, 0), F.get(tail, 1)

    a, c, b = parts(p, s)
    c2, a2, b2 = parts(s, p)
    return F.when(form == "psm", F.concat(a, b, c)).when(form == "spm", F.concat(a2, b2, c2)).otherwise(output)
