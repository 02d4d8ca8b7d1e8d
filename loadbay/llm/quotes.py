r"""Quotation linking and reply-ordered conversations.

A line that starts with ``>`` marks (up to three blanks before each) is quoted
at the level of their number.  Quoted lines, and whole quoted passages
(consecutive lines of one level), are normalised (lower case, one space for
white space, trimmed) and hashed; so are the unquoted lines and paragraphs of
all messages.  A quoted hash belongs to the latest earlier message of the
conversation that holds it unquoted.  A message replies to the message most of
its shallowest matched quotes come from (by characters, then the later one);
without a match, to the message before it.

Conversations are ordered as reply trees, depth first, replies by turn:
consecutive messages that answer each other form a run; a run that branches
off at turn p with first turn h sorts after everything below the next message
of its parent's run.

Only DataFrame functions are used; searches by time work on blocks of turns,
so one conversation of any length spans many tasks.  Null texts are empty.
Rows with a null conv_id or turn are returned unlinked (null parent and order).
Rows that repeat (conv_id, turn) share their links and follow one another; equal
ones are read once, different ones line by line on their own.  A very long
message is one message's lines.  Extra columns are ignored, whatever their
names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadbay.llm.common import running_total, stash

BLOCK = 1024
MARKS = r"^(?:[ \t]{0,3}>)+"


def latest_before(asked: DataFrame, known: DataFrame, keys: Sequence[str], out: str,
                  same: bool = False) -> DataFrame:
    """For every distinct (keys, turn) of ``asked``, the largest turn of
    ``known`` with these keys that is smaller (or equal, with ``same``).

    Turns are cut into blocks: inside a block a window looks back, and the
    largest turn of the earlier blocks comes from one row per block.
    """
    both = (asked.select(*keys, "turn").distinct().withColumn("ask", F.lit(True))
            .withColumn("have", F.lit(None).cast("long"))
            .union(known.select(*keys, "turn").distinct()
                   .select(*keys, "turn", F.lit(False), F.col("turn")))
            .withColumn("_block", F.floor(F.col("turn") / BLOCK)))
    near = Window.partitionBy(*keys, "_block").orderBy("turn").rangeBetween(
        Window.unboundedPreceding, 0 if same else -1)
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    far = both.groupBy(*keys, "_block").agg(F.max("have").alias("_last")).withColumn(
        "_far", F.max("_last").over(earlier)).drop("_last")
    return (both.withColumn("_near", F.max("have").over(near)).where("ask").join(far, [*keys, "_block"])
            .select(*keys, "turn", F.coalesce("_near", "_far").alias(out)))


def _normal(c: Column | str) -> Column:
    return F.lower(F.trim(F.regexp_replace(c, r"[\x20\x09-\x0D]+", " ")))


def read_lines(messages: DataFrame) -> DataFrame:
    """conv_id, turn, message, pos, level, line (normalised) of every distinct
    message's lines; ``message`` tells texts of one turn apart."""
    cut = (messages.select("conv_id", "turn", "text").distinct()
           .select("conv_id", "turn", F.xxhash64("text").alias("message"),
                   F.posexplode(F.split("text", "\r\n|\r|\n")).alias("pos", "raw")))
    marks = F.regexp_extract("raw", f"({MARKS})", 1)
    return cut.select("conv_id", "turn", "message", "pos", F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
                      _normal(F.regexp_replace("raw", MARKS, "")).alias("line"))


def passages(lines: DataFrame) -> DataFrame:
    """conv_id, turn, level, hash, chars of every line and every passage: a
    stretch of one level without a blank line."""
    message = Window.partitionBy("conv_id", "turn", "message").orderBy("pos")
    breaks = ((F.col("level") != F.coalesce(F.lag("level").over(message), F.lit(-1)))
              | (F.coalesce(F.lag("line").over(message), F.lit("")) == ""))
    parts = lines.withColumn("_new", breaks.cast("int")).withColumn(
        "part", F.sum("_new").over(message.rowsBetween(Window.unboundedPreceding, 0))).where("line <> ''")
    whole = (parts.groupBy("conv_id", "turn", "message", "level", "part")
             .agg(F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("all"))
             .where(F.size("all") > 1)
             .select("conv_id", "turn", "level", F.concat_ws(" ", "all.line").alias("line")))
    return parts.select("conv_id", "turn", "level", "line").union(whole).select(
        "conv_id", "turn", "level", F.sha2("line", 256).alias("hash"), F.length("line").alias("chars"))


def without_quotes(text: Column) -> Column:
    """The text without quoted lines and the line that announces them."""
    lines = F.split(text, "\r\n|\r|\n")
    quoted = lambda x: F.coalesce(x, F.lit("")).rlike(MARKS)
    kept = F.filter(lines, lambda x, i: ~quoted(x) & ~(
        x.rlike(r"(?i)\b(?:wrote|writes|schrieb|escribió|a écrit)\s*:\s*$") & quoted(F.get(lines, i + 1))))
    return F.trim(F.array_join(kept, "\n"))


def link_replies(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, parent_turn, quoted_turn, n_quoted, reply_order,
    clean_text per message; quoted_turn is null where no quote was found."""
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                           "role", F.coalesce("text", F.lit("")).alias("text"))
    placed = rows.where("conv_id is not null and turn is not null")
    turns = stash(placed.select("conv_id", "turn").distinct(), "quote-turns")

    # Only conversations with a quote need their lines hashed.
    quoting = placed.where(F.col("text").rlike(r"(?m)" + MARKS)).select("conv_id").distinct()
    parts = stash(passages(read_lines(placed.join(quoting, "conv_id", "left_semi"))), "quote-parts")
    quoted = parts.where("level > 0")
    asked = quoted.select("conv_id", "hash", "turn")
    origin = latest_before(asked, parts.where("level = 0"), ["conv_id", "hash"], "origin").where("origin is not null")
    links = (quoted.join(origin, ["conv_id", "hash", "turn"])
             .groupBy("conv_id", "turn", "level", "origin").agg(F.sum("chars").alias("chars"))
             .groupBy("conv_id", "turn").agg(
                 F.max_by("origin", F.struct(-F.col("level"), "chars", "origin")).alias("quoted_turn")))
    before = latest_before(turns, turns, ["conv_id"], "previous")
    tree = stash(turns.join(before, ["conv_id", "turn"], "left").join(links, ["conv_id", "turn"], "left")
                 .select("conv_id", "turn", "previous", "quoted_turn",
                         F.coalesce("quoted_turn", "previous").alias("parent_turn")), "quote-tree")

    ordered = reply_keys(tree)
    counts = F.size(F.filter(F.split("text", "\r\n|\r|\n"), lambda x: x.rlike(MARKS)))
    out = rows.join(ordered, ["conv_id", "turn"], "left")
    placed_out = running_total(
        out.where("key is not null").withColumn("_same", F.xxhash64("role", "text")),
        ["conv_id"], ["key", "_same"], F.lit(1), "at").withColumn("reply_order", F.col("at") + 1)
    loose = out.where("key is null").withColumn("reply_order", F.lit(None).cast("long"))
    cols = ["conv_id", "turn", "role", "parent_turn", "quoted_turn", counts.cast("long").alias("n_quoted"),
            "reply_order", without_quotes(F.col("text")).alias("clean_text")]
    return placed_out.select(*cols).union(loose.select(*cols))


def reply_keys(tree: DataFrame) -> DataFrame:
    """conv_id, turn, parent_turn, quoted_turn, key: sorted by key, a
    conversation is in reply order."""
    heads = tree.where(~F.col("parent_turn").eqNullSafe(F.col("previous")) | F.col("previous").isNull())
    run = latest_before(tree, heads, ["conv_id"], "head", same=True)
    runs = heads.select("conv_id", F.col("turn").alias("head"), F.col("parent_turn").alias("at"))
    of_parent = run.select("conv_id", F.col("turn").alias("at"), F.col("head").alias("up"))
    # Every run's path from the first one, found by doubling: each round joins
    # the path of the run reached so far.
    own = F.when(F.col("at").isNull(), F.array().cast("array<long>")).otherwise(
        F.array(F.lit(1).cast("long"), -F.col("at"), F.col("head")))
    paths = stash(runs.join(of_parent, ["conv_id", "at"], "left").select("conv_id", "head", "up", own.alias("path")),
                  "quote-paths")
    while not paths.where("up is not null").isEmpty():
        above = paths.select("conv_id", F.col("head").alias("up"), F.col("up").alias("_up"),
                             F.col("path").alias("_path"))
        paths = stash(paths.join(above, ["conv_id", "up"], "left").select(
            "conv_id", "head", F.col("_up").alias("up"),
            F.when(F.col("_path").isNull(), F.col("path")).otherwise(F.concat("_path", "path")).alias("path")),
            "quote-paths")
    return (tree.join(run, ["conv_id", "turn"]).join(paths.select("conv_id", "head", "path"), ["conv_id", "head"])
            .select("conv_id", "turn", "parent_turn", "quoted_turn",
                    F.concat("path", F.array(F.lit(0).cast("long"), F.col("turn"))).alias("key")))
