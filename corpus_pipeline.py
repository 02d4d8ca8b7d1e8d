"""Corpus pipeline: language ID, exact dedup, near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet below the shared checkpoint folder and reads it back for the
next one.  All stages but the last return the columns of ``documents``.  Null
texts and texts without a letter have no language and go in the first stage;
an empty table stays empty through all stages; extra columns are carried along
until packing.  The dedup stages decide row by row: rows without a doc_id and
rows that share one are documents of their own, null doc_ids last in the order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadbay.llm import exact_dedup, langid, minmax_dedup, mixing, packing
from loadbay.llm.common import stash
from loadbay.llm.queries import tokenizer_path


ROW = "_row_of_stage"


def _first_rows(docs: DataFrame, groups: Callable[[DataFrame], DataFrame], group: str) -> DataFrame:
    """The first row of every group, each row a document of its own.

    Rows are numbered as they are written, once, and the number takes the
    doc_id's place in ``groups``, so the texts are not sorted.  Of a group (the
    column ``group``) the smallest doc_id stays, null last; rows that share it are
    ordered by their hash.  Only these and the numbers are shuffled for that."""
    rows = stash(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")
    found = groups(rows.select(F.col(ROW).alias("doc_id"), "text")).select(
        F.col("doc_id").alias("_of"), F.col(group).alias("_group"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"),
                     F.xxhash64(*docs.columns).alias("hash"), F.col(ROW).alias("row"))
    ranked = rows.select(F.col(ROW).alias("_of"), order.alias("_order"))
    first = found.join(ranked.hint("merge"), "_of").groupBy("_group").agg(F.min("_order").alias("first"))
    return rows.join(first.select(F.col("first.row").alias(ROW)).hint("merge"), ROW, "left_semi").drop(ROW)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the rejected ones go.

    The model is learned from the stage's own input.  Rejection reads the text
    in place, so no row is joined back."""
    return langid.accepted(docs, langid.fit(langid.learnable(docs)))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document (by doc_id) of every group of equal texts."""
    return _first_rows(docs, exact_dedup.exact_groups, "keep_id")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document (by doc_id) of every near-duplicate group: sets of
    five-word shingles with a similarity of 0.8 or more."""
    return _first_rows(docs, lambda rows: minmax_dedup.near_groups(rows, k=5, percent=80), "component_id")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their token sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("language ID", language), ("exact dedup", exact), ("near dedup", near),
          ("mixing", mix), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs


#: Language ID, near dedup and packing have no SQL form; the pipeline is tested
#: against brute force instead.
ORACLE_SQL = None
