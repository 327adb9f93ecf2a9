"""A corpus pipeline of five stages over ``documents``; each stage's rows are the next one's documents."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import decontaminate, graph, language_id, mixing, near_copies, simhash, substring_dedup
from folioforge.llm.common import checkpointed, settings, short_batches, stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _bounded(stage):
    """The stage in short batches, which the session keeps; ``run`` sets it back."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        short_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


@_bounded
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents in which no language can be told (``und``: null or without a letter).

    That is a letter test, which needs no model; where nothing is there to train on, it is made directly.
    """
    model = language_id.train(docs)
    if model is None:
        return docs.where(F.col("text").cast("string").rlike(r"\p{L}"))
    marked = language_id.with_language(docs, model)
    return marked.where(F.col("lang_pred") != language_id.UNKNOWN).select(*docs.columns)


@_bounded
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of linked texts: that of the least doc_id (nulls last).

    Texts are linked whose fingerprints differ by at most four bits, and those whose 5-word shingles are 0.8 similar or
    more. Rows are told by doc_id and text, so unrelated texts under one doc_id (or under none) all stay.
    """
    keyed = docs.withColumn("_key", F.xxhash64(F.col("text").cast("string")))
    texts = keyed.select(F.col("_key").alias("key"), F.col("text").cast("string").alias("text"))
    prints = checkpointed(simhash.fingerprints(texts.select(F.col("key").alias("doc_id"), "text")).withColumnRenamed("doc_id", "key").distinct())
    named = checkpointed(prints.groupBy("fp").agg(F.min("key").alias("rep")))
    near = simhash.links(named.select("fp"))
    near = near.join(named.select(F.col("fp").alias("a"), F.col("rep").alias("x")), "a").join(named.select(F.col("fp").alias("b"), F.col("rep").alias("y")), "b")
    equal = prints.join(named, "fp").select(F.col("key").alias("a"), F.col("rep").alias("b"))
    links = near.select(F.col("x").alias("a"), F.col("y").alias("b")).unionByName(equal).unionByName(near_copies.links(texts))
    grown = graph.components(links, "a", "b").withColumnRenamed("node", "_key")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_key")).alias("first")
    firsts = keyed.groupBy("_key").agg(first).join(grown, "_key", "left")
    kept = firsts.groupBy(F.coalesce("component", "_key")).agg(F.min("first").alias("first")).select(F.col("first._key").alias("k"), F.col("first.doc_id").alias("d"))
    left = keyed.join(kept, (F.col("_key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("d")), "left_semi")
    one = left.groupBy("_key", "doc_id").agg(F.min_by(F.struct(*docs.columns), F.struct("text", "source", "lang")).alias("one"))
    return one.select("one.*")


@_bounded
def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the passages of 13 words or more that a smaller doc_id has too; texts left without a word go."""
    cut = substring_dedup.cut_documents(docs)
    return cut.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@_bounded
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item within its edit budget."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


@_bounded
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents so that sources come near their target weights; ``copy`` counts from 1."""
    return mixing.mix(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("decontaminated", decontaminated),
    ("mixed", mixed),
]

#: fingerprints, the random field and alignments aren't SQL; tests/llm holds the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = short_batches(spark)
    try:
        docs = table(spark, sf_dir, "documents").select(*COLUMNS)
        for k, (_, stage) in enumerate(STAGES):
            docs = stage(spark, docs, sf_dir)
            if k < len(STAGES) - 1:
                docs = stored(docs)
        return docs  # the last stage runs no Python
    finally:
        settings(spark, before)
