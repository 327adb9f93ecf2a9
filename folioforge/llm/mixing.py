"""Mixing sources to target weights, in DataFrame operations only.

Tokens are summed per source (map-side first), targets are levelled over the sources, and
each document is emitted floor(rate) times plus one seeded Bernoulli copy with the
fraction's probability.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix-1"
#: above so many sources they're numbered and joined without a single task or a broadcast
FEW_SOURCES = 50_000
#: sources with more than this part of all rows are joined apart where there are many sources
HOT_SOURCES = 1000


def size_of(text="text"):
    """Words of a text; null: 0."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _numbered(sources: DataFrame, few: bool) -> DataFrame:
    """Add ``n``: 0, 1, ... by code point, null last."""
    if few:
        order = Window.orderBy(F.col("source").asc_nulls_last())
        return sources.withColumn("n", F.row_number().over(order) - 1)
    dealt = checkpointed(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()).withColumn("own", F.monotonically_increasing_id() % (1 << 33)))
    counts = sorted(dealt.groupBy("part").count().collect())  # a row for each partition
    before, rows = 0, []
    for part, n in counts:
        rows.append((part, before))
        before += n
    offsets = dealt.sparkSession.createDataFrame(rows, "part int, before long")
    return dealt.join(F.broadcast(offsets), "part").select("source", "source_size", (F.col("own") + F.col("before")).alias("n"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target): sources share all words by weight, none over ``most`` times its own.

    What a source can't take is shared again by weight among the others, until none is
    above. The level is raised by sums over the distributed table; only sums reach the driver.
    """
    sizes = checkpointed(sizes)
    few = sizes.count() <= FEW_SOURCES
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("n") % len(weights) + 1).cast("int"))
    level = checkpointed(_numbered(sizes, few).select("source", "source_size", weight.alias("weight")))
    full = F.lit(False)
    all_words = level.agg(F.sum("source_size")).first()[0] or 0
    share, capped_before = 0.0, -1
    while True:
        capped, words, open_weight = level.agg(F.count_if(full), F.coalesce(F.sum(F.when(full, most * F.col("source_size"))), F.lit(0)), F.sum(F.when(~full, F.col("weight")))).first()
        if capped == capped_before or not open_weight:
            break
        share, capped_before = (all_words - words) / open_weight, capped
        full = F.lit(share) * F.col("weight") > F.lit(float(most)) * F.col("source_size")
    target = F.when(full, F.lit(float(most)) * F.col("source_size")).otherwise(F.lit(share) * F.col("weight"))
    out = level.select("source", "source_size", target.cast("double").alias("target"))
    return F.broadcast(out) if few else out


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """Add size, source_size, target and ``copies`` to the documents.

    Null texts have size 0 and are never taken; null sources are one source, the last.
    The copy beyond the whole ones is drawn from md5(seed:doc_id), so reruns agree and
    rows with one doc_id get one draw; a null doc_id counts as the empty text. Columns of these
    names in the input are replaced; no documents: an empty result.
    """
    taken = {"size", "source_size", "target", "copies"}
    docs = docs.drop(*[c for c in docs.columns if c in taken]).withColumn("size", size_of())
    sizes = checkpointed(docs.groupBy(F.col("source").cast("string").alias("source")).agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")))
    n, total = sizes.agg(F.count("*"), F.sum("rows")).first()
    own = "_source"
    while own in docs.columns:
        own += "_"
    shares = targets(sizes.select("source", "source_size"), weights, most).withColumnRenamed("source", own)
    named = docs["source"].cast("string").eqNullSafe(F.col(own))
    if n <= FEW_SOURCES:
        joined = docs.join(shares, named)
    else:
        # at most HOT_SOURCES have more than that part of all rows; their rows stay where they are
        hot = sizes.where(F.col("rows") * HOT_SOURCES > total).select(F.col("source").alias(own))
        hot_shares = shares.alias("s").join(F.broadcast(hot.alias("h")), F.col(f"s.{own}").eqNullSafe(F.col(f"h.{own}")), "left_semi")
        joined = docs.join(F.broadcast(hot_shares), named).unionByName(docs.join(F.broadcast(hot), named, "left_anti").join(shares, named))
    joined = joined.drop(own)
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13), 16, 10).cast("double") / float(1 << 52)
    copies = F.when(F.col("size") > 0, F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).otherwise(0)
    return joined.withColumn("copies", copies.cast("long"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The mixed documents themselves: each row ``copies`` times, with the input's columns and ``copy`` from 1."""
    columns = [c for c in docs.columns if c != "copy"]
    out = plan(docs, weights, most, seed).where("copies > 0")
    return out.select(*columns, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
