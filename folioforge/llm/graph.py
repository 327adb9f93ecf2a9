"""Connected components by alternating large-star and small-star steps.

Labels stay in DataFrames; no vertex or link is collected. Each round writes its links
to the checkpoint folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _canonical(links: DataFrame) -> DataFrame:
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hang each vertex's neighbours on the least of them (itself included)."""
    if large:
        arcs = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        arcs = links
    least = arcs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    hung = arcs.join(least, "a")
    if large:
        out = hung.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return _canonical(out)


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the least node that each linked node can reach.

    Nulls and links of a node with itself are left out; repeated links count once; nodes
    without a link to another aren't returned. An empty input gives an empty result.
    """
    now = checkpointed(_canonical(links.select(F.col(a).alias("a"), F.col(b).alias("b")).na.drop()))
    seen = None
    while True:
        now = checkpointed(_star(_star(now, large=True), large=False))
        # a star forest has as many links as it has leaves, and no leaf is a centre
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
    out = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return out.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
