"""Files of records: their state, their content, and what earlier runs stored."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import META, STATS
from .remote import HEADERS, Fetch


def _local_stats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import os
    import stat

    for b in batches:
        rows = []
        for path in b["path"]:
            try:
                s = os.stat(path)
                rows.append((path, True, s.st_size, s[stat.ST_MTIME]))
            except (OSError, TypeError, ValueError):
                rows.append((path, False, None, None))
        yield pd.DataFrame(rows, columns=["path", "exists", "size", "mtime"]).astype({"size": "Int64", "mtime": "Int64"})


def stats(paths: DataFrame) -> DataFrame:
    """(path, exists, size, mtime) of distinct paths on a file system that workers mount; empty files count."""
    return paths.select("path").distinct().mapInPandas(_local_stats, STATS)


def listed_stats(spark: SparkSession, folder: str) -> DataFrame:
    """The same from a listing by Spark's own reader, for stores that only it reaches (it passes over empty files)."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    path = F.regexp_replace(F.col("path"), r"^[a-z0-9]+:(//[^/]*)?", "")
    return found.select(path.alias("path"), F.lit(True).alias("exists"), F.col("length").alias("size"), F.unix_timestamp("modificationTime").alias("mtime"))


def contents(spark: SparkSession, folder: str) -> DataFrame:
    """(path, content) of all files below a folder."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return found.select(F.regexp_replace(F.col("path"), r"^[a-z0-9]+:(//[^/]*)?", "").alias("path"), "content")


def _read(get: Fetch | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), 16):
                part = b.iloc[i : i + 16].copy()
                part["content"] = [_bytes(p, get) for p in part["path"]]
                yield part

    return run


def _bytes(path: str, get: Fetch | None) -> bytes | None:
    try:
        if get is not None and path.startswith(("http://", "https://")):
            status, body = get(path, HEADERS)
            return body.encode() if status == 200 else None
        with open(path, "rb") as f:
            return f.read()
    except (OSError, TypeError, AttributeError):
        return None


def with_content(records: DataFrame, get: Fetch | None = None) -> DataFrame:
    """Add the bytes at each record's ``path``; null where it can't be read. A few files are held at a time.

    get: fetches paths that are URLs (status, body); any status but 200 is null.
    """
    kept = [c for c in records.columns if c != "content"]
    fields = ", ".join(f"`{c}` {records.schema[c].dataType.simpleString()}" for c in kept)
    return records.select(*kept).mapInPandas(_read(get), f"{fields}, content binary")


def texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): whole files as text; .gz is unpacked."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def meta(spark: SparkSession, path: str) -> DataFrame:
    """Stored metadata with a fixed schema, so that a missing key is null."""
    return spark.read.schema(META).json(path)


def prior_content(meta_rows: DataFrame, texts_by_key: DataFrame) -> DataFrame:
    """Metadata with the stored full text ('' if there's none) and acknowledgements that it doesn't hold itself."""
    own = texts_by_key.select(F.col("bibcode").alias("_key"), F.col("fulltext").alias("_text"), F.col("acknowledgements").alias("_ack"))
    out = meta_rows.join(own, meta_rows["bibcode"] == F.col("_key"), "left")
    return out.withColumns({"fulltext": F.coalesce("_text", F.lit("")), "acknowledgements": F.coalesce("acknowledgements", "_ack")}).drop("_key", "_text", "_ack")


def latest(rows: DataFrame) -> DataFrame:
    """Of each bibcode the row with the last index_date."""
    return rows.groupBy("bibcode").agg(F.max_by(F.struct(*rows.columns), "index_date").alias("r")).select("r.*")


def stored_meta(spark: SparkSession, folder: str) -> DataFrame:
    """What the decision needs of records that ``sinks.write_tables`` has stored; their index_date is their time."""
    meta_rows = latest(spark.read.parquet(f"{folder}/meta")).select(F.from_json("value", META).alias("m")).select("m.*")
    text = latest(spark.read.parquet(f"{folder}/fulltext")).select("bibcode", F.unix_timestamp(F.try_to_timestamp("index_date")).alias("fulltext_mtime"))
    time = F.unix_timestamp(F.try_to_timestamp("index_date")).alias("meta_mtime")
    return meta_rows.select("bibcode", F.col("bibcode").alias("meta_bibcode"), "index_date", "ft_source", time).join(text, "bibcode", "left")


def stored_content(spark: SparkSession, folder: str) -> DataFrame:
    """Stored records with all their content, for sending again and for entity recognition."""
    meta_rows = latest(spark.read.parquet(f"{folder}/meta")).select(F.from_json("value", META).alias("m")).select("m.*")
    texts = latest(spark.read.parquet(f"{folder}/fulltext")).select("bibcode", "fulltext").join(latest(spark.read.parquet(f"{folder}/acknowledgements")).select("bibcode", "acknowledgements"), "bibcode", "full")
    return prior_content(meta_rows, texts)
