"""The three entry points as plans: ingest of links, extraction of one format, entities of stored records."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import split_sources
from ..operators import assemble, decide, ner
from ..operators.extract import extract
from ..sources import files, remote


def to_extract(links: DataFrame, meta: DataFrame, stats: DataFrame, root: str = "/extract", service: str | None = None) -> DataFrame:
    """Decided records that need work, PDFs doubled for a service if there is one."""
    return decide.with_grobid(decide.decide(links, meta, stats, root).where("selected"), service)


#: what an extraction depends on
WORK = ("bibcode", "file_format", "ft_source", "provider")


def extracted(records: DataFrame, content: DataFrame | None = None, get: remote.Fetch | None = None) -> DataFrame:
    """Fields of records: their files are taken apart, read, extracted one by one, and put together in order.

    content: (path, content) to join; by default the paths are opened by the workers, and ``get`` fetches those that are
    URLs. ft_source stays what it was. A record listed twice is extracted once, and gives two rows with one text.
    """
    head = records.select("bibcode", "ft_source", "provider", "update_reason", "meta_path", "index_date", "file_format")
    work = head.select(*WORK).distinct().withColumn("key", F.struct(*WORK))
    url = F.when(F.col("ft_source").rlike("^https?://"), F.array("ft_source"))
    need = assemble.explode_sources(work, F.coalesce(url, split_sources(F.col("ft_source")))).select("key", "pos", "path", "file_format", "provider")
    read = files.with_content(need, get) if content is None else need.join(content, "path", "left")
    got = assemble.concat_files(extract(read), "key").select(*[F.col("key").getField(c).alias(f"_{c}") for c in WORK], "*").drop("key")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in WORK])
    return head.join(got, same, "left").drop(*[f"_{c}" for c in WORK])


def ingest(links: DataFrame, meta: DataFrame, stats: DataFrame, prior: DataFrame | None = None, content: DataFrame | None = None, root: str = "/extract", service: str | None = None, get: remote.Fetch | None = None) -> DataFrame:
    """From links to records with content; what's only to be sent comes from ``prior`` where it can."""
    todo = to_extract(links, meta, stats, root, service)
    if prior is None:
        return extracted(todo, content, get)
    split = decide.recover(todo, prior)
    fresh = extracted(split.where(~F.col("recovered")), content, get)
    kept = split.where("recovered").withColumn("error", F.lit(None).cast("string")).select(fresh.columns)
    return fresh.unionByName(kept)


def entities(links: DataFrame, stored: DataFrame, ack_model: Callable, text_model: Callable) -> DataFrame:
    """Facilities of records that have been extracted before."""
    known = stored.join(links.select("bibcode").distinct(), "bibcode", "left_semi")
    return ner.facilities(known, ack_model, text_model)
