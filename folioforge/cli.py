"""Command line: ingest a link file, or find facilities in what has been ingested."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions.paths import split_sources
from .operators import ner
from .plans import pipeline
from .sources import files, links, remote, sinks

META_COLUMNS = "bibcode string, meta_bibcode string, index_date string, ft_source string, meta_mtime long, fulltext_mtime long"


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="folioforge", description=__doc__)
    p.add_argument("--full-text-links", "-f", dest="links", help="tab-separated file of bibcode, source and provider")
    p.add_argument("--force-extract", "-x", action="store_true", help="extract even what is up to date")
    p.add_argument("--force-send", "-s", action="store_true", help="send stored content again")
    p.add_argument("--facility-ner", "-ner", dest="entities", action="store_true", help="find facilities of stored records only")
    p.add_argument("--max", "-m", dest="limit", type=int, default=0, help="take the first so many records; 0: all")
    p.add_argument("--out", "-o", default="extracted", help="folder of the result tables")
    p.add_argument("--service", default=None, help="URL of a PDF service")
    p.add_argument("--names", default="", help="facility names, comma-separated")
    p.add_argument("--bibcodes", "-b", default="", help="diagnose these records: comma-separated, with --raw-files and --providers")
    p.add_argument("--raw-files", "-r", dest="raw_files", default="")
    p.add_argument("--providers", "-p", default="")
    return p


def has_stored(spark: SparkSession, folder: str) -> bool:
    """Whether an earlier run has stored metadata there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/meta/_SUCCESS")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def main(args: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(args)
    spark = spark or SparkSession.builder.appName("folioforge").getOrCreate()
    if a.bibcodes:
        records = links.force(links.diagnostics(spark, a.bibcodes.split(","), a.raw_files.split(","), a.providers.split(",")), a.force_extract, a.force_send)
    else:
        records = links.read(spark, a.links, a.force_extract, a.force_send)
    records = links.first_records(records, a.limit, F.monotonically_increasing_id())
    if a.entities and not a.force_extract:
        stored = files.stored_content(spark, a.out)
        model = ner.gazetteer(n for n in a.names.split(",") if n)
        found = pipeline.entities(records, stored, model, model)
        found.select("bibcode", ner.facility_json().alias("value")).write.mode("overwrite").parquet(f"{a.out}/facility_ner")
        return 0
    remote.enable_pdf(a.service)
    paths = records.select(F.explode(split_sources(F.col("ft_source"))).alias("path"))
    before = has_stored(spark, a.out)
    meta = files.stored_meta(spark, a.out) if before else spark.createDataFrame([], META_COLUMNS)
    old = paths.unionByName(meta.select(F.explode(split_sources(F.col("ft_source"))).alias("path")))
    prior = files.stored_content(spark, a.out) if before else None
    out = pipeline.ingest(records, meta, files.stats(old), prior, root=a.out, service=a.service, get=remote.fetch).persist()
    there = meta.select("bibcode", F.lit(True).alias("has_meta"), F.col("fulltext_mtime").isNotNull().alias("has_fulltext"))
    sinks.write_tables(sinks.unsent(out, there), a.out)
    sinks.send(out, f"{a.out}/messages")
    return out.where("error is not null").count()


if __name__ == "__main__":
    raise SystemExit(0 if main() == 0 else 1)
