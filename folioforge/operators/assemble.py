"""Putting results together: files to records, messages, stored metadata, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.textclean import clean


def explode_sources(records: DataFrame, sources: Column) -> DataFrame:
    """A row for each file of a record, with its place ``pos``."""
    return records.select("*", F.posexplode(sources).alias("pos", "path"))


def _in_order(value: str) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct("pos", F.col(value).alias("v")))), lambda x: x["v"])


def concat_files(files: DataFrame, key: str = "bibcode", pos: str = "pos") -> DataFrame:
    """One row a record: texts joined by a space in file order, lists one after the other, errors by ``; ``.

    Null texts are left out; a record without any has null. A record's files are few; what's
    collected is bounded by its file list.
    """
    files = files.withColumn("pos", F.col(pos))

    def text(c: str) -> Column:
        kept = F.filter(_in_order(c), lambda x: x.isNotNull())
        return F.when(F.size(kept) > 0, F.array_join(kept, " ")).alias(c)

    def values(c: str) -> Column:
        kept = F.filter(_in_order(c), lambda x: x.isNotNull())
        return F.when(F.size(kept) > 0, F.flatten(kept)).alias(c)

    texts = [c for c in ("fulltext", "acknowledgements") if c in files.columns]
    lists = [c for c in ("dataset", "facility") if c in files.columns]
    errors = [F.nullif(F.array_join(F.filter(_in_order("error"), lambda x: x.isNotNull()), "; "), F.lit("")).alias("error")] if "error" in files.columns else []
    return files.groupBy(key).agg(*[text(c) for c in texts], *[values(c) for c in lists], *errors)


def concat_texts(rows: DataFrame, key: str, pos: str, text: str, joint: str = " ") -> DataFrame:
    """(key, fulltext): texts of a key joined in order of pos."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(text).alias("v"))))
    return rows.where(F.col(text).isNotNull()).groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x["v"]), joint).alias("fulltext"))


def message(records: DataFrame) -> DataFrame:
    """What goes downstream: the body cleaned once more, and the fields that aren't empty."""
    return records.select(
        "bibcode",
        clean(F.col("fulltext"), translated=False).alias("body"),
        F.nullif(F.col("acknowledgements"), F.lit("")).alias("acknowledgements"),
        F.when(F.size("dataset") > 0, F.col("dataset")).alias("dataset"),
        F.when(F.size("facility") > 0, F.col("facility")).alias("facility"),
    )


def meta_json() -> Column:
    """Stored metadata: keys that are null stay out, empty texts stay in."""
    names = ["meta_path", "ft_source", "bibcode", "provider", F.col("update_reason").alias("UPDATE"), "file_format", "index_date", "dataset", "facility", "acknowledgements"]
    return F.to_json(F.struct(*names))


def written_keys(records: DataFrame, batch: Column) -> DataFrame:
    """(batch, bibcodes): a JSON array of each batch's records, in order. A batch is as large as the caller makes it."""
    return records.groupBy(batch.alias("batch")).agg(F.to_json(F.array_sort(F.collect_list("bibcode"))).alias("bibcodes"))


def distinct_entities(column: Column) -> Column:
    """Each once, nulls out, sorted to be the same in each run."""
    return F.array_sort(F.array_distinct(F.filter(column, lambda x: x.isNotNull())))


def audit(links: DataFrame, artefacts: DataFrame) -> DataFrame:
    """Links with the first thing that's missing: dir, meta, ft, date, or ok.

    artefacts: bibcode, has_meta, has_fulltext, index_date; a bibcode not there has no folder.
    """
    own = artefacts.select(F.col("bibcode").alias("_key"), "has_meta", "has_fulltext", F.col("index_date").alias("_date"))
    status = F.when(F.col("_key").isNull(), "missing_dir").when(~F.col("has_meta"), "missing_meta").when(~F.col("has_fulltext"), "missing_ft").when(F.col("_date").isNull(), "missing_date").otherwise("ok")
    return links.join(own, links["bibcode"] == F.col("_key"), "left").select(links["*"], status.alias("status"))


def not_extracted(links: DataFrame, artefacts: DataFrame) -> DataFrame:
    return links.join(artefacts.select("bibcode"), "bibcode", "left_anti")


def extracted(links: DataFrame, artefacts: DataFrame) -> DataFrame:
    return links.join(artefacts.select("bibcode"), "bibcode", "left_semi")


def counts(audited: DataFrame, by: str = "status") -> DataFrame:
    return audited.groupBy(by).agg(F.count("*").alias("n"))


def summary_lines(records: DataFrame) -> Column:
    """The printed form of a summary."""
    return F.concat(F.lit("%R "), F.col("bibcode"), F.lit("\n"), F.col("summary"), F.lit("\n"))
