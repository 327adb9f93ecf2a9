"""Link lists: which records there are, and where their files lie."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.decide import force
from ..schema import LINKS


def _fields(value: str, separator: str) -> Column:
    """Fields that aren't empty, of a line without the white space around it."""
    return F.filter(F.split(F.regexp_replace(F.col(value), r"^\s+|\s+$", ""), separator), lambda x: x != "")


def parse(lines: DataFrame, value: str = "value", separator: str = "\t") -> DataFrame:
    """(bibcode, ft_source, provider) of lines; empty fields are dropped, lines with fewer than three left out."""
    fields = _fields(value, separator)
    return lines.withColumn("_f", fields).where(F.size("_f") >= 3).select(*[c for c in lines.columns if c != value], *[F.col("_f")[i].alias(n) for i, n in enumerate(("bibcode", "ft_source", "provider"))])


def skipped(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines that aren't blank and still too short: to be reported."""
    n = F.size(_fields(value, "\t"))
    return lines.where((n > 0) & (n < 3))


def read(spark: SparkSession, path: str, extract: bool = False, send: bool = False) -> DataFrame:
    return force(parse(spark.read.text(path)), extract, send)


def read_words(lines: DataFrame) -> DataFrame:
    """Records of scripts: three fields between any white space."""
    return parse(lines, separator=r"\s+")


def first_records(links: DataFrame, n: int, order: str | Column) -> DataFrame:
    """The first n in the given order; 0: all."""
    return links.orderBy(order).limit(n) if n else links


def diagnostics(spark: SparkSession, bibcodes: Sequence[str], files: Sequence[str], providers: Sequence[str]) -> DataFrame:
    """Records named on the command line."""
    return spark.createDataFrame(list(zip(bibcodes, files, providers, strict=False)), LINKS)
