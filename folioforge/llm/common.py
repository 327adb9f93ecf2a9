"""Helpers that the operators share: reading tables, checkpoints, partitions."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: bytes of a batch that goes to Python, about (one row is never split), and rows of a batch that a scan holds
SHORT = {"spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20), "spark.sql.parquet.columnarReaderBatchSize": "512"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage by files in the folder that the cluster names in spark.checkpoint.dir.

    Only where that is unset, as in tests on one machine, a local folder is made.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None) or os.path.join(tempfile.gettempdir(), "folioforge-checkpoints")
        context.setCheckpointDir(folder)
    with shuffles_dropped(spark):
        return df.select("*").checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The rows of df from a compressed table in the checkpoint folder, for what's large.

    The shuffle files that it took are dropped once it is written. Tables are removed when
    the application ends; a lost executor costs nothing, as they stand in the shared folder.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or os.path.join(tempfile.gettempdir(), "folioforge-checkpoints")
    path = f"{folder}/table-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.select("*").write.parquet(path)
    _tables.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables made by ``stored`` on which nothing that is still to be computed depends."""
    for t in tables:
        _delete(t.sparkSession, t._stored_at)
        _tables.remove((t.sparkSession, t._stored_at))


_tables: list[tuple[SparkSession, str]] = []


@atexit.register
def _remove_tables() -> None:
    for spark, path in _tables:
        try:
            _delete(spark, path)
        except Exception:  # the application may have ended already
            return


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def short_batches(spark: SparkSession) -> dict[str, str]:
    """Bound what a task holds of its texts at a time, in the JVM and in Python; returns the settings as they were.

    By default batches are of 10,000 rows (64 MB at most), of which a task holds several copies. The settings stay with the
    session, as frames that are returned are planned later, by whoever runs them. No row is left out or cut.
    """
    before = {k: spark.conf.get(k) for k in SHORT}
    settings(spark, SHORT)
    return before


def settings(spark: SparkSession, values: dict[str, str]) -> None:
    for k, v in values.items():
        spark.conf.set(k, v)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Queries made and run inside leave no shuffle files behind."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_bucket(column: str, modulus: int):
    """crc32 of a number written as text, modulo; a null number counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % F.lit(modulus)
