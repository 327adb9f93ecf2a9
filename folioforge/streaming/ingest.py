"""Continuous ingest: links or texts arrive as files, results are appended. No state is kept, so there is no watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.extract import extract_text
from ..sources.links import parse


def stream_links(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Records of link files as they arrive."""
    return parse(spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder))


def stream_table(spark: SparkSession, folder: str, schema, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def run(stream: DataFrame, process: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Process each batch and append it to a table; ``once``: what is there now, then stop.

    A batch that is run again after a failure replaces its own folder, so results stay whole and single.
    """

    def write(batch: DataFrame, number: int) -> None:
        process(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="10 seconds")).start()


def stream_text(stream: DataFrame, text: str = "text") -> DataFrame:
    """Plain-text extraction on a stream: no shuffle, no state."""
    return extract_text(stream, text)
