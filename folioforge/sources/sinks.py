"""Writing results: tables first, single files per record where a consumer wants them."""

from __future__ import annotations

import gzip
import json
import os
import tempfile
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import pair_path
from ..operators.assemble import message, meta_json

MODE = 0o640


def write_tables(records: DataFrame, folder: str, mode: str = "append") -> None:
    """Texts (not empty), acknowledgements (even empty), metadata and PDF-service texts as tables under folder.

    Runs append; of several rows for a record the latest index_date counts (see ``files.latest``).
    """
    grobid = F.col("file_format") == "pdf-grobid"
    records.where(~grobid & (F.coalesce("fulltext", F.lit("")) != "")).select("bibcode", "index_date", "fulltext").write.mode(mode).parquet(f"{folder}/fulltext")
    records.where(~grobid & F.col("acknowledgements").isNotNull()).select("bibcode", "index_date", "acknowledgements").write.mode(mode).parquet(f"{folder}/acknowledgements")
    records.where(~grobid).select("bibcode", "index_date", meta_json().alias("value")).write.mode(mode).parquet(f"{folder}/meta")
    records.where(grobid).select("bibcode", "index_date", F.col("fulltext").alias("grobid_fulltext")).write.mode(mode).parquet(f"{folder}/grobid_fulltext")


def unsent(records: DataFrame, artefacts: DataFrame) -> DataFrame:
    """Records that still have to be written: not those only to be sent whose artefacts exist."""
    there = artefacts.where("has_meta and has_fulltext").select(F.col("bibcode").alias("_key"))
    done = (F.col("bibcode") == F.col("_key")) & (F.col("update_reason") == "FORCE_TO_SEND")
    return records.join(there, done, "left_anti")


def replace_file(path: str, content: bytes, packed: bool = False) -> None:
    """The whole file or none: a temporary one beside it is put in its place."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    handle, temporary = tempfile.mkstemp(dir=os.path.dirname(path))
    try:
        with os.fdopen(handle, "wb") as f:
            f.write(gzip.compress(content, mtime=0) if packed else content)
        os.chmod(temporary, MODE)
        os.replace(temporary, path)
    except BaseException:
        os.unlink(temporary)
        raise


def write_files(records: DataFrame, root: str) -> None:
    """fulltext.txt.gz, acknowledgements.txt.gz and meta.json (last) in each record's folder on a mounted file system."""
    rows = records.select(pair_path(F.col("bibcode")).alias("at"), "file_format", "fulltext", "acknowledgements", meta_json().alias("meta"))

    def write(part: Iterable) -> None:
        for r in part:
            folder = root.rstrip("/") + r["at"]
            if r["file_format"] == "pdf-grobid":
                replace_file(f"{folder}grobid_fulltext.xml", (r["fulltext"] or "").encode(), packed=True)
                continue
            if r["fulltext"]:
                replace_file(f"{folder}fulltext.txt.gz", r["fulltext"].encode(), packed=True)
            if r["acknowledgements"] is not None:
                replace_file(f"{folder}acknowledgements.txt.gz", r["acknowledgements"].encode(), packed=True)
            replace_file(f"{folder}meta.json", r["meta"].encode())

    rows.foreachPartition(write)


def read_file(path: str, as_json: bool = False):
    """A stored artefact, unpacked whether or not its name says so."""
    with open(path, "rb") as f:
        content = f.read()
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    return json.loads(content) if as_json else content.decode()


def send(records: DataFrame, path: str, mode: str = "append") -> None:
    """Messages for what comes downstream."""
    message(records).write.mode(mode).parquet(path)
