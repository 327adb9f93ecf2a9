"""Exact substring dedup with fixed-block anchors.

Each text is cut in non-overlapping reference blocks of ``BLOCK`` = 7 words; whatever
13 words stand in a text, they hold one of its blocks whole. Blocks are indexed by hash
with the least doc_id that has them, and probed with every rolling window of 7 words of
all texts. Only texts with hits go on: a hit is extended to the 13-word windows around it,
those are compared by 128-bit hashes, and touching windows make up maximal exact
repeats. A text whole that a smaller doc_id has too is one repeat; such copies are told by
their digests, so that groups of them bring no windows of their own.

Each text is read once for the index, once for the probes, once for the windows around hits and once to be cut; the index
and the windows are stored between. Probes are (hash, doc_id) pairs, one for each distinct window of a
text, which meet the index in shares of at most about ``SHARE`` of its rows, held as hash tables, so that probes are never
sorted. The ``HOT_BLOCKS`` blocks that most texts hold are sent to the probing tasks; their hits are spread
by doc_id and meet nothing. The joins on digests and windows have plain exchanges on both sides, and AQE
splits what is hot there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, partitions, stored
from .kernel import Words, mix, pieces, signed

WINDOW = 13
BLOCK = (WINDOW + 1) // 2
#: blocks broadcast at most, and the texts that must hold one
HOT_BLOCKS = 20_000
HOT_TEXTS = 1_000
#: rows of the index that a task holds, about
SHARE = 500_000
#: stands for a null doc_id, which counts as larger than any other
LAST = (1 << 63) - 1


def _unique(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], row[new]


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, d): the blocks of each text."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for i, j in pieces(batch.column(1)):
            words, at, h, row = _runs(batch.column(1).slice(i, j - i))
            keep = (at - words.first[row]) % BLOCK == 0
            h, row = _unique(h[keep], row[keep])
            yield pa.RecordBatch.from_arrays([pa.array(signed(h)), pa.array(ids[i:j][row])], ["h", "d"])


def _probes(state):
    """(k, d): all runs of a block's length of each text, k their hash.

    For those of ``hot`` blocks k is negative, spread over the texts, and -1 - k modulo HOT_BLOCKS is the block's place;
    they are given only where a smaller doc_id has the block.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, least = state.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j in pieces(batch.column(1)):
                _, _, h, row = _runs(batch.column(1).slice(i, j - i))
                h, row = _unique(h, row)
                k, d = signed(h), ids[i:j][row]
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, k), len(hot) - 1)
                    common = hot[at] == k
                    keep = ~common | (least[at] < d)
                    spread = (mix(d.astype(np.uint64)) >> np.uint64(24)).astype(np.int64)
                    k = np.where(common, -1 - (at + HOT_BLOCKS * spread), k)[keep]
                    d = d[keep]
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(d)], ["k", "d"])

    return run


def _runs(column: pa.Array) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words, and the place, hash and row of each run of a block's length in the texts of a window or more.

    Of the hash 48 bits: a chance hit costs a closer look, and the rows are smaller.
    """
    words = Words(column)
    at, h = words.grams(BLOCK)
    row = words.rows[at]
    keep = (words.first[1:] - words.first[:-1])[row] >= WINDOW
    return words, at[keep], h[keep] >> np.uint64(16), row[keep]


def _candidates(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows that hold a flagged run of words, as (h0, h1, d)."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        flags = batch.column(2)
        for i, j in pieces(batch.column(1)):
            words = Words(batch.column(1).slice(i, j - i))
            at, h = words.grams(BLOCK)
            own = flags.slice(i, j - i)
            counts = np.diff(own.offsets.to_numpy())
            wanted_row = np.repeat(np.arange(j - i), counts)
            wanted = own.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            hit = _member(h >> np.uint64(16), words.rows[at], wanted, wanted_row)
            near = np.zeros(len(words.starts) + 1, np.int64)
            near[at[hit]] = 1
            total = np.concatenate(([0], np.cumsum(near)))
            at, h0 = words.grams(WINDOW, 0)
            _, h1 = words.grams(WINDOW, 1)
            keep = total[at + WINDOW - BLOCK + 1] > total[at]
            at, h0, h1 = at[keep], h0[keep], h1[keep]
            row = words.rows[at]
            order = np.lexsort((h1, h0, row))
            h0, h1, row = h0[order], h1[order], row[order]
            new = np.ones(len(row), bool)
            new[1:] = (h0[1:] != h0[:-1]) | (h1[1:] != h1[:-1]) | (row[1:] != row[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(signed(h0[new])), pa.array(signed(h1[new])), pa.array(ids[i:j][row[new]])], ["h0", "h1", "d"])


def _member(h: np.ndarray, row: np.ndarray, wanted: np.ndarray, wanted_row: np.ndarray) -> np.ndarray:
    """Whether (h, row) is among (wanted, wanted_row)."""
    if not len(wanted) or not len(h):
        return np.zeros(len(h), bool)
    salt = np.uint64(0x9E3779B97F4A7C15)
    key = h ^ (row.astype(np.uint64) * salt)
    among = np.sort(wanted ^ (wanted_row.astype(np.uint64) * salt))
    at = np.minimum(np.searchsorted(among, key), len(among) - 1)
    return among[at] == key


def _cut(text: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in pieces(batch.column(1)):
                yield _cut_piece(batch.slice(i, j - i), text)

    return run


def _cut_piece(batch: pa.RecordBatch, text: bool) -> pa.RecordBatch:
    words = Words(batch.column(1))
    at, h0 = words.grams(WINDOW, 0)
    _, h1 = words.grams(WINDOW, 1)
    marks = batch.column(2)
    wanted_row = np.repeat(np.arange(batch.num_rows), np.diff(marks.offsets.to_numpy()))
    pairs = marks.flatten()
    w0, w1 = (pairs.field(k).to_numpy(zero_copy_only=False).view(np.uint64) for k in range(2))
    hit = at[_member(h0 ^ (h1 << np.uint64(1)), words.rows[at], w0 ^ (w1 << np.uint64(1)), wanted_row)]
    change = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(change, hit, 1)
    np.add.at(change, hit + WINDOW, -1)
    sizes = np.diff(words.first)
    whole = batch.column(3).to_numpy(zero_copy_only=False).astype(bool) & (sizes >= WINDOW)
    gone = (np.cumsum(change[:-1]) > 0) | whole[words.rows]
    raw = words.raw.tobytes()
    digests, kept, spans, n_removed = [], [], [], []
    for r in range(batch.num_rows):
        a, b = words.first[r], words.first[r + 1]
        lost = gone[a:b]
        n_removed.append(int(lost.sum()))
        stay = np.flatnonzero(~lost) + a
        left = b" ".join([raw[s:e] for s, e in zip(words.starts[stay].tolist(), words.ends[stay].tolist(), strict=True)])
        digests.append(hashlib.sha256(left).hexdigest())
        if text:
            untouched = len(stay) == b - a
            kept.append((raw[words.offsets[r] : words.offsets[r + 1]] if untouched else left).decode())
            edges = np.flatnonzero(np.diff(np.concatenate(([0], lost.astype(np.int8), [0]))))
            spans.append([{"start": int(s), "end": int(e)} for s, e in zip(edges[::2], edges[1::2], strict=True)])
    out = [batch.column(0), pa.array(sizes), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())]
    names = [batch.schema.names[0], "n_words", "n_removed", "kept_sha256"]
    if text:
        out += [pa.array(kept, pa.string()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
        names += ["kept_text", "spans"]
    return pa.RecordBatch.from_arrays(out, names)


def repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """Words of each text without those in a 13-word window that starts in a smaller doc_id too.

    Returns doc_id, n_words, n_removed, kept_sha256 and, with_text, kept_text and
    ``spans`` (word ranges removed, end exclusive: the maximal exact repeats). Each row
    of the input gives one, repeated rows too; a null text has no words; a null doc_id
    counts as the largest; rows with one doc_id aren't held against each other. Windows are
    judged on the input. Other columns are ignored; an empty table gives an empty result.
    """
    return _judged(docs, F.col("doc_id").cast("long").alias("doc_id"), with_text)


def cut_documents(docs: DataFrame) -> DataFrame:
    """The documents with the words that ``repeats`` removes cut from text; kept words are joined by one space.

    A text that loses nothing stays as it is, to the byte. All columns and rows stay, with an n_removed added last.
    """
    rest = [c for c in docs.columns if c not in ("text", "n_removed")]
    cut = _judged(docs, F.struct(F.struct(*rest).alias("own"), F.col("text").isNull().alias("none")).alias("row"), True)
    text = F.when(F.col("row.none"), F.lit(None)).otherwise(F.col("kept_text")).alias("text")
    return cut.select(*[text if c == "text" else F.col("row.own").getField(c).alias(c) for c in docs.columns if c != "n_removed"], "n_removed")


def _judged(docs: DataFrame, carried, with_text: bool) -> DataFrame:
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("d")
    texts = docs.select(own, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), carried)
    name = texts.columns[2]
    plain = texts.select("d", "text")
    digest = texts.select("d", F.unhex(F.md5("text")).alias("digest"))
    same = stored(digest.groupBy("digest").agg(F.min("d").alias("least"), F.max("d").alias("most")).where("most > least").select("digest", "least"))
    later = digest.join(same, "digest").groupBy("d").agg(F.min(F.col("d") > F.col("least")).alias("copied"), F.count("*").alias("n"))
    # of several rows under one doc_id, all must be copies
    copies = stored(later.where("copied").join(texts.groupBy("d").agg(F.count("*").alias("of")), "d").where("n = of").select("d"))
    blocks = stored(plain.mapInArrow(_blocks, "h long, d long").groupBy("h").agg(F.min("d").alias("least"), F.count("*").alias("n")))
    # by way of a table, as a collected limit would send the driver HOT_BLOCKS rows of each partition
    most = stored(blocks.where(F.col("n") >= HOT_TEXTS).orderBy(F.desc("n"), "h").limit(HOT_BLOCKS).select("h", "least"))
    hot = sorted(most.collect())
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((np.array([r[0] for r in hot], np.int64), np.array([r[1] for r in hot], np.int64)))
    shares = max(partitions(spark), -(-blocks.count() // SHARE))
    index = blocks.select(F.col("h").alias("k"), "least").repartition(shares, "k").hint("shuffle_hash")
    met = plain.mapInArrow(_probes(sent), "k long, d long").repartition(shares, "k").join(index, "k", "left").where("k < 0 or d > least")
    named = spark.createDataFrame([(i, r[0], r[1]) for i, r in enumerate(hot)], "i long, hot long, hot_least long")
    place = F.when(F.col("k") < 0, F.pmod(-1 - F.col("k"), F.lit(HOT_BLOCKS).cast("long")))
    met = met.withColumn("i", place).join(F.broadcast(named), "i", "left")
    hits = met.select(F.coalesce("hot", "k").alias("h"), "d", F.coalesce("hot_least", "least").alias("least")).join(copies, "d", "left_anti")
    # a text with a hit, and the first text that holds the block, are both looked at closer
    flagged = stored(hits.select("h", F.explode(F.array("d", "least")).alias("d")).groupBy("d").agg(F.collect_set("h").alias("flags")))
    discard(same, blocks, most)
    near = stored(plain.join(flagged, "d").select("d", "text", "flags").mapInArrow(_candidates, "h0 long, h1 long, d long"))
    least = near.groupBy("h0", "h1").agg(F.min("d").alias("least"), F.max("d").alias("most")).where("most > least").select("h0", "h1", "least")
    marks = stored(near.join(least, ["h0", "h1"]).where("d > least").groupBy("d").agg(F.collect_set(F.struct("h0", "h1")).alias("marks")))
    discard(flagged, near)
    none = F.array().cast("array<struct<h0:long,h1:long>>")
    gone = marks.select("d", "marks", F.lit(False).alias("whole")).unionByName(copies.select("d", none.alias("marks"), F.lit(True).alias("whole")))
    marked = texts.join(gone, "d", "left").select(name, "text", F.coalesce("marks", none).alias("marks"), F.coalesce("whole", F.lit(False)).alias("whole"))
    schema = f"{name} {texts.schema[name].dataType.simpleString()}, n_words long, n_removed long, kept_sha256 string"
    if with_text:
        schema += ", kept_text string, spans array<struct<start:long,end:long>>"
    return marked.mapInArrow(_cut(with_text), schema)
