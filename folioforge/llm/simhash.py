"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut in three segments. Two fingerprints at most four bits apart differ
by at most one bit in segment A, or by at most one in B, or not at all in C (else they
would differ by 2 + 2 + 1 bits). So each fingerprint stands in three tables, probes A and
B with its small Hamming ball, and full distances are verified for what it meets. Of a
pair that differs by one bit in a segment, exactly one side has that bit at 0, so only
flips from 0 to 1 are enumerated: about 23 rows a fingerprint.

Only distinct fingerprints are compared, so groups of copies cost one row. A bucket of a
table over ``CHUNK`` fingerprints is dealt to several chunks, each its own group; what
probes it goes to every chunk. A group returns a spanning forest of the links it has
verified, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed
from .graph import components
from .kernel import signed, text_offsets

SEED = 42
CHUNK = 2048
#: (lowest bit, bits, radius)
SEGMENTS = ((0, 20, 1), (20, 20, 1), (40, 24, 0))
_A_TO_Z = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes, k: int = 4) -> int:
    """SimHash of the k-word shingles (repeats included) of lower-cased text; no words: 0."""
    words = text.translate(_A_TO_Z).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - k + 1)
    ends = ends[len(words) - n :]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, 1 << 16):
        part = zip(starts[i : min(n, i + (1 << 16))].tolist(), ends[i : i + (1 << 16)].tolist(), strict=True)
        h = np.array([digest(joined[s:e], SEED) for s, e in part], "<u8")
        ones += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(1)
        off, data = text_offsets(column)
        raw = memoryview(data) if data is not None else memoryview(b"")
        fp = np.array([fingerprint(bytes(raw[s:e])) for s, e in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed(fp))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp long) for each row; a null or blank text has fingerprint 0."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_fingerprints, "doc_id long, fp long")


def _index_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for i in range(0, len(fps), 4096):
            fp = fps[i : i + 4096]
            for kind, keys in ((False, []), (True, [])):
                out = []
                for s, (low, bits, radius) in enumerate(SEGMENTS):
                    seg = (fp >> np.uint64(low)) & np.uint64((1 << bits) - 1)
                    tag = np.uint64(s << 32)
                    if not kind:
                        out.append((seg | tag, fp))
                    elif radius:
                        for b in range(bits):
                            zero = (seg >> np.uint64(b)) & np.uint64(1) == 0
                            out.append((seg[zero] | np.uint64(1 << b) | tag, fp[zero]))
                key = np.concatenate([x[0] for x in out])
                val = np.concatenate([x[1] for x in out])
                yield pa.RecordBatch.from_arrays([pa.array(signed(key)), pa.array(signed(val)), pa.array(np.full(len(key), kind))], ["key", "fp", "probe"])


class _Forest:
    """Union-find by position."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def spanning(table: np.ndarray, others: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of all pairs table x (table + others) at most ``most`` bits apart."""
    both = np.concatenate([table, others])
    forest, links = _Forest(len(both)), []
    for i in range(0, len(both), 512):
        close = np.bitwise_count(both[i : i + 512, None] ^ table[None, :]) <= most
        for x, y in np.argwhere(close).tolist():
            if forest.join(i + x, y):
                links.append((i + x, y))
    return links


def _verify(most: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple = (None, None, np.zeros(0, np.uint64))  # of the last group: key, chunk, table
        for batch in batches:
            if not batch.num_rows:
                continue
            key, chunk, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            probe = batch.column(3).to_numpy(zero_copy_only=False).astype(bool)
            fp = fp.view(np.uint64)
            if (key[0], chunk[0]) == held[:2]:
                n = len(held[2])
                key, chunk = (np.concatenate([np.full(n, x[0], x.dtype), x]) for x in (key, chunk))
                fp, probe = np.concatenate([held[2], fp]), np.concatenate([np.zeros(n, bool), probe])
            new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (chunk[1:] != chunk[:-1]))))
            size = np.diff(np.append(new, len(key)))
            tables = np.add.reduceat((~probe).astype(np.int64), new)
            a, b = [], []
            small = tables <= 32
            rows_small = np.repeat(small, size)
            at = np.flatnonzero(rows_small)
            begin = np.repeat(new, size)[at]
            partners = np.minimum(np.repeat(tables, size)[at], at - begin)
            x = np.repeat(at, partners)
            y = np.repeat(begin, partners) + (np.arange(len(x)) - np.repeat(np.cumsum(partners) - partners, partners))
            close = np.bitwise_count(fp[x] ^ fp[y]) <= most
            a.append(fp[x[close]])
            b.append(fp[y[close]])
            for g in np.flatnonzero(~small):
                s, t, e = new[g], new[g] + tables[g], new[g] + size[g]
                links = spanning(fp[s:t], fp[t:e], most)
                own = fp[s:e]
                a.append(own[[i for i, _ in links]])
                b.append(own[[j for _, j in links]])
            g = len(new) - 1
            held = (key[-1], chunk[-1], fp[new[g] : new[g] + tables[g]])
            yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(a))), pa.array(signed(np.concatenate(b)))], ["a", "b"])

    return run


def links(fps: DataFrame, most: int = 4, chunk: int = CHUNK) -> DataFrame:
    """(a, b): links between distinct fingerprints that join all of those ``most`` bits apart or less.

    Not all pairs: of each group it meets, a spanning forest.
    """
    if not 0 <= most <= 4:
        raise ValueError("the segments are exact for 0 to 4 differing bits")
    rows = fps.select("fp").mapInArrow(_index_rows, "key long, fp long, probe boolean")
    large = checkpointed(rows.where("not probe").groupBy("key").agg(F.count("*").alias("held")).where(F.col("held") > chunk))
    n = large.count()
    if n:
        # at most 3/CHUNK of the fingerprints' number; broadcast only where that's few
        rows = rows.join(F.broadcast(large) if n <= 10_000 else large, "key", "left").withColumn("chunks", F.ceil(F.coalesce("held", F.lit(1)) / chunk).cast("int"))
        own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
        dealt = rows.select("key", "fp", "probe", "chunks", every.alias("chunk")).withColumn("probe", F.col("probe") | (F.col("chunk") != own))
    else:
        dealt = rows.withColumn("chunk", F.lit(0))
    dealt = dealt.select("key", "chunk", "fp", "probe").repartition("key", "chunk").sortWithinPartitions("key", "chunk", "probe")
    return dealt.mapInArrow(_verify(most), "a long, b long").where("a <> b")


def near_duplicates(docs: DataFrame, most: int = 4) -> DataFrame:
    """(doc_id, fp, component_id): the least doc_id reachable over links of at most ``most`` bits.

    Every row of the input gives a row, repeated rows too. Null and blank texts have
    fingerprint 0 and are linked like any other. A null doc_id is never a component_id
    unless nothing else is reachable. No documents: an empty result. Other columns of the
    input are ignored.
    """
    marked = checkpointed(fingerprints(docs))
    fps = checkpointed(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    grown = components(links(fps, most), "a", "b")
    named = fps.join(grown.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    # few rows may hold most documents' fingerprint: these joins leave the splitting of hot keys to AQE
    by_fp = named.select("fp", "component").join(least, "component").select("fp", "component_id")
    return marked.join(by_fp, "fp").select("doc_id", "fp", "component_id")
