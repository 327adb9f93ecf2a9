"""Benchmark decontamination by q-gram lemma filtering.

Of an item of m characters, what lies within e edits shares at least m + 1 - q (e + 1)
q-grams with it, all on diagonals (place in text less place in item) no more than e apart. So
shared q-grams are counted in bands of 2 (e + 1) diagonals that overlap by half; a band
that reaches the bound is retained and verified by alignment within that band, widened by the edits allowed.

A q-gram that an item repeats at near places (less than e + 1 apart) is held once with its number, and counts in
both bands that it may lie in: never too little, so nothing is lost, and no run of one character brings the square of its
length. Short items, which leave no q-gram certain, are searched for as they stand.

The benchmark's q-grams are taken in blocks of at most about ``BLOCK_CHARS``
characters, each sent to the executors in turn, so what's broadcast has a fixed bound and texts never move.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .kernel import mix, pieces

Q = 8
#: edits allowed for each character of an item
RATE = 0.1
BLOCK_CHARS = 4_000_000
_BASE = 0x9E3779B97F4A7C15
_BITS = 22
#: postings that are expanded at a time, about
_POSTINGS = 1 << 19
#: no character
_NONE = np.uint32(0xFFFFFFFF)
_WHITE = re.compile(r"\s+")


def normalised(text: str | None) -> str:
    """Lower case, each run of white space one space, trimmed."""
    return _WHITE.sub(" ", text or "").strip().lower()


def budget(m: int, rate: float = RATE, q: int = Q) -> int:
    """Edits allowed for m characters: the rate, but never so many that no shared q-gram need be left."""
    return max(0, min(int(rate * m), (m - q) // q))


def _hashes(codes: np.ndarray, q: int = Q) -> np.ndarray:
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    wide = codes.astype(np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(q):
        h = h * np.uint64(_BASE) + wide[k : k + n]
    return mix(h)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Index:
    """Postings of the q-grams of the items of ``Q`` characters or more; the shorter ones follow those in ``items``."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float = RATE):
        long = [(i, t) for i, t in items if len(t) >= Q]
        self.items = long + [(i, t) for i, t in items if 0 < len(t) < Q]
        self.sizes = np.array([len(t) for _, t in long], np.int64)
        self.edits = np.array([budget(n, rate) for n in self.sizes], np.int64)
        self.bound = np.maximum(1, self.sizes + 1 - Q * (self.edits + 1))
        hs = [_hashes(_codes(t)) for _, t in long]
        h = np.concatenate(hs) if hs else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(hs)), [len(x) for x in hs]).astype(np.int64)
        at = np.concatenate([np.arange(len(x)) for x in hs]) if hs else np.zeros(0, np.int64)
        cell = at // (self.edits[item] + 1)
        order = np.lexsort((at, item, h))
        h, item, at, cell = h[order], item[order], at[order], cell[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (item[1:] != item[:-1]) | (cell[1:] != cell[:-1])
        first = np.flatnonzero(new)
        #: how often the item has the gram in this cell; if more than once, ``at`` is where the cell begins
        self.times = np.diff(np.append(first, len(h)))
        self.item = item[first]
        self.at = np.where(self.times > 1, cell[first] * (self.edits[self.item] + 1), at[first])
        self.grams, self.begin = np.unique(h[first], return_index=True)
        self.begin = np.append(self.begin, len(first))
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[(self.grams >> np.uint64(64 - _BITS)).astype(np.int64)] = True


def align(item: str, text: str, most: int, low: int | None = None, high: int | None = None) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best place of item in text with ``most`` edits or fewer; ties: the first end, then the longest.

    Only the diagonals (place in text less place in item) from low to high are looked at; by default all. A row of the
    alignment holds one cell a diagonal; gaps within a row are closed by a running minimum.
    """
    a, b = _codes(item), _codes(text)
    m, n = len(a), len(b)
    low = -m if low is None else max(low, -m)
    high = n if high is None else min(high, n)
    if low > high:
        return None
    width = high - low + 1
    ahead = max(0, -low)
    wide = np.full(ahead + m + max(high, 0) + 1, _NONE, np.uint32)  # wide[ahead + j] is text[j]
    wide[ahead : ahead + min(n, len(wide) - ahead)] = b[: len(wide) - ahead]
    step, big = np.arange(width), 1 << 60
    scale = n + 2  # cost * scale + start: of equal costs, the earliest start
    place = step + low
    now = np.where(place >= 0, place, big)
    for i, c in enumerate(a):
        text_at = wide[ahead + low + i : ahead + low + i + width] if ahead + low + i >= 0 else np.full(width, _NONE, np.uint32)
        nxt = now + scale * (text_at != c)
        np.minimum(nxt[:-1], now[1:] + scale, out=nxt[:-1])
        place = place + 1
        np.copyto(nxt, big, where=(place < 0) | (place > n))
        if low + i < 0:  # an alignment may begin by leaving out signs of the item
            at = -low - i - 1
            if 0 <= at < width:
                nxt[at] = min(nxt[at], scale * (i + 1))
        now = np.minimum.accumulate(nxt - scale * step) + scale * step
        np.copyto(now, big, where=place > n)
        if i % 32 == 31 and now.min() // scale > most:
            return None
    edits = now // scale
    best = int(edits.argmin())
    return (int(edits[best]), int(now[best] % scale), int(place[best])) if edits[best] <= most else None


def search(index: Index, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
    """(text, item, start, end, edits), the best region of each pair that has one."""
    found = _by_grams(index, texts)
    for i in range(len(index.sizes), len(index.items)):  # too short for q-grams, and for any edit
        item = index.items[i][1]
        found += [(r, i, at, at + len(item), 0) for r, t in enumerate(texts) if (at := t.find(item)) >= 0]
    return found


def _by_grams(index: Index, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
    codes = _codes("".join(texts))
    length = np.array([len(t) for t in texts], np.int64)
    offset = np.concatenate(([0], np.cumsum(length)))
    h = _hashes(codes)
    at = np.flatnonzero(index.maybe[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
    if not len(at) or not len(index.grams):
        return []
    slot = np.minimum(np.searchsorted(index.grams, h[at]), len(index.grams) - 1)
    same = index.grams[slot] == h[at]
    at, slot = at[same], slot[same]
    row = np.searchsorted(offset, at, "right") - 1
    inside = at + Q <= offset[row + 1]
    at, slot, row = at[inside], slot[inside], row[inside]
    if not len(at):
        return []
    counts = index.begin[slot + 1] - index.begin[slot]
    ends, parts, i = np.cumsum(counts), [], 0
    while i < len(at):  # about _POSTINGS of them at a time
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + _POSTINGS, "right")))
        parts.append(_bands(index, at[i:j] - offset[row[i:j]], row[i:j], slot[i:j], counts[i:j]))
        if len(parts) > 1 and sum(len(x[0]) for x in parts) > _POSTINGS:
            parts = [_summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))]
        i = j
    pair, band, n = _summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    tried: set[tuple[int, int]] = set()
    both = n.copy()  # of this band and the next
    follows = np.flatnonzero((pair[1:] == pair[:-1]) & (band[1:] == band[:-1] + 1))
    both[follows] += n[follows + 1]
    for k in np.flatnonzero(both >= index.bound[pair % len(index.sizes)]).tolist():
        r, i = divmod(int(pair[k]), len(index.sizes))
        w, m = int(index.edits[i]) + 1, int(index.sizes[i])
        if (r, i) not in tried:
            tried.add((r, i))
            exact = texts[r].find(index.items[i][1])
            if exact >= 0:
                found[r, i] = 0, exact, exact + m
        if found.get((r, i), (1,))[0] == 0:
            continue  # nothing is better than the first exact place
        least = int(band[k]) * w - w  # the first diagonal of the widened band; the last is 4 w further
        low, high = max(0, least), min(int(length[r]), least + 4 * w + m)
        got = align(index.items[i][1], texts[r][low:high], w - 1, least - low, least + 4 * w - low)
        if got:
            best = (got[0], low + got[1], low + got[2])
            found[r, i] = min(found.get((r, i), best), best)
    return [(r, i, s, e, d) for (r, i), (d, s, e) in found.items()]


def _bands(index: Index, at: np.ndarray, row: np.ndarray, slot: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair of text and item, band, shared q-grams) of some q-grams at their places in their texts."""
    post = np.repeat(index.begin[slot] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    item, times = index.item[post], index.times[post]
    width = index.edits[item] + 1
    # from band * width, over 2 * width diagonals, with the band before
    band = (np.repeat(at, counts) - index.at[post]) // width
    pair = np.repeat(row, counts) * len(index.sizes) + item
    many = np.flatnonzero(times > 1)
    return _summed(np.concatenate([pair, pair[many]]), np.concatenate([band, band[many] - 1]), np.concatenate([times, times[many]]))


def _summed(pair: np.ndarray, band: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((band, pair))
    pair, band, n = pair[order], band[order], n[order]
    new = np.ones(len(pair), bool)
    new[1:] = (pair[1:] != pair[:-1]) | (band[1:] != band[:-1])
    first = np.flatnonzero(new)
    return pair[first], band[first], np.add.reduceat(n, first) if len(first) else n


def _scan(index, id_kind: pa.DataType):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix: Index = index.value
        for batch in batches:
            out = []
            for i, j in pieces(batch.column(1)):
                texts = [normalised(t) for t in batch.column(1).slice(i, j - i).to_pylist()]
                out += [(i + r, ix.items[k][0], s, e, d) for r, k, s, e, d in search(ix, texts)]
            cols = list(zip(*out, strict=True)) or [[]] * 5
            ids = batch.column(0).take(pa.array(cols[0], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.int64()) for c in cols[1:])], ["doc_id", "item_id", "start", "end", "edits"])

    return run


def _without(index):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix: Index = index.value
        for batch in batches:
            held = np.zeros(batch.num_rows, bool)
            for i, j in pieces(batch.column(1)):
                texts = [normalised(t) for t in batch.column(1).slice(i, j - i).to_pylist()]
                held[[i + r for r, *_ in search(ix, texts)]] = True
            yield batch.filter(pa.array(~held))

    return run


def _indexes(benchmark: DataFrame, rate: float, block_chars: int) -> list:
    """A function for each block of the benchmark that broadcasts its index."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(F.length("text") > 0)
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-int(total) // block_chars))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))

    def sent(b: int):
        part = sorted({(r[0], normalised(r[1])) for r in items.where(block == b).collect()}, key=lambda x: (x[0] is None, x))
        return spark.sparkContext.broadcast(Index(part, rate))

    return [lambda b=b: sent(b) for b in range(blocks)]


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, start, end, edits): documents that hold a benchmark item within its edit budget.

    The best region of each pair, in characters of the normalised text (see ``normalised``); ties: the earliest.
    An item's budget is ``rate`` times its length, or as many as leave one shared
    q-gram certain; items under ``Q`` characters have none and are searched for as they stand, inside words too. Null or
    empty texts and items match nothing; repeated rows give repeated rows; null ids are kept;
    other columns are ignored; empty tables give an empty result.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, start long, end long, edits long"
    return reduce(DataFrame.unionByName, [own.mapInArrow(_scan(sent(), pa.int64()), schema) for sent in _indexes(benchmark, rate, block_chars)])


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents without those that hold a benchmark item; columns stay.

    Each row is judged by its own text, whatever other rows have its doc_id.
    """
    left = docs.select(F.struct(*docs.columns).alias("d"), F.col("text").cast("string").alias("t"))
    for b, sent in enumerate(_indexes(benchmark, rate, block_chars)):
        # a table between blocks, so that a task holds one index at a time
        left = (stored(left) if b else left).mapInArrow(_without(sent()), left.schema)
    return left.select("d.*")
