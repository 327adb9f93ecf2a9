"""Texts whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more, joined to groups.

If two sets of n and m shingles are that similar, they share 4/9 of n + m at least, so in any one order of all
shingles the first n - ceil(4n/5) + 1 of the one and of the other have a shingle in common, and from the first
common one on either has 4/9 of n + m left. Those prefixes are grouped by shingle; a pair that meets with so much left is a
candidate, and the whole sets are compared. The order only decides how many candidates there are: shingles found often in a
sample come last, the others go by hash.

Large groups of near copies don't bring all their pairs. At first each text meets only the ``LEADS`` leaders of its shingle's
group (those least by a hash of their keys, so mostly the same in all groups of a cluster). What those links join is labelled.
Of the rest only texts that may be like one of another label go on, each with the parity bits of its set. Of the pairs in
a group that pass by their bits, a spanning forest of the labels is compared, the most alike first, so no more pairs than
rows; what it joins is labelled anew. Then all pairs of differing labels that pass and weren't compared are candidates: what is
left unlinked is unlike, or joined by others. A shingle with over ``HOT`` texts has one leader, found by aggregation; of its texts
those outside of its most frequent label are sent to each of its shares, so no task gets more than HOT of the others.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import graph
from .common import checkpointed, discard, stored
from .kernel import Words, pieces, ranges_hash, signed
from .simhash import _Forest

K = 5
SAMPLE = 20_000
FREQUENT = 1 << 15
#: candidates' keys up to this number are broadcast
KEYS = 500_000
#: texts that share a shingle, for which it is hot
HOT = 1 << 13
LEADS = 3
#: hot shingles (or buckets of shingles) up to this number are broadcast
FEW = 10_000
#: bits that name a bucket of shingles, at least
BUCKETS = 16
_BASE = 0xD6E8FEB86659FD93
_PAIRS = 1 << 20
#: words of 64 parity bits for each set
WORDS = 32


def shingle_sets(column: pa.Array, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, rows, hashes): distinct shingles of each row in the common order; row i's are those from first[i] to first[i + 1].

    A text of fewer words than K is one shingle; one without words has none.
    """
    words = Words(column, lower=True)
    at, h = words.grams(K)
    rows = words.rows[at]
    size = np.diff(words.first)
    short = np.flatnonzero((size > 0) & (size < K))
    whole = ranges_hash(words.hashes(), words.first[short], words.first[short + 1], _BASE)
    rows, h = np.concatenate([rows, short]), np.concatenate([h, whole])
    rank = np.zeros(len(h), np.int64)
    if len(frequent):
        place = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
        rank = (frequent[place] == h).astype(np.int64)
    order = np.lexsort((h, rank, rows))
    rows, h = rows[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (h[1:] != h[:-1])
    rows, h = rows[new], h[new]
    return np.searchsorted(rows, np.arange(len(column) + 1)), rows, h


def _sample(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j in pieces(batch.column(1)):
            yield pa.RecordBatch.from_arrays([pa.array(signed(shingle_sets(batch.column(1).slice(i, j - i), np.zeros(0, np.uint64))[2]))], ["h"])


def _prefixes(state):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, seen = state.value, set()
        for batch in batches:
            for i, j in pieces(batch.column(1)):
                keys = batch.column(0).slice(i, j - i).to_numpy()
                fresh = np.zeros(j - i, bool)
                for r, k in enumerate(keys.tolist()):
                    if k not in seen:
                        fresh[r] = True
                        seen.add(k)
                if len(seen) > 100_000:
                    seen.clear()
                first, rows, h = shingle_sets(batch.column(1).slice(i, j - i), frequent)
                n = np.diff(first)
                pos = np.arange(len(h)) - first[rows]
                take = (pos < (n - (4 * n + 4) // 5 + 1)[rows]) & fresh[rows]
                rows = rows[take]
                yield pa.RecordBatch.from_arrays([pa.array(signed(h[take])), pa.array(n[rows].astype(np.int32)), pa.array(pos[take].astype(np.int32)), pa.array(keys[rows])], ["h", "n", "pos", "key"])

    return run


def _may(n: np.ndarray, left: np.ndarray, m: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether sets of n and m shingles can be 0.8 similar with no more in common than what each has left."""
    return 9 * np.minimum(left, other) >= 4 * (n + m)


def _whole(batches: Iterable[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of sorted rows, with all rows of a group (by the first column) together."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            now = [np.concatenate(x) for x in zip(held, now, strict=True)]
        at = int(np.flatnonzero(now[0] != now[0][-1])[-1]) + 1 if now[0][0] != now[0][-1] else 0
        held = [x[at:] for x in now]
        if at:
            yield [x[:at] for x in now]
    if held is not None:
        yield held


def _led(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (by h, then leaders first) of groups of two keys or more, each with the leaders that it may be like."""
    for h, n, pos, key, _ in _whole(batches):
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (key[1:] != key[:-1])
        h, n, pos, key = h[new], n[new].astype(np.int64), pos[new].astype(np.int64), key[new]
        edge = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        size = np.diff(np.append(edge, len(h)))
        keep = np.repeat(size > 1, size)
        begin = np.repeat(edge, size)
        leads = []
        for j in range(LEADS):
            at = np.minimum(begin + j, len(h) - 1)
            fits = (np.arange(len(h)) > begin + j) & (h[at] == h) & _may(n, n - pos, n[at], n[at] - pos[at])
            leads.append(pa.array(key[at][keep], mask=~fits[keep]))
        cols = [pa.array(h[keep]), pa.array(n[keep].astype(np.int32)), pa.array(pos[keep].astype(np.int32)), pa.array(key[keep]), *leads]
        yield pa.RecordBatch.from_arrays(cols, ["h", "n", "pos", "key", *(f"l{j}" for j in range(LEADS))])


def _pairs(cols: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(x, y, part, flips) by shares: rows of one group whose labels differ and that may be alike.

    part numbers the runs of group and label. Where rows have parity bits, pairs that differ in too many are left out.
    """
    g, label, n, pos, key = cols[:5]
    bits = np.frombuffer(b"".join(cols[5]), np.uint64).reshape(len(g), -1) if len(cols) > 5 else np.zeros((len(g), 0), np.uint64)
    n = n.astype(np.int64)
    left = n - pos
    new = np.concatenate(([True], g[1:] != g[:-1]))
    turn = new | np.concatenate(([True], label[1:] != label[:-1]))
    edge, first = np.flatnonzero(new), np.flatnonzero(turn)
    part = np.cumsum(turn) - 1
    end = np.repeat(np.append(edge[1:], len(g)), np.diff(np.append(edge, len(g))))
    own = np.repeat(np.append(first[1:], len(g)), np.diff(np.append(first, len(g))))
    count = end - own  # partners come after a row's own label
    some = np.flatnonzero(count)
    cuts = np.searchsorted(np.cumsum(count[some]), np.arange(_PAIRS, count.sum() + _PAIRS, _PAIRS), "right") if len(some) else []
    at = 0
    for cut in [*cuts, len(some)]:
        rows = some[at : max(cut, at + 1)]
        at = max(cut, at + 1)
        if not len(rows):
            continue
        many = count[rows]
        x = np.repeat(rows, many)
        y = np.arange(len(x)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(own[rows], many)
        fits = _may(n[x], left[x], n[y], left[y]) & (key[x] != key[y])
        x, y = x[fits], y[fits]
        flips = np.zeros(len(x), np.int64)
        for w in range(bits.shape[1]):
            flips += np.bitwise_count(bits[x, w] ^ bits[y, w])
        alike = 9 * flips <= n[x] + n[y]
        yield x[alike], y[alike], part, flips[alike]


def _ordered(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])


def _across(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of keys of a group (rows by group and label) whose labels differ and that may be alike."""
    for cols in _whole(batches):
        for x, y, _, _ in _pairs(cols):
            yield _ordered(cols[4][x], cols[4][y])


def _forest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the pairs that ``_across`` gives, those that join the labels of a group: fewer than it has labels, the most alike first."""
    for cols in _whole(batches):
        n, key = cols[2].astype(np.int64), cols[4]
        up = None
        for x, y, part, flips in _pairs(cols):
            up = up or _Forest(int(part[-1]) + 1)
            unlike = flips / (n[x] + n[y])
            order = np.lexsort((unlike, part[y], part[x]))
            p, q = part[x[order]], part[y[order]]
            best = order[np.concatenate(([True], (p[1:] != p[:-1]) | (q[1:] != q[:-1])))] if len(order) else order
            best = best[np.argsort(unlike[best], kind="stable")]
            taken = [i for i, p, q in zip(best.tolist(), part[x[best]].tolist(), part[y[best]].tolist(), strict=True) if up.join(p, q)]
            yield _ordered(key[x[taken]], key[y[taken]])


def _open(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (by group and label) that may be like a row of their group that has another label."""
    for cols in _whole(batches):
        open_ = np.zeros(len(cols[0]), bool)
        for x, y, _, _ in _pairs(cols):
            open_[x] = open_[y] = True
        yield pa.RecordBatch.from_arrays([pa.array(c[open_]) for c in cols], ["g", "label", "n", "pos", "key"])


def _parity(rows: np.ndarray, h: np.ndarray, count: int) -> np.ndarray:
    """Parity bits of each of count sets of shingles: a shingle flips the bit that its hash names."""
    bits = np.zeros((count, WORDS), np.uint64)
    np.bitwise_xor.at(bits, (rows, (h >> np.uint64(6)).astype(np.int64) % WORDS), np.uint64(1) << (h & np.uint64(63)))
    return bits


def _sketches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, bits): parity bits of each text."""
    for batch in batches:
        for i, j in pieces(batch.column(1)):
            _, rows, h = shingle_sets(batch.column(1).slice(i, j - i), np.zeros(0, np.uint64))
            bits = [x.tobytes() for x in _parity(rows, h, j - i)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(bits, pa.binary())], ["key", "bits"])


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, n, bits, s): size, parity bits and shingles of each text, once in a task while not too many are met."""
    seen: set[int] = set()
    for batch in batches:
        for i, j in pieces(batch.column(1)):
            part = batch.slice(i, j - i)
            keys, fresh = part.column(0).to_pylist(), []
            for r, k in enumerate(keys):
                if k not in seen:
                    fresh.append(r)
                    seen.add(k)
            if len(seen) > 100_000:
                seen.clear()
            if not fresh:
                continue
            part = part.take(pa.array(fresh))
            first, rows, h = shingle_sets(part.column(1), np.zeros(0, np.uint64))
            bits = _parity(rows, h, len(fresh))
            each = pa.ListArray.from_arrays(pa.array(np.arange(len(fresh) + 1) * WORDS, pa.int32()), pa.array(signed(bits.ravel())))
            lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(signed(h)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(first).astype(np.int32)), each, lists], ["key", "n", "bits", "s"])


def links(texts: DataFrame, hot: int = HOT) -> DataFrame:
    """(a, b): pairs of keys, a < b, 0.8 similar or more, that join all keys which any such pairs join.

    texts: (key long, text string); equal keys have equal texts. Null texts and those without a word take no part.
    No texts: an empty result.
    """
    spark = texts.sparkSession
    own = texts.select("key", "text").where("text is not null")
    share = min(1.0, SAMPLE / max(1, own.count()))
    often = own.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(share * (1 << 30))).dropDuplicates(["key"])
    often = often.mapInArrow(_sample, "h long").groupBy("h").count().where("count > 2").orderBy(F.desc("count"), "h").limit(FREQUENT).select("h")
    frequent = np.sort(np.array([r[0] for r in stored(often).collect()], np.int64).view(np.uint64))
    rows = stored(own.mapInArrow(_prefixes(spark.sparkContext.broadcast(frequent)), "h long, n int, pos int, key long"))
    rank = F.xxhash64("key", F.lit(9))
    # the shingles of more than ``hot`` texts, one in ``hot`` rows at most
    large = checkpointed(_crowded(rows, hot).groupBy("h").agg(F.count("*").alias("c"), F.min(F.struct(rank.alias("r"), "key", "n", "pos")).alias("lead")).where(F.col("c") > hot))
    n_large = large.count()
    few = n_large <= FEW
    large = F.broadcast(large) if few else large
    cold = rows.join(large.select("h"), "h", "left_anti") if n_large else rows
    dealt = cold.select("h", "n", "pos", "key", rank.alias("r")).repartition("h").sortWithinPartitions("h", "r", "key")
    led = stored(dealt.mapInArrow(_led, "h long, n int, pos int, key long, " + ", ".join(f"l{j} long" for j in range(LEADS))))
    pairs = led.select("key", F.explode(F.array(*[f"l{j}" for j in range(LEADS)])).alias("lead")).where("lead is not null")
    if n_large:
        warm = rows.join(large, "h")
        left = F.least(F.col("n") - F.col("pos"), F.col("lead.n") - F.col("lead.pos"))
        pairs = pairs.unionByName(warm.where((F.col("key") != F.col("lead.key")) & (9 * left >= 4 * (F.col("n") + F.col("lead.n")))).select("key", F.col("lead.key").alias("lead")))
    pairs = stored(pairs.select(F.least("key", "lead").alias("a"), F.greatest("key", "lead").alias("b")).distinct())
    first = _similar(pairs, own)
    labels = graph.components(first, "a", "b").select(F.col("node").alias("key"), F.col("component").alias("label"))
    label = F.coalesce("label", "key").alias("label")
    rest = led.select("h", "n", "pos", "key").join(labels, "key", "left").select(F.col("h").alias("g"), label, "n", "pos", "key")
    if n_large:
        named = stored(warm.select("h", "n", "pos", "key", "c").distinct().join(labels, "key", "left").select("h", label, "n", "pos", "key", "c"))
        main = named.groupBy("h", "label").count().groupBy("h").agg(F.max_by("label", "count").alias("main"))
        main = F.broadcast(main) if few else main
        shares = F.ceil(F.col("c") / hot).cast("int")
        share_of = F.when(F.col("label") == F.col("main"), F.array(F.pmod(F.xxhash64("key", F.lit(3)), shares).cast("int"))).otherwise(F.sequence(F.lit(0), shares - 1))
        spread = named.join(main, "h").withColumn("share", F.explode(share_of))
        rest = rest.unionByName(spread.select(F.xxhash64("h", "share").alias("g"), "label", "n", "pos", "key"))
    shape = "g long, label long, n int, pos int, key long"
    kept = stored(rest.repartition("g").sortWithinPartitions("g", "label", "key").mapInArrow(_open, shape))
    keys = stored(kept.select("key").distinct())
    bits = stored(own.join(_sized(keys), "key", "left_semi").dropDuplicates(["key"]).mapInArrow(_sketches, "key long, bits binary"))
    dealt = _dealt(kept, bits)
    met = stored(dealt.mapInArrow(_forest, "a long, b long").distinct())
    second = _similar(met, own)
    # nodes are labels, so that only what the forest joined is named anew
    named_a = second.join(_once(kept, "a", "x"), "a").join(_once(kept, "b", "y"), "b")
    merged = graph.components(named_a, "x", "y").select(F.col("node").alias("label"), F.col("component").alias("now"))
    renamed = kept.join(merged, "label", "left").select("g", F.coalesce("now", "label").alias("label"), "n", "pos", "key")
    last = stored(_dealt(renamed, bits).mapInArrow(_across, "a long, b long").distinct().join(met, ["a", "b"], "left_anti"))
    third = _similar(last, own)
    discard(rows, led, pairs, kept, keys, bits, met, last, *([named] if n_large else []))
    return first.unionByName(second).unionByName(third)


def _crowded(rows: DataFrame, hot: int) -> DataFrame:
    """The rows of all shingles with over ``hot`` rows, and few others.

    Rows are counted by some bits of the shingle first, so that tasks hold no entry for each shingle: one with
    so many rows stands in a bucket with as many.
    """
    buckets = 1 << max(BUCKETS, (4 * rows.count() // hot).bit_length())
    bucket = F.col("h").bitwiseAND(F.lit(buckets - 1)).alias("bucket")
    full = checkpointed(rows.groupBy(bucket).agg(F.count("*").alias("held")).where(F.col("held") > hot).select("bucket"))
    full = F.broadcast(full) if full.count() <= FEW else full
    return rows.withColumn("bucket", bucket).join(full, "bucket", "left_semi").drop("bucket")


def _dealt(rows: DataFrame, bits: DataFrame) -> DataFrame:
    """Rows with their texts' bits, by group and label."""
    return rows.join(bits, "key").select("g", "label", "n", "pos", "key", "bits").repartition("g").sortWithinPartitions("g", "label", "key")


def _once(rows: DataFrame, key: str, label: str) -> DataFrame:
    """Each key's label, under other names."""
    return rows.groupBy(F.col("key").alias(key)).agg(F.first("label").alias(label))


def _similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs whose sets are 0.8 similar or more; only texts in a pair get to Python.

    Each shingle in one set alone flips a parity bit, so two sets differ in as many shingles as bits, at least; sets of n and
    m shingles so similar differ in (n + m) / 9 at most. What fails by its bits, a short row a text, never brings its set.
    """
    keys = _keys(pairs)
    found = stored(texts.join(_sized(keys), "key", "left_semi").mapInArrow(_sets, "key long, n int, bits array<long>, s array<long>"))
    small = found.groupBy("key").agg(F.first("n").alias("n"), F.first("bits").alias("bits"))
    flips = F.aggregate(F.zip_with("bits", "other", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    met = _joined(pairs, small, ("n", "bits"), ("m", "other")).where(9 * flips <= F.col("n") + F.col("m"))
    left = stored(met.select("a", "b"))
    wanted = _keys(left)
    sets = found.select("key", "s").join(_sized(wanted), "key", "left_semi").groupBy("key").agg(F.first("s").alias("s"))
    common = _joined(left, sets, ("s",), ("t",)).select("a", "b", F.size(F.array_intersect("s", "t")).alias("c"), (F.size("s") + F.size("t")).alias("n"))
    out = checkpointed(common.where("5 * c >= 4 * (n - c)").select("a", "b"))
    discard(keys, found, left, wanted)
    return out


def _keys(pairs: DataFrame) -> DataFrame:
    return stored(pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct())


def _sized(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.limit(KEYS + 1).count() <= KEYS else keys


def _joined(pairs: DataFrame, rows: DataFrame, own: tuple[str, ...], others: tuple[str, ...]) -> DataFrame:
    """Pairs with columns of a's row, and with those of b's row under other names."""
    out = pairs.join(rows.select(F.col("key").alias("a"), *own), "a")
    return out.join(rows.select(F.col("key").alias("b"), *[F.col(x).alias(y) for x, y in zip(own, others, strict=True)]), "b")
