"""Masked pseudo-likelihood of documents under a window network trained in numpy.

Each word is predicted from the two before and the two after it. Words fall into
``CLASSES`` classes: the most frequent words of the corpus each make one, all others go by their last
two bytes. A network (an embedding for each place in the window, a tanh layer, a softmax)
gives the class; corpus counts give the word within its class. A document's score is the
sum of the conditional log-probabilities of all its words.

Counts cover every word of every document, and so does training: each task of a round
runs gradient steps over its documents, masking a hashed share of their words (the rounds
together mask each word once), and the
weights are averaged by the number of words. What travels grows with the corpus; what
the driver holds doesn't: the averaged weights and the counts of the ``KNOWN`` most frequent words.
Counts of all other words stay in a table, which the rare words of the documents are joined to.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .kernel import Words, mix, pieces, signed

CLASSES = 128
SUFFIXES = 64
WIDTH = 8
HIDDEN = 24
#: words whose counts are broadcast; a word beyond them is at most one in KNOWN, so the join has no hot keys
KNOWN = 1 << 16
ROUNDS = 2
_PLACES = (-2, -1, 1, 2)
_CHUNK = 1 << 15


class Vocabulary:
    """The frequent words of a corpus with their counts; ``counts`` is the table of all (h, n), which isn't sent."""

    def __init__(self, known: list[tuple[int, int]], suffix_words: np.ndarray, counts: DataFrame | None = None):
        h = np.array([x[0] for x in known], np.int64).view(np.uint64)
        order = np.argsort(h)
        self.h, self.n = h[order], np.array([x[1] for x in known], float)[order]
        frequent = np.sort(h[: CLASSES - SUFFIXES])
        self.kinds = np.where(np.isin(self.h, frequent), SUFFIXES + np.searchsorted(frequent, self.h), -1)
        self.suffix_words = np.maximum(suffix_words, 1.0)
        self.counts = counts

    def __getstate__(self):
        return {**self.__dict__, "counts": None}

    def classes(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class of each word, log P(word | class), and whether that lacks log(count) as the word isn't known here."""
        h = words.hashes()
        suffix = suffix_of(words)
        if not len(self.h):
            return suffix, -np.log(self.suffix_words[suffix]), np.ones(len(h), bool)
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        rare = self.h[at] != h
        own = ~rare & (self.kinds[at] >= 0)
        within = np.log(np.where(rare, 1.0, self.n[at]) / self.suffix_words[suffix])
        return np.where(own, self.kinds[at], suffix), np.where(own, 0.0, within), rare


def suffix_of(words: Words) -> np.ndarray:
    last = words.raw[words.ends - 1].astype(np.uint64)
    before = words.raw[np.maximum(words.ends - 2, words.starts)].astype(np.uint64)
    return (mix(last * np.uint64(257) + before) >> np.uint64(32)).astype(np.int64) % SUFFIXES


def initial(seed: int = 3) -> list[np.ndarray]:
    rng = np.random.default_rng(seed)
    inner = len(_PLACES) * WIDTH
    shapes = [(len(_PLACES), CLASSES + 1, WIDTH), (inner, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,)]
    return [(rng.standard_normal(s) * (0.3 if len(s) > 1 else 0)).astype(np.float32) for s in shapes]


def windows(c: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(words, places) classes around each word; CLASSES beyond the text's ends."""
    out = np.full((len(c), len(_PLACES)), CLASSES, np.int64)
    for k, p in enumerate(_PLACES):
        a, b = (slice(-p, None), slice(None, p)) if p < 0 else (slice(None, -p or None), slice(p, None))
        if abs(p) < len(c):
            near = rows[a] == rows[b]
            out[a, k] = np.where(near, c[b], CLASSES)
    return out


def forward(w: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    e, w1, b1, w2, b2 = w
    inner = np.concatenate([e[k][x[:, k]] for k in range(len(_PLACES))], axis=1)
    hidden = np.tanh(inner @ w1 + b1)
    logits = hidden @ w2 + b2
    logits -= logits.max(axis=1, keepdims=True)
    return inner, hidden, logits


def log_p(w: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    _, _, z = forward(w, x)
    return z[np.arange(len(y)), y] - np.log(np.exp(z).sum(axis=1))


def descend(w: list[np.ndarray], sq: list[np.ndarray], x: np.ndarray, y: np.ndarray, rate: float = 0.08) -> None:
    """One AdaGrad step on -mean log P."""
    inner, hidden, z = forward(w, x)
    p = np.exp(z)
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(len(y)), y] -= 1
    p /= len(y)
    back = (p @ w[3].T) * (1 - hidden**2)
    into = back @ w[1].T
    e = np.zeros_like(w[0])
    for k in range(len(_PLACES)):
        part = into[:, k * WIDTH : (k + 1) * WIDTH]
        for j in range(WIDTH):
            e[k, :, j] = np.bincount(x[:, k], part[:, j], CLASSES + 1)
    for i, g in enumerate((e, inner.T @ back, back.sum(axis=0), hidden.T @ p, p.sum(axis=0))):
        sq[i] += g * g
        w[i] -= rate * g / np.sqrt(sq[i] + 1e-8)


def _lowered(column: pa.Array) -> Iterator[tuple[int, int, Words]]:
    for i, j in pieces(column):
        yield i, j, Words(column.slice(i, j - i), lower=True)


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, words in _lowered(batch.column(0)):
            h, first, n = np.unique(words.hashes(), return_index=True, return_counts=True)
            suffix = suffix_of(words)[first]
            yield pa.RecordBatch.from_arrays([pa.array(signed(h)), pa.array(suffix), pa.array(n)], ["h", "suffix", "n"])


def vocabulary(docs: DataFrame) -> Vocabulary:
    """Exact word counts over all documents: a table, of which the driver holds the most frequent ``KNOWN``."""
    counts = stored(docs.select(F.col("text").cast("string")).mapInArrow(_counts, "h long, suffix long, n long").groupBy("h").agg(F.min("suffix").alias("suffix"), F.sum("n").alias("n")))
    # by way of a table, as a collected limit would send the driver KNOWN rows of each partition
    known = stored(counts.orderBy(F.desc("n"), "h").limit(KNOWN).select("h", "n", "suffix")).collect()
    known.sort(key=lambda r: (-r[1], r[0]))
    words = np.zeros(SUFFIXES)
    for s, k in counts.groupBy("suffix").agg(F.sum("n")).collect():
        words[s] = k
    for _, k, s in known[: CLASSES - SUFFIXES]:
        words[s] -= k
    return Vocabulary([(r[0], r[1]) for r in known], words, counts.select("h", "n"))


def _train(state, turn: int, rounds: int = ROUNDS):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, start = state.value
        w = [x.copy() for x in start]
        sq = [np.full_like(x, 1e-3) for x in w]
        seen = 0
        for batch in batches:
            for _, _, words in _lowered(batch.column(0)):
                if not len(words.starts):
                    continue
                c, _, _ = vocabulary.classes(words)
                x = windows(c, words.rows)
                draw = mix(words.hashes() + np.arange(len(c), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                masked = np.flatnonzero(draw % np.uint64(rounds) == np.uint64(turn))
                for i in range(0, len(masked), 1024):
                    m = masked[i : i + 1024]
                    descend(w, sq, x[m], c[m])
                seen += len(masked)
        if seen:
            flat = np.concatenate([x.ravel() for x in w]).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat * seen), pa.array(np.full(len(flat), seen))], ["i", "v", "n"])

    return run


def train(docs: DataFrame, known: Vocabulary, rounds: int = ROUNDS) -> list[np.ndarray]:
    spark = docs.sparkSession
    w = initial()
    for turn in range(rounds):
        sent = spark.sparkContext.broadcast((known, w))  # of a size fixed by CLASSES and KNOWN
        parts = docs.select(F.col("text").cast("string")).mapInArrow(_train(sent, turn, rounds), "i long, v double, n long")
        flat = dict(parts.groupBy("i").agg(F.sum("v") / F.sum("n")).collect())
        if not flat:
            break
        at, new = 0, []
        for x in w:
            new.append(np.array([flat[at + k] for k in range(x.size)], np.float32).reshape(x.shape))
            at += x.size
        w = new
    return w


def _score(state):
    """Sums that lack log(count) of the words in ``rare``, which has a hash for each of them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, w = state.value
        for batch in batches:
            for i, j, words in _lowered(batch.column(1)):
                c, within, rare = vocabulary.classes(words)
                x = windows(c, words.rows)
                each = [log_p(w, x[a : a + _CHUNK], c[a : a + _CHUNK]) for a in range(0, len(c), _CHUNK)]
                p = np.concatenate(each) + within if each else np.zeros(0)
                total = np.bincount(words.rows, p, j - i).astype(float)
                n = np.bincount(words.rows, minlength=j - i)
                ends = np.concatenate(([0], np.cumsum(np.bincount(words.rows[rare], minlength=j - i))))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(signed(words.hashes()[rare])))
                cols = [batch.column(0).slice(i, j - i), pa.array(n.astype(np.int64)), pa.array(total), lists]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_words", "total", "rare"])

    return run


def scored(docs: DataFrame, known: Vocabulary, w: list[np.ndarray]) -> DataFrame:
    """(doc_id, n_words, log_likelihood, mean_log_likelihood) for each row.

    Words that the vocabulary hasn't counted go as counted once. Null and blank texts: no words, sum 0, mean null.
    Repeated rows give repeated rows; a null doc_id is kept; other columns are ignored; no documents: an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast((known, w))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = own.mapInArrow(_score(sent), "doc_id long, n_words long, total double, rare array<long>")
    # written once, so that the row numbers stand
    parts = stored(parts.withColumn("row", F.monotonically_increasing_id()))
    met = parts.select("row", F.explode("rare").alias("h")).join(known.counts, "h")
    lacking = met.groupBy("row").agg(F.sum(F.log(F.col("n").cast("double"))).alias("lacking"))
    both = parts.select("row", "doc_id", "n_words", "total").join(lacking, "row", "left")
    total = F.col("total") + F.coalesce("lacking", F.lit(0.0))
    mean = F.when(F.col("n_words") > 0, total / F.col("n_words"))
    return both.select("doc_id", "n_words", total.alias("log_likelihood"), mean.alias("mean_log_likelihood"))


def score(docs: DataFrame) -> DataFrame:
    """Count, train and score over one table of documents; see ``scored``."""
    known = vocabulary(docs)
    return scored(docs, known, train(docs, known))
