"""Language of words in code-switched text by a linear-chain conditional random field.

A chain is a sentence (cut at ``.``, ``!``, ``?`` and line ends). A word, a run of letters
in lower case, is described by its byte n-grams of 2 to 4 with word borders (which holds its affixes of 1
to 3 bytes) and by itself, the lexicon; learned transitions tie it to its neighbours.
Forward-backward gives each word its marginals; a document's language is the one with
the largest sum.

No step is taken by the word: chains are cut in blocks of ``BLOCK`` words, and all blocks of some texts advance
together. Where a chain has several, the product of a block's transitions and emissions carries the forward
vector to the next block and the backward vector to the one before, so the marginals are those of the whole chain.
N-grams are summed over ``WINDOW`` bytes at a time, whatever words or texts these belong to, so a very long text
(or word) takes about 60 bytes of memory for each of its own bytes, and no other text shares its slice.

Training is bounded: ``TRAIN_ROWS`` labelled documents and ``TRAIN_BYTES`` of their text, about, picked by hash
among those of ``LONGEST`` bytes or fewer; prediction covers every word of every text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .kernel import mix, pieces, text_offsets

#: labelled documents to fit on, about
TRAIN_ROWS = 1500
#: and bytes of text, about; a document of more than LONGEST bytes isn't picked
TRAIN_BYTES = 16 << 20
LONGEST = 1 << 20
BITS = 16
ORDERS = (2, 3, 4)
UNKNOWN = "und"
#: texts of a slice advance together
SLICE_BYTES = 1 << 18
#: bytes whose n-grams are held at a time
WINDOW = 1 << 16
#: words of a block
BLOCK = 64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True


class Chains:
    """Words of some texts, and the chains they form."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n\n\n" + b"\n\n\n".join(texts) + b"\n\n\n\n", np.uint8)  # no n-gram reaches from text to text
        low = _LOWER[raw]
        # capitals of Latin-1 in UTF-8: C3 80..9E
        high = np.flatnonzero((raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97) & (raw[:-1] == 0xC3)) + 1
        low[high] += 32
        letter = _LETTER[low]
        stops = np.flatnonzero((raw == 0x2E) | (raw == 0x21) | (raw == 0x3F) | (raw == 0x0A))
        self.low = np.where(letter, low, np.uint8(32))
        self.starts = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
        self.ends = np.flatnonzero(letter[:-1] & ~letter[1:]) + 1
        self.n = len(self.starts)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.cumsum(lengths + 3) - lengths
        self.rows = np.searchsorted(begin, self.starts, "right") - 1
        new = np.ones(self.n, bool)
        before = np.searchsorted(stops, self.starts)
        new[1:] = (before[1:] > before[:-1]) | (self.rows[1:] != self.rows[:-1])
        self.chain_at = np.flatnonzero(new)
        self.chain_len = np.diff(np.append(self.chain_at, self.n))

    def windows(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]]:
        """For each window: words a to b that it touches, the word of each place within one, where those begin, and per
        place the buckets of its n-grams and the hash of its longest one.

        A word's places are those from the byte before it to its last; a word may go on in the next window.
        """
        for s in range(0, len(self.low), WINDOW):
            t = min(len(self.low), s + WINDOW)
            a, b = int(np.searchsorted(self.ends, s, "right")), int(np.searchsorted(self.starts, t, "right"))
            if a >= b:
                continue
            low = np.full(t - s + max(ORDERS) - 1, 32, np.uint64)
            part = self.low[s : t + max(ORDERS) - 1]
            low[: len(part)] = part
            first = np.maximum(self.starts[a:b] - 1, s)
            size = np.minimum(self.ends[a:b], t) - first
            at = np.cumsum(size) - size
            inside = np.repeat(first - at, size) + np.arange(size.sum()) - s
            grams, h = [], low
            for order in range(2, max(ORDERS) + 1):
                h = h[:-1] << np.uint64(8) | low[order - 1 :]
                if order in ORDERS:
                    grams.append((mix(h[inside] + np.uint64(order << 56)) >> np.uint64(64 - BITS)).astype(np.int32))
            yield a, b, np.repeat(np.arange(a, b), size), at, grams, mix(h[inside])

    def own(self, total: np.ndarray) -> np.ndarray:
        """The lexicon's bucket of each word, from the sum of its longest n-grams' hashes."""
        size = (self.ends - self.starts + 1).astype(np.uint64)
        return (mix(total * np.uint64(0x100000001B3) + size) >> np.uint64(64 - BITS)).astype(np.int32)


class Model:
    def __init__(self, labels: list[str]):
        self.labels = labels
        k = len(labels)
        self.grams = [np.zeros((1 << BITS, k), np.float32) for _ in ORDERS]
        self.lexicon = np.zeros((1 << BITS, k), np.float32)
        self.step = np.eye(k, dtype=np.float64)
        self.first = np.zeros(k, np.float64)

    def emissions(self, c: Chains, found: Iterable | None = None) -> np.ndarray:
        """(words, labels): what each word's n-grams and lexicon entry speak for."""
        e, own = np.zeros((c.n, len(self.labels))), np.zeros(c.n, np.uint64)
        for a, b, _, at, grams, longest in c.windows() if found is None else found:
            total = sum(w[g] for w, g in zip(self.grams, grams, strict=True))
            e[a:b] += np.add.reduceat(total, at, axis=0, dtype=np.float64)
            own[a:b] += np.add.reduceat(longest, at)
        e += self.lexicon[c.own(own)]
        return e

    def marginals(self, c: Chains, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """P(label) of each word; and the scaled forward and backward vectors."""
        k = len(self.labels)
        p = np.exp(e - e.max(axis=1, keepdims=True)) if c.n else e
        step, first = np.exp(self.step), np.exp(self.first)
        parts = -(-c.chain_len // BLOCK)
        chain = np.repeat(np.arange(len(parts)), parts)
        nth = np.arange(len(chain)) - np.repeat(np.cumsum(parts) - parts, parts)
        at = c.chain_at[chain] + nth * BLOCK
        length = np.minimum(BLOCK, c.chain_len[chain] - nth * BLOCK)
        enter, leave = np.tile(first, (len(at), 1)), np.ones((len(at), k))
        long = np.flatnonzero(parts[chain] > 1)
        if len(long):
            through = _products(p, at[long], length[long], step)
            # a chain's blocks follow each other in ``long``
            for i, b in enumerate(long.tolist()):
                if nth[b]:
                    now = _scaled(enter[b - 1] @ through[i - 1]) @ step
                    enter[b] = now
            for i in range(len(long) - 1, -1, -1):
                b = int(long[i])
                if nth[b]:
                    leave[b - 1] = _scaled(step @ (through[i] @ leave[b]))
        order = np.argsort(-length, kind="stable")
        at, length = at[order], length[order]
        live = np.searchsorted(-length, -np.arange(1, (length[0] if len(length) else 0) + 1), "right")
        alpha, beta = np.empty_like(p), np.empty_like(p)
        beta[at + length - 1] = leave[order]
        now = enter[order]
        for t, m in enumerate(live):
            pos = at[:m] + t
            now = p[pos] * (now if t == 0 else now[:m] @ step)
            now /= now.sum(axis=1, keepdims=True)
            alpha[pos] = now
        for t in range(len(live) - 1, 0, -1):
            pos = at[: live[t]] + t
            back = (p[pos] * beta[pos]) @ step.T
            beta[pos - 1] = back / back.sum(axis=1, keepdims=True)
        both = alpha * beta
        return both / both.sum(axis=1, keepdims=True), alpha, p * beta


def _scaled(v: np.ndarray) -> np.ndarray:
    return v / v.sum()


def _products(p: np.ndarray, at: np.ndarray, length: np.ndarray, step: np.ndarray) -> np.ndarray:
    """For each block diag(p1) step diag(p2) step ... diag(pn), scaled."""
    order = np.argsort(-length, kind="stable")
    at, length = at[order], length[order]
    live = np.searchsorted(-length, -np.arange(1, length[0] + 1), "right")
    now = p[at][:, None, :] * np.eye(p.shape[1])
    for t, m in enumerate(live[1:].tolist(), 1):
        nxt = (now[:m] @ step) * p[at[:m] + t][:, None, :]
        now[:m] = nxt / nxt.sum(axis=(1, 2), keepdims=True)
    out = np.empty_like(now)
    out[order] = now
    return out


def fit(texts: list[bytes], langs: list[str], epochs: int = 3, seed: int = 7) -> Model:
    """Maximise the conditional likelihood by AdaGrad; chains are respliced so that languages switch."""
    model = Model(sorted(set(langs)))
    k = len(model.labels)
    gold_of = np.array([model.labels.index(x) for x in langs])
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    squares = [np.full_like(x, 0.1) for x in (*model.grams, model.lexicon)]
    square_step, square_first = np.full((k, k), 1.0), np.full(k, 1.0)
    for epoch in range(epochs):
        for pick in _minibatches(order, texts):
            c = Chains([texts[j] for j in pick])
            if not c.n:
                continue
            found = list(c.windows())
            gold = gold_of[pick][c.rows]
            # splice chains: a chain goes on where another one, of any text, begins
            joined = rng.permutation(len(c.chain_at))
            at = np.repeat(c.chain_at[joined] - np.cumsum(c.chain_len[joined]) + c.chain_len[joined], c.chain_len[joined]) + np.arange(c.n)
            e = model.emissions(c, found)[at]
            spliced = Chains.__new__(Chains)
            ends = np.cumsum(c.chain_len[joined])
            cut = np.concatenate(([0], ends[:-1][rng.random(len(ends) - 1) < 0.6]))
            spliced.n, spliced.chain_at = c.n, cut
            spliced.chain_len = np.diff(np.append(cut, c.n))
            m, alpha, ahead = model.marginals(spliced, e)
            y = np.eye(k)[gold[at]]
            error = np.empty_like(e)
            error[at] = y - m
            inner = np.ones(c.n, bool)
            inner[cut] = False
            nxt = np.flatnonzero(inner)
            pair = alpha[nxt - 1][:, :, None] * np.exp(model.step) * ahead[nxt][:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            g_step = (y[nxt - 1].T @ y[nxt] - pair.sum(axis=0)) / max(1, len(cut))
            g_first = (y[cut] - m[cut]).mean(axis=0)
            square_step += g_step**2
            square_first += g_first**2
            model.step += 0.2 * g_step / np.sqrt(square_step)
            model.first += 0.2 * g_first / np.sqrt(square_first)
            spread = error[np.concatenate([x[2] for x in found])]
            for o, (w, sq) in enumerate(zip(model.grams, squares, strict=False)):
                _ascend(w, sq, np.concatenate([x[4][o] for x in found]), spread, k)
            own = np.zeros(c.n, np.uint64)
            for a, b, _, first, _, longest in found:
                own[a:b] += np.add.reduceat(longest, first)
            _ascend(model.lexicon, squares[-1], c.own(own), error, k)
    return model


def _minibatches(order: np.ndarray, texts: list[bytes], rows: int = 40, most: int = 1 << 19) -> Iterator[np.ndarray]:
    """Up to ``rows`` texts at a time, of ``most`` bytes together unless one has more."""
    at = 0
    while at < len(order):
        sizes = np.cumsum([len(texts[j]) for j in order[at : at + rows]])
        n = max(1, int(np.searchsorted(sizes, most, "right")))
        yield order[at : at + n]
        at += n


def _ascend(w, sq, idx, err, k):
    g = np.stack([np.bincount(idx, err[:, j], 1 << BITS) for j in range(k)], axis=1)
    used = np.flatnonzero(np.abs(g).sum(axis=1))
    sq[used] += g[used] ** 2
    w[used] += 0.15 * g[used] / np.sqrt(sq[used])


def has_letter(text: bytes) -> bool:
    return any(97 <= b <= 122 for b in text[:64].lower()) or any(x.isalpha() for x in text.decode("utf-8", "replace"))


def _languages(m: Model | None, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    if m is None:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    c = Chains(texts)
    marginal = m.marginals(c, m.emissions(c))[0]
    size = (c.ends - c.starts).astype(float)
    sums = np.stack([np.bincount(c.rows, marginal[:, q] * size, len(texts)) for q in range(len(m.labels))], axis=1)
    best, total = sums.argmax(axis=1), sums.sum(axis=1)
    known = np.array([t > 0 and has_letter(x) for t, x in zip(total, texts, strict=True)], bool)
    return [m.labels[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], np.where(known, sums.max(axis=1) / np.where(total > 0, total, 1), 0.0)


def _label(model, text: int, kept: list[int], added: tuple[str, str]):
    """Rows with the columns ``kept`` and two more; ``text`` is the place of the text, which is sent once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model | None = model.value
        for batch in batches:
            column = batch.column(text)
            for i, j in pieces(column, SLICE_BYTES):
                part = column.slice(i, j - i)
                off, data = text_offsets(part)
                raw = memoryview(data) if data is not None else memoryview(b"")
                langs, score = _languages(m, [bytes(raw[s:e]) for s, e in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)])
                own = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*(own.column(k) for k in kept), pa.array(langs, pa.string()), pa.array(score)], [*(own.schema.names[k] for k in kept), *added])

    return run


def train(docs: DataFrame, rows: int = TRAIN_ROWS, most: int = TRAIN_BYTES) -> Model | None:
    """Fit on about ``rows`` documents (and ``most`` bytes) that have text and lang and crc32(doc_id) mod 4 other than 2; None if there are none."""
    size = F.octet_length(F.col("text").cast("string"))
    usable = docs.where("text is not null and lang is not null").where(~held_out()).where(size <= LONGEST)
    n, held = usable.agg(F.count("*"), F.sum(size.cast("long"))).first()
    share = int(min(1.0, rows / max(n, 1), most / max(held or 0, 1)) * (1 << 30))
    picked = usable.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(1 << 30)) < share)
    got = picked.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).collect()
    got.sort(key=lambda r: (r[0] is None, r[0], r[1], r[2]))
    return fit([r[1].encode() for r in got], [r[2] for r in got]) if got else None


def held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row.

    ``und`` with score 0 where the text is null or has no letter, or nothing was there to learn from;
    else score is the share of letters that the CRF gives to lang_pred. Ties go to the label that
    sorts first. Repeated rows give repeated rows; a null doc_id is kept; a text of any length is read whole; other
    columns are ignored; no documents: an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # size fixed by BITS and the number of labels
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(_label(sent, 2, [0, 1], ("lang_pred", "score")), "doc_id long, held_out boolean, lang_pred string, score double")


def with_language(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents with lang_pred and lang_score added after all their own columns, which keep their names and values.

    Columns of those two names in the input are replaced; the text must be a string. Rows as in ``predict``.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    own = docs.select(*[c for c in docs.columns if c not in ("lang_pred", "lang_score")])
    schema = StructType([*own.schema.fields, StructField("lang_pred", StringType()), StructField("lang_score", DoubleType())])
    return own.mapInArrow(_label(sent, own.columns.index("text"), list(range(len(own.columns))), ("lang_pred", "lang_score")), schema)
