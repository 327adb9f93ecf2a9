"""Toxicity by a weighted finite-state grammar over clauses.

A lexicon transducer turns words into classes: insults and threats (words and stems, with
weights learned from labelled documents), targets, negation and speech verbs or quotation
marks. Small transducers for negation, reported speech and target then rewrite insults and threats by
what comes before them in the clause; they are composed to one machine. A document's
matches are summed by the weights of the arcs they took, so that what is negated or
reported counts for less than what is said to someone; a logistic fitted around prior weights makes that a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernel import text_offsets

#: labelled documents to learn from, about
TRAIN_ROWS = 6000
STEM = range(3, 9)
LEAST_DOCS = 4
LEAST_ODDS = 3.0
LEAST_GAIN = 24.0
SEEDS = {
    "I": "idiot moron stupid pathetic worthless scum trash loser disgusting clown imbecile dumbass".split(),
    "H": "kill murder strangle stab".split(),
    "T": "you your youre u he she they him her them this that these those".split(),
    "N": "not no never isnt arent wasnt dont doesnt nicht kein keine ne pas jamais nunca ningun".split(),
    "R": "said says say told called calls wrote reported quoted claimed sagte dit dijo".split(),
}
SEED_WEIGHT = 3.0
#: weights of the grammar's arcs: said, negated, reported, said to or of someone
KINDS = {"I": 1.0, "I-": 0.5, 'I"': 0.6, "I>": 1.2, "H": 0.5, "H-": 0.2, 'H"': 0.3, "H>": 1.2}
#: of insults, of threats, and the bias
PRIOR = np.array([1.2, 1.2, -2.0])
_WORD = re.compile(r"[^\W\d_]+|[\"“”«»]")
_CLAUSE = re.compile(r"[.!?;\n]+")
_QUOTES = frozenset("\"“”«»")


class Transducer:
    """Deterministic and complete: step[state][symbol] is (next state, what it writes)."""

    def __init__(self, step: list[dict[str, tuple[int, str]]]):
        self.step = step

    def __matmul__(self, then: Transducer) -> Transducer:
        """Composition: what self writes, ``then`` reads."""
        place, step = {(0, 0): 0}, []
        todo = [(0, 0)]
        for a, b in todo:
            row = {}
            for symbol, (na, out) in self.step[a].items():
                nb, last = then.step[b][out]
                if (na, nb) not in place:
                    place[na, nb] = len(place)
                    todo.append((na, nb))
                row[symbol] = (place[na, nb], last)
            step.append(row)
        return Transducer(step)


def _marker(sign: str, trigger: str, reach: int | None) -> Transducer:
    """Mark insults and threats that bear no mark yet and follow a trigger by at most ``reach`` words (None: in the same clause)."""
    symbols = ["_", "T", "N", "R", *KINDS]
    states = 2 if reach is None else reach + 1
    step = []
    for state in range(states):
        row = {}
        for s in symbols:
            out = s + sign if state and s in ("I", "H") else s
            nxt = state if reach is None else max(0, state - 1)
            row[s] = (states - 1 if s == trigger else nxt, out)
        step.append(row)
    return Transducer(step)


GRAMMAR = _marker("-", "N", 3) @ _marker('"', "R", None) @ _marker(">", "T", None)


def _trie(words: Iterable[str], stems: Iterable[str]) -> str:
    """A regular expression of the words (whole) and stems (any ending) that shares prefixes."""
    root: dict = {}
    for kind, entries in (("$", words), ("*", stems)):
        for w in entries:
            node = root
            for c in w:
                node = node.setdefault(c, {})
            node[kind] = {}

    def spell(node: dict) -> str:
        if "*" in node:
            return ""
        parts = [re.escape(c) + spell(n) for c, n in sorted(node.items()) if c != "$"]
        if "$" in node:
            parts.append(r"(?![^\W\d_])")
        return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"

    return r"(?<![^\W\d_])" + spell(root)


class Model:
    def __init__(self, words: dict[str, float], stems: dict[str, float], weights: np.ndarray = PRIOR):
        self.words = dict.fromkeys(SEEDS["I"], SEED_WEIGHT) | words
        self.stems, self.weights = stems, weights
        self.classes = {w: k for k in ("T", "N", "R") for w in SEEDS[k]}
        self.threats = set(SEEDS["H"])
        self.find = re.compile(_trie({*self.words, *self.threats}, stems))

    def read(self, word: str) -> tuple[str, float]:
        """The lexicon transducer: a word's class and weight."""
        if (w := self.words.get(word)) is not None:
            return "I", w
        if word in self.threats:
            return "H", SEED_WEIGHT
        if c := self.classes.get(word):
            return c, 0.0
        if word in _QUOTES:
            return "R", 0.0
        for n in STEM:
            if (w := self.stems.get(word[:n])) is not None:
                return "I", w
        return "_", 0.0

    def matches(self, text: str) -> list[tuple[str, str, float]]:
        """(kind, word, weight) of what the grammar matches, clause by clause."""
        out = []
        low = text.lower()
        if not self.find.search(low):
            return out
        for clause in _CLAUSE.split(low):
            if not self.find.search(clause):
                continue
            state = 0
            for word in _WORD.findall(clause):
                symbol, weight = self.read(word)
                state, kind = GRAMMAR.step[state][symbol]
                if weight:
                    out.append((kind, word, weight))
        return out

    def features(self, text: str) -> np.ndarray:
        x = np.zeros(3)
        for kind, _, weight in self.matches(text):
            x[int(kind[0] == "H")] += weight * KINDS[kind]
        x = np.log1p(x)
        x[2] = 1
        return x

    def score(self, text: str) -> float:
        return 1 / (1 + math.exp(-float(np.clip(self.features(text) @ self.weights, -30, 30))))


def _group(words: set[str]) -> tuple:
    """Near copies mostly get one key, so that a passage often copied isn't taken for a word often used."""
    hs = [hash_of(w) for w in words if len(w) > 4]
    return (min(hs), min(h * 0x9E3779B97F4A7C15 % (1 << 61) for h in hs)) if hs else tuple(sorted(words))


def hash_of(word: str) -> int:
    h = 1469598103934665603
    for b in word.encode():
        h = (h ^ b) * 1099511628211 & 0xFFFFFFFFFFFFFFFF
    return h


def _gain(a: int, n1: int, b: int, n0: int) -> float:
    """Likelihood ratio of an entry in a of n1 toxic and b of n0 clean documents."""

    def part(k, n, p):
        return (k * math.log(p) if k else 0) + ((n - k) * math.log(1 - p) if n > k else 0)

    both = (a + b) / (n1 + n0)
    return 2 * (part(a, n1, a / n1) + part(b, n0, b / n0) - part(a, n1, both) - part(b, n0, both))


def learn(texts: list[str], toxic: list[int]) -> Model:
    """Choose words and stems by likelihood ratio and odds, then fit the logistic."""
    seen: set[tuple] = set()
    groups: dict[int, list[set[str]]] = {0: [], 1: []}
    for text, y in zip(texts, toxic, strict=True):
        words = {w for w in _WORD.findall(text.lower()) if w not in _QUOTES}
        key = (_group(words), y)
        if key not in seen:
            seen.add(key)
            groups[y].append(words)
    n = {y: len(g) for y, g in groups.items()}
    counts = ({0: Counter(), 1: Counter()}, {0: Counter(), 1: Counter()})
    for y in (1, 0):
        for words in groups[y]:
            cut = {w[:k] for w in words for k in STEM if len(w) > k}
            # what is rare among the toxic can't be chosen
            counts[0][y].update(words if y else words & often[0])
            counts[1][y].update(cut if y else cut & often[1])
        often = [{w for w, a in c[1].items() if a >= LEAST_DOCS} for c in counts]
        for c, keep in zip(counts, often, strict=True):
            c[1] = Counter({w: c[1][w] for w in keep})
    gains: tuple[dict[str, tuple[float, float]], ...] = ({}, {})
    if n[0] and n[1]:
        for own, found in zip(counts, gains, strict=True):
            for w, a in own[1].items():
                b = own[0][w]
                odds = math.log((a + 0.5) / (n[1] + 1)) - math.log((b + 0.5) / (n[0] + 1))
                if a >= LEAST_DOCS and odds >= LEAST_ODDS and (gain := _gain(a, n[1], b, n[0])) >= LEAST_GAIN:
                    found[w] = gain, odds
    # a stem must tell clearly more than any word it covers; of nested stems, the one that tells most
    best = Counter()
    for w, (gain, _) in gains[0].items():
        for k in STEM:
            best[w[:k]] = max(best[w[:k]], gain)
    stems: dict[str, float] = {}
    for s, (gain, odds) in sorted(gains[1].items(), key=lambda x: (-x[1][0], -len(x[0]), x[0])):
        if gain > 1.2 * best[s] and not any(s.startswith(t) or t.startswith(s) for t in stems):
            stems[s] = odds
    grammatical = {w for k in ("T", "N", "R", "H") for w in SEEDS[k]}
    words = {w: odds for w, (_, odds) in gains[0].items() if w not in grammatical and not any(w[:k] in stems for k in STEM)}
    model = Model(words, stems)
    if n[0] and n[1]:
        x = np.array([model.features(t) for t in texts])
        model.weights = _newton(x, np.array(toxic, float))
    return model


def _newton(x: np.ndarray, y: np.ndarray, hold: float = 2.0) -> np.ndarray:
    """Logistic regression drawn to PRIOR (the bias is free)."""
    w = PRIOR.copy()
    ridge = np.full(len(w), hold)
    ridge[-1] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (y - p) - ridge * (w - PRIOR)
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(h, g)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Learn from about ``rows`` labelled documents, picked by hash, none with crc32(doc_id) mod 5 = 0.

    Of several labels the largest counts; null labels, ids and texts are left out. Without
    labels of both kinds, the built-in words and prior weights are all there is.
    """
    usable = labels.where("doc_id is not null and toxic is not null").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n = usable.count()
    share = int(min(1.0, rows / max(n, 1)) * (1 << 30))
    picked = usable.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(10)), F.lit(1 << 30)) < share)
    texts = docs.where("text is not null").select("doc_id", F.col("text").cast("string").alias("text"))
    got = texts.join(F.broadcast(picked), "doc_id").select("doc_id", "text", "toxic").distinct().collect()
    got.sort(key=lambda r: (r[0], r[1]))
    return learn([r[1] for r in got], [min(1, max(0, r[2])) for r in got])


def _score(model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for batch in batches:
            off, data = text_offsets(batch.column(1))
            raw = memoryview(data) if data is not None else memoryview(b"")
            scores = np.array([m.score(str(raw[s:e], "utf-8", "replace")) for s, e in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)], float)
            cols = [batch.column(0), batch.column(2), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "held_out", "score", "predicted"])

    return run


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row.

    Null and empty texts match nothing and get the score of that. Repeated rows give
    repeated rows; a null doc_id is kept; other columns are ignored; no documents: an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # learned from TRAIN_ROWS rows
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out().alias("held_out"))
    return own.mapInArrow(_score(sent), "doc_id long, held_out boolean, score double, predicted int")
