"""Nearest neighbours by largest inner product, with score-aware quantisation.

Vectors are cut in pairs of components, each pair coded in four bits. Codebooks are
fitted with an anisotropic loss: the part of a residual parallel to the vector, which moves
large inner products, costs ``ETA`` times the part across it. A query scans tables of 16
entries per code (two codes, a byte, at a time); what may be among its nearest by the scan and
the error that quantisation has shown is reranked exactly in double precision.

Codes and queries travel as packed blocks. A cell is a block of queries and up to ``CELL_BLOCKS``
blocks of codes, which pass it one by one; the exact scores found so far narrow what the next
block has to rerank, and only the best of each query leave the cell.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions

#: vectors that codebooks are fitted on, at most about
TRAIN_ROWS = 20_000
ETA = 4.0
#: queries in a block at most about, and at least where tasks are idle otherwise
QUERY_BLOCK = 2048
LEAST_QUERIES = 256
CODE_BLOCK = 4096
CELL_BLOCKS = 64
CODES = 16


def fit(x: np.ndarray, rounds: int = 8, eta: float = ETA, seed: int = 5) -> np.ndarray:
    """Codebooks (subspaces, 16, 2) that lower the anisotropic loss on x, taken pair by pair."""
    rng = np.random.default_rng(seed)
    n, d = x.shape
    m = -(-d // 2)
    x = np.pad(x, ((0, 0), (0, 2 * m - d)))
    books = np.zeros((m, CODES, 2))
    for s in range(m):
        v = x[:, 2 * s : 2 * s + 2]
        book = v[rng.choice(n, CODES, replace=n < CODES)].astype(np.float64)
        for _ in range(rounds):
            code = _assign(v, book, eta)
            for c in range(CODES):
                own = v[code == c]
                if len(own):
                    # least squares under I + (eta - 1) u u', u the direction of each vector
                    u = own / np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-30)
                    a = len(own) * np.eye(2) + (eta - 1) * (u.T @ u)
                    book[c] = np.linalg.solve(a, own.sum(axis=0) + (eta - 1) * (u * (u * own).sum(axis=1, keepdims=True)).sum(axis=0))
        books[s] = book
    return books


def _assign(v: np.ndarray, book: np.ndarray, eta: float) -> np.ndarray:
    r = v[:, None, :] - book[None]
    u = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-30)
    return ((r**2).sum(axis=2) + (eta - 1) * np.einsum("ncd,nd->nc", r, u) ** 2).argmin(axis=1)


def encode(x: np.ndarray, books: np.ndarray, eta: float = ETA) -> np.ndarray:
    """(n, bytes): two codes to a byte, subspaces 2k (low) and 2k + 1 (high)."""
    m = len(books)
    x = np.pad(x, ((0, 0), (0, 2 * m - x.shape[1])))
    out = np.zeros((len(x), -(-m // 2)), np.uint8)
    for s in range(m):
        out[:, s // 2] |= _assign(x[:, 2 * s : 2 * s + 2], books[s], eta).astype(np.uint8) << (4 * (s % 2))
    return out


def decode(codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    parts = [books[s][(codes[:, s // 2] >> (4 * (s % 2))) & 15] for s in range(len(books))]
    return np.concatenate(parts, axis=1)


def tables(q: np.ndarray, books: np.ndarray) -> np.ndarray:
    """(bytes, 256, queries): what each byte of codes adds to each query's score."""
    m = len(books)
    q = np.pad(q, ((0, 0), (0, 2 * m - q.shape[1]))).reshape(len(q), m, 2)
    four = np.einsum("qmd,mcd->mcq", q, books)
    if m % 2:
        four = np.concatenate([four, np.zeros((1, *four.shape[1:]))])
    low, high = four[0::2], four[1::2]
    return (high[:, :, None, :] + low[:, None, :, :]).reshape(len(low), 256, -1).astype(np.float32)


def scan(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """(n, queries): table sums of all codes."""
    total = table[0][codes[:, 0]]
    for b in range(1, codes.shape[1]):
        total += table[b][codes[:, b]]
    return total


def usable(vectors: DataFrame, vec: str = "embedding") -> DataFrame:
    """Rows whose vector is neither null nor zero and holds neither null nor non-finite components."""
    v = F.col(vec)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(v.isNotNull() & fine & F.exists(v, lambda x: x != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    d = len(column[0]) if len(column) else 0
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), d)


def _block(n: int):
    return F.pmod(F.xxhash64("vec_id", F.lit(4)), F.lit(n))


def _every(n: int):
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def _blocks(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(block, ids, vectors) of the rows of each block in a batch, ``most`` at a time."""
    for batch in batches:
        block = batch.column(0).to_numpy(zero_copy_only=False)
        for b in np.unique(block):
            mine = batch.take(pa.array(np.flatnonzero(block == b)))
            for i in range(0, mine.num_rows, most):
                part = mine.slice(i, most)
                yield int(b), part.column(1).to_numpy(zero_copy_only=False).astype(np.int64), _matrix(part.column(2))


def _row(names: list[str], block: int, *arrays: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *(pa.array([a.tobytes()], pa.binary()) for a in arrays)], names)


def _pack(books, wide: str):
    """A row of ids, codes, vectors (in their own type) and the sizes of residuals for each block."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c, ids, x in _blocks(batches, CODE_BLOCK):
            codes = encode(x, books)
            padded = np.pad(x, ((0, 0), (0, 2 * len(books) - x.shape[1])))
            error = np.linalg.norm(padded - decode(codes, books), axis=1)
            yield _row(["c", "ids", "codes", "vectors", "errors"], c, ids, codes, x.astype(wide), error.astype(np.float32))

    return run


def _pack_queries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b, ids, x in _blocks(batches, QUERY_BLOCK):
        yield _row(["b", "qid", "q"], b, ids, x)


class _Best:
    """The k best of each query of a block so far, as the code blocks go by."""

    def __init__(self, qid: np.ndarray, q: np.ndarray, k: int):
        self.qid, self.q, self.k = qid, q, k
        self.score = np.full((len(qid), k), -np.inf)
        self.ids = np.zeros((len(qid), k), np.int64)
        # residuals lie in no direction of their own, so the spread of errors in the score
        # is |q| |residual| / sqrt(dim); three times that is kept on either side
        self.spread = (3 * np.linalg.norm(q, axis=1) / np.sqrt(max(1, q.shape[1]))).astype(np.float32)

    def take(self, books: np.ndarray, ids: np.ndarray, codes: np.ndarray, x: np.ndarray, errors: np.ndarray) -> None:
        """Scan a block of codes and rerank what may be among a query's best, by exact scores so far and the block's own."""
        k, most = self.k, float(errors.max(initial=0.0))
        for i in range(0, len(self.qid), 128):
            near = scan(codes, tables(self.q[i : i + 128], books)).T
            for j, a in enumerate(near, i):
                v, worst = self.q[j], self.score[j, -1]
                at = np.flatnonzero(a >= worst - self.spread[j] * most)  # no residual reaches further
                if not len(at):
                    continue
                a, slack = a[at], self.spread[j] * errors[at]
                floor = np.partition(a - slack, -k - 1)[-k - 1] if len(a) > k + 1 else -np.inf
                at = at[a + slack >= max(floor, worst)]
                at = at[ids[at] != self.qid[j]]
                score = np.concatenate([self.score[j], (x[at].astype(np.float64) * v).sum(axis=1)])
                own = np.concatenate([self.ids[j], ids[at]])
                best = np.lexsort((own, -score))[:k]
                self.score[j], self.ids[j] = score[best], own[best]

    def rows(self) -> pa.RecordBatch:
        found = self.score > -np.inf
        qid = np.repeat(self.qid, found.sum(axis=1))
        return pa.RecordBatch.from_arrays([pa.array(qid), pa.array(self.ids[found]), pa.array(self.score[found])], ["query_id", "vec_id", "score"])


def _search(books, dim: int, k: int, wide: str):
    """A query block stays while the code blocks of its cell pass; its k best leave at the end."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, best = None, None
        for batch in batches:
            for r in range(batch.num_rows):
                now = (batch.column(0)[r].as_py(), batch.column(1)[r].as_py())
                if now != cell:
                    if best is not None:
                        yield best.rows()
                    qid, q = (np.frombuffer(batch.column(c)[r].as_py(), t) for c, t in ((2, np.int64), (3, np.float64)))
                    cell, best = now, _Best(qid, q.reshape(len(qid), dim), k)
                ids, codes, x, errors = (np.frombuffer(batch.column(4 + c)[r].as_py(), t) for c, t in enumerate((np.int64, np.uint8, wide, np.float32)))
                best.take(books, ids, codes.reshape(len(ids), -1), x.reshape(len(ids), dim), errors)
        if best is not None:
            yield best.rows()

    return run


def _merge(k: int):
    """The k best of each query; its rows stand together, best first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count = None, 0
        for batch in batches:
            q = batch.column(0).to_numpy(zero_copy_only=False)
            if not len(q):
                continue
            new = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1])))
            size = np.diff(np.append(new, len(q)))
            rank = np.arange(len(q)) - np.repeat(new, size) + 1
            if q[0] == last:
                rank[: size[0]] += count
            last, count = q[-1], int(rank[-1])
            keep = np.flatnonzero(rank <= k)
            rows = batch.take(pa.array(keep))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(rank[keep].astype(np.int32)), rows.column(1), rows.column(2)], ["query_id", "rank", "vec_id", "score"])

    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, train_rows: int = TRAIN_ROWS, vec: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest among vectors of its dimension, its own id left out.

    Vectors and queries have vec_id and ``vec``. Largest inner product first, ties to the
    smaller vec_id; all candidates if there are fewer. Unusable vectors (see ``usable``) and null ids take no part;
    of rows that repeat an id all take part as candidates and queries. No rows: an empty result.
    """
    spark = vectors.sparkSession
    wide = "f4" if vectors.schema[vec].dataType.simpleString() == "array<float>" else "f8"
    own = usable(vectors.where("vec_id is not null"), vec).select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vec).cast("array<double>").alias("v"))
    asked = usable(queries.where("vec_id is not null"), vec).select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vec).cast("array<double>").alias("v"))
    out = []
    for dim, n in sorted((r[0], r[1]) for r in own.groupBy(F.size("v")).count().collect()):
        mine = own.where(F.size("v") == dim)
        share = int(min(1.0, train_rows / n) * (1 << 30))
        picked = mine.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < share).toPandas()
        if picked.empty:
            picked = mine.limit(256).toPandas()
        picked = picked.sort_values("vec_id")
        books = fit(np.array(picked["v"].tolist()))
        asks = asked.where(F.size("v") == dim)
        # a grid of cells, rows and columns dealt by hash of the id
        asking, n_cells = asks.count(), -(-n // (CODE_BLOCK * CELL_BLOCKS))
        q_blocks = max(1, -(-asking // QUERY_BLOCK), min(partitions(spark) // n_cells, -(-asking // LEAST_QUERIES)))
        c_blocks = max(1, -(-n // CODE_BLOCK))
        coded = mine.select(_block(c_blocks).alias("c"), "vec_id", "v").repartition("c").mapInArrow(_pack(books, wide), "c long, ids binary, codes binary, vectors binary, errors binary")
        packs = asks.select(_block(q_blocks).alias("b"), "vec_id", "v").repartition("b").mapInArrow(_pack_queries, "b long, qid binary, q binary")
        cell = F.pmod("c", F.lit(n_cells)).alias("s")
        # merged, so that the rows of a cell come one after the other
        pairs = packs.withColumn("s", _every(n_cells)).hint("merge").join(coded.select(cell, "ids", "codes", "vectors", "errors").withColumn("b", _every(q_blocks)), ["b", "s"])
        out.append(pairs.select("b", "s", "qid", "q", "ids", "codes", "vectors", "errors").mapInArrow(_search(books, dim, k, wide), "query_id long, vec_id long, score double"))
    if not out:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    best = found.repartition("query_id").sortWithinPartitions("query_id", F.desc("score"), "vec_id")
    return best.mapInArrow(_merge(k), "query_id long, rank int, vec_id long, score double")

