"""Exact top-k inner products by the threshold algorithm.

Vectors are dealt into blocks of bounded size, queries into larger ones, and each pair of blocks is
a task.  A task sorts its block once: every dimension has its own list of vectors, and all queries
use it.  They walk the lists of their non-zero dimensions in step, best end first (the top for a
positive weight, the bottom for a negative one), a few hundred queries at a time: the vectors that a
step meets for the first time are scored in full for the queries still open, and a query closes
as soon as the sum of the weighted values at its lists' heads - the bound on everything unseen - is
below its k-th score; at equality it goes on, since an unseen vector of smaller id could tie.  The
blocks' results are merged per query.

A row is known by its place in a written table, not by its id: rows of one id are candidates each,
and a query leaves out its own row alone."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK, QUERY_BLOCK = 4096, 8192         # vectors and queries of a task
TOGETHER = 256                          # queries that walk the lists together
FIRST_DEPTH, DEEPER = 16, 4             # list entries of the first step; each next step is longer


class Lists:
    """A block: its vectors in the order of id and row, and for each dimension their order by falling
    value."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, rows: np.ndarray | None = None):
        rows = ids if rows is None else rows
        order = np.lexsort((rows, ids))
        self.ids, self.rows, self.x = ids[order], rows[order], x[order]
        self.order = np.argsort(-self.x, axis=0, kind="stable")
        self.values = np.take_along_axis(self.x, self.order, axis=0)

    def top(self, own: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best vectors but the row ``own``, ties to the smaller id."""
        return self.top_many(np.array([own]), q[None], k)[0]

    def top_many(self, own: np.ndarray, q: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """``top`` of several queries, a row of ``q`` each."""
        n = len(self.ids)
        pos, neg = np.maximum(q, 0), np.minimum(q, 0)
        best = [(np.empty(0, np.int64), np.empty(0, self.x.dtype)) for _ in q]
        open_, unseen = np.arange(len(q)), np.ones(n, bool)
        before, depth = 0, min(FIRST_DEPTH, n)
        while len(open_) and n:
            met = np.zeros(n, bool)
            met[self.order[before:depth, (q[open_] > 0).any(0)].ravel()] = True
            met[self.order[n - depth:n - before, (q[open_] < 0).any(0)].ravel()] = True
            if depth == n:
                met[:] = True
            new = np.flatnonzero(met & unseen)
            unseen[new] = False
            scores = q[open_] @ self.x[new].T
            bound = pos[open_] @ self.values[depth - 1] + neg[open_] @ self.values[n - depth]
            still = []
            for at, row, limit in zip(open_.tolist(), scores, bound.tolist()):
                best[at] = self._better(best[at], new, row, own[at], k)
                if depth < n and not (len(best[at][0]) == k and best[at][1][-1] > limit):
                    still.append(at)
            open_ = np.array(still, np.int64)
            before, depth = depth, min(n, depth * DEEPER)
        return [(self.ids[at], score) for at, score in best]

    def _better(self, best, new: np.ndarray, scores: np.ndarray, own: int, k: int):
        """The k first by (score falling, place) of ``best`` and the newly scored places."""
        if len(scores) > k:                                # one more, since the own row may be among them
            least = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
            if len(best[0]) == k:
                least = max(least, best[1][-1])
            some = np.flatnonzero(scores >= least)
            new, scores = new[some], scores[some]
        other = self.rows[new] != own
        at, score = np.concatenate([best[0], new[other]]), np.concatenate([best[1], scores[other]])
        first = np.lexsort((at, -score))[:k]
        return at[first], score[first]


def _matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, rows = t.column("id").to_numpy(), t.column("row").to_numpy()
    flat = t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return ids, rows, flat.reshape(len(ids), -1)


def _exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """Doubles where every inner product stays below 2^53, integers otherwise."""
    top = max([int(np.abs(a).max()) for a in arrays if a.size] or [0])
    small = top * top * max(a.shape[1] for a in arrays) < 2**53
    return [a.astype(np.float64 if small else np.int64) for a in arrays]


def valid(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``row, id, v`` (array<long>) of the rows that take part: an id, and only finite numbers.
    ``v`` is floor(64 · x) of each component as a double, ``row`` a number of the row's own; it is fixed
    once the frame is written."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    v = F.transform(vector, lambda x: F.floor(F.lit(64.0) * x.cast("double")))
    return (vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & ok & (F.size(vector) > 0))
            .select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), v.alias("v")))


def search(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score`` from written ``row, id, v`` frames; ``queries`` are rows of ``vectors``.

    A query looks at every vector of its dimension but its own row; rows of one id are queries and
    candidates each.  Fewer than ``k`` others give as many rows; equal scores rank by the smaller id;
    no vectors or no queries give no rows."""
    n, m = vectors.count(), queries.count()
    nb, mb = max(1, -(-n // BLOCK)), max(1, -(-m // QUERY_BLOCK))
    cut = lambda parts, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(parts)).cast("int")
    dim = F.size("v").alias("dim")
    left = vectors.select("row", "id", "v", dim, cut(nb, 1).alias("c"), F.explode(F.sequence(F.lit(0), F.lit(mb - 1))).alias("q"))
    right = queries.select("row", "id", "v", dim, F.explode(F.sequence(F.lit(0), F.lit(nb - 1))).alias("c"), cut(mb, 2).alias("q"))

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        out = []
        if a.num_rows and b.num_rows:                      # a side without rows may lack its columns
            (ids, rows, x), (qids, qrows, qs) = _matrix(a), _matrix(b)
            x, qs = _exact(x, qs)
            lists = Lists(ids, x, rows)
            for at in range(0, len(qids), TOGETHER):
                part = slice(at, at + TOGETHER)
                for qid, own, (got, score) in zip(qids[part], qrows[part], lists.top_many(qrows[part], qs[part], k)):
                    out.append((np.full(len(got), qid), np.full(len(got), own), got, score.astype(np.int64)))
        cols = [np.concatenate(c) if out else np.empty(0, np.int64) for c in (zip(*out) if out else ((),) * 4)]
        return pa.table(dict(zip(("query_id", "row", "vec_id", "score"), cols)))

    keys = ("dim", "c", "q")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        run, "query_id bigint, row bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
