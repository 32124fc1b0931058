"""Exact top-k by inner product over an impact-ordered index, score at a time.

A block of vectors is indexed by dimension: the postings (vector, integer value) of a dimension
are sorted by value and cut into segments of equal quantised impact.  A query takes all
segments in descending order of the size of their contribution and adds them up.  It stops when a proof
holds: nothing outside of a small set can still reach the k-th best score, neither of the block
nor of a first block that every query was scored against before.  The set is scored again exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadlytics.llm.common import cut

BLOCK = 4096
QUERIES = 16384  # of a task: what is done again when it is lost
QUANTUM = 4  # values of a segment share floor(value / QUANTUM)
ROUNDS = 16
LEAST = -(2**63)
EARLIEST = 0.3  # share of the postings below which no proof is tried


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v) with v = floor(scale * x) by component, x as double.

    Vectors that are null, empty, or hold a null or non-finite component take no part, and
    neither do rows without a vec_id, which nothing could name.
    """
    v = F.expr(f"transform(embedding, x -> cast(floor({scale} * cast(x as double)) as bigint))")
    fine = "vec_id is not null and embedding is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    return vectors.where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


class ImpactIndex:
    """Postings of one block of vectors, by dimension and descending value."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        n, dims = matrix.shape
        self.n, self.dims = n, dims
        order = np.argsort(-matrix, axis=0, kind="stable")
        self.ids = np.ascontiguousarray(order.T.astype(np.int32))
        self.values = np.ascontiguousarray(np.take_along_axis(matrix, order, axis=0).T)
        dim, start, top, low = [], [], [], []
        for d in range(dims):
            quantum = self.values[d] // QUANTUM
            at = np.flatnonzero(np.concatenate(([True], quantum[1:] != quantum[:-1])))
            dim.append(np.full(len(at), d))
            start.append(at)
            top.append(self.values[d][at])
            low.append(self.values[d][np.concatenate((at[1:], [n])) - 1])
        self.dim, self.start = np.concatenate(dim), np.concatenate(start)
        self.top, self.low = np.concatenate(top), np.concatenate(low)
        self.end = np.concatenate((self.start[1:], [0]))
        self.end[self.end == 0] = n
        self.flat_ids, self.flat_values = self.ids.ravel(), self.values.ravel().astype(float)

    def search(self, query: np.ndarray, k: int, skip: int = -1, floor: int = LEAST) -> list[tuple[int, int]]:
        """(score, place) of every vector that can be among the best k, exactly scored, and no fewer
        than those of the best k, with all their ties, that reach ``floor``.  ``skip`` is the place
        of the query itself."""
        n = self.n
        others = n - (skip >= 0)
        if others <= k:
            possible = np.arange(n)
            return [(int(s), int(p)) for p, s in zip(possible, self.matrix @ query) if p != skip]
        q = query[self.dim]
        impact = np.maximum(np.abs(q * self.top), np.abs(q * self.low))
        order = np.argsort(-impact, kind="stable")
        sorted_impact = impact[order]
        sizes = (self.end - self.start)[order]
        done = np.cumsum(sizes)
        score, seen = np.zeros(n), np.zeros(n, np.int64)
        cuts = np.searchsorted(done, np.linspace(0, done[-1], ROUNDS + 1)[1:], side="left") + 1
        at = 0
        for upto in np.unique(np.minimum(cuts, len(order))):
            picked = order[at:upto]
            if not len(picked):
                continue
            length = sizes[at:upto]
            base = np.repeat(self.dim[picked] * n + self.start[picked] - (np.cumsum(length) - length), length)
            places = base + np.arange(int(length.sum()))
            ids = self.flat_ids[places]
            gain = np.repeat(q[picked].astype(float), length) * self.flat_values[places]
            score += np.bincount(ids, weights=gain, minlength=n)
            seen += np.bincount(ids, minlength=n)
            at = upto
            rest = float(sorted_impact[at]) if at < len(order) else 0.0
            if done[at - 1] < EARLIEST * done[-1]:
                continue
            slack = (self.dims - seen) * rest  # what the segments to come can add or take, at most
            least = score - slack
            if skip >= 0:
                least[skip] = -np.inf
            bound = np.partition(least, n - k)[n - k]  # the k-th best score is no lower
            possible = np.flatnonzero(score + slack >= max(bound, floor))
            if len(possible) <= max(16 * k, n // 16) or not rest:
                break
        exact = self.matrix[possible] @ query
        return [(int(s), int(p)) for p, s in zip(possible, exact) if p != skip]


def by_length(ids: list[int], vectors: list[list[int]]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """{length: (ids in ascending order, their vectors)}."""
    places: dict[int, list[int]] = {}
    for i, v in enumerate(vectors):
        places.setdefault(len(v), []).append(i)
    out = {}
    for length, at in places.items():
        names = np.array([ids[i] for i in at], np.int64)
        order = np.argsort(names, kind="stable")
        out[length] = names[order], np.array([vectors[at[i]] for i in order], np.int64)
    return out


def floors(queries: DataFrame, first: dict[int, tuple[np.ndarray, np.ndarray]], k: int) -> DataFrame:
    """``queries`` with floor: the k-th best score of each among the rows ``first``, its own aside.

    A query that meets fewer than k other rows there has the least long.
    """

    def run(batches):
        for batch in batches:
            found = []
            for q, v in zip(batch.column("vec_id").to_pylist(), batch.column("v").to_pylist()):
                names, matrix = first.get(len(v), (np.zeros(0, np.int64), np.zeros((0, len(v)), np.int64)))
                scores = (matrix @ np.array(v, np.int64))[names != q]
                found.append(int(np.partition(scores, -k)[-k]) if len(scores) >= k else LEAST)
            yield pa.record_batch([*batch.columns, pa.array(found, pa.int64())], ["vec_id", "v", "floor"])

    return queries.select("vec_id", "v").mapInArrow(run, "vec_id long, v array<long>, floor long")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best other rows, ties to the smaller vec_id.

    Both frames hold (vec_id, v), v an array of integers; a query scores every row of
    ``vectors`` but those with its own vec_id.  Vectors of another length than the query's take
    no part in its search.  Rows of one vec_id are rows of their own.

    Vectors are numbered into written blocks of about ``BLOCK``, whatever their ids.  A task
    holds one block, indexes it once and answers up to ``QUERIES`` queries as they stream by;
    vectors travel once per that many queries.  Up to ``BLOCK`` rows of the first block are
    sent to all tasks, for the score that a query's best must reach.  Only the best k of a
    query and block are shuffled.
    """
    blocks = max(1, -(-vectors.count() // BLOCK))
    parts = max(1, -(-queries.count() // QUERIES))
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks))
    stored = cut(vectors.select(place.alias("block"), "vec_id", F.col("v").cast("array<long>").alias("v")))
    first = stored.where("block = 0").select("vec_id", "v").limit(BLOCK).collect()
    first = by_length([r[0] for r in first], [r[1] for r in first])
    left = stored.select(
        "block", F.explode(F.expr(f"sequence(0L, {parts - 1}L)")).alias("part"), F.lit(0).alias("kind"), "vec_id", "v", F.lit(None).cast("long").alias("floor")
    )
    right = floors(queries.select("vec_id", F.col("v").cast("array<long>").alias("v")), first, k).select(
        F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")).alias("block"),
        F.pmod(F.xxhash64("vec_id", "v"), F.lit(parts)).alias("part"), F.lit(1).alias("kind"), "vec_id", "v", "floor",
    )
    task = (F.col("block") * parts + F.col("part")).cast("int")

    def run(batches):
        at, ids, held, indexes = None, [], [], None
        for batch in batches:
            out = []
            for *key, kind, name, v, floor in zip(*(c.to_pylist() for c in batch.columns)):
                if key != at:
                    at, ids, held, indexes = key, [], [], None
                if kind == 0:
                    ids.append(name)
                    held.append(v)
                    continue
                if indexes is None:
                    indexes = {n: (names, ImpactIndex(matrix)) for n, (names, matrix) in by_length(ids, held).items()}
                    held = []
                if len(v) not in indexes:
                    continue
                names, index = indexes[len(v)]
                a, b = np.searchsorted(names, name), np.searchsorted(names, name, side="right")
                found = index.search(np.array(v, np.int64), k + max(0, b - a - 1), int(a) if b > a else -1, floor)
                best = sorted((-s, int(names[p])) for s, p in found if names[p] != name and s >= floor)[:k]
                out.extend((name, other, -s) for s, other in best)
            columns = zip(*out) if out else ((),) * 3
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    # a block's vectors come before the queries that are put to it
    dealt = left.union(right).repartitionById(blocks * parts, task).sortWithinPartitions("block", "part", "kind")
    best = dealt.mapInArrow(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
