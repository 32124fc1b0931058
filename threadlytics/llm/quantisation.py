"""Embedding near-duplicates by product quantisation.

Unit vectors go to coarse inverted lists with codes of their residual by subspace.  A vector
probes every list whose border is near enough, compares itself with the codes of the list by
table look-ups, and the rest is ranked by exact cosine.  A code's own error is stored and
widens the look-up threshold, so no link of a probed list is lost to quantisation.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlytics.llm.common import components, cut

SAMPLE = 20_000
MOST_LISTS = 1024
SUBSPACES = 8
CODES = 256
CHUNK = 2048
QUERY_BLOCK = 512
FINE = (
    "embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    " and exists(embedding, x -> x <> 0)"
)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a**2).sum(1)[:, None] - 2 * a @ b.T + (b**2).sum(1), 0)


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 1) -> np.ndarray:
    centres = x[np.random.RandomState(seed).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = squared(x, centres).argmin(1)
        count = np.bincount(near, minlength=len(centres))
        sums = np.stack([np.bincount(near, weights=x[:, d], minlength=len(centres)) for d in range(x.shape[1])], 1)
        some = count > 0
        centres[some] = sums[some] / count[some, None]
    return centres


def unit(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@dataclass
class Quantiser:
    """Centres of the lists, and of the residuals by subspace."""

    centres: np.ndarray
    books: list[np.ndarray]
    parts: list[np.ndarray]

    @classmethod
    def fit(cls, x: np.ndarray, lists: int) -> "Quantiser":
        centres = kmeans(x, min(lists, len(x)))
        rest = x - centres[squared(x, centres).argmin(1)]
        parts = [p for p in np.array_split(np.arange(x.shape[1]), min(SUBSPACES, x.shape[1])) if len(p)]
        return cls(centres, [kmeans(rest[:, p], min(CODES, len(x)), 6) for p in parts], parts)

    def encode(self, x: np.ndarray, margin: float):
        """(list, codes, error, probes) of unit vectors.  A list is probed if the border between
        it and the own list is within ``margin``."""
        d = squared(x, self.centres)
        own = d.argmin(1)
        gap = np.sqrt(squared(self.centres, self.centres))[own]
        near = (d - d[np.arange(len(x)), own][:, None]) <= 2 * margin * np.maximum(gap, 1e-12)
        near[np.arange(len(x)), own] = True
        rest = x - self.centres[own]
        codes = np.stack([squared(rest[:, p], b).argmin(1) for p, b in zip(self.parts, self.books)], 1).astype(np.uint8)
        back = np.concatenate([b[codes[:, i]] for i, b in enumerate(self.books)], 1)
        error = np.linalg.norm(rest[:, np.concatenate(self.parts)] - back, axis=1)
        return own, codes, error, near

    def table(self, queries: np.ndarray, which: int) -> list[np.ndarray]:
        """Squared distances of the queries' residuals for a list to every code, by subspace."""
        rest = queries - self.centres[which]
        return [squared(rest[:, p], b) for p, b in zip(self.parts, self.books)]


def vectors_of(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(flat)
    return np.asarray(flat.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(n, -1)


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node of each node's component, for links a[i] - b[i] of nodes 0 to n - 1."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def matches(index: pa.Table, asked: pa.Table, model: Quantiser, which: int, threshold: float) -> pa.Table:
    """Link counts (a, n) and links (a, b) that connect what is linked, of one part of a list."""
    far = np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    y, ys, yn = unit(vectors_of(index.column("embedding"))), index.column("rep").to_numpy(), index.column("n").to_numpy()
    codes = np.frombuffer(b"".join(index.column("codes").to_pylist()), np.uint8).reshape(len(y), -1)
    reach = (far + index.column("error").to_numpy()) ** 2
    probes = np.zeros((len(y), len(model.centres)), bool)
    places = index.column("probes").combine_chunks()
    probes[np.repeat(np.arange(len(y)), np.diff(places.offsets.to_numpy())), places.flatten().to_numpy()] = True
    x, xs, xn = unit(vectors_of(asked.column("embedding"))), asked.column("rep").to_numpy(), asked.column("n").to_numpy()
    home = asked.column("list").to_numpy()
    names, inverse = np.unique(np.concatenate((xs, ys)), return_inverse=True)
    x_at, y_at = inverse[: len(xs)], inverse[len(xs) :]
    links, label = np.zeros(len(names), np.int64), np.arange(len(names))
    for at in range(0, len(x), QUERY_BLOCK):
        q = slice(at, at + QUERY_BLOCK)
        near = np.zeros((len(x[q]), len(y)))
        for i, part in enumerate(model.table(x[q], which)):
            near += part[:, codes[:, i]]
        a, b = np.nonzero((near <= reach) & (xs[q][:, None] != ys))
        if len(a) * 20 > near.size:
            cosine = (x[q] @ y.T)[a, b]
        else:
            cosine = np.einsum("ij,ij->i", x[q][a], y[b])
        good = cosine >= threshold
        a, b = a[good] + at, b[good]
        np.add.at(links, x_at[a], yn[b])
        alone = ~probes[b, home[a]]  # the other side does not probe this one's list
        np.add.at(links, y_at[b[alone]], xn[a[alone]])
        if len(a):
            label = roots(np.concatenate((x_at[a], np.arange(len(names)))), np.concatenate((y_at[b], label)), len(names))
    some, tied = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(names)))
    return pa.table({
        "a": pa.array(np.concatenate((names[some], names[tied])), pa.int64()),
        "b": pa.array([None] * len(some) + names[label[tied]].tolist(), pa.int64()),
        "n": pa.array(np.concatenate((links[some], np.zeros(len(tied), np.int64))), pa.int64()),
    })


def linked(classes: DataFrame, threshold: float, margin: float) -> DataFrame:
    """(a, b, n) of distinct vectors (rep, n, embedding) of one length; see :func:`matches`."""
    total = classes.count()
    sample = classes.select("embedding").orderBy(F.xxhash64("embedding"), "embedding").limit(SAMPLE).toArrow()
    lists = int(min(MOST_LISTS, max(1, np.sqrt(total))))
    model = Quantiser.fit(unit(vectors_of(sample.column("embedding"))), lists)

    def encode(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            own, codes, error, near = model.encode(unit(vectors_of(batch.column("embedding"))), margin)
            row, col = np.nonzero(near)
            bounds = np.concatenate(([0], np.cumsum(near.sum(1)))).astype(np.int32)
            yield pa.record_batch(
                [*batch.columns, pa.array(own.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error),
                 pa.ListArray.from_arrays(pa.array(bounds), pa.array(col.astype(np.int32)))],
                ["rep", "n", "embedding", "list", "codes", "error", "probes"],
            )

    kind = "array<double>"
    coded = cut(
        classes.select("rep", "n", F.col("embedding").cast(kind)).mapInArrow(
            encode, f"rep long, n long, embedding {kind}, list int, codes binary, error double, probes array<int>"
        )
    )
    asked = coded.select("rep", "n", "embedding", "list", F.explode("probes").alias("at"))
    # one row a list: at most MOST_LISTS
    held = {r[0]: r[1] for r in coded.groupBy("list").count().collect()}
    asks = {r[0]: r[1] for r in asked.groupBy("at").count().collect()}
    cuts = [F.array(*(F.lit(max(1, -(-c.get(i, 0) // CHUNK))) for i in range(len(model.centres)))) for c in (held, asks)]

    def cell(which, own):
        return F.pmod(F.xxhash64("rep"), F.element_at(cuts[which], F.col(own) + 1).cast("long"))

    def cells(which, own):
        return F.explode(F.sequence(F.lit(0), F.element_at(cuts[which], F.col(own) + 1) - 1))

    left = coded.select(F.col("list").alias("at"), cell(0, "list").alias("i"), cells(1, "list").alias("j"), "rep", "n", "embedding", "codes", "error", "probes")
    left = left.withColumn("j", F.col("j").cast("long"))
    right = asked.select("at", cells(0, "at").alias("i"), cell(1, "at").alias("j"), "rep", "n", "embedding", "list")
    right = right.withColumn("i", F.col("i").cast("long"))

    def run(index: pa.Table, ask: pa.Table) -> pa.Table:
        if not index.num_rows or not ask.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in "abn"})
        return matches(index, ask, model, ask.column("at")[0].as_py(), threshold)

    return left.groupBy("at", "i", "j").cogroup(right.groupBy("at", "i", "j")).applyInArrow(run, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, margin: float = 0.1) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding).

    Rows of equal vectors are one class, whatever its size; classes are compared, and each row
    gets its class's links and the other rows of the class.  Vectors that are null, empty, zero,
    or hold a null or non-finite component link with nothing.  Vectors of different lengths
    are not compared.  Rows of one vec_id are rows of their own.  A row without a vec_id counts like
    any other but names no component; one without any has a null component_id, and its rows are
    kept.  No link found is below ``threshold``; a pair is missed only where neither
    vector is within ``margin`` of the border to the other's list.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    fine = rows.where(FINE)
    # Classes are numbered as they are written: ids may repeat or be missing.
    classes = fine.groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
    classes = cut(classes.withColumn("rep", F.monotonically_increasing_id()))
    lengths = sorted(r[0] for r in classes.select(F.size("embedding")).distinct().collect())
    found = None
    for length in lengths:
        part = linked(classes.where(F.size("embedding") == length).select("rep", "n", "embedding"), threshold, margin)
        found = part if found is None else found.union(part)
    if found is None:
        found = rows.sparkSession.createDataFrame([], "a long, b long, n long")
    found = cut(found)
    counts = found.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    groups = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "rep")
    told = classes.join(counts, "rep", "left").join(groups, "rep", "left").select(
        "embedding", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component"), "least"
    )
    told = cut(told)
    told = told.join(told.groupBy("component").agg(F.min("least").alias("component_id")), "component").drop("component", "least")
    joined = fine.join(told, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where(f"not coalesce({FINE}, false)").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
