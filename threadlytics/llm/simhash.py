"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all variants within half the radius; two fingerprints
within the radius meet in at least one variant.  Variants are shuffled, colliding pairs are
made distinct and their distance is verified.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadlytics.llm.common import components, cut, text_bytes

BITS = 64
BLOCK = 65536


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the lower-cased word shingles of a text, repeats included.

    A bit is set if it is set in more than half of the shingles' XXH64.  Fewer words than a
    shingle make one shingle of all words; no word gives zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    k = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    first, last = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    hashed = xxhash.xxh64_intdigest
    hashes = np.fromiter((hashed(joined[a:b], seed) for a, b in zip(first, last)), ">u8", len(first))
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), BLOCK):
        bits = np.unpackbits(hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp) of every row, fp as a signed long."""
    return with_fingerprints(docs.select(F.col("doc_id").cast("long"), "text"), shingle).select("doc_id", "fp")


def with_fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """The rows of ``docs`` with their ``fp``."""

    def run(batches):
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in batch.column("__text").to_pylist()]
            fp = pa.array(np.array(fps, np.uint64).view(np.int64))
            yield pa.record_batch([*(batch.column(c) for c in kept), fp], [*kept, "fp"])

    kept = [c for c in docs.columns if c != "text"]
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name != "text")
    return docs.select(*kept, text_bytes().alias("__text")).mapInArrow(run, kinds + "fp long")


def colliding(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b) between distinct fingerprints of column ``fp`` that connect the same groups
    as all pairs within ``radius`` bits.

    A variant's bucket holds only fingerprints of one ball, C(64, radius / 2) at most however
    many rows there are, as fingerprints are distinct.  With an even radius all of a bucket lie
    within the radius, so each is linked with the next one in order; with an odd one a bucket's
    pairs are tried.
    """
    if radius < 1:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    half = (radius + 1) // 2
    masks = [sum(1 << b for b in c) for n in range(half + 1) for c in combinations(range(BITS), n)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    balls = fps.select("fp", F.explode(F.array(*map(F.lit, signed))).alias("mask")).select(
        F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"), "fp"
    )
    if radius % 2:
        other = balls.select("variant", F.col("fp").alias("b"))
        pairs = balls.withColumnRenamed("fp", "a").join(other, "variant").where("a < b").select("a", "b")
    else:
        before = F.lag("fp").over(Window.partitionBy("variant").orderBy("fp"))
        pairs = balls.select(before.alias("a"), F.col("fp").alias("b")).where("a is not null")
    return pairs.distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def fingerprint_classes(fps: DataFrame, radius: int) -> DataFrame:
    """(fp, component, component_id) of the fingerprints in (doc_id, fp)."""
    least = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    linked = components(colliding(least.select("fp"), radius))
    joined = least.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
    joined = joined.withColumn("component", F.coalesce("component", "fp"))
    root = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    return cut(joined.join(root, "component").select("fp", "component", "component_id"))


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fp, component_id): groups of documents linked by fingerprints within ``radius`` bits.

    ``component_id`` is the smallest doc_id of the group, the row's own if it has no other; null
    if no row of the group has one.  Null and empty texts have fingerprint zero and are linked
    like any other.  Rows with the same doc_id stay rows.  An empty table gives no rows; other
    columns are ignored.
    """
    rows = cut(fingerprints(docs, shingle))
    return rows.join(fingerprint_classes(rows, radius), "fp").select("doc_id", "fp", "component_id")


def _order(docs: DataFrame, names: list[str]) -> list:
    """``names`` as columns that can be compared; maps, and what holds them, as JSON text."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    return [F.to_json(F.struct(n)) if "map<" in kinds[n] or "variant" in kinds[n] else F.col(n) for n in names]


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row of ``docs`` of each group: that of the group's smallest doc_id.

    Rows that repeat a kept doc_id count as copies: the one with the smallest text (null first),
    then the smallest other columns, stays.  Rows without a doc_id are copies of any that have
    one; in a group without any doc_id the row with the smallest text stays.
    """
    rows = cut(fingerprints(docs, shingle))
    classes = fingerprint_classes(rows, radius)
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    least = F.min_by(F.struct("text", *rest), F.struct("text", *_order(docs, rest))).alias("row")
    winners = classes.select(F.col("component_id").alias("doc_id")).where("doc_id is not null").distinct()
    named = docs.join(winners, "doc_id", "left_semi").groupBy("doc_id").agg(least).select("doc_id", "row.*")
    bare = docs.where("doc_id is null")
    marked = with_fingerprints(bare.select(*[F.col(c).alias(f"__of_{c}") for c in docs.columns], "text"), shingle)
    alone = classes.where("component_id is null").select("fp", "component")
    nameless = marked.join(alone, "fp").select("component", *[F.col(f"__of_{c}").alias(c) for c in docs.columns])
    nameless = nameless.groupBy("component").agg(least).select(F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), "row.*")
    return named.select(*docs.columns).union(nameless.select(*docs.columns))
