"""Line duplicates by a sharded minimal perfect hash over distinct line hashes.

Each shard of the distinct line keys becomes one minimal perfect hash with an array of
fingerprints and one of counts; documents probe the arrays.  Arrays and probes meet by shard,
so neither is ever whole in one place.  Every probe goes through the arrays: a shard that holds
a frequent line gets copies of its arrays, among which its probes are dealt.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlytics.llm.common import cut, text_bytes

STRIPPED = b" \t\n\x0b\f\r"
KEYS_PER_SHARD = 16384
# Probes that meet the arrays of a shard in one task.  Shards with more number fewer than all
# probes divided by this, which bounds what is broadcast to tell them.
CELL = 500_000
GAMMA = 2.0
LEVELS = 64


def line_key(line: bytes, min_chars: int = 1) -> tuple[int, int] | None:
    """96 bits of XXH3-128 of the stripped, A-Z lower-cased line; None if it is too short."""
    key = line.strip(STRIPPED).lower()
    if not key or len(key) < min_chars or (min_chars > 1 and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    value = xxhash.xxh3_128_intdigest(key)
    hi, lo = value >> 64, value & 0xFFFFFFFF
    return hi - ((hi >> 63) << 64), lo - ((lo >> 31) << 32)


def _mixed(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    return hi.astype(np.int64).view(np.uint64) ^ (lo.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    x = keys + np.uint64((level + 1) * 0xD1B54A32D192ED03 % 2**64)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return (x % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Minimal perfect hash: levels of bits, one bit for each key that is alone in its slot there."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, base = [], 0
        for bits in levels:
            ranks = np.cumsum(bits, dtype=np.int64) - 1 + base
            base += int(bits.sum())
            self.ranks.append(ranks)

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        levels = []
        while len(keys):
            if len(levels) == LEVELS:
                raise ValueError("two keys with equal hashes in a shard")
            size = max(16, int(GAMMA * len(keys)))
            at = _slots(keys, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[at]]
        return cls(levels)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Places 0 to n - 1 of the keys that it was built for; -1 or any place for others."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            at = _slots(keys[open_], level, len(bits))
            hit = bits[at]
            out[open_[hit]] = ranks[at[hit]]
            open_ = open_[~hit]
        return out

    def dump(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], "<u4").tobytes()
        return sizes + b"".join(np.packbits(b).tobytes() for b in self.levels)

    @classmethod
    def load(cls, raw: bytes) -> "PerfectHash":
        n = int(np.frombuffer(raw, "<u4", 1)[0])
        levels, at = [], 4 * (n + 1)
        for size in np.frombuffer(raw, "<u4", n, 4).tolist():
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, -(-size // 8), at), count=size).astype(bool))
            at += -(-size // 8)
        return cls(levels)


def probes(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """(doc_id, seal, hi, lo): the distinct line keys of every row; ``seal`` is a hash of its text."""

    def run(batches):
        for batch in batches:
            ids, seals, his, los = [], [], [], []
            for doc, seal, text in zip(*(c.to_pylist() for c in batch.columns)):
                keys = {line_key(line, min_chars) for line in text.split(b"\n")}
                keys.discard(None)
                ids.extend([doc] * len(keys))
                seals.extend([seal] * len(keys))
                his.extend(k[0] for k in keys)
                los.extend(k[1] for k in keys)
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(seals, pa.int64()), pa.array(his, pa.int64()), pa.array(los, pa.int32())],
                ["doc_id", "seal", "hi", "lo"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("seal"), text_bytes())
    return rows.mapInArrow(run, "doc_id long, seal long, hi long, lo int")


def build_index(counts: DataFrame) -> DataFrame:
    """(shard, hash, fingerprints, counts) from (shard, hi, lo, n): the arrays of every shard."""

    def run(group: pa.Table) -> pa.Table:
        hi, lo, n = (group.column(c).to_numpy() for c in ("hi", "lo", "n"))
        mph = PerfectHash.build(keys := _mixed(hi, lo))
        place = mph.index(keys)
        prints, numbers = np.zeros(len(keys), "<i4"), np.zeros(len(keys), "<u4")
        prints[place], numbers[place] = lo, np.minimum(n, 2**32 - 1)
        row = {"shard": [group.column("shard")[0].as_py()], "hash": [mph.dump()], "fingerprints": [prints.tobytes()], "counts": [numbers.tobytes()]}
        return pa.table(row, pa.schema([("shard", pa.int64()), *((c, pa.binary()) for c in ("hash", "fingerprints", "counts"))]))

    return counts.groupBy("shard").applyInArrow(run, "shard long, hash binary, fingerprints binary, counts binary")


def probe(rows: DataFrame, index: DataFrame, min_docs: int) -> DataFrame:
    """The (doc_id, seal, hi, lo) of ``rows`` whose count in the index is ``min_docs`` or more.

    Both sides meet by shard and copy.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.select(["doc_id", "seal", "hi", "lo"])
        if not left.num_rows or not right.num_rows:
            return left.slice(0, 0)
        hi, lo = left.column("hi").to_numpy(), left.column("lo").to_numpy()
        mph = PerfectHash.load(right.column("hash")[0].as_py())
        prints = np.frombuffer(right.column("fingerprints")[0].as_py(), "<i4")
        numbers = np.frombuffer(right.column("counts")[0].as_py(), "<u4")
        place = mph.index(_mixed(hi, lo))
        hit = (place >= 0) & (prints[place] == lo) & (numbers[place] >= min_docs)
        return left.filter(pa.array(hit))

    by = ["shard", "copy"]
    return rows.groupBy(*by).cogroup(index.groupBy(*by)).applyInArrow(run, "doc_id long, seal long, hi long, lo int")


def drop_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, carry=(), cell: int = CELL) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped, and the ``carry`` columns) of every row.

    A line goes if its key, stripped and lower-cased, has ``min_chars`` code points and is in
    ``min_docs`` rows; the other lines stay as they are, joined by a newline.  Null and empty
    texts are one empty line.  Rows that share a doc_id, or have none, count as rows of their own;
    they get their hits back by doc_id and a hash of the text, which tell rows apart as far as
    their lines differ.  An empty table gives no rows.
    """
    rows = cut(probes(docs, min_chars))
    counts = cut(rows.groupBy("hi", "lo").agg(F.count("*").alias("n")))
    shard = F.pmod(F.col("hi"), F.lit(max(1, -(-counts.count() // KEYS_PER_SHARD)))).alias("shard")
    sharded = counts.select(shard, "hi", "lo", "n")
    # Shards with more probes than a cell takes: fewer than all probes divided by that.
    crowded = F.broadcast(
        cut(sharded.groupBy("shard").agg(F.sum("n").alias("all")).where(F.col("all") > cell).select(
            "shard", F.ceil(F.col("all") / cell).cast("int").alias("copies")
        ))
    )
    copies = F.coalesce("copies", F.lit(1))
    index = build_index(sharded).join(crowded, "shard", "left").withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    dealt = rows.select(shard, "doc_id", "seal", "hi", "lo").join(crowded, "shard", "left")
    dealt = dealt.withColumn("copy", F.pmod(F.xxhash64("doc_id", "seal"), copies).cast("int"))
    hits = probe(dealt.drop("copies"), index.drop("copies"), min_docs)
    by_doc = hits.groupBy("doc_id", "seal").agg(F.collect_set(F.struct("hi", "lo")).alias("hits"))
    by_doc = by_doc.select(
        F.col("doc_id").alias("hit_id"), F.col("seal").alias("hit_seal"),
        F.col("hits.hi").alias("hits_hi"), F.col("hits.lo").alias("hits_lo"),
    )
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_bytes(), F.xxhash64("text").alias("__seal"), *carry
    )
    same = (F.col("__seal") == F.col("hit_seal")) & F.col("doc_id").eqNullSafe(F.col("hit_id"))
    joined = base.join(by_doc, same, "left").drop("hit_id", "hit_seal", "__seal")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carry).schema) if carry else ""
    schema = "doc_id long, text string, n_lines long, n_dropped long" + (", " + kinds if kinds else "")

    def run(batches):
        for batch in batches:
            his, los = (batch.column(c).to_pylist() for c in ("hits_hi", "hits_lo"))
            texts, lines, dropped = [], [], []
            for text, a, b in zip(batch.column("text").to_pylist(), his, los):
                parts = text.split(b"\n")
                gone = set(zip(a, b)) if a else ()
                kept = [p for p in parts if line_key(p, min_chars) not in gone] if gone else parts
                texts.append(b"\n".join(kept))
                lines.append(len(parts))
                dropped.append(len(parts) - len(kept))
            columns = [batch.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
            yield pa.record_batch([*columns, *(batch.column(c) for c in carry)], ["doc_id", "text", "n_lines", "n_dropped", *carry])

    return joined.mapInArrow(run, schema)
