"""Ordinal cumulative-link regression over hashed text features.

Grades are ordered; one score, a sum of shared weights of a text's features, is cut by ordered
thresholds: P(grade > j) = sigmoid(score - threshold j).  It gives an expected grade and the
probability of the top grade, by which documents are selected.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlytics.llm.common import text_bytes

MARKS = b".,;:!?%*&$#|\"'()"
CACHE = 300_000
# Documents at or above this probability of the top grade are selected.
SELECT = 0.3


def grades(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 toxic, 1 poor, 2 good and clean; the lowest of repeated labels."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    known = labels.where("doc_id is not null and quality is not null and toxic is not null")
    return known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(grade).alias("grade"))


def features(text: bytes) -> set[bytes]:
    """The distinct lower-cased words without outer marks, their beginnings, and words for the text's shape."""
    words = text.split()
    n = len(words)
    if not n:
        return {b" empty"}
    raw = set(words)
    found = {w.strip(MARKS) for w in {w.lower() for w in raw}}
    found.discard(b"")
    found |= {b"^" + w[:5] for w in found if len(w) > 5}

    def level(name: bytes, share: float) -> bytes:
        return b" %s %d" % (name, int(share * 20))

    letters = sum(map(text.count, (b"e", b"a", b"n", b"i"))) + 1
    upper = sum(map(text.count, (b"E", b"A", b"N", b"I")))
    marks = text.count(b"%") + text.count(b"*") + text.count(b"$") + text.count(b"#") + text.count(b"&")
    found |= {
        level(b"distinct", len(raw) / n) if n >= 20 else b" short",
        level(b"upper", upper / (upper + letters)),
        level(b"marks", min(1, marks / n)),
        level(b"bars", min(1, text.count(b"|") / n)),
        level(b"shouts", min(1, text.count(b"!") / n)),
        b" words %d" % n.bit_length(),
        b" letters %d" % (len(text) // n),
    }
    return found


@dataclass
class Ordinal:
    """Weights by feature bucket, zero where none is kept, and ascending thresholds."""

    weights: dict[int, float]
    thresholds: np.ndarray
    buckets: int

    def bucket(self, feature: bytes) -> int:
        return zlib.crc32(feature) % self.buckets

    def score(self, found: set[bytes], known: dict[bytes, int]) -> float:
        """The sum over distinct buckets; ``known`` keeps the buckets with a weight of words met."""
        if new := found.difference(known):
            if len(known) + len(new) > CACHE:
                known.clear()
                new = found
            known.update((f, b if (b := self.bucket(f)) in self.weights else -1) for f in new)
        hit = {known[f] for f in found}
        hit.discard(-1)
        return sum(self.weights[b] for b in sorted(hit))

    def tails(self, score: float) -> np.ndarray:
        """P(grade > j) for each threshold j."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - score, -50, 50)))


def train(docs: DataFrame, labels: DataFrame, sample: int = 12_000, buckets: int = 1 << 26, least: int = 4,
          rounds: int = 400, pace: float = 1.0, penalty: float = 2e-5, evidence: float = 4.0) -> Ordinal:
    """Fit on at most ``sample`` labelled documents, those with the smallest hashes of their doc_id.

    Tasks send hashed features; the driver holds the sample's buckets only.  Features of fewer
    than ``least`` sampled documents, or whose share of lower grades is not ``evidence``
    standard deviations above the overall share, have weight zero.  Full-batch AdaGrad in the order of
    doc_id, so reruns agree.  Without labelled documents every text gets the top grade.
    """
    chosen = grades(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes()).join(F.broadcast(chosen), "doc_id")

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            hashed = [np.array(sorted({zlib.crc32(f) % buckets for f in features(t)}), "<u4").tobytes() for t in texts]
            yield pa.record_batch([batch.column("doc_id"), batch.column("grade"), pa.array(hashed, pa.binary())], ["doc_id", "grade", "hashed"])

    got = sorted((r[0], r[1], bytes(r[2])) for r in rows.mapInArrow(run, "doc_id long, grade int, hashed binary").collect())
    return fit([np.frombuffer(h, "<u4") for _, _, h in got], np.array([g for _, g, _ in got], np.int64), buckets, least, rounds, pace, penalty, evidence)


def fit(hashed: list[np.ndarray], y: np.ndarray, buckets: int, least: int = 4, rounds: int = 400,
        pace: float = 1.0, penalty: float = 2e-5, evidence: float = 4.0, top: int = 2) -> Ordinal:
    if not len(y):
        return Ordinal({}, np.full(top, -50.0), buckets)
    used, flat = np.unique(np.concatenate(hashed), return_inverse=True)
    doc = np.repeat(np.arange(len(y)), [len(h) for h in hashed])
    seen = np.bincount(flat)
    low = np.bincount(flat, weights=(y < top)[doc].astype(float))
    share = ((y < top).sum() + 0.5) / (len(y) + 1)
    z = (low - seen * share) / np.sqrt(seen * share * (1 - share))
    telling = (seen >= least) & (z >= evidence)
    keep = telling[flat]
    used, flat, doc = used[telling], (np.cumsum(telling) - 1)[flat[keep]], doc[keep]
    w, past = np.zeros(len(used)), np.full(len(used), 1e-8)
    above = np.array([[g > j for j in range(top)] for g in y], float)
    share = (above.sum(axis=0) + 1) / (len(y) + 2)
    cuts = -np.log(share / (1 - share))
    cut_past = np.full(top, 1e-8)
    for _ in range(rounds):
        score = np.bincount(doc, weights=w[flat], minlength=len(y))
        error = 1 / (1 + np.exp(np.clip(cuts - score[:, None], -50, 50))) - above
        grad = np.bincount(flat, weights=error.sum(axis=1)[doc], minlength=len(used)) / len(y) + penalty * w
        past += grad**2
        w -= pace * grad / np.sqrt(past)
        cut_grad = -error.mean(axis=0)
        cut_past += cut_grad**2
        cuts = np.sort(cuts - pace * cut_grad / np.sqrt(cut_past))
    return Ordinal(dict(zip(used.tolist(), w.tolist())), cuts, buckets)


def rate(docs: DataFrame, model: Ordinal, carry=()) -> DataFrame:
    """(doc_id, expected_grade, tail_probability, and the ``carry`` columns) of every row.

    The tail probability is that of the top grade.  Whole texts are read; null and empty ones
    are rated by what the sample says of empty texts.
    """
    kinds = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carry).schema) if carry else ""

    def run(batches):
        known: dict[bytes, int] = {}
        for batch in batches:
            expected, tail = [], []
            for text in batch.column("__text").to_pylist():
                tails = model.tails(model.score(features(text), known))
                expected.append(float(tails.sum()))
                tail.append(float(tails[-1]))
            yield pa.record_batch(
                [batch.column("__id"), pa.array(expected, pa.float64()), pa.array(tail, pa.float64()), *(batch.column(c) for c in carry)],
                ["doc_id", "expected_grade", "tail_probability", *carry],
            )

    picked = docs.select(F.col("doc_id").cast("long").alias("__id"), text_bytes().alias("__text"), *carry)
    return picked.mapInArrow(run, "doc_id long, expected_grade double, tail_probability double" + kinds)
