"""Secrets in texts: fixed patterns, and random strings told by character Markov models.

One first-order model of random strings and one of ordinary identifiers are trained from
labelled strings of a bounded sample of documents; a candidate whose log-likelihood ratio is
high enough is a further span.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlytics.llm.common import text_bytes

# Fixed patterns of the contract.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
RUN = re.compile(rb"[A-Za-z0-9+/_.=-]{4,}")
LONG = 20  # characters of a candidate; shorter runs outside the fixed patterns count as ordinary
CANDIDATE = re.compile(rb"[A-Za-z0-9+/_.=-]{%d,}" % LONG)
CODE = np.full(256, -1, np.int64)
CODE[np.frombuffer(ALPHABET, np.uint8)] = np.arange(len(ALPHABET))
N = len(ALPHABET)


def long_words(text: bytes, least: int):
    """(start, word) of the words of ``least`` bytes or more: a run without spaces lies in one word."""
    at = 0
    for word in text.split():
        if len(word) >= least:
            at = text.index(word, at)
            yield at, word
            at += len(word)


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes of the fixed patterns, kind as an index of ``KINDS``."""
    spans = []
    low = text.lower()
    if any(w in low for w in WORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    for at, word in long_words(text, 24):
        spans += [(at + m.start(), 2, at + m.end()) for m in HEX.finditer(word) if len(m[0]) >= 24]
    return sorted(spans)


def transitions(text: bytes) -> np.ndarray:
    """Codes previous * N + next of the character pairs of an identifier."""
    codes = CODE[np.frombuffer(text, np.uint8)]
    return codes[:-1] * N + codes[1:]


def samples(text: bytes) -> tuple[list[bytes], list[bytes]]:
    """Labelled strings of a text: values of secrets, and ordinary identifiers, too short to be judged, outside of them."""
    spans = base_spans(text)
    secrets = [ASSIGN.match(text, a)[2] if kind == 0 else text[a:b] for a, kind, b in spans]
    plain, at = [], 0
    for a, _, b in [*spans, (len(text), 0, len(text))]:
        plain += [w for w in RUN.findall(text[at : max(at, a)]) if len(w) < LONG]
        at = max(at, b)
    return secrets, plain


def drawn(count: int = 2000, seed: int = 7) -> list[bytes]:
    """Random strings over common alphabets, labelled random by how they are made."""
    rng = random.Random(seed)
    alphabets = (ALPHABET[:62], ALPHABET[:64], ALPHABET[26:62], ALPHABET[:26] + ALPHABET[52:62], b"0123456789abcdef")
    return [bytes(rng.choices(alphabets[i % len(alphabets)], k=rng.randint(20, 60))) for i in range(count)]


class Ratio:
    """Log-likelihood ratio of random strings against ordinary identifiers, by character pairs.

    A character seldom or never seen before another falls back on how often it is seen at all.
    """

    def __init__(self, random_counts: np.ndarray, plain_counts: np.ndarray, smooth: float = 5.0):
        tables = []
        for counts in (random_counts, plain_counts):
            pairs = counts.reshape(N, N)
            alone = pairs.sum(axis=0) + 0.5
            pairs = pairs + smooth * alone / alone.sum()
            tables.append(np.log(pairs / pairs.sum(axis=1, keepdims=True)).ravel())
        self.table = tables[0] - tables[1]

    def __call__(self, text: bytes) -> float:
        return float(self.table[transitions(text)].sum())


def train(docs: DataFrame, sample: int = 4000) -> Ratio:
    """Fit both models on the documents with the ``sample`` smallest hashes of their doc_id.

    Tasks send sums of character pairs, N * N for each label, whatever the texts hold.
    """
    ids = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = docs.select("doc_id", text_bytes()).join(F.broadcast(ids.distinct()), "doc_id", "left_semi")

    def run(batches):
        sums = np.zeros((2, N * N), np.int64)
        for batch in batches:
            for text in batch.column(1).to_pylist():
                for label, strings in enumerate(samples(text)):
                    for s in strings:
                        np.add.at(sums[label], transitions(s), 1)
        label, pair = np.nonzero(sums)
        yield pa.record_batch([pa.array(label), pa.array(pair), pa.array(sums[label, pair])], ["label", "pair", "n"])

    counts = np.zeros((2, N * N))
    for label, pair, n in chosen.mapInArrow(run, "label long, pair long, n long").groupBy("label", "pair").agg(F.sum("n")).collect():
        counts[label, pair] = n
    for s in drawn():
        np.add.at(counts[0], transitions(s), 1)
    return Ratio(*counts)


def all_spans(text: bytes, base: list[tuple[int, int, int]], ratio: Ratio, threshold: float, per_char: float):
    """``base`` and the candidates outside of it that look random by the models."""
    found = []
    starts = [x for x, _, _ in base]
    ends = list(accumulate((y for _, _, y in base), max))  # the furthest end so far
    for at, word in long_words(text, LONG):
        for m in CANDIDATE.finditer(word):
            a, b = at + m.start(), at + m.end()
            before = bisect_left(starts, b)
            if before and ends[before - 1] > a:
                continue
            score = ratio(m[0])
            if score >= threshold and score >= per_char * (len(m[0]) - 1):
                found.append((a, 3, b))
    return sorted(base + found)


def written(text: bytes, spans) -> str:
    """kind:start:end in code points, comma-joined."""
    if not spans:
        return ""
    if not text.isascii():
        opening = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80  # first bytes of code points
        places = np.concatenate(([0], np.cumsum(opening)))
        spans = [(places[a], k, places[b]) for a, k, b in spans]
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, ratio: Ratio, threshold: float = 20.0, per_char: float = 2.0) -> DataFrame:
    """(doc_id, base, spans, n_assign, n_access, n_hex) of every row, spans as written lists.

    Null and empty texts have none.  A candidate of the models is a run of 20 or more
    identifier characters outside the fixed patterns; it is a span if its log-likelihood ratio
    reaches ``threshold`` in all and ``per_char`` on average.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text)
                every = all_spans(text, base, ratio, threshold, per_char)
                n = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                rows.append((written(text, base), written(text, every), *n))
            base, every, *n = zip(*rows) if rows else ((),) * 5
            yield pa.record_batch(
                [batch.column(0), pa.array(base, pa.string()), pa.array(every, pa.string()), *(pa.array(x, pa.int64()) for x in n)],
                ["doc_id", "base", "spans", "n_assign", "n_access", "n_hex"],
            )

    schema = "doc_id long, base string, spans string, n_assign long, n_access long, n_hex long"
    return docs.select(F.col("doc_id").cast("long"), text_bytes()).mapInArrow(run, schema)
