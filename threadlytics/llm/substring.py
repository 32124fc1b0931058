"""Substring duplicates by relative Lempel-Ziv parsing against an index of the whole corpus.

Every document is both parsed and part of the reference.  The reference is indexed by blocks
whose borders follow the content: windows of ``window`` words whose smallest ``anchor``-word
gram is the same gram make one block, so equal passages are cut into equal blocks wherever
they stand.  The index holds two occurrences of a block, the first and the last of all.

A document is parsed greedily from its first block on: a factor holds all places of the index
that its blocks can be copied from and goes on while one of them does.  At a factor's boundary,
in a block that is not held whole but whose anchor is known, windows are looked up one by one,
so factors end at the word where the copy ends.  Neighbouring factors overlap by what a window
reaches over, so that every factor has ``window`` words or more and none of a copy is left over.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlytics.llm.common import among, cut, text_bytes

PLACE_BITS = 24  # positions in a piece of text; a longer text is parsed in overlapping pieces
PIECE = 1 << 20
MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
CACHE = 500_000


class WordHashes(dict):
    """XXH3 of words met, kept while there is room."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHE:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def powers_of(base: int, size: int) -> np.ndarray:
    factors = np.full(size, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


class Powers:
    """Powers of the multiplier and of its inverse modulo 2^64, as far as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 4096)
            self.up = powers_of(MULTIPLIER, size)
            self.down = powers_of(INVERSE, size)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Hashes:
    """Hashes of any run of a list of word hashes, from one running sum."""

    def __init__(self, words: np.ndarray, powers: Powers):
        powers.grow(len(words) + 1)
        self.powers = powers
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * powers.up[: len(words)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.powers.down[start] + (end - start).astype(np.uint64))

    def all(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return mixed((self.sums[length:] - self.sums[:n]) * self.powers.down[:n] + np.uint64(length))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if span < width else x


def blocks(words: np.ndarray, powers: Powers, window: int, anchor: int):
    """(anchor hash, block hash, start, windows) of the blocks of a text's word hashes.

    A block's ``windows`` windows start at ``start`` and the following words; each has the
    block's anchor as its smallest gram, the first one among equals.  A long text is cut into
    pieces that overlap by a window less one word, so no window is lost.
    """
    parts = []
    for at in range(0, max(1, len(words) - window + 1), PIECE):
        piece = words[at : at + PIECE + window - 1]
        if len(piece) < window:
            continue
        hashes = Hashes(piece, powers)
        grams = hashes.all(anchor)
        low = np.uint64((1 << PLACE_BITS) - 1)
        least = sliding_min((grams & ~low) | np.arange(len(grams), dtype=np.uint64), window - anchor + 1)
        place = (least & low).astype(np.int64)
        start = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        end = np.concatenate((start[1:], [len(place)]))
        parts.append((grams[place[start]], hashes.of(start, end + window - 1), start + at, end - start))
    if not parts:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*parts))


KEY = ["doc_id", "th"]
STEP = 4096  # a place is start * STEP + windows


def index_rows(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(doc_id, th, a, h, place): every block of every row, a its anchor's and h its own hash."""

    def run(batches):
        words, powers = WordHashes(), Powers()
        for batch in batches:
            parts, sizes = [], []
            for text in batch.column("text").to_pylist():
                parts.append(blocks(words.of(text.split()), powers, window, anchor))
                sizes.append(len(parts[-1][0]))
            if not parts:
                continue
            a, h, start, n = (np.concatenate(c) for c in zip(*parts))
            key = [batch.column(c).take(pa.array(np.repeat(np.arange(len(sizes)), sizes))) for c in KEY]
            yield pa.record_batch(
                [*key, pa.array(a.view(np.int64)), pa.array(h.view(np.int64)), pa.array(start * STEP + n)], [*KEY, "a", "h", "place"]
            )

    return docs.mapInArrow(run, "doc_id long, th int, a long, h long, place long")


def window_rows(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, th, place, whole, w) for each window of the blocks that stand in ``edges``."""

    def run(batches):
        words, powers = WordHashes(), Powers()
        for batch in batches:
            row, place, whole, w = [], [], [], []
            for i, (text, edges) in enumerate(zip(batch.column("text").to_pylist(), batch.column("edges").to_pylist())):
                hashes = Hashes(words.of(text.split()), powers)
                for edge in edges:
                    start, n = divmod(edge["place"], STEP)
                    starts = np.arange(start, start + n)
                    w.append(hashes.of(starts, starts + window))
                    place.append(starts * STEP + 1)
                    row += [i] * n
                    whole += [edge["whole"]] * n
            if row:
                yield pa.record_batch(
                    [*(batch.column(c).take(pa.array(row)) for c in KEY), pa.array(np.concatenate(place)), pa.array(whole), pa.array(np.concatenate(w).view(np.int64))],
                    [*KEY, "place", "whole", "w"],
                )

    return docs.mapInArrow(run, "doc_id long, th int, place long, whole boolean, w long")


def other(first: str = "first", last: str = "last"):
    """Columns s1, s2: the places ``first`` and ``last``, or the one of them that is not the row's own."""
    own = {name: F.col(name) == F.struct(*KEY, "place") for name in (first, last)}
    return (
        F.when(own[first], F.col(last)).otherwise(F.col(first)).alias("s1"),
        F.when(own[last], F.col(first)).otherwise(F.col(last)).alias("s2"),
    )


def copies(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(doc_id, th, place, s1, s2): runs of windows of ``docs`` (doc_id, th, text) that also start at s1 and s2.

    All counts are folded before they are shuffled, and rows of a passage that very many
    documents hold are dealt to many tasks when they meet their counts.
    """
    by = [*KEY, "place"]
    ends = F.min(F.struct(*by)).alias("first"), F.max(F.struct(*by)).alias("last")
    rows = cut(index_rows(docs, window, anchor))
    known = cut(rows.groupBy("a").agg(F.count("*").alias("c")).where("c > 1"))
    held = cut(among(rows, known, ["a"], by))
    distinct = cut(held.groupBy("a", "h").agg(F.count("*").alias("c"), *ends))
    whole = among(held, distinct.where("c > 1"), ["a", "h"], by, ("first", "last")).select(*by, *other())
    # anchors with several blocks: where a factor ends inside one of them
    firsts = distinct.select("a", "first.*", (F.col("c") > 1).alias("whole"))
    open_ = cut(firsts.groupBy("a").agg(F.count("*").alias("c")).where("c > 1"))
    edges = among(firsts, open_, ["a"], by)
    by_doc = edges.groupBy(*KEY).agg(F.collect_list(F.struct("place", "whole")).alias("edges"))
    windows = cut(window_rows(docs.join(by_doc, KEY), window))
    again = cut(windows.groupBy("w").agg(F.count("*").alias("c")).where("c > 1"))
    met = cut(among(windows, again, ["w"], by))
    sources = cut(met.groupBy("w").agg(F.count("*").alias("c"), *ends))
    return whole.union(among(met, sources, ["w"], by, ("first", "last")).where("not whole").select(*by, *other()))


def parse(runs, window: int) -> list[tuple[int, int, tuple[int, int, int]]]:
    """Greedy factors (start, length, (doc_id, th, start) of the source) of one document.

    ``runs`` are (start, windows, sources): windows at ``start`` and the following words that
    are copies of those at each source.  A factor goes on while a run follows without a gap and
    shares a source with all runs before it; of several sources left at its end the least counts.
    """
    found, start, reach, alive = [], 0, -1, set()
    for at, n, sources in sorted(runs):
        here = {(doc, th, place - at) for doc, th, place in sources}
        if at <= reach and not alive.isdisjoint(here):
            alive &= here
            reach = max(reach, at + n)
            continue
        if alive:
            found.append((start, reach - start + window - 1, min(alive)))
        start, reach, alive = at, at + n, here
    if alive:
        found.append((start, reach - start + window - 1, min(alive)))
    return [(start, length, (doc, th, start + shift)) for start, length, (doc, th, shift) in found]


NO_ID = -(2**63)  # stands for a null doc_id in keys
RESULT = "doc_id long, text string, n_words long, n_removed long, factors array<struct<start:long,length:long,source:long,source_start:long>>"


def drop_repeats(docs: DataFrame, window: int = 35, anchor: int = 8) -> DataFrame:
    """(doc_id, text, n_words, n_removed, factors) of every row: ``text`` holds the words that stay, joined by a space.

    A word goes if a factor covers it, and so if one of the ``window``-word windows that cover
    it has a word sequence that starts anywhere else as well, in the same row or another.
    ``factors`` are (start, length) in words with the doc_id and the word they can be copied
    from, in order; a row without copies has none.  Words are runs of characters other than ASCII
    white space, compared as they are.  Null and empty texts have none; rows that share a
    doc_id are rows of their own, and equal texts are repeats of each other.  Runs are compared
    by 64-bit hashes, a block by its anchor's and its own together.
    """
    if not 0 < anchor <= window < STEP:
        raise ValueError("the anchor must fit into the window")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes())
    repeated = base.select("doc_id").groupBy("doc_id").count().where("count > 1").limit(1).count()
    # tells rows of one doc_id apart; no id repeats in most tables
    mark = F.hash("text") if repeated else F.lit(0)
    base = base.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), mark.alias("th"), "text")
    run_of = F.struct("place", *(F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in ("s1", "s2") for c in (*KEY, "place")))
    runs = copies(base, window, anchor).groupBy(*KEY).agg(F.collect_list(run_of).alias("runs"))
    joined = base.join(runs, KEY, "left")

    def run(batches):
        for batch in batches:
            texts, n_words, n_removed, parsed, ends = [], [], [], [], [0]
            lists = batch.column("runs")
            flat = [x.to_pylist() for x in lists.flatten().flatten()]
            sizes, at = [n or 0 for n in pc.list_value_length(lists).to_pylist()], 0
            for text, size in zip(batch.column("text").to_pylist(), sizes):
                words = text.split()
                n = len(words)
                if size:
                    place, d1, t1, p1, d2, t2, p2 = (x[at : at + size] for x in flat)
                    at += size
                    found = parse(
                        [(p // STEP, p % STEP, ((a, b, c // STEP), (d, e, f // STEP))) for p, a, b, c, d, e, f in zip(place, d1, t1, p1, d2, t2, p2)],
                        window,
                    )
                    edge = np.zeros(n + 1, np.int64)
                    for start, length, _ in found:
                        edge[start] += 1
                        edge[start + length] -= 1
                    stay = np.flatnonzero(np.cumsum(edge[:n]) == 0).tolist()
                    words = [words[i] for i in stay]
                    parsed += [(start, length, None if doc == NO_ID else doc, place) for start, length, (doc, _, place) in found]
                ends.append(len(parsed))
                texts.append(b" ".join(words))
                n_words.append(n)
                n_removed.append(n - len(words))
            ids = [None if d == NO_ID else d for d in batch.column("doc_id").to_pylist()]
            names = ["start", "length", "source", "source_start"]
            fields = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (zip(*parsed) if parsed else [()] * 4)], names)
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), fields)],
                ["doc_id", "text", "n_words", "n_removed", "factors"],
            )

    return joined.mapInArrow(run, RESULT)
