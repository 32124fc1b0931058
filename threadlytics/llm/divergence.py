"""Divergence of the sources of a language from one another and from the language.

A group is a (lang, source).  Its share of a term is a whole number of billionths, smoothed so
that no share is zero, and the divergence of one share from another is the whole part of
(p - q)² / q.  All pairs of groups over all terms form a cube per language, cut in three
dimensions: a task owns one (group block, group block, term block) cell, gets the two slices of
counts that meet there, each slice being copied to the cells of its row, and computes the
divergences over its own terms.  Sums along the term axis are the results.  A cell is bounded
by its block sizes whatever the number of groups, terms or documents; more of them make more cells.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlytics.llm.common import cut, text_bytes

BILLION = 1_000_000_000
GROUP_BLOCK, TERM_BLOCK = 16, 4096
HELD = 200_000  # entries a task holds before it passes them on
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and of characters beyond ASCII, A-Z in lower case."""
    return text.translate(LETTERS).split()


def named() -> list[Column]:
    return [F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): partial counts of occurrences and documents.

    A task adds up what it reads before it passes it on.
    """

    def run(batches):
        seen: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flush():
            for (lang, source), (n, found) in seen.items():
                keys = list(n)
                yield pa.record_batch(
                    [
                        pa.array([lang] * len(keys), pa.string()),
                        pa.array([source] * len(keys), pa.string()),
                        pa.array(keys, pa.binary()).cast(pa.string()),
                        pa.array(n.values(), pa.int64()),
                        pa.array([found[k] for k in keys], pa.int64()),
                    ],
                    ["lang", "source", "term", "n", "docs"],
                )
            seen.clear()

        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                n, found = seen.setdefault((lang, source), (Counter(), Counter()))
                words = terms(text)
                n.update(words)
                found.update(set(words))
            if sum(len(n) for n, _ in seen.values()) > HELD:
                yield from flush()
        yield from flush()

    return docs.select(*named(), text_bytes()).mapInArrow(run, "lang string, source string, term string, n long, docs long")


def share(count: str, size: str) -> Column:
    """1 + floor(10^9 * (count + 1) / size) of long columns, exact for sizes below 9 * 10^15.

    The quotient is worked out three digits at a time, so that no product leaves the long range;
    count + 1 is at most the size.
    """
    rest, digits = f"({count} + 1L)", []
    for _ in range(3):
        digits.append(f"(({rest} * 1000L) div {size})")
        rest = f"(({rest} * 1000L) % {size})"
    return F.expr(f"1L + {digits[0]} * 1000000L + {digits[1]} * 1000L + {digits[2]}")


def cell_divergences(left: np.ndarray, right: np.ndarray, absent: int, left_zero: np.ndarray, right_zero: np.ndarray) -> np.ndarray:
    """Sums of floor((p - q)² / q), p of a row of ``left``, q of a row of ``right``, over the columns
    and over ``absent`` more terms that neither side has."""
    sums = np.empty((len(left), len(right)), np.int64)
    for i, p in enumerate(left):
        apart = p - right
        sums[i] = (apart * apart // right).sum(axis=1)
    apart = left_zero[:, None] - right_zero[None, :]
    return sums + apart * apart // right_zero[None, :] * absent


def _cell(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Divergences over one cell's terms of all ordered pairs of groups of different blocks or, on
    the diagonal, of one block.  Rows of a null term carry a group's zero share and the number of terms."""
    lang, i, j = key[0].as_py(), key[1].as_py(), key[2].as_py()
    sources = table.column("source").combine_chunks().dictionary_encode()
    names, of = sources.dictionary.to_pylist(), sources.indices.to_numpy()
    p = table.column("p").to_numpy()
    block = table.column("block").to_numpy()
    encoded = table.column("term").combine_chunks().dictionary_encode()
    term = encoded.indices.fill_null(-1).to_numpy()
    head = term < 0
    width = len(encoded.dictionary)
    zero, side = np.ones(len(names), np.int64), np.zeros(len(names), np.int64)
    zero[of[head]], side[of[head]] = p[head], block[head]
    shares = np.repeat(zero[:, None], width, axis=1)
    shares[of[~head], term[~head]] = p[~head]
    absent = int(table.column("width").to_numpy()[head].max(initial=0)) - width
    first, second = np.flatnonzero(side == i), np.flatnonzero(side == j)
    out = []
    for a, b in ((first, second),) if i == j else ((first, second), (second, first)):
        sums = cell_divergences(shares[a], shares[b], absent, zero[a], zero[b])
        out += [(lang, names[x], names[y], int(sums[r, c])) for r, x in enumerate(a) for c, y in enumerate(b) if x != y]
    columns = list(zip(*out)) or [()] * 4
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "source", "item", "value"])


def pair_divergences(kept: DataFrame, groups: DataFrame, group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK) -> DataFrame:
    """(lang, source, item, value) of all ordered pairs of groups of a language.

    ``kept`` holds (lang, source, term, n, first) with ``first`` on one row of each (lang, term);
    ``groups`` holds (lang, source, size, width), size being the group's smoothed total and width
    the number of terms of the language.  Blocks are chosen by hash.
    """
    counted = groups.groupBy("lang").agg(
        F.ceil(F.count("*") / group_block).cast("int").alias("group_blocks"),
        F.greatest(F.lit(1), F.ceil(F.max("width") / term_block)).cast("int").alias("term_blocks"),
    )
    placed = cut(
        groups.join(counted, "lang").withColumn("block", F.pmod(F.xxhash64("source"), F.col("group_blocks")).cast("int"))
    )
    blocks = counted.select("lang", "term_blocks")
    of_term = F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int").alias("k")
    widths = kept.where("first").join(blocks, "lang").groupBy("lang", of_term).agg(F.count("*").alias("w"))
    heads = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)).alias("k"))
    heads = heads.join(widths, ["lang", "k"], "left").select(
        "lang", "k", "block", "group_blocks", "source", F.lit(None).cast("string").alias("term"),
        share("0L", "size").alias("p"), F.coalesce("w", F.lit(0)).cast("long").alias("width"),
    )
    rows = kept.join(placed, ["lang", "source"]).select(
        "lang", of_term, "block", "group_blocks", "source", "term", share("n", "size").alias("p"), F.lit(0).cast("long").alias("width"),
    )
    slices = heads.unionByName(rows).select("*", F.explode(F.sequence(F.lit(0), F.col("group_blocks") - 1)).alias("other"))
    cells = slices.select(
        "lang", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "k",
        F.col("block").cast("long").alias("block"), "source", "term", "p", "width",
    )
    parts = cells.groupBy("lang", "i", "j", "k").applyInArrow(_cell, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_divergences(kept: DataFrame, groups: DataFrame, top: int = 200) -> DataFrame:
    """(lang, source, item, value, rank) of the ``top`` terms that a group uses more than its language.

    ``kept`` also holds ``lang_n``, the term's count in the language, and ``groups`` ``lang_size``.
    Tasks keep the ``top`` of what they hold before the shuffle.
    """
    told = kept.join(groups.select("lang", "source", "size", "lang_size"), ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), share("n", "size").alias("p"), share("lang_n", "lang_size").alias("q")
    )
    more = told.where("p > q").select("lang", "source", "item", F.expr("((p - q) * (p - q)) div q").alias("value"))
    return ranked(more).where(F.col("rank") <= top)


def ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, min_docs: int = 3, top: int = 200, group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group of ``docs``.

    Part ``pair`` compares a group with each other source of its language over the terms that
    ``min_docs`` documents of the language have, part ``term`` names the terms it uses more than
    its language does.  Null text, lang and source are empty strings; repeated rows are documents
    of their own; doc_id and other columns are not read.  A language of one group has no pairs,
    one without kept terms has pairs of value 0, an empty table gives no rows.  Ties go by the
    UTF-8 order of the item.
    """
    # One shuffle: all rows of a term in a language meet, few of them, as tasks have added up their own.
    counts = term_counts(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of = Window.partitionBy("lang", "term")
    counts = counts.select(
        "lang", "source", "term", "n", F.sum("n").over(of).alias("lang_n"), F.sum("docs").over(of).alias("lang_docs"),
        (F.min("source").over(of) == F.col("source")).alias("first"),
    )
    kept = cut(counts.where(F.col("lang_docs") >= min_docs).drop("lang_docs"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if("first").alias("width"))
    zero = F.lit(0)
    groups = cut(
        docs.select(*named()).distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select(
            "lang", "source", F.coalesce("width", zero).cast("long").alias("width"),
            F.greatest(F.coalesce("total", zero) + F.coalesce("width", zero), F.lit(1)).cast("long").alias("size"),
            F.greatest(F.coalesce("lang_total", zero) + F.coalesce("width", zero), F.lit(1)).cast("long").alias("lang_size"),
        )
    )
    pairs = ranked(pair_divergences(kept, groups, group_block, term_block)).withColumn("part", F.lit("pair"))
    telling = term_divergences(kept, groups, top).withColumn("part", F.lit("term"))
    return pairs.unionByName(telling).select("lang", "source", "part", "item", "value", "rank")
