"""Which of several filters removes what, over all orders in which they may be applied.

A filter is a failure condition on a row, so a row is the set of filters that it fails, and a
table shrinks to one count per set.  Subsets of filters form a lattice: the state of a run is
the subset applied so far, an order is a path from the empty set to the full one, and the edge
that adds a filter to a subset removes the rows that fail it and nothing in the subset.  The
number of paths that reach the tail of an edge times the number that leave its head weighs its
removals in the sum over all orders (Shapley), and the steps of any one order are read off the
same edges.
"""

from __future__ import annotations

from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MOST_FILTERS = 8  # an audit lists every order; 8 filters have 40,320
WORD_GAPS = r"[\x20\x09-\x0D]+"
COUNTS = ("rows", "good", "toxic")


def path_counts(n: int) -> tuple[list[int], list[int]]:
    """Forward and backward path counts of the lattice of subsets of ``n`` filters, by bit mask.

    The first is the number of orders in which a subset can have been applied, the second the
    number of orders in which the rest can follow.
    """
    full = (1 << n) - 1
    reaching, leaving = [1] + [0] * full, [0] * full + [1]
    for state in range(full + 1):
        for f in range(n):
            if not state >> f & 1:
                reaching[state | 1 << f] += reaching[state]
    for state in range(full - 1, -1, -1):
        leaving[state] = sum(leaving[state | 1 << f] for f in range(n) if not state >> f & 1)
    return reaching, leaving


def survivors(counts: list[int], n: int) -> list[int]:
    """Rows left in each state, from rows by failed set: those whose set avoids the state.

    Sums over the subsets of each set, one filter at a time, give the rows failing within it;
    the rows left in a state are those failing within its complement.
    """
    within = list(counts)
    for f in range(n):
        for state in range(1 << n):
            if state >> f & 1:
                within[state] += within[state ^ 1 << f]
    full = (1 << n) - 1
    return [within[full ^ state] for state in range(1 << n)]


def lattice_report(names: str, failed: dict[int, tuple[int, int, int]]):
    """One row per order and step, from (rows, good, toxic) by the mask of failed filters.

    Yields (filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley); the mask has bit ``i`` for the filter ``names[i]``.
    """
    n = len(names)
    reaching, leaving = path_counts(n)
    left = [survivors([failed.get(m, (0, 0, 0))[c] for m in range(1 << n)], n) for c in range(3)]
    failing = [sum(v[0] for m, v in failed.items() if m >> f & 1) for f in range(n)]
    edge = {
        (state, f): tuple(rows[state] - rows[state | 1 << f] for rows in left)
        for state in range(1 << n) for f in range(n) if not state >> f & 1
    }
    shapley = [0] * n
    for (state, f), (removed, _, _) in edge.items():
        shapley[f] += reaching[state] * leaving[state | 1 << f] * removed
    for order in permutations(range(n)):
        state = 0
        for step, f in enumerate(order, 1):
            removed, good, toxic = edge[state, f]
            state |= 1 << f
            unique = failed.get(1 << f, (0, 0, 0))[0]
            yield ("".join(names[i] for i in order), step, left[0][state], removed, failing[f] - removed, unique, good, toxic, shapley[f])


REPORT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def audit(masks: DataFrame, names: str) -> DataFrame:
    """The report of every part, from the columns part, mask, rows, good and toxic.

    ``names`` has a letter per filter, the first for the lowest bit of the mask.  Rows of one
    part and mask are added up first, so a part comes to a task as one row per set of filters.
    A null part counts as the empty string, null counts as zero; a table without rows gives
    none, a part whose rows fail nothing gives rows of zero removals.  Other columns are ignored.
    """
    if not 0 < len(names) <= MOST_FILTERS or len(set(names)) != len(names):
        raise ValueError(f"an audit takes 1 to {MOST_FILTERS} filters of different names, not {names!r}")
    summed = masks.groupBy(F.coalesce("part", F.lit("")).alias("part"), F.col("mask").cast("int").alias("mask")).agg(
        *[F.sum(F.coalesce(c, F.lit(0))).cast("long").alias(c) for c in COUNTS]
    )
    fields = [f.split()[0] for f in REPORT.split(", ")]

    def report(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        values = zip(*(table.column(c).to_pylist() for c in ("mask", *COUNTS)))
        rows = [(key[0].as_py(), *row) for row in lattice_report(names, {m: tuple(c) for m, *c in values})]
        kinds = [pa.string(), pa.string(), pa.int32()] + [pa.int64()] * 7
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], fields)

    return summed.groupBy("part").applyInArrow(report, REPORT)


def text_conditions(text: Column, words: Column) -> list[Column]:
    """Failure conditions of a text by itself: too short, repetitive, shouting, holding marks."""
    upper = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [
        F.size(words) < 100,
        100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        100 * upper > 10 * F.length(text),
        text.rlike(r"[#$%&*|]"),
    ]


def document_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, rows, good, toxic) of whole documents: bits 0 to 3 are those of
    :func:`text_conditions`, bit 4 says that a smaller doc_id has the same text.

    Texts leave their first stage as a digest.  Null texts and langs are empty strings.  A null
    doc_id is smaller than none and has no smaller one, and it has no label.  Rows that repeat
    a doc_id are rows of their own; of repeated labels the one that says yes counts, and a null
    says no.  Extra columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    split = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"),
        F.array_remove(F.split(text, WORD_GAPS), "").alias("words"),
    )
    bits = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(text_conditions(F.col("text"), F.col("words")))]
    seen = split.select(
        "doc_id", "part", sum(bits[1:], bits[0]).alias("mask"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")
    )
    # A doc_id of very many rows folds here, so the join below meets each id with few rows.
    seen = seen.groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n"))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    # Rows without a doc_id go where their text goes, and meet no label there.
    key = [F.coalesce("doc_id", F.xxhash64("digest")).alias("key"), F.col("doc_id").isNull().alias("nameless")]
    marks = marks.select(F.col("doc_id").alias("key"), F.lit(False).alias("nameless"), "good", "toxic")
    known = seen.select("*", *key).join(marks, ["key", "nameless"], "left").select(
        *seen.columns, F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")
    )
    # All that a group of copies needs is its least doc_id and how many rows have it; folded before
    # the shuffle, a text of any number of copies is one row per part and label.
    kinds = known.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"),
    )
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    first = kinds.withColumn("stay", F.col("nameless") + F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0))
    copies = F.explode(F.array(
        F.struct(F.col("mask"), F.col("stay").alias("rows")),
        F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("stay")).alias("rows")),
    )).alias("of")
    parts = first.select("part", "good", "toxic", copies).select("part", "of.*", "good", "toxic")
    return parts.groupBy("part", "mask").agg(
        F.sum("rows").alias("rows"),
        F.sum(F.when(F.col("good"), F.col("rows")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("rows")).otherwise(0)).alias("toxic"),
    )
