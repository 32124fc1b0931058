"""Weighted fair queueing of sources: virtual finish times, a global range sort, a total budget.

Documents of a source are shuffled by hash, repeated in epochs and served in packets of words.
A packet's virtual finish time is the words of its source up to the packet's end, divided by
the source's target.  Packets of all sources are sorted by finish time, and the sorted queue is
cut where the running total of words reaches the budget; nothing else limits a source.

Where the cut falls, all sources have been served to the same virtual time up to one packet.
Targets add up to the budget and a source whose target is its cap ends at time one, so that
time is one or later, no source is more than a packet short of its target, and what sources are
given beyond their targets adds up to what others are short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlytics.llm.common import cut

WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_BUCKET = 4096
PACKET = 32  # words, at least
PACKETS = 1024  # a packet of more words is this part of its source's target, at most


def n_words(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=(5, 2, 1), repeats: int = 3) -> DataFrame:
    """One row a source: source, source_id (rank by code point, null last), source_size, docs, target.

    The targets share the sum of all sizes by weight; none exceeds ``repeats`` times its source.
    With sources in ascending order of cap per weight, the share per weight that is left after
    capping the first ones is largest exactly at the first source that needs no cap.  The table
    has a row per distinct source, so these windows run over sources, never over documents.
    """
    by = sizes.groupBy("source").agg(
        F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("source_size"), F.count("*").alias("docs")
    )
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    by = by.select("*", rank.alias("source_id"))
    by = by.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("source_id") % len(weights) + 1).cast("int")).cast("long"))
    by = by.withColumn("cap", F.lit(repeats) * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "source_id").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    total = F.sum("source_size").over(everything)
    by = by.select(
        "*",
        (total - F.coalesce(F.sum("cap").over(order), F.lit(0))).alias("left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(order), F.lit(0))).alias("heft"),
    )
    best = F.max_by(F.struct("left", "heft"), F.col("left") / F.col("heft")).over(everything)
    by = by.withColumn("best", best)
    share = (F.col("weight") * F.col("best.left")).cast("double") / F.col("best.heft")
    return by.select("source", "source_id", "source_size", "docs", F.least(F.col("cap").cast("double"), share).alias("target"))


def queue(docs: DataFrame, weights=(5, 2, 1), repeats: int = 3) -> tuple[DataFrame, DataFrame]:
    """The mix of ``docs`` (doc_id, source, size, and ``key`` columns that are carried along).

    Returns (rows, entries).  rows: every input row with row_id, source_size and target.
    entries: what the mix takes, one row per packet: row_id, epoch, vft (virtual finish time),
    taken, and position, the words taken before it in the global order.  The packets taken of
    a document in an epoch are its first ones.

    Running sums are made in two levels: documents of a source are dealt by hash to buckets of
    about ``ROWS_PER_BUCKET`` rows, sums of buckets are summed along each source, and inside
    buckets along the documents.  So a source may hold any share of all rows.
    """
    keys = [c for c in docs.columns if c not in ("doc_id", "size", "source")]
    sized = cut(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), "source", "size",
            F.coalesce(F.md5(F.col("doc_id").cast("string")), F.lit("")).alias("h"), *keys,
            F.monotonically_increasing_id().alias("row_id"),
        )
    )
    targets = cut(source_targets(sized, weights, repeats))
    bits = F.greatest(F.lit(0), F.least(F.lit(31), F.ceil(F.log2((F.col("docs") / ROWS_PER_BUCKET).cast("double"))))).cast("int")
    head = F.conv(F.substring("h", 1, 8), 16, 10).cast("long")
    rows = cut(
        sized.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
        .withColumn("bits", bits)
        .withColumn("bucket", F.floor(F.coalesce(head, F.lit(0)) / F.pow(F.lit(2.0), 32 - F.col("bits"))).cast("long"))
    )
    sums = rows.groupBy("source_id", "bucket").agg(F.sum("size").alias("sum"))
    along = Window.partitionBy("source_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut(sums.select("source_id", "bucket", F.coalesce(F.sum("sum").over(along), F.lit(0)).alias("ahead")))
    inside = Window.partitionBy("source_id", "bucket").orderBy("h", "doc_id", "size", "row_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    queued = rows.withColumn("run", F.sum("size").over(inside)).join(offsets, ["source_id", "bucket"])
    before = F.col("ahead") + F.col("run") - F.col("size") + F.col("epoch") * F.col("source_size")
    packet = F.greatest(F.lit(PACKET), F.ceil(F.col("target") / PACKETS)).cast("long")
    entries = (
        queued.where("size > 0")
        .withColumn("packet", packet)
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
        .withColumn("before", before)
        .withColumn("first", F.explode(F.expr("sequence(0L, size - 1, packet)")))
        .withColumn("taken", F.least("packet", F.col("size") - F.col("first")))
        .withColumn("served", F.col("before") + F.col("first") + F.col("taken"))
        .select("row_id", "doc_id", "source", "source_id", "size", *keys, "epoch", "taken", "served",
                (F.col("served") / F.col("target")).alias("vft"))
    )
    return rows.drop("source_id", "bits", "bucket", "h", "docs"), truncated(entries, rows)


def truncated(entries: DataFrame, rows: DataFrame) -> DataFrame:
    """Sort entries globally by virtual finish time and stop at the total budget, all words of ``rows``.

    The range partitions are written once; sums of partitions give each its offset, so that the
    running sum over the whole order needs no task that sees all rows.  Ties go by source and by
    the words its packets end at, which no two packets of a source share.
    """
    order = ["vft", "source_id", "served"]
    dealt = cut(entries.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    sums = dealt.groupBy("part").agg(F.sum("taken").alias("sum"))
    ahead = F.coalesce(F.sum("sum").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = cut(sums.select("part", ahead.alias("ahead")))
    run = F.sum("taken").over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    budget = rows.agg(F.sum("size")).head()[0] or 0
    # a part that starts at the budget or beyond holds nothing that is taken
    reached = dealt.join(F.broadcast(offsets.where(F.col("ahead") < budget)), "part")
    placed = reached.withColumn("run", run).withColumn("position", F.col("ahead") + F.col("run") - F.col("taken"))
    return (
        placed.withColumn("taken", F.least("taken", F.lit(budget) - F.col("position")))
        .where("taken > 0")
        .drop("part", "run", "ahead", "source_id", "served")
    )


def mixed(docs: DataFrame, weights=(5, 2, 1), repeats: int = 3) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, source and others) as often as the mix takes them.

    A row that the mix takes in part keeps its first words, joined by a space.  Rows without
    words are not taken.  Null sources are a source of their own.  Equal rows are told apart
    by number, so that each is taken as its own place in the queue says.
    """
    key = ["doc_id", "th"]
    # the row travels as one column, so that none of its names meets a name of the queue
    marked = docs.select("doc_id", "source", F.xxhash64("text").alias("th"), F.struct("*").alias("row"))
    sized = marked.select("doc_id", n_words("row.text").alias("size"), "source", "th")
    _, packets = queue(sized, weights, repeats)
    entries = packets.groupBy("row_id", "doc_id", "th", "source", "size", "epoch").agg(F.sum("taken").alias("taken"))
    number = F.dense_rank().over(Window.partitionBy("doc_id", "th", "source").orderBy("row_id"))
    taken = entries.withColumn("e_copy", number).select(
        *(F.col(c).alias(f"e_{c}") for c in ("doc_id", "th", "source", "taken", "size")), "e_copy"
    )
    copy = F.row_number().over(Window.partitionBy(*key).orderBy("source"))
    first = F.min("copy").over(Window.partitionBy(*key, "source"))
    rows = marked.withColumn("copy", copy).withColumn("copy", F.col("copy") - first + 1)
    # copy and source are compared as ranges, so that the join keeps the window's partitions
    same = (
        F.col("doc_id").eqNullSafe(F.col("e_doc_id")) & (F.col("th") == F.col("e_th"))
        & F.coalesce("source", F.lit("")).between(F.coalesce("e_source", F.lit("")), F.coalesce("e_source", F.lit("")))
        & (F.col("source").isNull() == F.col("e_source").isNull())
        & F.col("copy").between(F.col("e_copy"), F.col("e_copy"))
    )
    words = F.expr(r"filter(split(row.text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')")
    part = F.array_join(F.slice(words, F.lit(1), F.col("e_taken").cast("int")), " ")
    text = F.when(F.col("e_taken") < F.col("e_size"), part).otherwise(F.col("row.text"))
    return rows.join(taken, same).select(*(text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))
