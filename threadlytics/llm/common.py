"""Helpers shared by the corpus operators: words, written cut points, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlytics.session import shared_dir

# White space of the contracts, [\x20\x09-\x0D]; bytes.split() and bytes.strip() use the same six.
SPACE = " \t\n\x0b\f\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_bytes(column: str = "text"):
    """The text as UTF-8 bytes, so that Python splits it without decoding; null is empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b"")).alias(column)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lost executor costs a re-read."""
    path = f"{shared_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SLOTS = 64
SHARE = 1024


def among(rows: DataFrame, counted: DataFrame, keys: list[str], by: list[str], carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows of the written table ``rows`` whose ``keys`` stand in ``counted`` (keys, c, ``carry``).

    ``c`` is how many of the rows have the key; ``carry`` are columns that the rows get from it.  A key of more than a ``SHARE``-th of all rows
    is dealt to ``SLOTS`` tasks by a hash of ``by``; such keys number fewer than ``SHARE``,
    which bounds what is broadcast to tell their rows.
    """
    limit = max(1, rows.count() // SHARE)
    slots = F.sequence(F.lit(0), F.when(F.col("c") > limit, SLOTS - 1).otherwise(0))
    hot = counted.where(F.col("c") > limit).select(*keys, F.lit(True).alias("hot"))
    dealt = rows.join(F.broadcast(hot), keys, "left")
    slot = F.when(F.col("hot"), F.pmod(F.xxhash64(*by), F.lit(SLOTS))).otherwise(F.lit(0)).cast("int")
    wanted = counted.select(*keys, *carry, F.explode(slots).alias("slot"))
    how = "inner" if carry else "left_semi"
    return dealt.withColumn("slot", slot).join(wanted, [*keys, "slot"], how).select(*rows.columns, *carry)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of an undirected graph given as long columns (a, b).

    Alternates large-star and small-star steps, both of them minima by node, until the edges
    no longer change; every node then points at the smallest of its component.  Rounds grow
    with the logarithm of the diameter.  Minima are folded before the shuffle and the joins
    are plain sort-merge joins, so a node with very many neighbours is split by AQE.  Each
    round ends in a written table.  Self links and repeated links are allowed; nodes without
    a link to another node are not returned.
    """
    e = cut(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    mark = F.struct(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1000003))
    before = None
    while (now := e.select(mark).head()[0]) != before and now[0]:
        before = now
        both = e.select(F.col("u").alias("n"), F.col("v").alias("x")).union(e.select("v", "u"))
        low = both.groupBy("n").agg(F.min("x").alias("m")).select("n", F.least("n", "m").alias("m"))
        large = both.join(low, "n").where("x > n").select(F.col("x").alias("u"), F.col("m").alias("v")).distinct()
        large = cut(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(small.union(low.select("u", "m")).distinct())
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
