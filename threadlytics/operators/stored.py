"""Tables that updates are merged into where they are stored.

A stored table is cut twice by its key: into shards, which are its directories, and inside a
shard into buckets, which are its files.  An update rewrites the shards that hold its keys and
leaves the files of all others alone.  Inside the buckets the rows meet the updates without a
shuffle of their own, so what travels is the update.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlytics.operators.maintenance import latest_per_key, merge
from threadlytics.session import cut_lineage

SHARD = "shard"


@dataclass(frozen=True)
class Stored:
    """A table of the catalog called ``name``, with its files at ``path``.

    ``shards`` is how many parts it is rewritten by, ``buckets`` how many files a shard has.  More
    shards narrow what an update rewrites; together they should make files of some 128 MB.
    """

    name: str
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    shards: int = 16
    buckets: int = 8

    def shard(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.shards)).cast("int")


def create_stored(spark: SparkSession, table: Stored) -> None:
    """Tell the catalog of a table, and of the shards that are at its place already."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    keys = ", ".join(f"`{k}`" for k in table.keys)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table.name} ({columns}, {SHARD} INT) USING parquet "
        f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({SHARD}) CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {table.buckets} BUCKETS "
        f"LOCATION '{table.path}'"
    )
    # An append of no rows makes the folder if there is none and changes nothing else.
    none = spark.createDataFrame([], T.StructType([*table.schema, T.StructField(SHARD, T.IntegerType())]))
    none.write.mode("append").partitionBy(SHARD).parquet(table.path)
    spark.sql(f"ALTER TABLE {table.name} RECOVER PARTITIONS")


def rows_of(spark: SparkSession, table: Stored) -> DataFrame:
    return spark.table(table.name).drop(SHARD)


def _overwrite(rows: DataFrame, table: Stored) -> None:
    """Replace the shards that ``rows`` stand in; a failed job leaves them as they were."""
    spark = rows.sparkSession
    spark.sql(f"REFRESH TABLE {table.name}")
    rows.select(*table.schema.fieldNames(), SHARD).write.insertInto(table.name, overwrite=True)


def fill(rows: DataFrame, table: Stored) -> None:
    """Write the first rows of a table; a shard that has rows already is replaced."""
    placed = rows.withColumn(SHARD, table.shard())
    _overwrite(placed.repartition(table.buckets, *table.keys), table)


def touched_shards(updates: DataFrame, table: Stored) -> list[int]:
    """The shards of the updates' keys; at most as many as the table has."""
    return sorted(r[0] for r in updates.select(table.shard()).distinct().collect())


def merge_plan(updates: DataFrame, table: Stored, shards: list[int], order: list[str]) -> DataFrame:
    """The rows of ``shards`` after ``updates``, which hold one row per key."""
    spark = updates.sparkSession
    before = spark.table(table.name).where(F.col(SHARD).isin(shards)).drop(SHARD)
    # Laid out like the buckets, whatever the session's number of shuffle partitions is.
    changes = updates.drop(*[c for c in order if c not in table.schema.fieldNames()])
    merged = merge(before, changes.repartition(table.buckets, *table.keys), list(table.keys))
    return merged.withColumn(SHARD, table.shard())


def upsert_stored(updates: DataFrame, table: Stored, order: list[str]) -> list[int]:
    """Merge ``updates`` into a stored table and return the shards that were rewritten.

    Supplied columns replace, others keep their value, new keys are added; of several updates of
    a key the last by ``order`` counts.  Updates with a null in their key are refused, as they
    name no row.  Running again with the same updates changes nothing.
    """
    nameless = F.lit(False)
    for key in table.keys:
        nameless = nameless | F.col(key).isNull()
    checked = updates.select(
        *[F.when(nameless, F.raise_error(F.lit(f"an update of {table.name} has a null key"))).otherwise(F.col(c)).alias(c)
          if c == table.keys[0] else F.col(c) for c in updates.columns]
    )
    latest = cut_lineage(latest_per_key(checked, list(table.keys), order))
    shards = touched_shards(latest, table)
    if shards:
        _overwrite(merge_plan(latest, table, shards, order), table)
    return shards
