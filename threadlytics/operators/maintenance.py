"""Stored tables: keyed upsert, clearing, schema changes and checks, processed marks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlytics.schemas import ADDED_COLUMNS, EXPECTED_OBJECTS, TABLES


def latest_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last row of each key by ``order``; copies are folded before the shuffle."""
    rest = [name for name in rows.columns if name not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return rows.groupBy(*keys).agg(last.alias("last")).select(*keys, "last.*").select(*rows.columns)


def merge(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` after ``changes``, one row per key: supplied columns replace, others stay."""
    supplied = [c for c in changes.columns if c in target.columns and c not in keys]
    new = changes.select(
        *keys, *[F.col(c).alias(f"new_{c}") for c in supplied], F.lit(True).alias("is_new")
    )
    merged = target.join(new, keys, "full_outer")
    columns = []
    for field in target.schema:
        name = field.name
        if name in supplied:
            value = F.when(F.col("is_new"), F.col(f"new_{name}")).otherwise(F.col(name))
            columns.append(value.cast(field.dataType).alias(name))
        else:
            columns.append(F.col(name))
    return merged.select(*columns)


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``target`` after ``updates``: supplied columns replace, others keep their value.

    ``order`` tells which update of a key comes last when there are several.  Updates may
    carry a part of the columns only; null is a supplied value like any other.
    ``stored.upsert_stored`` does the same to a table in place.
    """
    if not order:
        raise ValueError("an upsert needs a column that tells the last update of a key")
    return merge(target, latest_per_key(updates, keys, order), keys)


def sized(df: DataFrame, *by: str) -> DataFrame:
    """``df`` ready to be written in files of a session's advisory size, by ``by`` if it is given.

    Partitions are split and joined by their measured bytes, so neither a large nor a skewed
    input makes one huge file, and a small one makes no crumbs.
    """
    return df.hint("rebalance", *by)


def write_table(df: DataFrame, path: str, by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    """Write a parquet table in files of the session's advisory size, partitioned ``by`` columns."""
    writer = sized(df, *by).write.mode(mode)
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(path)


def clear_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows that clearing the tables removes, one line per table."""
    lines = [
        df.agg(F.count("*").alias("rows_deleted")).select(
            F.lit(name).alias("table_name"), "rows_deleted"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, lines)


def clear_tables(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Empty the parquet tables at ``paths`` and tell how many rows each lost."""
    stored = {name: spark.read.parquet(path) for name, path in paths.items()}
    counted = [(r["table_name"], r["rows_deleted"]) for r in clear_counts(stored).collect()]
    for name, path in paths.items():
        spark.createDataFrame([], stored[name].schema).write.mode("overwrite").parquet(path)
    return spark.createDataFrame(counted, "table_name string, rows_deleted bigint")


def add_columns(df: DataFrame, columns: list[tuple[str, str, str | None]]) -> DataFrame:
    """Add (name, type, default expression) columns that are missing; others stay as they are."""
    for name, kind, default in columns:
        if name not in df.columns:
            df = df.withColumn(name, F.expr(default or "NULL").cast(kind))
    return df


def evolve(table: str, df: DataFrame) -> DataFrame:
    """``df`` with the columns the migration adds to ``table``."""
    return add_columns(
        df, [(name, kind, default) for owner, name, kind, default in ADDED_COLUMNS if owner == table]
    )


# The column that posts, comments and their mentions are joined by.
BUCKET_KEYS = {
    "posts": "reddit_id",
    "comments": "reddit_id",
    "content_tickers": "content_reddit_id",
}


def create_tables(
    spark: SparkSession, prefix: str = "", location: str | None = None, buckets: int | None = None
) -> None:
    """Create the catalog tables that do not exist yet.

    With ``buckets``, contents and mentions are laid out by content id, so that the joins
    between them need no shuffle, in particular none of the texts.
    """
    for name, schema in TABLES.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        layout = ""
        if buckets and name in BUCKET_KEYS:
            key = BUCKET_KEYS[name]
            layout = f" CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS"
        place = f" LOCATION '{location}/{name}'" if location else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {prefix}{name} ({columns}) USING parquet{layout}{place}"
        )


def evolve_catalog(spark: SparkSession, prefix: str = "") -> None:
    """Add the migration's missing columns to catalog tables, in metadata only."""
    for table in dict.fromkeys(owner for owner, *_ in ADDED_COLUMNS):
        present = spark.table(f"{prefix}{table}").columns
        missing = [c for c in ADDED_COLUMNS if c[0] == table and c[1] not in present]
        if missing:
            columns = ", ".join(
                f"{name} {kind}" + (f" DEFAULT {default}" if default else "")
                for _, name, kind, default in missing
            )
            spark.sql(f"ALTER TABLE {prefix}{table} ADD COLUMNS ({columns})")


def schema_check(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Expected tables and columns, and whether each is there; decided from schemas alone."""
    lines = []
    for table, column in EXPECTED_OBJECTS:
        there = table in tables and (column is None or column in tables[table].columns)
        lines.append((f"{table}.{column}" if column else table, there))
    return spark.createDataFrame(lines, "object string, present boolean")


def column_catalogue(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(table, column, type) of every column."""
    lines = [
        (table, position, field.name, field.dataType.simpleString())
        for table, df in tables.items()
        for position, field in enumerate(df.schema)
    ]
    return spark.createDataFrame(
        lines, "table_name string, position int, column_name string, data_type string"
    )


def fit_to(df: DataFrame, target: T.StructType, wanted: list[str]) -> DataFrame:
    """The ``wanted`` columns that a target of an older layout can take."""
    known = set(target.fieldNames())
    return df.select(*[c for c in wanted if c in known and c in df.columns])


def mark_processed(items: DataFrame, handled: DataFrame, as_of: str) -> DataFrame:
    """``items`` with ``processed_at`` set to ``as_of`` where the id is in ``handled``.

    Where both frames tell the ``kind``, posts and comments of equal id are kept apart.
    """
    keys = ["kind", "reddit_id"] if "kind" in items.columns and "kind" in handled.columns else ["reddit_id"]
    done = handled.select(*keys).distinct().withColumn("handled", F.lit(True))
    columns = items.columns
    return (
        items.join(done, keys, "left")
        .withColumn(
            "processed_at",
            F.when(F.col("handled"), F.lit(as_of).cast("timestamp")).otherwise(
                F.col("processed_at")
            ),
        )
        .select(*columns)
    )
