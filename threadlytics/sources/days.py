"""Contents laid out by day: one directory per day of ``created_utc``, so a range reads its days only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlytics.operators.filters import in_range
from threadlytics.operators.maintenance import sized

DAY = "day"


def write_days(rows: DataFrame, path: str, column: str = "created_utc") -> None:
    """Write ``rows`` by the day of ``column``; the days of ``rows`` are replaced, others stay.

    Rows without a time share a directory of their own.  ``REBALANCE`` splits a day of very many
    rows into several files of the session's advisory size and puts small ones together, so no
    task gets a whole hot day.  A failed job leaves the days as they were.
    """
    placed = sized(rows.withColumn(DAY, F.to_date(column)), DAY)
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def read_days(
    spark: SparkSession, path: str, schema: T.StructType, start: str, end: str, column: str = "created_utc"
) -> DataFrame:
    """Rows with ``start <= column < end`` of the table at ``path``; directories outside are not opened.

    ``schema`` is that of the rows as they were written.  Rows without a time are in no range.
    """
    stored = spark.read.schema(T.StructType([*schema, T.StructField(DAY, T.DateType())])).parquet(path)
    within = F.col(DAY).between(F.to_date(F.lit(start)), F.to_date(F.lit(end)))
    return in_range(stored.filter(within), start, end, column).drop(DAY)


def read_listed_days(spark: SparkSession, path: str, schema: T.StructType, days: DataFrame) -> DataFrame:
    """Rows of the days in ``days`` (day date), such as those that a rerun has to do again.

    The list has one row per day, which bounds it; it is broadcast, and the scan is pruned by
    its values while the query runs.  Null days and days without a directory have no rows.
    """
    stored = spark.read.schema(T.StructType([*schema, T.StructField(DAY, T.DateType())])).parquet(path)
    # a comparison, so that the planner counts on the list to leave days out; nulls go with it
    wanted = days.select(F.col(DAY).cast("date").alias(DAY)).filter(F.col(DAY) >= F.lit("0001-01-01").cast("date")).distinct()
    return stored.join(F.broadcast(wanted), DAY, "left_semi").drop(DAY)
