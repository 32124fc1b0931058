"""Backfill of a date range: its scope, its report per day, and where to resume.

A range is one job grouped by day, not a loop over days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlytics.operators.filters import in_range, processed, unprocessed
from threadlytics.operators.inheritance import CONTEXT_METHOD
from threadlytics.plans.analysis import Analysis, analyze_with_context

# The estimator's constants.
ITEMS_PER_SECOND = 2
COST_PER_ITEM = 0.001


def check_range(start: str, end: str) -> None:
    if start >= end:
        raise ValueError(f"start {start} must be before end {end}")


def waiting_content(content: DataFrame, start: str, end: str) -> DataFrame:
    check_range(start, end)
    return in_range(unprocessed(content), start, end)


def scope(content: DataFrame, start: str, end: str) -> DataFrame:
    """Waiting posts, comments and items of the range, with hours and cost estimated."""
    counts = waiting_content(content, start, end).agg(
        F.count_if(F.col("kind") == "post").alias("posts"),
        F.count_if(F.col("kind") == "comment").alias("comments"),
    )
    items = F.col("posts") + F.col("comments")
    return counts.select(
        "posts",
        "comments",
        items.alias("items"),
        (items / ITEMS_PER_SECOND / 3600).alias("estimated_hours"),
        (items * COST_PER_ITEM).alias("estimated_cost"),
        F.datediff(F.lit(end).cast("date"), F.lit(start).cast("date")).alias("days"),
    )


def backfill(
    content: DataFrame, symbols: DataFrame, start: str, end: str, stored: DataFrame | None = None
) -> Analysis:
    """Analysis of the waiting contents of the range; ``items`` holds all of them."""
    waiting = waiting_content(content, start, end)
    return analyze_with_context(waiting, symbols, stored)._replace(items=waiting)


def daily_report(result: Analysis, start: str, end: str) -> DataFrame:
    """Items, mentions and inherited mentions of each day, days without any included.

    A mention carries the time of its content, so items and mentions are counted by day on
    their own and added up; the texts are not joined to their mentions.
    """
    check_range(start, end)
    spark = result.items.sparkSession
    day = F.to_date("created_utc").alias("day")
    zero = F.lit(0).cast("bigint")
    items = result.items.groupBy(day).agg(
        F.count("*").alias("items"), zero.alias("mentions"), zero.alias("inherited")
    )
    found = result.mentions.groupBy(day).agg(
        zero.alias("items"),
        F.count("*").alias("mentions"),
        F.count_if(F.col("method") == CONTEXT_METHOD).alias("inherited"),
    )
    days = spark.range(1).select(
        F.explode(
            F.sequence(F.lit(start).cast("date"), F.date_sub(F.lit(end).cast("date"), 1))
        ).alias("day"),
        zero.alias("items"),
        zero.alias("mentions"),
        zero.alias("inherited"),
    )
    return (
        days.unionByName(items)
        .unionByName(found)
        .groupBy("day")
        .agg(
            F.sum("items").alias("items"),
            F.sum("mentions").alias("mentions"),
            F.sum("inherited").alias("inherited"),
        )
    )


def report_totals(daily: DataFrame) -> DataFrame:
    return daily.agg(
        F.count("*").alias("days"),
        F.sum("items").alias("items"),
        F.sum("mentions").alias("mentions"),
        F.sum("inherited").alias("inherited"),
    )


def resume_point(content: DataFrame, today: str) -> DataFrame:
    """Latest processed day, the day to go on from, and whether that is up to date.

    No row when nothing was processed.
    """
    latest = (
        processed(content)
        .agg(F.max("created_utc").alias("latest"))
        .filter(F.col("latest").isNotNull())
    )
    resume = F.date_add(F.to_date("latest"), 1)
    return latest.select(
        F.to_date("latest").alias("latest_processed"),
        resume.alias("resume_date"),
        (resume >= F.lit(today).cast("date")).alias("up_to_date"),
    )
