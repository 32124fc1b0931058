"""Filters, projections and ordered limits over posts, comments and both together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlytics.functions.text import (
    is_analyzable,
    is_blank,
    is_likely_financial,
    post_text,
)


def unprocessed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("processed_at").isNull())


def processed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("processed_at").isNotNull())


def in_range(df: DataFrame, start: str, end: str, column: str = "created_utc") -> DataFrame:
    """Half-open ``start <= column < end``; plain comparisons, so the scan can use them."""
    moment = F.col(column)
    return df.filter(
        (moment >= F.lit(start).cast("timestamp")) & (moment < F.lit(end).cast("timestamp"))
    )


def analyzable_comments(comments: DataFrame) -> DataFrame:
    """Comments with text of their own: neither blank nor a removal placeholder."""
    return comments.filter(is_analyzable(F.col("body")))


def analyzable_posts(posts: DataFrame) -> DataFrame:
    """Posts with their combined ``post_text``, blank ones left out."""
    combined = posts.withColumn("post_text", post_text(F.col("title"), F.col("text")))
    return combined.filter(~is_blank(F.col("post_text")))


def likely_financial(posts: DataFrame) -> DataFrame:
    return posts.filter(is_likely_financial(F.col("title"), F.col("text")))


def top_posts_of_day(posts: DataFrame, as_of: str, n: int = 3) -> DataFrame:
    """Best-scored posts of the day before ``as_of`` (a top-n, no full sort)."""
    until = F.lit(as_of).cast("timestamp")
    recent = posts.filter(
        (F.col("created_utc") > until - F.expr("INTERVAL 1 DAY")) & (F.col("created_utc") <= until)
    )
    return recent.orderBy(F.desc("score"), "reddit_id").limit(n)


def oldest_first(df: DataFrame, limit: int | None = None) -> DataFrame:
    """By time, unknown times last, ties by id."""
    ordered = df.orderBy(F.asc_nulls_last("created_utc"), "reddit_id")
    return ordered if limit is None else ordered.limit(limit)


def first_by_id(df: DataFrame, limit: int) -> DataFrame:
    """A limit without a meaningful order, made repeatable by the key."""
    return df.orderBy("reddit_id").limit(limit)


def preview(text: Column, width: int) -> Column:
    return F.left(F.coalesce(text, F.lit("")), F.lit(width))


def post_texts(posts: DataFrame) -> DataFrame:
    return posts.select(
        F.lit("post").alias("kind"),
        F.col("reddit_id"),
        F.col("reddit_id").alias("post_reddit_id"),
        post_text(F.col("title"), F.col("text")).alias("text"),
        "score",
        "num_comments",
        "created_utc",
        "processed_at",
    )


def comment_texts(comments: DataFrame) -> DataFrame:
    return comments.select(
        F.lit("comment").alias("kind"),
        "reddit_id",
        "post_reddit_id",
        F.col("body").alias("text"),
        "score",
        F.lit(0).alias("num_comments"),
        "created_utc",
        "processed_at",
    )


def content_union(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Posts and comments as one stream of texts."""
    return post_texts(posts).unionByName(comment_texts(comments))


def analyzable(content: DataFrame) -> DataFrame:
    """Rows of :func:`content_union` that are worth a look at their text."""
    return content.filter(is_analyzable(F.col("text")) | (
        (F.col("kind") == "post") & ~is_blank(F.col("text"))
    ))
