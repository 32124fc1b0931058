"""Mentions that comments take over from their post or from the comment they reply to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlytics.functions.hype import (
    HYPE_THRESHOLD,
    context_confidence,
    guarded_hype,
    lexicon_hype,
    parent_confidence,
)
from threadlytics.operators.filters import analyzable_comments
from threadlytics.operators.spread import hot_keys, join_spread
from threadlytics.operators.threads import nearest_tagged

# How inherited mentions are labelled.
CONTEXT_METHOD = "contextual_inheritance"
CONTEXT_SOURCE = "post_context"
PARENT_METHOD = "inherit"
PARENT_SOURCE = "inherited"


def without_direct(comments: DataFrame, mentions: DataFrame) -> DataFrame:
    """Comments that carry no mention of their own; these never inherit."""
    own = mentions.filter(F.col("kind") == "comment").select(
        F.col("content_reddit_id").alias("reddit_id")
    )
    return comments.join(own, "reddit_id", "left_anti")


def post_context(mentions: DataFrame) -> DataFrame:
    """What posts hand to their comments: their distinct tickers and company names."""
    return (
        mentions.filter(F.col("kind") == "post")
        .groupBy(
            F.col("content_reddit_id").alias("post_reddit_id"), F.upper("ticker").alias("ticker")
        )
        .agg(F.max("company_name").alias("company_name"))
    )


def contextual_hype(comments: DataFrame) -> DataFrame:
    """Comments with ``hype_score``: the native score of the body, guarded and in [0, 1].

    The score is a generated column, as filters on it are not moved below a generator: the
    lexicon is looked up once per comment, over one lower-case copy.
    """
    body = F.coalesce(F.col("body"), F.lit(""))
    score = guarded_hype(F.col("body"), lexicon_hype(body, F.col("quiet_body")))
    return (
        comments.withColumn("quiet_body", F.lower(body))
        .select("*", F.explode(F.array(score)).alias("hype_score"))
        .drop("quiet_body")
    )


def comments_in_context(comments: DataFrame, mentions: DataFrame) -> DataFrame:
    """Untagged comments of tagged posts: the only ones a costly scorer must look at."""
    tagged_posts = (
        mentions.filter(F.col("kind") == "post")
        .select(F.col("content_reddit_id").alias("post_reddit_id"))
        .distinct()
    )
    waiting = analyzable_comments(without_direct(comments, mentions))
    return join_spread(
        waiting,
        tagged_posts,
        "post_reddit_id",
        F.col("reddit_id"),
        how="left_semi",
        hot=hot_keys(comments, "post_reddit_id"),
    )


def contextual_inheritance(
    comments: DataFrame,
    mentions: DataFrame,
    scored: DataFrame | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Mentions that excited, untagged comments take from the tickers of their post.

    ``scored`` replaces the native hype score: comments with a ``hype_score`` column, for
    example from ``scoring.hype_with``.  Scoring and threshold come before the joins, so that
    only ids and scores of keen comments are shuffled, never their texts.  The comments of
    a very busy post are split over many tasks; ``hot`` names such posts, by default those
    with many rows in ``comments``.
    """
    if scored is None:
        scored = contextual_hype(analyzable_comments(comments))
    keen = scored.filter(F.col("hype_score") >= HYPE_THRESHOLD).select(
        "reddit_id", "post_reddit_id", "hype_score", "created_utc"
    )
    keen = without_direct(keen, mentions)
    pairs = join_spread(
        keen,
        post_context(mentions),
        "post_reddit_id",
        F.col("reddit_id"),
        hot=hot_keys(comments, "post_reddit_id") if hot is None else hot,
    )
    return pairs.select(
        F.lit("comment").alias("kind"),
        F.col("reddit_id").alias("content_reddit_id"),
        "post_reddit_id",
        F.lit(0).alias("pos"),
        "ticker",
        F.lit(-1).alias("span_start"),
        F.lit(-1).alias("span_end"),
        context_confidence(F.col("hype_score")).alias("confidence"),
        F.lit(CONTEXT_METHOD).alias("method"),
        "hype_score",
        "company_name",
        F.lit(CONTEXT_SOURCE).alias("inheritance_source"),
        F.col("post_reddit_id").alias("context_post_id"),
        "created_utc",
    )


def mentions_with_context(comments: DataFrame, mentions: DataFrame) -> DataFrame:
    """Direct mentions plus the inherited ones of comments that have none."""
    return mentions.unionByName(contextual_inheritance(comments, mentions))


def parent_inheritance(comments: DataFrame, mentions: DataFrame) -> DataFrame:
    """Mentions that untagged comments take from their nearest tagged ancestor.

    A comment takes all tickers of the one it replies to, softened; its own replies take
    them from it in turn.  ``comments`` needs ``parent_reddit_id`` and ``parent_kind``.
    """
    tagged = mentions.select("kind", "content_reddit_id").distinct()
    nearest = nearest_tagged(comments, tagged).withColumn(
        "ancestor", F.concat_ws(":", "ancestor_kind", "ancestor_id")
    )
    given = mentions.groupBy(
        F.concat_ws(":", "kind", "content_reddit_id").alias("ancestor"), "ticker"
    ).agg(F.max("confidence").alias("confidence"))
    taken = join_spread(nearest, given, "ancestor", F.col("reddit_id"))
    # a comment that landed more than once inherits once
    detail = F.min(F.struct("post_reddit_id", "parent_reddit_id", "created_utc")).alias("detail")
    details = comments.groupBy("reddit_id").agg(detail).select("reddit_id", "detail.*")
    return taken.join(details, "reddit_id").select(
        F.lit("comment").alias("kind"),
        F.col("reddit_id").alias("content_reddit_id"),
        "post_reddit_id",
        "ticker",
        parent_confidence(F.col("confidence"), F.col("distance")).alias("confidence"),
        F.lit(PARENT_METHOD).alias("method"),
        F.lit(0.0).alias("hype_score"),
        F.lit("").alias("company_name"),
        F.lit(PARENT_SOURCE).alias("source"),
        F.col("parent_reddit_id").alias("inherited_from"),
        "distance",
        "created_utc",
    )


def coverage(comments: DataFrame, mentions: DataFrame) -> DataFrame:
    """How many comments have direct, contextual or no tickers, and the share covered."""
    how = (
        mentions.filter(F.col("kind") == "comment")
        .groupBy(F.col("content_reddit_id").alias("reddit_id"))
        .agg(F.max((F.col("method") == CONTEXT_METHOD).cast("int")).alias("inherited"))
    )
    counts = (
        comments.select("reddit_id")
        .join(how, "reddit_id", "left")
        .agg(
            F.count("*").alias("comments"),
            F.count_if(F.col("inherited") == 0).alias("direct"),
            F.count_if(F.col("inherited") == 1).alias("contextual"),
            F.count_if(F.col("inherited").isNull()).alias("uncovered"),
        )
    )
    share = F.try_divide(F.col("direct") + F.col("contextual"), F.col("comments")) * 100
    return counts.withColumn("coverage_pct", share.cast("double"))
