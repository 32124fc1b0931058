"""Analysis of contents that arrive, that were stored, or that wait for their turn."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlytics.operators import filters, inheritance, mentions as direct
from threadlytics.operators.spread import hot_keys
from threadlytics.session import cut_lineage


class Analysis(NamedTuple):
    """``items``: contents looked at; ``mentions``: what they mention, before deduplication;
    ``handled``: (kind, reddit_id) of all that a run is done with, blank and deleted too."""

    items: DataFrame
    mentions: DataFrame
    handled: DataFrame


def _of_kind(content: DataFrame, kind: str) -> DataFrame:
    return content.filter(F.col("kind") == kind)


def _handled(content: DataFrame) -> DataFrame:
    return content.select("kind", "reddit_id")


def _on_record(stored: DataFrame | None, found: DataFrame) -> DataFrame:
    """Mentions of earlier runs plus those just found, as far as inheritance needs them."""
    columns = ["kind", "content_reddit_id", "ticker", "company_name"]
    fresh = found.select(*columns)
    return fresh if stored is None else stored.select(*columns).unionByName(fresh)


def analyze_with_context(
    content: DataFrame,
    symbols: DataFrame,
    stored: DataFrame | None = None,
) -> Analysis:
    """Direct mentions of ``content``, and inherited ones of its untagged comments.

    ``stored`` holds mentions of earlier runs, so a comment may inherit from a post that was
    analysed before.  The direct mentions are read by three later steps; they are written to
    the shared folder once instead of extracting three times.
    """
    items = filters.analyzable(content)
    found = cut_lineage(direct.direct_mentions(items, symbols))
    waiting = _of_kind(items, "comment").withColumnRenamed("text", "body")
    # Counted over all comments, so that only their post ids are read for it.
    busy = hot_keys(_of_kind(content, "comment"), "post_reddit_id")
    inherited = inheritance.contextual_inheritance(
        waiting, _on_record(stored, found), scored=inheritance.contextual_hype(waiting), hot=busy
    )
    return Analysis(items, found.unionByName(inherited), _handled(content))


def analyze_stored(posts: DataFrame, comments: DataFrame, symbols: DataFrame,
                   mentions: DataFrame) -> Analysis:
    """Batch path: direct mentions of contents that have none on record."""
    content = direct.unanalyzed(filters.content_union(posts, comments), mentions)
    items = filters.analyzable(content)
    return Analysis(items, direct.direct_mentions(items, symbols), _handled(content))


def analyze_incremental(posts: DataFrame, comments: DataFrame, symbols: DataFrame,
                        mentions: DataFrame | None = None,
                        comment_limit: int | None = None) -> Analysis:
    """Incremental path: contents not processed yet, the oldest comments first.

    ``maintenance.mark_processed`` takes ``handled`` once the mentions are stored.
    """
    waiting = filters.unprocessed(comments)
    if comment_limit is not None:
        waiting = filters.oldest_first(waiting, comment_limit)
    content = filters.content_union(filters.unprocessed(posts), waiting)
    return analyze_with_context(content, symbols, mentions)


def analyze_on_arrival(posts: DataFrame, comments: DataFrame, symbols: DataFrame,
                       mentions: DataFrame | None = None) -> Analysis:
    """Arrival path: as above over all that arrived, then inheritance down the replies.

    ``comments`` needs ``parent_kind``.
    """
    content = filters.content_union(posts, comments)
    items, found, handled = analyze_with_context(content, symbols, mentions)
    found = cut_lineage(found)
    tagged = found if mentions is None else found.select(
        "kind", "content_reddit_id", "ticker", "confidence"
    ).unionByName(mentions.select("kind", "content_reddit_id", "ticker", "confidence"))
    handed_down = inheritance.parent_inheritance(comments, tagged).select(
        "kind",
        "content_reddit_id",
        "post_reddit_id",
        F.lit(0).alias("pos"),
        "ticker",
        F.lit(-1).alias("span_start"),
        F.lit(-1).alias("span_end"),
        "confidence",
        "method",
        "hype_score",
        "company_name",
        "source",
        "inherited_from",
        "created_utc",
    )
    return Analysis(items, found.unionByName(handed_down, allowMissingColumns=True), handled)
