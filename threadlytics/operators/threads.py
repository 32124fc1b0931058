"""Reply trees as adjacency lists: depth, and nearest ancestor of a kind.

Both walk upwards by pointer jumping: every round doubles the distance covered, so a
thread of depth d needs about log2(d) joins, not d.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlytics.operators.spread import hot_keys, join_spread
from threadlytics.session import cut_observed


def climb(links: DataFrame) -> DataFrame:
    """Follow ``links`` (id, up, distance, done) until no pointer can move further.

    ``done`` marks rows whose ``up`` is final.  Open rows take over the pointer of the row
    they point at.  Rows that point at no row of ``links`` can never arrive and are dropped,
    as are rows on a cycle.  An id that landed more than once counts once, by its smallest
    pointer.

    A round is one job: the write of its rows also counts them.  As long as any open row can
    arrive, one does in every round, namely the nearest; so the first round without an arrival
    is the last, and circles are not run through.
    """
    counts = {"open": F.count_if(~F.col("done")), "done": F.count_if("done")}
    once = F.min(F.struct("up", "distance", "done")).alias("link")
    hops, seen = cut_observed(links.groupBy("id").agg(once).select("id", "link.*"), **counts)
    arrived = [hops.filter("done").drop("done")]
    pending = hops.filter("NOT done")
    while seen["open"] and seen["done"]:
        step = hops.select(
            F.col("id").alias("up"),
            F.col("up").alias("next_up"),
            F.col("distance").alias("next_distance"),
            F.col("done").alias("next_done"),
        )
        # ids of ``step`` are distinct, so a busy parent is skew on one side, which AQE splits
        moved = pending.join(step, "up").select(
            "id",
            F.col("next_up").alias("up"),
            (F.col("distance") + F.col("next_distance")).alias("distance"),
            F.col("next_done").alias("done"),
        )
        moved, seen = cut_observed(moved, **counts)
        arrived.append(moved.filter("done").drop("done"))
        pending = moved.filter("NOT done")
        # Rows that arrived now end the walk of those that point at them next round.
        hops = hops.filter("done").unionByName(moved)
    result = arrived[0]
    for part in arrived[1:]:
        result = result.unionByName(part)
    return result


def comment_depth(comments: DataFrame) -> DataFrame:
    """Comments with ``depth``: 0 for a reply to the post, null for a lost ancestor.

    Needs ``reddit_id``, ``parent_reddit_id`` and ``parent_kind``.
    """
    links = comments.select(
        F.col("reddit_id").alias("id"),
        F.col("parent_reddit_id").alias("up"),
        F.when(F.col("parent_kind") == "post", 0).otherwise(1).cast("bigint").alias("distance"),
        (F.col("parent_kind") == "post").alias("done"),
    ).filter(F.col("up").isNotNull() & F.col("done").isNotNull())
    depths = climb(links).select(
        F.col("id").alias("reddit_id"), F.col("distance").cast("int").alias("depth")
    )
    return comments.drop("depth").join(depths, "reddit_id", "left")


def nearest_tagged(comments: DataFrame, tagged: DataFrame) -> DataFrame:
    """``(reddit_id, ancestor_kind, ancestor_id, distance)`` of untagged comments.

    ``tagged`` holds the distinct (kind, content_reddit_id) that carry tickers.  Comments
    without a tagged ancestor are left out.
    """
    marks = tagged.select(
        F.col("kind").alias("parent_kind"),
        F.col("content_reddit_id").alias("parent_reddit_id"),
        F.lit(True).alias("tagged_parent"),
    )
    own = tagged.filter(F.col("kind") == "comment").select(
        F.col("content_reddit_id").alias("reddit_id")
    )
    plain = comments.select("reddit_id", "parent_kind", "parent_reddit_id").join(
        own, "reddit_id", "left_anti"
    )
    parent = F.concat_ws(":", "parent_kind", "parent_reddit_id").alias("parent")
    # An untagged comment knows at once whether its parent is tagged; a post is the end.
    parents = join_spread(
        plain.withColumn("parent", parent),
        marks.select(
            F.concat_ws(":", "parent_kind", "parent_reddit_id").alias("parent"), "tagged_parent"
        ),
        "parent",
        F.col("reddit_id"),
        how="left",
        # Counted over all comments, so that neither texts nor tags are read for it.
        hot=hot_keys(comments.select(parent), "parent"),
    )
    links = parents.filter(
        F.col("tagged_parent") | (F.col("parent_kind") == "comment")
    ).select(
        F.concat(F.lit("comment:"), F.col("reddit_id")).alias("id"),
        F.col("parent").alias("up"),
        F.lit(1).cast("bigint").alias("distance"),
        F.coalesce("tagged_parent", F.lit(False)).alias("done"),
    )
    place = F.split(F.col("up"), ":", 2)
    return climb(links).select(
        F.substring_index("id", ":", -1).alias("reddit_id"),
        place[0].alias("ancestor_kind"),
        place[1].alias("ancestor_id"),
        "distance",
    )
