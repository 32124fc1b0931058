"""Reports over mentions and contents.

Every grouping folds its rows before the shuffle, so one ticker may hold any share of
them.  Sums are carried beside rounded values, and rounding happens once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from threadlytics.functions.text import ISO_UTC, is_blank
from threadlytics.operators.filters import preview
from threadlytics.operators.inheritance import CONTEXT_METHOD
from threadlytics.session import cut_lineage


def _of_kind(kind: str) -> Column:
    return F.count_if(F.col("kind") == kind)


# Sums of hype are sums of decimals: the order in which parts are added leaves no trace.
ADDEND = "decimal(26,12)"


def addend(hype: Column) -> Column:
    """A hype score as a part of a sum; none where it is no finite number below 10^14."""
    return hype.cast("double").try_cast(ADDEND)


def exact(total: Column) -> Column:
    """A sum of :func:`addend` as a double.

    Runs over other partitions, or after a lost executor, thus report the same means.
    """
    return F.round(total.cast("double"), 9)


def ticker_counts(mentions: DataFrame) -> DataFrame:
    """Per ticker: posts, comments, both together, mean confidence."""
    return mentions.groupBy("ticker").agg(
        _of_kind("post").alias("posts"),
        _of_kind("comment").alias("comments"),
        F.count("*").alias("total"),
        F.avg("confidence").alias("avg_confidence"),
    )


def extraction_summary(mentions: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most mentioned tickers, each with the number of distinct tickers."""
    counts = ticker_counts(mentions)
    n_tickers = mentions.select("ticker").distinct().agg(F.count("*"))
    top = counts.orderBy(F.desc("total"), "ticker").limit(k)
    return top.withColumn("unique_tickers", n_tickers.scalar())


def partial_totals(mentions: DataFrame) -> DataFrame:
    """Ticker totals with their unrounded parts; totals of parts are totals of the whole.

    Counts are taken over mentions before deduplication, blank tickers left out.  A first
    grouping by ticker and company name keeps the bulk of the work a hash aggregate; the
    few rows per ticker left are then folded to the last name known.
    """
    named = mentions.filter(~is_blank(F.col("ticker"))).select(
        F.upper("ticker").alias("ticker"),
        F.coalesce("company_name", F.lit("")).alias("company_name"),
        "kind",
        F.col("hype_score").cast("double").alias("hype_score"),
        "created_utc",
    )
    by_name = named.groupBy("ticker", "company_name").agg(
        F.count("*").alias("total_mentions"),
        _of_kind("post").alias("total_posts"),
        _of_kind("comment").alias("total_comments"),
        F.sum(addend(F.col("hype_score"))).alias("hype_sum"),
        F.max("hype_score").alias("hype_max"),
        F.max("created_utc").alias("last_mentioned_at"),
    )
    return fold_totals(by_name.withColumn("name_at", F.col("last_mentioned_at")))


def fold_totals(parts: DataFrame) -> DataFrame:
    """Add up partial totals per ticker; the last name that is not blank wins."""
    last_name = F.max_by("company_name", F.struct("name_at", "company_name")).alias("company_name")
    blank = F.col("company_name") == ""
    return (
        parts.withColumn("company_name", F.when(~blank, F.col("company_name")))
        .withColumn("name_at", F.when(~blank, F.col("name_at")))
        .groupBy("ticker")
        .agg(
            F.sum("total_mentions").alias("total_mentions"),
            F.sum("total_posts").alias("total_posts"),
            F.sum("total_comments").alias("total_comments"),
            F.sum("hype_sum").alias("hype_sum"),
            F.max("hype_max").alias("hype_max"),
            F.max("last_mentioned_at").alias("last_mentioned_at"),
            F.max("name_at").alias("name_at"),
            last_name,
        )
        .withColumn("company_name", F.coalesce("company_name", F.lit("")))
    )


def present_totals(parts: DataFrame) -> DataFrame:
    """The reported form of partial totals: mean and maximum rounded to two places."""
    return parts.select(
        "ticker",
        "company_name",
        "total_mentions",
        "total_posts",
        "total_comments",
        F.round(exact(F.col("hype_sum")) / F.col("total_mentions"), 2).alias("avg_hype_score"),
        F.round("hype_max", 2).alias("max_hype_score"),
        "last_mentioned_at",
    )


def ticker_totals(mentions: DataFrame) -> DataFrame:
    return present_totals(partial_totals(mentions))


def merge_totals(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing partial totals with those of new mentions added."""
    return fold_totals(existing.unionByName(new))


def hype_decimal(score: Column) -> Column:
    """A hype score as stored, DECIMAL(4,2); null where it does not fit."""
    return F.round(score, 2).try_cast("decimal(4,2)")


def merge_tickers(stored: DataFrame, mentions: DataFrame, as_of: str) -> DataFrame:
    """The rows of a stored ``tickers`` table that a batch of mentions changes or adds.

    Counts are added up, the mean is weighed by them and rounded as it is stored, so a merge
    knows the mean before it to two places only; :func:`merge_totals` keeps unrounded parts.  A
    blank name leaves the stored one, and only ``updated_at`` tells of the merge itself.
    Merging the same batch twice counts it twice.
    """
    now = F.lit(as_of).cast("timestamp")
    new = partial_totals(mentions).select(
        "ticker",
        F.nullif("company_name", F.lit("")).alias("new_name"),
        *[F.col(f"total_{of}").alias(f"new_{of}") for of in ("mentions", "posts", "comments")],
        F.coalesce(exact(F.col("hype_sum")), F.lit(0.0)).alias("new_sum"),
        F.col("hype_max").alias("new_max"),
        F.col("last_mentioned_at").alias("new_last"),
    )
    both = new.join(stored, "ticker", "left")
    count = {
        of: F.coalesce(f"total_{of}", F.lit(0)) + F.col(f"new_{of}") for of in ("mentions", "posts", "comments")
    }
    before = F.coalesce(F.col("avg_hype_score").cast("double"), F.lit(0.0)) * F.coalesce("total_mentions", F.lit(0))
    return both.select(
        "ticker",
        F.coalesce("new_name", "company_name", F.lit("")).alias("company_name"),
        *[count[of].cast("int").alias(f"total_{of}") for of in count],
        hype_decimal((before + F.col("new_sum")) / count["mentions"]).alias("avg_hype_score"),
        hype_decimal(F.greatest(F.col("max_hype_score").cast("double"), "new_max")).alias("max_hype_score"),
        F.greatest("last_mentioned_at", "new_last").alias("last_mentioned_at"),
        F.coalesce("created_at", now).alias("created_at"),
        now.alias("updated_at"),
    )


def stored_daily(stats: DataFrame, as_of: str) -> DataFrame:
    """Daily statistics in the layout of the stored table; mentions without a time have no day there."""
    return stats.where(F.col("date").isNotNull()).select(
        "ticker",
        "date",
        *[F.col(c).cast("int").alias(c) for c in ("mentions_count", "posts_count", "comments_count")],
        hype_decimal(F.col("avg_hype_score")).alias("avg_hype_score"),
        hype_decimal(F.col("max_hype_score")).alias("max_hype_score"),
        F.col("total_engagement").cast("int").alias("total_engagement"),
        F.lit(as_of).cast("timestamp").alias("created_at"),
    )


def running_hype(mentions: DataFrame, mention_id: str) -> DataFrame:
    """Count, mean and maximum of hype of a ticker up to and with each mention.

    One ticker may hold most rows, so its timeline is cut into slices by a range
    partitioning; slices are summed, the few slice sums are accumulated, and each slice is
    scanned on its own, starting from what came before it.  The slices are written down
    first, since a recomputed range partitioning could cut elsewhere.
    """
    order = ["ticker", "created_utc", mention_id]
    sliced = cut_lineage(
        mentions.select(
            "ticker", "created_utc", mention_id, F.col("hype_score").cast("double").alias("hype")
        )
        .repartitionByRange(*order)
        .withColumn("slice", F.spark_partition_id())
    )
    before = W.partitionBy("ticker").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        sliced.groupBy("ticker", "slice")
        .agg(F.count("*").alias("n"), F.sum(addend(F.col("hype"))).alias("s"), F.max("hype").alias("m"))
        .select(
            "ticker",
            "slice",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
            F.coalesce(F.sum("s").over(before), F.lit(0).cast(ADDEND)).alias("s_before"),
            F.max("m").over(before).alias("m_before"),
        )
    )
    inside = (
        W.partitionBy("ticker", "slice")
        .orderBy("created_utc", mention_id)
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    n = F.col("n_before") + F.count("*").over(inside)
    total = F.col("s_before") + F.coalesce(F.sum(addend(F.col("hype"))).over(inside), F.lit(0).cast(ADDEND))
    peak = F.greatest(F.col("m_before"), F.max("hype").over(inside))
    return sliced.join(starts, ["ticker", "slice"]).select(
        "ticker",
        "created_utc",
        mention_id,
        n.alias("mentions_so_far"),
        (exact(total) / n).alias("avg_hype_so_far"),
        peak.alias("max_hype_so_far"),
    )


def leaderboard(totals: DataFrame, k: int = 15) -> DataFrame:
    """The ``k`` tickers with most mentions; company names cut to 19 characters."""
    return (
        totals.orderBy(F.desc("total_mentions"), "ticker")
        .limit(k)
        .select(
            "ticker",
            preview(F.col("company_name"), 19).alias("company"),
            "total_mentions",
            "total_posts",
            "total_comments",
            "avg_hype_score",
            "max_hype_score",
        )
    )


def method_breakdown(mentions: DataFrame) -> DataFrame:
    return (
        mentions.groupBy(F.coalesce("method", F.lit("unknown")).alias("method"))
        .agg(F.count("*").alias("mentions"))
        .orderBy(F.desc("mentions"), "method")
    )


def table_counts(posts: DataFrame, comments: DataFrame, mentions: DataFrame) -> DataFrame:
    """Rows of each table, and the five most mentioned tickers with their counts."""

    def rows(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("n")).select(
            F.lit("table").alias("item"), F.lit(name).alias("name"), "n"
        )

    top = (
        mentions.groupBy("ticker")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "ticker")
        .limit(5)
        .select(F.lit("ticker").alias("item"), F.col("ticker").alias("name"), "n")
    )
    return (
        rows("posts", posts)
        .unionByName(rows("comments", comments))
        .unionByName(rows("content_tickers", mentions))
        .unionByName(top)
    )


def overall_summary(mentions: DataFrame) -> DataFrame:
    """Number of mentions, distinct tickers, mean confidence, and the list of tickers.

    Mentions are folded to one row per ticker first: the printed list is as long as the
    vocabulary of tickers, however many mentions there are.
    """
    per_ticker = mentions.groupBy("ticker").agg(
        F.count("*").alias("n"),
        F.sum("confidence").alias("c"),
        F.count("confidence").alias("n_confidence"),
    )
    return per_ticker.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_extractions"),
        F.count("*").alias("unique_tickers"),
        F.try_divide(F.sum("c"), F.sum("n_confidence")).alias("avg_confidence"),
        F.array_join(F.sort_array(F.collect_list("ticker")), ", ").alias("tickers"),
    )


def ticker_list(mentions: DataFrame) -> DataFrame:
    """All tickers with their mentions, one a row, sorted over all tasks: the list of
    :func:`overall_summary` for vocabularies of any length."""
    return mentions.groupBy("ticker").agg(F.count("*").alias("mentions")).orderBy("ticker")


def run_summary(content: DataFrame, mentions: DataFrame) -> DataFrame:
    """Analysed items, their mentions, and how many were inherited or direct."""
    zero = F.lit(0).cast("bigint")
    items = content.agg(F.count("*").alias("analyzed_items")).select(
        "analyzed_items", zero.alias("mentions"), zero.alias("inherited")
    )
    found = mentions.agg(
        F.count("*").alias("mentions"),
        F.count_if(F.col("method") == CONTEXT_METHOD).alias("inherited"),
    ).select(zero.alias("analyzed_items"), "mentions", "inherited")
    return (
        items.unionByName(found)
        .agg(*[F.sum(c).alias(c) for c in ("analyzed_items", "mentions", "inherited")])
        .withColumn("direct", F.col("mentions") - F.col("inherited"))
    )


DAILY_KEY = ["ticker", "kind", "reddit_id", "date"]


def daily_parts(mentions: DataFrame) -> DataFrame:
    """Mentions and hype per ticker, content and day; parts of any split can be added up."""
    dated = mentions.filter(~is_blank(F.col("ticker"))).withColumn("ticker", F.upper("ticker"))
    return dated.groupBy(
        "ticker",
        "kind",
        F.col("content_reddit_id").alias("reddit_id"),
        F.to_date("created_utc").alias("date"),
    ).agg(
        F.count("*").alias("n"),
        F.sum(addend(F.col("hype_score"))).alias("hype_sum"),
        F.max(F.col("hype_score").cast("double")).alias("hype_max"),
    )


def fold_daily(parts: DataFrame) -> DataFrame:
    """Add up daily parts of several splits of the mentions."""
    return parts.groupBy(*DAILY_KEY).agg(
        F.sum("n").alias("n"), F.sum("hype_sum").alias("hype_sum"), F.max("hype_max").alias("hype_max")
    )


def present_daily(parts: DataFrame, content: DataFrame) -> DataFrame:
    """The reported form of daily parts, one per ticker, content and day."""
    weight = content.select(
        "kind",
        "reddit_id",
        (F.coalesce("score", F.lit(0)) + F.coalesce("num_comments", F.lit(0))).alias("engagement"),
    )
    return (
        parts.join(weight, ["kind", "reddit_id"], "left")
        .groupBy("ticker", "date")
        .agg(
            F.sum("n").alias("mentions_count"),
            F.sum(F.when(F.col("kind") == "post", F.col("n")).otherwise(0)).alias("posts_count"),
            F.sum(F.when(F.col("kind") == "comment", F.col("n")).otherwise(0)).alias(
                "comments_count"
            ),
            (exact(F.sum("hype_sum")) / F.sum("n")).alias("avg_hype"),
            F.max("hype_max").alias("max_hype"),
            F.coalesce(F.sum("engagement"), F.lit(0)).alias("total_engagement"),
        )
        .withColumn("avg_hype_score", F.round("avg_hype", 2))
        .withColumn("max_hype_score", F.round("max_hype", 2))
        .drop("avg_hype", "max_hype")
    )


def daily_stats(mentions: DataFrame, content: DataFrame) -> DataFrame:
    """Per ticker and day of the content: counts, hype, and engagement of distinct contents.

    Engagement is the score of a content plus the comments of a post.  Mentions of one
    content are made distinct before its engagement is counted, so a duplicate mention
    counts once there and twice among the mentions.  Mentions without a time make a day of
    their own.
    """
    return present_daily(daily_parts(mentions), content)


def symbol_count(symbols: DataFrame) -> DataFrame:
    return symbols.agg(F.countDistinct("symbol").alias("symbols"))


def iso_time(df: DataFrame, *columns: str) -> DataFrame:
    """Times as ISO text, for reports."""
    for name in columns:
        df = df.withColumn(name, F.date_format(name, ISO_UTC))
    return df
