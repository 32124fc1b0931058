"""Queries over whole tables, one or more per operator.

Each takes a session and a folder of parquet tables.  Times are shown as text and
doubles rounded, so that results compare across engines.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlytics.functions import hype, responses, text as tx, tickers as tk
from threadlytics.operators import (
    aggregates,
    filters,
    inheritance,
    maintenance,
    mentions as direct,
    scoring,
    stored,
    threads,
)
from threadlytics.plans import analysis, backfill
from threadlytics.schemas import (
    BASIC_MENTION_COLUMNS,
    KEYS,
    MENTION_COLUMNS,
    RAW_COMMENTS,
    RAW_POSTS,
    TICKER_DAILY_STATS,
    TICKERS,
)
from threadlytics.session import SETTINGS, cut_lineage, shared_dir
from threadlytics.sources import adapters, days, landing, symbols as symbol_files
from threadlytics.streaming import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

AS_OF = "2024-01-05 00:00:00"
DAY_END = "2024-01-02 00:00:00"
RANGE = ("2024-01-02", "2024-01-06")
SPAN_KEYS = ["TO", "DER", "NDLY", "THE", "ZZZZ"]


def query(function: Callable[[SparkSession, str], DataFrame]):
    """Register a query; it runs with times in UTC."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        zone = "spark.sql.session.timeZone"
        spark.conf.set(zone, SETTINGS[zone])
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def six(name: str):
    return F.round(name, 6).alias(name)


def content(spark: SparkSession, sf_dir: str, read=adapters.table) -> DataFrame:
    return filters.content_union(
        adapters.posts(spark, sf_dir, read), adapters.comments(spark, sf_dir, read)
    )


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Direct mentions of all posts and comments."""
    items = filters.analyzable(content(spark, sf_dir))
    return direct.direct_mentions(items, adapters.symbols(spark))


def in_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Direct and contextual mentions of all posts and comments."""
    return analysis.analyze_with_context(content(spark, sf_dir), adapters.symbols(spark)).mentions


def folder(spark: SparkSession) -> str:
    """A fresh shared folder for what a query writes."""
    return f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"


# Sources, sinks and table maintenance


def _landed(raw: DataFrame, schema, path: str) -> None:
    names = [name for name in schema.fieldNames() if name in raw.columns]
    raw.select(*names).write.mode("overwrite").json(path)


def award_names(column: str):
    return F.array_join(F.transform(column, lambda award: award["name"]), ",").alias(column)


@query
def read_submissions(spark, sf_dir):
    """Posts landed as JSON lines, read back with a fixed schema."""
    path = folder(spark)
    _landed(adapters.raw_posts(spark, sf_dir), RAW_POSTS, path)
    return landing.read_submissions(spark, path).select(
        "id", "title", F.md5("selftext").alias("text_md5"), "url", "author", "score", "num_comments",
        "total_awards_received", "upvote_ratio", "created_utc", "permalink", "subreddit",
        "link_flair_text", F.col(landing.CORRUPT).isNull().alias("well_formed"),
    )


@query
def read_comments(spark, sf_dir):
    path = folder(spark)
    _landed(adapters.landed_comments(spark, sf_dir), RAW_COMMENTS, path)
    return landing.read_comments(spark, path).select(
        "id", "post_id", "parent_id", "author", F.md5("body").alias("body_md5"), "created_utc", "score",
        "total_awards_received", award_names("all_awardings"), award_names("awardings"),
        F.col(landing.CORRUPT).isNull().alias("well_formed"),
    )


@query
def top_posts_of_day(spark, sf_dir):
    top = filters.top_posts_of_day(adapters.posts(spark, sf_dir), DAY_END, 3)
    return aggregates.iso_time(top, "created_utc").select(
        "reddit_id", "title", "score", "created_utc"
    )


@query
def normalize_posts(spark, sf_dir):
    posts = landing.normalize_posts(adapters.raw_posts(spark, sf_dir))
    return aggregates.iso_time(posts, "created_utc").withColumn("text", F.md5("text"))


@query
def normalize_comments(spark, sf_dir):
    rows = landing.normalize_comments(adapters.raw_comments(spark, sf_dir))
    return (
        aggregates.iso_time(rows, "created_utc")
        .withColumn("body", F.md5("body"))
        .withColumn("awards", F.array_join("awards", ","))
        .drop("depth")
    )


@query
def valid_comments(spark, sf_dir):
    rows = landing.normalize_comments(
        landing.valid_comments(adapters.raw_comments(spark, sf_dir))
    )
    return rows.select("reddit_id", F.length("body").alias("body_length"))


@query
def comment_depth(spark, sf_dir):
    return threads.comment_depth(adapters.comments(spark, sf_dir)).select(
        "reddit_id", "parent_reddit_id", "depth"
    )


@query
def upsert_posts(spark, sf_dir):
    merged = maintenance.upsert(
        adapters.posts(spark, sf_dir),
        adapters.post_updates(spark, sf_dir),
        ["reddit_id"],
        ["landed_at"],
    )
    return aggregates.iso_time(merged, "created_utc", "processed_at").select(
        "reddit_id", "title", F.md5("text").alias("text_md5"), "score", "subreddit",
        "created_utc", "processed_at",
    )


@query
def upsert_mentions(spark, sf_dir):
    """Stored mentions of one method, updated by those of the others."""
    rows = adapters.mentions(spark, sf_dir)
    stored = direct.best_mentions(rows.filter(F.col("method") == "llm")).select(
        "kind", "content_reddit_id", "ticker", "confidence", "method", "hype_score", "company_name"
    )
    updates = rows.filter(F.col("method") == "contextual_inheritance").select(
        "kind", "content_reddit_id", "ticker", "confidence", "method", "hype_score", "event_id"
    )
    merged = maintenance.upsert(
        stored, updates, ["kind", "content_reddit_id", "ticker"], ["event_id"]
    )
    return merged.select(
        "kind", "content_reddit_id", "ticker", six("confidence"), "method", six("hype_score"),
        "company_name",
    )


def stored_table(spark, kind, schema, shards=8, buckets=4) -> stored.Stored:
    """A stored table at a fresh place."""
    run = uuid.uuid4().hex
    table = stored.Stored(
        f"{kind}_{run}", f"{shared_dir(spark)}/{kind}-{run}", schema, tuple(KEYS[kind]), shards, buckets
    )
    stored.create_stored(spark, table)
    return table


@query
def upsert_stored(spark, sf_dir):
    """The posts as a stored table, updated where it is."""
    posts = adapters.posts(spark, sf_dir)
    table = stored_table(spark, "posts", posts.schema)
    stored.fill(posts, table)
    stored.upsert_stored(adapters.post_updates(spark, sf_dir), table, ["landed_at"])
    return aggregates.iso_time(stored.rows_of(spark, table), "created_utc", "processed_at").select(
        "reddit_id", "title", F.md5("text").alias("text_md5"), "score", "subreddit",
        "created_utc", "processed_at",
    )


@query
def upsert_comments(spark, sf_dir):
    """Comments landed with their awards, stored, and updated by later versions of some."""
    path = folder(spark)
    _landed(adapters.landed_comments(spark, sf_dir), RAW_COMMENTS, path)
    raw = landing.split_landed(spark, path, RAW_COMMENTS).rows
    comments = landing.normalize_comments(landing.valid_comments(raw))
    table = stored_table(spark, "comments", comments.schema)
    stored.fill(comments, table)
    stored.upsert_stored(adapters.comment_updates(spark, sf_dir), table, ["landed_at"])
    return aggregates.iso_time(stored.rows_of(spark, table), "created_utc").select(
        "reddit_id", "post_reddit_id", "parent_reddit_id", "author", F.md5("body").alias("body_md5"), "score",
        "total_awards", award_names("awards"), "created_utc",
    )


@query
def merge_stored_tickers(spark, sf_dir):
    """The stored totals of the mentions up to a day, merged with those of the mentions after it."""
    rows = adapters.mentions(spark, sf_dir)
    table = stored_table(spark, "tickers", TICKERS)
    for batch, as_of in (
        (rows.filter(F.col("created_utc") < F.lit("2024-01-20").cast("timestamp")), AS_OF),
        (rows.filter(F.col("created_utc") >= F.lit("2024-01-20").cast("timestamp")), "2024-02-01 00:00:00"),
    ):
        changed = aggregates.merge_tickers(stored.rows_of(spark, table), batch, as_of)
        stored.upsert_stored(changed, table, ["updated_at"])
    return aggregates.iso_time(
        stored.rows_of(spark, table), "last_mentioned_at", "created_at", "updated_at"
    ).withColumns({c: F.col(c).cast("double") for c in ("avg_hype_score", "max_hype_score")})


@query
def upsert_daily_stats(spark, sf_dir):
    """Stored daily statistics of the first days, replaced and added to by those of all days."""
    found = cut_lineage(in_context(spark, sf_dir))
    items = content(spark, sf_dir)
    table = stored_table(spark, "ticker_daily_stats", TICKER_DAILY_STATS)
    first = found.where(F.col("created_utc") < F.lit("2024-01-04 12:00:00").cast("timestamp"))
    for batch in (first, found):
        stats = aggregates.stored_daily(aggregates.daily_stats(batch, items), AS_OF)
        stored.upsert_stored(stats, table, ["created_at"])
    return stored.rows_of(spark, table).select(
        "ticker", F.col("date").cast("string").alias("date"), "mentions_count", "posts_count", "comments_count",
        F.col("avg_hype_score").cast("double").alias("avg_hype_score"),
        F.col("max_hype_score").cast("double").alias("max_hype_score"), "total_engagement",
    )


@query
def landed_rejects(spark, sf_dir):
    """Landed lines that are no usable post, and why."""
    path = folder(spark)
    adapters.post_lines(spark, sf_dir).write.text(path)
    landed = landing.split_landed(spark, path, RAW_POSTS)
    return landed.rejects.select(
        F.col("file").isNotNull().alias("has_file"), "reason", F.left("record", F.lit(20)).alias("begins")
    ).unionByName(
        landing.normalize_posts(landed.rows).select(
            F.lit(False).alias("has_file"), F.lit("usable").alias("reason"), F.col("reddit_id").alias("begins")
        )
    )


@query
def flatten_nested(spark, sf_dir):
    """Comments of nested trees, with their awards."""
    rows = landing.flatten_nested(adapters.nested_posts(spark, sf_dir))
    return rows.select(
        "id", "post_id", "parent_id", "author", F.md5("body").alias("body_md5"), "created_utc", "score",
        "total_awards_received", award_names("all_awardings"), award_names("awardings"), "depth",
    )


@query
def branching_depth(spark, sf_dir):
    """Depths in branching trees whose comments landed more than once."""
    return threads.comment_depth(adapters.branching_comments(spark, sf_dir)).select(
        "reddit_id", "parent_reddit_id", "depth"
    )


@query
def branching_inheritance(spark, sf_dir):
    """Tickers that comments of branching trees take from their nearest tagged ancestor."""
    return inheritance.parent_inheritance(
        adapters.branching_comments(spark, sf_dir),
        found(spark, sf_dir).where("kind = 'post' or content_reddit_id like '%x2'"),
    ).select(
        "content_reddit_id", "ticker", six("confidence"), "inherited_from", F.col("distance").cast("int").alias("distance")
    )


@query
def symbol_rows(spark, sf_dir):
    """The symbol list as one document per symbol."""
    listed = symbol_files.symbols_of(adapters.symbol_files(spark, sf_dir))
    return symbol_files.symbol_rows(direct.symbol_dim(listed), 1704067200.0)


@query
def ticker_list(spark, sf_dir):
    return aggregates.ticker_list(adapters.mentions(spark, sf_dir))


@query
def clear_counts(spark, sf_dir):
    return maintenance.clear_counts(
        {
            "content_tickers": direct.best_mentions(adapters.mentions(spark, sf_dir)),
            "comments": adapters.comments(spark, sf_dir),
            "posts": adapters.posts(spark, sf_dir),
        }
    )


@query
def evolve_schema(spark, sf_dir):
    """Mentions of the basic layout with the columns of the migration added."""
    basic = direct.best_mentions(adapters.mentions(spark, sf_dir)).select(*BASIC_MENTION_COLUMNS)
    return maintenance.evolve("content_tickers", basic).select(
        "kind", "content_reddit_id", "ticker", six("confidence"),
        F.col("hype_score").cast("double").alias("hype_score"), "company_name",
        F.col("created_at").cast("string").alias("created_at"), "inheritance_source",
        "context_post_id",
    )


@query
def schema_tolerant_mentions(spark, sf_dir):
    """Full mentions cut to what a target of the basic layout takes."""
    full = direct.best_mentions(adapters.mentions(spark, sf_dir))
    target = full.select(*BASIC_MENTION_COLUMNS).schema
    return maintenance.fit_to(full, target, MENTION_COLUMNS).withColumn(
        "confidence", F.round("confidence", 6)
    )


@query
def mark_processed(spark, sf_dir):
    """Comments after a run: the analysed, the blank and the deleted ones are all marked."""
    comments = adapters.comments(spark, sf_dir)
    plan = analysis.analyze_incremental(
        adapters.posts(spark, sf_dir), comments, adapters.symbols(spark)
    )
    done = plan.handled.filter(F.col("kind") == "comment").select("reddit_id")
    marked = maintenance.mark_processed(comments, done, AS_OF)
    return aggregates.iso_time(marked, "processed_at").select("reddit_id", "processed_at")


@query
def load_symbols(spark, sf_dir):
    """Symbols of landed JSON documents of both forms."""
    path = folder(spark)
    adapters.symbol_files(spark, sf_dir).write.mode("overwrite").text(path)
    return symbol_files.symbols_of(spark.read.text(path))


@query
def symbols_json(spark, sf_dir):
    listed = symbol_files.symbols_of(adapters.symbol_files(spark, sf_dir))
    return symbol_files.symbols_document(direct.symbol_dim(listed), 1704067200.0)


# Filters, projections, sort and limit


@query
def unprocessed_items(spark, sf_dir):
    return filters.unprocessed(content(spark, sf_dir)).select("kind", "reddit_id")


@query
def processed_items(spark, sf_dir):
    rows = filters.processed(content(spark, sf_dir))
    return aggregates.iso_time(rows, "processed_at").select("kind", "reddit_id", "processed_at")


@query
def items_in_range(spark, sf_dir):
    rows = filters.in_range(content(spark, sf_dir), *RANGE)
    return aggregates.iso_time(rows, "created_utc").select("kind", "reddit_id", "created_utc")


@query
def events_in_range(spark, sf_dir):
    """The range filter straight on a stored table, where the scan takes it over."""
    events = adapters.table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    rows = events.filter(
        (F.col("ts") >= F.lit(RANGE[0]).cast("timestamp_ntz"))
        & (F.col("ts") < F.lit(RANGE[1]).cast("timestamp_ntz"))
    )
    return rows.select("event_id", "event_type")


@query
def analyzable_comments(spark, sf_dir):
    rows = filters.analyzable_comments(adapters.comments(spark, sf_dir))
    return rows.select("reddit_id", F.length("body").alias("body_length"))


@query
def post_text(spark, sf_dir):
    rows = filters.analyzable_posts(adapters.posts(spark, sf_dir))
    return rows.select(
        "reddit_id", F.md5("post_text").alias("text_md5"), F.length("post_text").alias("n_chars")
    )


@query
def likely_financial(spark, sf_dir):
    """Documents as posts whose title is the source."""
    documents = adapters.texts(spark, sf_dir, "documents").withColumnRenamed("source", "title")
    return filters.likely_financial(documents).select("doc_id")


@query
def oldest_unprocessed(spark, sf_dir):
    waiting = filters.unprocessed(adapters.comments(spark, sf_dir))
    return filters.oldest_first(waiting, 100).select("reddit_id", "post_reddit_id")


@query
def sample_comments(spark, sf_dir):
    return filters.first_by_id(adapters.comments(spark, sf_dir), 50).select(
        "reddit_id", filters.preview(F.col("body"), 60).alias("preview")
    )


# Joins


@query
def unanalyzed_items(spark, sf_dir):
    return direct.unanalyzed(content(spark, sf_dir), cut_lineage(found(spark, sf_dir))).select(
        "kind", "reddit_id"
    )


@query
def contextual_inheritance(spark, sf_dir):
    rows = inheritance.contextual_inheritance(
        adapters.comments(spark, sf_dir), cut_lineage(found(spark, sf_dir))
    )
    return rows.select(
        "content_reddit_id", "ticker", six("confidence"), six("hype_score"), "company_name",
        "method", "inheritance_source", "context_post_id",
    )


@query
def mentions_with_context(spark, sf_dir):
    rows = inheritance.mentions_with_context(
        adapters.comments(spark, sf_dir), cut_lineage(found(spark, sf_dir))
    )
    return rows.select(
        "kind", "content_reddit_id", "ticker", "span_start", "span_end", six("confidence"),
        "method", six("hype_score"), "company_name", "context_post_id",
    )


@query
def parent_inheritance(spark, sf_dir):
    rows = inheritance.parent_inheritance(
        adapters.comments(spark, sf_dir), cut_lineage(in_context(spark, sf_dir))
    )
    return rows.select(
        "content_reddit_id", "ticker", six("confidence"), "method", "source", "inherited_from",
        F.col("distance").cast("int").alias("distance"),
    )


@query
def mentions_on_arrival(spark, sf_dir):
    """The arrival path: direct, then contextual, then parent mentions, one per key."""
    result = analysis.analyze_on_arrival(
        adapters.posts(spark, sf_dir), adapters.comments(spark, sf_dir), adapters.symbols(spark)
    )
    return direct.best_mentions(result.mentions).select(
        "kind", "content_reddit_id", "ticker", six("confidence"), "method", six("hype_score")
    )


@query
def mentions_of_batch(spark, sf_dir):
    """The batch path: direct mentions of comments, when those of posts are on record."""
    posts, comments = adapters.posts(spark, sf_dir), adapters.comments(spark, sf_dir)
    stored = cut_lineage(found(spark, sf_dir).filter(F.col("kind") == "post"))
    result = analysis.analyze_stored(posts, comments, adapters.symbols(spark), stored)
    return result.mentions.select("kind", "content_reddit_id", "ticker", "span_start", "span_end")


@query
def valid_tickers(spark, sf_dir):
    """Mentions of documented symbols, the list read from the symbol files."""
    listed = symbol_files.symbols_of(adapters.symbol_files(spark, sf_dir))
    return direct.valid_tickers(adapters.mentions(spark, sf_dir), listed).select(
        "event_id", "ticker"
    )


@query
def ticker_validity(spark, sf_dir):
    listed = symbol_files.symbols_of(adapters.symbol_files(spark, sf_dir))
    return direct.with_validity(adapters.mentions(spark, sf_dir), listed).select(
        "event_id", "ticker", "is_valid"
    )


@query
def posts_with_tickers(spark, sf_dir):
    best = direct.best_mentions(found(spark, sf_dir))
    return direct.posts_with_tickers(adapters.posts(spark, sf_dir), best).select(
        "reddit_id", "title", "score", "ticker", six("confidence"), "method"
    )


@query
def with_company_name(spark, sf_dir):
    return direct.with_company_name(in_context(spark, sf_dir), adapters.symbols(spark)).select(
        "kind", "content_reddit_id", "ticker", "company_name"
    )


# Deduplication and aggregation


@query
def best_mentions(spark, sf_dir):
    return direct.best_mentions(adapters.mentions(spark, sf_dir)).select(
        "kind", "content_reddit_id", "ticker", six("confidence"), "event_id", "span_start",
        "span_end", "method",
    )


@query
def extraction_summary(spark, sf_dir):
    return aggregates.extraction_summary(cut_lineage(found(spark, sf_dir))).withColumn(
        "avg_confidence", F.round("avg_confidence", 6)
    )


@query
def event_summary(spark, sf_dir):
    """The same summary over the larger table of event mentions."""
    return aggregates.extraction_summary(adapters.mentions(spark, sf_dir)).withColumn(
        "avg_confidence", F.round("avg_confidence", 6)
    )


@query
def ticker_totals(spark, sf_dir):
    return aggregates.iso_time(
        aggregates.ticker_totals(adapters.mentions(spark, sf_dir)), "last_mentioned_at"
    )


@query
def merge_ticker_totals(spark, sf_dir):
    """Totals up to a day, merged with those of the mentions after it."""
    rows = adapters.mentions(spark, sf_dir)
    before = rows.filter(F.col("created_utc") < F.lit("2024-01-20").cast("timestamp"))
    after = rows.filter(F.col("created_utc") >= F.lit("2024-01-20").cast("timestamp"))
    merged = aggregates.merge_totals(
        aggregates.partial_totals(before), aggregates.partial_totals(after)
    )
    return aggregates.iso_time(aggregates.present_totals(merged), "last_mentioned_at")


@query
def running_ticker_hype(spark, sf_dir):
    rows = adapters.mentions(spark, sf_dir).withColumn("ticker", F.upper("ticker"))
    return aggregates.running_hype(rows, "event_id").select(
        "ticker", "event_id", "mentions_so_far", "avg_hype_so_far", six("max_hype_so_far")
    )


@query
def ticker_leaderboard(spark, sf_dir):
    totals = aggregates.ticker_totals(in_context(spark, sf_dir))
    return aggregates.leaderboard(totals)


@query
def lineitem_leaderboard(spark, sf_dir):
    """The leaderboard over line items as mentions of their supplier."""
    rows = adapters.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("p"), F.col("l_suppkey").cast("string")).alias("ticker"),
        F.when(F.col("l_linenumber") == 1, "post").otherwise("comment").alias("kind"),
        (F.col("l_discount") * 10).alias("hype_score"),
        F.concat(F.lit("Part "), F.col("l_returnflag"), F.lit(" of a long company name")).alias(
            "company_name"
        ),
        F.col("l_shipdate").cast("timestamp").alias("created_utc"),
    )
    return aggregates.leaderboard(aggregates.ticker_totals(rows))


@query
def method_breakdown(spark, sf_dir):
    return aggregates.method_breakdown(adapters.mentions(spark, sf_dir))


@query
def table_counts(spark, sf_dir):
    return aggregates.table_counts(
        adapters.posts(spark, sf_dir),
        adapters.comments(spark, sf_dir),
        direct.best_mentions(adapters.mentions(spark, sf_dir)),
    )


@query
def overall_summary(spark, sf_dir):
    return aggregates.overall_summary(adapters.mentions(spark, sf_dir)).withColumn(
        "avg_confidence", F.round("avg_confidence", 6)
    )


@query
def backfill_scope(spark, sf_dir):
    return backfill.scope(content(spark, sf_dir), *RANGE).select(
        "posts", "comments", "items", six("estimated_hours"), six("estimated_cost"), "days"
    )


def _on_record(spark, sf_dir):
    """Mentions of the contents that were processed before."""
    before = filters.analyzable(filters.processed(content(spark, sf_dir)))
    return cut_lineage(direct.direct_mentions(before, adapters.symbols(spark)))


def _backfill(spark, sf_dir, start="2024-01-01", end="2024-01-12"):
    result = backfill.backfill(
        content(spark, sf_dir), adapters.symbols(spark), start, end, _on_record(spark, sf_dir)
    )
    return backfill.daily_report(result, start, end)


@query
def backfill_daily(spark, sf_dir):
    return _backfill(spark, sf_dir).withColumn("day", F.col("day").cast("string"))


def _by_day(spark, sf_dir):
    """The contents laid out by day: the folder and their schema."""
    path, rows = folder(spark), content(spark, sf_dir)
    days.write_days(rows, path)
    return path, rows.schema


@query
def backfill_stored_days(spark, sf_dir, start="2024-01-01", end="2024-01-12"):
    rows = days.read_days(spark, *_by_day(spark, sf_dir), start, end)
    result = backfill.backfill(rows, adapters.symbols(spark), start, end, _on_record(spark, sf_dir))
    return backfill.daily_report(result, start, end).withColumn("day", F.col("day").cast("string"))


@query
def contents_of_listed_days(spark, sf_dir):
    listed = spark.createDataFrame([("2024-01-03",), ("2024-01-09",), ("1999-01-01",), (None,)], "day string")
    rows = days.read_listed_days(spark, *_by_day(spark, sf_dir), listed)
    return rows.groupBy("kind", F.to_date("created_utc").cast("string").alias("day")).agg(
        F.count("*").alias("contents"), F.countDistinct("reddit_id").alias("ids")
    )


@query
def backfill_totals(spark, sf_dir):
    return backfill.report_totals(_backfill(spark, sf_dir))


@query
def run_summary(spark, sf_dir):
    result = analysis.analyze_incremental(
        adapters.posts(spark, sf_dir),
        adapters.comments(spark, sf_dir),
        adapters.symbols(spark),
        _on_record(spark, sf_dir),
    )
    return aggregates.run_summary(result.items, result.mentions)


@query
def coverage(spark, sf_dir):
    rows = inheritance.coverage(adapters.comments(spark, sf_dir), in_context(spark, sf_dir))
    return rows.withColumn("coverage_pct", F.round("coverage_pct", 6))


@query
def resume_date(spark, sf_dir):
    rows = backfill.resume_point(content(spark, sf_dir), "2024-02-01")
    return rows.select(
        F.col("latest_processed").cast("string").alias("latest_processed"),
        F.col("resume_date").cast("string").alias("resume_date"),
        "up_to_date",
    )


@query
def ticker_daily_stats(spark, sf_dir):
    stats = aggregates.daily_stats(in_context(spark, sf_dir), content(spark, sf_dir))
    return stats.withColumn("date", F.col("date").cast("string"))


@query
def symbol_dim(spark, sf_dir):
    """Words of the documents that have the shape of a symbol, and how many there are."""
    words = adapters.texts(spark, sf_dir, "documents").select(
        F.explode(F.split("text", "[ \n]")).alias("symbol")
    )
    return aggregates.symbol_count(direct.symbol_dim(words))


# Set operations


@query
def content_union(spark, sf_dir):
    rows = content(spark, sf_dir)
    return aggregates.iso_time(rows, "created_utc").select(
        "kind", "reddit_id", "post_reddit_id", F.md5("text").alias("text_md5"), "created_utc"
    )


# Scalar functions


@query
def clean_json(spark, sf_dir):
    return adapters.responses(spark, sf_dir).select(
        "event_id", responses.clean_json(F.col("response")).alias("json")
    )


@query
def parse_responses(spark, sf_dir):
    rows = direct.mentions_from_responses(adapters.ticker_responses(spark, sf_dir))
    return rows.select(
        "content_reddit_id", "pos", "ticker", "span_start", "span_end", six("confidence"),
        "method", six("hype_score"), "company_name",
    )


@query
def ticker_span(spark, sf_dir):
    keys = F.explode(F.array(*[F.lit(key) for key in SPAN_KEYS])).alias("ticker")
    rows = adapters.texts(spark, sf_dir, "documents").select("doc_id", "text", keys)
    return direct.with_span(rows).select("doc_id", "ticker", "span_start", "span_end")


@query
def extraction_confidence(spark, sf_dir):
    """Confidence of event mentions, seen or not by the place they carry."""
    return adapters.mentions(spark, sf_dir).select(
        "event_id",
        F.round(
            tk.extraction_confidence(
                F.col("ticker"), F.col("company_name"), F.col("span_start") >= 0
            ),
            6,
        ).alias("extraction_confidence"),
    )


@query
def lexicon_hype(spark, sf_dir):
    texts = adapters.texts(spark, sf_dir, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "text"
    ).unionByName(content(spark, sf_dir).select(F.col("reddit_id").alias("id"), "text"))
    return texts.select("id", F.round(hype.lexicon_hype(F.col("text")), 6).alias("hype"))


@query
def contextual_hype(spark, sf_dir):
    return inheritance.contextual_hype(adapters.comments(spark, sf_dir)).select(
        "reddit_id", six("hype_score")
    )


@query
def hype_band(spark, sf_dir):
    return (
        adapters.mentions(spark, sf_dir)
        .groupBy(hype.hype_band(hype.clamp_unit(F.col("hype_score") * 1.5)).alias("band"))
        .agg(F.count("*").alias("mentions"))
    )


@query
def extract_tickers(spark, sf_dir):
    rows = direct.extract_tickers(content(spark, sf_dir), adapters.symbols(spark))
    return rows.select("kind", "reddit_id", "ticker", "company_name")


@query
def base36_id(spark, sf_dir):
    """Base-36 values of all words of each document, as a count and a checksum."""
    words = adapters.texts(spark, sf_dir, "documents").select(
        "doc_id", F.explode(F.split("text", "[ \n]")).alias("word")
    )
    value = tx.base36_id(F.col("word"))
    return words.groupBy("doc_id").agg(
        F.count("*").alias("words"),
        F.count(value).alias("ids"),
        F.sum(value % 1000003).alias("checksum"),
    )


@query
def parent_id(spark, sf_dir):
    full_name = F.col("parent_id")
    return adapters.raw_comments(spark, sf_dir).select(
        "post_id", "created_utc", tx.parent_id(full_name).alias("parent_reddit_id"),
        tx.parent_kind(full_name).alias("parent_kind"),
    )


# Streams: each runs over all that is there into a fresh folder, then reads its log


@query
def stream_upsert_posts(spark, sf_dir):
    run = folder(spark)
    landed = landing.normalize_posts(
        adapters.post_landings(spark, sf_dir, adapters.stream), keep=("landed_at",)
    )
    jobs.ingest(landed, "posts", f"{run}/log", f"{run}/checkpoint").awaitTermination()
    return jobs.current(spark, "posts", f"{run}/log").select(
        "reddit_id", "title", F.md5("text").alias("text_md5"), "author", "score"
    )


@query
def stream_upsert_comments(spark, sf_dir):
    run = folder(spark)
    landed = landing.normalize_comments(
        adapters.comment_landings(spark, sf_dir, adapters.stream), keep=("landed_at",)
    )
    jobs.ingest(landed, "comments", f"{run}/log", f"{run}/checkpoint").awaitTermination()
    jobs.compact(spark, f"{run}/log", jobs.FOLDS["comments"])
    return jobs.current(spark, "comments", f"{run}/log").select(
        "reddit_id", "post_reddit_id", "author", F.md5("body").alias("body_md5"), "score", award_names("awards")
    )


@query
def stream_edits(spark, sf_dir):
    """Contents that land three times, edited in between, by a job that is stopped and started again."""
    run = folder(spark)
    first = content(spark, sf_dir)
    for landing_no in (1, 2, 3):
        text = F.expr(adapters.EDITS[landing_no]) if landing_no > 1 else F.col("text")
        landed = first.withColumn("text", text).withColumn("landed_at", F.lit(landing_no))
        # A file is a batch, and each batch has a fixed cost: a landing has a file a core at most.
        landed.coalesce(spark.sparkContext.defaultParallelism).write.parquet(f"{run}/landed/no={landing_no}")
        if landing_no > 1:
            stream = spark.readStream.schema(
                first.withColumn("landed_at", F.lit(1)).schema
            ).option("maxFilesPerTrigger", 1).parquet(f"{run}/landed/*")
            jobs.edited_mentions(
                stream, adapters.symbols(spark), f"{run}/log", f"{run}/checkpoint"
            ).awaitTermination()
    return jobs.current_edited_mentions(spark, f"{run}/log").select(
        "kind", "content_reddit_id", "ticker", "span_start", "span_end", six("confidence"), six("hype_score")
    )


@query
def stream_mentions(spark, sf_dir):
    run = folder(spark)
    stream = content(spark, sf_dir, adapters.stream)
    jobs.mentions(
        stream, adapters.symbols(spark), f"{run}/log", f"{run}/checkpoint"
    ).awaitTermination()
    return jobs.current_mentions(spark, f"{run}/log").select(
        "kind", "content_reddit_id", "ticker", "span_start", "span_end", six("confidence"),
        six("hype_score"),
    )


@query
def stream_contextual(spark, sf_dir):
    run = folder(spark)
    posts = filters.analyzable(filters.post_texts(adapters.posts(spark, sf_dir)))
    symbols = adapters.symbols(spark)
    direct.direct_mentions(posts, symbols).write.parquet(f"{run}/stored")
    jobs.contextual(
        filters.comment_texts(adapters.comments(spark, sf_dir, adapters.stream)), symbols,
        lambda session: session.read.parquet(f"{run}/stored"), f"{run}/log", f"{run}/checkpoint",
    ).awaitTermination()
    rows = jobs.current_mentions(spark, f"{run}/log")
    return rows.filter(F.col("method") == inheritance.CONTEXT_METHOD).select(
        "content_reddit_id", "ticker", six("confidence"), six("hype_score"), "context_post_id"
    )


@query
def stream_daily_stats(spark, sf_dir):
    run = folder(spark)
    in_context(spark, sf_dir).write.parquet(f"{run}/mentions")
    mentions = spark.read.parquet(f"{run}/mentions")
    stream = spark.readStream.schema(mentions.schema).parquet(f"{run}/mentions")
    jobs.daily_stats(stream, f"{run}/log", f"{run}/checkpoint").awaitTermination()
    rows = jobs.current_daily_stats(spark, f"{run}/log", content(spark, sf_dir))
    return rows.withColumn("date", F.col("date").cast("string"))


@query
def stream_ticker_totals(spark, sf_dir):
    run = folder(spark)
    stream = adapters.mentions(spark, sf_dir, adapters.stream)
    jobs.ticker_totals(stream, f"{run}/log", f"{run}/checkpoint").awaitTermination()
    return aggregates.iso_time(
        jobs.current_ticker_totals(spark, f"{run}/log"), "last_mentioned_at"
    )


# User-supplied scorers


def stub_extractor():
    """Maker of a deterministic scorer: fenced or plain responses, some unusable or failing.

    The maker is a local function, so it travels to the workers by value.
    """

    def make():
        def reply(text: str) -> str:
            if "risky" in text:
                return "I cannot tell."
            if "holding" in text:
                raise ValueError("refused")
            listed = [{"symbol": s.lower(), "name": ""} for s in ("TSLA", "GME") if s in text]
            body = json.dumps({"tickers": listed, "hype_score": 0.5})
            return f"```json\n{body}\n```" if "TSLA" in text else f"Sure! {body}"

        return lambda texts: [reply(text) for text in texts]

    return make


def stub_hype():
    """Maker of a deterministic hype scorer that refuses some texts."""

    def make():
        def reply(text: str) -> str:
            if "risky" in text:
                raise ValueError("refused")
            return json.dumps({"contextual_hype": 1.7 if "🚀" in text else 0.25})

        return lambda texts: [reply(text) for text in texts]

    return make


@query
def score_with_stub(spark, sf_dir):
    items = filters.analyzable(content(spark, sf_dir))
    return scoring.mentions_with(items, stub_extractor()).select(
        "kind", "content_reddit_id", "pos", "ticker", "span_start", "span_end",
        six("confidence"), six("hype_score"),
    )


@query
def score_with_ledger(spark, sf_dir):
    """The same through a ledger: each distinct text is asked, none by the second run."""
    items = filters.analyzable(content(spark, sf_dir))
    ledger = f"{folder(spark)}/ledger"
    scoring.score_once(items, "text", stub_extractor(), ledger)

    def nobody():
        def refuse(texts):
            raise AssertionError("a text was asked again")

        return refuse

    return scoring.mentions_with(items, nobody, ledger).select(
        "kind", "content_reddit_id", "pos", "ticker", "span_start", "span_end",
        six("confidence"), six("hype_score"),
    )


@query
def score_errors(spark, sf_dir):
    """Texts the scorer failed on, and why."""
    items = filters.analyzable(content(spark, sf_dir))
    scored = scoring.score_with(items, "text", stub_extractor())
    return scored.filter(F.col("error").isNotNull()).select("kind", "reddit_id", "error")


@query
def hype_with_stub(spark, sf_dir):
    waiting = inheritance.comments_in_context(
        adapters.comments(spark, sf_dir), cut_lineage(found(spark, sf_dir))
    )
    return scoring.hype_with(waiting, stub_hype()).select("reddit_id", six("hype_score"))
