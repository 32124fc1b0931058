"""Table layouts: landed records, stored tables, and the migration's additions."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(spec: str) -> T.StructType:
    """``"name type, ..."`` to a StructType, without needing a session."""
    atomic = {
        "string": T.StringType(),
        "int": T.IntegerType(),
        "bigint": T.LongType(),
        "double": T.DoubleType(),
        "hype": T.DecimalType(4, 2),
        "timestamp": T.TimestampType(),
        "date": T.DateType(),
        "awards": T.ArrayType(T.MapType(T.StringType(), T.StringType())),
    }
    fields = (item.split() for item in spec.split(","))
    return T.StructType([T.StructField(name, atomic[kind]) for name, kind in fields])


# Landed records, as the forum hands them out.
RAW_POSTS = _struct(
    "id string, title string, selftext string, url string, author string, score int,"
    "num_comments int, total_awards_received int, upvote_ratio double, created_utc bigint,"
    "permalink string, subreddit string, link_flair_text string"
)
RAW_COMMENTS = _struct(
    "id string, post_id string, parent_id string, author string, body string,"
    "created_utc bigint, score int, depth int, total_awards_received int,"
    "all_awardings awards, awardings awards"
)

# Stored tables.
POSTS = _struct(
    "reddit_id string, title string, text string, url string, author string, score int,"
    "num_comments int, total_awards int, upvote_ratio double, created_utc timestamp,"
    "permalink string, subreddit string, flair string, reddit_id_int bigint,"
    "processed_at timestamp"
)
COMMENTS = _struct(
    "reddit_id string, post_reddit_id string, parent_reddit_id string, author string,"
    "body string, created_utc timestamp, score int, depth int, total_awards int,"
    "awards awards, processed_at timestamp"
)
CONTENT_TICKERS = _struct(
    "kind string, content_reddit_id string, ticker string, confidence double,"
    "span_start int, span_end int, method string, hype_score hype, company_name string,"
    "created_at timestamp, inheritance_source string, context_post_id string,"
    "source string, inherited_from string"
)
TICKERS = _struct(
    "ticker string, company_name string, total_mentions int, total_posts int,"
    "total_comments int, avg_hype_score hype, max_hype_score hype,"
    "last_mentioned_at timestamp, created_at timestamp, updated_at timestamp"
)
TICKER_DAILY_STATS = _struct(
    "ticker string, date date, mentions_count int, posts_count int, comments_count int,"
    "avg_hype_score hype, max_hype_score hype, total_engagement int, created_at timestamp"
)

TABLES = {
    "posts": POSTS,
    "comments": COMMENTS,
    "content_tickers": CONTENT_TICKERS,
    "tickers": TICKERS,
    "ticker_daily_stats": TICKER_DAILY_STATS,
}

KEYS = {
    "posts": ["reddit_id"],
    "comments": ["reddit_id"],
    "content_tickers": ["kind", "content_reddit_id", "ticker"],
    "tickers": ["ticker"],
    "ticker_daily_stats": ["ticker", "date"],
}

# Columns every version of content_tickers has.
BASIC_MENTION_COLUMNS = [
    "kind",
    "content_reddit_id",
    "ticker",
    "confidence",
    "span_start",
    "span_end",
    "method",
]

# Columns added by the migration (table, column, type, default).
ADDED_COLUMNS = [
    ("content_tickers", "hype_score", "decimal(4,2)", "0.0"),
    ("content_tickers", "company_name", "string", "''"),
    ("content_tickers", "created_at", "timestamp", None),
    ("content_tickers", "inheritance_source", "string", None),
    ("content_tickers", "context_post_id", "string", None),
    ("posts", "processed_at", "timestamp", None),
    ("comments", "processed_at", "timestamp", None),
]

# What must exist after the migration (table, column or whole table).
EXPECTED_OBJECTS = [
    ("posts", "processed_at"),
    ("comments", "processed_at"),
    ("content_tickers", "created_at"),
    ("tickers", None),
    ("ticker_daily_stats", None),
]

# A mention before deduplication, as every extractor of the library returns it.
MENTION_COLUMNS = [
    "kind",
    "content_reddit_id",
    "post_reddit_id",
    "pos",
    "ticker",
    "span_start",
    "span_end",
    "confidence",
    "method",
    "hype_score",
    "company_name",
    "inheritance_source",
    "context_post_id",
    "created_utc",
]
