"""The given tables seen as posts, comments, mentions, responses and symbols.

The SQL is plain enough to run unchanged in other engines, which the checks make use of.
Tags are added to the texts by fixed formulas, since the given prose has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlytics.schemas import RAW_POSTS
from threadlytics.sources.landing import normalize_comments, normalize_posts, valid_comments

RAW_POSTS_SQL = """
select 'p' || cast(conv_id as string) as id,
  '  Thread ' || cast(conv_id as string) || s.tags || ' ' as title,
  text as selftext,
  'https://example.org/' || cast(conv_id as string) as url,
  case when conv_id % 9 = 4 then null when conv_id % 9 = 5 then ''
    else 'user' || cast(conv_id % 17 as string) end as author,
  case when conv_id % 8 = 3 then null else cast((conv_id * 7) % 50 as int) end as score,
  cast(conv_id % 30 as int) as num_comments,
  cast(conv_id % 3 as int) as total_awards_received,
  case when conv_id % 6 = 5 then null else cast(conv_id % 10 as double) / 10 end as upvote_ratio,
  case when conv_id % 13 = 12 then null
    else cast(1704067200 + conv_id * 7200 as bigint) end as created_utc,
  case when conv_id % 7 = 6 then '' else '/t/' || cast(conv_id as string) end as permalink,
  case when conv_id % 5 = 1 then '' when conv_id % 5 = 2 then null else 'stocks' end as subreddit,
  case when conv_id % 4 = 1 then null else 'DD' end as link_flair_text,
  case when conv_id % 5 = 0 then cast(1704067200 + conv_id * 7200 + 60 as bigint) end as processed_epoch
from {conversations} t join (values (0, ' $TSLA'), (1, ' AAPL and GME'), (2, ''), (3, '')) s(r, tags)
  on (t.conv_id * 5 + t.turn * 3) % 4 = s.r
where turn = 0
"""

RAW_COMMENTS_SQL = """
select case when turn = 6 and conv_id % 10 = 9 then null
    else 'c' || cast(conv_id as string) || 'x' || cast(turn as string) end as id,
  'p' || cast(conv_id as string) as post_id,
  case when turn = 1 then 't3_p' || cast(conv_id as string)
    when turn = 5 and conv_id % 10 = 4 then 'c' || cast(conv_id as string) || 'x4'
    else 't1_c' || cast(conv_id as string) || 'x' || cast(turn - 1 as string) end as parent_id,
  case when conv_id % 9 = 2 then null else 'user' || cast((conv_id + turn) % 23 as string) end as author,
  case when turn = 4 and conv_id % 10 = 3 then null when turn = 4 and conv_id % 10 = 6 then ''
    else s.own || repeat(text, s.copies) || s.tags end as body,
  case when conv_id % 11 = 10 and turn = 2 then cast(0 as bigint)
    when conv_id % 11 = 9 and turn = 2 then null
    else cast(1704067200 + conv_id * 7200 + turn * 60 as bigint) end as created_utc,
  case when conv_id % 8 = 5 then null else cast((conv_id + turn * 3) % 20 as int) end as score,
  cast(turn % 2 as int) as total_awards_received,
  case when (conv_id + turn) % 4 = 0 then split('gold,silver', ',') end as all_awardings,
  case when (conv_id + turn) % 4 < 2 then split('wholesome', ',') end as awardings,
  case when conv_id % 6 = 0 and turn = 1 then cast(1704067200 + conv_id * 7200 + 90 as bigint) end
    as processed_epoch
from {conversations} t join (values (0, '[deleted]', 0, ''), (1, '  ', 0, ''), (2, '', 1, ' LFG!!! 🚀'),
    (3, '', 1, ' diamond hands 💎🙌'), (4, '', 1, ' not sure, seems risky'), (5, '', 1, ' bought $gme'),
    (6, '', 1, ' AAPL calls'), (7, '', 1, ' 🚀 TSLA and brk.b'), (8, '', 1, ' holding'),
    (9, '', 1, ''), (10, '', 1, ''), (11, '', 1, '')) s(r, own, copies, tags)
  on (t.conv_id * 5 + t.turn * 3) % 12 = s.r
where turn > 0
"""

MENTIONS_SQL = """
select event_id, case when event_id % 3 = 0 then 'post' else 'comment' end as kind,
  'u' || cast(user_id as string) as content_reddit_id,
  cast(event_id as int) as pos,
  case when event_id % 97 = 13 then ' ' when event_id % 2 = 0 then upper(event_type)
    else event_type end as ticker,
  cast((event_id * 37) % 71 as double) / 100 + 0.3 as confidence,
  cast(event_id % 40 as int) - 1 as span_start,
  case when event_id % 40 = 0 then -1 else cast(event_id % 40 as int) + 3 end as span_end,
  case when event_id % 7 = 0 then null when event_id % 7 < 4 then 'llm'
    when event_id % 7 = 4 then 'inherit' else 'contextual_inheritance' end as method,
  value / 500 as hype_score,
  case when event_id % 5 < 2 then '' else event_type || ' of user ' || cast(user_id % 7 as string) || ' Inc.' end
    as company_name,
  cast(ts as timestamp) as created_utc
from {events}
"""

RESPONSES_SQL = """
select event_id, case event_id % 8
    when 0 then props
    when 1 then concat('```json', chr(10), props, chr(10), '```')
    when 2 then concat('Here: ', props, ' Hope this helps!')
    when 3 then concat(props, ' and ', props)
    when 4 then 'no json here'
    when 5 then concat('```', props, '```')
    when 6 then concat('[', props, ']')
    else '' end as response
from {events}
"""

# The extraction layout around values of the events.
TICKER_RESPONSES_SQL = """
select event_id, 'post' as kind, 'e' || cast(event_id as string) as reddit_id,
  'e' || cast(event_id as string) as post_reddit_id,
  case event_id % 3 when 0 then 'all in on $' || event_type || ' now'
    when 1 then upper(event_type) || ' it is' else 'nothing' end as text,
  concat(case when event_id % 4 = 0 then 'Sure: ' else '' end,
    '{{"tickers": [', case when event_id % 5 = 4 then '' else concat('{{"symbol": "', event_type, '", "name": "',
      case when event_id % 2 = 0 then 'Some Corp' else '' end, '"}}') end,
    case when event_id % 5 = 3 then ', {{"symbol": "zz"}}' else '' end,
    '], "hype_score": ', case when event_id % 6 = 5 then 'null' else cast(event_id % 10 as string) end, '}}',
    case when event_id % 7 = 6 then ' {{' else '' end) as response,
  cast(ts as timestamp) as created_utc
from {events}
"""

# Later versions of the posts, and posts that are new: updates for a keyed upsert.
POST_UPDATES_SQL = """
select 'p' || cast(conv_id as string) as reddit_id, 'Edit ' || cast(turn as string) as title,
  cast(conv_id % 7 + turn as int) as score, turn as landed_at
from {conversations} where turn > 0
union all
select 'q' || cast(conv_id as string), 'New', cast(1 as int), turn from {conversations} where turn = 0
"""

# Later versions of some comments: other text and score, other awards.
COMMENT_UPDATES_SQL = """
select 'c' || cast(conv_id as string) || 'x' || cast(turn - 1 as string) as reddit_id,
  case when turn % 2 = 0 then 'Edit ' || cast(turn as string) else '[removed]' end as body,
  cast(conv_id % 7 + turn as int) as score,
  case when turn % 3 = 0 then split('platinum,gold', ',') end as award_names, turn as landed_at
from {conversations} where turn > 1 and conv_id % 3 > 0
"""

# Every turn read as a landing of one of its thread's first three comments.
COMMENT_LANDINGS_SQL = """
select 'c' || cast(conv_id as string) || 'x' || cast(turn % 3 as string) as id,
  'p' || cast(conv_id as string) as post_id, 't3_p' || cast(conv_id as string) as parent_id, role as author,
  ' ' || text as body, cast(1704067200 + conv_id * 7200 + turn as bigint) as created_utc, cast(turn as int) as score,
  cast(null as int) as total_awards_received,
  case when turn % 2 = 0 then split('gold,silver', ',') end as all_awardings,
  case when turn % 3 = 0 then split('wholesome', ',') end as awardings, turn as landed_at
from {conversations} where turn > 0
"""

# Comments in trees: turn n replies to turn n / 2; every third one landed twice.
BRANCHING_SQL = """
select 'c' || cast(conv_id as string) || 'x' || cast(turn as string) as reddit_id,
  'p' || cast(conv_id as string) as post_reddit_id,
  case when turn = 1 then 'p' || cast(conv_id as string)
    else 'c' || cast(conv_id as string) || 'x' || cast(cast(floor(turn / 2) as int) as string) end as parent_reddit_id,
  case when turn = 1 then 'post' else 'comment' end as parent_kind,
  cast(1704067200 + conv_id * 7200 + turn as bigint) as created_epoch
from {conversations} t join (values (0, 1), (1, 0), (2, 0), (0, 2)) s(r, copy) on turn % 3 = s.r where turn > 0
"""

# What a content says in its second and third landing; by score some stay as they are.
EDITS = {
    2: "case when score % 3 = 1 then case when score % 2 = 0 then 'Sold it all for $GME' else 'Sold it' end else text end",
    3: "case when score % 3 = 1 then case when score % 2 = 0 then 'Sold it all for $GME' else 'Sold it' end "
       "when score % 3 = 2 then ' ' else text end",
}

# Every turn read as a landing of its thread's post.
POST_LANDINGS_SQL = """
select 'p' || cast(conv_id as string) as id, ' Turn ' || cast(turn as string) as title,
  text as selftext, cast(null as string) as url, role as author, cast(turn as int) as score,
  cast(null as int) as num_comments, cast(null as int) as total_awards_received,
  cast(null as double) as upvote_ratio, cast(1704067200 + conv_id * 7200 as bigint) as created_utc,
  '' as permalink, '' as subreddit, cast(null as string) as link_flair_text, turn as landed_at
from {conversations}
"""

SYMBOLS_SQL = """
select * from (values ('TSLA', 'Tesla Inc.'), ('AAPL', 'Apple Inc.'), ('GME', ''),
  ('BRK.B', 'Berkshire Hathaway Inc.'), ('BTC', 'Bitcoin')) as s(symbol, name)
"""

# A symbol file per day: objects on even days of the month, bare arrays on odd ones.
SYMBOL_FILES_SQL = """
select case when extract(day from ts) % 2 = 0
    then concat('{{"symbols": ["', event_type, '", " ', event_type, 's ", 7, null], "updated_at": 1.5}}')
    else concat('["', lower(event_type), '", {{"a": 1}}, "u', cast(user_id % 50 as string), '"]') end as value
from {events}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose columns are costly to look through, on all cores.

    The given files hold one row group each, which one task reads whatever the session's split
    sizes are; fewer files than cores are dealt out once.  Larger tables are read as they lie.
    """
    scan, cores = table(spark, sf_dir, name), spark.sparkContext.defaultParallelism
    return scan.repartition(cores) if len(scan.inputFiles()) < cores else scan


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream, be it one file or a folder of files.

    The path is a pattern that only the table matches: a plain path would be the base of
    partitions to the source of the stream, which has to be a folder.
    """
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name}.parque[t]")


def _sql(spark: SparkSession, query: str, sf_dir: str, name: str, read=table) -> DataFrame:
    return spark.sql(query, **{name: read(spark, sf_dir, name)})


def raw_posts(spark: SparkSession, sf_dir: str, read=table) -> DataFrame:
    return _sql(spark, RAW_POSTS_SQL, sf_dir, "conversations", read).withColumn(
        "processed_at", F.timestamp_seconds("processed_epoch")
    )


def raw_comments(spark: SparkSession, sf_dir: str, read=table) -> DataFrame:
    return _sql(spark, RAW_COMMENTS_SQL, sf_dir, "conversations", read).withColumn(
        "processed_at", F.timestamp_seconds("processed_epoch")
    )


def posts(spark: SparkSession, sf_dir: str, read=table) -> DataFrame:
    return normalize_posts(raw_posts(spark, sf_dir, read), keep=("processed_at",))


def comments(spark: SparkSession, sf_dir: str, read=table) -> DataFrame:
    return normalize_comments(
        valid_comments(raw_comments(spark, sf_dir, read)), keep=("processed_at",)
    )


def awards(names: Column) -> Column:
    """Names of awards as the forum lands them, a map each."""
    return F.transform(names, lambda name: F.create_map(F.lit("name"), name))


def landed_comments(spark: SparkSession, sf_dir: str, read=table) -> DataFrame:
    """Raw comments in the layout of a landing, awards and all."""
    return raw_comments(spark, sf_dir, read).withColumns(
        {name: awards(F.col(name)) for name in ("all_awardings", "awardings")}
    )


def comment_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sql(spark, COMMENT_UPDATES_SQL, sf_dir, "conversations")
    return rows.withColumn("awards", awards(F.coalesce("award_names", F.array()))).drop("award_names")


def comment_landings(spark: SparkSession, sf_dir: str, read=table) -> DataFrame:
    return _sql(spark, COMMENT_LANDINGS_SQL, sf_dir, "conversations", read).withColumns(
        {name: awards(F.col(name)) for name in ("all_awardings", "awardings")}
    )


def post_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed posts as JSON lines; some are cut short, some have no id or an empty one."""
    rows = raw_posts(spark, sf_dir)
    number = F.substring("id", 2, 20).cast("long")
    odd = F.when(number % 10 == 7, F.when(number % 20 == 7, "").otherwise(F.lit(None))).otherwise(F.col("id"))
    line = F.to_json(F.struct(*[odd.alias("id") if c == "id" else F.col(c) for c in RAW_POSTS.fieldNames()]))
    return rows.select(F.when(number % 10 == 3, F.left(line, F.lit(20))).otherwise(line).alias("value"))


def nested_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, replies): threads as nested JSON; turn n replies to turn n / 2, the first one to the post."""
    turns = table(spark, sf_dir, "conversations").where("turn > 0").select(
        "conv_id", "turn", F.floor(F.log2("turn")).cast("int").alias("level"),
        F.to_json(F.struct(
            F.concat(F.lit("c"), "conv_id", F.lit("x"), "turn").alias("id"), F.col("role").alias("author"),
            F.col("text").alias("body"), (1704067200 + F.col("conv_id") * 7200 + F.col("turn")).alias("created_utc"),
            F.col("turn").alias("score"), (F.col("turn") % 2).alias("total_awards_received"),
            awards(F.when(F.col("turn") % 2 == 1, F.array(F.lit("gold"), F.lit("silver")))).alias("all_awardings"),
            awards(F.when(F.col("turn") % 3 == 0, F.array(F.lit("wholesome")))).alias("awardings"),
        )).alias("own"),
    )
    below = turns.limit(0).select("conv_id", "turn", F.lit("").alias("replies"))
    for level in range(5, -1, -1):
        level_nodes = turns.where(F.col("level") == level).join(below, ["conv_id", "turn"], "left")
        node = F.concat(
            F.expr("left(own, length(own) - 1)"), F.lit(',"replies":['), F.coalesce("replies", F.lit("")), F.lit("]}")
        )
        below = level_nodes.groupBy("conv_id", F.floor(F.col("turn") / 2).cast("int").alias("turn")).agg(
            F.array_join(F.sort_array(F.collect_list(node)), ",").alias("replies")
        )
    return below.select(
        F.concat(F.lit("p"), "conv_id").alias("id"), F.concat(F.lit("["), "replies", F.lit("]")).alias("replies")
    )


def branching_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments whose parents are those of :func:`nested_posts`, each third one landed twice."""
    flat = _sql(spark, BRANCHING_SQL, sf_dir, "conversations")
    return flat.withColumn("created_utc", F.timestamp_seconds("created_epoch"))


def post_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, POST_UPDATES_SQL, sf_dir, "conversations")


def post_landings(spark: SparkSession, sf_dir: str, read=table) -> DataFrame:
    return _sql(spark, POST_LANDINGS_SQL, sf_dir, "conversations", read)


def mentions(spark: SparkSession, sf_dir: str, read=table) -> DataFrame:
    """Mentions before deduplication, with the columns of ``schemas.MENTION_COLUMNS``."""
    return _sql(spark, MENTIONS_SQL, sf_dir, "events", read).select(
        "*",
        F.lit(None).cast("string").alias("post_reddit_id"),
        F.lit(None).cast("string").alias("inheritance_source"),
        F.lit(None).cast("string").alias("context_post_id"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, RESPONSES_SQL, sf_dir, "events", texts)


def ticker_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, TICKER_RESPONSES_SQL, sf_dir, "events", texts)


def symbols(spark: SparkSession) -> DataFrame:
    return spark.sql(SYMBOLS_SQL)


def symbol_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, SYMBOL_FILES_SQL, sf_dir, "events")
