"""Direct mentions: extraction, validation, deduplication, and joins around them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlytics.functions.hype import lexicon_hype
from threadlytics.functions.responses import RESPONSE_SCHEMA, clean_json
from threadlytics.functions.tickers import (
    extraction_confidence,
    is_symbol_shape,
    length_before_tag,
    length_before_word,
    loose_position,
    normal_symbol,
    ticker_candidates,
)
from threadlytics.operators.membership import not_on_record
from threadlytics.schemas import MENTION_COLUMNS


def symbol_dim(symbols: DataFrame) -> DataFrame:
    """Distinct well-formed symbols, normalised, with a name when one is known."""
    names = F.col("name") if "name" in symbols.columns else F.lit("")
    return (
        symbols.filter(is_symbol_shape(F.col("symbol")))
        .select(normal_symbol(F.col("symbol")).alias("symbol"), names.alias("name"))
        .groupBy("symbol")
        .agg(F.coalesce(F.max("name"), F.lit("")).alias("name"))
    )


def extract_tickers(content: DataFrame, symbols: DataFrame) -> DataFrame:
    """One row per content and tagged symbol of the list, with its place in the text's tags.

    The tags of one text are made distinct before they become rows, and the text stays
    behind: only ids and tags meet the symbol list.
    """
    tags = content.select("*", F.posexplode(ticker_candidates(F.col("text"))).alias("pos", "ticker"))
    return listed(tags.drop("text"), symbols)


def listed(tags: DataFrame, symbols: DataFrame) -> DataFrame:
    """Rows of ``tags`` whose ``ticker`` is on the symbol list, with its ``company_name``."""
    known = symbol_dim(symbols).select(
        F.col("symbol").alias("ticker"), F.col("name").alias("company_name")
    )
    return tags.join(known, "ticker", "inner")


def with_span(df: DataFrame, text: str = "text", ticker: str = "ticker") -> DataFrame:
    """``df`` with the best place of a ticker in its text, -1/-1 when it is not there.

    ``$T`` wins over the bare word, and the word over a mere substring.  Each step only runs
    where the one before found nothing, and none where the text lacks the ticker.
    """
    source, symbol = F.col(text), F.col(ticker)
    size = F.length(symbol)
    there = F.col("loose_at") > 0
    tagged = F.col("before_tag") >= 0
    word = F.col("before_word") >= 0
    steps = (
        df.withColumn("loose_at", F.when(size > 0, loose_position(source, symbol)).otherwise(0))
        .withColumn(
            "before_tag",
            F.when(
                there & F.contains(source, F.lit("$")), length_before_tag(source, symbol)
            ).otherwise(-1),
        )
        .withColumn(
            "before_word",
            F.when(there & ~tagged, length_before_word(source, symbol)).otherwise(-1),
        )
    )
    start = (
        F.when(~there, -1)
        .when(tagged, F.col("before_tag"))
        .when(word, F.col("before_word"))
        .otherwise(F.col("loose_at") - 1)
    )
    width = F.when(~there, 0).when(tagged, size + 1).otherwise(size)
    return (
        steps.withColumn("span_start", start)
        .withColumn("span_end", F.col("span_start") + width)
        .drop("loose_at", "before_tag", "before_word")
    )


def direct_mentions(content: DataFrame, symbols: DataFrame) -> DataFrame:
    """Mentions with span, confidence, hype and company name of each tagged text.

    ``content`` has the columns of ``filters.content_union``.  Hype is scored once per text and
    spans are found beside the text; the join with the symbol list carries no text.
    """
    found = content.select("*", F.explode(F.array(ticker_candidates(F.col("text")))).alias("tags"))
    scored = found.filter(F.size("tags") > 0).select(
        "*", F.explode(F.array(lexicon_hype(F.col("text")))).alias("hype_score")
    )
    tags = scored.select("*", F.posexplode("tags").alias("pos", "ticker"))
    spotted = listed(with_span(tags).drop("text"), symbols)
    return spotted.select(
        "kind",
        F.col("reddit_id").alias("content_reddit_id"),
        "post_reddit_id",
        "pos",
        "ticker",
        "span_start",
        "span_end",
        extraction_confidence(
            F.col("ticker"), F.col("company_name"), F.col("span_start") >= 0
        ).alias("confidence"),
        F.lit("rule").alias("method"),
        "hype_score",
        "company_name",
        F.lit(None).cast("string").alias("inheritance_source"),
        F.when(F.col("kind") == "comment", F.col("post_reddit_id")).alias("context_post_id"),
        "created_utc",
    )


def mentions_from_responses(scored: DataFrame, response: str = "response") -> DataFrame:
    """Mentions of raw extraction responses; one hype score serves all tickers of a text.

    ``scored`` has the columns of ``filters.content_union`` and the response.  A response
    without usable JSON gives no mentions.
    """
    parsed = (
        scored.withColumn("json", clean_json(F.col(response)))
        .withColumn("json", F.from_json("json", RESPONSE_SCHEMA))
        .withColumn(
            "hype_score",
            F.coalesce(F.col("json.hype_score").try_cast("double"), F.lit(0.0)),
        )
        .select("*", F.posexplode("json.tickers").alias("pos", "found"))
        .withColumn("ticker", F.upper(F.coalesce(F.col("found.symbol"), F.lit(""))))
        .withColumn("company_name", F.coalesce(F.col("found.name"), F.lit("")))
    )
    return with_span(parsed).select(
        "kind",
        F.col("reddit_id").alias("content_reddit_id"),
        "post_reddit_id",
        "pos",
        "ticker",
        "span_start",
        "span_end",
        extraction_confidence(
            F.col("ticker"), F.col("company_name"), F.col("span_start") >= 0
        ).alias("confidence"),
        F.lit("llm").alias("method"),
        "hype_score",
        "company_name",
        F.lit(None).cast("string").alias("inheritance_source"),
        F.when(F.col("kind") == "comment", F.col("post_reddit_id")).alias("context_post_id"),
        "created_utc",
    )


def best_mentions(mentions: DataFrame) -> DataFrame:
    """Best mention per (kind, content, ticker): most confident, then first.

    An aggregate rather than a window: copies of one key are folded before the shuffle, so a
    key with very many copies never meets in one task.
    """
    keys = ["kind", "content_reddit_id", "ticker"]
    rest = [name for name in mentions.columns if name not in keys]
    best = F.max_by(F.struct(*rest), F.struct("confidence", -F.col("pos")))
    spans = {"span_start", "span_end"}
    return (
        mentions.groupBy(*keys)
        .agg(best.alias("best"))
        .select(
            *keys,
            *[
                F.nullif(F.col(f"best.{name}"), F.lit(-1)).alias(name)
                if name in spans
                else F.col(f"best.{name}").alias(name)
                for name in rest
            ],
        )
    )


def stored_mentions(mentions: DataFrame) -> DataFrame:
    """Best mentions in the layout of the stored table, hype as DECIMAL(4,2)."""
    best = best_mentions(mentions.select(*MENTION_COLUMNS))
    return best.select(
        "kind",
        "content_reddit_id",
        "ticker",
        "confidence",
        "span_start",
        "span_end",
        "method",
        F.col("hype_score").try_cast("decimal(4,2)").alias("hype_score"),
        "company_name",
        F.col("created_utc").alias("created_at"),
        "inheritance_source",
        "context_post_id",
    )


def unanalyzed(content: DataFrame, mentions: DataFrame) -> DataFrame:
    """Content without any mention of its kind.

    Contents that a filter of the analysed ids does not know stay where they are, with their texts;
    only the rest meets the record.
    """
    seen = mentions.select("kind", F.col("content_reddit_id").alias("reddit_id"))
    return not_on_record(content, seen, ["kind", "reddit_id"])


def valid_tickers(df: DataFrame, symbols: DataFrame, column: str = "ticker") -> DataFrame:
    """Rows whose ticker is on the symbol list."""
    known = symbol_dim(symbols).select(F.col("symbol").alias("known_symbol"))
    return df.join(
        known,
        normal_symbol(F.col(column)) == F.col("known_symbol"),
        "left_semi",
    )


def with_validity(df: DataFrame, symbols: DataFrame, column: str = "ticker") -> DataFrame:
    """All rows, with ``is_valid``: whether the ticker is on the symbol list."""
    known = symbol_dim(symbols).select(F.col("symbol").alias("known_symbol"))
    return (
        df.join(
            known,
            normal_symbol(F.col(column)) == F.col("known_symbol"),
            "left",
        )
        .withColumn("is_valid", F.col("known_symbol").isNotNull())
        .drop("known_symbol")
    )


def with_company_name(df: DataFrame, symbols: DataFrame, column: str = "ticker") -> DataFrame:
    """All rows, with the official company name when it is known, else ''."""
    known = symbol_dim(symbols).select(
        F.col("symbol").alias("known_symbol"), F.col("name").alias("known_name")
    )
    joined = df.drop("company_name").join(
        known,
        normal_symbol(F.col(column)) == F.col("known_symbol"),
        "left",
    )
    return joined.withColumn("company_name", F.coalesce("known_name", F.lit(""))).drop(
        "known_symbol", "known_name"
    )


def posts_with_tickers(posts: DataFrame, mentions: DataFrame) -> DataFrame:
    """Posts with one row per ticker; posts without any keep one row with a null ticker."""
    of_posts = mentions.filter(F.col("kind") == "post").select(
        F.col("content_reddit_id").alias("reddit_id"), "ticker", "confidence", "method"
    )
    return posts.select("reddit_id", "title", "score").join(of_posts, "reddit_id", "left")
