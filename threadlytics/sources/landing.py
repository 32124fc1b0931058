"""Landed forum records: reading, normalising and flattening them."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from threadlytics.functions.text import (
    DEFAULT_SUBREDDIT,
    PERMALINK_PREFIX,
    base36_id,
    blank_to_null,
    epoch_or_null,
    epoch_or_zero,
    first_filled_array,
    parent_id,
    parent_kind,
    stripped_or_empty,
)
from threadlytics.schemas import RAW_COMMENTS, RAW_POSTS
from threadlytics.session import shared_dir

CORRUPT = "_corrupt_record"


def _read(spark: SparkSession, path: str, schema: T.StructType, format: str) -> DataFrame:
    if format != "json":
        return spark.read.format(format).schema(schema).load(path)
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(with_corrupt)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def read_submissions(spark: SparkSession, path: str, format: str = "json") -> DataFrame:
    """Landed posts; a JSON line that does not parse is kept in ``_corrupt_record``."""
    return _read(spark, path, RAW_POSTS, format)


def read_comments(spark: SparkSession, path: str, format: str = "json") -> DataFrame:
    """Landed comments; a JSON line that does not parse is kept in ``_corrupt_record``."""
    return _read(spark, path, RAW_COMMENTS, format)


class Landed(NamedTuple):
    """``rows`` that can be used, and ``rejects``: (file, reason, record) of those that cannot."""

    rows: DataFrame
    rejects: DataFrame


def split_landed(spark: SparkSession, path: str, schema: T.StructType) -> Landed:
    """Landed JSON lines, sorted into usable rows and rejects in one read of the files.

    A line is rejected if it does not parse, or if it has no id, by which all later steps know a
    record; its text is kept with the name of its file.  Both parts are folders of one written
    table, so reading one does not touch the other.
    """
    read = _read(spark, path, schema, "json")
    reason = F.when(F.col(CORRUPT).isNotNull(), "does not parse").when(F.coalesce("id", F.lit("")) == "", "no id")
    record = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*schema.fieldNames())))
    sorted_out = read.select(
        *schema.fieldNames(),
        F.when(reason.isNotNull(), F.col("_metadata.file_name")).alias("_file"),
        reason.alias("_reason"),
        F.when(reason.isNotNull(), record).alias("_record"),
        reason.isNotNull().alias("_rejected"),
    )
    place = f"{shared_dir(spark)}/landed-{uuid.uuid4().hex}"
    sorted_out.write.partitionBy("_rejected").parquet(place)
    written = spark.read.schema(sorted_out.schema).parquet(place)
    return Landed(
        written.where(~F.col("_rejected")).select(*schema.fieldNames()),
        written.where("_rejected").select(F.col("_file").alias("file"), F.col("_reason").alias("reason"), F.col("_record").alias("record")),
    )


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast("int")


def normalize_posts(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Landed posts in the layout of the posts table; ``keep`` carries extra columns along.

    Records without an id are left out, as nothing could refer to them; :func:`split_landed` tells
    which they were.
    """
    return raw.filter(F.col("id") != "").select(
        F.col("id").alias("reddit_id"),
        stripped_or_empty(F.col("title")).alias("title"),
        stripped_or_empty(F.col("selftext")).alias("text"),
        "url",
        blank_to_null(F.col("author")).alias("author"),
        _or_zero("score").alias("score"),
        _or_zero("num_comments").alias("num_comments"),
        _or_zero("total_awards_received").alias("total_awards"),
        F.coalesce("upvote_ratio", F.lit(0.0)).alias("upvote_ratio"),
        epoch_or_zero(F.col("created_utc")).alias("created_utc"),
        F.concat(F.lit(PERMALINK_PREFIX), blank_to_null(F.col("permalink"))).alias("permalink"),
        F.coalesce(blank_to_null(F.col("subreddit")), F.lit(DEFAULT_SUBREDDIT)).alias("subreddit"),
        F.coalesce("link_flair_text", F.lit("")).alias("flair"),
        base36_id(F.col("id")).alias("reddit_id_int"),
        *keep,
    )


def valid_comments(raw: DataFrame) -> DataFrame:
    """Landed comments with an id and a body; a body of white space only is one."""
    return raw.filter((F.col("id") != "") & (F.col("body") != ""))


def normalize_comments(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Landed comments in the layout of the comments table, plus the kind of the parent."""
    return raw.select(
        F.col("id").alias("reddit_id"),
        F.col("post_id").alias("post_reddit_id"),
        parent_id(F.col("parent_id")).alias("parent_reddit_id"),
        parent_kind(F.col("parent_id")).alias("parent_kind"),
        blank_to_null(F.col("author")).alias("author"),
        stripped_or_empty(F.col("body")).alias("body"),
        epoch_or_null(F.col("created_utc")).alias("created_utc"),
        _or_zero("score").alias("score"),
        (_or_zero("depth") if "depth" in raw.columns else F.lit(0)).alias("depth"),
        _or_zero("total_awards_received").alias("total_awards"),
        first_filled_array(F.col("all_awardings"), F.col("awardings")).alias("awards"),
        *keep,
    )


# A comment of a nested tree as a landed comment.
FLAT_COMMENT = T.StructType([f for f in RAW_COMMENTS if f.name != "depth"] + [RAW_COMMENTS["depth"]])


def _number(value: object) -> int | None:
    return int(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else None


def _text(value: object) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value)


def _awards(value: object) -> list[list[tuple[str, str | None]]] | None:
    if not isinstance(value, list):
        return None
    return [[(k, _text(v)) for k, v in award.items()] for award in value if isinstance(award, dict)]


def _comments_below(post_id: str, forest: str | None) -> Iterator[tuple]:
    """Comments of a tree in the order of its text; a tree that is no JSON list has none."""
    try:
        roots = json.loads(forest or "[]")
    except (ValueError, RecursionError):
        return
    waiting = [(node, f"t3_{post_id}", 0) for node in reversed(roots)] if isinstance(roots, list) else []
    while waiting:
        node, parent, depth = waiting.pop()
        if not isinstance(node, dict):
            continue
        yield (
            _text(node.get("id")), post_id, parent, _text(node.get("author")), _text(node.get("body")),
            _number(node.get("created_utc")), _number(node.get("score")), _number(node.get("total_awards_received")),
            _awards(node.get("all_awardings")), _awards(node.get("awardings")), depth,
        )
        below = node.get("replies")
        if isinstance(below, list):
            waiting.extend((reply, f"t1_{node.get('id')}", depth + 1) for reply in reversed(below))


def flatten_nested(posts: DataFrame, replies: str = "replies") -> DataFrame:
    """Landed comments of reply trees that are nested in JSON text, whatever their depth.

    ``posts`` has ``id`` and the column ``replies``: a JSON array of comments, each with its own
    ``replies``.  One pass over the trees, in one job: a tree is walked where it lies, with a list
    of its open comments, and leaves as rows with all fields of a landed comment.  Trees that do
    not parse give no rows, and neither do posts without an id.
    """
    names = FLAT_COMMENT.fieldNames()
    kinds = to_arrow_schema(FLAT_COMMENT).types

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                row for post_id, forest in zip(*(c.to_pylist() for c in batch.columns)) for row in _comments_below(post_id, forest)
            ]
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names)

    trees = posts.where(F.col("id").isNotNull()).select(F.col("id").cast("string"), F.col(replies).cast("string"))
    return trees.mapInArrow(run, FLAT_COMMENT)
