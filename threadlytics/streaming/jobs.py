"""Streaming jobs.  A checkpoint takes the place of the processed mark.

Per-batch results go to ``batch_id=<n>`` folders of a parquet log.  A batch that runs again
after a failure overwrites its own folder, so every job is idempotent, and a batch costs
what its own rows cost: the log is folded by key when it is read, and :func:`compact` folds what
is there into a base table now and then.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from threadlytics.operators import aggregates, mentions as direct
from threadlytics.operators.filters import analyzable
from threadlytics.operators.maintenance import latest_per_key, sized
from threadlytics.plans import analysis
from threadlytics.schemas import KEYS
from threadlytics.session import cut_lineage

BATCH = "batch_id"


COMPACTED = "compacted"


def append_batch(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that writes each batch to a folder of its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return write


def run(
    stream: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a ``foreachBatch`` job; by default it takes all that is there and stops."""
    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(sink)
        .start()
    )


def _stored(spark: SparkSession, base: str, path: str) -> DataFrame | None:
    """The parquet tables at ``path``, or None if there are none; any other error is raised."""
    try:
        return spark.read.option("basePath", base).option("mergeSchema", True).parquet(path)
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _compacted_upto(spark: SparkSession, path: str) -> int | None:
    """The last batch that a finished compaction holds."""
    finished = _stored(spark, path, f"{path}/{COMPACTED}")
    return None if finished is None else finished.agg(F.max("upto")).head()[0]


def read_log(spark: SparkSession, path: str) -> DataFrame | None:
    """All batches of a log, or None before the first one.

    Batches that were compacted come as one, that of the last of them, so the cost of reading is
    that of the folded rows and of the batches since.
    """
    log, upto = _stored(spark, path, f"{path}/{BATCH}=*"), _compacted_upto(spark, path)
    if upto is None:
        return log
    base = spark.read.parquet(f"{path}/base-{upto}").withColumn(BATCH, F.lit(upto))
    if log is None:
        return base
    return base.unionByName(log.where(F.col(BATCH) > upto), allowMissingColumns=True)


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def compact(spark: SparkSession, path: str, fold: Callable[[DataFrame], DataFrame]) -> int | None:
    """Fold all batches of a log so far into a base table, and return the last of them.

    ``fold`` takes the rows of the log with their batch and returns them folded, without it:
    one of :data:`FOLDS`.  The base table is written first, named as finished after that, and only
    then the folders it holds are removed: a compaction that failed at any point is run again,
    and a batch that runs again after it is not read twice.  A reader that planned before the
    removal has to start again.
    """
    upto = _compacted_upto(spark, path)
    batches = _stored(spark, path, f"{path}/{BATCH}=*")
    consumed = [] if batches is None else [r[0] for r in batches.select(F.col(BATCH).cast("int")).distinct().collect()]
    last = max([n for n in consumed if upto is None or n > upto], default=None)
    if last is not None:
        sized(fold(read_log(spark, path))).write.mode("overwrite").parquet(f"{path}/base-{last}")
        spark.range(1).select(F.lit(last).alias("upto")).write.mode("append").parquet(f"{path}/{COMPACTED}")
        if upto is not None:
            _remove(spark, f"{path}/base-{upto}")
    for batch in consumed:
        _remove(spark, f"{path}/{BATCH}={batch}")
    return upto if last is None else last


# A table that batches look up: a frame that never changes, or a function that reads it anew.
Table = DataFrame | Callable[[SparkSession], DataFrame]


def _now(table: Table, spark: SparkSession) -> DataFrame:
    return table(spark) if callable(table) else table


def _begun(spark: SparkSession, path: str) -> DataFrame:
    log = read_log(spark, path)
    if log is None:
        raise LookupError(f"no batch has been written to {path} yet")
    return log


def ingest(
    stream: DataFrame, table: str, path: str, checkpoint: str, order: str = "landed_at"
) -> StreamingQuery:
    """Keyed upsert of normalised posts or comments; the last landed row of a key wins.

    ``order`` names the column that tells which row of one batch landed last.
    """
    if order not in stream.columns:
        raise ValueError(f"the stream has no column {order!r} to tell the last row of a key")

    def upsert(batch: DataFrame, batch_id: int) -> None:
        append_batch(path)(latest_per_key(batch, KEYS[table], [order]), batch_id)

    return run(stream, upsert, checkpoint)


def current(spark: SparkSession, table: str, path: str) -> DataFrame:
    """The table an ingest log amounts to: the row of the last batch for each key."""
    return FOLDS[table](_begun(spark, path))


def mentions(stream: DataFrame, symbols: Table, path: str, checkpoint: str) -> StreamingQuery:
    """Direct mentions of a stream of contents, each content once across restarts.

    No watermark: a late row is analysed like any other.
    """

    def analyze(batch: DataFrame, batch_id: int) -> None:
        found = direct.direct_mentions(analyzable(batch), _now(symbols, batch.sparkSession))
        append_batch(path)(found, batch_id)

    return run(stream, analyze, checkpoint)


def current_mentions(spark: SparkSession, path: str) -> DataFrame:
    """Best mention per content and ticker over all batches of a mentions log."""
    return FOLDS["mentions"](_begun(spark, path))


ITEM = ["kind", "reddit_id"]
# Batches after which the versions of an edits job are folded by item.
FOLD_EVERY = 20


def _meet(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on the item; ``right`` names it kind_ and reddit_id_.  A missing id is an item as well."""
    return left.join(right, [left[k].eqNullSafe(right[f"{k}_"]) for k in ITEM], how)


def edited_mentions(
    stream: DataFrame, symbols: Table, path: str, checkpoint: str, order: str = "landed_at"
) -> StreamingQuery:
    """Direct mentions of contents that land again and again, edited or not.

    ``order``, a number from 0 on, tells which landing of an item is the last, in a batch and
    over all of them.  The checkpoint holds a log of the versions seen: a digest of the text and
    the order value of an item.  A batch looks up its own items there, so that an unchanged one is
    not analysed again, across restarts.  A batch logs one row without a ticker for every item it
    analysed, beside the mentions: that takes back the tickers of earlier versions, also when an
    edit, a removal or a blank text leaves none.
    """
    versions = f"{checkpoint}/versions"

    def analyze(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _remove(spark, f"{versions}/{BATCH}={batch_id}")  # of an attempt that failed
        if batch_id % FOLD_EVERY == FOLD_EVERY - 1:
            compact(spark, versions, FOLDS["versions"])
        rows = cut_lineage(
            latest_per_key(batch.withColumn(order, F.col(order).cast("long")), ITEM, [order]).withColumns(
                {"digest": F.md5(F.coalesce("text", F.lit(""))), "version": F.coalesce(order, F.lit(-1))}
            )
        )
        seen = items = rows.where("version >= -1")
        known = read_log(spark, versions)
        if known is not None:
            own = rows.select(*[F.col(k).alias(f"{k}_") for k in ITEM])
            before = FOLDS["versions"](_meet(known, own, "left_semi")).select(
                *[F.col(k).alias(f"{k}_") for k in ITEM], F.col("digest").alias("digest_"), F.col("version").alias("version_")
            )
            met = _meet(rows, before, "left").where(F.col("version") >= F.coalesce("version_", F.lit(-1)))
            seen, items = met, met.where(F.col("digest_").isNull() | (F.col("digest") != F.col("digest_")))
        items = cut_lineage(items.select(*stream.columns))
        found = direct.direct_mentions(analyzable(items), _now(symbols, spark))
        analysed = items.select("kind", F.col("reddit_id").alias("content_reddit_id"))
        append_batch(path)(found.unionByName(analysed, allowMissingColumns=True), batch_id)
        append_batch(versions)(seen.select(*ITEM, "digest", "version"), batch_id)

    return run(stream, analyze, checkpoint)


def _last_versions(log: DataFrame) -> DataFrame:
    """The rows of each item's last batch, that without a ticker included."""
    item = ["kind", "content_reddit_id"]
    last = log.groupBy(*item).agg(F.max(BATCH).alias(BATCH))
    return log.join(last, [*item, BATCH], "left_semi").drop(BATCH)


def current_edited_mentions(spark: SparkSession, path: str) -> DataFrame:
    """Best mention per ticker of the last version of each content."""
    return direct.best_mentions(_last_versions(_begun(spark, path)).where(F.col("ticker").isNotNull()))


def contextual(
    stream: DataFrame, symbols: Table, stored: Table, path: str, checkpoint: str
) -> StreamingQuery:
    """Mentions of a stream of contents: direct ones, and for untagged comments inherited ones.

    A comment is asked for tickers of its own before it inherits any.  ``stored`` holds the
    mentions of posts; a function is called in every batch, so that posts analysed in the
    meantime hand their tickers down, while a frame stays as it was when the job started.
    """

    def analyze(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        found = analysis.analyze_with_context(batch, _now(symbols, spark), _now(stored, spark))
        append_batch(path)(found.mentions, batch_id)

    return run(stream, analyze, checkpoint)


def daily_stats(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Live counts and hype per ticker and day: every batch logs the parts of its own mentions.

    No row is too late, and those without a time count as they do in the batch report.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        append_batch(path)(aggregates.daily_parts(batch), batch_id)

    return run(stream, add, checkpoint)


def current_daily_stats(spark: SparkSession, path: str, content: DataFrame) -> DataFrame:
    """``aggregates.daily_stats`` of all batches so far, with the engagement of ``content``."""
    parts = FOLDS["daily_stats"](_begun(spark, path))
    return aggregates.present_daily(parts, content)


def ticker_totals(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Running totals: every batch logs the partial totals of its own mentions."""

    def add(batch: DataFrame, batch_id: int) -> None:
        append_batch(path)(aggregates.partial_totals(batch), batch_id)

    return run(stream, add, checkpoint)


def current_ticker_totals(spark: SparkSession, path: str) -> DataFrame:
    """Totals of all batches so far: the sum of their parts."""
    return aggregates.present_totals(FOLDS["ticker_totals"](_begun(spark, path)))


def _latest(table: str) -> Callable[[DataFrame], DataFrame]:
    return lambda log: latest_per_key(log, KEYS[table], [BATCH]).drop(BATCH)


# How the log of each job is folded, to be read or compacted.
FOLDS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "posts": _latest("posts"),
    "comments": _latest("comments"),
    "mentions": lambda log: direct.best_mentions(log.drop(BATCH)),
    "edited_mentions": _last_versions,
    "versions": lambda log: latest_per_key(log, ITEM, [BATCH]).drop(BATCH),
    "daily_stats": lambda log: aggregates.fold_daily(log.drop(BATCH)),
    "ticker_totals": lambda log: aggregates.fold_totals(log.drop(BATCH)),
}
