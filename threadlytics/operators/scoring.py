"""User-supplied scorers: functions from a batch of texts to raw responses.

Filters do not move below a Python step, so choose the texts first
(``filters.unprocessed``, ``mentions.unanalyzed``, ``inheritance.comments_in_context``).
Parallelism is that of the input's partitions.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlytics.functions.hype import guarded_hype
from threadlytics.functions.responses import HYPE_FIELD, clean_json
from threadlytics.operators.mentions import mentions_from_responses

Scorer = Callable[[list[str]], list[str | Exception]]


def _replies(scorer: Scorer, texts: list[str]) -> tuple[list, bool]:
    """Replies or faults, one per text, and whether the call failed as a whole."""
    try:
        replies = list(scorer(texts))
        if len(replies) != len(texts):
            raise ValueError(f"{len(replies)} responses to {len(texts)} texts")
        return replies, False
    except Exception as fault:  # noqa: BLE001 - a bad text must not end the job
        return [fault] * len(texts), True


def _answers(scorer: Scorer, texts: list[str], alone: bool) -> list[tuple[str | None, str | None, int]]:
    """(response, error, calls) of each text."""
    one_by_one, calls = alone, 1
    if not alone:
        replies, one_by_one = _replies(scorer, texts)
        if one_by_one and len(texts) > 1:
            # Something in the batch fails: ask one by one, so only the bad texts are lost.
            calls = 2
        else:
            one_by_one = False
    if one_by_one:
        replies = [_replies(scorer, [one])[0][0] for one in texts]
    return [
        (None, f"{type(r).__name__}: {r}", calls) if isinstance(r, Exception) else (r, None, calls)
        for r in replies
    ]


def _ask(df: DataFrame, text: str, make_scorer: Callable[[], Scorer], alone: bool) -> DataFrame:
    """Fill ``response`` or ``error`` of the rows whose ``open`` is true, and count their ``calls``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in batches:
            columns = {name: batch.column(name) for name in batch.schema.names}
            waiting = columns["open"].to_pylist()
            if any(waiting):
                # One client per partition, made only when there is something to ask.
                scorer = scorer or make_scorer()
                texts = [t or "" for t, asked in zip(columns[text].to_pylist(), waiting) if asked]
                answers = iter(_answers(scorer, texts, alone))
                kept = zip(*(columns[c].to_pylist() for c in ("response", "error", "calls")), waiting)
                filled = [next(answers) if asked else (reply, error, n) for reply, error, n, asked in kept]
                columns["response"] = pa.array([r for r, _, _ in filled], pa.string())
                columns["error"] = pa.array([e for _, e, _ in filled], pa.string())
                columns["calls"] = pa.array([n for _, _, n in filled], pa.int32())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return df.mapInArrow(run, schema=df.schema)


def holds_json(response: Column) -> Column:
    return clean_json(response) != ""


def score_with(
    df: DataFrame,
    text: str,
    make_scorer: Callable[[], Scorer],
    usable: Callable[[Column], Column] = holds_json,
    complaint: str = "no JSON in the response",
) -> DataFrame:
    """``df`` with ``response`` and ``error`` of a scorer, which gets a text twice at most.

    ``make_scorer`` is called once per partition and attempt, and returns the scorer.  A scorer may return
    an exception in place of a response, which fails that text alone; if it raises, the texts
    of its call are asked again one by one, and that was their second time.  Otherwise the
    texts whose response is not ``usable`` are asked once more, each by itself.  Both attempts
    and the check between them run in one stage.
    """
    first = _ask(
        df.withColumns(
            {
                "response": F.lit(None).cast(T.StringType()),
                "error": F.lit(None).cast(T.StringType()),
                "calls": F.lit(0),
                "open": F.lit(True),
            }
        ),
        text,
        make_scorer,
        alone=False,
    )
    poor = F.col("error").isNull() & ~F.coalesce(usable(F.col("response")), F.lit(False))
    second = _ask(first.withColumn("open", poor & (F.col("calls") < 2)), text, make_scorer, alone=True)
    return second.withColumn("error", F.when(poor, complaint).otherwise(F.col("error"))).drop("open", "calls")


ENTRY = pa.schema([("digest", pa.string()), ("response", pa.string()), ("error", pa.string()), ("calls", pa.int32())])
ENTRIES = "digest string, response string, error string, calls int"
ASK_AT_ONCE = 64


def _ledger_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder as tasks reach it: a path, or an address that pyarrow knows."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)


def _ask_into(waiting: DataFrame, make_scorer: Callable[[], Scorer], ledger: str, attempt: int, alone: bool) -> None:
    """Ask the texts of ``waiting`` (digest, text) and write each call's answers to the ledger at once.

    A task writes to a folder named by its run and partition, and a task that runs again reads
    that folder first: it goes on after the last answer that was paid for.
    """
    run_id = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        files, root = _ledger_folder(ledger)
        folder = f"{root}/run={run_id}/task={TaskContext.get().partitionId()}"
        files.create_dir(folder, recursive=True)
        kept = [f.path for f in files.get_file_info(pafs.FileSelector(folder)) if f.path.endswith(".parquet")]
        answered = {d for p in kept for d in pq.read_table(p, columns=["digest"], filesystem=files)["digest"].to_pylist()}
        for batch in batches:
            asked = [(d, t) for d, t in zip(*(c.to_pylist() for c in batch.columns)) if d not in answered]
            for at in range(0, len(asked), ASK_AT_ONCE):
                scorer = scorer or make_scorer()
                digests, texts = zip(*asked[at : at + ASK_AT_ONCE])
                told = [(d, r, e, n + attempt) for d, (r, e, n) in zip(digests, _answers(scorer, list(texts), alone))]
                table = pa.table([pa.array(c, f.type) for c, f in zip(zip(*told), ENTRY)], schema=ENTRY)
                name = uuid.uuid4().hex
                # Readers skip names that begin with a mark, so they never see half a file.
                pq.write_table(table, f"{folder}/_{name}", filesystem=files)
                files.move(f"{folder}/_{name}", f"{folder}/{name}.parquet")
            yield pa.RecordBatch.from_arrays([pa.array([len(asked)], pa.int64())], ["asked"])

    waiting.mapInArrow(run, "asked long").agg(F.sum("asked")).collect()


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """(digest, response, error, calls) of all texts that were ever asked, the last answer of each."""
    try:
        entries = spark.read.schema(ENTRIES).option("recursiveFileLookup", True).parquet(ledger)
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        entries = spark.createDataFrame([], ENTRIES)
    last = F.max_by(F.struct("response", "error", "calls"), F.struct("calls", F.col("error").isNull(), "response"))
    return entries.groupBy("digest").agg(last.alias("last")).select("digest", "last.*")


def score_once(
    df: DataFrame,
    text: str,
    make_scorer: Callable[[], Scorer],
    ledger: str,
    usable: Callable[[Column], Column] = holds_json,
    complaint: str = "no JSON in the response",
) -> DataFrame:
    """:func:`score_with` through a ledger: a folder that keeps every answer, by a digest of its text.

    A text is asked twice at most, however often it occurs, in this run or in later ones: distinct
    texts without an entry are asked, and those whose first answer is not ``usable`` once more.
    Answers are written before anything reads them, call by call, so a task or a job that fails
    and runs again asks only what was not answered.  Use a ledger per scorer; the folder must be
    one that all executors reach.  Only distinct open texts go through Python, the other columns of
    ``df`` stay where they are.  A null text is an empty one.
    """
    spark = df.sparkSession
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    rows = df.withColumn("digest", digest)
    texts = rows.groupBy("digest").agg(F.any_value(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    poor = F.col("error").isNull() & ~F.coalesce(usable(F.col("response")), F.lit(False))
    known = read_ledger(spark, ledger)
    open_texts = texts.join(known.select("digest"), "digest", "left_anti")
    _ask_into(open_texts, make_scorer, ledger, attempt=0, alone=False)
    again = read_ledger(spark, ledger).where(poor & (F.col("calls") < 2)).select("digest")
    _ask_into(texts.join(again, "digest", "left_semi"), make_scorer, ledger, attempt=1, alone=True)
    answers = read_ledger(spark, ledger).withColumn("error", F.when(poor, complaint).otherwise(F.col("error"))).drop("calls")
    return rows.drop("response", "error").join(answers, "digest", "left").drop("digest")


def mentions_with(content: DataFrame, make_scorer: Callable[[], Scorer], ledger: str | None = None) -> DataFrame:
    """Mentions of the extraction responses of a scorer; failed texts give none.

    With ``ledger`` the texts are asked by :func:`score_once`.
    """
    if ledger is not None:
        return mentions_from_responses(score_once(content, "text", make_scorer, ledger))
    return mentions_from_responses(score_with(content, "text", make_scorer))


def hype_with(comments: DataFrame, make_scorer: Callable[[], Scorer], ledger: str | None = None) -> DataFrame:
    """Comments with the ``hype_score`` of a scorer; failures and short texts are 0.

    A response whose hype is not a number gets the second attempt as well.  ``ledger`` is that of
    :func:`mentions_with`.
    """

    def value(response: Column) -> Column:
        return F.get_json_object(clean_json(response), HYPE_FIELD)

    rules = (lambda r: value(r).try_cast("double").isNotNull(), "no hype in the response")
    if ledger is not None:
        scored = score_once(comments, "body", make_scorer, ledger, *rules)
    else:
        scored = score_with(comments, "body", make_scorer, *rules)
    return scored.withColumn("hype_score", guarded_hype(F.col("body"), value(F.col("response")))).drop(
        "response", "error"
    )
