"""From raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all of ``docs`` and returns a DataFrame that is
written as Parquet and read again by the next stage.  All but the last return the columns of
``documents``; other columns of an input are not passed on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlytics.llm import lines, mixing, packing, quality, simhash
from threadlytics.llm.common import cut, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the top grade is high enough; fitted on the labels in ``sf_dir``."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), sample=12_000)
    rated = quality.rate(docs, model, carry=COLUMNS[1:])
    return rated.where(F.col("tail_probability") >= quality.SELECT).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share; n_chars is counted anew."""
    kept = lines.drop_common_lines(docs, min_docs=10, min_chars=1, carry=["lang", "source"])
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near-duplicates."""
    return simhash.keep_one(docs.select(*COLUMNS), shingle=3, radius=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; n_chars is that of what it takes."""
    mixed = mixing.mixed(docs.select(*COLUMNS), weights=(5, 2, 1), repeats=3)
    return mixed.withColumn("n_chars", F.length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 ids, with the ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, eos=2)


STAGES = [
    ("quality_classifier", select_quality),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_copies),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

# Fitted weights and a tokenizer's ids cannot be written in SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
