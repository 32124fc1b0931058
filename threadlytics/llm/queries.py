"""The corpus operators as queries over whole tables, with their production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from threadlytics.llm import credentials, divergence, interaction, labelling, lines, mixing, packing, pages, quality, quantisation, simhash, substring, topk
from threadlytics.llm.common import table


def op4_simhash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    groups = simhash.near_duplicates(docs, shingle=3, radius=2)
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, eos=2).drop("ids")


def op9_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", mixing.n_words("text").alias("size"), "source")
    rows, entries = mixing.queue(docs, weights=(5, 2, 1), repeats=3)
    taken = entries.groupBy("row_id").agg(F.sum("taken").alias("taken"))
    return rows.join(taken, "row_id", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def op5_lines(spark, sf_dir):
    kept = lines.drop_common_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op7_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = credentials.scan(docs, credentials.train(docs, sample=4000))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def op8_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rated = quality.rate(docs, quality.train(docs, table(spark, sf_dir, "labels"), sample=12_000))
    return rated.withColumn("selected", F.col("tail_probability") >= quality.SELECT)


def op10_pages(spark, sf_dir):
    found = table(spark, sf_dir, "pages")
    texts = pages.extract(found, pages.train(found, sample=2000))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op3_topk(spark, sf_dir):
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"), scale=256)
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op2_embeddings(spark, sf_dir):
    return quantisation.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95, margin=0.1)


def op1_substrings(spark, sf_dir):
    kept = substring.drop_repeats(table(spark, sf_dir, "documents"), window=35, anchor=8)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op11_filters(spark, sf_dir):
    masks = interaction.document_masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return interaction.audit(masks, "ABCDE")


def op12_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return labelling.judge(docs, labelling.train(docs, table(spark, sf_dir, "labels"), sample=6000), share=0.3)


def op13_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"), min_docs=3, top=200)
