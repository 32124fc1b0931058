"""The pipeline's stages on a small table, each against plain Python on its own input."""

import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_corpus_operators import brute_fingerprint, brute_lines, brute_targets, roots, words

import __spark_entry__
import corpus_pipeline
from threadlytics.llm import quality


@pytest.fixture(scope="module")
def folder(spark, sf_dir, tmp_path_factory):
    """documents with nulls, empty texts, repeated rows and extra columns, and the labels."""
    where = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = [(90_000, None, "en", None, None), (90_001, "", None, "src0", 0), (90_002, "x " * 30_000, "en", "src1", 60_000), (90_003, "tail", "en", None, 4)]
    odd = spark.createDataFrame(odd, docs.schema)
    every = docs.union(odd).union(docs.where("doc_id in (3, 4)"))
    every = every.withColumns({"hits": F.lit("x"), "taken": F.lit(1), "th": F.lit(None).cast("string"), "grade": F.lit(0)})
    every.write.parquet(f"{where}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(f"{where}/labels.parquet")
    return where


@pytest.fixture(scope="module")
def stages(spark, folder):
    """(name, input rows, output frame) of every stage, outputs written as a driver would."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, folder).write.parquet(f"{folder}/stage{i}")
        docs = spark.read.parquet(f"{folder}/stage{i}")
        out.append((name, before, docs))
    return {name: (before, after) for name, before, after in out}


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_columns(stages):
    for name, (_, after) in list(stages.items())[:-1]:
        assert after.columns == corpus_pipeline.COLUMNS, name


def test_quality_keeps_what_its_model_selects(spark, stages, folder):
    before, after = stages["quality_classifier"]
    model = quality.train(before, spark.read.parquet(f"{folder}/labels.parquet"), sample=12_000)
    want = []
    for r in before.select(*corpus_pipeline.COLUMNS).collect():
        score = model.score(quality.features((r.text or "").encode()), {})
        if model.tails(score)[-1] >= quality.SELECT:
            want.append(tuple(r))
    # a null text is read as an empty one
    assert rows(after, "doc_id", "source") == sorted(((w[0], w[3]) for w in want), key=repr)


def test_lines(stages):
    before, after = stages["line_dedup"]
    want = brute_lines([(r.doc_id, r.text, None) for r in before.collect()], 10)
    assert rows(after, "doc_id", "text", "n_chars") == sorted(((d, t, len(t)) for d, t, _, _ in want), key=repr)


def test_one_of_each_group_stays(stages):
    before, after = stages["simhash_near_dedup"]
    prints = {r.doc_id: brute_fingerprint(r.text) for r in before.collect()}
    links = [(a, b) for a in prints for b in prints if a < b and bin(prints[a] ^ prints[b]).count("1") <= 2]
    root = roots(prints, links)
    assert [d for d, in rows(after, "doc_id")] == sorted((d for d in root if root[d] == d), key=lambda d: repr((d,)))


def test_mix_meets_its_targets(stages):
    before, after = stages["source_mixing"]
    size, used = Counter(), Counter()
    texts = defaultdict(list)
    for r in before.collect():
        size[r.source] += len(words(r.text))
        texts[r.doc_id].append(words(r.text))
    for r in after.collect():
        used[r.source] += len(words(r.text))
        assert any(words(r.text) == t[: len(words(r.text))] for t in texts[r.doc_id])
        assert r.n_chars == len(r.text)
    order = sorted((s for s in size if s is not None), key=str.encode) + [None] * (None in size)
    for s, target in zip(order, brute_targets([size[s] for s in order])):
        # one packet short at most, as the order proves; the surplus is what others are short
        assert target - 32 <= used[s] <= target + 32 * len(order)
    assert sum(used.values()) == sum(size.values())


def test_packing(stages):
    from tokenizers import Tokenizer

    before, after = stages["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for r in before.collect():
        want.update(tokenizer.encode(r.text, add_special_tokens=False).ids + [2])
    got = Counter()
    fill = Counter()
    for r in after.collect():
        got.update(np.frombuffer(r.ids, "<u4").tolist())
        fill[r.sequence_id] += r.length
    assert got == want and max(fill.values()) <= 4096
    assert len(fill) * 4096 - sum(fill.values()) < 4096


def test_run_is_the_stages(spark, stages, folder):
    got = corpus_pipeline.run(spark, folder)
    columns = ["doc_id", "length", "doc_tokens"]
    after = stages["packing"][1]
    assert got.columns == after.columns
    assert Counter(r[0] for r in rows(got, "doc_id")).keys() == Counter(r[0] for r in rows(after, "doc_id")).keys()
    assert got.agg(F.sum("length")).head() == after.agg(F.sum("length")).head(), columns


def test_empty_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0, name


def test_registered():
    names = [n for n in __spark_entry__.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
