import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from threadlytics.operators import membership, mentions


@pytest.mark.parametrize("per_word, most", [(2, 0.002), (4, 0.01), (8, 0.05)])
def test_filter_knows_its_keys_and_few_others(spark, per_word, most):
    words = 1 << 13
    n = words * per_word
    ids = spark.range(2 * n).withColumn("kind", F.when(F.col("id") % 3 == 0, "post").otherwise("comment"))
    known = membership.bloom_filter(ids.where(F.col("id") < n), ["kind", "id"], words)
    told = membership.with_maybe(ids, ["kind", "id"], known, words)
    ours, others = told.agg(
        F.count_if(F.col("maybe") & (F.col("id") < n)), F.count_if(F.col("maybe") & (F.col("id") >= n))
    ).head()
    assert ours == n and others / n <= most
    assert known.count() <= words


@pytest.mark.parametrize("words", [1, 64, 1 << 20])
def test_not_on_record_is_the_anti_join(spark, words):
    """Also with a filter that lets everything pass, repeated keys and rows, null keys, and without a record."""
    schema = "kind string, reddit_id string, text string"
    rows = [("post" if i % 2 else "comment", f"k{i % 150}", f"t{i}") for i in range(300)]
    rows += [("post", None, "x"), (None, "k1", "y"), (None, None, ""), rows[0]]
    content = spark.createDataFrame(rows, schema)
    known = [("post", f"k{i}") for i in range(0, 150, 3)] * 2 + [("comment", "k4"), ("post", None), (None, "k1")]
    for listed in (known, []):
        record = spark.createDataFrame(listed, "kind string, reddit_id string")
        got = membership.not_on_record(content, record, ["kind", "reddit_id"], words)
        there = {k for k in listed if None not in k}
        assert got.columns == content.columns
        assert values(got, *got.columns) == sorted((r for r in rows if r[:2] not in there), key=repr)
    assert membership.not_on_record(content.limit(0), record, ["kind", "reddit_id"], words).count() == 0


def test_unanalyzed_keeps_new_contents_out_of_the_shuffle(spark, tmp_path):
    """Of 40,000 new and 50 analysed contents, texts of few but the analysed go through an exchange."""
    path = str(tmp_path / "contents")
    ids = spark.range(40_050).select(
        F.lit("post").alias("kind"), F.concat(F.lit("p"), F.col("id")).alias("reddit_id"), F.repeat(F.lit("x"), 50).alias("text")
    )
    ids.write.parquet(path)
    content = spark.read.parquet(path)
    record = content.where("cast(substr(reddit_id, 2) as int) < 50").select("kind", F.col("reddit_id").alias("content_reddit_id"))
    seen = record.withColumnRenamed("content_reddit_id", "reddit_id")
    filtered = membership.with_maybe(content, ["kind", "reddit_id"], membership.bloom_filter(seen, ["kind", "reddit_id"]))
    assert 50 <= filtered.where("maybe").count() < 60
    got = mentions.unanalyzed(content, record)
    assert got.count() == 40_000
    assert "BroadcastHashJoin" in plan_of(got)
