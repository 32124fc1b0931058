import json

import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from threadlytics import schemas, session
from threadlytics.operators import filters, inheritance, maintenance, mentions
from threadlytics.sources import adapters, landing, symbols
from threadlytics.streaming import jobs


def write_lines(path, lines):
    path.mkdir()
    (path / "part.json").write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))
    return str(path)


def test_landed_posts(spark, tmp_path):
    path = write_lines(tmp_path / "posts", [
        {"id": "1abc", "title": " A\n", "selftext": None, "score": 3, "created_utc": 1704067200, "permalink": "/r/x",
         "subreddit": "", "upvote_ratio": 0.5, "author": "me"},
        {"id": "a-b"},
        "{broken",
    ])
    raw = landing.read_submissions(spark, path)
    assert raw.cache().filter(F.col(landing.CORRUPT).isNotNull()).count() == 1
    got = {r["reddit_id"]: r.asDict() for r in landing.normalize_posts(raw.filter("id is not null")).collect()}
    first, second = got["1abc"], got["a-b"]
    assert (first["title"], first["text"], first["score"], first["permalink"], first["subreddit"]) == (
        "A", "", 3, "https://reddit.com/r/x", "wallstreetbets")
    assert (first["reddit_id_int"], first["upvote_ratio"], first["flair"]) == (int("1abc", 36), 0.5, "")
    assert (second["reddit_id_int"], second["score"], second["author"], second["permalink"]) == (None, 0, None, None)
    assert second["created_utc"].timestamp() == 0


def test_landed_comments(spark, tmp_path):
    path = write_lines(tmp_path / "comments", [
        {"id": "c", "post_id": "p", "parent_id": "t1_a_b", "body": " hi ", "created_utc": 0, "depth": 2,
         "all_awardings": [], "awardings": [{"name": "gold"}]},
        {"id": "d", "post_id": "p", "parent_id": "p", "body": "   "},
        {"id": "e", "post_id": "p", "body": ""},
        {"post_id": "p", "body": "x"},
        {"id": "f", "post_id": "p", "body": None},
    ])
    rows = landing.normalize_comments(landing.valid_comments(landing.read_comments(spark, path)))
    got = {r["reddit_id"]: r.asDict() for r in rows.collect()}
    assert set(got) == {"c", "d"}
    assert (got["c"]["body"], got["c"]["parent_reddit_id"], got["c"]["created_utc"], got["c"]["depth"]) == (
        "hi", "a_b", None, 2)
    assert got["c"]["awards"] == [{"name": "gold"}] and got["d"]["awards"] == []
    assert (got["d"]["body"], got["d"]["parent_reddit_id"]) == ("", None)


def test_parquet_landing(spark, tmp_path, sf_dir):
    path = str(tmp_path / "raw")
    adapters.raw_posts(spark, sf_dir).select(*schemas.RAW_POSTS.fieldNames()).write.parquet(path)
    assert landing.read_submissions(spark, path, "parquet").count() == adapters.raw_posts(spark, sf_dir).count()


def nested(depth):
    node = {"id": f"n{depth}", "body": f"at {depth}", "replies": []}
    for level in range(depth - 1, -1, -1):
        node = {"id": f"n{level}", "body": f"at {level}", "replies": [node, {"id": f"m{level}", "body": "leaf"}]}
    return json.dumps([node, {"id": "last", "body": "x", "replies": None}])


def test_flatten_nested(spark):
    posts = spark.createDataFrame([("p", nested(7)), ("q", "[]"), ("r", None)], "id string, replies string")
    flat = landing.flatten_nested(posts)
    got = dict(values(flat, "id", "depth"))
    assert got == {**{f"n{i}": i for i in range(8)}, **{f"m{i}": i + 1 for i in range(7)}, "last": 0}
    parents = dict(values(flat, "id", "parent_id"))
    assert parents["n0"] == "t3_p" and parents["n3"] == "t1_n2"
    assert landing.normalize_comments(flat.withColumn("total_awards_received", F.lit(0)).withColumn(
        "all_awardings", F.lit(None).cast("array<string>")).withColumn(
        "awardings", F.lit(None).cast("array<string>"))).count() == 16


def test_symbol_files(spark, tmp_path):
    folder = tmp_path / "symbols"
    folder.mkdir()
    (folder / "a.json").write_text('{\n "symbols": ["aapl", " brk.b ", 7, null],\n "updated_at": 1.5}')
    (folder / "b.json").write_text('["TSLA", "aapl", "TOOLONGNAME", {"x": 1}]')
    (folder / "c.json").write_text("7")
    loaded = symbols.load_symbols(spark, str(folder))
    assert values(loaded, "symbol") == [("AAPL",), ("BRK.B",), ("TOOLONGNAME",), ("TSLA",)]
    out = str(tmp_path / "out")
    symbols.save_symbols(mentions.symbol_dim(loaded), out, 2.0)
    document = json.loads(spark.read.text(out, wholetext=True).filter("value <> ''").first()["value"])
    assert document == {"symbols": ["AAPL", "BRK.B", "TSLA"], "updated_at": 2.0}
    assert values(symbols.load_symbols(spark, out), "symbol") == [("AAPL",), ("BRK.B",), ("TSLA",)]


def test_evolve_is_repeatable(spark):
    basic = spark.createDataFrame([("post", "a", "X", 0.5)], "kind string, content_reddit_id string, ticker string, confidence double")
    once = maintenance.evolve("content_tickers", basic)
    assert once.first()["company_name"] == "" and float(once.first()["hype_score"]) == 0
    changed = once.withColumn("company_name", F.lit("kept"))
    assert maintenance.evolve("content_tickers", changed).first()["company_name"] == "kept"
    assert maintenance.evolve("content_tickers", once).schema == once.schema


def test_schema_check(spark):
    tables = {name: spark.createDataFrame([], schema) for name, schema in schemas.TABLES.items()}
    assert maintenance.schema_check(spark, tables).filter("present").count() == 5
    tables["posts"] = tables["posts"].drop("processed_at")
    del tables["tickers"]
    got = dict(values(maintenance.schema_check(spark, tables), "object", "present"))
    assert got == {"posts.processed_at": False, "comments.processed_at": True, "content_tickers.created_at": True,
                   "tickers": False, "ticker_daily_stats": True}
    catalogue = maintenance.column_catalogue(spark, tables)
    assert ("posts", "title", "string") in values(catalogue, "table_name", "column_name", "data_type")


def test_catalog_tables(spark):
    maintenance.create_tables(spark)
    maintenance.create_tables(spark)
    assert spark.table("tickers").schema["avg_hype_score"].dataType.simpleString() == "decimal(4,2)"
    spark.sql("CREATE TABLE old_content_tickers (kind STRING, ticker STRING) USING parquet")
    spark.sql("INSERT INTO old_content_tickers VALUES ('post', 'X')")
    spark.sql("CREATE TABLE old_posts (reddit_id STRING) USING parquet")
    spark.sql("CREATE TABLE old_comments (reddit_id STRING) USING parquet")
    maintenance.evolve_catalog(spark, "old_")
    maintenance.evolve_catalog(spark, "old_")
    row = spark.table("old_content_tickers").first()
    assert (row["company_name"], float(row["hype_score"]), row["created_at"]) == ("", 0.0, None)
    assert spark.table("old_posts").columns == ["reddit_id", "processed_at"]


def test_bucketed_tables_join_without_a_shuffle(spark, sf_dir):
    maintenance.create_tables(spark, "b_", buckets=4)
    posts = adapters.posts(spark, sf_dir)
    posts.select(*schemas.POSTS.fieldNames()).write.insertInto("b_posts")
    found = mentions.stored_mentions(adapters.mentions(spark, sf_dir))
    found.select(*[f"`{c}`" if c in found.columns else F.lit(None).cast("string").alias(c)
                   for c in schemas.CONTENT_TICKERS.fieldNames()]).write.insertInto("b_content_tickers")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        joined = spark.table("b_posts").join(
            spark.table("b_content_tickers").select("kind", F.col("content_reddit_id").alias("reddit_id")),
            "reddit_id", "left_anti")
        assert joined.count() == posts.count()
        assert "Exchange" not in plan_of(joined)
    finally:
        spark.conf.set(threshold, before)


def test_clear_tables(spark, tmp_path):
    path = str(tmp_path / "posts")
    maintenance.write_table(spark.range(2500).withColumnRenamed("id", "reddit_id"), path)
    assert len(spark.read.parquet(path).inputFiles()) == 1
    cleared = maintenance.clear_tables(spark, {"posts": path})
    assert values(cleared, "table_name", "rows_deleted") == [("posts", 2500)]
    assert spark.read.parquet(path).count() == 0


def test_shared_dir_is_the_one_configured(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    cut = session.cut_lineage(spark.range(3))
    assert cut.count() == 3 and "Range (" not in cut._jdf.queryExecution().toString()


def test_ingest_across_restarts(spark, tmp_path):
    """Late and repeated rows are taken up, each file once, and a rerun batch changes nothing."""
    source, log, marks = (str(tmp_path / x) for x in ("in", "log", "marks"))
    schema = "reddit_id string, title string, landed_at int"

    def land(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        jobs.ingest(stream, "posts", log, marks).awaitTermination()
        return values(jobs.current(spark, "posts", log), "reddit_id", "title")

    assert land([("a", "one", 1), ("a", "two", 2), ("b", "x", 1)]) == [("a", "two"), ("b", "x")]
    assert land([("b", "y", 0), ("c", "z", 0)]) == [("a", "two"), ("b", "y"), ("c", "z")]
    assert spark.read.parquet(log).select(jobs.BATCH).distinct().count() == 2
    repeated = spark.createDataFrame([("b", "y", 0), ("c", "z", 0)], schema)
    jobs.append_batch(log)(repeated, 1)
    assert values(jobs.current(spark, "posts", log), "reddit_id", "title") == [("a", "two"), ("b", "y"), ("c", "z")]
    assert jobs.read_log(spark, str(tmp_path / "none")) is None


def test_totals_over_several_batches(spark, tmp_path, sf_dir):
    rows = adapters.mentions(spark, sf_dir)
    source = str(tmp_path / "in")
    for part in range(3):
        rows.filter(F.col("event_id") % 3 == part).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    log, daily = str(tmp_path / "log"), str(tmp_path / "daily")
    jobs.ticker_totals(stream, log, f"{log}-marks").awaitTermination()
    jobs.daily_stats(stream, daily, f"{daily}-marks").awaitTermination()
    assert spark.read.parquet(log).select(jobs.BATCH).distinct().count() == 3
    got = jobs.current_ticker_totals(spark, log)
    from threadlytics.operators import aggregates

    want = aggregates.ticker_totals(rows)
    assert values(got, *want.columns) == values(want, *want.columns)
    content = filters.content_union(adapters.posts(spark, sf_dir), adapters.comments(spark, sf_dir))
    days, want = jobs.current_daily_stats(spark, daily, content), aggregates.daily_stats(rows, content)
    assert values(days, *want.columns) == values(want, *want.columns)


def test_stream_equals_batch(spark, tmp_path, sf_dir):
    listed = adapters.symbols(spark)
    content = filters.content_union(adapters.posts(spark, sf_dir), adapters.comments(spark, sf_dir))
    found = mentions.direct_mentions(filters.analyzable(content), listed)
    stream = filters.content_union(
        adapters.posts(spark, sf_dir, adapters.stream), adapters.comments(spark, sf_dir, adapters.stream)
    )
    log = str(tmp_path / "mentions")
    jobs.mentions(stream, listed, log, f"{log}-marks").awaitTermination()
    want = mentions.best_mentions(found)
    assert values(jobs.current_mentions(spark, log), *want.columns) == values(want, *want.columns)
    log = str(tmp_path / "context")
    comments = filters.comment_texts(adapters.comments(spark, sf_dir, adapters.stream))
    jobs.contextual(comments, listed, found.filter("kind = 'post'"), log, f"{log}-marks").awaitTermination()
    inherited = inheritance.contextual_inheritance(adapters.comments(spark, sf_dir), found)
    want = mentions.best_mentions(found.filter("kind = 'comment'").unionByName(inherited))
    got = jobs.current_mentions(spark, log)
    assert values(got, *want.columns) == values(want, *want.columns) != []


def test_contextual_stream_reads_posts_anew(spark, tmp_path):
    """A post analysed between two batches hands its ticker down; own tickers come first."""
    source, stored, log = (str(tmp_path / x) for x in ("in", "stored", "log"))
    listed = spark.createDataFrame([("TSLA", "Tesla"), ("AAPL", "Apple")], "symbol string, name string")
    schema = "kind string, reddit_id string, post_reddit_id string, text string, score int, num_comments int, created_utc timestamp, processed_at timestamp"

    def batch(post, ticker, comments):
        rows = spark.createDataFrame([("post", post, post, ticker, 1, 0, None, None)], schema)
        mentions.direct_mentions(rows, listed).write.mode("append").parquet(stored)
        rows = [("comment", i, p, t, 1, 0, None, None) for i, p, t in comments]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        jobs.contextual(stream, listed, lambda s: s.read.parquet(stored), log, f"{log}-marks").awaitTermination()
        return [tuple(r)[:3] for r in values(jobs.current_mentions(spark, log), "content_reddit_id", "ticker", "method")]

    inherited = inheritance.CONTEXT_METHOD
    first = [("a", "TSLA", inherited), ("b", "AAPL", "rule")]
    assert batch("p", "TSLA", [("a", "p", "to the moon 🚀🚀🚀"), ("b", "p", "AAPL LFG!!! 🚀")]) == first
    assert batch("q", "$AAPL", [("c", "q", "to the moon 🚀🚀🚀")]) == [*first, ("c", "AAPL", inherited)]


def test_ingest_needs_an_order(spark):
    with pytest.raises(ValueError):
        jobs.ingest(spark.createDataFrame([], "reddit_id string, awards array<map<string,string>>"), "comments", "l", "c")


def test_ingest_comments(spark, tmp_path):
    """Columns that cannot be ordered, like maps, are carried along."""
    source, log = str(tmp_path / "in"), str(tmp_path / "log")
    schema = "reddit_id string, body string, awards array<map<string,string>>, landed_at int"
    rows = [("a", "old", [{"n": "1"}], 1), ("a", "new", [{"n": "2"}], 2), ("b", None, None, None)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(schema).parquet(source)
    jobs.ingest(stream, "comments", log, f"{log}-marks").awaitTermination()
    got = jobs.current(spark, "comments", log).orderBy("reddit_id").collect()
    assert [(r.reddit_id, r.body, r.awards) for r in got] == [("a", "new", [{"n": "2"}]), ("b", None, None)]


@pytest.mark.parametrize("part", range(4))
def test_queries_match_their_sql(spark, sf_dir, part):
    from __spark_entry__ import oracle_sql, queries
    from check import compare, duck

    assert set(oracle_sql()) <= set(queries())
    connection = duck(sf_dir)
    for name in sorted(queries())[part::4]:
        same, n, note = compare(spark, connection, sf_dir, name)
        assert same is not False, f"{name}: {note}"
        assert n > 0, name


def test_entry(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns[0] == "ticker" and df.count() > 0


def test_streams_read_tables_that_are_folders(spark, tmp_path, sf_dir):
    """A table may be one file or a folder of them; a neighbour whose name begins alike is no part of it."""
    from __spark_entry__ import queries

    names = ["stream_upsert_posts", "stream_upsert_comments", "stream_mentions", "stream_contextual"]
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    turns.repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    turns.withColumn("conv_id", F.col("conv_id") + 1_000_000).write.parquet(str(tmp_path / "conversations.parquet2"))
    for name in names:
        got = queries()[name](spark, str(tmp_path))
        assert values(got, *got.columns) == values(queries()[name](spark, sf_dir), *got.columns) != [], name
