"""Stored tables and logs: upserts in place, rejects, nested trees, compaction, edits, ledgers."""

import glob
import json
import os
import subprocess
import sys

import pytest
from conftest import ROOT, plan_of, values
from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import functions as F

from threadlytics.operators import aggregates, maintenance, mentions, scoring, stored, threads
from threadlytics.operators.spread import hot_keys, join_spread
from threadlytics.schemas import RAW_COMMENTS, RAW_POSTS, TICKERS
from threadlytics.session import shared_dir
from threadlytics.sources import adapters, days, landing, symbols
from threadlytics.streaming import jobs


def files_at(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/*/*.parquet")}


def jobs_of(spark, group, action):
    """What ``action`` returns, and the number of jobs it ran."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        return action(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# Stored upserts


@pytest.fixture
def things(spark, tmp_path):
    rows = spark.range(400).select(
        F.concat(F.lit("k"), "id").alias("k"), F.col("id").cast("int").alias("v"), F.repeat(F.lit("long "), F.lit(20)).alias("text"),
        F.array(F.create_map(F.lit("name"), F.lit("gold"))).alias("awards"),
    )
    table = stored.Stored(f"things_{os.path.basename(tmp_path).replace('-', '_')}", str(tmp_path / "things"), rows.schema, ("k",), 16, 4)
    stored.create_stored(spark, table)
    stored.fill(rows, table)
    return table


def test_upsert_rewrites_only_the_shards_of_its_keys(spark, things):
    before = files_at(things.path)
    updates = spark.createDataFrame([("k7", 1, 1), ("k7", 2, 2), ("k9", None, 1), ("new", 5, 1)], "k string, v int, at int")
    shards = stored.upsert_stored(updates, things, ["at"])
    after = files_at(things.path)
    kept = {f for f in before if int(f.split("shard=")[1].split("/")[0]) not in shards}
    assert 0 < len(shards) <= 3 and kept and all(after.get(f) == before[f] for f in kept)
    assert not set(before) - kept & set(after)
    rows = stored.rows_of(spark, things)
    assert rows.count() == 401
    assert values(rows.where("k in ('k7', 'k9', 'new', 'k8')"), "k", "v", F.length("text"), F.size("awards")) == [
        ("k7", 2, 100, 1), ("k8", 8, 100, 1), ("k9", None, 100, 1), ("new", 5, None, None)]
    once = values(rows, "k", "v", "text")
    again = stored.upsert_stored(updates, things, ["at"])
    assert again == shards and values(stored.rows_of(spark, things), "k", "v", "text") == once


def test_upsert_shuffles_no_text_of_the_target(spark, things):
    updates = spark.createDataFrame([("k7", 1), ("k9", 2)], "k string, v int")
    plan = stored.merge_plan(updates, things, stored.touched_shards(updates, things), [])
    lines = plan._jdf.queryExecution().executedPlan().toString().splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line)
    assert "Bucketed: true" in lines[scan] and "text" in lines[scan]
    depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-"))
    above = []
    for line in reversed(lines[:scan]):
        indent = len(line) - len(line.lstrip(" :+-"))
        if indent < depth:
            above.append(line)
            depth = indent
    assert any("SortMergeJoin" in line for line in above) and not any("Exchange" in line for line in above)


def test_upsert_refuses_null_keys_and_needs_an_order(spark, things):
    with pytest.raises(PySparkException, match="null key"):
        stored.upsert_stored(spark.createDataFrame([(None, 1, 1)], "k string, v int, at int"), things, ["at"])
    assert stored.upsert_stored(spark.createDataFrame([], "k string, v int, at int"), things, ["at"]) == []
    assert stored.rows_of(spark, things).count() == 400
    with pytest.raises(ValueError, match="tells the last update"):
        maintenance.upsert(stored.rows_of(spark, things), stored.rows_of(spark, things), ["k"], [])


def test_a_stored_table_is_found_again(spark, things):
    other = stored.Stored(f"{things.name}_again", things.path, things.schema, things.keys, things.shards, things.buckets)
    stored.create_stored(spark, other)
    assert stored.rows_of(spark, other).count() == 400


def test_merging_batches_into_stored_totals(spark, tmp_path, sf_dir):
    rows = adapters.mentions(spark, sf_dir)
    table = stored.Stored("tickers_in_parts", str(tmp_path / "tickers"), TICKERS, ("ticker",), 4, 2)
    stored.create_stored(spark, table)
    for part in range(3):
        batch = rows.where(F.col("event_id") % 3 == part)
        stored.upsert_stored(aggregates.merge_tickers(stored.rows_of(spark, table), batch, f"2024-03-0{part + 1} 00:00:00"), table, ["updated_at"])
    exact = ["ticker", "total_mentions", "total_posts", "total_comments", "last_mentioned_at"]
    merged, whole = stored.rows_of(spark, table), aggregates.ticker_totals(rows)
    assert merged.schema == TICKERS and values(merged, *exact) == values(whole, *exact)
    near = dict(values(whole, "ticker", "avg_hype_score"))
    assert all(abs(float(avg) - near[t]) <= 0.02 for t, avg in values(merged, "ticker", "avg_hype_score"))
    assert values(merged.select("created_at").distinct(), F.col("created_at").cast("string")) == [("2024-03-01 00:00:00",)]


def test_written_files_have_the_advised_size(spark, tmp_path):
    size, advised = 1 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advised)
    spark.conf.set(advised, size)
    try:
        uneven = spark.range(0, 600_000, 1, 40).select("id", F.md5(F.col("id").cast("string")).alias("x")).where("id % 600000 < 15000 or id > 200000")
        maintenance.write_table(uneven, str(tmp_path / "t"))
    finally:
        spark.conf.set(advised, before)
    sizes = sorted(os.path.getsize(f) for f in glob.glob(f"{tmp_path}/t/*.parquet"))
    assert len(sizes) > 5 and sizes[-1] <= 2 * size and sizes[1] >= size / 2


# Landing


def test_rejects_of_a_landing(spark, tmp_path):
    good = {"id": "a", "title": " t ", "score": 3}
    lines = [json.dumps(good), '{"id": "b", "title"', json.dumps({"title": "no id"}), json.dumps({"id": "", "title": "x"}), json.dumps({"id": "c", "score": "many"})]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.json").write_text("\n".join(lines))
    landed, n_jobs = jobs_of(spark, "rejects", lambda: landing.split_landed(spark, str(tmp_path / "in"), RAW_POSTS))
    assert n_jobs == 1
    assert values(landed.rows, "id", "title", "score") == [("a", " t ", 3)]
    assert values(landed.rejects, "file", "reason", "record") == sorted([
        ("one.json", "does not parse", '{"id": "b", "title"'), ("one.json", "does not parse", '{"id": "c", "score": "many"}'),
        ("one.json", "no id", '{"title":"no id"}'), ("one.json", "no id", '{"id":"","title":"x"}')])
    raw = landing.read_submissions(spark, str(tmp_path / "in"))
    assert values(landing.normalize_posts(raw).where("reddit_id is null or reddit_id = ''"), "reddit_id") == []
    (tmp_path / "none").mkdir()
    empty = landing.split_landed(spark, str(tmp_path / "none"), RAW_COMMENTS)
    assert empty.rows.count() == 0 and empty.rejects.count() == 0


def test_deep_trees_in_one_job_with_all_fields(spark):
    leaf = {"id": "leaf", "author": "u", "body": "b\n\"q\"", "created_utc": 5.0, "score": -2, "total_awards_received": 1,
            "all_awardings": [{"name": "gold", "count": 2}, "odd"], "awardings": [], "replies": ""}
    node = leaf
    for level in reversed(range(200)):
        node = {"id": f"n{level}", "replies": [node, None, 7]}
    trees = [("p", json.dumps([node])), ("q", "[{"), ("r", None), (None, json.dumps([leaf])), ("s", '{"id": "x"}'), ("t", json.dumps([leaf, leaf]))]
    posts = spark.createDataFrame(trees, "id string, replies string")
    rows, n_jobs = jobs_of(spark, "nested", lambda: landing.flatten_nested(posts).collect())
    assert n_jobs == 1
    of_p = {r["id"]: r for r in rows if r["post_id"] == "p"}
    assert {k: r["depth"] for k, r in of_p.items()} == {**{f"n{i}": i for i in range(200)}, "leaf": 200}
    assert of_p["n0"]["parent_id"] == "t3_p" and of_p["n199"]["parent_id"] == "t1_n198" and of_p["n5"]["all_awardings"] is None
    row = of_p["leaf"].asDict()
    assert row == {"id": "leaf", "post_id": "p", "parent_id": "t1_n199", "author": "u", "body": 'b\n"q"', "created_utc": 5, "score": -2,
                   "total_awards_received": 1, "all_awardings": [{"name": "gold", "count": "2"}], "awardings": [], "depth": 200}
    assert sorted(r["post_id"] for r in rows if r["post_id"] != "p") == ["t", "t"]
    normal = landing.normalize_comments(landing.valid_comments(landing.flatten_nested(posts)))
    assert values(normal.where("reddit_id = 'leaf'"), "depth", "parent_reddit_id") == [(0, "t"), (0, "t"), (200, "n199")]


# Trees and hot keys


def test_circles_end_with_the_first_round_without_an_arrival(spark):
    circle = [(f"o{i}", f"o{(i + 1) % 500}", 1, False) for i in range(500)]
    chain = [("c0", "root", 0, True)] + [(f"c{i}", f"c{i - 1}", 1, False) for i in range(1, 7)]
    links = spark.createDataFrame(circle + chain + [("lost", "nowhere", 1, False)], "id string, up string, distance bigint, done boolean")
    result, n_jobs = jobs_of(spark, "climb", lambda: threads.climb(links))
    assert values(result, "id", "up", "distance") == [(f"c{i}", "root", i) for i in range(7)]
    # The chain takes three rounds, and one more finds that nothing arrives any more; AQE splits a round's shuffles into jobs.
    writes = 1 + 3 + 1
    assert n_jobs <= 4 * writes


def test_join_without_hot_keys_is_a_plain_one(spark):
    large = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
    small = spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("x"))
    joined = join_spread(large, small, "k", F.col("id"))
    assert plan_of(joined).count("Join") == plan_of(large.join(small, "k")).count("Join")
    spread = join_spread(large, small, "k", F.col("id"), hot=hot_keys(large, "k", 30))
    assert values(spread, "k", "id", "x") == values(joined, "k", "id", "x")
    physical = spread._jdf.queryExecution().executedPlan().toString()
    assert physical.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in physical


# Streams


def write_batches(path, frames):
    for at, frame in enumerate(frames):
        frame.coalesce(1).write.mode("append").parquet(f"{path}/no={at}")


def test_log_reads_the_same_after_compaction(spark, tmp_path, sf_dir):
    rows = adapters.mentions(spark, sf_dir)
    source, log = str(tmp_path / "in"), str(tmp_path / "log")

    def stream():
        return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{source}/*")

    def current():
        totals = jobs.current_ticker_totals(spark, log)
        return values(totals, *totals.columns)

    with pytest.raises(LookupError):
        jobs.current_ticker_totals(spark, log)
    assert jobs.compact(spark, log, jobs.FOLDS["ticker_totals"]) is None
    parts = [rows.where(F.col("event_id") % 6 == i) for i in range(6)]
    for start, stop in ((0, 4), (4, 6)):
        write_batches(source, [p for p in parts[start:stop]]) if start == 0 else [
            p.coalesce(1).write.parquet(f"{source}/no={start + i}") for i, p in enumerate(parts[start:stop])]
        jobs.ticker_totals(stream(), log, f"{log}-marks").awaitTermination()
        before = current()
        assert jobs.compact(spark, log, jobs.FOLDS["ticker_totals"]) == stop - 1
        assert current() == before
        assert jobs.compact(spark, log, jobs.FOLDS["ticker_totals"]) == stop - 1
        assert current() == before and not glob.glob(f"{log}/{jobs.BATCH}=*") and len(glob.glob(f"{log}/base-*")) == 1
    want = aggregates.ticker_totals(rows)
    assert current() == values(want, *want.columns)
    # A batch that runs again after its compaction is not counted twice.
    jobs.append_batch(log)(aggregates.partial_totals(parts[5]), 5)
    assert current() == values(want, *want.columns)


CONTENT = "kind string, reddit_id string, post_reddit_id string, text string, landed_at int"


def test_edits_take_back_tickers(spark, tmp_path):
    source, log = str(tmp_path / "in"), str(tmp_path / "log")
    listed = spark.createDataFrame([("AAPL", "Apple"), ("GME", "")], "symbol string, name string")

    def land(no, *items):
        rows = [("post", i, i, text, at) for i, text, at in items]
        spark.createDataFrame(rows, CONTENT).withColumn("created_utc", F.lit("2024-01-01").cast("timestamp")).coalesce(1).write.parquet(f"{source}/no={no}")
        stream = spark.readStream.schema(spark.read.parquet(f"{source}/no=0").schema).parquet(f"{source}/*")
        jobs.edited_mentions(stream, listed, log, f"{log}-marks").awaitTermination()
        return values(jobs.current_edited_mentions(spark, log), "content_reddit_id", "ticker")

    def analysed():
        return spark.read.parquet(f"{log}/{jobs.BATCH}=*").where("ticker is null").count()

    assert land(0, ("a", "AAPL and GME", 1), ("b", "GME", 1), ("c", None, 1), ("d", "GME", 2), ("d", "old AAPL", 1)) == [
        ("a", "AAPL"), ("a", "GME"), ("b", "GME"), ("d", "GME")]
    assert analysed() == 4
    # b is unchanged, d is an older version that comes late, c gains a ticker, a loses one
    assert land(1, ("a", "only GME", 2), ("b", "GME", 2), ("c", "AAPL", 2), ("d", "AAPL", 1)) == [
        ("a", "GME"), ("b", "GME"), ("c", "AAPL"), ("d", "GME")]
    assert analysed() == 6
    assert land(2, ("a", "[deleted]", 3), ("b", " ", 3), ("c", "AAPL", 3)) == [("c", "AAPL"), ("d", "GME")]
    jobs.compact(spark, log, jobs.FOLDS["edited_mentions"])
    assert values(jobs.current_edited_mentions(spark, log), "content_reddit_id", "ticker") == [("c", "AAPL"), ("d", "GME")]
    assert land(3, ("d", "nothing", 5)) == [("c", "AAPL")]


def test_edits_survive_folding_and_a_batch_that_runs_again(spark, tmp_path, monkeypatch):
    """An item of the folded versions stays known, one without an id too; what a failed attempt noted does not count."""
    source, log, failed = str(tmp_path / "in"), str(tmp_path / "log"), []
    listed = spark.createDataFrame([("AAPL", "Apple"), ("GME", "")], "symbol string, name string")
    monkeypatch.setattr(jobs, "FOLD_EVERY", 2)
    append = jobs.append_batch

    def append_batch(path):
        def write(batch, batch_id):
            append(path)(batch, batch_id)
            if path.endswith("versions") and batch_id == 3 and not failed:
                failed.append(batch_id)
                raise RuntimeError("lost")

        return write

    monkeypatch.setattr(jobs, "append_batch", append_batch)

    def land(no, *items):
        rows = [("post", i, i, text, at) for i, text, at in items]
        spark.createDataFrame(rows, CONTENT).withColumn("created_utc", F.lit("2024-01-01").cast("timestamp")).coalesce(1).write.parquet(f"{source}/no={no}")
        stream = spark.readStream.schema(spark.read.parquet(f"{source}/no=0").schema).parquet(f"{source}/*")
        try:
            jobs.edited_mentions(stream, listed, log, f"{log}-marks").awaitTermination()
        except StreamingQueryException:
            jobs.edited_mentions(stream, listed, log, f"{log}-marks").awaitTermination()
        return values(jobs.current_edited_mentions(spark, log), "content_reddit_id", "ticker")

    def analysed():
        return spark.read.parquet(f"{log}/{jobs.BATCH}=*").where("ticker is null").count()

    assert land(0, ("a", "AAPL", 1), ("b", "GME", 1), (None, "GME", 1)) == [("a", "AAPL"), ("b", "GME")]
    assert land(1, ("a", "AAPL", 2), ("b", "AAPL", 2), (None, "GME", 2)) == [("a", "AAPL"), ("b", "AAPL")]
    assert analysed() == 4
    assert land(2, ("a", "AAPL", 3), ("b", "AAPL", 3)) == [("a", "AAPL"), ("b", "AAPL")]
    assert analysed() == 4
    assert land(3, ("a", "GME", 4), ("b", "AAPL", 1)) == [("a", "GME"), ("b", "AAPL")]
    assert failed and analysed() == 5
    assert land(4, ("a", "GME", 5), ("c", "GME", 1)) == [("a", "GME"), ("b", "AAPL"), ("c", "GME")]
    assert analysed() == 6


def test_edits_take_a_batch_a_core_whatever_the_files(spark, tmp_path, sf_dir):
    from __spark_entry__ import queries

    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").where("conv_id % 10 < 2")
    turns.repartition(7).write.parquet(str(tmp_path / "conversations.parquet"))
    before = set(glob.glob(f"{shared_dir(spark)}/run-*"))
    queries()["stream_edits"](spark, str(tmp_path))
    (run,) = set(glob.glob(f"{shared_dir(spark)}/run-*")) - before
    assert 3 <= len(glob.glob(f"{run}/log/{jobs.BATCH}=*")) <= 3 * spark.sparkContext.defaultParallelism


# Ledgers


FAILING = """
import collections, glob, os, sys, uuid
sys.path.insert(0, {root!r})
from pyspark import TaskContext
from pyspark.sql import functions as F
from threadlytics.operators import scoring
from threadlytics.session import get_session

place = {place!r}
spark = get_session("ledger", "local[2,3]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2",
    "spark.driver.host": "127.0.0.1", "spark.sql.execution.arrow.maxRecordsPerBatch": "40", "spark.checkpoint.dir": place}})
spark.sparkContext.setLogLevel("OFF")

def make():
    def scorer(texts):
        # A task fails once, after some of its calls were answered.
        if TaskContext.get().attemptNumber() == 0 and len(glob.glob(f"{{place}}/ledger/*/task={{TaskContext.get().partitionId()}}/*.parquet")) == 1 \\
                and not os.path.exists(f"{{place}}/failed-{{TaskContext.get().partitionId()}}"):
            open(f"{{place}}/failed-{{TaskContext.get().partitionId()}}", "w").close()
            os._exit(1)
        with open(f"{{place}}/calls-{{uuid.uuid4().hex}}", "w") as out:
            out.write("\\n".join(texts))
        return ["no" if t.endswith("7") else "{{}}" for t in texts]
    return scorer

rows = spark.range(600).select("id", F.concat(F.lit("text "), F.col("id") % 150).alias("body"))
for _ in range(2):
    scored = scoring.score_once(rows, "body", make, f"{{place}}/ledger")
    assert scored.count() == 600 and scored.where("response is null").count() == 0
    assert scored.where("error is not null").select("body").distinct().count() == 15
calls = collections.Counter(line for f in glob.glob(f"{{place}}/calls-*") for line in open(f).read().split("\\n"))
assert len(calls) == 150 and len(glob.glob(f"{{place}}/failed-*")) >= 1
assert all(n == (2 if t.endswith("7") else 1) for t, n in calls.items()), calls
print("paid once")
"""


def test_no_text_is_paid_for_again_after_a_lost_task(tmp_path):
    done = subprocess.run([sys.executable, "-c", FAILING.format(root=ROOT, place=str(tmp_path))], capture_output=True, text=True, timeout=300)
    assert "paid once" in done.stdout, done.stderr[-3000:]


def test_ledger_agrees_with_asking_anew(spark, tmp_path):
    def make():
        def reply(text):
            if "bad" in text:
                raise ValueError("refused")
            return '{"tickers": [{"symbol": "gme", "name": ""}], "hype_score": 0.5}' if "GME" in text else "none"

        return lambda texts: [reply(t) for t in texts]

    rows = [("post", "a", "a", "GME up", 1), ("post", "b", "b", "GME up", 1), ("post", "c", "c", "bad", 1), ("post", "d", "d", None, 1), ("post", "e", "e", "calm", 1)]
    items = spark.createDataFrame(rows, CONTENT).withColumn("created_utc", F.lit("2024-01-01").cast("timestamp"))
    ledger = str(tmp_path / "ledger")
    plain = scoring.score_with(items, "text", make)
    kept = scoring.score_once(items, "text", make, ledger)
    assert values(kept, "reddit_id", "response", "error") == values(plain, "reddit_id", "response", "error")
    assert kept.columns == plain.columns
    found = scoring.mentions_with(items, make, ledger)
    assert values(found, "content_reddit_id", "ticker") == [("a", "GME"), ("b", "GME")]
    assert scoring.score_once(items.limit(0), "text", make, ledger).count() == 0
    assert scoring.read_ledger(spark, ledger).count() == 4


def test_symbols_written_in_rows(spark, tmp_path):
    listed = spark.createDataFrame([("GME",), ("AAPL",), ("GME",), ("X",)], "symbol string")
    path = str(tmp_path / "symbols")
    symbols.save_symbol_rows(listed, path, 2.0)
    lines = [line for f in sorted(glob.glob(f"{path}/part-*")) for line in open(f).read().split()]
    assert lines == [json.dumps({"symbols": [s], "updated_at": 2.0}, separators=(",", ":")) for s in ("AAPL", "GME", "X")]
    assert values(symbols.symbols_of(spark.read.text(path)), "symbol") == [("AAPL",), ("GME",), ("X",)]
    plan = plan_of(symbols.symbol_rows(listed, 2.0)) + plan_of(aggregates.ticker_list(mentions.posts_with_tickers(
        spark.createDataFrame([], "reddit_id string, title string, score int"), spark.createDataFrame([], "kind string, content_reddit_id string, ticker string, confidence double, method string"))))
    assert "collect_list" not in plan


def test_contents_by_day_open_the_days_of_a_range_only(spark, tmp_path):
    path = str(tmp_path / "by_day")
    rows = spark.sql("""select id, timestamp'2024-01-01 22:00:00' + make_interval(0, 0, 0, 0, cast(id as int)) as created_utc, 'mine' as note from range(96)
        union all select 1000 + id, null, 'timeless' from range(3)""")
    days.write_days(rows, path)
    assert sorted(os.path.basename(d) for d in glob.glob(f"{path}/day=*")) == [*(f"day=2024-01-0{d}" for d in range(1, 6)), "day=__HIVE_DEFAULT_PARTITION__"]
    some = days.read_days(spark, path, rows.schema, "2024-01-02", "2024-01-04 06:00:00")
    assert values(some, "id") == sorted([(i,) for i in range(2, 56)], key=repr) and some.columns == rows.columns
    assert {f.split("day=")[1][:10] for (f,) in some.select(F.input_file_name()).collect()} == {"2024-01-02", "2024-01-03", "2024-01-04"}
    assert "PartitionFilters: [isnotnull(day" in plan_of(some)
    assert days.read_days(spark, path, rows.schema, "2025-01-01", "2025-02-01").count() == 0

    before = files_at(path)
    days.write_days(rows.filter("id between 2 and 25 and id <> 7").withColumn("note", F.lit("new")), path)
    after = files_at(path)
    assert {f for f in before if "2024-01-02" not in f} == {f for f in after if "2024-01-02" not in f} and not {f for f in before if "2024-01-02" in f} & set(after)
    listed = spark.createDataFrame([("2024-01-02",), ("2024-01-02",), (None,), ("1999-01-01",)], "day string")
    again = days.read_listed_days(spark, path, rows.schema, listed)
    assert values(again, "id", "note") == sorted([(i, "new") for i in range(2, 26) if i != 7], key=repr)
    assert "dynamicpruning" in plan_of(again)
    days.write_days(rows.limit(0), path)
    assert set(files_at(path)) == set(after)
