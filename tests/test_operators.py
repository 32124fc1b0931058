import random
from collections import defaultdict

import pandas as pd
import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from threadlytics.operators import (
    aggregates,
    filters,
    inheritance,
    maintenance,
    mentions,
    scoring,
    spread,
    threads,
)
from threadlytics.plans import analysis, backfill
from threadlytics.schemas import COMMENTS, MENTION_COLUMNS, POSTS
from threadlytics.sources import adapters

SYMBOLS = [("TSLA", "Tesla Inc."), ("AAPL", "Apple Inc."), ("GME", "")]


@pytest.fixture(scope="module")
def symbols(spark):
    return spark.createDataFrame(SYMBOLS, "symbol string, name string")


def posts_of(spark, rows):
    """(id, title, seconds[, processed]) as posts."""
    df = spark.createDataFrame([(*r, None)[:4] for r in rows], "reddit_id string, title string, t bigint, p bigint")
    return df.select(
        "reddit_id", "title", F.lit("").alias("text"), F.lit(5).alias("score"), F.lit(2).alias("num_comments"),
        F.timestamp_seconds("t").alias("created_utc"), F.timestamp_seconds("p").alias("processed_at"),
    )


def comments_of(spark, rows):
    """(id, post, parent kind, parent, body) as comments."""
    df = spark.createDataFrame(
        rows, "reddit_id string, post_reddit_id string, parent_kind string, parent_reddit_id string, body string"
    )
    return df.select(
        "*", F.lit(1).alias("score"), F.timestamp_seconds(F.lit(1704067200)).alias("created_utc"),
        F.lit(None).cast("timestamp").alias("processed_at"),
    )


def mention_rows(spark, rows):
    """(kind, content, ticker, confidence[, pos]) as mentions."""
    df = spark.createDataFrame(
        [(*r, 0)[:5] for r in rows],
        "kind string, content_reddit_id string, ticker string, confidence double, pos int",
    )
    return df.select(
        "*", F.lit(-1).alias("span_start"), F.lit(-1).alias("span_end"), F.lit("llm").alias("method"),
        F.lit(0.5).alias("hype_score"), F.lit("").alias("company_name"), F.lit(None).cast("string").alias("post_reddit_id"),
        F.lit(None).cast("string").alias("inheritance_source"), F.lit(None).cast("string").alias("context_post_id"),
        F.timestamp_seconds(F.lit(1704067200)).alias("created_utc"),
    )


def test_two_threads_from_extraction_to_coverage(spark, symbols):
    """A thread about GME with one comment of each way, beside a thread without a ticker."""
    posts = posts_of(spark, [("g", "What now for GME?", 1704067200), ("n", "Weekend thread", 1704070800)])
    said = {
        "c1": ("g", "🚀 🚀 buying"),  # 0.5: takes the post's ticker
        "c2": ("g", "moon"),  # 0.3: takes it as well
        "c3": ("g", "moon but risky"),  # 0.1: not keen enough
        "c4": ("g", "rather AAPL than $TSLA, moon"),  # has its own
        "c5": ("g", "🚀"),  # too short to be judged
        "c6": ("g", "[deleted]"),
        "c7": ("n", "yolo 💎"),  # keen, but the post has nothing to give
    }
    comments = comments_of(spark, [(i, post, "post", post, body) for i, (post, body) in said.items()])
    result = analysis.analyze_with_context(filters.content_union(posts, comments), symbols)
    got = values(result.mentions, "content_reddit_id", "ticker", "method", F.round("confidence", 6))
    assert got == [
        ("c1", "GME", "contextual_inheritance", 0.7),
        ("c2", "GME", "contextual_inheritance", 0.5),
        ("c4", "AAPL", "rule", 0.95),
        ("c4", "TSLA", "rule", 0.95),
        ("g", "GME", "rule", 0.8),
    ]
    report = inheritance.coverage(comments, result.mentions).first().asDict()
    assert report == {"comments": 7, "direct": 1, "contextual": 2, "uncovered": 4, "coverage_pct": pytest.approx(300 / 7)}
    summary = aggregates.run_summary(result.items, result.mentions).first().asDict()
    assert summary == {"analyzed_items": 8, "mentions": 5, "inherited": 2, "direct": 3}


def test_a_keen_comment_takes_every_ticker_of_its_post(spark):
    tagged = mention_rows(spark, [("post", "p", t, 0.9) for t in ("BTC", "GE", "TSLA")] + [("post", "q", "GME", 0.5), ("comment", "p", "ZZ", 0.9)])
    moods = {"lfg 🙌 moon": 0.75, "bullish, i'm in": 0.6, "hold on": None, "quiet day": None}
    rows = [(f"{post} {text}", post, "post", post, text) for post in ("p", "q", "none") for text in moods]
    got = values(inheritance.contextual_inheritance(comments_of(spark, rows), tagged), "content_reddit_id", "ticker", F.round("confidence", 6))
    given = {"p": ("BTC", "GE", "TSLA"), "q": ("GME",), "none": ()}
    want = [(i, ticker, moods[text]) for i, post, _, _, text in rows if moods[text] for ticker in given[post]]
    assert got == sorted(want, key=repr)


def test_direct_comment_never_inherits(spark, sf_dir):
    found = mentions.direct_mentions(
        filters.analyzable(filters.content_union(adapters.posts(spark, sf_dir), adapters.comments(spark, sf_dir))),
        adapters.symbols(spark),
    )
    inherited = inheritance.contextual_inheritance(adapters.comments(spark, sf_dir), found)
    own = found.filter(F.col("kind") == "comment").select("content_reddit_id")
    assert inherited.count() > 0
    assert inherited.join(own, "content_reddit_id", "left_semi").count() == 0


def test_best_mentions(spark):
    rows = mention_rows(spark, [("post", "a", "X", 0.5, 0), ("post", "a", "X", 0.9, 1), ("post", "a", "X", 0.9, 2),
                                ("post", "a", "Y", 0.1, 3), ("comment", "a", "X", 0.2, 0)])
    got = values(mentions.best_mentions(rows), "kind", "content_reddit_id", "ticker", "confidence", "pos", "span_start")
    assert got == [("comment", "a", "X", 0.2, 0, None), ("post", "a", "X", 0.9, 1, None), ("post", "a", "Y", 0.1, 3, None)]


def test_best_mentions_keeps_nulls_in_the_rest(spark):
    rows = mention_rows(spark, [("post", "a", "X", 0.5)]).withColumn("method", F.lit(None).cast("string"))
    assert values(mentions.best_mentions(rows), "ticker", "method") == [("X", None)]


def test_stored_layout(spark, sf_dir):
    stored = mentions.stored_mentions(adapters.mentions(spark, sf_dir))
    assert stored.schema["hype_score"].dataType.simpleString() == "decimal(4,2)"
    assert stored.count() == stored.select("kind", "content_reddit_id", "ticker").distinct().count()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(spark, how):
    random.seed(3)
    # One key holds a third of the rows.
    left = [(i, "hot" if i % 3 == 0 else f"k{random.randrange(40)}") for i in range(3000)] + [(9999, None)]
    right = [("hot", v) for v in range(3)] + [(f"k{k}", v) for k in range(0, 30) for v in range(k % 3)]
    large = spark.createDataFrame(left, "id int, k string")
    small = spark.createDataFrame(right, "k string, v int")
    hot = spread.hot_keys(large, "k", rows_per_slot=100)
    slots = dict(values(hot, "k", "slots"))
    assert slots["hot"] == 10 and len(slots) < 5
    got = spread.join_spread(large, small, "k", F.col("id"), how, hot)
    want = large.join(small, "k", how)
    assert values(got, *want.columns) == values(want, *want.columns)


def test_all_hot_keys_are_split(spark):
    df = spark.range(1000).select((F.col("id") % 100).cast("string").alias("k"))
    assert spread.hot_keys(df, "k", rows_per_slot=5).count() == 100


def test_texts_do_not_meet_the_symbol_list(spark, sf_dir, symbols):
    content = filters.content_union(adapters.posts(spark, sf_dir), adapters.comments(spark, sf_dir))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(mentions.direct_mentions(content, symbols))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and not any("text#" in line for line in exchanges)


def test_trees_of_comments_that_landed_twice(spark):
    chain = [(f"c{i}", "p", "post" if i == 0 else "comment", "p" if i == 0 else f"c{i - 1}", "x") for i in range(6)]
    once, twice = comments_of(spark, chain), comments_of(spark, chain + chain)
    depths = values(threads.comment_depth(once), "reddit_id", "depth")
    assert values(threads.comment_depth(twice).distinct(), "reddit_id", "depth") == depths
    assert threads.comment_depth(twice).count() == 12
    given = mention_rows(spark, [("post", "p", "TSLA", 0.9)])
    columns = ("content_reddit_id", "ticker", "distance")
    assert values(inheritance.parent_inheritance(twice, given), *columns) == values(
        inheritance.parent_inheritance(once, given), *columns
    )


def test_validity_flags(spark, symbols):
    df = spark.createDataFrame([(" tsla",), ("ZZZ",), (None,)], "ticker string")
    assert values(mentions.with_validity(df, symbols), "ticker", "is_valid") == sorted(
        [(" tsla", True), ("ZZZ", False), (None, False)], key=repr)
    assert values(mentions.with_company_name(df, symbols), "ticker", "company_name") == sorted(
        [(" tsla", "Tesla Inc."), ("ZZZ", ""), (None, "")], key=repr)


def random_forest(n, seed):
    """Comments of random trees: some replies lost, some on a cycle, one long chain."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if i < 40:
            parent = ("post", "p0") if i == 0 else ("comment", f"c{i - 1}")
        else:
            parent = rng.choice([("post", f"p{rng.randrange(4)}"), ("comment", f"c{rng.randrange(i)}"),
                                 ("comment", f"c{rng.randrange(i)}"), ("comment", "lost")])
        rows.append((f"c{i}", "p0", *parent, "text"))
    rows += [("x1", "p0", "comment", "x2", "t"), ("x2", "p0", "comment", "x1", "t"), ("x3", "p0", "comment", "x2", "t"),
             ("x4", "p0", "comment", "x4", "t"), ("x5", "p0", None, None, "t")]
    return rows


def test_comment_depth_against_brute_force(spark):
    rows = random_forest(300, 1)
    parents = {r[0]: (r[2], r[3]) for r in rows}

    def depth(c, seen=()):
        kind, up = parents[c]
        if kind == "post":
            return 0
        if kind is None or up not in parents or up in seen:
            return None
        below = depth(up, (*seen, c))
        return None if below is None else below + 1

    got = dict(values(threads.comment_depth(comments_of(spark, rows)), "reddit_id", "depth"))
    assert got == {c: depth(c) for c in parents}
    assert max(d for d in got.values() if d is not None) >= 39


def test_parent_inheritance_against_brute_force(spark):
    rows = random_forest(300, 2)
    rng = random.Random(5)
    tagged = [("post", f"p{i}", t, 0.9 - i / 10) for i in range(2) for t in ("A", "B")]
    tagged += [("comment", f"c{i}", rng.choice("ABC"), rng.choice([0.3, 0.7, 0.95])) for i in rng.sample(range(300), 25)]
    # A post and a comment of one id do not mix.
    tagged += [("post", "c1", "Z", 0.9), ("comment", "x2", "Q", 0.9)]
    own = defaultdict(dict)
    for kind, content, ticker, confidence in tagged:
        own[kind, content][ticker] = confidence
    children = defaultdict(list)
    for r in rows:
        children[r[2], r[3]].append(r[0])
    want = {}

    def hand_down(parent, carried):
        for child in children[parent]:
            if ("comment", child) in own:
                continue
            softened = {t: min(0.5, c * 0.8) for t, c in carried.items()}
            want.update({(child, t): round(c, 6) for t, c in softened.items()})
            hand_down(("comment", child), softened)

    for key, carried in own.items():
        hand_down(key, carried)
    got = inheritance.parent_inheritance(comments_of(spark, rows), mention_rows(spark, tagged))
    assert {(c, t): x for c, t, x in values(got, "content_reddit_id", "ticker", F.round("confidence", 6))} == want
    assert len(want) > 50


def test_running_hype_against_pandas(spark, sf_dir):
    rows = adapters.mentions(spark, sf_dir).withColumn("ticker", F.lit("ONE"))
    got = aggregates.running_hype(rows, "event_id").toPandas().sort_values("event_id").reset_index(drop=True)
    frame = rows.select("event_id", "created_utc", "hype_score").toPandas().sort_values(["created_utc", "event_id"])
    frame["n"] = range(1, len(frame) + 1)
    frame["avg"] = frame["hype_score"].cumsum() / frame["n"]
    frame["peak"] = frame["hype_score"].cummax()
    frame = frame.sort_values("event_id").reset_index(drop=True)
    assert (got["mentions_so_far"] == frame["n"]).all()
    pd.testing.assert_series_equal(got["avg_hype_so_far"], frame["avg"], check_names=False, rtol=1e-9)
    pd.testing.assert_series_equal(got["max_hype_so_far"], frame["peak"], check_names=False)


def test_running_hype_splits_one_ticker(spark, monkeypatch):
    rows = spark.range(20000).select(
        F.lit("ONE").alias("ticker"), F.lit(None).cast("timestamp").alias("created_utc"), "id",
        (F.col("id") % 10 / 10).alias("hype_score"),
    )
    kept = []
    cut = aggregates.cut_lineage
    monkeypatch.setattr(aggregates, "cut_lineage", lambda df: kept.append(cut(df)) or kept[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = aggregates.running_hype(rows, "id")
        assert got.agg(F.max("mentions_so_far")).first()[0] == 20000
        assert got.select("mentions_so_far").distinct().count() == 20000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    # One ticker, all at one (missing) time, still lies in several slices.
    assert kept[0].select("slice").distinct().count() > 1


def test_totals_of_parts_are_totals(spark, sf_dir):
    rows = adapters.mentions(spark, sf_dir)
    parts = [aggregates.partial_totals(rows.filter(F.col("event_id") % 4 == i)) for i in range(4)]
    merged = parts[0]
    for part in parts[1:]:
        merged = aggregates.merge_totals(merged, part)
    whole = aggregates.ticker_totals(rows)
    assert values(aggregates.present_totals(merged), *whole.columns) == values(whole, *whole.columns)


def test_last_company_name_is_not_blank(spark):
    rows = spark.createDataFrame(
        [("tsla", "post", 0.5, "", 3), ("TSLA", "comment", 0.1, "Old", 1), ("TSLA", "comment", 0.126, "New", 2),
         (" ", "post", 0.9, "x", 1), ("GME", "post", 0.125, None, 1)],
        "ticker string, kind string, hype_score double, company_name string, t int",
    ).withColumn("created_utc", F.timestamp_seconds("t"))
    got = values(aggregates.ticker_totals(rows), "ticker", "company_name", "total_mentions", "total_posts",
                 "total_comments", "avg_hype_score", "max_hype_score")
    assert got == [("GME", "", 1, 1, 0, 0.13, 0.13), ("TSLA", "New", 3, 1, 2, 0.24, 0.5)]


def test_daily_stats_add_up_to_totals(spark, sf_dir, symbols):
    content = filters.content_union(adapters.posts(spark, sf_dir), adapters.comments(spark, sf_dir))
    found = analysis.analyze_with_context(content, symbols).mentions
    daily = aggregates.daily_stats(found, content)
    sums = daily.groupBy("ticker").agg(F.sum("mentions_count").alias("n"), F.sum("posts_count").alias("p"))
    totals = aggregates.ticker_totals(found)
    assert values(sums, "ticker", "n", "p") == values(totals, "ticker", "total_mentions", "total_posts")


def test_daily_stats_engagement_counts_a_content_once(spark):
    twice = mention_rows(spark, [("post", "p", "X", 0.5, 0), ("post", "p", "x", 0.5, 1)])
    content = filters.content_union(posts_of(spark, [("p", "t", 1704067200)]), comments_of(spark, []))
    row = aggregates.daily_stats(twice, content).first()
    assert (row["mentions_count"], row["total_engagement"]) == (2, 7)


def test_extraction_summary_and_counts(spark):
    rows = mention_rows(spark, [("post", "a", "X", 0.5), ("comment", "b", "X", 0.7), ("comment", "c", "Y", 0.9)])
    got = values(aggregates.extraction_summary(rows, 1), "ticker", "posts", "comments", "total", "unique_tickers")
    assert got == [("X", 1, 1, 2, 2)]
    assert aggregates.overall_summary(rows).first()["tickers"] == "X, Y"
    empty = aggregates.overall_summary(rows.limit(0)).first()
    assert (empty["total_extractions"], empty["unique_tickers"], empty["avg_confidence"]) == (0, 0, None)


def test_filters(spark):
    posts = posts_of(spark, [("a", "x", 100), ("b", "y", 200, 5), ("c", "z", 300)])
    assert values(filters.unprocessed(posts), "reddit_id") == [("a",), ("c",)]
    assert values(filters.processed(posts), "reddit_id") == [("b",)]
    got = filters.in_range(posts, "1970-01-01 00:01:40", "1970-01-01 00:05:00")
    assert values(got, "reddit_id") == [("a",), ("b",)]
    assert [r[0] for r in filters.oldest_first(posts, 2).select("reddit_id").collect()] == ["a", "b"]
    assert filters.top_posts_of_day(posts, "1970-01-01 00:04:00").count() == 2


def test_range_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "posts")
    posts_of(spark, [("a", "x", 100)]).write.parquet(path)
    plan = filters.in_range(spark.read.parquet(path), "2024-01-01", "2024-01-02").select("reddit_id")
    text = plan_of(plan)
    assert "GreaterThanOrEqual(created_utc" in text and "LessThan(created_" in text
    assert "title" not in text.split("ReadSchema")[1].split("\n")[0]


def test_no_python_outside_scorers(spark, sf_dir, symbols):
    content = filters.content_union(adapters.posts(spark, sf_dir), adapters.comments(spark, sf_dir))
    plan = plan_of(aggregates.ticker_totals(analysis.analyze_with_context(content, symbols).mentions))
    assert "Python" not in plan and "mapInArrow" not in plan
    plan = plan_of(mentions.direct_mentions(content, symbols))
    assert "BroadcastHashJoin" in plan and "ArrowEvalPython" not in plan


def test_upsert(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, kept string")
    updates = spark.createDataFrame([("b", 5, 1), ("b", None, 2), ("c", 7, 1)], "k string, v int, o int")
    merged = maintenance.upsert(target, updates, ["k"], ["o"])
    want = [("a", 1, "x"), ("b", None, "y"), ("c", 7, None)]
    assert values(merged, "k", "v", "kept") == sorted(want, key=repr)
    again = maintenance.upsert(merged, updates, ["k"], ["o"])
    assert values(again, "k", "v", "kept") == sorted(want, key=repr)
    assert merged.schema == target.schema


def test_mark_processed(spark):
    posts = posts_of(spark, [("a", "x", 100), ("b", "y", 200, 5), ("c", "z", 300)])
    handled = spark.createDataFrame([("a",), ("a",)], "reddit_id string")
    got = maintenance.mark_processed(posts, handled, "2024-01-01 00:00:00")
    assert [(k, bool(p)) for k, p in values(got, "reddit_id", "processed_at")] == [("a", True), ("b", True), ("c", False)]


def test_analyze_stored_skips_known(spark, symbols):
    posts = posts_of(spark, [("a", "TSLA", 1), ("b", "GME", 2)])
    comments = comments_of(spark, [("c", "a", "post", "a", "AAPL"), ("a", "b", "post", "b", "TSLA")])
    known = mention_rows(spark, [("post", "a", "TSLA", 0.9)])
    got = analysis.analyze_stored(posts, comments, symbols, known).mentions
    # The comment "a" is not the post "a".
    assert values(got, "kind", "content_reddit_id") == [("comment", "a"), ("comment", "c"), ("post", "b")]


def test_incremental_takes_oldest_and_inherits_from_stored(spark, symbols):
    posts = posts_of(spark, [("p", "TSLA", 1, 9)])
    comments = comments_of(spark, [("c1", "p", "post", "p", "LFG!!!"), ("c2", "p", "post", "p", "moon")])
    stored = mention_rows(spark, [("post", "p", "TSLA", 0.9)])
    result = analysis.analyze_incremental(posts, comments, symbols, stored, comment_limit=1)
    assert values(result.mentions, "content_reddit_id", "ticker") == [("c1", "TSLA")]
    assert result.items.count() == 1


def test_on_arrival_cascades(spark, symbols):
    posts = posts_of(spark, [("p", "TSLA", 1)])
    comments = comments_of(spark, [("c1", "p", "post", "p", "meh"), ("c2", "p", "comment", "c1", "fine"),
                                   ("c3", "p", "comment", "c2", "LFG!!! moon"), ("c4", "p", "comment", "c3", "so")])
    got = analysis.analyze_on_arrival(posts, comments, symbols).mentions
    assert values(got, "content_reddit_id", "method", F.round("confidence", 3)) == [
        ("c1", "inherit", 0.5), ("c2", "inherit", 0.4), ("c3", "contextual_inheritance", 0.75), ("c4", "inherit", 0.5),
        ("p", "rule", 0.95)]
    assert set(MENTION_COLUMNS) <= set(got.columns)


def test_backfill(spark, symbols):
    posts = posts_of(spark, [("p", "TSLA", 1704067200), ("q", " ", 1704240000), ("r", "GME", 1704067300, 9)])
    comments = comments_of(spark, [("c", "p", "post", "p", "LFG!!!"), ("d", "p", "post", "p", "[deleted]")])
    content = filters.content_union(posts, comments)
    result = backfill.backfill(content, symbols, "2024-01-01", "2024-01-04")
    daily = backfill.daily_report(result, "2024-01-01", "2024-01-04")
    got = values(daily, F.col("day").cast("string"), "items", "mentions", "inherited")
    assert got == [("2024-01-01", 3, 2, 1), ("2024-01-02", 0, 0, 0), ("2024-01-03", 1, 0, 0)]
    assert tuple(backfill.report_totals(daily).first()) == (3, 4, 2, 1)
    scope = backfill.scope(content, "2024-01-01", "2024-01-04").first()
    assert (scope["posts"], scope["comments"], scope["items"], scope["days"]) == (2, 2, 4, 3)
    assert scope["estimated_hours"] == pytest.approx(4 / 2 / 3600)
    with pytest.raises(ValueError):
        backfill.scope(content, "2024-01-02", "2024-01-02")


def test_resume_point(spark):
    content = filters.content_union(posts_of(spark, [("p", "x", 1704067200, 9)]), comments_of(spark, []))
    row = backfill.resume_point(content, "2024-01-02").first()
    assert (str(row["latest_processed"]), str(row["resume_date"]), row["up_to_date"]) == ("2024-01-01", "2024-01-02", True)
    assert not backfill.resume_point(content, "2024-01-03").first()["up_to_date"]
    assert backfill.resume_point(content.filter("false"), "2024-01-03").count() == 0


def test_score_with(spark):
    texts = ["plain TSLA", "boom", "never", None]
    df = spark.createDataFrame([(f"i{i}", t, i) for i, t in enumerate(texts)], "reddit_id string, text string, n int")
    df = df.withColumn("n", F.when(F.col("n") != 2, F.col("n"))).coalesce(1)

    def make():
        def reply(text):
            if text == "boom":
                raise ValueError("no")
            return "hm" if text == "never" else '{"tickers": [{"symbol": "tsla"}], "hype_score": "0.4"}'

        return lambda texts: [reply(text) for text in texts]

    got = scoring.score_with(df, "text", make).collect()
    by_id = {r["reddit_id"]: (r["response"], r["error"], r["n"]) for r in got}
    assert by_id["i0"][0].startswith("{") and by_id["i0"][1] is None
    assert by_id["i1"] == (None, "ValueError: no", 1)
    assert by_id["i2"] == ("hm", "no JSON in the response", None)
    assert by_id["i3"][1] is None


def test_second_attempt(spark):
    """The second attempt repairs what the first could not: calls alternate per text."""
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "reddit_id string, text string").coalesce(1)
    calls = spark.sparkContext.accumulator(0)

    def make():
        def score(texts):
            calls.add(len(texts))
            return ["hm" if t == "x" else "{}" for t in texts]

        return score

    got = {r["reddit_id"]: r["error"] for r in scoring.score_with(df, "text", make).collect()}
    assert got == {"a": "no JSON in the response", "b": None}
    # Two texts in the first attempt, the failed one again in the second.
    assert calls.value == 3


def test_no_text_is_asked_three_times(spark):
    """One bad text in the batch, one that stays unusable, one that a later try repairs."""
    texts = ["good", "bad", "never", "later"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    calls = {t: spark.sparkContext.accumulator(0) for t in texts}

    def make(whole):
        def score(asked):
            for t in asked:
                calls[t].add(1)
            replies = [{"good": "{}", "bad": ValueError("no"), "never": "hm"}.get(t, "{}") for t in asked]
            if whole and "bad" in asked:
                raise ValueError("no")
            return ["hm" if t == "later" and len(asked) > 1 else r for t, r in zip(asked, replies)]

        return lambda: score

    want = {"good": None, "bad": "ValueError: no", "never": "no JSON in the response", "later": None}
    for whole, counts in ((True, [2, 2, 2, 2]), (False, [1, 1, 2, 2])):
        before = {t: calls[t].value for t in texts}
        assert {r.text: r.error for r in scoring.score_with(df, "text", make(whole)).collect()} == want
        assert [calls[t].value - before[t] for t in texts] == counts


def test_hype_that_is_no_number_is_asked_again(spark, tmp_path):
    df = spark.createDataFrame([("a", "to the moon")], "reddit_id string, body string")
    asked = tmp_path / "asked"

    def make():
        def score(texts):
            value = "0.5" if asked.exists() else '"high"'
            asked.touch()
            return [f'{{"contextual_hype": {value}}}' for _ in texts]

        return score

    assert scoring.hype_with(df, make).collect()[0]["hype_score"] == 0.5


def test_wrong_number_of_replies_is_an_error(spark):
    df = spark.createDataFrame([("a", "x")], "reddit_id string, text string")
    row = scoring.score_with(df, "text", lambda: lambda texts: []).first()
    assert row["error"].startswith("ValueError")


def test_mentions_with_scorer(spark):
    df = spark.createDataFrame(
        [("comment", "c", "p", "I like tsla", 1), ("post", "q", "q", "[1]", 1)],
        "kind string, reddit_id string, post_reddit_id string, text string, t int",
    ).withColumn("created_utc", F.timestamp_seconds("t"))

    def make():
        return lambda texts: [
            "[1, 2]" if t == "[1]" else 'x {"tickers": [{"symbol": "tsla", "name": "Tesla"}, {}], "hype_score": 7}'
            for t in texts
        ]

    got = values(scoring.mentions_with(df, make), "content_reddit_id", "pos", "ticker", "span_start", "span_end",
                 "hype_score", F.round("confidence", 6), "context_post_id")
    assert got == [("c", 0, "TSLA", 7, 11, 7.0, 0.95, "p"), ("c", 1, "", -1, -1, 7.0, 0.5, "p")]


def test_hype_with_scorer(spark):
    df = spark.createDataFrame([("a", "good text"), ("b", "x"), ("c", "fail")], "reddit_id string, body string")

    def make():
        return lambda texts: ['{"contextual_hype": 3}' if t != "fail" else "?" for t in texts]

    assert values(scoring.hype_with(df, make), "reddit_id", "hype_score") == [("a", 1.0), ("b", 0.0), ("c", 0.0)]


def test_posts_with_tickers_keeps_plain_posts(spark):
    posts = posts_of(spark, [("a", "x", 1), ("b", "y", 2)])
    got = mentions.posts_with_tickers(posts, mention_rows(spark, [("post", "a", "X", 0.5), ("comment", "b", "Y", 0.5)]))
    assert values(got, "reddit_id", "ticker") == [("a", "X"), ("b", None)]


def test_table_schemas_have_the_keys(spark):
    assert "processed_at" in POSTS.fieldNames() and "processed_at" in COMMENTS.fieldNames()
