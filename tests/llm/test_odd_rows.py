"""Rows without ids, repeated ids, and inputs that grow without bound, for the corpus operators."""

import random
import time

import pytest
from conftest import values
from pyspark.sql import functions as F

from threadlytics.llm import credentials, lines, pages, quantisation, simhash, topk

VECTORS = "vec_id long, embedding array<double>"


def test_perfect_hash_serves_every_line_and_deals_hot_ones(spark):
    rows = [(i if i % 3 else None, f"Shared line\nown {i}\n shared LINE ") for i in range(60)]
    rows += [(None, "twin"), (None, "twin"), (5, None), (5, "other\nshared line")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = sorted(((i, "" if t is None else "\n".join(x for x in t.split("\n") if x.strip().lower() != "shared line"),
                    len((t or "").split("\n"))) for i, t in rows), key=repr)
    for cell in (lines.CELL, 7):
        kept = lines.drop_common_lines(docs, min_docs=10, cell=cell)
        assert values(kept, "doc_id", "text", "n_lines") == want


def test_one_row_of_each_group_stays_without_ids(spark):
    rows = [(None, "first text of its own here", {"a": 1}), (None, "second text, quite another one", {"b": 2}), (None, "second text, quite another one", {"a": 2}),
            (7, "text with an id that others copy", None), (None, "text with an id that others copy", {"x": 1}), (None, None, None), (None, "", {"z": 1}),
            (9, "text of nine", {"k": 1}), (9, "text of nine", {"j": 1})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra map<string,int>")
    kept = simhash.keep_one(docs)
    assert values(kept, "doc_id", "text") == sorted([(None, "first text of its own here"), (None, "second text, quite another one"), (7, "text with an id that others copy"),
                                                     (None, None), (9, "text of nine")], key=repr)
    assert kept.columns == docs.columns and kept.where("doc_id = 9").head()["extra"] == {"j": 1}
    groups = simhash.near_duplicates(docs)
    assert groups.count() == len(rows) and groups.where("component_id is null").count() == 5


def test_vectors_without_or_with_repeated_ids(spark):
    rows = [(3, [1.0, 0.01]), (3, [-1.0, 0.0]), (4, [-1.0, 0.01]), (None, [0.0, 1.0]), (None, [0.0, 1.0]), (8, [0.5, -1.0]), (None, [0.5, -1.0]), (1, None)]
    told = quantisation.near_duplicates(spark.createDataFrame(rows, VECTORS), threshold=0.95)
    assert values(told, "vec_id", "n_links", "component_id", "kept") == sorted([
        (3, 0, 3, True), (3, 1, 3, True), (4, 1, 3, False), (None, 1, None, True), (None, 1, None, True), (8, 1, 8, True), (None, 1, 8, False), (1, 0, 1, True)], key=repr)


def test_top_k_leaves_out_rows_without_ids(spark):
    vectors = topk.quantised(spark.createDataFrame([(0, [1.0]), (None, [9.0]), (1, [2.0]), (2, [3.0])], VECTORS))
    assert values(topk.top_k(vectors, vectors.where("vec_id = 0"), 5), "query_id", "rank", "vec_id") == [(0, 1, 2), (0, 2, 1)]


ARTICLE = "<article>" + "<p>words of the article go on and on for quite a while here</p>" * 5 + "</article>"


@pytest.mark.parametrize("unclosed", [50, 150, 3000])
def test_unclosed_elements_of_an_advert_do_not_swallow_the_article(unclosed):
    weights = pages.Weights({})
    page = f"<body><div class='advert'>{'<i>x ' * unclosed}</div>{ARTICLE}</body>"
    assert pages.main_text(page, weights).count("words of the article") == 5


def test_open_elements_cost_no_more_than_their_number():
    weights = pages.Weights({})
    start = time.perf_counter()
    text = pages.main_text("<body>" + "<span>w " * 20_000 + "<p>end" + "</span>" * 20_000, weights)
    assert time.perf_counter() - start < 2 and text.endswith("end")


def test_a_paragraph_ends_the_one_before_whatever_is_open_in_it():
    weights = pages.Weights({})
    assert pages.main_text("<body><p>one <b><i><u><em>two<p>three</body>", weights) == "one two\nthree"


def test_many_spans_of_a_long_text_take_linear_time():
    text = ("é token=abcdefgh1 " + "Zq9" * 4 + " 0123456789abcdef01234567 xK3pQ9vLm2Rt8Wz4Yb6N\n").encode() * 10_000
    ratio = credentials.Ratio(*credentials.np.ones((2, credentials.N**2)))
    began = time.time()
    base = credentials.base_spans(text)
    every = credentials.all_spans(text, base, ratio, -1.0, -1.0)
    told = credentials.written(text, every)
    assert time.time() - began < 4 and len(base) == 20_000 and len(every) == 30_000
    whole = text.decode()
    for span in told.split(",")[::997]:
        kind, a, b = span.split(":")
        assert whole[int(a) : int(b)] == {"assign": "token=abcdefgh1", "hex": "0123456789abcdef01234567", "markov": "xK3pQ9vLm2Rt8Wz4Yb6N"}[kind]


@pytest.mark.parametrize("queries", [16384, 3])
def test_best_rows_over_many_blocks_and_parts(spark, monkeypatch, queries):
    """Blocks of a few rows, a third of them one repeated row, and queries whose length few rows have."""
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERIES", queries)
    rng = random.Random(5)
    rows = [(i % 70, [rng.randint(-9, 9) for _ in range(4)]) for i in range(90)] + [(77, [1, 2, 3, 4])] * 45 + [(80, [5, 5]), (81, [1, 2]), (82, [3])]
    frame = spark.createDataFrame(rows, "vec_id long, v array<long>").repartition(4)
    asked = {i: v for i, v in rows if i in (17, 37, 57, 77, 80, 81, 82)}
    got = topk.top_k(frame, spark.createDataFrame(list(asked.items()), "vec_id long, v array<long>"), k=5)
    found = {}
    for r in got.collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q, own in asked.items():
        best = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in rows if i != q and len(v) == len(own))[:5]
        assert sorted(found.get(q, [])) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
