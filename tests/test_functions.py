import string

import pytest
from conftest import values
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from threadlytics.functions import hype, responses, text, tickers
from threadlytics.operators import mentions
from threadlytics.operators.inheritance import contextual_hype


def one(spark, column_of, value, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(column_of(F.col("x")).alias("y")).first()["y"]


def many(spark, column_of, inputs, kind="string"):
    rows = [(i, x) for i, x in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, x {kind}").select("i", column_of(F.col("x")).alias("y"))
    return [r["y"] for r in sorted(df.collect())]


# Objects a model may return, and what may stand around them.
OBJECTS = ['{"a": 1}', '{"a": {"b": [1, "}"]}}', '{"a": "```"}', "{}"]
AROUND = [("", ""), ("```json\n", "\n```"), ("```", "```"), ("As asked: ", ""), ("", " - anything else?"), ("One\ntwo ", "\nthree")]
# One rule each: quotes, names, commas, numbers, two values, halves, text without any.
BROKEN = ["{'a':1}", "{a:1}", '{"a":1,}', '{"a":01}', '{"a":1} and {"b":2}', "[1] [2]", "}{", "1],[2", '{"a":1}],[{"b":2}',
          '{"a":1}},{"v":{"b":2}', "words, words", '{"a": yes}', "", None]
VALUES = ["[1,2]", "5", "null"]


def test_clean_json_finds_the_object_in_any_wrapping(spark):
    wrapped = [(before + held + after, held) for held in OBJECTS for before, after in AROUND if not (held == '{"a": "```"}' and "```" in before)]
    assert many(spark, responses.clean_json, [w for w, _ in wrapped]) == [held for _, held in wrapped]


def test_clean_json_of_what_is_no_object(spark):
    assert many(spark, responses.clean_json, BROKEN) == [""] * len(BROKEN)
    assert many(spark, responses.clean_json, VALUES) == VALUES


# The rule of the lexicon: a text scores the sum of the weights of the terms it holds, once each.
WEIGHTS = {"🚀": 0.3, "moon": 0.3, "diamond hands": 0.3, "lfg": 0.3, "yolo": 0.3, "💎": 0.3, "🙌": 0.3, "let's go": 0.2, "i'm in": 0.2,
           "buying": 0.2, "hold": 0.2, "bullish": 0.2, "risky": -0.2, "careful": -0.2, "not sure": -0.2, "bear": -0.2, "sell": -0.2}


def expected_hype(text):
    total = sum(w for term, w in WEIGHTS.items() if term in text.lower())
    total += 0.2 if "!!!" in text else 0.1 if "!" in text else 0
    total += 0.2 if len(text) > 3 and text.upper() == text != text.lower() else 0
    return round(min(1.0, max(0.0, total)), 6)


def test_lexicon_hype_of_each_term_pair_and_mark(spark):
    terms = list(WEIGHTS)
    cases = [f"{frame[0]}{t}{frame[1]}" for t in terms for frame in (("x ", " y"), ("", ""), ("", "!"), ("q ", "!!!"), ("", t))]
    cases += [f"x {a} {b} y" for i, a in enumerate(terms) for b in terms[i + 1 :]]
    cases += [" ".join(terms[:n]) for n in range(len(terms) + 1)] + ["QQQ", "QQQQ", "QQQ1", "1234", "Qqqq", "a!b", "!", "!!!!"]
    cases += [t.upper() for t in terms]
    got = many(spark, hype.lexicon_hype, cases)
    assert [round(x, 6) for x in got] == [expected_hype(c) for c in cases]


def test_contextual_hype_guard(spark):
    df = spark.createDataFrame([("a", "🚀"), ("b", None), ("c", " 🚀! "), ("d", "moon")], "reddit_id string, body string")
    got = dict(values(contextual_hype(df), "reddit_id", "hype_score"))
    assert got == {"a": 0.0, "b": 0.0, "c": 0.0, "d": 0.3}


def test_clamp(spark):
    got = many(spark, hype.clamp_unit, ["0.5", "7", "-1", "high", None, "1e-1"])
    assert got == [0.5, 1.0, 0.0, 0.0, 0.0, 0.1]


def test_hype_band(spark):
    got = many(spark, hype.hype_band, [0.0, 0.294, 0.295, 0.3, 0.5, 0.699, 0.89, 0.9, 1.0], "double")
    assert got == ["0.00-0.29", "0.00-0.29", "0.30-0.49", "0.30-0.49", "0.50-0.69", "0.70-0.89",
                   "0.70-0.89", "0.90-1.00", "0.90-1.00"]


def test_confidence(spark):
    rows = [("TSLA", "Tesla Inc.", True), ("GME", "", True), ("GE", " ", False), ("BLSH", None, True)]
    df = spark.createDataFrame(rows, "t string, n string, s boolean")
    got = dict(values(df, "t", tickers.extraction_confidence(F.col("t"), F.col("n"), F.col("s"))))
    assert got == pytest.approx({"TSLA": 0.95, "GME": 0.8, "GE": 0.5, "BLSH": 0.85})


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.text("AB $.", max_size=6), st.text(max_size=3), st.booleans()), min_size=1, max_size=30))
def test_confidence_range(spark, rows):
    df = spark.createDataFrame(rows, "t string, n string, s boolean")
    column = tickers.extraction_confidence(F.col("t"), F.col("n"), F.col("s"))
    low, high = df.agg(F.min(column), F.max(column)).first()
    assert 0.3 <= low <= high <= 1.0


# text, ticker, and where the mention stands
SPANS = [
    ("calls on $TSLA and some AAPL 🚀", "TSLA", 9, 14),
    ("calls on $TSLA and some AAPL 🚀", "AAPL", 24, 28),
    ("all of GME today", "GME", 7, 10),
    ("nothing to see", "GME", -1, -1),
    ("🚀🚀 $TSLA x", "TSLA", 3, 8),
    ("TSLA then $tsla", "TSLA", 10, 15),
    ("éGME and gme", "GME", 9, 12),
    ("éGME", "GME", 1, 4),
    ("$GMEX gme_ GME", "GME", 11, 14),
    ("BRK.B or brkxb", "BRK.B", 0, 5),
    ("BRKxB only", "BRK.B", -1, -1),
    ("❤️GME", "GME", 2, 5),
    ("line one\nGME\nline three", "GME", 9, 12),
    ("a $ sign, then GME$", "GME", 15, 18),
    ("xGMEx", "GME", 1, 4),
    ("", "GME", -1, -1),
    ("GME", "", -1, -1),
]


def test_span_cases(spark):
    df = spark.createDataFrame([(i, *c[:2]) for i, c in enumerate(SPANS)], "i int, text string, ticker string")
    got = values(mentions.with_span(df), "i", "span_start", "span_end")
    assert got == sorted(((i, *c[2:]) for i, c in enumerate(SPANS)), key=repr)


def is_word(character):
    return character == "_" or character.isalnum()


def places(text, ticker):
    """Starts of a ticker in a text by rank: 2 after a dollar sign and ending a word, 1 as a whole
    word, 0 anywhere.  Walks over the characters; tickers here start and end with a letter."""
    found = {}
    for at in range(len(text) - len(ticker) + 1):
        if text[at : at + len(ticker)].upper() != ticker.upper():
            continue
        before, after = text[at - 1 : at], text[at + len(ticker) : at + len(ticker) + 1]
        ends = not (after and is_word(after))
        rank = 2 if before == "$" and ends else 1 if ends and not (before and is_word(before)) else 0
        found.setdefault(rank, at)
    return found


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.text("aAbB.$ _é🚀\n1", max_size=14), st.sampled_from(["A", "B", "AB", "BA", "A.B", "ABA"])),
                min_size=1, max_size=60))
def test_span_property(spark, cases):
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, text string, ticker string")
    for r in mentions.with_span(df).collect():
        found = places(r.text, r.ticker)
        if not found:
            assert (r.span_start, r.span_end) == (-1, -1)
        else:
            rank = max(found)
            start = found[rank] - (rank == 2)
            assert (r.span_start, r.span_end) == (start, found[rank] + len(r.ticker))


def test_candidates(spark):
    cases = [
        ("YOLO $TSLA and AAPL. AAPL!", ["YOLO", "TSLA", "AAPL"]),
        ("$gme brk.b BRK.B", ["GME", "BRK.B"]),
        ("IT is ALL GO, $ALL", []),
        ("TOOLONG $TOOLONG xAAPL AAPLx é_A", []),
        ("A.Bc", ["A"]),
        (None, None),
    ]
    assert many(spark, tickers.ticker_candidates, [c[0] for c in cases]) == [c[1] for c in cases]


def test_symbol_dim(spark):
    df = spark.createDataFrame(
        [(" aapl ",), ("BRK.B",), ("TOOLONG",), ("A1",), ("",), (None,), ("AAPL",), ("ÉT",)], "symbol string"
    )
    assert values(mentions.symbol_dim(df), "symbol") == [("AAPL",), ("BRK.B",), ("ÉT",)]


def test_base36(spark):
    cases = [("z", 35), ("10", 36), ("abc123", int("abc123", 36)), ("1-2", None), ("", None), (None, None),
             ("é", None), ("zzzzzzzzzzzz", int("z" * 12, 36)), ("ZZ", 1295),
             ("1y2p0ij32e8e7", 2**63 - 1), ("1y2p0ij32e8e8", None), ("0000000000001", 1), ("0" * 40 + "z", 35),
             ("zzzzzzzzzzzzzz", None), ("10000000000000", None), ("0", 0), ("000", 0)]
    assert many(spark, text.base36_id, [c[0] for c in cases]) == [c[1] for c in cases]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(string.digits + string.ascii_letters, min_size=1, max_size=16), min_size=1, max_size=40))
def test_base36_property(spark, ids):
    assert many(spark, text.base36_id, ids) == [n if (n := int(x, 36)) < 2**63 else None for x in ids]


def test_parent_id(spark):
    inputs = ["t1_abc", "t3_a_b", "abc", "_x", "", None]
    assert many(spark, text.parent_id, inputs) == ["abc", "a_b", None, "x", None, None]
    assert many(spark, text.parent_kind, inputs) == ["comment", "post", None, None, None, None]


def test_strip(spark):
    inputs = ["\n a\t", " x　", "  ", "\x1fq\x0b", "a b"]
    assert many(spark, text.strip, inputs) == [x.strip() for x in inputs]


def test_epochs(spark):
    assert many(spark, lambda c: text.iso_utc(text.epoch_or_zero(c)), [None, 0, 1704067200], "bigint") == [
        "1970-01-01T00:00:00Z", "1970-01-01T00:00:00Z", "2024-01-01T00:00:00Z"]
    assert many(spark, lambda c: text.iso_utc(text.epoch_or_null(c)), [None, 0, 1704067200], "bigint") == [
        None, None, "2024-01-01T00:00:00Z"]


def test_likely_financial(spark):
    cases = [("Stock tips", "", True), ("hi", "costs $5", True), (None, "calling", True), ("x", None, False)]
    df = spark.createDataFrame(cases, "t string, b string, want boolean")
    assert df.filter(text.is_likely_financial(F.col("t"), F.col("b")) != F.col("want")).count() == 0


def test_is_analyzable(spark):
    inputs = ["hi", " ", None, "[deleted]", " [removed] ", "[deleted] x"]
    assert many(spark, text.is_analyzable, inputs) == [True, False, False, False, False, True]


def test_parent_confidence(spark):
    df = spark.createDataFrame([(0.9, d) for d in (1, 2, 3, 4)] + [(None, 1)], "c double, d int")
    got = [r[0] for r in df.select(hype.parent_confidence(F.col("c"), F.col("d"))).collect()]
    assert got[:4] == pytest.approx([0.5, 0.4, 0.32, 0.256]) and got[4] is None
