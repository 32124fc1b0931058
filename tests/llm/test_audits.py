"""Filter interaction, line labelling and divergence against plain versions, with nulls in every
column, empty and very long texts, ties, repeated rows, empty tables and clashing extra columns."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations, product
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadlytics.llm import divergence, interaction, labelling, queries
from threadlytics.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, mask string, part int, term string, size string, kept string"
LABELS = "doc_id long, quality int, toxic int, text string, part string"


def corpus(seed=5):
    rng = random.Random(seed)
    vocabulary = [f"wort{i}é" if i % 7 == 0 else f"Word{chr(97 + i % 26)}" for i in range(300)]
    make = lambda n: " ".join(rng.choices(vocabulary, k=n))
    copied = make(130)
    texts = [None, "", " \t\n\x0b", "one", "ONE TWO THREE", make(100), make(99), "a | b", "w " * 200, copied, copied, copied, copied.upper()]
    texts += [make(rng.randint(90, 140)) + rng.choice(["", "", " 5 %", " #tag"]) for _ in range(30)]
    texts += [" ".join(f"u{i}" for i in range(40_000)), "Same\nSame\nsame\n\n" + make(20)]
    rows = []
    for i, text in enumerate(texts):
        rows.append((i, text, ["en", "de", None, ""][i % 4], [f"s{i % 5}", None, "é", "z"][i % 4 if i % 3 else 0], 1, "x", 1, "y", "z", "k"))
    nameless = [(None, copied, "en", "s0", 1, "x", 1, "y", "z", "k"), (None, None, None, None, None, None, None, None, None, None)]
    return rows + nameless + [rows[9], rows[3], rows[-1]]


def labelled(rows):
    rng = random.Random(1)
    marks = [(r[0], rng.choice([0, 1, None]), rng.choice([0, 1, None]), "t", "p") for r in rows if r[0] is not None and r[0] % 3]
    return marks + marks[:4] + [(None, 1, 1, "t", "p"), (4, 1, 0, "t", "p")]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# Interaction of filters


def brute_audit(rows, marks):
    good = {d for d, q, _, *_ in marks if q == 1 and d is not None}
    toxic = {d for d, _, t, *_ in marks if t == 1 and d is not None}
    least = {}
    for doc, text, *_ in rows:
        if doc is not None:
            least[text or ""] = min(doc, least.get(text or "", doc))
    failed = []
    for doc, text, lang, *_ in rows:
        text = text or ""
        words = WORD.findall(text)
        upper = sum("A" <= c <= "Z" for c in text)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * upper > 10 * len(text),
                 "D": bool(re.search(r"[#$%&*|]", text)), "E": doc is not None and doc > least[text]}
        failed.append((lang or "", {k for k, v in fails.items() if v}, doc in good, doc in toxic))
    out, shapley = {}, Counter()
    for part in {f[0] for f in failed}:
        of = [f for f in failed if f[0] == part]
        for order in permutations("ABCDE"):
            left = of
            for step, name in enumerate(order, 1):
                gone = [f for f in left if name in f[1]]
                left = [f for f in left if name not in f[1]]
                failing = [f for f in of if name in f[1]]
                unique = sum(f[1] == {name} for f in of)
                out[part, "".join(order), step] = (len(left), len(gone), len(failing) - len(gone), unique, sum(f[2] for f in gone), sum(f[3] for f in gone))
                shapley[part, name] += len(gone)
    return sorted(((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()), key=repr)


REPORT = [f.split()[0] for f in interaction.REPORT.split(", ")]


def test_filter_audit_is_that_of_running_every_order(spark, rows, docs):
    marks = labelled(rows)
    masks = interaction.document_masks(docs, spark.createDataFrame(marks, LABELS))
    assert got(interaction.audit(masks, "ABCDE"), *REPORT) == brute_audit(rows, marks)


@pytest.mark.parametrize("n", [1, 2, 4, 6])
def test_paths_of_the_lattice(n):
    reaching, leaving = interaction.path_counts(n)
    for state in range(1 << n):
        size = state.bit_count()
        assert (reaching[state], leaving[state]) == (factorial(size), factorial(n - size))
    counts = [random.Random(state).randint(0, 9) for state in range(1 << n)]
    assert interaction.survivors(counts, n) == [sum(c for m, c in enumerate(counts) if not m & s) for s in range(1 << n)]


def test_audit_of_no_rows_of_nulls_and_of_other_filter_numbers(spark):
    kinds = "part string, mask int, rows long, good long, toxic long, step string"
    assert interaction.audit(spark.createDataFrame([], kinds), "ABCDE").count() == 0
    masks = spark.createDataFrame([(None, 3, 2, None, 1, "x"), ("", 3, 1, 1, None, "x"), ("", 0, None, 0, 0, "x"), ("b", 0, 5, 1, 1, "x")], kinds)
    report = got(interaction.audit(masks, "xy"), *REPORT)
    assert report == [
        ("", "xy", 1, 0, 3, 0, 0, 1, 1, 3), ("", "xy", 2, 0, 0, 3, 0, 0, 0, 3), ("", "yx", 1, 0, 3, 0, 0, 1, 1, 3), ("", "yx", 2, 0, 0, 3, 0, 0, 0, 3),
        ("b", "xy", 1, 5, 0, 0, 0, 0, 0, 0), ("b", "xy", 2, 5, 0, 0, 0, 0, 0, 0), ("b", "yx", 1, 5, 0, 0, 0, 0, 0, 0), ("b", "yx", 2, 5, 0, 0, 0, 0, 0, 0),
    ]
    for names in ("", "AA", "ABCDEFGHI"):
        with pytest.raises(ValueError):
            interaction.audit(masks, names)


def test_audit_of_empty_tables(spark, docs):
    labels = spark.createDataFrame([], LABELS)
    assert interaction.audit(interaction.document_masks(docs.limit(0), labels), "ABCDE").count() == 0
    assert interaction.audit(interaction.document_masks(docs, labels), "ABCDE").agg(F.sum("good_lost")).head()[0] == 0


# Line labelling


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    again = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if again[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)),
            len(covered), len(words) < 10 or 100 * len(covered) > 20 * len(words))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def fitted(sequences, **how):
    """The field of sequences of (features, label)."""
    lines = [(r, features, label) for r, s in enumerate(sequences) for features, label in s]
    names = sorted({f for _, features, _ in lines for f in features})
    pairs = [(i, names.index(f)) for i, (_, features, _) in enumerate(lines) for f in features]
    line, feature = np.array(pairs, np.int64).reshape(-1, 2).T
    return labelling.fit(np.array([r for r, _, _ in lines], np.int64), np.array([y for *_, y in lines], np.int64), line, feature, names, **how)


def test_line_rule_counts(rows, docs):
    everything = labelling.judge(docs, fitted([]))
    want = sorted(((r[0], *brute_counts(r[1]), not brute_counts(r[1])[-1]) for r in rows), key=repr)
    assert got(everything, "doc_id", *COUNTS, "kept") == want
    assert labelling.judge(docs.limit(0), fitted([])).count() == 0


def test_repeated_words_against_windows():
    rng = random.Random(2)
    for n in (0, 4, 5, 6, 30, 200, 2000):
        words = [rng.choice([b"a", b"b", b"c"]) if n < 300 else b"%d" % rng.randint(0, 9) for _ in range(n)]
        assert labelling.repeated_words(words) == brute_counts(b" ".join(words).decode())[4]
    assert labelling.repeated_words([b"x"] * 300_000) == 300_000


def score_of(path, scores, moves):
    return sum(s for s, y in zip(scores, path) if y) + sum(moves[a][b] for a, b in zip(path, path[1:]))


def test_decoding_and_marginals_against_all_paths():
    rng = np.random.default_rng(4)
    sequences, moves = [rng.normal(size=n) for n in (7, 5, 5, 2, 1)], rng.normal(size=(2, 2))
    field = labelling.Field({}, moves)
    padded = np.zeros((5, 7))
    for r, s in enumerate(sequences):
        padded[r, : len(s)] = s
    content, pairs = labelling.marginals(padded, np.array([len(s) for s in sequences]), moves)
    expected = np.zeros((2, 2))
    for r, s in enumerate(sequences):
        paths = list(product((0, 1), repeat=len(s)))
        weights = np.exp([score_of(p, s, moves) for p in paths])
        weights /= weights.sum()
        assert tuple(field.decode(s.tolist())) == paths[int(weights.argmax())]
        np.testing.assert_allclose(content[r, : len(s)], weights @ np.array(paths))
        for p, w in zip(paths, weights):
            for a, b in zip(p, p[1:]):
                expected[a, b] += w
    np.testing.assert_allclose(pairs, expected)
    assert field.decode([]) == [] and labelling.Field({}, np.zeros((2, 2))).decode([0.0, 0.0]) == [1, 1]


def test_fitted_weights_are_those_of_the_steepest_climb():
    """At the found weights, no small step of any weight makes the labels likelier than the penalty costs."""
    rng = random.Random(3)
    sequences = []
    for _ in range(40):
        label = rng.choice([0, 1])
        run = []
        for _ in range(rng.randint(1, 6)):
            label = label if rng.random() < 0.8 else 1 - label
            run.append(([b" bias", b" f %d" % (label if rng.random() < 0.8 else 1 - label)] + ([b"w"] if rng.random() < 0.3 else []), label))
        sequences.append(run)
    field = fitted(sequences, least=1, evidence=0.0, rounds=3000, penalty=1e-2)
    names = sorted(field.weights)
    n = sum(map(len, sequences))

    def loss(w, moves):
        weight, total = dict(zip(names, w)), 0.0
        for run in sequences:
            scores = [sum(weight[f] for f in features) for features, _ in run]
            paths = list(product((0, 1), repeat=len(run)))
            total += np.logaddexp.reduce([score_of(p, scores, moves) for p in paths]) - score_of([y for _, y in run], scores, moves)
        return total / n + 0.5 * 1e-2 * (np.square(w).sum() + np.square(moves).sum())

    at = np.array([field.weights[f] for f in names])
    best = loss(at, field.moves)
    for i in range(len(at)):
        for step in (-0.05, 0.05):
            moved = at.copy()
            moved[i] += step
            assert loss(moved, field.moves) > best
    for a, b in product((0, 1), repeat=2):
        for step in (-0.05, 0.05):
            moved = field.moves.copy()
            moved[a, b] += step
            assert loss(at, moved) > best


def test_labels_of_lines_tell_copies_from_boilerplate():
    A, B, C, LICENCE, POOR = 1, 2, 3, 4, 5
    runs = [(A, B, C)] * 9 + [(100 + d, LICENCE) for d in range(9)] + [(POOR,)]
    run, key = zip(*[(r, k) for r, keys in enumerate(runs) for k in keys])
    key = np.array(key)
    found = labelling.line_labels(np.array(run), key, np.where(key == POOR, 0, 1), 5)
    assert {k: set(found[key == k].tolist()) for k in (A, B, C, 100, LICENCE, POOR)} == {A: {1}, B: {1}, C: {1}, 100: {1}, LICENCE: {0}, POOR: {0}}


def test_held_out_accuracy_of_line_rules(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    field = labelling.train(docs, labels.where("doc_id % 2 = 0"), sample=2000)
    told = labelling.judge(docs, field).where("not base_failed").join(labels.where("doc_id % 2 = 1 and toxic = 0"), "doc_id")
    right = {r["quality"]: r["right"] for r in told.groupBy("quality").agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int")).alias("right")).collect()}
    assert right[1] > 0.98 and right[0] > 0.95


def test_training_again_gives_the_same_field(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    one, two = (labelling.train(d, labels, sample=100) for d in (docs, docs.repartition(7)))
    assert one.weights == two.weights and (one.moves == two.moves).all()
    assert labelling.train(docs, labels.limit(0)).decode([50.0]) == [labelling.CONTENT]


# Divergence


def brute_divergence(rows, min_docs, top):
    counts, langs, holders = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        words = [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        counts[lang or "", source or ""].update(words)
        langs[lang or ""].update(words)
        holders[lang or ""].update(set(words))
    out = []

    def ranks(key, part, items, most=None):
        order = sorted(items, key=lambda x: (-x[1], x[0].encode()))
        out.extend((*key, part, item, value, r) for r, (item, value) in enumerate(order[:most], 1))

    for lang, of in langs.items():
        kept = [t for t in of if holders[lang][t] >= min_docs]

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 1) // (total + len(kept)) for t in kept}

        q = shares(of)
        groups = {k: shares(c) for k, c in counts.items() if k[0] == lang}
        for key, p in groups.items():
            ranks(key, "pair", [(k[1], sum((p[t] - o[t]) ** 2 // o[t] for t in kept)) for k, o in groups.items() if k != key])
            ranks(key, "term", [(t, (p[t] - q[t]) ** 2 // q[t]) for t in kept if counts[key][t] and p[t] > q[t]], top)
    return sorted(out, key=repr)


DIVERGENCE = ["lang", "source", "part", "item", "value", "rank"]


@pytest.mark.parametrize("group_block,term_block", [(16, 4096), (2, 10), (1, 1000)])
def test_divergence_of_all_pairs_whatever_the_cells(rows, docs, group_block, term_block):
    found = divergence.audit(docs, min_docs=3, top=7, group_block=group_block, term_block=term_block)
    assert got(found, *DIVERGENCE) == brute_divergence(rows, 3, 7)


def test_divergence_without_rows_terms_or_partners(spark, docs):
    assert divergence.audit(docs.limit(0)).count() == 0
    few = spark.createDataFrame([(1, "only here", "xx", "a"), (2, None, "xx", "b"), (3, "alone", "yy", None)], "doc_id long, text string, lang string, source string")
    assert got(divergence.audit(few), *DIVERGENCE) == [("xx", "a", "pair", "b", 0, 1), ("xx", "b", "pair", "a", 0, 1)]


def test_partial_counts_do_not_depend_on_when_they_are_passed_on(docs, rows, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 1)
    assert got(divergence.audit(docs.coalesce(1), top=7), *DIVERGENCE) == brute_divergence(rows, 3, 7)


def test_shares_are_exact_for_huge_counts(spark):
    rows = [(0, 1), (0, 3), (5, 6), (10**15 - 7, 8 * 10**15 + 1), (7 * 10**15, 8 * 10**15)]
    found = spark.createDataFrame(rows, "n long, size long").select("n", "size", divergence.share("n", "size"))
    assert [tuple(r) for r in found.collect()] == [(n, s, 1 + 10**9 * (n + 1) // s) for n, s in rows]


def test_queries_of_the_audits_run(spark, sf_dir):
    assert queries.op12_rules(spark, sf_dir).where("kept and base_failed").count() == 0
