"""Labels of lines, content or boilerplate, by a linear-chain conditional random field.

A document is a sequence of lines.  Each line has binary features of its shape, and words that
training found often enough; the field scores a label by the features of its line and by the
label of the line before.  Viterbi decoding gives the best sequence of a whole document, and the
share of its text in content lines decides whether it is kept, next to fixed counts.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlytics.llm.common import text_bytes

BOILERPLATE, CONTENT = 0, 1
CONTINUED = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that begin no code point
SYMBOLS = b"#*$%&|<>"
UPPER, DIGITS = bytes(range(65, 91)), b"0123456789"
MARKS = b".,;:!?%*&$#|<>\"'()[]"
RUN = 64  # lines that a sampled document gives to training


def level(share: float) -> int:
    """0 for none, then a step for each doubling from 1/64."""
    return 0 if share <= 0 else 1 + max(0, min(7, int(np.floor(np.log2(share))) + 6))


LEVELS = [level(i / 256) for i in range(257)]


def shape(line: bytes, words: list[bytes], repeated: bool, last: bool) -> list[bytes]:
    """Names of the shape features of a line that has ``words``; they begin with a space, which words never do."""
    n, size = len(words), len(line)

    def part(held: bytes, of: int) -> int:
        return LEVELS[min(256, 256 * (size - len(line.translate(None, held))) // of)]

    found = [
        b" bias",
        b" symbols %d" % part(SYMBOLS, size),
        b" upper %d" % part(UPPER, size),
        b" digits %d" % part(DIGITS, size),
        b" shouts %d" % part(b"!", n),
        b" bars %d" % part(b"|", n),
        b" stops %d" % part(b".,;:", n),
        b" words %d" % n.bit_length(),
        b" letters %d" % (min(size // n, 24) // 3),
        b" ends" if line.rstrip()[-1:] in (b".", b"!", b"?") else b" open",
    ]
    if n >= 8:
        found.append(b" distinct %d" % (len(set(words)) * 8 // n))
    if repeated:
        found.append(b" repeated")
    if last:
        found.append(b" last")
    return found


def line_sequence(text: bytes):
    """Lines that have a word, as (bytes, words, equal to an earlier line, last of the text)."""
    lines = [(line, words) for line in text.split(b"\n") if (words := line.split())]
    seen: set[bytes] = set()
    for at, (line, words) in enumerate(lines):
        yield line, words, line in seen, at == len(lines) - 1
        seen.add(line)


def vocabulary(words: list[bytes]) -> set[bytes]:
    return {w.strip(MARKS) for w in {w.lower() for w in words}}


@dataclass
class Field:
    """Weights for content over boilerplate by feature, and scores of (label before, label)."""

    weights: dict[bytes, float]
    moves: np.ndarray

    def score(self, line: bytes, words: list[bytes], repeated: bool, last: bool) -> float:
        held = sorted(vocabulary(words) & self.weights.keys())
        return sum(self.weights.get(f, 0.0) for f in shape(line, words, repeated, last) + held)

    def decode(self, scores: list[float]) -> list[int]:
        """The labels of the best path; of equal paths the one that says content later on."""
        (bb, bc), (cb, cc) = self.moves.tolist()
        back, bad, good = [], 0.0, 0.0
        for at, score in enumerate(scores):
            if at:
                from_bad, from_good = bad + bb > good + cb, bad + bc > good + cc
                back.append((BOILERPLATE if from_bad else CONTENT, BOILERPLATE if from_good else CONTENT))
                bad, good = (bad + bb if from_bad else good + cb), (bad + bc if from_good else good + cc)
            good += score
        labels = [BOILERPLATE if bad > good else CONTENT] if scores else []
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]


def marginals(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray):
    """Forward-backward sums of many sequences at once, longest first.

    ``scores`` has a row per sequence and a column per line.  Returns the probability of content
    of each line and the expected number of each pair of labels.
    """
    n, width = scores.shape
    forward = np.zeros((n, width, 2))
    forward[:, 0, CONTENT] = scores[:, 0]
    alive = [int((lengths > t).sum()) for t in range(width)]
    for t in range(1, width):
        a = alive[t]
        paths = forward[:a, t - 1, :, None] + moves
        forward[:a, t] = np.logaddexp(paths[:, 0], paths[:, 1])
        forward[:a, t, CONTENT] += scores[:a, t]
    backward = np.zeros((n, width, 2))
    pairs = np.zeros((2, 2))
    ends = forward[np.arange(n), lengths - 1]
    total = np.logaddexp(ends[:, 0], ends[:, 1])
    for t in range(width - 2, -1, -1):
        a = alive[t + 1]
        ahead = backward[:a, t + 1].copy()
        ahead[:, CONTENT] += scores[:a, t + 1]
        paths = moves + ahead[:, None, :]
        backward[:a, t] = np.logaddexp(paths[:, :, 0], paths[:, :, 1])
        pairs += np.exp(forward[:a, t, :, None] + paths - total[:a, None, None]).sum(axis=0)
    content = np.exp(np.minimum(forward[..., CONTENT] + backward[..., CONTENT] - total[:, None], 0))
    return content, pairs


def fit(run: np.ndarray, label: np.ndarray, line: np.ndarray, feature: np.ndarray, names: list[bytes], least: int = 8,
        evidence: float = 6.0, rounds: int = 150, pace: float = 0.5, penalty: float = 1e-4) -> Field:
    """Weights of the highest likelihood of labelled sequences.

    ``run`` and ``label`` are those of each line, runs numbered from 0 and in order; ``line`` and
    ``feature`` are the pairs of a line and a feature that it has, ``names`` in ascending order.  Shapes
    count from ``least`` lines on.  Words count if in addition their share of boilerplate lines is
    ``evidence`` standard deviations from the overall one.  Full-batch AdaGrad, so reruns agree.
    Without lines every line is content.
    """
    if not len(run):
        return Field({b" bias": 50.0}, np.zeros((2, 2)))
    seen = np.bincount(feature, minlength=len(names))
    bad = np.bincount(feature, weights=label[line] == BOILERPLATE, minlength=len(names))
    rate = ((label == BOILERPLATE).sum() + 0.5) / (len(label) + 1)
    shapes = np.array([name[:1] == b" " for name in names], bool)
    used = (seen >= least) & (shapes | (np.abs(bad - seen * rate) >= evidence * np.sqrt(seen * rate * (1 - rate))))
    line, feature = line[used[feature]], (np.cumsum(used) - 1)[feature[used[feature]]]
    names = [name for name, telling in zip(names, used) if telling]
    lengths = np.bincount(run)
    place = np.argsort(np.argsort(-lengths, kind="stable"))
    row, column = place[run], np.arange(len(run)) - (np.cumsum(lengths) - lengths)[run]
    lengths = -np.sort(-lengths)
    told, next_to = np.zeros((2, 2)), run[1:] == run[:-1]
    np.add.at(told, (label[:-1][next_to], label[1:][next_to]), 1)
    w, moves = np.zeros(len(names)), np.zeros((2, 2))
    past, moves_past = np.full(len(names), 1e-8), np.full((2, 2), 1e-8)
    scores = np.zeros((len(lengths), lengths[0]))
    for _ in range(rounds):
        scores[row, column] = np.bincount(line, weights=w[feature], minlength=len(run))
        content, pairs = marginals(scores, lengths, moves)
        error = content[row, column] - label
        grad = np.bincount(feature, weights=error[line], minlength=len(names)) / len(run) + penalty * w
        past += grad**2
        w -= pace * grad / np.sqrt(past)
        grad = (pairs - told) / len(run) + penalty * moves
        moves_past += grad**2
        moves -= pace * grad / np.sqrt(moves_past)
    return Field(dict(zip(names, w.tolist())), moves)


def train(docs: DataFrame, labels: DataFrame, sample: int = 6000, shared: int = 5) -> Field:
    """Fit on runs of lines of at most ``sample`` labelled documents, those of the smallest hashes of
    their doc_id; a run is at most 64 lines long and starts where a hash says.

    Lines of documents labelled good are content, those of others boilerplate, as are lines that
    stand next to ``shared`` different lines.  Of repeated labels the lowest counts, labels with a
    null do not.  The sample bounds what the driver receives, which stays in Arrow and numpy arrays.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    chosen = known.agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes()).join(F.broadcast(chosen), "doc_id")

    def run(batches):
        for batch in batches:
            out = []
            for doc, text, good in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "quality"))):
                found = list(line_sequence(text))
                start = int.from_bytes(hashlib.md5(b"%d" % doc).digest()[:4], "big") % max(1, len(found) - RUN + 1)
                for at, (line, words, repeated, last) in enumerate(found[start : start + RUN]):
                    key = int.from_bytes(hashlib.md5(line.strip().lower()).digest()[:8], "big", signed=True)
                    out.append((doc, at, key, int(good), [*shape(line, words, repeated, last), *vocabulary(words)]))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.binary())]
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 5, kinds)], ["doc", "at", "key", "good", "features"]
            )

    got = rows.mapInArrow(run, "doc long, at int, key long, good int, features array<binary>").toArrow()
    got = got.sort_by([(c, "ascending") for c in ("doc", "at", "key", "good")])
    doc, key, good = (got.column(c).to_numpy() for c in ("doc", "key", "good"))
    features = got.column("features").combine_chunks()
    encoded = features.flatten().dictionary_encode()
    names = encoded.dictionary.to_pylist()
    order = sorted(range(len(names)), key=names.__getitem__)
    rank = np.empty(len(names), np.int64)
    rank[order] = np.arange(len(names))
    line = np.repeat(np.arange(len(doc)), np.diff(features.offsets.to_numpy()))
    of_run = np.cumsum(np.diff(doc, prepend=doc[:1]) != 0)
    return fit(of_run, line_labels(of_run, key, good, shared), line, rank[encoded.indices.to_numpy()], [names[i] for i in order])


def line_labels(run: np.ndarray, key: np.ndarray, good: np.ndarray, shared: int) -> np.ndarray:
    """Labels of lines in order, from their run, a hash of the line and the label of the document.

    Copies of a text repeat a line next to the same lines, boilerplate stands next to others: a
    line is boilerplate if ``shared`` different lines precede or follow it.
    """
    number = np.unique(key, return_inverse=True)[1]
    together = run[1:] == run[:-1]
    pairs = np.unique(np.stack([number[:-1][together], number[1:][together]]), axis=1)
    n = len(number)
    apart = np.maximum(np.bincount(pairs[0], minlength=n), np.bincount(pairs[1], minlength=n))
    return np.where((good == 1) & (apart[number] < shared), CONTENT, BOILERPLATE)


def repeated_words(words: list[bytes], window: int = 5) -> int:
    """How many words lie in a window of consecutive words that the text has twice or more.

    Windows are numbered by doubling: equal pairs of numbered stretches get equal numbers, so
    the work grows with the text times its logarithm and numbers are never hashes.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    single = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    if len(known) == len(words):
        return 0
    number, covered = single, 1
    while covered < window:
        step = min(covered, window - covered)
        pair = number[: len(words) - covered - step + 1] * (int(number.max()) + 1) + number[step : len(words) - covered + 1]
        covered += step
        number = np.unique(pair, return_inverse=True)[1]
    twice = np.flatnonzero(np.bincount(number)[number] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + window, -1)
    return int((np.cumsum(edges) > 0).sum())


def n_chars(held: bytes) -> int:
    return len(held.translate(None, CONTINUED))


def verdict(text: bytes, field: Field, share: float) -> tuple[int, int, int, int, int, bool, bool]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) of a text."""
    found = list(line_sequence(text))
    sizes = [sum(map(len, words)) if line.isascii() else n_chars(b"".join(words)) for line, words, _, _ in found]
    words = [w for _, some, _, _ in found for w in some]
    again = repeated_words(words)
    failed = len(words) < 10 or 100 * again > 20 * len(words)
    kept = False
    if not failed:
        labels = field.decode([field.score(*line) for line in found])
        kept = sum(s for s, label in zip(sizes, labels) if label == CONTENT) >= share * sum(sizes)
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    return len(words), sum(sizes), symbols, sum(r for _, _, r, _ in found), again, failed, kept


def judge(docs: DataFrame, field: Field, share: float = 0.3) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) of every row.

    Kept are texts that pass the counts and have at least ``share`` of the characters of their
    words in content lines.  Null texts are empty; texts of fewer than ten words fail the counts.
    Rows that repeat a doc_id, or have none, are judged one by one; other columns are ignored.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2

    def run(batches):
        for batch in batches:
            found = list(zip(*(verdict(t, field, share) for t in batch.column(1).to_pylist()))) or [()] * 7
            yield pa.record_batch([batch.column(0), *(pa.array(c, k) for c, k in zip(found, kinds))], ["doc_id", *names])

    schema = "doc_id long, " + ", ".join(f"{n} {'boolean' if k == pa.bool_() else 'long'}" for n, k in zip(names, kinds))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes()).mapInArrow(run, schema)
