"""Token ids by a public tokenizer file, with repeated words looked up instead of encoded again."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Letters of Latin-1, then punctuation: such a word is one letter run and at most one run of
# marks to a tokenizer that separates letters from marks.  An apostrophe may start an ending.
SIMPLE = "^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[!-&(-/:-@\\[-`{-~]*)$"


class WordEncoder:
    """Ids of whole texts by a word-end BPE file (lower case, white space dropped).

    White space never lies inside a token of such a file, so a text's ids are those of its
    words in order.  The words of a group of texts are made distinct and cut into runs, and runs
    met before are looked up; the table is emptied at ``most`` entries, which bounds memory and
    changes no result.
    """

    def __init__(self, path: str, most: int = 800_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.most = most
        self.runs: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, runs: list[str]) -> list[bytes]:
        """Encode single runs many at a time: each ends with its only word-end token."""
        found = []
        groups = [runs[i : i + 500] for i in range(0, len(runs), 500)]
        for group, ids in zip(groups, self._encode([" ".join(g) for g in groups])):
            ids = np.array(ids, "<u4")
            bounds = np.flatnonzero(self.ends[ids]) + 1
            if len(bounds) != len(group):
                raise ValueError("a word-end tokenizer file is needed")
            raw, start = ids.tobytes(), 0
            for end in (4 * bounds).tolist():
                found.append(raw[start:end])
                start = end
        if len(self.runs) + len(runs) > self.most:
            self.runs.clear()
        self.runs.update(zip(runs, found))
        return found

    def _ids_of_runs(self, runs: pa.Array) -> list[bytes]:
        """Ids of each run; an empty one has none."""
        distinct = runs.dictionary_encode()
        names = distinct.dictionary.to_pylist()
        known = [self.runs.get(n) if n else b"" for n in names]
        if new := [i for i, ids in enumerate(known) if ids is None]:
            for i, ids in zip(new, self._learn([names[i] for i in new])):
                known[i] = ids
        return list(map(known.__getitem__, distinct.indices.to_pylist()))

    def _ids_of_words(self, words: pa.Array) -> list[bytes]:
        cut = pc.extract_regex(words, SIMPLE)
        ids = [b""] * len(words)
        simple = cut.is_valid()
        parts = cut.filter(simple)
        letters, marks = (self._ids_of_runs(r) for r in (pc.utf8_lower(parts.field("letters")), parts.field("marks")))
        for at, a, b in zip(pc.indices_nonzero(simple).to_pylist(), letters, marks):
            ids[at] = a + b
        hard = pc.invert(simple)
        texts = [w.decode("utf-8", "replace") for w in words.filter(hard).view(pa.large_binary()).to_pylist()]
        for at, found in zip(pc.indices_nonzero(hard).to_pylist(), self._encode(texts)):
            ids[at] = np.array(found, "<u4").tobytes()
        return ids

    def encode_batch(self, texts: pa.Array, group: int = 4000):
        """Yield the ids of each text, as little-endian unsigned 32-bit numbers.

        ``texts`` are binary, without nulls; white space are the six characters of ASCII.
        """
        for at in range(0, len(texts), group):
            split = pc.ascii_split_whitespace(texts.slice(at, group).cast(pa.large_binary()).view(pa.large_string()))
            met = split.flatten().dictionary_encode()
            words = self._ids_of_words(met.dictionary)
            ends = np.cumsum([0, *map(len, words)]) // 4
            table = pa.LargeListArray.from_arrays(ends, np.frombuffer(b"".join(words), "<u4"))
            found = table.take(met.indices)
            starts = split.offsets.to_numpy()
            bounds = found.offsets.to_numpy()[starts - starts[0]].tolist()
            ids = found.values.to_numpy()
            for start, end in zip(bounds, bounds[1:]):
                yield ids[start:end]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder_of(path: str) -> WordEncoder:
    """The encoder of this worker process: tasks that follow one another find its words known."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
