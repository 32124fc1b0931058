"""Sum-of-squares online packing of token ids into fixed windows.

Each document goes into the fill level that minimises the sum of squared counts of partially
filled windows, tracked in a level array.  Every task packs its own stream of documents as
they are read, so no row is shuffled and only open windows are held.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlytics.llm.common import text_bytes

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, ids binary"
)
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


class Packer:
    """Windows of ``capacity`` ids; :meth:`add` and :meth:`close` give finished windows.

    A window is a list of pieces (doc, start, ids, tokens of the document).  Documents longer
    than a window first fill whole windows; the rest is placed.  ``levels[h]`` counts the open
    windows with h ids.  Moving a window from h to h + s changes the sum of squares by
    (1 - 2 levels[h]) + (2 levels[h + s] + 1); a new window has no first term, a full one no
    second.  Among equals the fullest level is taken.
    """

    def __init__(self, capacity: int = 4096):
        self.capacity = capacity
        self.levels = np.zeros(capacity + 1, np.int64)
        self.leave = np.full(capacity + 1, np.inf)
        self.leave[0] = 0
        self.join = np.ones(capacity + 1)
        self.join[capacity] = 0
        self.open: dict[int, list[list]] = defaultdict(list)

    def _count(self, level: int, by: int) -> None:
        if 0 < level < self.capacity:
            self.levels[level] += by
            n = self.levels[level]
            self.leave[level] = 1 - 2 * n if n else np.inf
            self.join[level] = 2 * n + 1

    def level_for(self, size: int) -> int:
        cost = self.leave[: self.capacity - size + 1] + self.join[size:]
        return len(cost) - 1 - int(np.argmin(cost[::-1]))

    def add(self, doc, ids: np.ndarray):
        n, c = len(ids), self.capacity
        for start in range(0, n - n % c, c):
            yield [(doc, start, ids[start : start + c], n)]
        if rest := n % c:
            piece = (doc, n - rest, ids[n - rest :], n)
            level = self.level_for(rest)
            window = self.open[level].pop() if level else []
            window.append(piece)
            self._count(level, -1)
            if level + rest == c:
                yield window
            else:
                self.open[level + rest].append(window)
                self._count(level + rest, 1)

    def close(self):
        """End of the stream: the emptiest open windows are poured, cut, into the others' space,
        so that less than one window of padding is left in all."""
        windows = [w for level in sorted(self.open, reverse=True) for w in self.open[level]]
        fill = [sum(len(p[2]) for p in w) for w in windows]
        keep = -(-sum(fill) // self.capacity)
        kept, at = windows[:keep], 0
        for doc, start, ids, n in (p for w in windows[keep:] for p in w):
            while len(ids):
                while fill[at] == self.capacity:
                    at += 1
                room = min(self.capacity - fill[at], len(ids))
                kept[at].append((doc, start, ids[:room], n))
                fill[at] += room
                start, ids = start + room, ids[room:]
        self.open.clear()
        yield from kept


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, eos: int = 2, rows_per_task: int = 2000) -> DataFrame:
    """Pieces of the packed sequences with their ids: see ``SCHEMA``.

    ids are little-endian unsigned 32-bit, ``ids_crc32`` is their CRC-32, ``doc_tokens`` counts a
    document's ids with the closing ``eos``.  A sequence ends where its last piece ends and is
    padded to ``capacity`` by whoever reads it.  Each task leaves less than one window of
    padding; scan splits with fewer rows than ``rows_per_task`` on average are read together.
    Null and empty texts hold only ``eos``.  Repeated rows are packed again, each on its own.
    """

    def run(batches):
        from threadlytics.llm.tokens import encoder_of

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, packer, end = encoder_of(tokenizer), Packer(capacity), np.array([eos], "<u4")
        sequence = TaskContext.get().partitionId() << 33
        rows = []

        def put(window):
            nonlocal sequence
            offset = 0
            for doc, start, ids, n in window:
                raw = ids.tobytes()
                rows.append((doc, start, len(ids), zlib.crc32(raw), n, sequence, offset, raw))
                offset += len(ids)
            sequence += 1

        def batch():
            out = pa.record_batch(
                [pa.array(c, pa.binary() if n == "ids" else pa.int64()) for n, c in zip(NAMES, zip(*rows))], NAMES
            )
            rows.clear()
            return out

        for b in batches:
            for doc, ids in zip(b.column(0).to_pylist(), encoder.encode_batch(b.column(1))):
                for window in packer.add(doc, np.concatenate((ids, end))):
                    put(window)
                if len(rows) >= 2000:
                    yield batch()
        for window in packer.close():
            put(window)
        if rows:
            yield batch()

    tasks = max(1, docs.count() // rows_per_task)
    return docs.select(F.col("doc_id").cast("long"), text_bytes()).coalesce(tasks).mapInArrow(run, SCHEMA)
