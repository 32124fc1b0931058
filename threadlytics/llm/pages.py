"""Main text of web pages by the maximum-scoring subsequence of their tokens.

A page is a sequence of tags and words.  Words score positive and tags negative; the weights
come from pages that mark their content.  One linear scan finds the contiguous region of the
highest total; inside it, blocks named as boilerplate are left out, and blocks of links as far as
the marked pages have such blocks outside their content.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import numpy as np

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|iframe|svg)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"""|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*"|'[^']*')*+)>"""
    r"|<[!?][^>]*>",
    re.S | re.I,
)
CLASSES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
SPLIT = re.compile(r"[\s_-]+")
# Fixed lists of HTML: elements without an end, elements that break a line, elements of a page's frame.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol option p pre section select summary table "
    "tbody td tfoot th thead title tr ul".split()
)
FRAME = set("head title nav header footer aside form button select option textarea dialog menu label fieldset".split())
# Words in a class, id or role that name something beside the article.
ASIDE = set(
    "ad ads advert advertisement advertisements adverts banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies footer header login masthead menu nav navbar navigation newsletter notice notices pagination "
    "popup promo promoted promotion related share sharing sidebar signup social sponsor sponsored subscribe toolbar "
    "widget".split()
)
# Elements that hold blocks; p, li, headings and cells count as text of the element around them.
CONTAINERS = (BLOCK | FRAME) - set("caption center dd dt figcaption h1 h2 h3 h4 h5 h6 hr li p pre summary tbody td tfoot th thead tr".split())
CONTENT = ("article", "main")
INSIDE, OUTSIDE = 1.0, 0.0  # words that do not count for a region are not part of its text either
PLAIN = -0.2  # a tag that content has too
LINKS = 3  # fewer links are no menu


class Place:
    """An element that holds text of its own: whether its name tells boilerplate, its words and links."""

    __slots__ = ("named", "words", "linked", "links")

    def __init__(self, named: bool):
        self.named = named
        self.words = self.linked = self.links = 0

    def share(self) -> int:
        """Tenths of the words that are links; 0 if it has few links."""
        return 10 * self.linked // self.words if self.links >= LINKS and self.words else 0


class OpenElements:
    """The elements that are open at a spot, each with the place that text in it belongs to.

    Elements are also kept by name, so that finding what an end tag closes does not depend on how many
    elements are open.
    """

    def __init__(self):
        self.names: list[str] = []
        self.places: list[Place] = []
        self.at: dict[str, list[int]] = {}
        self.blocks: list[int] = []  # block elements other than p
        self.top = Place(False)
        self.in_link = False
        self.content_seen = False

    def place(self) -> Place:
        return self.places[-1] if self.places else self.top

    def named(self, name: str, attrs: str) -> bool | None:
        """Whether an element is boilerplate by its name, class, id or role; None if it is no place of its own.

        Inline elements are part of the text around them, whatever their class.  The first article or
        main element of a page is content wherever it stands, and a header inside it belongs to it.
        """
        if name in CONTENT and not self.content_seen:
            self.content_seen = True
            return False
        if name not in BLOCK and name not in FRAME:
            return None
        words = set()
        if "=" in attrs and name not in ("html", "body"):
            for m in CLASSES.finditer(attrs):
                words.update(SPLIT.split((m[1] or m[2] or m[3] or "").lower()))
        aside, frame = words & ASIDE, name in FRAME
        if any(self.at.get(c) for c in CONTENT):
            aside, frame = aside - {"header"}, frame and name != "header"
        if aside or frame or self.place().named:
            return True
        return False if name in CONTAINERS else None

    def start(self, name: str, attrs: str) -> None:
        if name == "p" and self.at.get("p") and (not self.blocks or self.blocks[-1] < self.at["p"][-1]):
            self.end("p")
        if name in VOID or attrs.endswith("/"):
            return
        named = self.named(name, attrs)
        place = self.place() if named is None else Place(named)
        if name == "a":
            self.in_link = True
            place.links += 1
        elif named is not None:
            self.in_link = False
        spot = len(self.names)
        self.places.append(place)
        self.names.append(name)
        self.at.setdefault(name, []).append(spot)
        if name in BLOCK and name != "p":
            self.blocks.append(spot)

    def end(self, name: str) -> None:
        """Close the last open element of the name and all that are open inside it; none, if there is none."""
        if name == "a" or name in CONTAINERS:
            self.in_link = False
        if not self.at.get(name):
            return
        for spot in range(len(self.names) - 1, self.at[name][-1] - 1, -1):
            self.at[self.names.pop()].pop()
            self.places.pop()
            if self.blocks and self.blocks[-1] == spot:
                self.blocks.pop()


def tokens(page: str) -> list[tuple[str | None, Place, str | None]]:
    """(tag, place, text) in order: tags as 'name' or '/name' with text None; else text between tags.

    The counts of a place are whole once all tokens are read.
    """
    opened = OpenElements()
    found = []

    def add(text: str) -> None:
        place, n = opened.place(), len(text.split())
        place.words += n
        place.linked += n * opened.in_link
        found.append((None, place, text))

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if not (name := m["name"]):
            continue
        name = name.lower()
        if m["close"]:
            opened.end(name)
        else:
            opened.start(name, m["attrs"])
        found.append((m["close"] + name, opened.place(), None))
    if at < len(page):
        add(page[at:])
    return found


class Weights:
    """Scores of tags, and of words by the share of links in their place.

    ``counts`` gives (words or tags inside, outside) of marked content.  Before any are seen, places
    of links for the most part are held for menus, and all others for content.
    """

    def __init__(self, counts: dict[tuple[str, str], tuple[int, int]]):
        self.tags = {}
        self.shares = [INSIDE if tenth < 6 else OUTSIDE for tenth in range(11)]
        for (kind, name), (inside, outside) in counts.items():
            odds = float(np.log((inside + 0.5) / (outside + 0.5)))
            if kind == "tag":
                self.tags[name] = PLAIN if inside >= 0.02 * outside else max(-9.0, odds)
            elif int(name) and inside + outside >= 50:
                self.shares[int(name)] = INSIDE if odds > 0 else OUTSIDE

    def tag(self, name: str) -> float:
        return self.tags.get(name, PLAIN)

    def word(self, place: Place) -> float:
        return OUTSIDE if place.named else self.shares[place.share()]


def count_page(page: str) -> Counter:
    """(kind, name, inside) counts of a page that marks its content by one article or main element."""
    counts: Counter = Counter()
    inside = False
    for tag, place, text in tokens(page):
        if tag in CONTENT:
            counts["tag", tag, False] += 1
            inside = True
        elif tag and tag[1:] in CONTENT:
            inside = False
            counts["tag", tag, False] += 1
        elif tag:
            counts["tag", tag, inside] += 1
        else:
            counts["share", str(place.share()), inside] += len(text.split())
    return counts


def train(pages: DataFrame, sample: int = 2000) -> Weights:
    """Weights from the pages with the ``sample`` smallest hashes of their page_id that hold exactly
    one whole article or main element: what is inside it is content, the rest is not."""
    ids = pages.select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
    chosen = pages.select("page_id", "html").join(F.broadcast(ids.distinct()), "page_id", "left_semi")

    def run(batches):
        sums: Counter = Counter()
        for batch in batches:
            for page in batch.column(1).to_pylist():
                low = (page or "").lower()
                if [low.count(f"<{c}") for c in CONTENT] in ([1, 0], [0, 1]) and any(f"</{c}" in low for c in CONTENT):
                    sums.update(count_page(page))
        rows = [(*k, n) for k, n in sums.items()]
        kind, name, inside, n = zip(*rows) if rows else ((),) * 4
        yield pa.record_batch(
            [pa.array(kind, pa.string()), pa.array(name, pa.string()), pa.array(inside, pa.bool_()), pa.array(n, pa.int64())],
            ["kind", "name", "inside", "n"],
        )

    summed = chosen.mapInArrow(run, "kind string, name string, inside boolean, n long").groupBy("kind", "name").agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)), F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n")))
    )
    return Weights({(k, n): (a, b) for k, n, a, b in summed.collect()})


def region(scores: list[float]) -> tuple[int, int]:
    """[start, end) of the contiguous run of the highest sum; empty if no score is positive."""
    best, start, end = 0.0, 0, 0
    total, begin = 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += s
        if total > best:
            best, start, end = total, begin, i + 1
    return start, end


def main_text(page: str | None, weights: Weights) -> str:
    """Blocks of the best region in page order, one a line, white space inside a block as one space."""
    if not page:
        return ""
    found = tokens(page)
    scores = [weights.tag(t) if t else weights.word(place) * len(x.split()) for t, place, x in found]
    start, end = region(scores)
    blocks, line = [], []
    for tag, place, text in found[start:end]:
        if tag:
            if tag.lstrip("/") in BLOCK:
                blocks.append("".join(line))
                line = []
            elif tag == "br":
                line.append(" ")
        elif weights.word(place) > 0:
            line.append(html.unescape(text))
    blocks.append("".join(line))
    return "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def extract(pages: DataFrame, weights: Weights) -> DataFrame:
    """(page_id, url, text) of every row; null, empty and contentless pages have an empty text."""

    def run(batches):
        for batch in batches:
            texts = [main_text(p, weights) for p in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html").mapInArrow(run, "page_id long, url string, text string")
