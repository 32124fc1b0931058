"""Main texts against another parser, and what is left out inside a region."""

from collections import Counter
from html.parser import HTMLParser

import pytest
from threadlytics.llm import pages

GIVEN = "/root/testdata/sf0.01"


class Marked(HTMLParser):
    """Words between the start and the end of the article element of a page."""

    def __init__(self, page):
        super().__init__()
        self.inside, self.parts = False, []
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.inside = self.inside or tag == "article"
        self.parts.append(" ")

    def handle_endtag(self, tag):
        self.inside = self.inside and tag != "article"
        self.parts.append(" ")

    def handle_data(self, data):
        if self.inside:
            self.parts.append(data)

    @property
    def words(self):
        return "".join(self.parts).split()


def test_held_out_words(spark):
    """Trained on the pages of odd ids: word F1 on the others, whose article element is taken out of the markup."""
    rows = spark.read.parquet(f"{GIVEN}/pages.parquet")
    weights = pages.train(rows.where("page_id % 2 = 1"))
    hit = told = real = 0
    for r in rows.where("page_id % 2 = 0 and html is not null").collect():
        truth = Marked(r.html).words
        bare = r.html.replace("<article>", "<div>").replace("</article>", "</div>")
        for got in (pages.main_text(r.html, weights), pages.main_text(bare, weights)):
            got = Counter(got.replace("\n", " ").split())
            hit += sum((got & Counter(truth)).values())
            told += sum(got.values())
            real += len(truth)
    assert 2 * hit / (told + real) > 0.99


@pytest.mark.parametrize("page, text", [
    ("<article><header><h1>Title</h1></header><p>one two</article>", "Title\none two"),
    ("<body><header><h1>Site</h1></header><article><p>one two</p></article>", "one two"),
    ('<p>a <span class="share">word</span> and <a class="related-link">see</a> this', "a word and see this"),
    ("<p>one <a href=x>only link</a>", "one only link"),
    ('<p>text before<div class="site-links"><a>home</a> <a>about us</a> | <a>jobs</a></div><p>text after', "text before\ntext after"),
    ("<p>words<ul><li><a>one</a> is long for what it is<li><a>two</a> is so too<li><a>three</a> and more", "words\none is long for what it is\ntwo is so too\nthree and more"),
    ('<body class="has-sidebar cookies"><p>one two</p></body>', "one two"),
    ('<main class="with-sidebar"><p>one two</p></main>', "one two"),
    ('<div class="comments"><section><p>first!</p></section></div><article><p>one two</p></article>', "one two"),
    ('<article><p>one two</p></article><article class="comment"><p>first!</p></article>', "one two"),
    ('<article><p>a b c d<p class="advert">buy<p>e f g h</article>', "a b c d\ne f g h"),
    ("<article><p>a b c d<form><label>mail</label><button>go</button></form><p>e f g h</article>", "a b c d\ne f g h"),
    ("<p>see <a href=x>this<p>and that is no link at all", "see this\nand that is no link at all"),
])
def test_left_out(page, text):
    assert pages.main_text(page, pages.Weights({})) == text


def test_shares_are_trained():
    """Blocks of links are kept where marked pages hold them inside their content for the most part."""
    page = "<p>a b c d e<div><a>f</a><a>g</a><a>h</a></div>"
    assert pages.main_text(page, pages.Weights({("share", "10"): (10, 90)})) == "a b c d e"
    assert pages.main_text(page, pages.Weights({("share", "10"): (90, 10)})) == "a b c d e\nfgh"
    assert pages.main_text(page, pages.Weights({("share", "10"): (9, 1)})) == "a b c d e"  # too few words to go by
