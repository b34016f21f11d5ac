"""Main text by aligned wrappers: what the alignment decides, awkward pages, and brute force."""

import re
import time
from html.parser import HTMLParser

import pytest

from dispatchlens.llm import html
from dispatchlens.llm.queries import op5_html

SCHEMA = "page_id long, url string, html string"


def extracted(spark, pages, parts=3):
    rows = [(i, url, text) for i, (url, text) in enumerate(pages)]
    got = html.extract(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()
    assert len(got) == len(rows)
    return {r["page_id"]: r["text"] for r in got}


def story(i, extra=""):
    """A page whose boxes around and inside the article have classes that no list names."""
    return ("http://a.example/%d" % i, f"<html><body><div class=q9>All about our firm</div><div class=w><article><h2>Summary</h2><p>Story {i} of many</p>{extra}<div class=x7>Write to us</div>"
            f"<h2>Sources</h2><ul><li>The same paper</li></ul></article></div><div class=zz>Bottom {i % 1}</div></body></html>")


def test_headings_and_lists_that_every_article_has_stay(spark):
    got = extracted(spark, [story(i) for i in range(6)])
    assert all(got[i] == f"Summary\nStory {i} of many\nSources\nThe same paper" for i in range(6))


def test_optional_and_repeated_groups_of_an_article_stay(spark):
    note = "<div class=n><p>Note one</p></div><div class=n><p>Note two</p></div>"
    got = extracted(spark, [story(i, note if i % 3 == 0 else "") for i in range(9)])
    assert got[0] == "Summary\nStory 0 of many\nNote one\nNote two\nSources\nThe same paper" and got[1] == "Summary\nStory 1 of many\nSources\nThe same paper"


def test_the_alignment_decides(spark, monkeypatch):
    """Without article or main the container is where slots are; only aligned pages tell slots from long constant texts."""
    def page(i):
        return ("http://c.example/%d" % i, f"<body><div class=a1>{'A long text that stands on all pages. ' * 5}</div><div class=b2><p>Own text {i}</p><p>More {i * 7}</p></div><div class=c3>end</div></body>")

    pages = [page(i) for i in range(5)]
    got = extracted(spark, pages)
    assert all(got[i] == f"Own text {i}\nMore {i * 7}" for i in range(5))
    # one page alone takes its longest box for the main text
    alone = extracted(spark, pages[:1])
    assert alone[0].startswith("A long text") and "Own text" not in alone[0]  # the longest box, as far as one page tells
    first, second = (html.folded(p) for _, p in pages[:2])
    assert html.rule_of(html.aligned(first, second)) != html.rule_of(first)


def test_rounds_of_alignment_change_nothing(spark, monkeypatch):
    pages = [story(i, "<div class=o>Odd</div>" if i % 2 else "") for i in range(23)] + [("http://b.example/", story(1)[1])]
    whole = extracted(spark, pages)
    monkeypatch.setattr(html, "ALIGNED", 3)
    assert extracted(spark, pages, 5) == whole
    assert whole[23] == "Summary\nStory 1 of many\nWrite to us\nSources\nThe same paper"  # too few pages of that host to call a box constant


@pytest.mark.parametrize("page", ["<a '" * 250_000, '<div class="x>' + "<p>abc" * 160_000, "<p title='" + "a<b " * 250_000, "<" * 1_000_000, "<!--" * 250_000, "<div " * 200_000])
def test_long_broken_pages_are_read_in_one_go(page):
    start = time.monotonic()
    html.main_text(page, None)
    assert time.monotonic() - start < 10  # under a second; minutes if every tag read to the end


def test_awkward_pages(spark):
    pages = [(None, None), ("x", ""), ("http://d.example/1", "plain words"), ("http://d.example/2", "<p>cut &am"), ("http://d.example/2", "<p>cut &am"),
             ("http://d.example/3", "<article></article>"), ("http://d.example/4", "<nav>menu</nav>"), ("http://d.example/5", "a<!-- b --> &lt;c&gt; <b>d</b><script>e</script>")]
    got = extracted(spark, pages)
    assert [got[i] for i in range(8)] == ["", "", "plain words", "cut &am", "cut &am", "", "", "a <c> d"]


class Article(HTMLParser):
    """The text of article elements, block by block, without adverts, menus and scripts."""
    VOID, INLINE, OUT = set("br img meta link".split()), set("a b i em span".split()), set("nav footer script style ad".split())

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.blocks, self.now = [], [], []

    def flushed(self):
        text = re.sub(r"\s+", " ", "".join(self.now)).strip()
        self.now = []
        if text:
            self.blocks.append(text)

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.now.append(" ")
        if tag in self.VOID | self.INLINE:
            return
        self.flushed()
        if tag == "p" and self.open[-1:] == ["p"]:
            self.open.pop()
        self.open.append("ad" if dict(attrs).get("class") == "ad" else tag)

    def handle_endtag(self, tag):
        if tag in self.VOID | self.INLINE:
            return
        self.flushed()
        name = tag if tag in self.open else "ad"
        if name in self.open:
            while self.open.pop() != name:
                pass

    def handle_data(self, data):
        if "article" in self.open and not self.OUT & set(self.open):
            self.now.append(data)


def test_query_matches_brute_force(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    got = {(r["page_id"], r["url"]): r for r in op5_html(spark, sf_dir).collect()}
    assert len(pages) == len(got) > 0
    for p in pages:
        reader = Article()
        reader.feed(p["html"] or "")
        reader.close()
        reader.flushed()
        r = got[p["page_id"], p["url"]]
        assert r["text"] == "\n".join(reader.blocks) and r["n_chars"] == len(r["text"])
