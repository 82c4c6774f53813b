"""Pages whose wrappers are named after what stands beside the article."""

from __future__ import annotations

from html.parser import HTMLParser

import pytest

from tallywatch.llm import html_text

ARTICLE = "<article><h1>Head of it</h1><p>" + "word " * 40 + "</p><p>" + "more " * 30 + "</p></article>"


@pytest.mark.parametrize(
    "wrapper",
    ["body class='has-sidebar'", "body class='no-sidebar'", "body class='comments-open share-enabled'", "html class='sidebar'", "body id=menu",
     "div class='content-sidebar-wrap'", "div class='layout sidebar'", "div class='with-sidebar'"],
)
@pytest.mark.parametrize("inside", [ARTICLE, ARTICLE.replace("article", "main"), ARTICLE.replace("article", "div")])
def test_wrappers(wrapper, inside):
    tree = html_text.train_tree()
    page = f"<{wrapper}>{inside}<div class='sidebar'><p>Other things to see here today</p></div></{wrapper.split()[0]}>"
    assert html_text.main_text(page, tree) == html_text.main_text(inside, tree) != ""


@pytest.mark.parametrize("name", ["ad", "ad-slot", "comment-list", "site-footer", "cookie-notice", "main-nav"])
def test_asides_stay_out(name):
    page = f"{ARTICLE}<div class='{name}'><p>{'side ' * 40}</p></div>"
    assert "side" not in html_text.main_text(page, html_text.train_tree())


LONG = "word " * 100


@pytest.mark.parametrize("wrapper", ["article", "main"])
@pytest.mark.parametrize(
    "inside, text",
    [
        # a last paragraph after a list of links
        (f"<p>First of it</p><ul><li><a href=x>One</a></li><li><a href=y>Two more</a></li></ul><p>{LONG}</p>", ["First of it", "One", "Two more", LONG]),
        # paragraphs that are one link
        (f"<p>{LONG}</p><p><a href=x>All of this is linked</a></p><p>End</p>", [LONG, "All of this is linked", "End"]),
        ("<p><a href=x>Only a link</a></p>", ["Only a link"]),
        # names of sections and of boxes that are not beside the article
        (f"<section id='legal'><p>{LONG}</p></section>", [LONG]),
        (f"<div class='related-work'><p>{LONG}</p></div>", [LONG]),
        (f"<div class='comment-free article-body'><p>{LONG}</p></div>", [LONG]),
        (f"<h2 id=discussion>Discussion</h2><p data-id=ad data-class='menu'>{LONG}</p>", ["Discussion", LONG]),
        # quotes that hold no value, and values that look like markup
        ("<p title=it's>First one</p><p>Second one</p><p title=that's>Third</p>", ["First one", "Second one", "Third"]),
        ("<p title='a > b class=ad' data-x=\"it's\">Kept</p><p title=\"hidden\">Too</p>", ["Kept", "Too"]),
        ("<p title = \"x\" lang=en/>Kept</p><p a\"b>Also</p><a href=?q=\"x>y</a>", ["Kept", "Also", "y"]),
        # what is beside the text
        (f"<p>{LONG}</p><div class='comment-list'>Reader says</div><div class='ad-slot-2'>Buy</div><div class='post-share'>Share</div>", [LONG]),
        (f"<p>{LONG}</p><aside>Aside</aside><form>Name</form><div CLASS='Ad'>Buy</div><p HIDDEN>Not seen</p>", [LONG]),
    ],
)
def test_texts_within_an_article(wrapper, inside, text):
    page = f"<nav><a href=/>Home</a></nav><{wrapper}>{inside}</{wrapper}><footer>Imprint</footer>"
    assert html_text.main_text(page, html_text.train_tree()) == "\n\n".join(t.strip() for t in text)


def test_an_element_named_like_raw_text():
    page = "<article><title-bar>Shown</title-bar><p>Text of it</p></article><title>Not shown</title>"
    assert html_text.main_text(page, html_text.train_tree()) == "Shown\n\nText of it"


def test_many_blocks_and_clashing_columns(spark):
    many = "<article>" + "<p>some words</p>" * 20_000 + "</article>"
    frame = spark.createDataFrame(
        [(1, "u", many, 5, "x"), (1, "u", many, 6, "y"), (None, None, None, None, None)],
        "page_id long, url string, html string, n_chars int, text string",
    )
    rows = html_text.extract_pages(frame).collect()
    assert sorted((r.page_id or 0, r.text.count("\n\n"), r.n_chars) for r in rows) == [(0, 0, 0), (1, 19_999, 239_998), (1, 19_999, 239_998)]


class _Reader(HTMLParser):
    """Blocks under article or main, outside elements that stand beside the text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.found, self.held = [], [], []

    def cut(self):
        text = " ".join("".join(self.held).split())
        if text:
            self.found.append(text)
        self.held = []

    def handle_starttag(self, tag, attrs):
        if tag not in html_text.INLINE:
            self.cut()
        beside = tag in ("nav", "footer", "aside", "form", "script", "style") or dict(attrs).get("class") in ("ad", "comment", "comments", "sidebar")
        if tag not in html_text.VOID:
            self.open.append((tag, beside))

    def handle_endtag(self, tag):
        if tag not in html_text.INLINE:
            self.cut()
        tags = [t for t, _ in self.open]
        if tag in tags:
            del self.open[len(tags) - 1 - tags[::-1].index(tag):]

    def handle_data(self, data):
        if any(t in ("article", "main") for t, _ in self.open) and not any(beside for _, beside in self.open):
            self.held.append(data)


def test_whole_table_against_a_reader(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    wanted = {}
    for row in pages.collect():
        reader = _Reader()
        reader.feed(row.html or "")
        reader.close()
        reader.cut()
        wanted[row.page_id] = "\n\n".join(reader.found)
    assert any(wanted.values())
    assert {r.page_id: r.text for r in html_text.extract_pages(pages).collect()} == wanted
