"""Main text of web pages from flat text blocks and a decision tree.

A page is read as a flat list of text blocks; every block-level tag ends one.
A block is described by its words and link density, those of the blocks
before and after, and the places it stands in (a navigation, footer or form
element, a container whose class or role says so, an article). A decision
tree trained on the small labelled table below says which blocks are main text.

Defined results: a null or empty page has no text; unclosed elements, cut-off
tags and stray ends are read as far as they go; texts are never cut; rows that
repeat stay separate; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# a comment, an element of raw text, a tag, a declaration, or a tag cut off by the end of the page
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|title|textarea|xmp)(?=[\s/>])[^>]*+>.*?(?:</\1\s*>|\Z)"
    # quotes hold a value only right after an equals sign
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)*+)>"
    r"|<[!?][^>]*+>"
    r"|<[a-zA-Z/!?][^>]*+(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s/=>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?+")
NAMED = frozenset(("class", "id", "role", "hidden", "aria-hidden"))
TOKEN = re.compile(r"[a-z]+")

INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("head script style noscript template svg math iframe object select textarea button canvas audio video".split())
ASIDE_TAGS = frozenset("nav footer aside form menu dialog".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu toolbar".split())
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement adbox advertorial banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright disclaimer discussion disqus footer gdpr hidden legal login masthead menu modal nav navbar navigation "
    "newsletter notice pagination popup promo related replies reply respond share sharing sidebar signup social "
    "sponsor sponsored subscribe toc toolbar topbar widget".split()
)
# names with one of these say how a page is laid out, not what the element is
STATE_WORDS = frozenset("active allowed closed disabled enabled has hide no off on open show with without".split())
# whole names of a wrapper around an article and what stands beside it
WRAPPERS = frozenset(("layout", "page"))
# words that within an article may name one of its sections
SUBJECTS = frozenset("copyright disclaimer discussion legal login menu reply respond signup social subscribe".split())
# words that only say which part of a page or which kind of box a name means
PARTS = frozenset(
    "area article bar block bottom box button buttons center column container content entry feed fixed floating form "
    "group holder inline inner item items left link links list main middle page panel post posts rail region right "
    "section side site slot space sticky story strip tags thread top unit wrap wrapper zone".split()
)
ARTICLE_TAGS = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
# an opening tag of the key ends an open one of the same group, unless a tag of the value is in between
SIBLINGS = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "option": ()}

FEATURES = ("words", "links", "words before", "links before", "words after", "links after", "aside tag", "aside name", "in article", "heading")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    aside_tag: bool
    aside_name: bool
    in_article: bool
    heading: bool


@dataclass(frozen=True)
class _Open:
    """An open element with what it inherits."""

    tag: str
    dropped: bool = False
    link: bool = False
    aside_tag: bool = False
    aside_name: bool = False
    article: bool = False
    heading: bool = False


@lru_cache(maxsize=1 << 14)
def _names_aside(value: str, in_article: bool, section: bool) -> bool:
    """Whether a class or id names an aside.

    Outside an article a name counts that begins or ends with a word for asides. Within one all
    its words must be of asides or of boxes, as related-work or comment-free may be its text, and
    the name of a section must not be a subject.
    """
    names = value.split()
    if not WRAPPERS.isdisjoint(names):
        return False
    for name in names:
        parts = [part for part in TOKEN.findall(name) if len(part) > 1]
        if not parts or not STATE_WORDS.isdisjoint(parts):
            continue
        if not in_article:
            if parts[0] in ASIDE_WORDS or parts[-1] in ASIDE_WORDS:
                return True
        elif ASIDE_WORDS.issuperset(set(parts) - PARTS):
            found = ASIDE_WORDS.intersection(parts)
            if found and not (section and found <= SUBJECTS):
                return True
    return False


def _opened(tag: str, attributes: str, outer: _Open) -> _Open:
    aside_name = False
    if "=" in attributes or "hidden" in attributes.lower():
        for name, *values in ATTRIBUTE.findall(attributes):
            name = name.lower()
            if name not in NAMED:
                continue
            value = unescape("".join(values)).lower().strip()
            if name in ("class", "id"):
                # an id is an anchor of a section, and so may be its heading's words
                section = tag == "section" or tag in HEADINGS or name == "id"
                aside_name |= tag not in ("html", "body") and _names_aside(value, outer.article, section)
            elif name == "role":
                aside_name |= value in ASIDE_ROLES
            else:
                aside_name |= value != "false" and (name == "hidden" or value == "true")
    aside = tag in ASIDE_TAGS or (tag == "header" and not outer.article)
    plain = not (aside or aside_name) and tag not in DROPPED and tag not in ARTICLE_TAGS and tag not in HEADINGS and tag != "a"
    if plain:
        return _Open(tag, *_flags(outer))
    return _Open(
        tag,
        outer.dropped or tag in DROPPED,
        outer.link or tag == "a",
        outer.aside_tag or aside,
        # an article within a marked wrapper is no aside, one within an article may be
        aside_name or (outer.aside_name and (tag not in ARTICLE_TAGS or outer.article)),
        outer.article or tag in ARTICLE_TAGS,
        outer.heading or tag in HEADINGS,
    )


def _flags(element: _Open) -> tuple[bool, ...]:
    return element.dropped, element.link, element.aside_tag, element.aside_name, element.article, element.heading


def blocks(html: str) -> list[Block]:
    """The text blocks of a page, in order, without those of dropped elements."""
    found: list[Block] = []
    stack = [_Open("")]
    pieces: list[str] = []
    linked = 0
    place: _Open | None = None

    def close() -> None:
        nonlocal linked, place
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text and place is not None:
                words = text.count(" ") + 1
                found.append(Block(text, words, min(linked, words), place.aside_tag, place.aside_name, place.article, place.heading))
            pieces.clear()
        linked, place = 0, None

    def add(text: str) -> None:
        nonlocal linked, place
        top = stack[-1]
        if top.dropped:
            return
        pieces.append(text)
        if not text.isspace():
            if top.link:
                linked += len(text.split())
            # a block stands where its first text outside inline elements stands
            if place is None:
                place = top

    def leave(tag: str, until: tuple[str, ...] = ()) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag == tag:
                del stack[depth:]
                return
            if stack[depth].tag in until:
                return

    at = 0
    for match in MARKUP.finditer(html):
        start, end = match.span()
        if start > at:
            add(html[at:start])
        at = end
        tag = match[3]
        if tag is None:
            if match[1] and match[1].lower() == "textarea":
                close()
            continue
        tag = tag.lower()
        inline = tag in INLINE
        if not inline:
            close()
        if match[2]:
            leave(tag)
        else:
            if not inline:
                leave("p", ("article", "section", "div", "td", "table", "li", "blockquote", "aside", "nav", "form", "body"))
                if tag in SIBLINGS:
                    leave(tag, SIBLINGS[tag])
            if tag in VOID:
                if inline:
                    pieces.append(" ")
            elif not match[4].endswith("/") or tag not in ("path", "svg"):
                stack.append(_opened(tag, match[4], stack[-1]))
    if at < len(html):
        add(html[at:])
    close()
    return found


def feature_rows(found: list[Block]) -> np.ndarray:
    """One row of ``FEATURES`` per block; outside the page stand blocks of no words."""
    n = len(found)
    words = np.zeros(n + 2)
    links = np.zeros(n + 2)
    for i, b in enumerate(found, 1):
        words[i], links[i] = b.words, b.linked / b.words
    places = np.array([(b.aside_tag, b.aside_name, b.in_article, b.heading) for b in found], float).reshape(n, 4)
    near = np.stack([words[1:-1], links[1:-1], words[:-2], links[:-2], words[2:], links[2:]], axis=1)
    return np.concatenate([near, places], axis=1)


@dataclass
class Node:
    """A split (``feature`` at most ``limit`` goes left), or a leaf with its label."""

    label: bool
    feature: int = -1
    limit: float = 0.0
    left: Node | None = None
    right: Node | None = None


def grow_tree(x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 1) -> Node:
    """A classification tree by Gini impurity; between equal splits the first feature, the lowest limit."""
    node = Node(bool(y.mean() >= 0.5))
    if depth == 0 or y.min() == y.max():
        return node

    def impurity(part: np.ndarray) -> float:
        share = part.mean()
        return len(part) * share * (1 - share)

    best, own = None, impurity(y)
    for feature in range(x.shape[1]):
        values = np.unique(x[:, feature])
        for limit in (values[1:] + values[:-1]) / 2:
            left = x[:, feature] <= limit
            if min(left.sum(), (~left).sum()) < least:
                continue
            gain = own - impurity(y[left]) - impurity(y[~left])
            if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                best = gain, feature, limit, left
    if best is None:
        return node
    _, node.feature, node.limit, left = best
    node.left = grow_tree(x[left], y[left], depth - 1, least)
    node.right = grow_tree(x[~left], y[~left], depth - 1, least)
    return node


def classify(node: Node, x: np.ndarray) -> np.ndarray:
    if node.left is None or node.right is None:
        return np.full(len(x), node.label)
    out = np.empty(len(x), bool)
    left = x[:, node.feature] <= node.limit
    out[left], out[~left] = classify(node.left, x[left]), classify(node.right, x[~left])
    return out


def _filled(label: str, n: int) -> str:
    return " ".join([label, *["word"] * (n - 1)])


def labelled_pages() -> list[str]:
    """The labelled table: small pages whose blocks begin with their label, ``main`` or ``side``."""

    def p(n: int, tag: str = "p", attributes: str = "") -> str:
        return f"<{tag}{attributes}>{_filled('main', n)}</{tag}>"

    def side(n: int, tag: str = "p", attributes: str = "") -> str:
        return f"<{tag}{attributes}>{_filled('side', n)}</{tag}>"

    def menu(n: int, words: int = 1) -> str:
        return "<ul>" + "".join(f"<li><a href='#'>{_filled('side', words)}</a></li>" for _ in range(n)) + "</ul>"

    def linked(n: int) -> str:
        return f"<a href='#'>{_filled('main', n)}</a>"

    ad = side(9, "div", ' class="ad"')
    pages = [
        # an article between a menu and a footer, with short and long paragraphs
        f"<nav>{menu(5)}</nav>{ad}<article>{p(7, 'h1')}{p(60)}{p(1)}{p(2)}{p(35)}{p(3)}</article><footer>{side(12)}</footer>",
        f"<nav>{menu(3, 2)}</nav><main>{p(4, 'h1')}{p(1)}{p(90)}{p(5, 'li')}{p(2, 'li')}{p(40)}</main><footer>{side(40)}</footer>",
        f"<header>{side(5, 'h1')}{side(14)}</header><article>{p(3, 'h2')}{p(25)}{p(12, 'td')}{p(1)}</article><aside>{side(30)}{menu(4, 4)}</aside>",
        # adverts, notices, forms and comments inside an article
        f"<article>{p(6, 'h1')}{p(50)}{ad}{p(45)}<form>{side(6)}{side(18)}</form>{p(20)}{side(25, 'section', ' id=comments')}</article>",
        f"<article>{p(3, 'h1')}{p(2)}{side(40, 'div', ' class=comment')}{side(3, 'div', ' class=comment')}{side(2, 'div', ' role=alert')}</article>",
        f"<article>{p(30)}<aside>{side(50)}{side(3, 'h3')}</aside>{p(8)}<nav>{menu(2, 3)}</nav>{p(1)}</article>",
        f"<article>{p(1)}</article><footer>{side(1)}</footer><nav>{side(3)}</nav>{ad}",
        # the last words of an article before a menu
        f"<article>{p(4, 'h1')}{p(28)}{p(3)}</article><nav>{menu(6, 2)}</nav>",
        f"<main>{p(35)}{p(2)}</main><div>{menu(4, 3)}</div><footer>{side(8)}</footer>",
        f"<article>{p(2)}</article><div>{menu(5)}</div>",
        # pages without an article: prose stands out by its words and few links
        f"<div>{menu(6, 2)}</div><div>{p(5, 'h1')}{p(80)}{p(15)}{p(55)}</div><div>{menu(5, 3)}{side(4)}</div>",
        f"<div>{menu(4)}</div><div>{p(4, 'h1')}{p(45)}{p(70)}</div><div>{side(3)}{menu(3, 2)}</div>",
        f"<div>{side(2)}</div><div>{menu(3, 4)}</div><div>{p(30)}{p(120)}{p(18)}</div><div class='footer'>{side(25)}</div>",
        f"<div class='cookie-notice'>{side(35)}</div><div>{p(3, 'h1')}{p(28)}{p(33)}</div><div id='sidebar'>{side(45)}{menu(4, 5)}</div>",
        f"{p(12)}{p(9)}",
        p(3),
        f"<div>{p(5, 'h1')}{p(40)}{p(6)}</div>",
        # wrappers named after what stands beside the article
        f"<body class='has-sidebar comments-open'><div class='no-sidebar'>{p(4, 'h1')}{p(50)}{p(20)}</div></body>",
        f"<div class='sidebar-left'><main>{p(4, 'h1')}{p(40)}{p(12)}</main></div><div class='sidebar'>{side(30)}</div>",
        # links within prose do not make it a menu
        f"<article>{p(2, 'h1')}<p>main word <a>word word</a> word word word word</p>{p(22)}<p>main <a>word word word</a></p></article>",
        # sections of an article whose names also occur beside articles
        f"<article>{p(3, 'h2', ' id=discussion')}{p(30, 'section', ' id=legal')}{p(40, 'div', ' class=related-work')}</article>",
    ]
    # whole links and lists of them inside an article are its text, whatever stands before and after
    links = "<ul>" + "".join(f"<li>{linked(n)}</li>" for n in (1, 2, 4)) + "</ul>"
    for wrapper in ("article", "main"):
        for before in ("", p(1), p(14), p(70), linked(5), links):
            for n in (1, 2, 4, 9, 20, 100):
                pages.append(f"<{wrapper}>{before}{p(n)}</{wrapper}><footer>{side(8)}</footer>")
                pages.append(f"<header>{side(n)}</header><{wrapper}>{before}{p(12)}</{wrapper}><footer>{side(n)}</footer>")
                pages.append(f"<{wrapper}>{p(n)}{before}</{wrapper}><nav>{menu(4, 2)}</nav>")
                pages.append(f"<{wrapper}>{before}<p>{linked(n)}</p>{before}</{wrapper}><div>{menu(3, 2)}</div>")
                pages.append(f"<{wrapper}>{before}{side(n, 'aside')}{before}{side(n, 'div', ' class=comments')}</{wrapper}>")
    # an element that says it stands beside the text does so at any length, with or without an article
    prose = f"<div>{p(4, 'h1')}{p(45)}{p(30)}</div>"
    for n in (1, 3, 7, 15, 40, 90):
        for beside in ("nav", "footer", "aside", "form", "div class=sidebar", "div role=banner"):
            beside = f"<{beside}>{side(n)}{side(2 * n)}</{beside.split()[0]}>"
            pages += [f"{beside}{prose}", f"{prose}{beside}", f"{beside}<article>{p(20)}</article>{beside}"]
    return pages


def train_tree() -> Node:
    rows, labels = [], []
    for page in labelled_pages():
        found = blocks(page)
        rows.append(feature_rows(found))
        labels += [b.text.startswith("main") for b in found]
    return grow_tree(np.concatenate(rows), np.array(labels, float))


def main_text(html: str, tree: Node) -> str:
    found = blocks(html)
    if not found:
        return ""
    chosen = classify(tree, feature_rows(found))
    return "\n\n".join(b.text for b, main in zip(found, chosen) if main)


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of each row of ``pages``."""
    kinds = {name: pages.schema[name].dataType.simpleString() for name in ("page_id", "url")}

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = train_tree()
        for batch in batches:
            texts = [main_text(html.as_py(), tree) for html in batch.column(2)]
            arrays = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "text", "n_chars"])

    picked = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    return picked.mapInArrow(compute, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
