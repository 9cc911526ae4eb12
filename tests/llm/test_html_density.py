"""Main text against a plain version of the method, and pages that are broken or odd."""

import math
import re
import time
from html.parser import HTMLParser

import numpy as np
import pytest

from stepweave.llm import html_text


class _Node:
    def __init__(self, tag, parent=None):
        self.tag, self.parent, self.items = tag, parent, []

    def nodes(self):
        yield self
        for item in self.items:
            if isinstance(item, _Node):
                yield from item.nodes()

    def text(self, linked=None):
        """Characters that are not white space, all or those in links."""
        total = 0
        for item in self.items:
            if isinstance(item, _Node):
                total += item.text(True if linked is not None and item.tag == "a" else linked)
            elif linked is None or linked:
                total += len(re.sub(r"\s", "", item))
        return total


class _Parser(HTMLParser):
    """Well-formed pages only."""

    def __init__(self, page):
        super().__init__()
        self.root = self.open = _Node("#root")
        self.feed(page)

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, self.open)
        self.open.items.append(node)
        self.open = node

    def handle_endtag(self, tag):
        self.open = self.open.parent

    def handle_data(self, data):
        self.open.items.append(data)


def plain_densities(page):
    """Composite text density of every node, each from its own subtree."""
    root = _Parser(page).root
    whole, links = root.text(), root.text(False)
    share = links / whole if whole else 0.0
    found = []
    for node in root.nodes():
        size, linked = node.text(), node.text(node.tag == "a" or _in_link(node))
        inner = list(node.nodes())[1:]
        tags, link_tags = max(len(inner), 1), max(sum(n.tag == "a" for n in inner), 1)
        if not size:
            found.append(0.0)
            continue
        base = math.log(size / max(size - linked, 1) * linked + share * size + math.e)
        ratio = size / max(linked, 1) * tags / link_tags
        found.append(size / tags * math.log(ratio) / math.log(max(base, 1.1)))
    return found


def _in_link(node):
    while node.parent is not None:
        node = node.parent
        if node.tag == "a":
            return True
    return False


def random_page(random, depth=0):
    parts = []
    for _ in range(int(random.integers(1, 5))):
        kind = int(random.integers(0, 4 if depth < 4 else 2))
        if kind == 0:
            parts.append("word " * int(random.integers(1, 30)))
        elif kind == 1:
            parts.append(f"<a href='/x'>{'link ' * int(random.integers(1, 4))}</a>")
        else:
            tag = ["div", "section", "span", "b"][int(random.integers(0, 4))]
            parts.append(f"<{tag}>{random_page(random, depth + 1)}</{tag}>")
    return "".join(parts)


def test_densities_like_the_plain_version():
    random = np.random.default_rng(1)
    for _ in range(60):
        page = f"<body>{random_page(random)}</body>"
        assert html_text._Page(page).densities() == pytest.approx(plain_densities(page))


PROSE = "Some words of prose that go on for a while and then stop, as prose does. " * 2


@pytest.mark.parametrize(
    "part",
    [
        "<section class='related-work'><p>{}</p></section>",
        "<div class='legal-analysis'><p>{}</p></div>",
        "<p class='ad hoc'>{}</p>",
        "<div id='form-2'><p>{}</p></div>",
        "<div class='widget hidden-gem'><p>{}</p></div>",
    ],
)
@pytest.mark.parametrize("holder", ["article", "main"])
def test_names_within_an_article_do_not_cut_prose(part, holder):
    blocks = [f"{PROSE}{n}." for n in range(5)]
    inner = "".join(f"<p>{b}</p>" for b in blocks[:3]) + part.format(blocks[3]) + f"<p>{blocks[4]}</p>"
    page = f"<body><nav><a href='/'>home</a></nav><{holder}>{inner}</{holder}><footer>foot</footer></body>"
    assert html_text.main_text(page).split("\n\n") == [" ".join(b.split()) for b in blocks]


@pytest.mark.parametrize(
    "part",
    [
        "<div class='ad'>Buy now</div>",
        "<div class='share'><a href='/s'>Share this text with others</a> or <a href='/t'>there</a></div>",
        "<div class='related'><ul><li><a href='/1'>Another text</a><li><a href='/2'>One more</a></ul></div>",
        "<section class='comments'><p>{}</p></section>",
        "<div id='respond'><p>{}</p></div>",
        "<p class='notice'>Short note</p>",
    ],
)
def test_furniture_within_an_article_is_cut(part):
    blocks = [f"{PROSE}{n}." for n in range(4)]
    inner = "".join(f"<p>{b}</p>" for b in blocks)
    page = f"<body><article><h1>A headline</h1>{inner}{part.format(PROSE)}</article></body>"
    assert html_text.main_text(page).split("\n\n")[1:] == [" ".join(b.split()) for b in blocks]


def test_headers_of_main_and_article_stay():
    for holder in ("main", "article"):
        page = f"<header>site</header><{holder}><header><h1>The headline</h1></header><p>{PROSE}</p></{holder}>"
        assert html_text.main_text(page).split("\n\n") == ["The headline", PROSE.strip()]


@pytest.mark.parametrize(
    "piece", ["<a ", "<a '", '<a "', "<!x ", "<!-- ", "<script ", "</a ", "<", "<a '>", "<a b=\"'\" ", "&lt"]
)
@pytest.mark.parametrize("end", ["", ">", "<p>x</p>"])
def test_a_megabyte_of_broken_markup_takes_seconds(piece, end):
    start = time.perf_counter()
    html_text.main_text(piece * (1_000_000 // len(piece)) + end)
    assert time.perf_counter() - start < 20


def test_comments_and_tags_without_an_end():
    assert html_text.main_text("<p>one</p>two<!-- three <b>four") == "one\n\ntwo"
    assert html_text.main_text("<p>one</p>two<!-- three") == "one\n\ntwo"
    assert html_text.main_text("<p>one</p><!-- x --><p>two</p> <b") == "one\n\ntwo\n\n<b"
