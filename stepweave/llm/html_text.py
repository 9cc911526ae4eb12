"""Main text of web pages by composite text density.

Every DOM node gets its characters per tag, adjusted for the share of link text; a
node's density sum adds its children's densities.  The node with the greatest sum is
the content; the least density on its path to the body is the threshold that other
parts must reach.  Where the content is in an article, the article is whole and the
threshold is the least density from it to the body.  Elements that are furniture (menus,
notices, forms and so on) are left out before and after.  A class or identifier that names
furniture does so outside of the page's articles, but never for what holds the main text;
within an article text that is as dense as the article stays, whatever its name.
Readers' comments are left out wherever they are.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSED_BY_SAME = {
    "li": ("ul", "ol"),
    "dt": ("dl",),
    "dd": ("dl",),
    "tr": ("table",),
    "td": ("tr", "table"),
    "th": ("tr", "table"),
    "option": ("select",),
}
FURNITURE = frozenset(
    "nav header footer aside form script style noscript template iframe object svg canvas "
    "button select textarea dialog menu head title".split()
)
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments commentlist consent cookie cookies copyright disqus footer form header hidden "
    "legal login masthead menu modal nav navbar navigation newsletter notice notices pager "
    "pagination popup promo promotion related replies respond share sharing sidebar signup "
    "social sponsor sponsored subscribe toolbar warning widget".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist replies respond".split())
FURNITURE_ROLES = frozenset(
    "alert banner complementary contentinfo dialog form menu menubar navigation search".split()
)
# These hold the article whatever they are called.
HOLDERS = frozenset(("html", "body", "main", "article"))

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)
    | <[!?][^>]*+>
    | <(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)
      (?P<attributes>(?:[^>"']++|"[^"]*+"|'[^']*+')*+ | [^>]*+)>""",
    re.S | re.X,
)
_MARKS = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_VALUES = re.compile(r"""=\s*(?:"[^"]*"|'[^']*'|[^\s>]+)""")
_HIDDEN_NAME = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)", re.I)
_HIDDEN = re.compile(
    r"""(?:^|\s)aria-hidden\s*=\s*["']?true
    | (?:^|\s)style\s*=\s*(?:"[^"]*?|'[^']*?|[^\s"']*?)display\s*:\s*none""",
    re.I | re.X,
)
_WORDS = re.compile(r"[a-z]+")
# The logarithm's base is kept above 1, which it would be on a page without links.
_LEAST_BASE = 1.1


class _Page:
    """A page's nodes in page order, each with its parent, and its runs of text."""

    def __init__(self, source: str):
        self.tags, self.parents, self.left_out = ["#root"], [0], [False]
        # Nodes that a class or identifier calls furniture, and those it calls comments.
        self._named: set[int] = set()
        self._comments: set[int] = set()
        self.runs: list[tuple[int, int, str]] = []  # node, block, text
        self._open = [0]
        self._read(source)
        self._leave_out_named()

    def _read(self, source: str) -> None:
        at, block, n = 0, 0, len(source)
        # Behind the last end of a tag there is none, however many may begin.
        last = source.rfind(">") + 1
        while at < n:
            token = _TOKEN.search(source, at, last) if at < last else None
            start = token.start() if token else n
            if start > at:
                self.runs.append((self._open[-1], block, source[at:start].split("<!--", 1)[0]))
            if not token:
                break
            at = token.end()
            if at == last and token[0].startswith("<!--") and not token[0].endswith("-->"):
                break  # a comment without an end
            tag = (token["tag"] or "").lower()
            if not tag:
                continue
            block += tag not in INLINE
            if tag == "br":
                self.runs.append((self._open[-1], block, " "))
            if token["end"]:
                self._close(tag)
                continue
            attributes = token["attributes"]
            self._start(tag, attributes)
            if tag in RAW:
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, at)
                self._open.pop()
                at = stop.start() if stop else n

    def _start(self, tag: str, attributes: str) -> None:
        stack = self._open
        if tag in CLOSED_BY_SAME:
            self._close_within(tag, CLOSED_BY_SAME[tag])
        elif tag not in INLINE:
            self._close_within("p", ())
        parent = stack[-1]
        self.tags.append(tag)
        self.parents.append(parent)
        furniture = self._is_furniture(tag, attributes, parent)
        self.left_out.append(self.left_out[parent] or furniture)
        if not furniture and tag not in HOLDERS:
            words = self._name_words(attributes)
            if not FURNITURE_WORDS.isdisjoint(words):
                self._named.add(len(self.tags) - 1)
            if not COMMENT_WORDS.isdisjoint(words):
                self._comments.add(len(self.tags) - 1)
        if tag not in VOID:
            stack.append(len(self.tags) - 1)

    def _close_within(self, tag: str, limits: tuple[str, ...]) -> None:
        """Close the nearest open ``tag`` unless one of ``limits`` is nearer."""
        for i in range(len(self._open) - 1, 0, -1):
            open_tag = self.tags[self._open[i]]
            if open_tag == tag:
                del self._open[i:]
                return
            if open_tag in limits or (not limits and open_tag not in INLINE):
                return

    def _close(self, tag: str) -> None:
        for i in range(len(self._open) - 1, 0, -1):
            open_tag = self.tags[self._open[i]]
            if open_tag == tag:
                del self._open[i:]
                return
            if tag in INLINE and open_tag not in INLINE:
                return

    def _is_furniture(self, tag: str, attributes: str, parent: int) -> bool:
        if tag in HOLDERS:
            return False
        if tag in FURNITURE:
            return tag != "header" or not self._in_article(parent)
        if not attributes or attributes.isspace():
            return False
        if _HIDDEN.search(attributes) or _HIDDEN_NAME.search(_VALUES.sub("=", attributes)):
            return True
        return any(
            name.lower() == "role" and not FURNITURE_ROLES.isdisjoint(_WORDS.findall(value.lower()))
            for name, value in _MARKS.findall(attributes)
        )

    def _name_words(self, attributes: str) -> set[str]:
        return {
            word
            for name, value in _MARKS.findall(attributes)
            if name.lower() != "role"
            for word in _WORDS.findall(value.lower())
        }

    def _leave_out_named(self) -> None:
        """Leave out what has furniture's name, but never what holds the main text.

        That is a node around a main or article element, or, on a page that has none
        elsewhere, one with half or more of the text outside of links.  Within a main or
        article element a node stays if it is as dense; only comments never do.
        """
        if not self._named:
            return
        n = len(self.tags)
        holders, plain, in_link = [0] * n, [0] * n, [False] * n
        holder = [0] * n  # the main or article element that a node lies in
        for i in range(1, n):
            up = self.parents[i]
            in_link[i] = in_link[up] or self.tags[i] == "a"
            holders[i] = self.tags[i] in ("main", "article") and not self.left_out[i]
            holder[i] = up if holders[up] else holder[up]
        for node, _, text in self.runs:
            if not (in_link[node] or self.left_out[node]):
                plain[node] += len("".join(text.split()))
        for i in range(n - 1, 0, -1):
            holders[self.parents[i]] += holders[i]
            plain[self.parents[i]] += plain[i]
        density = self.densities()
        for i in range(1, n):
            up = self.parents[i]
            named = i in self._named and not holders[i]
            if named and not holders[0] and 2 * plain[i] >= plain[0] > 0:
                named = False
            if named and holder[i] and i not in self._comments:
                named = density[i] < density[holder[i]]
            self.left_out[i] = self.left_out[i] or self.left_out[up] or named

    def _in_article(self, node: int) -> bool:
        while node and self.tags[node] not in ("article", "main"):
            node = self.parents[node]
        return bool(node)

    def densities(self) -> list[float]:
        """Each node's composite density; 0 for furniture."""
        n = len(self.tags)
        chars, tags, link_chars, link_tags = ([0] * n for _ in range(4))
        in_link = [False] * n
        for i in range(1, n):
            in_link[i] = in_link[self.parents[i]] or self.tags[i] == "a"
        page_chars = page_links = 0
        for node, _, text in self.runs:
            size = len("".join(text.split()))
            page_chars += size
            page_links += size * in_link[node]
            if not self.left_out[node]:
                chars[node] += size
                link_chars[node] += size * in_link[node]
        for i in range(n - 1, 0, -1):
            if self.left_out[i]:
                continue
            up = self.parents[i]
            chars[up] += chars[i]
            link_chars[up] += link_chars[i]
            tags[up] += tags[i] + 1
            link_tags[up] += link_tags[i] + (self.tags[i] == "a")
        share = page_links / page_chars if page_chars else 0.0
        found = [0.0] * n
        for i in range(n):
            size = chars[i]
            if not size or self.left_out[i]:
                continue
            linked, plain = link_chars[i], size - link_chars[i]
            count = max(tags[i], 1)
            base = math.log(size / max(plain, 1) * linked + share * size + math.e)
            ratio = size / max(linked, 1) * count / max(link_tags[i], 1)
            found[i] = size / count * math.log(ratio) / math.log(max(base, _LEAST_BASE))
        return found

    def content(self) -> list[bool]:
        """For each node, whether it belongs to the main text."""
        density = self.densities()
        n = len(self.tags)
        sums = [0.0] * n
        for i in range(1, n):
            sums[self.parents[i]] += density[i]
        sums = [s or density[i] for i, s in enumerate(sums)]  # a leaf's sum is its own
        best = max(range(n), key=sums.__getitem__)  # of equal ones the first, the outermost
        path = [best]
        while path[-1]:
            path.append(self.parents[path[-1]])
        article = next((i for i in path if self.tags[i] == "article"), None)
        if article is not None:  # it is whole, and others may stand beside it
            best, path = article, path[path.index(article) :]
        least = min(density[i] for i in path)
        body = next((i for i in path if self.tags[i] == "main"), 0)
        roots = {best} | self._others(density, least, body, set(path))
        inside = [False] * n
        for i in range(n):
            inside[i] = not self.left_out[i] and (i in roots or (i > 0 and inside[self.parents[i]]))
        return inside

    def _others(self, density: list[float], least: float, top: int, path: set[int]) -> set[int]:
        """Subtrees beside the path, below ``top``, that are as dense as the threshold."""
        return {
            i
            for i in range(1, len(self.tags))
            if i not in path
            and self.parents[i] in path
            and self.parents[i] >= top
            and self.tags[i] not in INLINE
            and density[i] >= least > 0
        }

    def text(self) -> str:
        inside = self.content()
        blocks: list[str] = []
        last = None
        for node, block, text in self.runs:
            if inside[node]:
                if block != last:
                    blocks.append("")
                    last = block
                blocks[-1] += html.unescape(text)
        whole = (" ".join(block.split()) for block in blocks)
        return "\n\n".join(block for block in whole if block)


def main_text(source: str | None) -> str:
    """The main text of one page; empty if there is none."""
    return _Page(source).text() if source else ""


def extract_main_text(
    pages: DataFrame, ident: str = "page_id", url: str = "url", source: str = "html"
) -> DataFrame:
    """Per page its identifier, address, main text and the text's code points.

    Rows are treated one by one: repeated rows give repeated rows, null or empty pages
    an empty text, and columns other than the three named are ignored, whatever their
    names.  A page of any length is read whole, in time in proportion to it.
    """

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch[2].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch[0],
                    batch[1],
                    pa.array(texts, pa.string()),
                    pa.array([len(text) for text in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    wanted = pages.select(pages[ident].alias("page_id"), pages[url].alias("url"), pages[source])
    kind = wanted.schema["page_id"].dataType.simpleString()
    return wanted.mapInArrow(extract, f"page_id {kind}, url string, text string, n_chars long")
