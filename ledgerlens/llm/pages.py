"""Main text of web pages by tree scoring (operator 12).

A page is read into a tree.  Parts that are not the article by their tag,
role or class names are left out; every text block passes points for its
length and commas to its ancestors, a container's points are discounted by
its link density, and the best container and its fitting siblings are kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm._tables import pick

# Names of HTML, by what they do to the text around them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup p pre search section summary table "
    "tbody tfoot thead title tr ul".split())
#: Elements that may be the article's container; lists, tables and quotes hand points on.
CONTAINERS = frozenset("div section article main body center".split()) | {""}
#: Never part of an article.
LEFT_OUT = frozenset(
    "head title style script noscript template nav footer aside menu form button select option textarea input iframe object "
    "embed applet canvas svg math audio video map dialog".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What a start tag closes, and the tags beyond which it closes nothing.
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr"}, {"table"}), "tfoot": ({"thead", "tbody", "tr"}, {"table"}),
    "option": ({"option"}, {"select"}), "rt": ({"rt", "rp"}, {"ruby"}), "rp": ({"rt", "rp"}, {"ruby"}),
}
ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar status tablist".split())
# Words of class and id names.
UNWANTED = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot adunit sponsor sponsored sponsors promo "
    "promos promotion banner banners nav navbar navigation navi menu menus submenu breadcrumb breadcrumbs masthead topbar "
    "footer foot sidebar sidebars aside widget widgets related recommended recommendations recirc outbrain taboola share "
    "sharing sharebar social comment comments commentlist commentary disqus reply replies respond discussion discuss cookie "
    "cookies consent gdpr ccpa notice notices notification notifications alert alerts popup modal overlay newsletter subscribe "
    "subscription signup login search searchform searchbox pagination pager copyright disclaimer skip hidden".split())
#: The same for inline elements, which may well be named after what they tell.
UNWANTED_INLINE = frozenset("ad ads advert advertisement sponsored hidden".split())
HEADER = frozenset({"header"})
WANTED = frozenset("article content story entry post main body".split())
#: Layout names ("with-sidebar", "no-ads") say what stands beside an element, not what it is.
BESIDE = re.compile(r"(?:has|with|no|without)[-_]+[a-z0-9]+")
NAMES = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: A sibling of the best container stays with this share of its points, or as a block of its own with fewer links.
SIBLING_SHARE, LINK_LIMIT = 0.2, 0.5


#: Elements whose contents are characters only, all of them left out; what ends each.
RAW = {t: re.compile(f"</{t}(?=[\\s/>])", re.I) for t in ("script", "style", "title", "textarea", "iframe", "noembed", "noframes")}
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")


class Node:
    """An element: its place in the tree, its blocks and what they add up to."""

    __slots__ = ("tag", "names", "parent", "block", "inside", "out", "kept", "head", "points", "chars", "links", "begin")

    def __init__(self, tag: str, names: frozenset, parent: Node | None, begin: int) -> None:
        self.tag, self.names, self.parent, self.begin = tag, names, parent, begin
        #: the innermost block element, itself included; whether within an article, left out, kept, in a header
        self.block = self if parent is None or tag in BLOCK else parent.block
        self.inside = tag in ("article", "main") or parent is not None and parent.inside
        self.head = tag == "header" or parent is not None and parent.head
        self.out = self.kept = False
        self.points, self.chars, self.links = 0.0, 0, 0

    def line(self) -> Iterator[Node]:
        """The element and all above it."""
        node = self
        while node is not None:
            yield node
            node = node.parent

    def density(self) -> float:
        return self.links / self.chars if self.chars else 0.0


def _words_of(tag: str, attributes: dict) -> frozenset:
    """Words of the class and id names (headings and paragraphs: of the class, as their ids tell their text)."""
    text = " ".join(attributes.get(k) or "" for k in (("class",) if tag in HEADINGS or tag == "p" else ("class", "id")))
    return frozenset(NAMES.findall(BESIDE.sub(" ", CAMEL.sub("-", text).lower())))


def _left_out(node: Node, attributes: dict, by_names: bool) -> bool:
    """Whether the element is something else than an article, by its tag, role, style or names."""
    if node.tag in ("html", "body"):
        return False
    if node.tag in LEFT_OUT or (attributes.get("role") or "").strip().lower() in ROLES:
        return True
    style = re.sub(r"\s", "", attributes.get("style") or "").lower()
    if "hidden" in attributes or "display:none" in style or (attributes.get("aria-hidden") or "").lower() == "true":
        return True
    if not by_names:
        return False
    if (node.tag == "header" or node.names & HEADER and not node.names & WANTED) and not node.inside:
        return True
    if node.tag in ("main", "article"):
        return bool(node.names & {"comment", "comments", "reply", "related"})
    if node.tag not in BLOCK:
        return bool(node.names & UNWANTED_INLINE)
    return bool(node.names & UNWANTED)


def markup(text: str) -> Iterator[tuple[str, str, dict]]:
    """("start", tag, attributes), ("end", tag, {}) and ("text", characters, {}) of a page, in one pass.

    Comments, declarations and the contents of RAW elements are passed over;
    a tag, comment or RAW element without an end takes the rest of the page.
    """
    at = 0
    while at < len(text):
        mark = text.find("<", at)
        if mark != at:
            yield "text", unescape(text[at:mark] if mark >= 0 else text[at:]), {}
            if mark < 0:
                return
        start = TAG.match(text, mark)
        if start:
            at, attributes, tag = start.end(), {}, start[2].lower()
            while attribute := ATTRIBUTE.match(text, at):
                at = attribute.end()
                value = attribute[2] or ""
                value = value[1:-1] if value[:1] in ("'", '"') and value[-1:] == value[:1] and len(value) > 1 else value
                attributes.setdefault(attribute[1].lower(), unescape(value))
            end = text.find(">", at)
            if end < 0:
                return
            at = end + 1
            yield "end" if start[1] else "start", tag, attributes
            if tag in RAW and not start[1]:
                end = RAW[tag].search(text, at)
                if not end:
                    return
                at = end.start()
        elif text.startswith(("<!", "</", "<?"), mark):
            comment = text.startswith("<!--", mark)
            close = "-->" if comment and not text.startswith((">", "->"), mark + 4) else ">"
            end = text.find(close, mark + 4 if close == "-->" else mark + 2)
            if end < 0:
                return
            at = end + len(close)
        else:
            yield "text", "<", {}
            at = mark + 1


class Page:
    """Tree and blocks of one page; a block is the text between two edges of block elements."""

    def __init__(self, by_names: bool = True) -> None:
        self.by_names = by_names
        self.root = Node("", frozenset(), None, 0)
        self.open: list[Node] = [self.root]
        self.text: list[str] = []
        self.linked: list[str] = []
        self.blocks: list[tuple[str, int, Node]] = []  # text, characters in links, block element
        self.nodes: list[Node] = [self.root]
        self.counts: Counter[str] = Counter()  # open elements by tag

    def _flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.blocks.append((text, len(" ".join("".join(self.linked).split())), self.open[-1].block))
        self.text, self.linked = [], []

    def _close(self, at: int) -> None:
        """Close the open elements from ``at`` on."""
        if any(n.tag in BLOCK for n in self.open[at:]):
            self._flush()
        self.counts.subtract(n.tag for n in self.open[at:])
        del self.open[at:]

    def _close_implied(self, tags: set, beyond: set) -> None:
        """Close the outermost open element of ``tags`` within the innermost of ``beyond``."""
        found = 0
        if not any(self.counts[t] for t in tags):
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag in tags:
                found = at
            elif self.open[at].tag in beyond or self.open[at].tag in ("article", "section", "body"):
                break
        if found:
            self._close(found)

    def _start(self, tag: str, attributes: dict) -> None:
        if tag == "br" or tag in ("td", "th"):
            self._data(" ")
        if tag in BLOCK:
            self._close_implied({"p"}, {"table", "button", "object"})
        if tag in CLOSED_BY:
            self._close_implied(*CLOSED_BY[tag])
        if tag == "a":
            self._close_implied({"a"}, {"table"})
        if tag in BLOCK:
            self._flush()
        if tag in VOID:
            return
        parent = self.open[-1]
        node = Node(tag, _words_of(tag, attributes), parent, len(self.blocks))
        node.out = parent.out or _left_out(node, attributes, self.by_names)
        if tag in BLOCK:
            self.nodes.append(node)
        self.open.append(node)
        self.counts[tag] += 1

    def _end(self, tag: str) -> None:
        if not self.counts[tag]:
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                self._close(at)
                return
            if tag not in BLOCK and self.open[at].tag in BLOCK:
                return  # an inline end tag does not close blocks

    def _data(self, data: str) -> None:
        if not self.open[-1].out:
            self.text.append(data)
            if self.counts["a"]:
                self.linked.append(data)

    def read(self, text: str) -> None:
        for kind, what, attributes in markup(text):
            if kind == "text":
                self._data(what)
            elif kind == "start":
                self._start(what, attributes)
            else:
                self._end(what)
        self._close(1)
        self._flush()


def score(page: Page) -> None:
    """Points, characters and link characters of every block element.

    A block gives one point, one per comma and one per 100 characters (three
    at most), less its share of links, to its container; every container hands
    half of its points on to the one above.
    """
    for text, links, node in page.blocks:
        node.chars += len(text)
        node.links += links
        if node.tag not in HEADINGS:
            node.points += (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - min(1.0, links / len(text)))
    for node in reversed(page.nodes[1:]):  # children come after their parents
        above = node.parent.block
        above.chars += node.chars
        above.links += node.links
        above.points += node.points / 2 if node.tag in CONTAINERS else node.points


def _fits(sibling: Node, home: Node) -> bool:
    """Whether a sibling of the best container is kept."""
    if sibling.out or sibling.density() >= LINK_LIMIT:
        return False
    if home.tag == "article":
        return sibling.tag == "h1" and sibling.begin <= home.begin
    if sibling.tag not in CONTAINERS:
        return True
    return sibling.points * (1 - sibling.density()) >= SIBLING_SHARE * home.points


def main_text(html: str) -> str:
    """The article's blocks in page order, joined by two line breaks; empty if there is none."""
    for by_names in (True, False):  # a page whose names leave nothing is read without them
        page = Page(by_names)
        page.read(html)
        if page.blocks:
            break
    else:
        return ""
    score(page)
    best = max((n for n in page.nodes if n.tag in CONTAINERS), key=lambda n: (n.points * (1 - n.density()), -n.begin))
    line = list(best.line())
    home = next((n for n in line if n.tag == "article"), next((n for n in line if n.tag == "main"), best))
    around = home.parent.block if home.parent is not None else None
    over = {id(n) for n in home.line()}
    # text beside the best container and its siblings, in the same part of the page
    beside = around is not None and around.tag not in ("", "html", "body") and home.tag not in ("article", "main")
    for node in page.nodes:
        above = node.parent.block if node.parent is not None else None
        # lists and containers that are mostly links are menus, wherever they stand
        menu = node.density() >= LINK_LIMIT and id(node) not in over and node.tag not in HEADINGS and node.tag not in ("p", "li")
        chosen = node is home or above is not None and (above.kept or above is around and _fits(node, home))
        node.kept = chosen and not menu
    texts = []
    for text, links, node in page.blocks:
        if not node.kept and not (beside and node is around and links < LINK_LIMIT * len(text)):
            continue
        if node.head and node.tag not in HEADINGS:
            continue  # of an article's own header only the headings belong to its text
        texts.append(text)
    return "\n\n".join(texts)


def extract_pages(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars (code points).

    Null html is empty and gives an empty text; so does a page without text.
    Rows that repeat are rows of their own, ids and urls are handed on as they
    are (null too).  A page of any length is read whole, one at a time.  An
    empty table gives an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py() or "") for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    d = pick(pages, "page_id", "url", "html").select(F.col("page_id"), F.col("url").cast("string"), F.col("html").cast("string"))
    return d.mapInArrow(run, f"page_id {d.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
