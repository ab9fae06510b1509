"""Main text of web pages by tree scoring.

A page is parsed into a tree of its block elements.  Each block of text passes points for its length and commas to its
ancestors, less to farther ones; a container's score is discounted by its link density.  The best container, the
siblings that score alike and the article that holds it are kept, and what is marked as furniture of the page is not.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtloom.llm.common import byte_batches

BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no running text of a page.
DROPPED = set("head title script style noscript template svg math iframe object canvas audio video nav footer aside form button select textarea input dialog search menu".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tooltip".split())
#: Parts of class and id names that mark furniture.
MARKS = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments commentlist consent cookie cookies disclaimer "
    "disqus dropdown footer gdpr header login masthead menu menus modal nav navbar navigation newsletter notice notices notification pager pagination "
    "popup promo promotion recommended related reply replies respond responses share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "toolbar topbar widget widgets".split()
)
KEPT = {"html", "body", "article", "main"}
PART = re.compile(r"[^a-z0-9]+|(?<=[a-z0-9])(?=[A-Z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Start tags that end an open element: tag -> what it ends, looked for no further than its list or table.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPE = {"ul", "ol", "dl", "table", "menu", "dir"}
LEVELS = 5
SIBLING_SHARE = 0.2
LINK_LIST = 0.6
#: Link density from which a sibling paragraph is none of the article, and characters that make it one without a sentence end.
TEXT_LINKS = 0.25
SIBLING_CHARS = 25


class Node:
    __slots__ = ("children", "chars", "drop", "links", "parent", "points", "tag")

    def __init__(self, tag: str, parent: Node | None, drop: bool):
        self.tag, self.parent, self.drop = tag, parent, drop
        self.points = self.chars = self.links = 0.0
        self.children = 0


def furniture(tag: str, attrs: list[tuple[str, str | None]], inside: bool) -> bool:
    """Whether an element is no part of an article; a header inside an article is its own."""
    if tag in DROPPED or tag == "header" and not inside:
        return True
    if tag in KEPT or not attrs:
        return False
    for name, value in attrs:
        value = value or ""
        if name in ("class", "id") and not MARKS.isdisjoint(p.lower() for p in PART.split(value) if p):
            return True
        if name == "role" and value.lower() in ROLES or name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and HIDDEN.search(value):
            return True
    return False


class Tree(HTMLParser):
    """Block elements of a page and, in page order, its blocks of text: (node, text, characters inside links)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("", None, False)]
        self.stack = [self.nodes[0]]
        self.open: Counter = Counter()
        self.blocks: list[tuple[Node, str, int]] = []
        self.text: list[str] = []
        self.linked = self.in_link = 0
        self.muted: list[str] = []  # open inline elements without running text

    def close_block(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                self.blocks.append((self.stack[-1], text, min(self.linked, len(text))))
            self.text, self.linked = [], 0

    def pop(self) -> None:
        self.open[self.stack.pop().tag] -= 1

    def pop_to(self, tags: set[str], scope: set[str] = frozenset()) -> None:
        """Close the innermost open element of `tags` with all inside it, unless one of `scope` is nearer."""
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[i].tag
            if tag in tags:
                while len(self.stack) > i:
                    self.pop()
                return
            if tag in scope:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.text.append(" ")
        elif tag not in BLOCKS:
            if tag == "a":
                self.in_link = 1
            elif tag not in VOID and (self.muted or furniture(tag, attrs, True)):
                self.muted.append(tag)
        else:
            self.close_block()
            self.in_link, self.muted = 0, []
            if self.open["p"]:
                self.pop_to({"p"}, SCOPE)
            if tag == "body" and self.open["head"]:
                self.pop_to({"head"})
            if tag in ENDS and any(self.open[t] for t in ENDS[tag]):
                self.pop_to(ENDS[tag], SCOPE)
            if tag != "hr":
                top = self.stack[-1]
                inside = bool(self.open["article"] or self.open["main"])
                node = Node(tag, top, top.drop or furniture(tag, attrs, inside))
                top.children += 1
                self.nodes.append(node)
                self.stack.append(node)
                self.open[tag] += 1

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.close_block()
            self.in_link, self.muted = 0, []
            if self.open[tag]:
                self.pop_to({tag})
        elif tag == "a":
            self.in_link = 0
        elif tag in self.muted:
            while self.muted.pop() != tag:
                pass

    def handle_data(self, data: str) -> None:
        if not self.muted:
            self.text.append(data)
            if self.in_link:
                self.linked += len(data.strip())


def score(tree: Tree) -> None:
    """Points of every container and the sizes of its subtree; furniture takes no part."""
    for node, text, links in tree.blocks:
        if node.drop:
            continue
        node.chars += len(text)
        node.links += links
        points = (0.1 + min(len(text) / 100, 3) + text.count(",")) * (1 - links / len(text))
        # A paragraph or heading hands its points on; text right inside a container counts for the container.
        at = node.parent if node.tag in ("p", "pre", "td", "li", "dd", "dt", "blockquote") or heading(node) else node
        for level in range(1, LEVELS + 1):
            if at is None:
                break
            at.points += points / level
            at = at.parent
    for node in reversed(tree.nodes[1:]):
        node.parent.chars += node.chars
        node.parent.links += node.links


def heading(node: Node) -> bool:
    return node.tag[:1] == "h" and node.tag[1:].isdigit()


def reads_on(node: Node, last: str) -> bool:
    """Whether a paragraph or heading beside the container reads as part of it; its points went to the parent, so its own text tells."""
    if node.links / node.chars >= TEXT_LINKS:
        return False
    return heading(node) or node.tag in ("p", "pre", "blockquote") and (node.chars >= SIBLING_CHARS or "," in last or last.rstrip("\"')”’»]")[-1:] in set(".!?:…。！？"))


def worth(node: Node) -> float:
    return node.points * (1 - node.links / node.chars) if node.chars else 0.0


def titles(tree: Tree, whole: Node) -> set[int]:
    """Headings that lead up to a container: before it, beside one of its ancestors below the body."""
    above, at = set(), whole.parent
    while at is not None and at.tag not in ("body", "html", ""):
        at = at.parent
        above.add(id(at))
    found = set()
    for node in tree.nodes:  # in page order
        if node is whole:
            break
        if heading(node) and not node.drop and node.chars and id(node.parent) in above and node.links / node.chars < TEXT_LINKS:
            found.add(id(node))
    return found


def main_text(html: str | None) -> str:
    """Blocks of the article, one line each; empty if the page has none."""
    if not html:
        return ""
    tree = Tree()
    tree.feed(html)
    tree.close()
    tree.close_block()
    score(tree)
    live = [n for n in tree.nodes if not n.drop and n.chars]
    if not live:
        return ""
    best = max(live, key=worth)  # the outer one of equals
    up = best
    while up is not None and up.tag not in ("article", "main"):
        up = up.parent
    whole = up or best
    kept = {id(whole)}
    if whole.parent is not None and whole.parent.tag not in ("html", ""):
        last = {id(node): text for node, text, _ in tree.blocks}
        kept |= {id(n) for n in live if n.parent is whole.parent and (worth(n) >= SIBLING_SHARE * worth(best) or up is None and reads_on(n, last.get(id(n), "")))}
        kept |= titles(tree, whole) if up is None else set()
    elif whole.tag in ("html", ""):
        kept.add(id(tree.nodes[0]))
    body = id(whole) if whole.tag not in ("html", "body", "") else 0
    within: dict[int, bool] = {}
    verdicts: dict[int, bool] = {}
    inside: dict[int, bool] = {}
    for node in tree.nodes:  # parents come before their children
        own = id(node) in kept or node.parent is not None and inside[id(node.parent)]
        inside[id(node)] = own
        within[id(node)] = id(node) == body or node.parent is not None and within[id(node.parent)]
        # Inside the article a list of links, such as its sources, is text; furniture there goes by its marks.
        links = not within[id(node)] and node.tag in ("ul", "ol", "div", "section", "table") and node.chars and node.links / node.chars > LINK_LIST and id(node) not in kept
        verdicts[id(node)] = own and not node.drop and not links and (node.parent is None or id(node) in kept or verdicts[id(node.parent)])
    return "\n".join(text for node, text, _ in tree.blocks if verdicts[id(node)])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    byte_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    chosen = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return chosen.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op1_tree_scoring(pages: DataFrame) -> DataFrame:
    """Main text of all pages.

    A null or empty html, or one without an article, gives an empty text.  Repeated rows and rows without page_id or
    url give a row each; other columns are not looked at.
    """
    return extract(pages)
