"""Main text of web pages by tree scoring.

A page is read into a tree of blocks. Each paragraph passes points for its length
and commas to its parent, half of them to its grandparent, and a third to the next
one up. A container's points are discounted by the share of its text that
stands in links. The text is that of the best container and of those siblings
that score well themselves, hold plain paragraphs, are its headings, or are
sections of its own tag and class with few links. If the best container lies in an
article or main element, that whole element is taken instead, but for parts of it
that are mostly links. Menus, headers, footers, sidebars, notices, adverts, forms, comments of readers,
scripts, styles and mark-up go before that, by element or by what their class, id
or role says. A class or id with such a word in it does not remove what holds all
articles or most of the text in paragraphs; one that is such a word removes it too,
unless another class stands beside it, all articles and most of that text are inside,
and the word is not one for comments or related pages. If names leave nothing of a page
with paragraphs, they are not heeded. A dialog or fieldset inside an article stays.

A block is what lies between the borders of block elements. White space inside
one becomes a single space; blocks are joined in page order by a line feed.
Character references are decoded. End tags that are missing or that match nothing
are repaired as they come. Tags and attributes end where an HTML tokeniser ends them; a
quote that is never closed counts as a plain character, and a tag that is never closed
reaches to the end of the page. Time is linear in the length of a page. Null and empty pages, and pages without text, give an
empty text. Every row is extracted, repeated ones alike; an empty table gives an
empty result. Columns other than id and html are not read.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Elements by what they do, and words that name a boilerplate block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split())
DROPPED = frozenset(
    "nav footer aside form script style noscript template iframe svg math button select option input "
    "textarea object embed canvas audio video head title menu map".split())
DROPPED_OUTSIDE_MAIN = frozenset("header dialog fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p pre blockquote td li dd dt".split()) | HEADINGS
CLOSED_BY_BLOCK = frozenset(["p", *HEADINGS])
BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|"
    r"nav|navbar|navigation|menu|breadcrumb|breadcrumbs|header|masthead|topbar|footer|copyright|"
    r"sidebar|side|aside|widget|related|recommended|share|sharing|social|cookie|cookies|consent|notice|"
    r"popup|modal|newsletter|subscribe|signup|login|search|form|comment|comments|disqus|replies|"
    r"respond|toolbar|pagination|pager|skip|hidden)(?:$|[\s_-])", re.IGNORECASE)
BOILERPLATE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert dialog menu menubar".split())
NEVER_THE_TEXT = frozenset(
    "comment comments disqus replies respond related recommended".split())
MAIN = frozenset(["article", "main"])

COMMENT_END = re.compile(r"--!?>")
TAG = re.compile(r"</?([A-Za-z][^\s/>]*+)")
BETWEEN = re.compile(r"[\s/]*+")
NAME = re.compile(r"[^\s/>][^\s/>=]*+")
EQUALS = re.compile(r"\s*+=\s*+")
BARE = re.compile(r"[^\s>]*+")
SPACE = re.compile(r"[\s\xa0]+")


@dataclass
class Node:
    tag: str
    parent: "Node | None"
    kind: str = ""  # the class, as written
    in_main: bool = False
    dropped: bool = False
    named: str = ""  # boilerplate by a "whole" class or id, "beside" a plain one, or by a "part"
    points: float = 0.0
    chars: int = 0
    linked: int = 0
    prose: int = 0
    articles: int = 0
    kept: bool = False
    children: list["Node"] = field(default_factory=list)


def is_boilerplate(tag: str, attributes: dict[str, str], inside_main: bool) -> bool:
    if tag in DROPPED or (tag in DROPPED_OUTSIDE_MAIN and not inside_main):
        return True
    if tag in MAIN or tag in ("html", "body"):
        return False
    return "hidden" in attributes or attributes.get("role", "").lower() in BOILERPLATE_ROLES


def named(tag: str, attributes: dict[str, str]) -> str:
    """How a class or id names boilerplate.

    It is such a word (whole), or that beside another class (beside), or has one in it (part).
    """
    if tag in MAIN or tag in ("html", "body"):
        return ""
    words = [w for name in ("class", "id") for w in attributes.get(name, "").lower().split()]
    whole = {w for w in words if BOILERPLATE.fullmatch(w)}
    if whole:
        beside = not whole & NEVER_THE_TEXT and any(not BOILERPLATE.search(w) for w in words)
        return "beside" if beside else "whole"
    return "part" if any(map(BOILERPLATE.search, words)) else ""


class Tags:
    """The mark-up of a page, read from left to right."""

    def __init__(self, text: str):
        self.text = text
        self.last = {quote: text.rfind(quote) for quote in "\"'"}

    def attributes(self, at: int) -> tuple[dict[str, str], int]:
        """The attributes of a tag, the first of a name, and where the tag ends."""
        text, found = self.text, {}
        while True:
            at = BETWEEN.match(text, at).end()
            if at >= len(text):
                return found, at
            if text[at] == ">":
                return found, at + 1
            name = NAME.match(text, at)
            value, at = "", name.end()
            equals = EQUALS.match(text, at)
            if equals:
                at = equals.end()
                quote = text[at:at + 1]
                if at < self.last.get(quote, -1):
                    end = text.index(quote, at + 1)
                    value, at = text[at + 1:end], end + 1
                else:
                    bare = BARE.match(text, at)
                    value, at = bare.group(), bare.end()
            found.setdefault(name.group().lower(), html.unescape(value))

    def other(self, at: int) -> int:
        """The end of a comment or declaration, or ``at`` if the < there is text."""
        text = self.text
        if text.startswith("<!--", at):
            if text.startswith((">", "->"), at + 4):
                return text.index(">", at + 4) + 1
            end = COMMENT_END.search(text, at + 4)
            return end.end() if end else len(text)
        if text.startswith(("<!", "<?", "</"), at):
            end = text.find(">", at)
            return end + 1 if end >= 0 else len(text)
        return at


class Page:
    """The blocks of a page in order, each with the node that holds it."""

    def __init__(self, text: str, by_name: bool = True):
        self.root = Node("#root", None)
        self.nodes = [self.root]  # parents before their children
        self.open: dict[str, int] = {}
        self.blocks: list[tuple[Node, str, int]] = []  # holder, text, characters in links
        self.at, self.links = self.root, 0
        self.pending: list[tuple[str, bool]] = []
        self._read(text)
        self._flush()
        if by_name:
            self._drop_named()

    def summed_up(self, *names: str) -> None:
        """Add what nodes hold to all their ancestors."""
        for node in reversed(self.nodes[1:]):
            for name in names:
                setattr(node.parent, name, getattr(node.parent, name) + getattr(node, name))

    def _drop_named(self) -> None:
        """Drop blocks under boilerplate names.

        A name that only has such a word in it does not count if the node holds all article
        and main elements, or most of the text of the page's paragraphs and, where there are
        such elements, any of them or lies in one. One beside a plain class does not count if
        the node holds all such elements and most of that text.
        """
        if not any(node.named for node in self.nodes):
            return
        for node in self.nodes:
            node.articles = int(node.tag in MAIN and not node.dropped)
        for node, text, linked in self.blocks:
            node.prose += len(text) - linked if node.tag in PARAGRAPHS else 0
        self.summed_up("prose", "articles")

        def holds_the_text(node: Node) -> bool:
            every, articles = self.root.prose, self.root.articles
            if node.named == "beside":
                return 0 < articles == node.articles and 2 * node.prose > every
            if 0 < articles == node.articles:
                return True
            return (not articles or node.articles or node.in_main) and 2 * node.prose > every

        for node in self.nodes[1:]:
            node.dropped = (node.dropped or node.parent.dropped or node.named == "whole"
                            or bool(node.named) and not holds_the_text(node))
        self.blocks = [block for block in self.blocks if not block[0].dropped]

    def _flush(self) -> None:
        """End the block being read."""
        if not self.pending:
            return
        whole = SPACE.sub(" ", html.unescape("".join(t for t, _ in self.pending))).strip()
        if whole and not self.at.dropped:
            linked = sum(len(html.unescape(t).strip()) for t, link in self.pending if link)
            self.blocks.append((self.at, whole, min(linked, len(whole))))
        self.pending = []

    def _read(self, text: str) -> None:
        tags, at, start = Tags(text), 0, 0  # of what is not yet told to be text
        while (at := text.find("<", at)) >= 0:
            tag = TAG.match(text, at)
            end = 0 if tag else tags.other(at)
            if not tag and end == at:
                at += 1
                continue
            self._text(text[start:at])
            if tag:
                attributes, end = tags.attributes(tag.end())
                name = tag.group(1).lower()
                if text[at + 1] == "/":
                    self._close(name)
                else:
                    self._open(name, attributes)
                    if name in RAW:
                        close = re.compile(rf"</{re.escape(name)}[\s/>]", re.IGNORECASE).search(text, end)
                        end = close.start() if close else len(text)
            at = start = end
        self._text(text[start:])

    def _text(self, text: str) -> None:
        if text and not self.at.dropped:
            self.pending.append((text, self.links > 0))

    def _open(self, tag: str, attributes: dict[str, str]) -> None:
        if tag == "br":
            self.pending.append((" ", False))
            return
        if tag == "a":
            self.links += 1
        if tag in INLINE:
            return
        self._flush()
        if tag in VOID:
            return
        if self.at.tag in CLOSED_BY_BLOCK or (tag == self.at.tag and tag in PARAGRAPHS):
            self._leave()
        self.links = 0
        inside = self.at.in_main or self.at.tag in MAIN
        dropped = self.at.dropped or is_boilerplate(tag, attributes, inside)
        if self.at.tag == "header" and inside and tag not in HEADINGS:
            dropped = True  # of an article's header its headings stay
        node = Node(tag, self.at, attributes.get("class", ""), inside, dropped, named(tag, attributes))
        self.nodes.append(node)
        self.at.children.append(node)
        self.open[tag] = self.open.get(tag, 0) + 1
        self.at = node

    def _leave(self) -> None:
        self.open[self.at.tag] -= 1
        self.at = self.at.parent

    def _close(self, tag: str) -> None:
        if tag == "a":
            self.links = max(0, self.links - 1)
        if tag in INLINE or tag in VOID:
            return
        self._flush()
        if not self.open.get(tag):
            return
        while self.at.tag != tag:
            self._leave()
        self._leave()
        self.links = 0


def score(page: Page) -> None:
    """Points, characters and linked characters of every node that holds text."""
    for node, text, linked in page.blocks:
        gain = 1 + text.count(",") + min(3.0, len(text) / 100)
        gain *= 1 - linked / len(text)
        holder = node if node.tag not in PARAGRAPHS else node.parent
        node.chars += len(text)
        node.linked += linked
        while holder is not None and holder.tag in ("tr", "tbody", "ul", "ol", "dl"):
            holder = holder.parent
        for divisor in (1, 2, 3):
            if holder is None:
                break
            holder.points += gain / divisor
            holder = holder.parent
    page.summed_up("chars", "linked")


def final(node: Node) -> float:
    density = node.linked / node.chars if node.chars else 1.0
    return node.points * (1 - density) * (1.5 if node.tag in MAIN else 1.0)


def few_links(node: Node) -> bool:
    return node.chars > 0 and node.linked <= 0.25 * node.chars


def choose(best: Node) -> None:
    """Mark the nodes whose blocks are the text."""
    inner = best  # on the way up
    while best.in_main and best.tag not in MAIN:
        inner, best = best, best.parent
    best.kept = True
    if inner is not best:
        # The whole article, but for lists of links beside the way to the best container.
        while inner is not best:
            for other in inner.parent.children:
                if other is not inner and 2 * other.linked > other.chars:
                    other.dropped = True
            inner = inner.parent
    elif best.parent is not None:
        bar = max(10.0, 0.2 * final(best))
        for other in best.parent.children:
            alike = other.tag in PARAGRAPHS or (
                other.tag not in MAIN and (other.tag, other.kind) == (best.tag, best.kind))
            other.kept = other is best or final(other) >= bar or (alike and few_links(other))


def main_text(source: str | None) -> str:
    """The article's blocks, joined by line feeds."""
    if not source:
        return ""
    page = Page(source)
    if not page.blocks:  # all of it under boilerplate names
        page = Page(source, by_name=False)
        if not any(node.tag in PARAGRAPHS for node, *_ in page.blocks):
            return ""
    if not page.blocks:
        return ""
    score(page)
    choose(max(holders_of(page), key=final))
    for node in page.nodes[1:]:
        node.dropped = node.dropped or node.parent.dropped
        node.kept = node.kept or node.parent.kept
    return "\n".join(text for node, text, _ in page.blocks if node.kept and not node.dropped)


def holders_of(page: Page) -> list[Node]:
    """Containers above any block, in page order, each once."""
    seen: dict[int, Node] = {}
    for node, _, _ in page.blocks:
        at = node if node.tag not in PARAGRAPHS else node.parent
        while at is not None and id(at) not in seen:
            seen[id(at)] = at
            at = at.parent
    return list(seen.values())


def text_column(html_col: str = "html") -> Column:
    """The main text of a column of pages."""
    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(main_text)

    return run(F.coalesce(F.col(html_col), F.lit("")))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``id, text`` of every row."""
    return pages.select(F.col(id_col).alias("id"), text_column(html_col).alias("text"))
