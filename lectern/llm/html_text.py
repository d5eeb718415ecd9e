"""Main text of web pages by composite text density.

Every node of the page's tree gets its characters a tag, adjusted by links:

    C/T * log(C/L * T/K) / log(log(C*L/N + C*l/c + e))

with its characters C, tags T, characters in links L (at most C) and outside of them N, link tags K, and the body's
characters c and link characters l. Counts that divide, and the last logarithm, count as 1 at least; so does C/L * T/K, so
no density is negative. The node whose children's densities sum highest is in the article. Where an article or main element
holds it, that element is the article (a main that holds one article is taken whole, title and all). Elsewhere the least
density on its path to the body is the threshold: in every node at or above it, the descendant with the highest sum is
content too, and so is all of the nearest node around the first one that holds a first heading. Nothing of what was chosen
is dropped, however short or sparse: leads, lists, tables and sections stay, in page order. On a page with one article or
main, only nodes inside of it are asked for their sums.

What can't be article is left out before: by its tag (menus, footers, sidebars, forms, scripts, ...), by a class, id or
role that says so (adverts, notices, ...), or as hidden. A name counts as a whole: all its parts must name such things or say
no more than where they stand, so "no-sidebar" names nothing. Reader comments are named by any part of a name, unless it
says that there are none or may be some ("has-comments"); they are left out at any length. A node named otherwise is kept if
it holds an article, main or h1 and the page has no article or main outside of such nodes; there a node with
most of the page's text, or most of what is outside of menus, footers and the like, is kept too, be it a form or named, and
density decides. Tags of text flow (b, em, a, span, ...) are counted but are no nodes. Unclosed paragraphs, list
items and cells end where HTML ends them; an end tag without a start is nothing.

Cases: null and empty html give an empty text; so do pages without text; text outside of any tag counts as the body's;
a truncated page ends all that is open; repeated rows give a row each; an empty table gives an empty result. Columns that
the caller has under this operator's names keep their values.
"""

from __future__ import annotations

import re
from html import unescape
from math import e, log

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, table

_TAG = re.compile(r"""<(?:!--|(/?)([a-zA-Z][^\s>/]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>|[!?/][^>]*>)""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s>/]*)([^>]*)>")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Why a node may be left out: by its tag or as hidden; by its names or as a form; as readers' comments.
ALWAYS, JUDGED, COMMENTS = 1, 2, 3

#: Their content is no markup.
RAW = frozenset("script style noscript template iframe textarea xmp title svg math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags of text flow.
FLOW = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: What is never article.
NOISE = frozenset("nav footer aside form head script style noscript template iframe svg math button select textarea object canvas dialog menu".split())
#: Words in class, id or role that name what is no article.
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert newsletter subscribe subscription paywall sidebar menu nav navbar navigation breadcrumb breadcrumbs footer share sharing social related recommended recommendations popup modal overlay widget masthead toolbar pagination pager login signup search complementary contentinfo dialog skip".split()
)
#: Words that name readers' comments, and those that only say whether there are any.
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies respond responses".split())
NO_COMMENTS = frozenset("allow allowed closed disabled enabled free has hide no off on open show with without".split())
#: Parts of a name that only say where or in what shape a thing stands.
PLACES = frozenset(
    "area articles bar block bottom box buttons col column container footer form global group header inner item items left link links list main module news outer page pages panel posts primary reader readers region right row secondary section site slot stories story tertiary this thread top unit us user users widgets wrap wrapper".split()
)
#: With a header or footer they name the page's own one.
WHOLE_PAGE = frozenset("global main page site top".split())
#: A start tag that ends an open one of these, up to a holder.
ENDS = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dd dt", {"dl"}), "dd": ("dd dt", {"dl"}), "tr": ("tr td th", {"table"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}), "option": ("option", {"select"})}


class _Node:
    __slots__ = ("chars", "children", "density", "holds", "link_chars", "link_tags", "noise", "parent", "summed", "tag", "tags")

    def __init__(self, tag: str, parent: _Node | None, noise: int) -> None:
        self.tag, self.parent, self.noise, self.holds, self.children = tag, parent, noise, frozenset(), []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.summed = 0.0
        if parent is not None:
            parent.children.append(self)


def _names_noise(names: str) -> int:
    """Whether a name in a class, id or role says that its node is no article."""
    out = 0
    for name in names.strip("\"'").split():
        parts = {w.lower() for w in _WORDS.findall(name)}
        if parts & COMMENT_WORDS and not parts & NO_COMMENTS:
            return COMMENTS
        page_end = parts & {"header", "footer"} and parts & WHOLE_PAGE
        if (parts & NOISE_WORDS or page_end) and parts <= NOISE_WORDS | PLACES:
            out = JUDGED
    return out


def _tree(html: str) -> tuple[_Node, list[tuple[_Node, str]]]:
    """The body and its blocks: (node, text) in page order."""
    body = node = _Node("body", None, 0)
    blocks: list[tuple[_Node, str]] = []
    buffer: list[str] = []
    link: _Node | None = None
    at, end = 0, len(html)

    def flush() -> None:
        if buffer:
            if text := " ".join(unescape("".join(buffer)).split()):
                blocks.append((node, text))
                node.chars += len(text)
            buffer.clear()

    def close(upto: _Node) -> _Node:
        nonlocal link
        flush()
        if link is not None and upto.parent is not None:
            on = link
            while on is not None and on is not upto:
                on = on.parent
            link = None if on is not None else link
        return upto.parent or upto

    def text(piece: str) -> None:
        buffer.append(piece)
        if link is not None:
            node.link_chars += len(piece.strip())

    while at < end:
        start = html.find("<", at)
        if start < 0:
            text(html[at:])
            break
        if start > at:
            text(html[at:start])
        found = _TAG.match(html, start) or _LOOSE.match(html, start)
        if found is None:
            text("<")
            at = start + 1
            continue
        at = found.end()
        tag = (found[2] or "").lower() if found.lastindex else ""
        if not tag:
            if html.startswith("<!--", start):
                stop = html.find("-->", start + 4)
                at = end if stop < 0 else stop + 3
            continue
        if not found[1]:
            if tag in RAW:
                if not (found[3] or "").endswith("/"):
                    stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
                    at = end if stop is None else stop.end()
                continue
            if tag in FLOW:
                node.tags += 1
                if tag == "a":
                    node.link_tags += 1
                    link = node
                elif tag == "br":
                    text(" ")
                continue
            if tag in ("html", "body"):
                flush()
                continue
            if tag in ENDS:
                names, holders = ENDS[tag]
                on, last = node, None
                while on is not None and on.tag not in holders:
                    if on.tag in names.split():
                        last = on
                    on = on.parent
                if last is not None:
                    node = close(last)
            flush()
            on = node  # a block ends an open paragraph
            while on is not None and on.tag not in ("td", "th", "li", "body", "article", "main", "table"):
                if on.tag == "p":
                    node = close(on)
                    break
                on = on.parent
            if tag in ("article", "main"):  # and a menu that was never closed
                on = node
                while on is not None:
                    if on.tag in NOISE:
                        node = close(on)
                    on = on.parent
            if tag in VOID:
                node.tags += 1
                continue
            attributes = found[3] or ""
            noise = 0 if tag not in NOISE else JUDGED if tag == "form" else ALWAYS
            if attributes and noise != ALWAYS and tag not in ("article", "main"):
                if _HIDDEN.search(attributes):
                    noise = ALWAYS
                else:
                    noise = max(noise, *(_names_noise(m[1]) for m in _NAMES.finditer(attributes)), 0)
            if tag == "header":
                on = node
                while on is not None and on.tag not in ("article", "main"):
                    on = on.parent
                noise = ALWAYS if on is None else noise
            node = _Node(tag, node, noise)
            if tag in ("article", "main", "h1"):
                on = node
                while on is not None:
                    on.holds |= {tag}
                    on = on.parent
        elif tag == "a":
            link = None
        elif tag not in FLOW and tag not in RAW:
            on = node
            while on is not None and on.tag != tag:
                on = on.parent
            if on is not None and on is not body:
                node = close(on)
            else:
                flush()
    flush()
    return body, blocks


def _large(body: _Node) -> set[int]:
    """Judged nodes that hold most of the page's text, or of what may be article, where no article or main has text elsewhere."""
    order, stack = [], [body]
    while stack:
        order.append(node := stack.pop())
        stack.extend(node.children)
    if not any(node.noise == JUDGED for node in order):
        return set()
    every, maybe, named = {}, {}, {}  # characters: all, outside of what its tag or being hidden leaves out, in article or main
    for node in reversed(order):
        i, inner = id(node), [id(c) for c in node.children]
        gone = node.noise == COMMENTS or (node.noise == ALWAYS and not (node.holds and node.tag not in NOISE))
        every[i] = 0 if node.noise == COMMENTS else node.chars + sum(every[c] for c in inner)
        maybe[i] = 0 if gone else node.chars + sum(maybe[c] for c in inner)
        named[i] = maybe[i] if node.tag in ("article", "main") else sum(named[c] for c in inner) if maybe[i] else 0
    top = id(body)
    return {i for n in order if n.noise == JUDGED for i in (id(n),) if named[i] == named[top] and (2 * every[i] > every[top] or 2 * maybe[i] > maybe[top])}


def _elements(body: _Node) -> list[_Node]:
    """Outermost articles and mains outside of nodes that may be left out."""
    out, stack = [], [body]
    while stack:
        for c in reversed(stack.pop().children):
            if c.tag in ("article", "main"):
                out.append(c)
            elif not c.noise:
                stack.append(c)
    return out


def _stays(node: _Node, large: set[int], elsewhere: bool) -> bool:
    if not node.noise or id(node) in large:
        return True
    if node.noise == COMMENTS:  # comments are often articles themselves
        return "main" in node.holds
    if node.noise == JUDGED and elsewhere:
        on = node.parent
        while on is not None and on.tag not in ("article", "main"):
            on = on.parent
        return "main" in node.holds or (on is not None and "h1" in node.holds)
    return bool(node.holds) and node.tag not in (NOISE if node.noise == ALWAYS else NOISE - {"form"})


def _score(body: _Node) -> list[_Node]:
    """Nodes without noise, parents first; their counts, densities and sums are set."""
    large, elsewhere = _large(body), bool(_elements(body))
    order, stack = [], [body]
    while stack:
        node = stack.pop()
        order.append(node)
        node.children = [c for c in node.children if _stays(c, large, elsewhere)]
        stack.extend(reversed(node.children))
    for node in reversed(order):
        for c in node.children:
            node.chars += c.chars
            node.tags += c.tags + 1
            node.link_chars += c.link_chars
            node.link_tags += c.link_tags
    share = body.link_chars / max(body.chars, 1)
    for node in order:
        if c := node.chars:
            links = min(node.link_chars, c)
            base = log(c * links / max(c - links, 1) + share * c + e)
            node.density = c / max(node.tags, 1) * log(max(c / max(links, 1) * max(node.tags, 1) / max(node.link_tags, 1), 1.0) + 1e-9) / max(log(base + 1e-9), 1.0)
    for node in order:
        node.summed = sum(c.density for c in node.children)
    return order


def _up(node: _Node | None):
    while node is not None:
        yield node
        node = node.parent


def _chosen(body: _Node, order: list[_Node]) -> set[int]:
    """The nodes that are content with all that is left below them."""
    elements = _elements(body)
    asked = [n for n in order if any(x is elements[0] for x in _up(n))] if len(elements) == 1 else order
    top = max(asked, key=lambda n: n.summed)
    around = next((n for n in _up(top) if n.tag in ("article", "main")), None)
    if around is not None:
        for main in _up(around.parent):
            if main.tag == "main" and len(_elements(main)) == 1:
                return {id(main)}
        return {id(around)}
    least = min(n.density for n in _up(top))
    best: dict[int, _Node] = {}
    for node in reversed(order):
        best[id(node)] = max([node, *(best[id(c)] for c in node.children)], key=lambda n: n.summed)
    titled = next((n for n in _up(top) if n is not body and (n.tag == "h1" or "h1" in n.holds)), top)
    heads = {id(c) for n in _up(titled) for c in n.children if c.tag == "h1"}
    return {id(best[id(n)]) for n in order if n.density >= least and n.chars} | {id(titled)} | heads


def main_text(html: str | None) -> str:
    """The article's blocks, one a line."""
    body, blocks = _tree(html or "")
    order = _score(body)
    content = _chosen(body, order)
    inside: dict[int, bool] = {}
    for node in order:  # parents first; what was left out is missing
        inside[id(node)] = id(node) in content or (node.parent is not None and inside.get(id(node.parent), False))
    return "\n".join(text for node, text in blocks if inside.get(id(node), False))


def extracted(html: Column) -> Column:
    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(main_text)

    return run(F.coalesce(html, F.lit("")))


def extract(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """pages with the main text of html."""
    small_batches(pages.sparkSession)
    return pages.withColumn(out, extracted(F.col(html)))


def op9_main_text(spark, sf_dir: str) -> DataFrame:
    pages = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
