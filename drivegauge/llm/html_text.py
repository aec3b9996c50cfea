"""Main text of web pages by tree scoring.

Blocks of text pass points (one, one per comma, one per hundred characters up to three) to the containers above them:
all to the nearest, half to the next, a third to the one after, discounted by the share of their characters inside
links. The container with the most points after discounting by its own link density wins; an article or main element
around it is taken instead. Siblings with a fifth of its points, or that are paragraphs of plain prose, are kept too.

Blocks inside menus, headers, footers, sidebars, scripts, styles and reader comments do not count and are not kept, be
they known by their element, their role or, comments, by their class and id. Forms, and what its class or id calls an
advert, notice, menu or sidebar, weigh less: points under such a name count a tenth (menus and the like) or a thirtieth
(forms, adverts, notices; prose only) when the best container is chosen, and are kept only where that is one of them. So
names alone never empty a page of prose; an element whose names also call it the post or article weighs in full.

A page takes time in proportion to its length and elements, however deep or broken it is: a tag without end, an end
tag without start and an open quote are passed over once. ``option``, ``select`` and ``button`` without end tag last
to the next block.

Cases: null and empty html give the empty text; broken markup (unclosed tags, unknown tags, truncated pages) is read
as far as it goes; rows repeat as given; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import collections
import html as _html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import map_batches

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
VALUE = re.compile(r"""[^>"'=]*""")
#: Elements by their role in HTML.
RAW = {"script", "style", "title", "textarea", "template", "noscript", "iframe", "svg", "math", "object", "audio", "video", "canvas"}
CONTROL = {"select", "datalist", "option", "optgroup", "button"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
PARAGRAPH = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "pre", "blockquote", "figcaption", "summary"}
CLOSES_P = BLOCK - {"html", "body", "head"}
LEFT_OUT = {"nav", "header", "footer", "aside", "menu", "dialog", "head"}
FORMS = {"form", "fieldset"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"}
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|disqus)(?:$|[\s_-])", re.I)
NOISE = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|breadcrumbs?|cookies?|newsletter|notices?|popup|promo\w*|sponsor\w*|subscribe)(?:$|[\s_-])", re.I)
DOUBT = re.compile(r"(?:^|[\s_-])(?:banner|footer|header|masthead|menu|nav\w*|related|share|sharing|sidebar|social|toolbar|widget)(?:$|[\s_-])", re.I)
CONTENT = re.compile(r"(?:^|\s)(?:(?:post|article|entry|story|page|main)(?:[_-](?:content|body|text))?|content|body)(?:$|\s)", re.I)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
COMMENT_END = re.compile(r"--!?>")
CLEAN, DOUBTFUL, NOISY, OUT = 0, 1, 2, 3
#: What a point counts for under each kind of name when the best container is chosen.
WEIGHT = {CLEAN: 1.0, DOUBTFUL: 0.1, NOISY: 1 / 30, OUT: 0.0}


class Node:
    """A block element: what it gathered, and whether its text can be main text."""

    __slots__ = ("tag", "parent", "state", "points", "chars", "linked", "prose")

    def __init__(self, tag: str, parent: Node | None, state: int):
        self.tag, self.parent, self.state = tag, parent, state
        self.points, self.chars, self.linked, self.prose = 0.0, 0, 0, False

    @property
    def value(self) -> float:
        return self.points * (1 - self.linked / max(1, self.chars))


def state_of(tag: str, attributes: str) -> int:
    """Whether an element is left out by what it is, noisy (a form, or by its names), doubtful by its names, or clean."""
    if tag in LEFT_OUT:
        return OUT
    state, names = NOISY if tag in FORMS else CLEAN, ""
    for name, *values in ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), "".join(values)
        if name in ("class", "id"):
            names += f" {value}"
        elif name == "role" and value.lower() in ROLES or name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return OUT
        elif name == "style" and re.search(r"display\s*:\s*none", value):
            return OUT
    if names and tag not in ("body", "html", "article", "main") and not CONTENT.search(names):
        state = max(state, OUT if COMMENTS.search(names) else NOISY if NOISE.search(names) else DOUBTFUL if DOUBT.search(names) else CLEAN)
    return state


class Scanner:
    """Tags of a page from left to right, in one pass."""

    def __init__(self, page: str):
        self.page, self.quotes = page, True
        self.no_end: set[str] = set()

    def tag_end(self, at: int) -> int:
        """Place of the ``>`` that ends the tag whose attributes begin at ``at``; -1 if there is none.

        A quote counts behind ``=`` only. After a quote that swallows all that follows, quotes no longer count.
        """
        page, start = self.page, at
        while self.quotes:
            at = VALUE.match(page, at).end()
            if at >= len(page):
                break
            if page[at] == ">":
                return at
            if page[at] == "=":
                at += 1
                while at < len(page) and page[at].isspace():
                    at += 1
                if at < len(page) and page[at] in "\"'":
                    stop = page.find(page[at], at + 1)
                    if stop < 0:
                        break
                    at = stop + 1
            else:
                at += 1
        self.quotes = self.quotes and page.find(">", start) < 0
        return page.find(">", start)

    def raw_end(self, tag: str, at: int) -> int:
        """End of the raw element's end tag; -1 if there is none."""
        if tag in self.no_end:
            return -1
        stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(self.page, at)
        if not stop:
            self.no_end.add(tag)
        return stop.end() if stop else -1

    def __iter__(self):
        """``(text before, tag, closing, attributes)``; comments and declarations have an empty tag."""
        page, at, size = self.page, 0, len(self.page)
        text = 0
        while at < size:
            start = page.find("<", at)
            if start < 0:
                break
            follow = page[start + 1 : start + 2]
            if follow in ("!", "?"):
                if page.startswith("<!--", start):
                    empty = 5 if page.startswith(">", start + 4) else 6 if page.startswith("->", start + 4) else 0
                    stop = None if empty else COMMENT_END.search(page, start + 4)
                    at = start + empty if empty else stop.end() if stop else size
                else:
                    stop = page.find(">", start + 2)
                    at = stop + 1 if stop >= 0 else size
                yield page[text:start], "", False, ""
            else:
                closing = follow == "/"
                name = NAME.match(page, start + 1 + closing)
                if not name:
                    at = start + 1
                    continue
                stop = self.tag_end(name.end())
                at = stop + 1 if stop >= 0 else size
                tag = name[0].lower()
                attributes = page[name.end() : at - 1]
                yield page[text:start], tag, closing, attributes
                if tag in RAW and not closing and not attributes.endswith("/") and (end := self.raw_end(tag, at)) >= 0:
                    at = end
                elif tag in ("script", "style") and not closing and not attributes.endswith("/"):
                    at = size
            text = at
        yield page[text:], "", False, ""


def blocks_of(page: str) -> tuple[list[Node], list[tuple[Node, str, int]]]:
    """The page's block elements, parents first, and its blocks in order: the element each stands in, its text, and how
    many of its characters are links'."""
    node = Node("html", None, CLEAN)
    nodes, out = [node], []
    open_: collections.Counter[str] = collections.Counter()
    parts: list[str] = []
    links: list[str] = []
    in_link, control = False, ""

    def flush() -> None:
        text = " ".join(_html.unescape("".join(parts)).split())
        if text:
            linked = len(" ".join(_html.unescape(" ".join(links)).split())) if links else 0
            out.append((node, text, min(linked, len(text))))
        parts.clear()
        links.clear()

    for text, tag, closing, attributes in Scanner(page):
        if text and not control:
            parts.append(text)
            if in_link:
                links.append(text)
        if not tag:
            continue
        if tag in RAW:
            parts.append(" ")
        elif tag in CONTROL:
            parts.append(" ")
            if not closing:
                control = control or tag
            elif tag == control or tag in ("select", "datalist", "button"):
                control = ""
        elif tag == "a":
            in_link = not closing
        elif tag in VOID:
            parts.append(" " if tag in ("br", "wbr") else "")
            if tag == "hr":
                flush()
        elif tag in BLOCK:
            control = ""
            flush()
            if closing:
                while open_[tag] and node.parent:
                    open_[node.tag] -= 1
                    node, found = node.parent, node.tag
                    if found == tag:
                        break
            else:
                if tag in CLOSES_P and node.tag == "p" or tag in ("li", "dt", "dd", "tr", "td", "th") and node.tag == tag:
                    open_[node.tag] -= 1
                    node = node.parent
                node = Node(tag, node, max(node.state, state_of(tag, attributes)))
                open_[tag] += 1
                nodes.append(node)
                in_link = False
    flush()
    return nodes, out


def main_text(page: str | None) -> str:
    """Text of the best container and its kept siblings, one block per line."""
    nodes, blocks = blocks_of(page or "")
    for node, text, linked in blocks:
        node.chars += len(text)
        node.linked += linked
        if node.state == OUT:
            continue
        node.prose = len(text) > 80 and linked * 4 < len(text) or not linked and text[-1] in ".!?"
        points = (1 + text.count(",") + min(len(text) // 100, 3)) * (1 - linked / len(text))
        holder = node.parent if node.tag in PARAGRAPH and node.parent else node
        for share in (1, 2, 3):
            if holder and holder.state == node.state and (node.state != NOISY or node.prose):  # noisy text counts if it is prose
                holder.points += points / share
            holder = holder and holder.parent
    for node in reversed(nodes):
        if node.parent:
            node.parent.chars += node.chars
            node.parent.linked += node.linked
    usable = [n for n in nodes if n.points > 0]
    if not usable:
        return ""
    best = max(usable, key=lambda n: n.value * WEIGHT[n.state])
    allowed = best.state
    above: Node | None = best
    while above:
        if above.tag in ("article", "main"):
            best = above
        above = above.parent
    least = best.value / 5
    kept: set[int] = set()
    for node in nodes:  # parents come first
        beside = node.parent is not None and node.parent is best.parent and (node.prose and node.tag == "p" or node.points > 0 and node.value >= least)
        if node is best or node.state <= allowed and (beside or id(node.parent) in kept):
            kept.add(id(node))
    return "\n".join(text for node, text, _ in blocks if node.state <= allowed and id(node) in kept)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` per row."""
    pages = df.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(html_col), F.lit("")).alias("html"), F.col(url_col).cast("string").alias("url"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [main_text(h) for h in batch.column(1).to_pylist()]
        return pa.record_batch([batch.column(0), batch.column(2), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return map_batches(pages, run, "page_id long, url string, text string, n_chars long")
