"""Blocks of an HTML page: a small tolerant parser.

Inline markup belongs to the block around it, so the tree has block elements
only. Scripts, styles and the like have no text. What HTML lets an author leave
out (end tags of paragraphs, list items, cells) is put in; a tag cut off by the
end of the page is dropped.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Element names of HTML.
BLOCKS = frozenset(
    "html head body header footer nav main article section aside div p ul ol li dl dt dd table thead tbody "
    "tfoot tr td th caption h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption form fieldset legend details "
    "summary address center dialog menu hgroup search button select option optgroup datalist label noscript "
    "template svg canvas video audio object iframe math map".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements whose text is never shown as such.
HIDDEN = frozenset(
    "head script style textarea title xmp iframe noembed noframes noscript template select option optgroup "
    "datalist button svg canvas video audio object math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
#: A start tag ends an open element of these names, not beyond the second ones.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody"), ("table",)), "tfoot": (("thead", "tbody"), ("table",)),
    "option": (("option",), ("select", "datalist")), "body": (("head",), ("html",)),
}
_TAG = re.compile(
    r"<(?:!--.*?(?:--!?>|\Z)|[!?][^>]*(?:>|\Z)|/(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|(?P<start>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)"
    r"|/[^a-zA-Z>][^>]*(?:>|\Z)|/>)", re.S)
_NAMES = re.compile(r"(?i)\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_LABEL = re.compile(r"(?i)\bdata-label\s*=\s*[\"']?([01])")
_OPEN_QUOTE = re.compile(r"=\s*(?:\"[^\"]*|'[^']*)\Z")
_SPLIT = re.compile(r"[^a-z0-9]+")


@dataclass
class Page:
    """Block elements in page order; ``runs`` are pieces of text with their element."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    names: list[tuple[str, ...]] = field(default_factory=list)
    label: list[int] = field(default_factory=list)
    hidden: list[bool] = field(default_factory=list)
    link: list[int] = field(default_factory=list)  # characters inside links
    runs: list[tuple[int, str | None]] = field(default_factory=list)  # None ends a block


def parse(source: str) -> Page:
    """The page's blocks; node 0 is the page itself.

    Where the open elements of a name stand in the stack is kept by name, so a
    tag costs the same however deep it lies.
    """
    page = Page(["#page"], [-1], [()], [0], [False], [0], [])
    stack, in_link, at = [0], False, 0
    places: dict[str, list[int]] = {}

    def text(piece: str) -> None:
        node = stack[-1]
        if piece and not page.hidden[node]:
            page.runs.append((node, piece))
            if in_link:
                page.link[node] += len(piece)

    def pop_to(depth: int) -> None:
        nonlocal in_link
        for node in stack[depth:]:
            places[page.tag[node]].pop()
        del stack[depth:]
        in_link = False
        page.runs.append((stack[-1], None))

    def innermost(names) -> int:
        """Depth of the innermost open element of some names, 0 if none is open."""
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    def end_open(ended, stop) -> None:
        """End the innermost element of some names, not beyond those of others."""
        depth = innermost(ended)
        if depth > innermost(stop):
            pop_to(depth)

    size = len(source)
    while at < size:
        match = _TAG.search(source, at)
        if match is None:
            text(source[at:])
            break
        text(source[at:match.start()])
        at = match.end()
        name = match["start"]
        if name is None:
            name = match["end"]
            if name is None:
                continue
            name = name.lower()
            if name == "a":
                in_link = False
            elif name == "br":
                text(" ")
            elif name in BLOCKS:
                end_open((name,), ())
            continue
        name = name.lower()
        if not match[0].endswith(">") or _OPEN_QUOTE.search(match["rest"]) and source.find(">", at) < 0:
            break  # cut off by the end of the page
        if name in RAW:
            end = re.compile(f"(?i)</{name}(?=[\\s/>])[^>]*>?").search(source, at)
            body, at = source[at:end.start() if end else size], end.end() if end else size
            if name not in HIDDEN:
                text(body)
            continue
        if name == "a":
            in_link = True
        elif name in ("br", "hr", "img", "input", "wbr"):
            if name == "hr":
                page.runs.append((stack[-1], None))
            if name != "wbr":
                text(" ")
        if name not in BLOCKS:
            continue
        if name in CLOSES_P:
            end_open(("p",), ("table", "td", "th", "button"))
        if name in ENDS:
            end_open(*ENDS[name])
        rest = match["rest"] or ""
        names, given = (), None
        if "=" in rest:
            names = tuple(dict.fromkeys(
                word for found in _NAMES.findall(rest) for word in _SPLIT.split("".join(found).lower()) if word))
            given = _LABEL.search(rest)
        up = stack[-1]
        page.tag.append(name)
        page.parent.append(up)
        page.names.append(names)
        page.label.append(int(given[1]) if given else page.label[up])
        page.hidden.append(page.hidden[up] or name in HIDDEN)
        page.link.append(0)
        page.runs.append((up, None))
        if not rest.endswith("/") or name not in ("svg", "object", "iframe"):
            places.setdefault(name, []).append(len(stack))
            stack.append(len(page.tag) - 1)
            in_link = False
    return page


def assemble(page: Page, wanted: list[bool]) -> str:
    """Text of the wanted elements, blocks joined by a space, character references decoded.

    References are decoded in each run of text, as one can't reach over a tag.
    """
    parts, open_run, last = [], [], -1
    for node, piece in page.runs:
        if piece is None or not wanted[node] or (open_run and node != last):
            if open_run:
                parts.append("".join(open_run))
                open_run = []
        if piece is not None and wanted[node]:
            open_run.append(html.unescape(piece))
            last = node
    if open_run:
        parts.append("".join(open_run))
    return " ".join(word for part in parts for word in part.split())
