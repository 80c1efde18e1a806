"""Web pages to sequences of text blocks with their tag paths.

A block is the text between two boundaries of block-level elements; inline
elements and line breaks stay inside it. The path of a block names its
ancestors' tags and their class, id and role words.

Only what a page never shows as text, and form fields, give no blocks; formulas,
drawings' labels and fallback texts stand in the block around them.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

# Element kinds of HTML.
RAW = frozenset("script style template textarea title iframe select head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - {"body", "html", "button", "option", "td", "th", "tr", "tbody", "thead", "tfoot", "legend"}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table select menu".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))", re.S
)
_NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")


class Block(NamedTuple):
    path: tuple[str, ...]
    text: str
    link_chars: int


def _names(tag: str, attributes: str) -> tuple[str, ...]:
    out = [tag]
    if "=" in attributes:
        for a, b, c in _NAMED.findall(attributes):
            out += ["." + w for w in _WORD.findall((a or b or c).lower())]
    return tuple(out)


def blocks(page: str | None) -> list[Block]:
    """The blocks of a page in order; raw elements (scripts, styles, the head's title) give none."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    path: tuple[str, ...] | None = None
    links = depth = 0

    def flush() -> None:
        nonlocal parts, path, links
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Block(path or (), text, min(links, len(text))))
        parts, path, links = [], None, 0

    def add(text: str) -> None:
        nonlocal path, links
        if not text:
            return
        if path is None and not text.isspace():
            path = tuple(n for _, names in stack for n in names)
        parts.append(text)
        if depth:
            links += len(text)

    def pop(to: int) -> None:
        nonlocal depth
        for tag, _ in stack[to:]:
            depth -= tag == "a"
        del stack[to:]

    page = page or ""
    lowered: str | None = None
    at = 0
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                add(m[0][9:].removesuffix("]]>"))
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in BLOCK:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    pop(k)
                    break
                if tag not in BLOCK and stack[k][0] in BLOCK:
                    break  # an inline end tag never closes a block
            continue
        if tag in RAW:
            if tag in ("head", "select") and m[0].endswith("/>"):
                continue
            lowered = page.lower() if lowered is None else lowered
            if len(lowered) != len(page):  # a letter whose lower case has another length
                end = re.compile(rf"</{tag}", re.I).search(page, at)
                stop = end.start() if end else -1
            else:
                stop = lowered.find(f"</{tag}", at)
            if tag == "head":  # an unclosed head ends where the body starts
                body = re.compile(r"<body", re.I).search(page, at, stop if stop >= 0 else len(page))
                stop = body.start() if body else stop
                at = stop if stop >= 0 else at
                continue
            at = stop if stop >= 0 else len(page)
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            else:
                add(" ")
            continue
        if tag in BLOCK:
            flush()
            if tag in CLOSES_P:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == "p":
                        pop(k)
                        break
                    if stack[k][0] in BLOCK:
                        break
            same = SAME.get(tag)
            if same:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in same:
                        pop(k)
                        break
                    if stack[k][0] in SCOPES:
                        break
        if m[0].endswith("/>") and tag not in BLOCK:
            continue
        stack.append((tag, _names(tag, m[3])))
        depth += tag == "a"
    flush()
    return out
