"""Leaf blocks of a page's element tree: a tolerant one-pass scan of the HTML.

A block is the text between two borders of block-level elements, with the
elements around it.  Open elements are closed as browsers do in the common
cases (a new paragraph ends one, a closing tag ends what is open inside it);
scripts, styles, templates, comments and tags give no text; a tag that the end
of the page cuts off is dropped.  Character references are decoded, then runs
of white space become one space.  Scanning is linear in the page's length.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

#: Fixed values of the language: elements without content, without text of the page, inside a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSHOWN = frozenset("script style template noscript iframe object svg math canvas xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
#: An opening tag of the key ends open elements of the value, up to the nearest limit.
ENDS = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
        "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}, "body": {"head"}}
LIMITS = frozenset("ul ol dl table div section article body html td th nav aside main form".split())
CLOSE_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
                    "h5 h6 header hr main menu nav ol p pre section table ul".split())

# A quote counts only after "=", and an open one runs to the end, so nothing is scanned twice.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+"[^"]*+(?:"|\Z)|=\s*+'[^']*+(?:'|\Z)|[^>])*+)(>|\Z)""")
_SKIP = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?/][^>]*(?:>|\Z)", re.S)
_NAMED = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?until)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_WORDS = re.compile(r"[a-z]+")


@dataclass
class Block:
    """Text of a leaf block; ``around``: names of the elements it is in, with
    the words of their classes, ids and roles; ``inner``: its own element."""

    text: str
    around: frozenset
    inner: str
    link_chars: int
    depth: int


def _names(attributes: str) -> list[str]:
    out = [f".{w}" for _, a, b, c in _NAMED.findall(attributes) for w in _WORDS.findall((a or b or c).lower())]
    if _HIDDEN.search(attributes):
        out.append("hidden")
    return out


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks of a page in order, those without text left out."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, frozenset]] = []
    opened: Counter[str] = Counter()   # names on the stack
    parts: list[str] = []
    place: list = []          # elements around the first text of the block
    links, in_link = 0, 0

    def flush() -> None:
        nonlocal links
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            names, inner, depth = place[0]
            out.append(Block(text, names, inner, min(links, len(text)), depth))
        parts.clear()
        place.clear()
        links = 0

    def add(text: str) -> None:
        nonlocal links
        if not text:
            return
        if not place and not text.isspace():
            inner = next((t for t, _ in reversed(stack) if t not in INLINE), "")
            place.append((stack[-1][1] if stack else frozenset(), inner, len(stack)))
        parts.append(text)
        if in_link:
            links += len(text)

    def pop() -> None:
        nonlocal in_link
        tag, _ = stack.pop()
        opened[tag] -= 1
        if tag == "a":
            in_link -= 1
        elif tag not in INLINE:
            flush()

    at, n = 0, len(page)
    while at < n:
        less = page.find("<", at)
        if less < 0:
            add(page[at:])
            break
        if less > at:
            add(page[at:less])
        tag = _TAG.match(page, less)
        if tag is None:
            skip = _SKIP.match(page, less)
            if skip is None:
                add("<")
                at = less + 1
            else:
                at = skip.end()
            continue
        at = tag.end()
        if not tag[4]:
            break             # cut off by the end of the page
        name = tag[2].lower()
        if tag[1]:
            if opened[name]:
                while stack[-1][0] != name:
                    pop()
                pop()
            elif name == "p":
                flush()
            continue
        if name in UNSHOWN:
            if not tag[3].endswith("/"):
                close = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
                at = close.end() if close else n
            if name not in INLINE:
                flush()
            continue
        if name in VOID:
            if name == "br":
                add(" ")
            elif name == "hr":
                flush()
            continue
        if name in CLOSE_P or name in ENDS:
            flush()
            ended = ENDS.get(name, {"p"})
            k = len(stack) - 1 if any(opened[t] for t in ended) else -1
            while k >= 0 and (stack[k][0] in ended or stack[k][0] not in LIMITS):
                if stack[k][0] in ended:
                    while len(stack) > k:
                        pop()
                k -= 1
        elif name not in INLINE:
            flush()
        outer = stack[-1][1] if stack else frozenset()
        stack.append((name, outer.union([name], _names(tag[3])) if tag[3] or name not in outer else outer))
        opened[name] += 1
        if name == "a":
            in_link += 1
    flush()
    return out
