"""A page as the sequence of its blocks of text, each with the path of tags that leads to it.

A block ends where an element other than an inline one begins or ends. Browsers mend markup by
long rules; here unclosed paragraphs, items and cells end where the next one of their kind or an
enclosing end tag comes, and an end tag that nothing opened is ignored.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

# Elements by what they do to text.
INLINE = set(
    "a abbr acronym b bdi bdo big br button cite code data del dfn em font i img input ins kbd label mark q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements without text for readers.
SILENT = "script|style|template|svg|math|iframe|object|canvas"
#: Elements that end an open element of the second set, up to the nearest of the third.
CLOSES = {
    **dict.fromkeys(
        "address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header "
        "hr main menu nav ol p pre section table ul".split(),
        ({"p"}, {"td", "th", "button", "caption"}),
    ),
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}

_PIECE = re.compile(
    rf"<!--.*?(?:-->|\Z)"
    rf"|<(?P<silent>{SILENT})\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*+>.*?(?:</(?P=silent)\s*>|\Z)"
    rf"|<[!?][^>]*+(?:>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    rf"|<(?P<end2>/?)(?P<tag2>[a-z][^\s/>]*)(?P<attrs2>[^>]*+)(?:>|\Z)"
    rf"|(?P<text>[^<]++|<)",
    re.IGNORECASE | re.DOTALL,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"display\s*:\s*none|aria-hidden\s*=\s*.?true|\shidden\b", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")


@dataclass
class Block:
    """Text with its white space made single, the tags and names on its path, the last tag, and
    the share of its characters inside links."""

    text: str
    path: tuple[str, ...]
    last: str
    linked: float


def _names(attrs: str) -> tuple[str, ...]:
    found = [w.lower() for m in _NAMES.finditer(attrs) for w in _WORD.findall(m[1] or m[2] or m[3] or "")]
    if _HIDDEN.search(attrs):
        found.append("hidden")
    return tuple("." + w for w in found)


def blocks(page: str | None) -> list[Block]:
    out: list[Block] = []
    stack: list[str] = []
    names: list[tuple[str, ...]] = []
    words: list[str] = []
    linked = 0
    path: tuple[str, ...] | None = None
    links = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(words).split())
        if text:
            tags = [t for t in stack if t not in INLINE]
            out.append(Block(text, path or (), tags[-1] if tags else "", min(1.0, linked / len(text))))
        words.clear()
        linked = 0

    def cut(depth: int) -> None:
        nonlocal path, links
        if any(t not in INLINE for t in stack[depth:]):
            flush()
            path = None
        links -= stack[depth:].count("a")
        del stack[depth:], names[depth:]

    for m in _PIECE.finditer(page or ""):
        if (text := m["text"]) is not None:
            text = html.unescape(text) if "&" in text else text
            words.append(text)
            if links:
                linked += len(text)
            if path is None:
                # Inline elements around the first words do not tell where the block is.
                path = tuple(dict.fromkeys(x for t, n in zip(stack, names, strict=True) if t not in INLINE or n for x in (t, *n)))
            continue
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        if m["end"] or m["end2"]:
            if tag in stack:
                cut(len(stack) - 1 - stack[::-1].index(tag))
            elif tag not in INLINE:
                flush()
                path = None
            continue
        if tag not in INLINE:
            flush()
            path = None
            ended, until = CLOSES.get(tag, (set(), set()))
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth] in until:
                    break
                if stack[depth] in ended:
                    cut(depth)
                    break
        elif tag == "br":
            words.append(" ")
        if tag not in VOID:
            stack.append(tag)
            names.append(_names(m["attrs"] or m["attrs2"] or ""))
            links += tag == "a"
    flush()
    return out
