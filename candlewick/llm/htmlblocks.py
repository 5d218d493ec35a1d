"""Cutting a web page into leaf blocks: their text and the path of open elements above them.

Block elements cut, inline elements and <br> do not; scripts, styles, titles, templates and comments hold no
text (self-closed ones are empty); text inside objects, frames, formulas and drawings is kept. An unclosed tag at the end of a cut-off page is markup. Character references are decoded and white
space inside a block becomes one space.
"""

from __future__ import annotations

import html as _html
import re

# fixed values of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp
small span strike strong sub sup time tt u var wbr""".split())
EMBEDDED = frozenset("""noscript textarea iframe object svg g path math mfrac mi mn mo mrow ms mspace msqrt mstyle msub msubsup msup
mtext""".split())
INLINE |= EMBEDDED
RAW = "script|style|title|template"
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
# an implied end never reaches past these
BARRIER = frozenset("html body div article section main ul ol dl table tbody thead tfoot nav aside header footer form blockquote figure td".split())
CLOSED_BY_BLOCK = frozenset("""address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4
h5 h6 header hgroup hr main menu nav ol pre section table ul""".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{RAW})(?=[\s/>]|\Z)[^>]*(?:(?<=/)>|>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)"
    r"|<[/!?a-z][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
_ATTR = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def leaf_blocks(html: str) -> list[tuple[str, str]]:
    """(text, path) of each block in page order. A path lists the open elements, outermost first, each as
    tag.word.word of its class, id and role, then the shares of link text (L0..L3) and size (S0..S5)."""
    out: list[tuple[str, str]] = []
    stack: list[tuple[str, str]] = [("", "")]
    links = 0                         # open <a> elements
    parts: list[str] = []
    path, linked, size = "", 0, 0

    def flush() -> None:
        nonlocal parts, linked, size
        if parts:
            text = " ".join(_html.unescape("".join(parts)).split())
            if text:
                n = len(text)
                share = 0 if not linked else 1 if 2 * linked < size else 2 if linked < size else 3
                length = 0 if n < 10 else 1 if n < 30 else 2 if n < 80 else 3 if n < 200 else 4 if n < 600 else 5
                out.append((text, f"{path}|L{share}|S{length}"))
            parts, linked, size = [], 0, 0

    for m in _TOKEN.finditer(html):
        text = m["text"]
        if text is not None:
            if not parts:
                if not text.strip():
                    continue
                path = next((k for t, k in reversed(stack) if t not in INLINE), "")
            parts.append(text)
            n = len(text.strip())
            size += n
            if links:
                linked += n
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            if parts:
                parts.append(" ")
            continue
        inline = tag in INLINE
        if not inline:
            flush()
        if m["end"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    links -= sum(t == "a" for t, _ in stack[i:])
                    del stack[i:]
                    break
                if inline and stack[i][0] not in INLINE:
                    break
            continue
        if tag in VOID:
            continue
        ends = CLOSES.get(tag) or ({"p"} if tag in CLOSED_BY_BLOCK else None)
        if ends:
            for i in range(len(stack) - 1, 0, -1):
                t = stack[i][0]
                if t in ends:
                    links -= sum(x == "a" for x, _ in stack[i:])
                    del stack[i:]
                    break
                if t in BARRIER:
                    break
        if m["attrs"].endswith("/") and (tag in EMBEDDED or not inline and tag not in CLOSED_BY_BLOCK):
            continue
        words = ""
        attrs = m["attrs"]
        if attrs and "=" in attrs:
            words = "".join("." + w.lower() for v in _ATTR.findall(attrs) for w in _NAME.findall(v))
        stack.append((tag, f"{stack[-1][1]}>{tag}{words}"))
        links += tag == "a"
    flush()
    return out
