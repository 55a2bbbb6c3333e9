"""HTML as a sequence of leaf blocks.

A block is the text between two block-level tags, with inline markup taken
out, character references decoded and white space folded.  Each block keeps
the path of open elements, each as ``tag`` with its class, id and role words.
Works on truncated and malformed pages: an unclosed script, style or comment
ends with the page; an unclosed ``p`` or ``li`` ends where the next begins.
"""

from __future__ import annotations

import html
import re

#: Fixed values of the HTML standard.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr br img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math select option button object canvas".split())
#: An element of these ends an open element of the same group.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "h1": {"p"}, "h2": {"p"}, "h3": {"p"}, "h4": {"p"}, "h5": {"p"}, "h6": {"p"}, "ul": {"p"},
          "ol": {"p"}, "div": {"p"}, "section": {"p"}, "article": {"p"}, "aside": {"p"}, "nav": {"p"}, "footer": {"p"},
          "header": {"p"}, "form": {"p"}, "table": {"p"}, "blockquote": {"p"}, "pre": {"p"}, "main": {"p"}, "figure": {"p"}}
#: Elements beyond which an implied end does not reach.
SCOPES = frozenset("div section article aside nav footer header form table td th ul ol li blockquote main figure body html".split())

TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+>|[^>]*(?:>|\Z))""",
                   re.DOTALL)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.IGNORECASE)
SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORDS = re.compile(r"[a-z]+")


def element(tag: str, attributes: str) -> str:
    """``tag`` and the words of its class, id and role."""
    if "=" not in attributes and "hidden" not in attributes:
        return tag
    words = []
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        value = a or b or c
        words += WORDS.findall(value.lower()) if value else ["hidden"] if name.lower() == "hidden" else []
    return " ".join([tag, *words])


def blocks(page: str) -> list[tuple[tuple[str, ...], str, int]]:
    """(path, text, characters inside links) of each non-empty block, in page order."""
    out: list[tuple[tuple[str, ...], str, int]] = []
    stack: list[str] = []
    tags: list[str] = []
    parts: list[str] = []
    path: tuple[str, ...] | None = None
    linked = 0
    at, n = 0, len(page)

    def flush():
        nonlocal path, linked
        if parts:
            text = "".join(parts)
            if "&" in text:
                text = html.unescape(text)
            text = SPACE.sub(" ", text).strip(" ")
            if text:
                out.append((path or (), text, linked))
            parts.clear()
        path, linked = None, 0

    def take(a, b):
        nonlocal path, linked
        if a < b:
            piece = page[a:b]
            if path is None and not piece.isspace():
                path = tuple(stack)
            if "a" in tags:
                linked += b - a
            parts.append(piece)

    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            take(at, n)
            break
        take(at, m.start())
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag in INLINE:
                if tag in tags and not (SCOPES & set(tags[len(tags) - tags[::-1].index(tag):])):
                    i = len(tags) - 1 - tags[::-1].index(tag)
                    del tags[i], stack[i]
                continue
            flush()
            if tag in tags:
                i = len(tags) - 1 - tags[::-1].index(tag)
                del tags[i:], stack[i:]
            continue
        attributes = m[3]
        if tag in RAW:
            if not attributes.endswith("/>") or tag not in ("svg", "math"):
                end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
                if end:
                    at = end.end()
                elif tag in ("script", "style", "textarea", "title"):
                    at = n
            continue
        if tag in INLINE:
            if tag == "br":
                parts.append(" ")
            elif tag not in VOID:
                stack.append(element(tag, attributes))
                tags.append(tag)
            continue
        flush()
        closes = CLOSES.get(tag)
        if closes:
            for i in range(len(tags) - 1, -1, -1):
                if tags[i] in closes:
                    del tags[i:], stack[i:]
                    break
                if tags[i] in SCOPES:
                    break
        if tag not in VOID:
            stack.append(element(tag, attributes))
            tags.append(tag)
    flush()
    return out
