"""Blocks of text of one HTML page, with where they stand. Plain string work, no Spark."""

from __future__ import annotations

import html
import re

#: Where a block stands.
FURNITURE, ARTICLE, OPEN = 0, 1, 2

_BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav "
    "ol option p pre section select summary table tbody tfoot thead title tr ul".split()
)
_SPACED = {"br", "td", "th"}
_VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "object", "math"}
_FURNITURE = {"nav", "aside", "footer", "form", "head", "menu", "dialog", "button", "select"}
_NAME = (
    r"(?:ads?|advert[a-z]*|banners?|sponsor[a-z]*|promo[a-z]*|sidebar|side-bar|comments?|replies|"
    r"cookies?|notice|consent|gdpr|popup|modal|menu|nav|navbar|navigation|breadcrumbs?|footer|"
    r"masthead|share|social|related|newsletter|subscribe|widgets?|toolbar|pagination)"
)
#: Parts that say which one of its kind an element is, or that it holds them.
_PLACE = (
    r"(?:site|page|main|primary|secondary|global|top|bottom|left|right|header|container|wrapper|wrap|box|block|"
    r"bar|list|section|area|slot|unit|items?|links?|buttons?|icons?|form|thread|signup|\d+)"
)
#: A whole class or id that names furniture; a modifier as in has-sidebar or category-social does not.
_FURNITURE_NAME = re.compile(
    rf"(?:^|\s)(?:{_PLACE}[_-]+)*{_NAME}(?:[_-]+(?:{_NAME}|{_PLACE}))*(?:$|\s)", re.I
)
_FURNITURE_ROLE = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form"}
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|"
    r"""<(/?)([A-Za-z][^\s/>]*)((?:[^'">]|"[^"]*"|'[^']*')*+|[^>]*)>""",
    re.S,
)


#: What marks an element as furniture.
_BY_CLASS, _BY_TAG = 1, 2


def _is_furniture(tag: str, attributes: str, in_article: bool) -> int:
    """0, or what marks the element. A class never marks an article or main, but one inside another."""
    if tag in _FURNITURE or (tag == "header" and not in_article):
        return _BY_TAG
    if not attributes or tag in ("html", "body", "article", "main") and "class" not in attributes and "id" not in attributes:
        return 0
    named = tag not in ("html", "body") and (in_article or tag not in ("article", "main"))
    mark = 0
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id") and named and _FURNITURE_NAME.search(value):
            mark = _BY_CLASS
        if name == "role" and value.lower() in _FURNITURE_ROLE or name == "hidden":
            return _BY_TAG
    return mark


def blocks(page: str) -> list[tuple[int, str]]:
    """(where, text) of every block with text, in page order.

    Unclosed elements end with their parent; an article inside an unclosed menu
    or page header ends that. Where all articles of a page stand in elements that
    only their class marks as furniture, they are read all the same, unless their
    own class names furniture (a comment). Character references are decoded and
    white space becomes one space.
    """
    out, shut = _blocks(page, False)
    if shut and all(where != ARTICLE for where, _ in out):
        out, _ = _blocks(page, True)
    return out


def _blocks(page: str, reopen: bool) -> tuple[list[tuple[int, str]], bool]:
    """The blocks, and whether an article stands in an element that its class alone marks;
    ``reopen`` takes such an article out of it."""
    shut = False
    out: list[tuple[int, str]] = []
    parts: list[str] = []
    stack: list[tuple[str, int, int]] = []  # open block elements, where text in them stands, and their mark

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append((stack[-1][1] if stack else OPEN, text))
        parts.clear()

    pos, end = 0, len(page)
    while pos < end:
        m = _MARKUP.search(page, pos)
        if m is None:
            parts.append(page[pos:])
            break
        parts.append(page[pos : m.start()])
        pos = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _RAW and not m[1]:
            if not m[3].endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, pos)
                pos = close.end() if close else end
            continue
        if tag in _SPACED:
            parts.append(" ")
        where = stack[-1][1] if stack else OPEN
        if m[1]:
            if tag in _BLOCK:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        furniture = _is_furniture(tag, m[3], where == ARTICLE) if where != FURNITURE else 0
        if tag in _BLOCK or furniture:
            flush()
            if tag in ("article", "main") and where == FURNITURE:
                for k, (name, _, _) in enumerate(stack):
                    if name in ("nav", "header", "head"):
                        del stack[k:]
                        break
                where = stack[-1][1] if stack else OPEN
                if where == FURNITURE and all(mark != _BY_TAG for _, _, mark in stack) and not _is_furniture(tag, m[3], True):
                    shut = True
                    where = OPEN if reopen else FURNITURE
                furniture = _is_furniture(tag, m[3], where == ARTICLE) if where != FURNITURE else 0
            if furniture:
                where = FURNITURE
            elif tag in ("article", "main") and where == OPEN:
                where = ARTICLE
            if tag not in _VOID and not m[3].endswith("/"):
                if tag == "p":  # a paragraph ends an open one
                    for k in range(len(stack) - 1, -1, -1):
                        if stack[k][0] == "p":
                            del stack[k:]
                            break
                        if stack[k][0] in _BLOCK:
                            break
                stack.append((tag, where, furniture))
    flush()
    return out, shut
