"""Leaf blocks of HTML pages: runs of text between block-level tags, with what encloses them."""

from __future__ import annotations

import html as references
import re
from collections import Counter
from dataclasses import dataclass

BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td"
    " tfoot th thead title tr ul".split()
)
#: Raw text that is no text of the page; an unclosed one takes the rest.
RAW = frozenset("script style textarea".split())
#: Their text is read like any other, and marked.
EMBEDDED = frozenset("noscript template iframe object svg math canvas audio video".split())
#: What can stand in a head, beside its title and raw text.
IN_HEAD = frozenset("html head meta link base basefont bgsound noscript template noframes".split())
IN_SELECT = frozenset("option optgroup hr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

#: Names in class, id and role, by what they say of an element.
HINTS: dict[str, str] = {
    word: kind
    for kind, words in {
        "ad": "ad ads adbox advert advertisement adverts banner dfp promo promoted promotion sponsor sponsored",
        "menu": "breadcrumb breadcrumbs crumbs menu menubar nav navbar navigation navlist pager pagination tabs toc topnav",
        "side": "aside complementary popular rail recommended recommendations related sidebar side teaser trending widget widgets",
        "head": "banner header masthead topbar toolbar sitehead",
        "foot": "contentinfo copyright foot footer imprint legal",
        "comment": "comment commentlist comments disqus discussion feedback replies reply respond responses reviews thread",
        "notice": "alert consent cookie cookies gdpr modal newsletter notice notification overlay paywall popup signup subscribe",
        "share": "byline follow meta share sharing social tags toolbar",
        "form": "contact form login register search searchform",
        "main": "article articlebody body content entry main post postbody prose story text",
    }.items()
    for word in words.split()
}
KINDS = ("ad", "menu", "side", "head", "foot", "comment", "notice", "share", "form", "main")
TAGS = ("nav", "header", "footer", "aside", "article", "main", "form", "section", "ul", "ol", "dl", "li", "table", "td", "blockquote", "pre", "figure", "a")

_NEXT = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)|[!?])")
_REST = re.compile(r"""[^"'>]*(?:(?:"[^"]*"|'[^']*')[^"'>]*)*>""")
_NAMES = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile(r"[a-z]+")
_RAW_END = {tag: re.compile(rf"</{tag}\b", re.I) for tag in RAW}
_TITLE_END = re.compile(r"</title\b|</head\b|<body\b", re.I)


@dataclass
class Block:
    text: str
    tag: str
    inside: tuple[str, ...]  # tags and hint kinds that enclose it
    links: int  # characters in links


def _hints(attributes: str) -> list[str]:
    if "=" not in attributes:
        return []
    found = []
    for value in _NAMES.findall(attributes):
        found += [HINTS[w] for w in _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()) if w in HINTS]
    return [f".{kind}" for kind in set(found)]


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order; work grows with the length of the page.

    Comments and raw elements are skipped, an unclosed one to the end.  A head ends where
    something begins that cannot stand in it, a select likewise.  White space in a block
    is one space; blocks without other text are left out.
    """
    out: list[Block] = []
    stack: list[tuple[str, list[str]]] = []
    open_tags: Counter[str] = Counter()
    around: Counter[str] = Counter()
    parts: list[str] = []
    links = 0
    in_head = head_seen = False
    within = ""  # an element of the head that is not on the stack
    titles_end = True  # whether a title may still find its end
    plain_ends = False  # after an unpaired quote the first ">" ends a tag

    def flush() -> None:
        nonlocal links
        text = " ".join("".join(parts).split())
        if text:
            nearest = next((tag for tag, _ in reversed(stack) if tag in BLOCK_TAGS), "body")
            out.append(Block(text, nearest, tuple(k for k, n in around.items() if n > 0), links))
        parts.clear()
        links = 0

    def close(tag: str) -> None:
        while stack:
            name, marks = stack.pop()
            open_tags[name] -= 1
            for mark in marks:
                around[mark] -= 1
            if name == tag:
                return

    at, size = 0, len(page)
    while at < size:
        found = _NEXT.search(page, at)
        text = page[at : found.start() if found else size]
        if text and in_head:
            in_head = not text.strip()
        if text and not in_head:
            text = references.unescape(text)
            parts.append(text)
            if open_tags["a"] > 0:
                links += len(text.strip())
        if not found:
            break
        if found[1]:
            # "<!-->" and "<!--->" are whole comments.
            end = page.find("-->", found.end() - 2)
            at = size if end < 0 else end + 3
            continue
        ended = None if plain_ends else _REST.match(page, found.end())
        if ended:
            at = ended.end()
        else:
            plain_ends = plain_ends or '"' in page[found.end() : found.end() + 1_000] or "'" in page[found.end() : found.end() + 1_000]
            at = page.find(">", found.end()) + 1 or size
        tag = (found[3] or "").lower()
        if not tag:
            continue
        if found[2]:
            if tag == within:
                within = ""
            if tag == "head":
                in_head = False
            if tag in BLOCK_TAGS and not (tag == "title" and open_tags["svg"] > 0):
                flush()
            if open_tags[tag] > 0:
                if tag in EMBEDDED and next(name for name, _ in reversed(stack) if name == tag or name in BLOCK_TAGS) != tag:
                    flush()
                close(tag)
            continue
        if tag in RAW:
            end = _RAW_END[tag].search(page, at)
            at = page.find(">", end.end()) + 1 or size if end else size
            continue
        if tag == "head":
            if not head_seen:
                flush()
                in_head = head_seen = True
            continue
        if in_head:
            if tag == "title":
                end = _TITLE_END.search(page, at) if titles_end else None
                titles_end = end is not None
                if end:
                    at = page.find(">", end.end()) + 1 or size if end[0].startswith("</t") or end[0].startswith("</T") else end.start()
                else:
                    at = page.find("<", at)
                    at = size if at < 0 else at
                continue
            if tag in IN_HEAD or within == "noscript" and tag in ("img", "iframe"):
                within = tag if tag in ("noscript", "template") else within
                continue
            in_head = False
        if open_tags["select"] > 0 and tag in BLOCK_TAGS and tag not in IN_SELECT:
            flush()
            close("select")
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK_TAGS and not (tag == "title" and open_tags["svg"] > 0):
            flush()
            for implied in ("p", "li" if tag == "li" else "", "option" if tag == "option" else ""):
                if implied and open_tags[implied] > 0 and _closable(stack, implied):
                    close(implied)
        if tag in VOID or page[at - 2 : at] == "/>" and tag not in BLOCK_TAGS:
            continue
        marks = [tag] if tag in TAGS else ["embedded"] if tag in EMBEDDED else ["form"] if tag == "select" else []
        marks += _hints(page[found.end() : at])
        for mark in marks:
            around[mark] += 1
        open_tags[tag] += 1
        stack.append((tag, marks))
    flush()
    return out


def _closable(stack: list[tuple[str, list[str]]], tag: str) -> bool:
    """Whether the innermost block element is of this tag."""
    for name, _ in reversed(stack):
        if name == tag:
            return True
        if name in BLOCK_TAGS:
            return False
    return False
