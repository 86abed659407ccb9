"""Text blocks of one HTML page, with what the markup says about each."""

from __future__ import annotations

import html
import re

MAIN, OPEN, CHROME = 0, 1, 2
# An article whose class names it a part around the article; what it is shows at the page's end.
_DOUBT = 3

BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu
nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their content is text up to their own end tag, and none of it is shown as part of the article.
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
DROPPED = frozenset("""aside audio button canvas dialog footer form menu nav noscript object search select svg template
video""".split())
# Class names and ids that name parts around an article; a compound does if all its words are of this set or of BESIDE.
AROUND = frozenset("""ad ads adv advert advertisement adverts adsense banner breadcrumb breadcrumbs comment comments
consent cookie cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices
overlay pagination popup promo promoted promotion recommended related replies reply respond search share sharing
sidebar sidebars signup skip social sponsor sponsored subscribe subscription teaser toolbar widget widgets""".split())
BESIDE = frozenset("""area author banner bar block body bottom box button buttons container content count form group header heading holder icon icons
inner item items left link links list main message meta outer page panel post posts region right section site slot text thread
title top unit user users wp wrap wrapper zone""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# No class or id closes these; ids of TITLED are made from titles and name no part.
WHOLE = frozenset("html body main".split())
TITLED = HEADINGS | frozenset("article p section".split())
ROLES_AROUND = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
INNER = frozenset("article main".split())

# An element of these ends where one of the second set begins, unless one of the third lies in between.
_ITEMS, _CELLS = frozenset("ul ol menu table td th".split()), frozenset(["table"])
_ENDS = {"li": (frozenset(["li"]), _ITEMS), "option": (frozenset(["option", "optgroup"]), frozenset(["select"]))}
_ENDS |= {x: (frozenset(["dt", "dd"]), _ITEMS | {"dl"}) for x in ("dt", "dd")}
_ENDS |= {x: (frozenset("td th tr thead tbody tfoot".split()), _CELLS) for x in ("td", "th")}
_ENDS |= {"tr": (frozenset("tr thead tbody tfoot".split()), _CELLS)}
_ENDS |= {x: (frozenset("thead tbody tfoot".split()), _CELLS) for x in ("thead", "tbody", "tfoot")}
_HELD = frozenset("div section header span ul ol menu dl table select".split()) | frozenset(_ENDS)

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]+|\"[^\"]*\"|'[^']*')*+(?:>|\Z)|[^>]*(?:>|\Z))", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b")


def _names(value: str, known: frozenset[str]) -> bool:
    """Is a class name or id made of known words only, but for BESIDE and numbers?"""
    parts = [x for x in re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower()) if x and not x.isdigit()]
    return any(x in known for x in parts) and all(x in known or x in BESIDE for x in parts)


_STARTS = {n: _ENDS[n][1] if n in _ENDS else frozenset(["select"]) for ends, _ in _ENDS.values() for n in ends}


def _ended(stack: list[tuple[str, int]], name: str) -> int:
    """How many elements stay open where an element ``name`` begins: those that need no end tag end before it."""
    stay = len(stack)
    if stack and stack[-1][0] == "p" and name in BLOCK:
        stay -= 1
    for k in range(stay - 1, -1, -1) if name in _STARTS else ():
        if stack[k][0] in _ENDS and name in _ENDS[stack[k][0]][0]:
            stay = k
        elif stack[k][0] in _STARTS[name]:
            break
    return stay


_HEADER = frozenset(["header"])


def _kind(name: str, rest: str, inside_main: bool) -> int:
    """What an element says about its content; OPEN if nothing."""
    if name in DROPPED:
        return CHROME
    classes: list[str] = []
    role = prop = own_id = ""
    if len(rest) > 1:
        for m in _ATTRIBUTE.finditer(rest):
            key, value = (m[1] or "").lower(), m[2] or m[3] or m[4] or ""
            if m[5] or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value)):
                return CHROME
            if key == "class":
                classes += value.split()
            elif key == "id":
                own_id = value
            elif key == "role":
                role = value.lower()
            elif key == "itemprop":
                prop = value.lower()
    if role in ROLES_AROUND or name == "header" and not inside_main:
        return CHROME
    inner = name in INNER or role in INNER or prop == "articlebody"
    if name not in WHOLE:
        names = classes if name in TITLED or "section" in classes else [*classes, own_id]
        if any(_names(x, AROUND) for x in names):
            return _DOUBT if inner else CHROME
        if not inner and not inside_main and name not in HEADINGS and any(_names(x, _HEADER) for x in names):
            return CHROME
    return MAIN if inner else OPEN


def blocks(page: str) -> list[tuple[int, str]]:
    """(kind, text) of the page's blocks in order: character references decoded, white space runs as one space, trimmed.

    Elements such as navigation, forms and asides, and elements whose class, id or role names such a part, are
    CHROME with all they hold; ``article`` and ``main`` hold MAIN text.  Where a page marks its main text, all text
    outside is CHROME; a page that does not has OPEN text, except for blocks that are two or more links only.
    An article whose class names a part around it goes only where the page has another; where nothing else is
    marked it is OPEN like the rest.
    Broken markup is taken as it comes: an end tag closes the innermost element of its name or nothing.  List items,
    terms, cells, rows, options and paragraphs end without an end tag where the next one begins.
    """
    out: list[list] = []
    stack: list[tuple[str, int]] = []
    chrome = main = doubt = links = anchors = articles = 0
    text: list[str] = []
    linked = 0

    def flush():
        nonlocal linked, anchors
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            if joined:
                kind = CHROME if chrome else _DOUBT if doubt else MAIN if main else OPEN
                out.append([kind, joined, anchors > 1 and linked >= sum(map(len, text)) - sum(x.isspace() and len(x) for x in text)])
            text.clear()
            linked = anchors = 0

    at, end = 0, len(page)
    while at < end:
        token = _TOKEN.search(page, at)
        stop = token.start() if token else end
        if stop > at:
            piece = page[at:stop]
            text.append(piece)
            if links and not piece.isspace():
                linked += len(piece)
                anchors += links == 1
                links = 2
        if token is None:
            break
        at = token.end()
        name = token[2]
        if name is None:
            continue
        name = name.lower()
        if token[1]:
            if name == "a":
                links = 0
            if name in BLOCK:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if name not in BLOCK and any(s[1] != OPEN for s in stack[k:]):
                        flush()
                    for _, kind in stack[k:]:
                        chrome -= kind == CHROME
                        main -= kind == MAIN
                        doubt -= kind == _DOUBT
                    del stack[k:]
                    break
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = close.start() if close else end
            if name in BLOCK:
                flush()
            continue
        if name == "br":
            text.append(" ")
            continue
        if name == "a":
            links = 1
        if name in BLOCK:
            flush()
        if name in VOID or token[3].endswith("/>") and name not in BLOCK:
            continue
        stay = _ended(stack, name)
        for _, kind in stack[stay:]:
            chrome -= kind == CHROME
            main -= kind == MAIN
            doubt -= kind == _DOUBT
        del stack[stay:]
        kind = _kind(name, token[3], main > 0)
        if kind != OPEN and name not in BLOCK:
            flush()
        if kind != OPEN or name in _HELD:
            stack.append((name, kind))
            chrome += kind == CHROME
            main += kind == MAIN
            doubt += kind == _DOUBT
        articles += name == "article"
    flush()
    marked = any(b[0] == MAIN for b in out)
    unsure = OPEN if not marked else MAIN if articles == 1 else CHROME
    out = [(unsure if k == _DOUBT else k, t, only_links) for k, t, only_links in out]
    return [(CHROME if k == OPEN and (marked or only_links) else k, t) for k, t, only_links in out]
