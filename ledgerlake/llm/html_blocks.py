"""Blocks of a web page: its text cut at block elements, with what the markup says about each.

A tolerant reader of HTML: unclosed and stray tags, quoted attributes, comments, raw
text (scripts, styles) and a page that ends inside a tag or comment are read as browsers do.
It keeps no tree; a block carries the few facts about its place that labelling needs.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass
from typing import NamedTuple

# Element kinds of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("iframe noembed noframes script style textarea title xmp".split())
SKIPPED = RAW | set("audio button canvas datalist head noscript object optgroup option select svg template video".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
# An element that ends an open one of its kind, and what that one lies in.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"})}
# Words in names of elements that are not the article, and of those that are.
BOILER_TAGS = {"nav", "footer", "aside", "menu", "dialog", "search"}
FORM_TAGS = {"form", "fieldset", "label", "legend"}
BOILER_ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
BOILER_NAMES = set(
    "ad ads adsense advert advertisement advertising adverts alert aside banner breadcrumb breadcrumbs comment commentlist comments consent cookie cookies copyright discussion "
    "disqus feedback foot footer gdpr legal login masthead menu menubar modal nav navbar navigation newsletter notice notification outbrain pager paging pagination popup promo "
    "promotion recommended related replies reply respond search share sharing sidebar signin signup sitemap social sponsor sponsored subscribe subscription taboola toc toolbar "
    "topbar trending widget widgets".split()
)
HEADER_NAMES = {"header"}
CONTENT_NAMES = set("article articlebody body content entry hentry main markdown post prose story text".split())

NONE, CONTENT, WEAK, STRONG = 0, 1, 2, 3  # what the nearest marking element says of a block

_TOKEN = re.compile(
    r"(?P<text>[^<]+)"
    r"|(?P<comment><!--(?:-?>|.*?(?:--!?>|\Z)))"
    r"|(?P<other><(?:[!?]|/(?![a-zA-Z]))[^>]*(?:>|\Z))"
    r"""|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+)(?P<end>>|\Z)"""
    r"|(?P<sign><)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]*+))|(?=[\s/]|\Z))""", re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])|\Z", re.IGNORECASE) for name in RAW}


@dataclass
class Block:
    text: str
    state: int  # NONE, CONTENT, WEAK or STRONG
    tag: str
    container: int  # number of the element around the block's own
    outer: int  # and around that
    distance: int  # steps in the tree from the block before
    linked: int  # characters of raw text inside links
    raw: int  # characters of raw text


class _Open(NamedTuple):
    name: str
    state: int
    skipped: bool
    depth: int  # of the block element it is or lies in
    tag: str
    element: int
    container: int
    outer: int


def _state(name: str, attrs: str, above: int) -> tuple[int, bool]:
    """What an element says of its text, given what the one around it says; and whether it is hidden."""
    said = WEAK if name in FORM_TAGS or name == "header" else STRONG if name in BOILER_TAGS else CONTENT if name in ("article", "main") else NONE
    hidden = False
    if attrs and name not in ("html", "body"):
        names: set[str] = set()
        for key, *values in _ATTRIBUTE.findall(attrs):
            key, value = key.lower(), next((v for v in values if v), "")
            if key in ("class", "id"):
                names.update(w.lower() for w in _WORDS.findall(value))
            elif key == "role":
                role = value.strip().lower()
                said = STRONG if role in BOILER_ROLES else CONTENT if role in ("main", "article") and said == NONE else said
            elif key == "style":
                hidden |= "display:none" in re.sub(r"\s", "", value.lower())
            else:
                hidden |= key == "hidden" or value.lower() == "true"
        if names & BOILER_NAMES:
            said = STRONG
        elif said == NONE and names & CONTENT_NAMES:
            said = CONTENT
        elif said == NONE and names & HEADER_NAMES:
            said = WEAK
    if said == CONTENT:
        # an article in a sidebar, or one that is a comment, is none; only <main> opens anew
        return (CONTENT if above != STRONG or name == "main" else above), hidden
    if said == WEAK:
        # the heading part of an article belongs to it, a form in it does not
        return (above if above == STRONG or (above == CONTENT and name not in FORM_TAGS) else STRONG if above == CONTENT else WEAK), hidden
    return max(said, above) if said == STRONG else above, hidden


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in page order; text that is never shown is left out."""
    out: list[Block] = []
    # open elements: name, state, whether their text is left out, and the block element they are or lie in
    stack = [_Open("", NONE, False, 0, "", 0, 0, 0)]
    open_ = Counter()
    numbered, low, pieces, linked, raw, last_depth = 0, 1, [], 0, 0, 0

    def flush() -> None:
        nonlocal pieces, linked, raw, low, last_depth
        text = " ".join("".join(pieces).split())
        if text:
            top = stack[-1]
            low = min(low, top.depth + 1)
            out.append(Block(text, top.state, top.tag, top.container, top.outer, max(last_depth - low, 0) + top.depth + 1 - low, linked, raw))
            low = last_depth = top.depth + 1
        pieces, linked, raw = [], 0, 0

    def close(k: int) -> None:
        nonlocal low
        for e in stack[k:]:
            open_[e.name] -= 1
        del stack[k:]
        low = min(low, len(stack))

    def nearest(names: set[str], until: set[str]) -> int:
        """Place in the stack of the nearest open one of ``names``, not beyond one of ``until``; 0 if none."""
        if any(open_[n] > 0 for n in names):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name in names:
                    return k
                if stack[k].name in until:
                    break
        return 0

    at, end = 0, len(page)
    while at < end:
        token = _TOKEN.match(page, at)
        at = token.end()
        if token["text"] is not None or token["sign"]:
            if not stack[-1].skipped:
                text = html.unescape(token[0])
                pieces.append(text)
                raw += len(text)
                linked += len(text) if open_["a"] > 0 else 0
            continue
        name = (token["name"] or "").lower()
        if not name or not token["end"]:
            continue
        block = name in BLOCK
        if name == "br":
            pieces.append("\n")
            continue
        if block:
            flush()
        if token["close"]:
            # an inline end does not close the blocks around its text
            if k := nearest({name}, set() if block else BLOCK):
                close(k)
            continue
        if block and (k := nearest({"p"}, BLOCK - {"p"})):
            close(k)
        if name in ENDS and (k := nearest(*ENDS[name])):
            close(k)
        if name in VOID:
            continue
        top = stack[-1]
        state, hidden = _state(name, token["attrs"], top.state)
        numbered += 1
        place = (len(stack), name, numbered, top.element, top.container) if block else top[3:]
        stack.append(_Open(name, state, top.skipped or hidden or name in SKIPPED, *place))
        open_[name] += 1
        if name in RAW:
            at = _RAW_END[name].search(page, at).start()
    flush()
    return out
