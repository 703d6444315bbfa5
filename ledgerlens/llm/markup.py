"""Pages as blocks of text under the nodes of their site's style tree.

One pass over a page's tags, forgiving as browsers are: elements that may stay open are
closed by what follows, an end tag without its start is passed over, an unclosed
element ends with its parent. A block is the text between two block-level tags.

The node of an element is a 64-bit hash of its host and of the chain of presentations
(tag, classes, id; numbers of three and more digits as 0) that leads to it, so the elements of all pages of a
host that look alike at the same place are one node. Paragraphs and other flow elements
of one parent are alike; containers without class or id count by their order.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape
from urllib.parse import urlsplit

import xxhash

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark "
    "nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: start tags that end an open paragraph
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li dd dt main menu nav ol p pre "
    "section summary table ul tr td th tbody thead tfoot body".split())
#: elements that a start tag of the same family ends, up to the family's parent
_FAMILY = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
           "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
           "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
           "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
           "option": ({"option"}, {"select", "datalist"})}
_FAMILY["tbody"] = _FAMILY["tfoot"] = _FAMILY["thead"]
_IN_CELL = frozenset("div section center ul ol li dl blockquote form".split())
_SCOPE = frozenset("html body table td th caption button template article section main aside nav "
                   "header footer form".split())
_FLOW = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr pre blockquote figure figcaption dl "
                  "thead tbody tfoot caption hgroup details summary address center".split())

#: presentations that are never the article
NOISE_TAGS = frozenset(
    "head nav footer aside form script style noscript template iframe button select option "
    "textarea dialog menu svg object canvas audio video datalist noembed noframes".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert "
                        "alertdialog dialog menu menubar toolbar tablist status".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar "
    "cookie cookies consent gdpr notice notices banner alert popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social related recommended "
    "recommendations comment comments commentlist disqus reply replies respond widget "
    "pagination pager toolbar search form copyright skip hidden".split())
#: presentations that hold the article, the likeliest first
MAIN_TAGS = {"article": 3, "main": 2}
MAIN_ROLES = {"article": 3, "main": 2}
MAIN_WORDS = frozenset("article post entry story content body text main".split())
MAIN_ALONE = MAIN_WORDS - {"body", "text"}
_WITH = frozenset("has with no without is not".split())
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

DEEPEST = 512  # elements nested deeper belong to the element at this depth
NOISE, HEADER = -1, -2  # a header is noise unless it is the article's own


def host(url: str | None) -> str:
    try:
        return (urlsplit((url or "").strip()).hostname or "").lower()
    except ValueError:
        return ""


@lru_cache(1 << 14)
def _named(name: str) -> int:
    """Rank of a class or id: ``NOISE``, ``HEADER``, 1 (the article) or 0 (says nothing)."""
    parts = [p.lower() for p in _PART.findall(name)]
    if not parts or parts[0] in _WITH:
        return 0
    if parts[0] in NOISE_WORDS or parts[-1] in NOISE_WORDS:
        return NOISE
    if "header" in (parts[0], parts[-1]):
        return HEADER
    return int(all(p in MAIN_WORDS for p in parts) and (len(parts) > 1 or parts[0] in MAIN_ALONE))


@lru_cache(1 << 16)
def presentation(tag: str, attributes: str) -> tuple[str, int, bool]:
    """Signature, rank (``NOISE``, ``HEADER``, 0, or how likely it holds the article)
    and whether it has class or id."""
    found = {}
    if attributes and "=" in attributes or "hidden" in attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            found.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    names = sorted(set(found.get("class", "").split()))
    ident = found.get("id", "").strip()
    sign = re.sub(r"\d{3,}", "0", tag + "".join(f".{n}" for n in names) + (f"#{ident}" if ident else ""))
    role = found.get("role", "").strip().lower()
    if tag in NOISE_TAGS or role in NOISE_ROLES:
        rank = NOISE
    elif ("hidden" in found or found.get("aria-hidden", "").lower() == "true"
          or re.search(r"display\s*:\s*none", found.get("style", ""), re.I)):
        rank = NOISE
    elif tag in ("html", "body"):
        rank = 0
    else:
        ranks = [_named(n) for n in [*names, ident] if n]
        rank = max(MAIN_TAGS.get(tag, 0), MAIN_ROLES.get(role, 0),
                   2 if found.get("itemprop", "").lower() == "articlebody" else 0)
        if NOISE in ranks and (rank < 2 or tag == "article"):
            rank = NOISE  # an article, too: a comment, an advert, a teaser
        elif rank < 2:
            rank = HEADER if tag == "header" or HEADER in ranks else max([rank, *ranks])
    return sign, rank, bool(names or ident)


@dataclass
class _Open:
    tag: str
    node: int  # of the tree, an inline element's is its parent's
    judged: tuple  # nodes from the body down that importance may remove
    rank: int  # the strongest on the way here; NOISE ends it
    block: int  # the same of the nearest block-level element
    kinds: dict = field(default_factory=dict)  # signature of a child -> how many
    last: str = ""


@dataclass
class Block:
    text: str
    judged: tuple
    rank: int


@dataclass
class Page:
    blocks: list[Block]
    #: node -> (hash of the sequence of its children, distinct children)
    tree: dict[int, tuple[int, int]]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def parse(html: str | None, site: str) -> Page:
    """Blocks and tree nodes of one page."""
    html = html or ""
    root = _Open("", xxhash.xxh64_intdigest(site.encode("utf-8", "replace")), (), 0, 0)
    stack = [root]
    blocks: list[Block] = []
    styles: dict[int, int] = {}
    kinds: dict[int, set] = {}
    text: list[str] = []
    deeper: dict[str, int] = {}  # open elements below DEEPEST

    def flush() -> None:
        if text:
            whole = " ".join("".join(text).split())
            text.clear()
            if whole:
                top = stack[-1]
                blocks.append(Block(whole, top.judged, top.block))

    def opened(tag: str, attributes: str) -> _Open:
        top = stack[-1]
        sign, rank, named = presentation(tag, attributes)
        if top.rank == NOISE:
            rank = NOISE
        elif rank == HEADER:
            rank = top.rank if top.rank > 0 else NOISE
        elif rank != NOISE:
            rank = max(rank, top.rank)
        block = top.block if tag in INLINE else rank
        if tag in INLINE:
            return _Open(tag, top.node, top.judged, rank, block)
        if not named and tag not in _FLOW:
            order = top.kinds[sign] = top.kinds.get(sign, 0) + 1
            place = f"{sign}:{order}"
        else:
            place = sign
        node = xxhash.xxh64_intdigest(place.encode("utf-8", "replace"), top.node)
        if top.last != place:
            styles[top.node] = xxhash.xxh64_intdigest(place.encode("utf-8", "replace"),
                                                      styles.get(top.node, 0))
            kinds.setdefault(top.node, set()).add(place)
            top.last = place
        styles.setdefault(node, 0)
        table = tag in ("td", "th", "table")
        judge = (tag not in ("html", "body", "head") and (named or tag not in _FLOW)
                 and rank <= top.rank and not (table and not named and rank > 0))
        return _Open(tag, node, (*top.judged, signed(node)) if judge else top.judged, rank,
                     block)

    def close(tag: str) -> None:
        """Close the innermost open ``tag``, if it is in reach."""
        if deeper.get(tag):
            deeper[tag] -= 1
            return
        for i in range(len(stack) - 1, 0, -1):
            here = stack[i].tag
            if here == tag:
                if tag not in INLINE:
                    flush()
                del stack[i:]
                return
            if (here not in INLINE if tag in INLINE else here in _SCOPE if tag == "p"
                    else here in ("td", "th") and tag in _IN_CELL):
                return

    def add(raw: str) -> None:
        top = stack[-1]
        if top.rank != NOISE:
            text.append(unescape(raw))
        elif top.block == NOISE:
            text.append(raw)  # only its hash and length are used

    def start(tag: str, attributes: str) -> None:
        if tag not in INLINE:
            flush()
            if tag == "body" or tag in _ENDS_P:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == "head":
                        del stack[i:]
                        break
                    if stack[i].tag in _SCOPE and stack[i].tag != "html":
                        break
            if tag in _ENDS_P:
                close("p")
            if tag in _FAMILY:
                same, parents = _FAMILY[tag]
                cut = 0
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in parents:
                        break
                    if stack[i].tag in same:
                        cut = i
                if cut:
                    del stack[cut:]
        if tag in VOID:
            if tag in ("br", "hr"):
                text.append(" ")
            return
        if len(stack) < DEEPEST:
            stack.append(opened(tag, attributes))
        else:
            deeper[tag] = deeper.get(tag, 0) + 1

    at, end = 0, len(html)
    while at < end:
        m = _TAG.search(html, at)
        if m is None:
            break
        if m.start() > at:
            add(html[at:m.start()])
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            if tag not in VOID:
                close(tag)
            elif tag == "br":
                text.append(" ")
        elif m[2]:
            tag = m[2].lower()
            start(tag, m[3])
            if tag in RAW:
                done = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(html, at)
                at = done.start() if done else end
    if at < end:
        add(html[at:])
    flush()
    return Page(blocks, {signed(node): (signed(style), len(kinds.get(node, ())))
                         for node, style in styles.items()})
