"""Leaf blocks of an HTML page: text runs between block-level tags, each with
what its ancestors are. Tolerant of unclosed and misnested tags; linear in the
page's length."""

from __future__ import annotations

import re
from html import unescape

# Element names by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
SKIP = frozenset("head template svg math object select button datalist canvas audio video map"
                 .split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output"
    " q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table"
    " ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
        "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LIMITS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"},
          "td": {"table"}, "th": {"table"}, "option": {"select"}}
ANCESTORS = frozenset(
    "article main section nav header footer aside form ul ol li table td th p h1 h2 h3 h4 h5 h6"
    " div blockquote pre figure figcaption dl dt dd address details dialog fieldset menu"
    " body".split())

# Words in class, id and role attributes, by what they tell.
KEYS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs topnav tabs pagination pager"
            " skip toc",
    "header": "header masthead topbar logo branding siteheader banner",
    "footer": "footer copyright legal colophon bottom sitefooter contentinfo",
    "side": "sidebar aside side rail widget widgets complementary secondary",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay warning privacy"
              " announcement dialog toast disclaimer",
    "ad": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion"
          " promoted adsense dfp outbrain taboola",
    "comment": "comment comments reply replies discussion disqus respond commentlist thread"
               " feedback reader",
    "share": "share sharing social follow tweet facebook",
    "related": "related recommended recommendations popular trending readmore further teaser",
    "form": "login signin signup register subscribe subscription newsletter search searchform form"
            " optin",
    "meta": "byline author date meta tags timestamp published category",
    "content": "content article post entry story body main text maincontent articlebody prose"
               " hentry",
}
KEY_OF = {word: group for group, words in KEYS.items() for word in words.split()}

_NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
_ATTR = re.compile(r"""([A-Za-z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_KEYS_OF: dict[str, tuple[str, ...]] = {}


def keys_of(attrs: str) -> tuple[str, ...]:
    """Groups of KEYS that a tag's class, id and role name, and ``hidden``."""
    found = _KEYS_OF.get(attrs)
    if found is None:
        groups = set()
        for name, a, b, c in _ATTR.findall(attrs):
            name, value = name.lower(), a or b or c
            if name in ("class", "id", "role", "aria-label"):
                words = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower()
                for word in _SPLIT.split(words):
                    if word in KEY_OF:
                        groups.add(KEY_OF[word])
            elif name == "style" and _HIDDEN.search(value):
                groups.add("hidden")
        if re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", attrs):
            groups.add("hidden")
        if len(_KEYS_OF) > 50_000:
            _KEYS_OF.clear()
        found = _KEYS_OF[attrs] = tuple(sorted(groups))
    return found


# What follows a tag's name up to its end. A quote opens a value only behind an
# equals sign, and only if it is closed; any other stands for itself.
_TAG_REST = re.compile(r"""(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+>""")


def _tag_end(html: str, at: int) -> int:
    """Position of the > that ends the tag at ``at``, quotes respected; -1 if
    there is none."""
    m = _TAG_REST.match(html, at)
    return m.end() - 1 if m else -1


class Block:
    __slots__ = ("text", "path", "link_chars")

    def __init__(self, text: str, path: tuple, link_chars: int):
        self.text, self.path, self.link_chars = text, path, link_chars


def parse(html: str) -> tuple[str, list[Block]]:
    """(title, blocks in page order). A block's path is its open elements,
    outermost first, as (tag, keys), without inline ones."""
    blocks: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    text: list[str] = []
    title = ""
    skip = links = link_chars = 0
    pos, n = 0, len(html)
    low = None

    def flush():
        nonlocal link_chars
        if text:
            joined = " ".join(unescape("".join(text)).split())
            text.clear()
            if joined:
                blocks.append(Block(joined, tuple(x for x in stack if x[0] not in INLINE),
                                    link_chars))
            link_chars = 0

    def pop_to(depth: int):
        nonlocal skip, links
        while len(stack) > depth:
            tag = stack.pop()[0]
            skip -= tag in SKIP
            links -= tag == "a"

    while pos < n:
        lt = html.find("<", pos)
        if lt < 0:
            lt = n
        if lt > pos and not skip:
            piece = html[pos:lt]
            text.append(piece)
            if links:
                link_chars += len(piece)
        if lt >= n:
            break
        nxt = html[lt + 1:lt + 2]
        if nxt == "!" or nxt == "?":
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 4)
                pos = n if end < 0 else end + 3
            else:
                end = html.find(">", lt)
                pos = n if end < 0 else end + 1
            continue
        m = _NAME.match(html, lt)
        if not m:
            if not skip:
                text.append("<" if nxt != "/" else "")
            if nxt == "/":
                end = html.find(">", lt)
                pos = n if end < 0 else end + 1
            else:
                pos = lt + 1
            continue
        gt = _tag_end(html, m.end())
        if gt < 0:
            break  # an unfinished tag at the end of the page
        tag = m[1].lower()
        pos = gt + 1
        if nxt == "/":
            if tag == "br":
                text.append(" ")
                continue
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    break
                if tag in INLINE and stack[depth][0] not in INLINE:
                    depth = -1
                    break
            else:
                depth = -1
            if tag not in INLINE:
                flush()
            if depth >= 0:
                pop_to(depth)
            continue
        if tag in VOID:
            if tag == "br":
                text.append(" ")
            elif tag == "hr":
                flush()
            continue
        if tag in RAW:
            if low is None:
                low = html.lower()
                if len(low) != n:  # some letters change length
                    low = re.sub("[A-Z]", lambda x: x[0].lower(), html)
            end = low.find("</" + tag, pos)
            if tag == "title" and not title and "svg" not in (s[0] for s in stack):
                title = " ".join(unescape(html[pos:end if end >= 0 else n]).split())
            end = -1 if end < 0 else html.find(">", end)
            pos = n if end < 0 else end + 1
            if tag == "textarea":
                flush()
            continue
        if tag == "body" and skip:  # a head that was never closed
            pop_to(next((i for i, x in enumerate(stack) if x[0] == "head"), len(stack)))
        if tag not in INLINE:
            flush()
            if tag in CLOSES_P or tag in SAME:
                ends = {"p"} if tag in CLOSES_P else set()
                ends |= SAME.get(tag, set())
                limit = LIMITS.get(tag, set())
                for depth in range(len(stack) - 1, -1, -1):
                    name = stack[depth][0]
                    if name in ends:
                        pop_to(depth)
                        break
                    if name in limit or (name not in INLINE and not limit):
                        break
        if html[gt - 1] != "/" or tag not in ("svg", "math"):
            stack.append((tag, keys_of(html[m.end():gt])))
            skip += tag in SKIP
            links += tag == "a"
            if len(stack) > 2000:  # nested without end: what is deepest goes
                pop_to(1000)
    flush()
    return title, blocks
