"""One page's elements, blocks of text and containers, from tolerant reading of its HTML.

A page is read once from left to right. Elements that are boilerplate by tag, role or name (menus,
headers, footers, sidebars, notices, adverts, forms, comments) are marked as dropped together with
what they hold; the rest is text in blocks, each in its element. Small helpers for ``extract``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import xxhash

#: Elements whose content is no text of the page, or no markup.
RAW = frozenset("script style noscript template textarea title iframe svg math object select button canvas audio video noembed noframes xmp".split())
#: A comment, a declaration, or a tag; the possessive parts keep the reading linear, also with quotes that nothing closes.
_TOKEN = re.compile(r"<(?:!--.*?(?:-->|\Z)|(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+[^>]*+)>|[!?/][^>]*>)", re.S)
_RAW_END = {t: re.compile(rf"</{t}\s*>|\Z", re.I) for t in RAW}
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
#: Whether attributes say something about what an element is.
_SPEAKS = re.compile(r"class|id\b|role|style|hidden|itemprop", re.I).search
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")

#: Three digits and more, or a number of its own behind a word, but for a grid's.
_COUNTS = re.compile(r"[0-9]{3,}|(?<=[-_])(?<!col-)(?<!col-xs-)(?<!col-sm-)(?<!col-md-)(?<!col-lg-)(?<!col-xl-)(?<!span-)(?<!grid-)(?<!column-)(?<!w-)[0-9]+(?![0-9A-Za-z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold an article or part of a page.
CONTAINERS = frozenset("html body main article section div td center form fieldset figure blockquote details dialog header hgroup table tbody tr ul ol dl".split())
#: Which open elements a start tag ends, and the elements behind which it doesn't look for them.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_WALLS = frozenset("div article section main body html table ul ol dl blockquote aside nav header footer form figure center".split())
_LIST_WALLS = {"li": frozenset("ul ol div article section".split()), "tr": frozenset(["table"]), "td": frozenset(["table"]), "th": frozenset(["table"])}
_ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())

#: Boilerplate by tag, by role and by a word of the class or id.
DROP_TAGS = frozenset("nav aside footer header form menu dialog fieldset".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split())
DROP_NAMES = frozenset("""
ad ads adbox adslot adsense adsbygoogle adunit advert adverts advertisement advertising advertorial sponsor sponsored sponsors promo promos promoted promotion outbrain taboola dfp
nav navbar navi navigation menu menus submenu breadcrumb breadcrumbs crumbs masthead topbar toolbar header footer foot colophon copyright sitemap skip
sidebar sidebars aside rail widget widgets blogroll tagcloud related recommended recommendations trending popular
cookie cookies consent gdpr ccpa notice notices alert alerts banner popup modal overlay lightbox paywall toast disclaimer disclosure
newsletter subscribe subscription signup signin login register optin search searchbox form forms
share sharing sharebar social socials follow addthis
comment comments commentlist commentform disqus respond responses reactions replies reply discussion talkback livefyre
pagination pager pagenav paging
""".split())
#: The same in words written together, such as sitefooter, cookiebar or relatedposts.
_COMPOUND = re.compile(
    r"(?:site|page|main|top|side|left|right|sub|global|primary|secondary|footer|header|bottom|mobile|user|reader|post|article)?"
    r"(?:nav|navbar|menu|footer|sidebar|comments?|cookies?|adverts?|ads?|banner|newsletter|social|share|promo|related)"
    r"(?:bar|box|list|links?|section|wrap|wrapper|container|area|block|panel|form|widget|posts|articles|banner|notice|s)?|(?:site|page|top)header")
#: Words that make a header one of the article, and a word in front of a name that only tells of it.
_OF_ARTICLE = frozenset("post entry article story content page title headline".split())
_TELLS = frozenset("has with no without show is".split())
#: Names of a whole article, alone as a class or id.
WHOLE_NAMES = frozenset("article post entry hentry story blogpost".split())
#: Container names that speak for an article.
GOOD_NAMES = frozenset("article articles body content contents entry hentry main post posts story text prose page column blog news".split())
_KEEP = frozenset(["article", "main", "html", "body"])


@dataclass(slots=True)
class Element:
    """An element: its parent's index, tag, the generalised tag-class step, the hash of the path that ends with it, and what it is."""

    up: int
    tag: str
    step: str
    path: int
    dropped: bool
    bonus: float
    weak: bool = False
    #: weight of the text that belongs to it as a container
    score: float = 0.0


@dataclass(slots=True)
class Page:
    elements: list[Element] = field(default_factory=list)
    #: (element, text, characters of it inside links)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)

    def steps(self, k: int) -> str:
        """The generalised path of an element: tags with classes from the root down."""
        out = []
        while k > 0:
            out.append(self.elements[k].step)
            k = self.elements[k].up
        return "/".join(reversed(out))

    def inside(self, k: int, top: int) -> bool:
        while k > top:
            k = self.elements[k].up
        return k == top


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(text)}


def names_of(attrs: dict[str, str]) -> list[list[str]]:
    """The words of each class and of the id."""
    return [[w.lower() for w in _NAME.findall(x)] for x in [*attrs.get("class", "").split(), *([attrs["id"]] if attrs.get("id") else [])]]


def _general(tag: str, attrs: dict[str, str]) -> str:
    """The tag with its classes and id; numbers that count pages are #, those that tell columns or short names apart stay."""
    shape = lambda s: _COUNTS.sub("#", s)
    kinds = sorted({shape(c) for c in attrs.get("class", "").split()})
    return tag + "".join(f".{c}" for c in kinds) + (f"#{shape(attrs['id'])}" if attrs.get("id") else "")


def _by_name(names: list[list[str]]) -> bool:
    for words in names:
        if words and words[0] in _TELLS:
            continue
        hit = {w for w in words if w in DROP_NAMES or _COMPOUND.fullmatch(w)}
        if hit and not (hit <= {"header", "banner"} and _OF_ARTICLE.intersection(words)):
            return True
    return False


#: What an article's element, one named so, main and a name that speaks for an article raise a score by.
ARTICLE, WHOLE, MAIN, NAMED = 4.0, 2.0, 1.8, 1.25


@lru_cache(maxsize=1 << 14)
def _judged(tag: str, text: str, in_article: bool) -> tuple[bool, bool, float, str]:
    """(dropped, weakly: unless an article lies inside, score bonus, generalised step) of a start tag with these attributes."""
    attrs = _attributes(text)
    return *_kind(tag, attrs, in_article), tag if tag in INLINE else _general(tag, attrs)


def _kind(tag: str, attrs: dict[str, str], in_article: bool) -> tuple[bool, bool, float]:
    role = attrs.get("role", "").lower()
    style = attrs.get("style", "").lower().replace(" ", "")
    if "hidden" in attrs or "display:none" in style or "visibility:hidden" in style:
        return True, False, 1.0
    names = names_of(attrs)
    comment = any({"comment", "comments", "reply", "replies"}.intersection(w) for w in names)
    if tag in _KEEP and not (tag == "article" and comment):
        dropped = False
    else:
        of_article = tag == "header" and (in_article or any(_OF_ARTICLE.intersection(w) for w in names))
        dropped = (tag in DROP_TAGS and not of_article) or role in DROP_ROLES or _by_name(names)
    if tag == "article" or role == "article" or "articlebody" in attrs.get("itemprop", "").lower():
        bonus = ARTICLE
    elif any(len(w) == 1 and w[0] in WHOLE_NAMES for w in names):
        bonus = WHOLE
    elif tag == "main" or role == "main":
        bonus = MAIN
    else:
        bonus = NAMED if any(GOOD_NAMES.intersection(w) for w in names) else 1.0
    return dropped, True, bonus


def read(html: str) -> Page:
    """The page's elements and its blocks of text, dropped ones without text."""
    page = Page([Element(-1, "", "", 0, False, 0.8)])
    els, stack, open_ = page.elements, [0], {}
    buffer: list[str] = []
    linked = 0
    holder = 0
    links = articles = 0
    at, find = 0, _TOKEN.search

    def flush() -> None:
        nonlocal linked, holder
        if buffer:
            text = " ".join(unescape("".join(buffer)).split())
            if text:
                page.blocks.append((holder, text, min(linked, len(text))))
            buffer.clear()
        linked = 0

    def pop(to: int) -> None:
        nonlocal links, articles
        while len(stack) > to:
            e = els[stack.pop()]
            open_[e.tag] -= 1
            links -= e.tag == "a"
            articles -= e.tag in ("article", "main")

    def close(names, walls) -> None:
        for i in range(len(stack) - 1, 0, -1):
            t = els[stack[i]].tag
            if t in names:
                flush()
                pop(i)
                return
            if t in walls:
                return

    def say(text: str) -> None:
        nonlocal holder, linked
        if not buffer:
            k = stack[-1]
            while els[k].tag in INLINE and not els[k].dropped:
                k = els[k].up
            holder = k
        buffer.append(text)
        if links:
            linked += len(text)

    while m := find(html, at):
        if m.start() > at:
            say(html[at : m.start()])
        at = m.end()
        end, tag, attrs = m.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if tag in RAW:
            if not end:
                at = _RAW_END[tag].search(html, at).end()
            continue
        if end:
            if tag == "br":
                say(" ")
            elif open_.get(tag):
                inline = tag in INLINE
                walls = _WALLS if inline or tag == "p" else _LIST_WALLS.get(tag, ())
                for i in range(len(stack) - 1, 0, -1):
                    t = els[stack[i]].tag
                    if t == tag:
                        if not inline:
                            flush()
                        elif els[stack[i]].dropped:
                            flush()
                        pop(i)
                        break
                    if t in walls:
                        break
            elif tag not in INLINE:
                flush()
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                say(" ")
            continue
        inline = tag in INLINE
        if tag in CLOSES:
            close(CLOSES[tag], _LIST_WALLS.get(tag, _WALLS))
        elif tag in _ENDS_P and open_.get("p"):
            close({"p"}, _WALLS)
        if tag in ("html", "body") and open_.get(tag):
            continue
        dropped, weak, bonus, step = _judged(tag, attrs if attrs and _SPEAKS(attrs) else "", articles > 0)
        if not inline or dropped:
            flush()
        up = stack[-1]
        path = els[up].path if inline or tag not in CONTAINERS else xxhash.xxh64_intdigest(step, els[up].path)
        els.append(Element(up, tag, step, path, dropped, bonus if tag not in ("html", "body") else 0.8, weak))
        if attrs.endswith("/") and tag not in CONTAINERS and tag != "p":
            continue
        stack.append(len(els) - 1)
        open_[tag] = open_.get(tag, 0) + 1
        links += tag == "a"
        articles += tag in ("article", "main")
    if at < len(html):
        rest = html[at:]
        cut = re.search(r"<[A-Za-z/!?]", rest)  # a tag that the page's end cuts off
        say(rest[: cut.start()] if cut else rest)
    flush()
    _settle(page)
    return page


def _settle(page: Page) -> None:
    """Decide what is dropped: what is marked and holds no article, main or page title, and all that lies in it."""
    els = page.elements
    holds, titled, listed = [False] * len(els), [False] * len(els), [False] * len(els)
    chars = [0] * len(els)
    for k, text, linked in page.blocks:
        chars[k] += len(text) - linked
    total = sum(chars) or 1
    for k in range(len(els) - 1, 0, -1):
        e = els[k]
        if holds[k] or (e.tag in ("article", "main") and not e.dropped):
            holds[e.up] = True
        chars[e.up] += chars[k]
        titled[e.up] |= titled[k] or e.tag == "h1"
        listed[e.up] |= listed[k] or e.tag in ("nav", "ul", "ol", "form")
    for k in range(1, len(els)):
        e = els[k]
        if e.dropped and e.weak and (holds[k] or (e.tag in ("form", "header") and 2 * chars[k] > total)):
            e.dropped = False
        if e.dropped and e.tag == "header" and titled[k] and not listed[k] and _named_above(els, k):
            e.dropped = False  # the header of an article that isn't an article element
        if els[e.up].dropped:
            e.dropped = True
    kept = [b for b in page.blocks if not els[b[0]].dropped]
    # a page whose every text lies in named boxes: the names were no boilerplate there
    if not kept and page.blocks:
        for e in els:
            e.dropped = e.dropped and e.tag in DROP_TAGS
        for k in range(1, len(els)):
            els[k].dropped = els[k].dropped or els[els[k].up].dropped
        kept = [b for b in page.blocks if not els[b[0]].dropped]
    page.blocks = kept


def _named_above(els: list[Element], k: int) -> bool:
    k = els[k].up
    while k > 0 and els[k].bonus < WHOLE:
        k = els[k].up
    return k > 0


#: What a container gets of text that lies so many containers below it: each one takes this share of the one inside it.
FADE = 0.7


def scored(page: Page) -> int:
    """The container with the greatest score, after each container's is set; the page itself where no text speaks for one.

    A block counts with its characters outside links, less the more of it is links; headings
    don't count. Its container gets all, the one around it ``FADE`` of that, and so on, but for an
    article's own element, which gets all that is in it; names and tags that speak for articles raise a score.
    """
    els = page.elements
    for e in els:
        e.score = 0.0
    for k, text, linked in page.blocks:
        tag = els[k].tag
        if tag in HEADINGS:
            continue
        share = linked / len(text)
        weight = len(text) * (1 - share) ** 2
        while k > 0 and els[k].tag not in CONTAINERS:
            k = els[k].up
        els[k].score += weight
    best, most = 0, -1.0
    for k in range(len(els) - 1, 0, -1):  # children stand behind their parents
        e = els[k]
        u = e.up
        if e.tag in CONTAINERS:
            els[u].score += (1.0 if els[u].bonus >= WHOLE else FADE) * e.score
        else:
            els[u].score += e.score
    for k, e in enumerate(els):
        s = e.score * e.bonus
        if (e.tag in CONTAINERS or k == 0) and not e.dropped and s > most:
            best, most = k, s
    return best


def text_of(page: Page, tops: list[int]) -> str:
    """The blocks inside the containers in page order, with the page's title in front where it stands outside."""
    els = page.elements
    within = [False] * len(els)
    for t in tops:
        within[t] = True
    for k in range(1, len(els)):
        within[k] = within[k] or within[els[k].up]
    mine = [i for i, b in enumerate(page.blocks) if within[b[0]]]
    if not mine:
        return ""
    if not any(els[page.blocks[i][0]].tag == "h1" for i in mine):
        mine = [i for i, b in enumerate(page.blocks) if b[0] and els[b[0]].tag == "h1" and i < mine[0]][-1:] + mine
    return " ".join(page.blocks[i][1] for i in mine)


def matching(page: Page, path: int) -> list[int]:
    """The outermost containers at a generalised path that hold text; among those whose step names no class only the best one."""
    els = page.elements
    found = [k for k, e in enumerate(els) if e.path == path and not e.dropped and (e.tag in CONTAINERS or k == 0)]
    found = [k for k in found if els[k].score > 0] or found
    if len(found) > 1 and found and "." not in els[found[0]].step and "#" not in els[found[0]].step and els[found[0]].tag != "article":
        found = [max(found, key=lambda k: (els[k].score, -k))]
    return found
