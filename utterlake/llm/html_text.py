"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is read once into blocks (text between block-level tags). A block is described by its own word count and link density,
those of the blocks before and after it, the kind of the nearest container that names itself (by tag, or by the names in class, id
or role), whether it lies in an article, its tag, and what its container holds (words, links, share of the page). The tree is grown
with numpy on a small labelled table: some pages of several make-ups (labelled_pages()), with block sizes drawn at random, and pages
with the class lists of common publishing systems (written_pages()); held_out_accuracy() reads pages drawn anew.

A name counts as a whole: it must consist of words of one kind and of words that say nothing (site, box, left ...), so that
`category-social`, `menu-planning` or `has-sidebar` say nothing. A main name outranks a junk name on the same element. A container
that holds half of the page's words and a main container or the page's first heading, or nearly all words and few links, is a page's frame,
whatever its names are. What follows a heading like "Reader comments" in its container is taken as comments.

Reading follows html's own rules as far as texts depend on them: attribute values may hold > and other quotes, some end tags may be
left out, scripts and the like end at their end tag only. What is never closed ends with what encloses it. Each character is read a
bounded number of times, whatever the page holds.

Blocks keep the page's order; character references are decoded, white space becomes one space, blocks are joined by a line break.
Scripts, styles, comments, CDATA sections, the head, and elements that are hidden (attribute hidden, or display:none or visibility:hidden in style) are no text.

Defined cases: null or empty html gives an empty text; a page without markup is one block; unclosed or stray tags are closed by what
encloses them; very long pages are read whole; every input row gives one output row, repeated rows and null ids included; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utterlake.llm.common import small_batches, table

#: One attribute: a name, and perhaps a value in double quotes, in single ones, or (with any quotes inside) in none.
_ATTRIBUTE = r"""[\s/]*+[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+))?+"""
TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"  # a comment
    r"|<(?:[!?]|/(?![a-zA-Z]))[^>]*+(?:>|\Z)"  # a declaration, or what counts as a comment
    rf"|<(/?)([a-zA-Z][^\s/>]*+)((?:{_ATTRIBUTE})*+)[\s/]*+(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""[\s/]*+([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|((?!["'])[^\s>]*+)))?+""")
#: Tags whose content is never text. A head holds these and empty tags only; what else stands in it, unclosed, is the page's.
DROPPED = frozenset("script style noscript template title svg math iframe object select datalist textarea button canvas audio video".split())
#: Of these, tags whose content isn't read as tags, and tags that hold others of their kind.
RAW = frozenset("script style title iframe textarea".split())
NESTED = frozenset("template svg math object canvas audio video".split())
VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())
#: Tags that end a block.
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Open elements that a start tag closes, up to the nearest element of the third kind.
CLOSES = {
    **dict.fromkeys(("li",), ({"li", "p"}, {"ul", "ol", "menu", "dir"})), **dict.fromkeys(("dt", "dd"), ({"dt", "dd", "p"}, {"dl"})),
    **dict.fromkeys(("td", "th"), ({"td", "th", "p"}, {"tr", "table"})), "tr": ({"tr", "td", "th", "p"}, {"table"}),
    **dict.fromkeys(("tbody", "thead", "tfoot"), ({"tbody", "thead", "tfoot", "tr", "td", "th", "p"}, {"table"})),
}
PLAIN = ({"p"}, {"td", "th", "table", "li", "blockquote", "article", "section", "div", "form", "fieldset", "dd", "figure", "details"})
#: Kinds of containers, by tag or by names in class, id or role.
KINDS = {
    "main": ("article main", "article main post entry story content body text prose blog news recipe hentry"),
    "menu": ("nav menu", "nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager tabs toc skiplink skiplinks"),
    "edge": ("header footer", "header footer masthead banner copyright colophon contentinfo byline postmeta"),
    "side": ("aside", "aside sidebar side related recommended recommendations widget widgets share sharing social promo complementary tags tagcloud sidenav trending popular"),
    "advert": ("", "ad ads advert adverts advertisement advertising adsense sponsor sponsored cookie cookies consent notice popup modal newsletter subscribe subscription alert gdpr paywall"),
    "form": ("form fieldset", "form login signup signin search searchform contactform"),
    "comments": ("", "comment comments commentlist reply replies respond disqus"),
}
#: Words of a name that say nothing about what it is.
PLAIN_WORDS = frozenset(
    "site page main primary secondary top bottom left right center outer inner upper lower global local mobile desktop sticky fixed the my our all new "
    "box boxes wrap wrapper container area block section region list lists group holder panel row col column columns bar item items unit zone slot "
    "link links post posts article articles story stories entry entries content text body head title meta info thread form user users reader readers "
    "view full width default standard type layout module component card view inline large small medium dark light clearfix cf hidden xs sm md lg xl "
    "buttons button icons icon count counts this google dfp publisher id js".split()
)
#: Words that a name may be joined with (commentlist, sitefooter).
GLUED = ("list", "area", "box", "wrap", "wrapper", "section", "block", "container", "thread", "form", "item", "bar", "user", "reader", "site", "page", "main", "top", "bottom", "article", "post")
KIND_OF_TAG = {t: k for k, (tags, _) in enumerate(KINDS.values()) for t in tags.split()}
KIND_OF_WORD = {w: k for k, (_, words) in enumerate(KINDS.values()) for w in words.split()}
for _w in [w for w, k in KIND_OF_WORD.items() if k and len(w) > 5]:
    KIND_OF_WORD |= {n: KIND_OF_WORD[_w] for g in GLUED for n in (_w + g, g + _w) if n not in KIND_OF_WORD}
KIND_OF_WORD |= {g + w: 0 for g in ("main", "article", "post", "entry", "page", "story") for w in ("content", "body", "text")}
MAIN, OTHER, COMMENTS = 0, len(KINDS), list(KINDS).index("comments")
FRAMES = [list(KINDS).index(k) for k in ("menu", "edge", "side")]  # of these a name may be a whole layout's
#: After these words a name says what else there is (post-with-sidebar), not what this is; a name that ends with "page" is a whole page's.
BESIDES = re.compile(r"(^|[-_])(with|has|no|without|of|and|is|not|on|for)([-_]|$)", re.I)
#: Whole headings that begin a part with readers' comments.
COMMENTS_FOLLOW = re.compile(
    r"\W*(?:\d+\s+)?(?:(?:reader|readers'|user|visitor|your|latest|recent|all)\s+)?(?:comments?|replies|responses|kommentare?|commentaires?|comentarios?)(?:\s*\(?\d+\)?)?\W*"
    r"|\W*leave a (?:reply|comment)\W*|\W*join the (?:discussion|conversation)\W*|\W*(?:\d+ )?(?:comments?|responses?|thoughts?|replies) (?:on|to) .{1,200}", re.I | re.S,
)
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
NAMES = [
    "words", "links", "words_before", "links_before", "words_after", "links_after", *KINDS, "in_article", "heading", "paragraph", "item",
    "container_words", "container_links", "container_share",
]


class Container:
    """An element that names itself, with the words in it and in what it encloses (once the page is read).

    frames: it holds a main container or the page's first heading; fixed: its tag says what it is.
    """

    __slots__ = ("kind", "above", "words", "linked", "frames", "fixed")

    def __init__(self, kind: int, above: Container | None, fixed: bool):
        self.kind, self.above, self.words, self.linked, self.frames, self.fixed = kind, above, 0, 0, False, fixed


class Block:
    __slots__ = ("text", "words", "linked", "holder", "after", "tag")

    def __init__(self, text: str, linked: int, holder: Container, after: bool, tag: str):
        self.text, self.words, self.linked, self.holder, self.after, self.tag = text, len(text.split()), linked, holder, after, tag


@lru_cache(maxsize=20_000)
def kind_of_name(name: str) -> int:
    """The kind that one name of a class list, id or role stands for; OTHER if it says nothing.

    All words but those of the kind have to be ones that say nothing; of several junk kinds the last word's counts (related-posts-ad).
    """
    if name.lower().endswith("page") or BESIDES.search(name):
        return OTHER
    words = [w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", name)]
    kinds = [KIND_OF_WORD.get(w, OTHER) for w in words]
    junk = [k for k in kinds if k not in (MAIN, OTHER)]
    if junk and all(k != OTHER or w in PLAIN_WORDS for k, w in zip(kinds, words, strict=True)):
        return COMMENTS if COMMENTS in junk else junk[-1]
    if not junk and MAIN in kinds and all(k == MAIN or w in PLAIN_WORDS for k, w in zip(kinds, words, strict=True)):
        return MAIN
    return OTHER


def container_kind(tag: str, attributes: str) -> tuple[int, bool]:
    """(the kind of container that a tag names itself, or OTHER; whether its tag says so).

    The tag outranks its names. Of the names comments come first, then main ones, then other junk.
    """
    if tag in KIND_OF_TAG:
        own = KIND_OF_TAG[tag]
        if tag != "article" or not attributes:
            return own, True
    elif not attributes or tag in ("body", "html", "head"):
        return OTHER, False
    else:
        own = OTHER
    found = {kind_of_name(name[:100]) for key, *value in ATTRIBUTE.findall(attributes) if key.lower() in ("class", "id", "role") for name in "".join(value).split()} - {OTHER}
    if COMMENTS in found:  # an article may be a comment
        return COMMENTS, False
    if own != OTHER:
        return own, True
    return (MAIN if MAIN in found else min(found) if found else OTHER), False


def is_hidden(attributes: str) -> bool:
    """Whether a tag's attributes hide it: hidden, or a style that says so."""
    if not attributes or not ("hidden" in (low := attributes.lower()) or "none" in low):
        return False
    return any((key := name.lower()) == "hidden" or key == "style" and HIDING.search("".join(value)) for name, *value in ATTRIBUTE.findall(attributes))


def _after(html: str, tag: str, at: int, around: Counter, endless: set[str], nested: bool = False) -> int:
    """Where a dropped tag's content ends that begins at `at`: after its end tag, else before that of a tag around it.
    nested: the tag may hold others of its kind.

    endless collects the raw tags that no end tag follows any more.
    """
    if tag in RAW and tag not in endless:
        if end := re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at):
            return end.end()
        endless.add(tag)
    opened: Counter = Counter()
    while m := TOKEN.search(html, at):
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if opened[name]:
                opened[name] -= 1
            elif name == tag:
                return at
            elif around[name]:
                return m.start()
        elif name not in VOID and not m[0].endswith("/>"):
            if name in RAW and name not in endless:
                if end := re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(html, at):
                    at = end.end()
                else:
                    endless.add(name)
            elif name != tag or nested or tag in NESTED:
                opened[name] += 1
    return len(html)


class _Page:
    """The open elements of a page that is read, and its blocks so far."""

    def __init__(self):
        self.blocks: list[Block] = []
        self.page = Container(OTHER, None, False)
        self.holders = [self.page]  # outer ones first
        #: tag, nearest container, whether what it holds is hidden, and the level of a heading above comments in it (0: none)
        self.stack: list[list] = [["", self.page, False, 0]]
        self.open: Counter = Counter()  # of the stack's tags
        self.parts: list[str] = []
        self.linked: list[str] = []
        self.link = 0  # the stack's height where a link was opened
        self.headed = False

    def data(self, text: str) -> None:
        if self.stack[-1][2]:
            return
        text = references.unescape(text) if "&" in text else text
        self.parts.append(text)
        if self.link:
            self.linked.append(text)

    def close_block(self) -> None:
        words = "".join(self.parts).split()
        if words:
            tag, holder, _, after = self.stack[-1]
            heading = len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()
            if heading:  # it ends comments that began under a heading of its level, and may begin some
                above = self.stack[-2]
                if above[3] and int(tag[1]) <= above[3]:
                    above[3] = 0
                after = above[3]
                if not above[3] and len(words) < 40 and COMMENTS_FOLLOW.fullmatch(" ".join(words)):
                    above[3] = after = int(tag[1])
            block = Block(" ".join(words), min(len(words), len(" ".join(self.linked).split())), holder, bool(after), tag)
            self.blocks.append(block)
            holder.words += block.words
            holder.linked += block.linked
            if tag == "h1" and not self.headed:
                self.headed = True
                self.frame(holder)
        self.parts.clear()
        self.linked.clear()

    def frame(self, holder: Container | None) -> None:
        """holder and what encloses it hold a main container or the first heading."""
        while holder is not None and not holder.frames:
            holder.frames = True
            holder = holder.above

    def pop(self) -> None:
        self.open[self.stack.pop()[0]] -= 1
        if self.link > len(self.stack):
            self.link = 0

    def start(self, tag: str, attributes: str, empty: bool) -> None:
        if tag == "a":
            self.link = len(self.stack)
        if tag not in BLOCK:
            return
        self.close_block()
        closed, until = CLOSES.get(tag, PLAIN)
        while any(self.open[t] for t in closed) and self.stack[-1][0] not in until:
            self.pop()
        if tag not in VOID and not empty:
            (own, fixed), (_, holder, hidden, after) = container_kind(tag, attributes), self.stack[-1]
            if own != OTHER:
                if own == MAIN:
                    self.frame(holder)
                holder = Container(own, holder, fixed)
                self.holders.append(holder)
            # a section of its own has headings of its own
            self.stack.append([tag, holder, hidden or is_hidden(attributes), after])
            self.open[tag] += 1

    def end(self, tag: str) -> None:
        if tag == "a":
            self.link = 0
        if tag in BLOCK:
            self.close_block()
            if self.open[tag]:
                while self.stack[-1][0] != tag:
                    self.pop()
                self.pop()


def blocks(html: str | None) -> list[Block]:
    """The page's non-empty text blocks, in order."""
    html, page, at = html or "", _Page(), 0
    endless: set[str] = set()
    while m := TOKEN.search(html, at):
        if m.start() > at:
            page.data(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA[") and "]]>" not in endless:
                end = html.find("]]>", m.start())
                if end < 0:
                    endless.add("]]>")
                at = max(at, end + 3)
            continue
        tag, empty = m[2].lower(), m[0].endswith("/>")
        if m[1]:
            page.end(tag)
        elif tag in DROPPED:
            if not empty:
                at = _after(html, tag, at, page.open, endless)
        elif tag not in BLOCK and tag not in VOID and not empty and is_hidden(m[3]):
            at = _after(html, tag, at, page.open, endless, nested=True)
        else:
            page.start(tag, m[3], empty)
    page.data(html[at:])
    page.close_block()
    for holder in reversed(page.holders[1:]):
        holder.above.words += holder.words
        holder.above.linked += holder.linked
    return page.blocks


def block_features(found: list[Block]) -> np.ndarray:
    """A row of NAMES' features for each block; beyond the page's ends there are 0 words and no links."""
    n = len(found)
    own = np.array([(min(b.words, 100), b.linked / max(b.words, 1)) for b in found], float).reshape(n, 2)
    none = np.zeros((1, 2))
    near = [own, np.vstack([none, own[:-1]])[:n], np.vstack([own[1:], none])[:n]]
    total = max(sum(b.words for b in found), 1)
    known: dict[Container, tuple[int, bool]] = {}

    def standing(holder: Container | None) -> tuple[int, bool]:
        """(kind, in an article); a frame of the page has the kind of what encloses it."""
        if holder is None:
            return OTHER, False
        if holder not in known:
            kind, inside = standing(holder.above)
            words, linked = holder.words, holder.linked
            frame = holder.kind not in (MAIN, COMMENTS) and holder.frames and 2 * words >= total
            frame = frame or not holder.fixed and holder.kind in FRAMES and words >= 25 and 10 * words >= 9 * total and 10 * linked < 3 * words
            own = OTHER if frame else holder.kind
            known[holder] = (own if own != OTHER else kind, inside or own == MAIN)
        return known[holder]

    for b in found:  # from outside in, so that standing() never goes deep
        chain, holder = [], b.holder
        while holder is not None and holder not in known:
            chain.append(holder)
            holder = holder.above
        for holder in reversed(chain):
            standing(holder)
    kinds = np.array([COMMENTS if b.after else known[b.holder][0] for b in found], int).reshape(n, 1) == np.arange(OTHER)
    inside = [known[b.holder][1] for b in found]
    place = [(i, b.tag[:1] == "h" and b.tag[1:].isdigit(), b.tag in ("p", "blockquote", "pre"), b.tag in ("li", "td", "dd", "dt")) for b, i in zip(found, inside, strict=True)]
    held = [(min(b.holder.words, 1000), b.holder.linked / max(b.holder.words, 1), b.holder.words / total) for b in found]
    return np.hstack([*near, kinds.astype(float), np.array(place, float).reshape(n, 4), np.array(held, float).reshape(n, 3)])


def labelled_pages(n: int = 600, seed: int = 1) -> list[str]:
    """The labelled table, as pages: a block's text tells its label (main text begins with +).

    A page's make-up (which parts it has, and whether they name themselves) and the sizes of its blocks are drawn at random.
    """
    r = np.random.default_rng(seed)
    pick = lambda *of: of[int(r.integers(len(of)))]
    words = lambda low, high: " ".join(["word"] * int(np.exp(r.uniform(np.log(low), np.log(high + 1)))))
    link = lambda low, high: f"<a href=x>{words(low, high)}</a>"
    several = lambda make, low, high: "".join(make() for _ in range(int(r.integers(low, high + 1))))
    main_p = lambda: f"<p>+{words(1, 200)}{pick('', '', f' {link(1, 8)} {words(1, 40)}')}</p>"
    long_p = lambda: f"<p>+{words(25, 200)}</p>"
    refs = lambda: "<ul>" + several(lambda: f"<li>{link(1, 12).replace('word', '+word', 1)}</li>", 1, 6) + "</ul>"
    items = lambda: "<ul>" + several(lambda: f"<li>+{words(1, 40)}</li>", 1, 6) + "</ul>"
    menu = lambda: "<ul>" + several(lambda: f"<li>{link(1, 4)}</li>", 3, 9) + "</ul>"
    teasers = lambda: several(lambda: f"<div>{link(2, 12)}</div>", 3, 6)
    prose = lambda: several(lambda: f"<p>{words(1, 120)}</p>", 1, 4)
    lines = lambda: "<ul>" + several(lambda: f"<li>{words(1, 60)}</li>", 1, 4) + "</ul>"
    small = lambda: f"<div>{words(1, 14)}{pick('', ' ' + link(1, 4))}</div>"
    boxes = (
        "<nav>{}</nav>", "<aside>{}</aside>", "<div class=ad>{}</div>", "<form>{}</form>", '<div class="sidebar-box">{}</div>', '<div id="comments">{}</div>',
        '<div class="cookie-notice">{}</div>', '<section class="related-posts">{}</section>', "<div class=main-menu>{}</div>", '<div class="site-footer">{}</div>',
    )
    junk = lambda: pick(*boxes).format(pick(prose, prose, lines, menu, teasers, small)())
    lone = lambda: pick(*boxes[:4], *boxes[5:7]).format(pick("<p>{}</p>", "<ul><li>{}</li></ul>", "{}").format(words(1, 120)))
    pages = []
    for k in range(n):
        kind = k % 10
        if kind < 3:  # parts that name themselves, with junk before, in and after an article
            head = pick("", f"<header><h1>+{words(1, 14)}</h1></header>", f"<h1>+{words(1, 14)}</h1>")
            inner = several(lambda: pick(main_p, main_p, main_p, items, refs, lambda: f"<h2>+{words(1, 8)}</h2>", lambda: f"<blockquote>+{words(1, 60)}</blockquote>", junk)(), 2, 9)
            box = pick("<article>{}</article>", "<main>{}</main>", '<div class="post content">{}</div>', '<div id="article-body">{}</div>')
            end = f"<footer>{pick(prose, menu)()}</footer>"
            pages.append(several(junk, 0, 3) + pick("", f"<header>{pick(menu, prose, small)()}</header>") + box.format(head + inner) + several(junk, 0, 3) + pick("", end))
        elif kind < 6:  # parts without names: lists of links and small lines around longer texts
            body = long_p() + several(lambda: pick(long_p, long_p, main_p, items)(), 1, 7) + long_p()
            top = pick("", menu() + several(small, 0, 2), several(small, 0, 1) + menu(), small() + teasers())
            tail = pick(menu, teasers)() + several(small, 0, 3) + pick("", menu(), several(small, 1, 2))
            pages.append(top + pick("", f"<h1>+{words(2, 14)}</h1>") + f"<div>{body}</div>" + tail)
        elif kind < 8:  # hardly any markup
            pages.append(pick(f"+{words(1, 200)}", f"<p>+{words(1, 200)}</p>", several(main_p, 2, 5), f"<div>+{words(1, 200)}</div>"))
        else:  # no main text
            pages.append(lone() + pick("", lone()))
    return pages


def written_pages(n: int = 120, seed: int = 1) -> list[str]:
    """Labelled pages with the class lists of common publishing systems and site builders; the sizes of blocks are drawn at random."""
    r = np.random.default_rng(seed)
    words = lambda low, high: " ".join(["word"] * int(np.exp(r.uniform(np.log(low), np.log(high + 1)))))
    many = lambda form, low, high, a, b: "".join(form.format(words(a, b)) for _ in range(int(r.integers(low, high + 1))))
    prose = lambda low=1, high=6: many("<p>+{}</p>", low, high, 5, 150)
    junk = lambda low=1, high=4: many("<p>{}</p>", low, high, 2, 60)
    links = lambda: many("<li><a href=x>{}</a></li>", 3, 9, 1, 5)
    makes = (
        lambda: f'<body class="post-template-default single single-post"><div id="page" class="site"><header id="masthead" class="site-header"><p>{words(1, 8)}</p><ul id="primary-menu">{links()}</ul></header>'
        f'<div id="content" class="site-content"><div id="primary" class="content-area"><article id="post-12" class="post-12 post type-post status-publish format-standard hentry category-social tag-form">'
        f'<header class="entry-header"><h1 class="entry-title">+{words(2, 10)}</h1></header><div class="entry-content">{prose(2, 7)}<h2>+{words(1, 6)}</h2>{prose(1, 3)}</div></article>'
        f'<div id="comments" class="comments-area"><h2 class="comments-title">{words(2, 6)}</h2><ol class="commentlist">{many("<li class=comment><p>{}</p></li>", 1, 6, 3, 80)}</ol><div id="respond" class="comment-respond"><h3>{words(1, 4)}</h3></div></div></div>'
        f'<aside id="secondary" class="widget-area"><section class="widget widget_recent_entries"><ul>{links()}</ul></section></aside></div><footer id="colophon"><p>{words(2, 12)}</p></footer></div></body>',
        lambda: f'<div class="layout sidebar-right"><div class="region region-sidebar"><ul>{links()}</ul></div><div class="node node--type-page"><h1>+{words(2, 9)}</h1><div class="field field--name-body">{prose(2, 8)}</div></div></div>',
        lambda: f'<form id="aspnetForm"><div class="topbar"><ul>{links()}</ul></div><div class="pageBody"><h1>+{words(2, 9)}</h1>{prose(3, 8)}</div><div class="siteFooter">{junk(1, 2)}</div></form>',
        lambda: f'<div class="content-sidebar-wrap"><main class="content"><article class="entry">{prose(2, 6)}<div class="share-buttons">{words(1, 4)}</div><section id="header-files"><h2>+{words(1, 4)}</h2>{prose(1, 3)}</section></article></main>'
        f'<aside class="sidebar sidebar-primary">{junk()}</aside></div><div class="usercomments">{junk(1, 6)}</div>',
        lambda: f'<main><div class="search-result-article"><h1>+{words(2, 9)}</h1>{prose(1, 4)}</div><h2>Reader comments</h2><div>{junk(1, 6)}</div></main>',
        lambda: f'<div class="article promo-free"><h1>+{words(2, 9)}</h1>{prose(1, 4)}<div id="menu-planning"><h2>+{words(1, 4)}</h2>{prose(1, 3)}</div><section id="comments-on-the-law">{prose(1, 3)}</section></div><div class="cookie-banner">{junk(1, 2)}</div>',
        lambda: f'<div class="container"><div class="row"><div class="col-md-8"><h1>+{words(2, 9)}</h1>{prose(3, 8)}</div><div class="col-md-4"><div class="card"><ul>{links()}</ul></div></div></div><p class="text-muted">{words(2, 8)}</p></div>',
    )
    return [makes[k % len(makes)]() for k in range(n)]


def labelled_blocks(n: int = 600, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    x, y = [], []
    for page in labelled_pages(n, seed) + written_pages(n // 4, seed):
        found = blocks(page)
        x.append(block_features(found))
        y += [b.text.startswith("+") for b in found]
    return np.vstack(x), np.array(y)


def grow_tree(x: np.ndarray, y: np.ndarray, depth: int = 14, least: int = 4) -> tuple:
    """Split by the least Gini impurity into parts of `least` rows or more: (feature, threshold, left, right), or a leaf (True or False,)."""
    n, total = len(y), y.sum()
    best = (n * (total / n) * (1 - total / n) - 1e-9, None)
    if depth and 0 < total < n:
        for j in range(x.shape[1]):
            order = np.argsort(x[:, j], kind="stable")
            v, good = x[order, j], np.cumsum(y[order])[:-1]
            size = np.arange(1, n)
            cost = good * (1 - good / size) + (total - good) * (1 - (total - good) / (n - size))
            cost = np.where((v[1:] > v[:-1]) & (size >= least) & (n - size >= least), cost, np.inf)
            k = int(np.argmin(cost)) if n > 1 else 0
            if n > 1 and cost[k] < best[0]:
                best = (cost[k] - 1e-9, (j, (v[k] + v[k + 1]) / 2))
    if best[1] is None:
        return (bool(2 * total >= n),)
    j, cut = best[1]
    left = x[:, j] <= cut
    return (j, cut, grow_tree(x[left], y[left], depth - 1, least), grow_tree(x[~left], y[~left], depth - 1, least))


def held_out_accuracy(tree: tuple | None = None, n: int = 300, seed: int = 99) -> float:
    """Share of blocks that the tree labels rightly on pages drawn with another seed."""
    x, y = labelled_blocks(n, seed)
    return float((classify(tree or grow_tree(*labelled_blocks()), x) == y).mean())


def classify(tree: tuple, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0])
    out = np.zeros(len(x), bool)
    left = x[:, tree[0]] <= tree[1]
    out[left], out[~left] = classify(tree[2], x[left]), classify(tree[3], x[~left])
    return out


def main_text(html: str | None, tree: tuple) -> str:
    found = blocks(html)
    if not found:
        return ""
    return "\n".join(b.text for b, keep in zip(found, classify(tree, block_features(found)), strict=True) if keep)


def extracted(html: Column, tree: tuple) -> Column:
    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(p, tree) for p in pages], dtype=object)

    return texts(html)


def extract_text(pages: DataFrame, tree: tuple | None = None) -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars (code points)."""
    small_batches(pages.sparkSession)
    tree = tree or grow_tree(*labelled_blocks())
    out = pages.select("page_id", "url", extracted(F.col("html"), tree).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op8_html_text(spark, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
