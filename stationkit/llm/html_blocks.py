"""Main text of web pages from flat text blocks and a small decision tree.

A page is read as a flat sequence of text blocks, cut at block-level tags;
inline tags, formulas and line breaks stay inside a block.  Each block gets its
word count and link density, those of the blocks before and after it, and what
its surroundings say: inside an article or main element, inside an element whose
tag or role is furniture (navigation, footer, form ...), heading, list item, and
for the innermost element around it whose class or id names furniture (advert,
cookie notice, sidebar ...) that element's share of the page's words: a small
share is furniture, a large one is a wrapper of the whole layout that names a
part of it.  Names such as ``has-sidebar`` or ``no-comments`` say nothing of
the element itself.  Elements named after reader comments count by name alone,
unless they hold an article element.  Where a page has article or main elements,
a block knows whether it stands outside them.

A decision tree, grown on ``LABELLED_PAGES`` when a query starts, tells article
blocks from the rest.  Each labelled page enters twice, as it is and without its
semantic tags, classes and ids, where only words, links and neighbours speak;
of the second form, which only pages of some length have, furniture that nothing
tells from an article (texts without links, but the shortest) is left out.

Scripts, styles, the head, comments and markup are never text.  Character
references are decoded, white space in a block becomes one space, blocks are
trimmed, empty ones dropped, and the kept ones joined in page order by two
line feeds.  Reading a page takes time in proportion to its length, whatever is
left open or unbalanced in it.

Defined cases: null or empty html gives the empty text; pages of any length are
read whole; a page that breaks off inside a tag or a script keeps what came
before; a block on the edge of a leaf (a share of one half) is kept; repeated
rows are each extracted; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, text_of

# fixed values: element names and words that name page furniture
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark
 nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr
 math mi mo mn ms mtext mspace mrow mfrac msqrt mroot msup msub msubsup mover munder munderover mstyle semantics""".split())
RAW = frozenset("script style noscript template textarea title iframe object svg canvas select button annotation".split())
RAW_INLINE = frozenset("select button svg canvas annotation".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE = frozenset("nav footer aside form menu dialog head fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HINTS = frozenset("""ad ads adv advert advertisement adsense adbox banner billboard promo promotion sponsor sponsored
 cookie cookies consent gdpr notice notices notification alert comment comments reply replies disqus respond sidebar
 aside rail menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar share sharing social
 related recommended recommendations newsletter subscribe subscription signup login register popup modal overlay
 widget widgets pagination pager copyright legal disclaimer search skip tags trending outbrain taboola
 thread threads discussion""".split())
READERS = frozenset("comment comments reply replies disqus respond thread threads discussion".split())
# a class whose first part is one of these tells of the page or the text, not of the element
MODIFIERS = frozenset("""has no not with without is show shows hide hides category cat tag type format status layout page post
 single template type theme style""".split())
PREFIXES = ("advert", "sponsor", "cookie", "comment", "sidebar", "breadcrumb", "newsletter")

# a tag without "<" or ">" in its attribute values; others are looked at by _tag_end
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/><]*+)((?:[^>"'<]++|"[^"<>]*+"|'[^'<>]*+')*+)>""")
_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/><]*+)")
_STOP = re.compile(r"""[>"']""")
_NAMED = re.compile(r"""\b(class|id|role|style|aria-hidden)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"\shidden(?=[\s=/]|$)", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after",
            "article", "furniture", "hint_share", "readers", "heading", "item", "outer_header", "outside")


def _names(value: str):
    """Parts of the names in a class or id that tell of the element itself."""
    for token in value.split():
        parts = [x.lower() for x in _PARTS.findall(token)]
        if parts and not (len(parts) > 1 and parts[0] in MODIFIERS):
            yield from parts


def _hint(name: str, attributes: str) -> tuple[bool, bool, bool]:
    """Whether the attributes mark furniture by role or state, by class or id,
    and whether that names reader comments."""
    role = word = readers = False
    if "=" in attributes:
        for key, a, b, c in _NAMED.findall(attributes):
            value = a or b or c
            key = key.lower()
            if key == "role":
                role |= value.strip().lower() in ROLES
            elif key == "style":
                role |= "display:none" in value.replace(" ", "").lower()
            elif key == "aria-hidden":
                role |= value.strip().lower() == "true"
            elif name not in ("html", "body", "article", "main"):
                for x in _names(value):
                    word |= x in HINTS or x.startswith(PREFIXES)
                    readers |= x in READERS or x.startswith("comment")
    return role or bool(_HIDDEN.search(attributes)), word or readers, readers


def _tag_end(page: str, at: int) -> int:
    """Place of the ">" that ends the tag whose attributes begin at ``at``; a
    quote counts behind an equals sign.  -1 if there is none."""
    while True:
        m = _STOP.search(page, at)
        if m is None:
            return -1
        k = m.start()
        if page[k] == ">":
            return k
        at = k + 1
        before = k - 1
        while before >= 0 and page[before] in " \t\n\r\f":
            before -= 1
        if before >= 0 and page[before] == "=":
            at = page.find(page[k], at) + 1
            if not at:
                return -1


class _Page:
    """A page being read: finished blocks, and the elements that are open."""

    def __init__(self):
        self.out: list[tuple] = []  # (text, words, link density, article, furniture, hinted, reader, heading, item, header)
        self.stack: list[tuple] = []  # (tag, state outside)
        self.open: dict[str, int] = {}
        # article, furniture, innermost hinted element, innermost of readers, heading, item, header
        self.state = (False, False, -1, -1, False, False, False)
        self.hinted: list[list] = []  # words and article elements before and after the element
        self.parts: list[str] = []
        self.linked: list[str] = []
        self.in_link = False
        self.words = self.tops = 0

    def keep(self, piece: str) -> None:
        if piece:
            self.parts.append(piece)
            if self.in_link:
                self.linked.append(piece)

    def close_block(self) -> None:
        if self.parts:
            words = html.unescape("".join(self.parts)).split()
            if words:
                anchor = len(html.unescape("".join(self.linked)).split()) if self.linked else 0
                self.out.append((" ".join(words), len(words), min(1.0, anchor / len(words)), *self.state))
                self.words += len(words)
            self.parts.clear()
            self.linked.clear()

    def start(self, name: str, attributes: str) -> None:
        if name in ("p", "li", "td", "tr", "th", "dt", "dd", "option") and self.stack and self.stack[-1][0] == name:
            self._leave(len(self.stack) - 1)  # the end tag is optional: a sibling ends the open one
        article, furniture, hinted, reader, *_, header = self.state
        role, word, readers = _hint(name, attributes) if attributes else (False, False, False)
        self.stack.append((name, self.state))
        self.open[name] = self.open.get(name, 0) + 1
        top = name in ("article", "main")
        if word:
            self.hinted.append([self.words, self.tops, -1, -1])
            hinted = len(self.hinted) - 1
            reader = hinted if readers else reader
        if top:
            self.tops += 1
        inside = article or top
        self.state = (inside, furniture or name in FURNITURE or role, hinted, reader, name in HEADINGS,
                      name in ("li", "dt", "dd", "option"), header or (name == "header" and not inside))

    def end(self, name: str) -> None:
        if not self.open.get(name):
            return  # a stray end tag
        k = len(self.stack) - 1
        while self.stack[k][0] != name:
            k -= 1
        self._leave(k)

    def _leave(self, k: int) -> None:
        """Close the open elements from the k-th on."""
        self._close_hinted(self.stack[k][1][2])
        self.state = self.stack[k][1]
        for tag, _ in self.stack[k:]:
            self.open[tag] -= 1
        del self.stack[k:]

    def _close_hinted(self, outside: int) -> None:
        now = self.state[2]
        while now > outside:  # those inside were opened later and have higher numbers
            if self.hinted[now][2] < 0:
                self.hinted[now][2:] = [self.words, self.tops]
            now -= 1

    def finish(self) -> list[tuple]:
        self.close_block()
        self._close_hinted(-1)
        total = max(1, self.words)
        # an element that holds the article is a wrapper, whatever its name
        share = [1.0 if h[3] > h[1] else (h[2] - h[0]) / total for h in self.hinted]
        holds = [h[3] > h[1] for h in self.hinted]
        somewhere = any(b[3] and not b[4] for b in self.out)
        return [(text, n, links, article, furniture, share[hint] if hint >= 0 else 1.0, reader >= 0 and not holds[reader],
                 heading, item, header, somewhere and not article)
                for text, n, links, article, furniture, hint, reader, heading, item, header in self.out]


def blocks(page: str) -> list[tuple]:
    """Text blocks in page order: (text, words, link density, article, furniture,
    hint share, readers, heading, list item, header outside an article, outside
    the page's articles)."""
    p = _Page()
    at, lowered, last, quotes = 0, None, page.rfind(">"), True
    while True:
        k = page.find("<", at)
        if k < 0:
            p.keep(page[at:])
            return p.finish()
        p.keep(page[at:k])
        m = _TAG.match(page, k)
        if m:
            closing, name, attributes, at = m[1], m[2], m[3], m.end()
        elif page.startswith("<!--", k):
            end = page.find("-->", k + 4)
            at = len(page) if end < 0 else end + 3
            continue
        elif page.startswith(("<!", "<?"), k):
            end = page.find(">", k)
            at = len(page) if end < 0 else end + 1
            continue
        else:
            m = _OPEN.match(page, k)
            if m is None:  # a sign, not a tag; at the end of the page a tag that was cut off
                p.keep("<" if k + 1 < len(page) and page[k:k + 2] != "</" else "")
                at = k + 1
                continue
            if last < k:  # the page breaks off inside this tag
                return p.finish()
            end = _tag_end(page, m.end()) if quotes else page.find(">", m.end())
            if end < 0:  # an open quote: from here on quotes do not count
                quotes, end = False, page.find(">", m.end())
            closing, name, attributes, at = m[1], m[2], page[m.end():end], end + 1
        name = name.lower()
        if name in RAW:
            if closing:
                if name not in RAW_INLINE:
                    p.close_block()
                continue
            if attributes.endswith("/"):
                continue
            if lowered is None:
                lowered = page.lower()
                if len(lowered) != len(page):  # a few letters change their length
                    lowered = page
            end = lowered.find("</" + name, at)
            at = len(page) if end < 0 else end
            if name not in RAW_INLINE:
                p.close_block()
            continue
        if name in INLINE:
            if name == "a":
                p.in_link = not closing
            elif name == "br" and not closing:
                p.keep(" ")
            continue
        p.close_block()
        p.in_link = False
        if name in VOID:
            continue
        if closing:
            p.end(name)
        else:
            p.start(name, attributes)


def features(found: list[tuple]) -> np.ndarray:
    """One row of ``FEATURES`` for each block."""
    own = np.array([b[1:3] for b in found], float).reshape(-1, 2)
    flags = np.array([b[3:] for b in found], float).reshape(-1, len(FEATURES) - 6)
    before = np.concatenate([own[:1], own[:-1]])  # at the edge of the page a block is its own neighbour
    after = np.concatenate([own[1:], own[-1:]])
    return np.concatenate([own, before, after, flags], axis=1)


class Tree:
    """Binary decision tree on numeric features, split by Gini impurity."""

    def __init__(self, depth: int = 8, leaf: int = 2):
        self.depth, self.leaf, self.nodes = depth, leaf, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Tree":
        self.nodes = []
        self._grow(x, y, self.depth)
        return self

    def _grow(self, x, y, depth) -> int:
        me = len(self.nodes)
        self.nodes.append((-1, 0.0, 0, 0, float(y.mean())))
        if depth == 0 or y.min() == y.max():
            return me
        best = (len(y) * 2 * y.mean() * (1 - y.mean()) - 1e-9, None, None)
        for f in range(x.shape[1]):
            order = np.argsort(x[:, f], kind="stable")
            v, ones = x[order, f], np.cumsum(y[order])
            for i in np.flatnonzero(v[1:] > v[:-1]):
                n, m = i + 1, len(y) - i - 1
                if min(n, m) < self.leaf:
                    continue
                p, q = ones[i] / n, (ones[-1] - ones[i]) / m
                cost = 2 * (n * p * (1 - p) + m * q * (1 - q))
                if cost < best[0] - 1e-12:
                    best = (cost, f, (v[i] + v[i + 1]) / 2)
        if best[1] is None:
            return me
        low = x[:, best[1]] <= best[2]
        left = self._grow(x[low], y[low], depth - 1)
        right = self._grow(x[~low], y[~low], depth - 1)
        self.nodes[me] = (best[1], best[2], left, right, self.nodes[me][4])
        return me

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Share of article blocks in each row's leaf."""
        out = np.empty(len(x))
        for i, row in enumerate(x):
            f, at, left, right, p = self.nodes[0]
            while f >= 0:
                f, at, left, right, p = self.nodes[left if row[f] <= at else right]
            out[i] = p
        return out


#: Mark of article text in the labelled pages.
MARK = "\N{SECTION SIGN}"
_LONG = "Several boats left the harbour before dawn and came back late in the evening with very little to show for it."
_NOTE = "This site stores small files on your device so that pages load faster and we can measure how they are read."
#: The labelled table: pages written for this purpose, article blocks marked.
LABELLED_PAGES = [
    f"""<head><title>Boats</title></head><body><nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></nav>
    <div class="ad">Buy two ropes and get a third one free this week only.</div><article><h1>{MARK}Boats at dawn</h1>
    <p>{MARK}{_LONG}</p><p>{MARK}Nothing.</p><p>{MARK}{_LONG} <a href=x>More on nets</a> and weather.</p><h2>{MARK}Prices</h2>
    <ul><li>{MARK}Cod rose.</li><li>{MARK}Herring fell a little.</li></ul><p>{MARK}{_LONG}</p></article>
    <footer>Copyright Harbour Press</footer></body>""",
    f"""<body><header><a href=/>The Daily</a><p>Independent since 1901 and printed every working day of the year</p></header>
    <div id="cookie-notice"><p>{_NOTE}</p><p>OK</p></div><main><h1>{MARK}A bridge reopens</h1><p>{MARK}{_LONG}</p>
    <p>{MARK}Yes.</p><blockquote>{MARK}We waited for years.</blockquote><p>{MARK}{_LONG}</p>
    <div class="related"><h3>Read also</h3><p>{_LONG}</p></div></main>
    <aside><h3>Weather</h3><p>Rain in the morning, later dry with some sun along the whole coast until the night.</p></aside>
    <section id="comments"><h3>Two comments</h3><div class="comment"><p>{_LONG}</p></div>
    <div class="comment"><p>I was there and saw it with my own eyes, what a day it was.</p></div></section>
    <footer><p>All rights reserved. {_NOTE}</p><a href=/i>Imprint</a></footer></body>""",
    f"""<body><div class="menu"><a href=a>Start</a> <a href=b>Sport</a> <a href=c>Culture</a></div>
    <div class="content"><h1>{MARK}Old mills</h1><p>{MARK}{_LONG}</p><p>{MARK}{_LONG} {_LONG}</p><p>{MARK}Gone.</p>
    <p>{MARK}{_LONG}</p></div><form><p>{_NOTE}</p><label>Your mail</label><input name=m></form>
    <div class="sidebar"><p>{_LONG}</p><a href=q>Archive</a></div><div id="footer">Contact us by post</div></body>""",
    f"""<body><p><a href=1>One</a> <a href=2>Two</a> <a href=3>Three</a></p><p><a href=5>Five</a></p>
    <div><p>{MARK}{_LONG}</p><p>{MARK}{_LONG}</p><p>{MARK}Short one.</p><p>{MARK}{_LONG}</p></div>
    <div class="share"><a href=f>Share</a></div><div class="advertisement">{_LONG}</div>
    <div role="complementary"><p>{_LONG}</p></div><p><a href=6>Next page</a></p><p><a href=7>Top</a></p></body>""",
    f"""<body><nav><a href=/>Home</a></nav><article><header><h1>{MARK}Letters</h1><p>{MARK}By our own writer in the north</p></header>
    <p>{MARK}{_LONG}</p><div class="promo"><p>Subscribe now and read the first month for nothing at all.</p></div>
    <p>{MARK}{_LONG}</p><table><tr><td>{MARK}Year</td><td>{MARK}Count</td></tr></table>
    <form><p>Join our weekly list</p></form><nav><a href=z>Part two</a></nav><aside>{_LONG}</aside>
    <p>{MARK}See <a href=s>the second report on rivers</a></p><p>{MARK}<a href=t>Source of the tables</a></p>
    <footer>Filed under rivers</footer><section class="comments"><p>{_LONG}</p><p>Nice.</p></section></article>
    <footer><p>{_LONG}</p></footer></body>""",
    f"""<body><header><h1><a href=/>Coast Weekly</a></h1><nav><a href=a>A</a></nav></header><div class="alert">Our office is closed today.</div>
    <article><p>{MARK}Tiny.</p><p>{MARK}Also tiny.</p><p>{MARK}Third.</p><ol><li>{MARK}First step</li><li>{MARK}Second step</li></ol></article>
    <div class="newsletter"><p>Get the letter every Friday.</p></div><div class="widget"><p>Poll of the day</p></div>
    <footer>Printed by hand</footer></body>""",
    f"""<body><div id="top-menu"><a href=a>Start</a> <a href=b>Maps</a></div><div id="text"><h1>{MARK}Island walks</h1>
    <p>{MARK}Bring water.</p><p>{MARK}{_LONG}</p><p>{MARK}Stop here.</p><p>{MARK}Turn left.</p><p>{MARK}{_LONG}</p>
    <ul><li>{MARK}Boots</li><li>{MARK}Hat</li><li>{MARK}A light coat</li></ul><p>{MARK}The end</p></div>
    <div class="comments"><p>Lovely.</p><p>{_LONG}</p></div><div class="banner">Fly away for less.</div></body>""",
    f"""<body><p>{MARK}One short line.</p><p>{MARK}Two.</p><p>{MARK}{_LONG}</p><p>{MARK}Three, and then no more of it.</p></body>""",
    f"""<body><div><a href=a>All news</a> | <a href=b>Letters</a> | <a href=c>About us</a></div><table><tr><td><p>{MARK}{_LONG}</p>
    <p>{MARK}It rained.</p><p>{MARK}It rained again, and again, until the whole field stood under water.</p></td>
    <td class="rail"><p>{_NOTE}</p><p>Ask us.</p></td></tr></table><div><a href=u>Back</a> <a href=d>Further</a></div>
    <div class="copyright">{_NOTE}</div></body>""",
    f"""<body><header><p>News from the valley</p><p>Since 1950</p></header><section><h2>{MARK}Harvest</h2><p>{MARK}Good year.</p>
    <p>{MARK}{_LONG}</p><pre>{MARK}12 tons of wheat</pre></section><section class="related-stories"><p>Older harvests</p>
    <p>{_LONG}</p></section><div aria-hidden="true">Menu opened</div><div style="display: none">Saved for later.</div></body>""",
]


LABELLED_PAGES += [
    f"""<body><div class="social media-list"><a href=a>Follow</a></div><div class="content-and-sidebar-frame"><div><h1>{MARK}Salt roads</h1>
    <p>{MARK}{_LONG}</p><p>{MARK}Mules.</p><p>{MARK}{_LONG}</p><p>{MARK}{_LONG}</p><p>{MARK}The road ended here.</p></div>
    <div class="sidebar"><p>Old maps for sale</p><a href=m>Maps</a></div></div><div class="footer">Printed in the valley</div></body>""",
    f"""<body><div class="widget-area-wrapper"><article><h1>{MARK}Rope makers</h1><p>{MARK}{_LONG}</p><p>{MARK}Hemp.</p>
    <p>{MARK}{_LONG}</p></article><div class="share-bar"><a href=s>Send</a></div></div>
    <div class="comment-list"><p>{_LONG} {_LONG}</p><p>{_LONG} {_LONG}</p><p>{_LONG}</p><p>So true.</p></div></body>""",
    f"""<body><section class="social history"><h2>{MARK}Work in the mills</h2><p>{MARK}{_LONG}</p><p>{MARK}Children too.</p>
    <p>{MARK}{_LONG} {_LONG}</p></section><ol class="thread"><li>{_LONG}</li><li>{_LONG}</li><li>Thanks for this.</li></ol></body>""",
    f"""<body><div><a href=a>Start</a> <a href=b>Boats</a></div><div>Follow us here</div><div><a href=c>One</a> <a href=d>Two</a></div>
    <div>Popular today</div><div><a href=e>Cod prices fall again</a></div><div><a href=f>New ferry to the island</a></div>
    <div><p>{MARK}{_LONG}</p><p>{MARK}It was cold.</p><p>{MARK}{_LONG}</p><p>{MARK}Nobody spoke.</p><p>{MARK}{_LONG}</p></div>
    <div><a href=g>Before</a></div><div>Page two of nine</div><div><a href=h>Behind</a></div><div>Write to us</div>
    <div><a href=i>Imprint</a> <a href=j>Privacy</a></div></body>""",
    f"""<body><div><a href=a>Home</a></div><div>You are here</div><div><a href=b>Valley</a> <a href=c>Farms</a></div>
    <div><h2>{MARK}Two dry summers</h2><p>{MARK}{_LONG}</p><p>{MARK}Wells fell.</p><p>{MARK}{_LONG}</p>
    <p>{MARK}Then it rained.</p><p>{MARK}{_LONG}</p></div><div><a href=d>Print</a> <a href=e>Mail</a></div>
    <div>More from the farms</div><div><a href=f>A good year for plums</a></div><div>Sort by date</div><div><a href=g>Older</a></div></body>""",
]
LABELLED_PAGES += [
    f"""<body><nav><a href=/>Home</a> <a href=/n>News</a></nav><article><h1>{MARK}Notes</h1><p>{MARK}Wind.</p><p>{MARK}Calm sea.</p>
    <p>{MARK}See you.</p></article><footer>Made by us</footer></body>""",
    f"""<body><header><p>The Daily</p></header><main><p>{MARK}Closed.</p><p>{MARK}Back on Monday.</p></main><aside><p>Ask us</p></aside></body>""",
    f"<article><p>{MARK}Before.</p></article>", f"<article><p>{MARK}Not found here.</p></article><footer>By us</footer>",
    f"<main><h2>{MARK}Sold out</h2></main>", f"<article><table><tr><td>{MARK}x<td>{MARK}1<tr><td>{MARK}y<td>{MARK}2</table></article>",
    f"""<article><div hidden><p>Not for now</p></div><p>{MARK}Shown now.</p><div role="dialog">Log in</div><p>{MARK}Done.</p></article>""",
    f"""<nav><a href=a>A</a></nav><main><dl><dt>{MARK}Cod<dd>{MARK}4</dl><p>{MARK}Sum: 4</p></main><footer><p>Tax free</p><p>Since 1950</p></footer>""", f"<nav><a href=a>A</a></nav><article><p>{MARK}Yes <a href=b>and more</a></p></article>",
    f"""<body><article><ul><li>{MARK}Salt</li><li>{MARK}Two eggs</li><li>{MARK}<a href=x>Flour</a></li></ul><table><tr><td>{MARK}a</td>
    <td>{MARK}b</td></tr></table><div class="related"><p>Other cakes</p></div></article><form><p>Your name</p></form></body>""",
    f"""<article><div class="ad">Half price</div><p>{MARK}Only this.</p><aside>Or that</aside><p>{MARK}And this.</p></article>
    <section id="comments"><p>First!</p><p>Nice one</p></section>""",
]
#: words from which furniture without links cannot be told from an article in the plain form
LONG_WORDS = 5
#: words that a page needs for its plain form to tell anything
PLAIN_WORDS = 60
_SEMANTIC = re.compile(r"<(/?)(?:nav|footer|aside|article|main|section|header|form|blockquote)\b[^>]*>")
_MARKS = re.compile(r"""\s(?:class|id|role|style|aria-hidden)=(?:"[^"]*"|'[^']*'|[^\s>]+)""")


def plain_form(page: str) -> str:
    """``page`` without the tags and names that tell what its parts are."""
    return _MARKS.sub("", _SEMANTIC.sub(r"<\1div>", page))


def _of_pages(forms) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of marked pages, each with whether it is in plain form."""
    xs, ys = [], []
    for page, plain in forms:
        found = blocks(page.replace(MARK, ""))
        label = np.array([float(MARK in b[0]) for b in blocks(page)])
        told = np.array([not plain or y or b[1] < LONG_WORDS or b[2] > 0.3 for b, y in zip(found, label)], bool)
        xs.append(features(found)[told])
        ys.append(label[told])
    return np.concatenate(xs), np.concatenate(ys)


def labelled_blocks() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of ``LABELLED_PAGES`` as they are."""
    return _of_pages([(page, False) for page in LABELLED_PAGES])


def training_blocks() -> tuple[np.ndarray, np.ndarray]:
    """``LABELLED_PAGES`` as they are, and in plain form where they are long enough."""
    long = [page for page in LABELLED_PAGES if sum(b[1] for b in blocks(page)) >= PLAIN_WORDS]
    return _of_pages([(page, False) for page in LABELLED_PAGES] + [(plain_form(page), True) for page in long])


def train() -> Tree:
    return Tree().fit(*training_blocks())


def main_text(page: str, tree: Tree) -> str:
    found = blocks(page)
    if not found:
        return ""
    keep = tree.predict(features(found)) >= 0.5
    return "\n\n".join(b[0] for b, k in zip(found, keep) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            tree: Tree | None = None) -> DataFrame:
    """``page_id, url, text, n_chars``, one row per page."""
    tree = tree or train()
    bounded_batches(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def each(batches):
        for b in batches:
            texts = [main_text(t, tree) for t in text_of(b, 2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = [f.dataType.simpleString() for f in rows.schema]
    return rows.mapInArrow(each, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
