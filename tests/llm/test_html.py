import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import CLASHES
from stationkit.llm import html_blocks as H


@pytest.fixture(scope="module")
def tree():
    return H.train()


def test_tree_fits_its_table_and_unseen_pages(tree):
    x, y = H.labelled_blocks()
    assert ((tree.predict(x) >= 0.5) == y).mean() > 0.95


def test_tree_splits_like_brute_force():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 6, (60, 3)).astype(float)
    y = (x[:, 1] > 2.5).astype(float)
    t = H.Tree(depth=3, leaf=1).fit(x, y)
    assert t.nodes[0][0] == 1 and t.nodes[0][1] == 2.5 and (t.predict(x) == y).all()


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{x:1}</style><script>var a="</p><p>no</p>";</script>
</head><body><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- <p>not this</p> -->
<div class="ad">Buy this now and save a lot of money today.</div>
<article><h1>Rock &amp; roll &copy; &#233;t&eacute;</h1><p><b>First   paragraph
 with a <a href="x">link</a>, and a<br>break.<br><p>Second &lt;b&gt; one.</p><p> &nbsp; </p><p>Ok.</p>
<ul><li>Item one</li><li>Item two</li></ul><div class="newsletter-signup">Sign up for our letter now please.</div>
<form><label>Name</label><input><button>Go</button></form></article>
<section id="comments"><p>I agree with every single word of this, thank you for it.</p></section>
<aside><p>Sidebar words here that go on for quite a while longer.</p></aside>
<footer>&copy; 2020 &middot; All rights</footer></body></html>"""

WANT = ["Rock & roll © été", "First paragraph with a link, and a break.", "Second <b> one.", "Ok.", "Item one", "Item two"]


def test_article_text(tree):
    assert H.main_text(PAGE, tree).split("\n\n") == WANT


@pytest.mark.parametrize("page,want", [
    ("", ""), ("   ", ""), ("<article><p>Cut off in a tag <a hre", "Cut off in a tag"),
    ("<article><p>Before.</p><script>never closed <p>x</p>", "Before."),
    ("<article><p>a &lt b &amp c &am</p></article>", "a < b & c &am"),
    ("<article><p title='a > b'>Quoted end.</p></article>", "Quoted end."),
    ("<ARTICLE><P>Upper case tags.</P></ARTICLE>", "Upper case tags."),
    ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
    ("<article><div hidden><p>Not shown at all</p></div><p>Shown.</p></article>", "Shown."),
    ("<article><table><tr><td>a<td>b</table></article>", "a\n\nb")])
def test_odd_pages(tree, page, want):
    assert H.main_text(page, tree) == want


def test_table_of_pages(spark, tree):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", "<article><p>" + "word " * 100_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").select(
        "*", *[F.lit(1).alias(c) for c in (*CLASHES, "text", "n_chars")])
    out = sorted((str(r["page_id"]), r["url"], r["text"], r["n_chars"]) for r in H.extract(df, tree=tree).collect())
    assert out == sorted((str(a), b, t, len(t)) for (a, b, _), t in zip(
        rows, ["\n\n".join(WANT)] * 2 + ["", "", ("word " * 100_000).strip()]))
    assert H.extract(df.limit(0)).count() == 0


def test_broken_markup_takes_linear_time(tree):
    import time
    began = time.time()
    for page in ("<script>" * 20_000, "<p>" * 100_000, "<div>" * 50_000 + "x", "<" * 100_000, "<!--" * 50_000):
        H.main_text(page, tree)
    assert time.time() - began < 20


LONG = H._LONG
BODY = f"<h1>Old mills</h1><p>{LONG}</p><p>Gone.</p><p>{LONG}</p>"
BODY_TEXT = "\n\n".join(["Old mills", LONG, "Gone.", LONG])


@pytest.mark.parametrize("wrapper", [
    '<div class="content has-sidebar">%s</div>', '<div class="layout with-sidebar"><article>%s</article></div>',
    '<div id="page" class="no-comments"><main>%s</main></div>', '<div class="post category-news tag-social">%s</div>',
    '<section class="social history">%s</section>', '<div class="container sidebar-right">%s</div>',
    '<nav><a href=a>x</a></nav><div class="wrapper sidebar-left">%s</div><div class="sidebar"><p>Buy it now today</p></div>',
    f'%s<ol class="thread"><li>{LONG}</li><li>me too</li></ol>',
    f'<div class="comments-open"><article>%s</article></div><div id="comments"><p>{LONG} {LONG} {LONG}</p><p>{LONG} {LONG}</p></div>'])
def test_articles_inside_layout_wrappers(tree, wrapper):
    assert H.main_text(f"<body>{wrapper % BODY}<footer>By us</footer></body>", tree) == BODY_TEXT


def test_formulas_stay_in_their_block(tree):
    page = ("<article><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds "
            "<svg><text>no</text></svg>here.</p></article>")
    assert H.main_text(page, tree) == "So x=2 holds here."


def test_the_tree_reads_words_links_and_neighbours(tree):
    used = {H.FEATURES[n[0]] for n in tree.nodes if n[0] >= 0}
    assert "links" in used and "words" in used
    assert used & {"words_before", "words_after"} and used & {"links_before", "links_after"}


UNSEEN = f"""<body><div><a href=a>Home</a></div><div>Read by many</div><div><a href=b>Farms</a> <a href=c>Ships</a></div>
<div><h1>§The lost bell</h1><p>§{LONG}</p><p>§It rang twice.</p><p>§{LONG}</p><p>§{LONG}</p></div>
<div><a href=d>Send</a> <a href=e>Save</a></div><div>Also of note</div><div><a href=f>A bell in the sea was found</a></div></body>"""


def test_an_unseen_page_without_any_names(tree):
    want = "\n\n".join(b[0] for b in H.blocks(UNSEEN) if "§" in b[0]).replace("§", "")
    assert H.main_text(UNSEEN.replace("§", ""), tree) == want


def parsed_blocks(page):
    """The blocks by the standard library's parser."""
    from html.parser import HTMLParser

    class P(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.out, self.parts, self.raw = [], [], 0

        def cut(self):
            text = " ".join("".join(self.parts).split())
            self.parts = []
            if text:
                self.out.append(text)

        def handle_starttag(self, tag, attrs):
            if tag in H.RAW:
                self.raw += 1
                if tag not in H.RAW_INLINE:
                    self.cut()
            elif tag == "br":
                self.parts.append(" ")
            elif tag not in H.INLINE:
                self.cut()

        def handle_endtag(self, tag):
            if tag in H.RAW:
                self.raw = max(0, self.raw - 1)
            elif tag not in H.INLINE:
                self.cut()

        def handle_data(self, data):
            if not self.raw:
                self.parts.append(data)

    p = P()
    p.feed(page)
    p.close()
    p.cut()
    return p.out


def test_blocks_equal_the_standard_parsers():
    import random
    rnd = random.Random(5)
    names = ["div", "p", "b", "a", "span", "li", "section", "h2", "math", "mi", "em"]

    def made(depth):
        if depth == 0 or rnd.random() < 0.3:
            return " ".join(rnd.choice(["one", "two &amp; a half", "x &lt; y", "&eacute;t&eacute;", "three\n four"])
                            for _ in range(rnd.randrange(1, 4)))
        inner = "".join(made(depth - 1) for _ in range(rnd.randrange(1, 4)))
        n = rnd.choice(names)
        extra = rnd.choice(["", ' class="a > b"', " title='x < y'", ' data-x="1"', " hidden"])
        return rnd.choice([f"<{n}{extra}>{inner}</{n}>", f"<!-- {n} -->{inner}<br>", f"<script>var a = 1;</script>{inner}"])

    for _ in range(300):
        page = f"<body>{made(5)}</body>"
        assert [b[0] for b in H.blocks(page)] == parsed_blocks(page), page


@pytest.mark.parametrize("pattern", ['<a "', "<p a='x ", "<a", "<p a='x>", "<div>x", '"<a b="', "<a b='>", "</p", "<p x=\"<p x='"])
def test_a_megabyte_of_broken_markup_is_read_in_seconds(pattern):
    import time
    began = time.time()
    H.blocks(pattern * (1_000_000 // len(pattern)))
    H.blocks("<p>" + pattern * (1_000_000 // len(pattern)) + ">" + "</p>" * 1000)
    assert time.time() - began < 15


def test_stray_end_tags_take_linear_time():
    import time
    began = time.time()
    H.blocks("<div>x" * 100_000 + "</p>" * 100_000)
    assert time.time() - began < 10


def test_share_of_an_element_and_headings_inside(tree):
    found = H.blocks(f'<div class="promo"><p>{LONG}</p></div><div class="sidebar"><p>a b</p></div>')
    n = len(LONG.split())
    assert [b[5] for b in found] == [pytest.approx(n / (n + 2)), pytest.approx(2 / (n + 2))]
    assert [b[6] for b in H.blocks('<div class="comments"><p>a</p></div>')] == [True]
    assert [b[6] for b in H.blocks('<div class="comments"><article>a</article></div>')] == [False]
    assert [b[-1] for b in H.blocks("<p>a</p><main><p>b</p></main>")] == [True, False]
