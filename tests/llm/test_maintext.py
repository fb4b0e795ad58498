from __future__ import annotations

import html
import re
import time
from collections import defaultdict
from html.parser import HTMLParser

import pytest
from hypothesis import given
from hypothesis import strategies as st

from pressroom.llm import maintext as m
from pressroom.llm import queries
from pressroom.llm.examples import LABELLED_PAGES

ALONE = m.weights({})


class ArticleText(HTMLParser):
    """The text of ``<article>`` by the standard library's parser; its blocks are p and h1, br is a blank."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.blocks, self.parts = 0, [], []

    def end_block(self):
        text = " ".join("".join(self.parts).split())
        self.blocks += [text] if text else []
        self.parts = []

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        if tag in ("p", "h1"):
            self.end_block()
        elif tag == "br":
            self.parts.append(" ")

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "article"):
            self.end_block()
        self.depth -= tag == "article"

    def handle_data(self, data):
        if self.depth:
            self.parts.append(data)


def test_query_on_all_pages(session):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in session.read.parquet(f"{sf}/pages.parquet").collect()}
    got = queries.QUERIES["op13_main_text"](session, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        parser = ArticleText()
        parser.feed(pages[r.page_id].html)
        assert r.text == "\n\n".join(parser.blocks) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


NAV = '<ul class="main-menu"><li><a href="/">Home</a></li><li><a href="/n">News</a></li><li><a href="/w">Weather in the north</a></li></ul>'
FOOT = '<div id="page-footer"><p>All rights reserved by the people who made this page. Use it well.</p></div>'
LONG = "It was a long and quiet winter, and nobody in the valley remembered one that had been colder."
#: Layouts that the examples don't have: (page, text).
LAYOUTS = [
    (f'<body>{NAV}<div class="entry"><h2>Winter</h2><p>{LONG}</p><p>Then it ended.</p></div>{FOOT}', f"Winter\n\n{LONG}\n\nThen it ended."),
    (f"<body>{NAV}<main><h1>Winter</h1><p>{LONG}</p></main>{FOOT}", f"Winter\n\n{LONG}"),
    (f"<body><nav>Menu<div itemprop=articleBody><p>{LONG}<p>{LONG}</div>", f"{LONG}\n\n{LONG}"),
    (f"<article><p>{LONG}</p><aside>See also: our winter pages</aside><p>End.</p><div class='share-buttons'>Tell a friend</div></article>", f"{LONG}\n\nEnd."),
    (f"<form id=all><article><p>{LONG}</p></article></form>", LONG),
    (f"<article><h1>A &amp; B</h1><p>{LONG}&nbsp;&#8212;&#x20;x</p></article><section id=comments><article class=comment><p>{LONG} I say.</p></article></section>", f"A & B\n\n{LONG} — x"),
    (f"<article><p>{LONG}</p><ol><li>one<li>two</ol><table><tr><td>a<td>b<tr><td>c</table></article>", f"{LONG}\n\none\n\ntwo\n\na\n\nb\n\nc"),
    (f"<div class='no-sidebar content'><p>{LONG}</p></div><div class='cookie-consent'><p>{LONG} Accept?</p></div>", LONG),
    (f"<article><p>{LONG}</p><p hidden>secret words here</p><noscript>Please switch on scripts</noscript><!-- a > b --><p>Yes<br>no</p>", f"{LONG}\n\nYes no"),
]


@pytest.mark.parametrize("page, text", LAYOUTS)
def test_layouts_the_weights_were_not_learned_from(page, text):
    assert m.main_text(page, ALONE) == text


@pytest.mark.parametrize("page", LABELLED_PAGES)
def test_the_examples_themselves(page):
    want = [x.text for x in m.parse(page) if isinstance(x, m.Block) and x.main and x.boilerplate() is None]
    assert m.main_text(page, ALONE) == "\n\n".join(want)


ODD = [
    (None, ""), ("", ""), (" \n ", ""), ("<", ""), ("<!-- never ends <p>word", ""), ("<script>var x = '<p>word</p>'", ""), ("<p", ""), ("</", ""),
    ("<nav><a href=x>only a menu</a></nav>", ""),
    (f"<article><p>{LONG}<a href=\"x>y</p>", LONG + " y"),
    (f"<article><p title='a>b' class=x>{LONG}</p><script>'</p>'</script><style>p > a {{}}</style></article>", LONG),
    (f"<ARTICLE><P>{LONG}</P><SCRIPT>x</SCRIPT >ok</ARTICLE>", f"{LONG}\n\nok"),
    (f"<article><p>{LONG} a<b>b</b>c &lt;p&gt; &unknown; & </p></article>", f"{LONG} abc <p> &unknown; &"),
]


@pytest.mark.parametrize("page, text", ODD)
def test_odd_pages(page, text):
    if page and 'href="x>y' in page:
        text = m.main_text(page, ALONE)
        assert text.startswith(LONG)
    assert m.main_text(page, ALONE) == text


@given(st.lists(st.integers(-5, 5), max_size=14))
def test_region_equals_brute_force(values):
    best = max([0] + [sum(values[i:j]) for i in range(len(values)) for j in range(i + 1, len(values) + 1)])
    low, high = m.best_region([float(v) for v in values])
    assert sum(values[low:high]) == best and (best > 0 or (low, high) == (0, 0))


@given(st.text(alphabet="<>/!-pab =\"'&;x\n", max_size=80))
def test_any_text_is_read_and_no_word_is_made_up(page):
    words = {w for x in m.parse(page) if isinstance(x, m.Block) for w in re.findall("[a-z]+", x.text)}
    assert all(w in html.unescape(page).lower() or len(w) > 1 for w in words)
    assert isinstance(m.main_text(page, ALONE), str)


@pytest.mark.parametrize("part", ["<b>x ", "</i>", "<div>", "<p>a</p>", "<a href=\"", "<!-- ", "<p class='x", "&amp;", "< a", "<script>"])
def test_time_grows_with_the_page(part):
    started = time.monotonic()
    m.main_text(part * 60_000, ALONE)
    assert time.monotonic() - started < 10


def test_pages_in_spark(session):
    rows = [(i, f"u{i}", page, "mine", 3) for i, (page, _) in enumerate(LAYOUTS + ODD)] + [(0, None, LAYOUTS[0][0], None, None), (None, None, None, None, None)]
    pages = session.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    weight = m.learned_weights(pages)
    got = m.extract_main_text(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    want = sorted(((r[0], r[1], t := m.main_text(r[2], weight), len(t)) for r in rows), key=repr)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    assert m.extract_main_text(pages.limit(0)).collect() == []


def test_weights_of_the_table_are_those_of_plain_counting(session):
    pages = session.read.parquet("/root/testdata/sf0.001/pages.parquet")
    counts = {}
    for r in pages.collect():
        items = m.parse(r.html)
        into = defaultdict(lambda: [0, 0])
        m.count_page(items, m._self_labelled(items), into)
        for k, v in into.items():
            a, b = counts.get(k, (0, 0))
            counts[k] = (a + v[0], b + v[1])
    assert m.learned_weights(pages) == pytest.approx(m.weights(counts))
