from __future__ import annotations

import html
import re

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import extract

LONG = "One long paragraph of text that is really the text of this page and goes on for a while."
CASES = {
    "": "",
    "<p>Hi": "Hi",
    "plain &amp; simple": "plain & simple",
    "<div class=ad>x</div><p>Body &lt;text&gt; here &amp; more</p>": "Body <text> here & more",
    "<nav>a<article><p>real</article>": "real",
    f"<body><nav><a href=x>m</a></nav><p>{LONG}</p><p>two <a href=q>link</a></p><div id='comments'><p>nice</p></div><form>f</form><footer>ff": f"{LONG} two link",
    "a < b > c <": "a < b > c <",
    "<a <a <a": "",
    "<p>x<script>var t='</p>'": "x",
    "<article class='comment'>c</article><article>a<aside>s</aside>b</article>": "a b",
    "<article><h1>T</h1><p><b>one\n two<br><p>th<i>re</i>e</article><footer>no</footer>": "T one two three",
    "<p>a<!-- no -->b</p><!-- open": "ab",
    "<article><p>cut off &am": "cut off &am",
}


@pytest.mark.parametrize("page", CASES)
def test_cases(page):
    assert extract.main_text(page) == CASES[page]


WRAPPED = {
    f'<div class="content-sidebar-wrap"><article><p>{LONG}</p></article></div>': LONG,
    f'<div class="layout has-sidebar"><article><p>{LONG}</p></article><div class="sidebar"><p>side</p></div></div>': LONG,
    f'<div id="page-with-header"><div class="site-header">top</div><article><p>{LONG}</p></article></div>': LONG,
    f'<div class="widget"><article><p>{LONG}</p></article></div><div class="site-footer">foot</div>': LONG,
    f'<div class="form"><p>{LONG}</p><p>{LONG}</p></div><div class="adBox">buy</div>': f"{LONG} {LONG}",
    f'<main><h1>T</h1><div class="social"><p>{LONG}</p></div></main>': f"T {LONG}",
    f'<article><div class="entry-header"><h1>T</h1></div><p>{LONG}</p></article>': f"T {LONG}",
    f'<article><p class="social-theory">{LONG}</p><p class="immune-response">b</p><p id="related-work">c</p></article>': f"{LONG} b c",
    f'<article><p class="commentary">c</p><p>{LONG}</p><div class="share social">s</div></article>': f"c {LONG}",
    f'<article><p>{LONG}</p></article><div id="comments"><article><p>{LONG * 9}</p></article></div>': LONG,
    f'<article><p>{LONG}</p></article><div class="sidebar"><p>{LONG * 9}</p></div>': LONG,
    f'<p>short</p><div class="ads"><p>{LONG * 9}</p></div>': "short",
}


@pytest.mark.parametrize("page", WRAPPED)
def test_names_of_wrappers_and_compound_names_drop_nothing(page):
    assert extract.main_text(page) == WRAPPED[page]


def test_teasers_do_not_displace_the_main_text():
    body = f"<div><p>{LONG}</p><p>{LONG}</p></div>"
    gap = "<nav>a<p>b<p>c</nav>"
    teasers = "<article><p>A teaser of other text.</p></article>"
    assert f"{LONG} {LONG}" in extract.main_text(body + teasers)
    assert f"{LONG} {LONG}" in extract.main_text(body + gap + teasers)
    assert f"{LONG} {LONG}" in extract.main_text(teasers + gap + body)


def test_articles_bound_the_text_where_they_are_most_of_it():
    page = f"<div>Site name</div><article><p>{LONG}</p></article><div><p>between</p></div><article><p>{LONG}</p></article><div>Imprint</div>"
    assert extract.main_text(page) == f"{LONG} between {LONG}"


SHORT = "A short paragraph of some sixty characters parted by adverts."
ADVERTS = "<div class=ad>x</div><aside>y</aside><ul class=share><li>z</li></ul>"


@pytest.mark.parametrize("blocks", [[LONG, LONG, SHORT], [LONG, SHORT, LONG], [SHORT, LONG, LONG], [LONG, SHORT, SHORT]])
def test_short_paragraphs_parted_by_adverts_stay(blocks):
    page = ADVERTS.join(f"<p>{b}</p>" for b in blocks)
    assert extract.main_text(page) == " ".join(blocks)


EMPTY = "<div></div>" * 5
AROUND = f"<div>Home</div><div>About</div><div>Contact</div>{EMPTY}<p>{LONG}</p><p>{SHORT}</p>{EMPTY}<p>{LONG}</p>{EMPTY}<div>Imprint</div>"


def test_surges_and_dives_choose_the_stretches():
    """What no tag or name tells from text goes by its distance from the main run; without surges it would stay."""
    assert extract.main_text(AROUND) == f"{LONG} {SHORT} {LONG}"
    for off in ({"surge": 0}, {"surge": 10**9, "near": 10**9}, {"window": 100}):
        assert extract.main_text(AROUND, **off).startswith("Home About Contact"), off
    assert extract.main_text(AROUND.replace(EMPTY, "<div></div>" * 4)).endswith("Imprint")
    # A run is found wherever it lies, and one short page is all run.
    assert extract.main_text(f"<div>a</div>{EMPTY * 3}<p>{LONG}</p>") == LONG
    assert extract.main_text(f"<p>ab</p>{EMPTY}<p>c</p>") == "ab"


I = "\u0130" * 24  # grows when lower-cased


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<p>{I}</p><script>var a = 1 < 2;</script><p>{LONG}</p><SCRIPT>b()</Script><p>end</p>", f"{I} {LONG} end"),
        (f"<p>{LONG}{I}<style>x</style>{I}</p><p>b</p><noscript>{I}</noscript>c", f"{LONG}{I}{I} b c"),
        (f"<form action=x><nav>m</nav><article><p>{LONG}</p><form>vote</form></article></form>", LONG),
        (f"<form><p>{LONG}</p><p>{LONG}</p><input><button>go</button></form>", f"{LONG} {LONG}"),
        (f"<aside><article><p>{LONG}</p></article></aside>", LONG),
        (f"<dialog open><p>{LONG}</p></dialog><footer>f</footer>", LONG),
        (f"<header>Site<nav>m</nav></header><article><header><h1>Title</h1></header><p>{LONG}</p></article>", f"Title {LONG}"),
        (f"<header><main><h1>T</h1><p>{LONG}</p></main></header>", f"T {LONG}"),
        ("<form>search</form>", ""),
        ("<header>Site</header><footer>f</footer>", ""),
        (f"<header>Site</header><p>{LONG}</p><aside>{SHORT}</aside>", LONG),
    ],
)
def test_dotted_capital_i_and_wrapping_elements(page, text):
    assert extract.main_text(page) == text


@pytest.mark.parametrize("piece", ["<div><b>x</i>", "<p><q>x</div>", "<table><td>x</article>", "<nav><article>", "<script>"])
def test_time_grows_with_unclosed_tags(piece):
    import time

    def took(n):
        began = time.perf_counter()
        extract.main_text(piece * n)
        return time.perf_counter() - began

    took(500)
    assert took(32_000) <= 12 * took(8_000) / 2 + 0.3


def test_menu_of_links_is_no_text():
    menu = "".join(f"<p><a href=/{i}>Some long link text number {i}</a></p>" for i in range(8))
    assert extract.main_text(f"<body><div>{menu}</div><p>{LONG}</p><p>{LONG}</p></body>") == f"{LONG} {LONG}"


def test_given_pages_give_their_articles(spark):
    def article(page):
        inner = page[page.index("<article>") + 9 : page.index("</article>")]
        blocks = (html.unescape(re.sub("</?b>", "", b)) for b in re.split("</?(?:p|h1|br)>", inner))
        return " ".join(x for x in (" ".join(b.split()) for b in blocks) if x)

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in extract.extract(pages).collect()}
    for r in pages.collect():
        assert got[r.page_id].text == article(r.html) and got[r.page_id].n_chars == len(article(r.html))


def test_odd_rows(spark):
    rows = [(None, None, None), (1, "u", ""), (1, "u", ""), (2, None, "<p>" + "é\U0001f600 " * 200_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("t"))
    got = brute.rows(extract.extract(df), "page_id", "url", "n_chars")
    assert got == sorted([(None, None, 0), (1, "u", 0), (1, "u", 0), (2, None, 599_999)], key=str)
    assert extract.extract(df.limit(0)).count() == 0
