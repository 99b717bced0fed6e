import itertools
import os
import random
import re
import time
from html import unescape

import pytest

from sievewright.llm import htmlextract as H


def energy(labels, costs, edges):
    return sum(c for (i, j), c in edges.items() if labels[i] != labels[j]) - sum(c for keep, c in zip(labels, costs) if keep)


@pytest.mark.parametrize("seed", range(40))
def test_min_cut_is_minimal(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 9)
    costs = [rng.randint(-6, 6) for _ in range(n)]
    edges = {(i, j): rng.randint(1, 6) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5}
    best = min(energy(x, costs, edges) for x in itertools.product([False, True], repeat=n))
    assert energy(H.min_cut(costs, edges), costs, edges) == best


def test_flow_without_decided_blocks():
    costs, edges = [3, -1, 0, -3], {(0, 1): 4, (1, 2): 4, (2, 3): 4, (0, 2): 2}
    best = min(energy(x, costs, edges) for x in itertools.product([False, True], repeat=4))
    near = [{} for _ in costs]
    for (i, j), c in edges.items():
        near[i][j] = near[j][i] = c
    side = H._source_side(list(range(4)), costs, near)
    assert energy([i in side for i in range(4)], costs, edges) == best


PAGE = """<!DOCTYPE html><html><head><title>Title &amp; site</title><style>p > a {}</style><script>if (a<b) document.write("<p>no</p>")</script></head>
<body class="post-template"><header class="site-header"><a href="/">Site name</a><p>The best site of all sites there are, by far.</p></header>
<nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>
<div class="cookie-notice">We use cookies to make this site better for you and for all.</div>
<!-- a comment <p>hidden</p> -->
<div id="content"><article><header><h1>The  head&shy;line</h1></header>
<p>First &lt;paragraph&gt; with <b>bold</b>, a <a href="x">link</a> and
  a line&nbsp;break<br>here.
<p>Second paragraph, a short one
<ul><li>An item of the article that says something.</li><li>Another</ul>
<div class="ad-slot">Buy this thing now, it is cheap.</div>
<form><label>Your mail</label><input name=m></form>
<blockquote>Quoted words, 3 &lt; 4 &amp;&amp; 5 > 4.</blockquote>
<p style="display: none">Not shown</p>
</article><section class="comments"><p>A reader's comment that is rather long and has several words in it, too.</p></section></div>
<aside class="sidebar"><p>Related: a long text in the sidebar that should not be in the result at all.</p></aside>
<footer><p>&copy; 2024 Somebody. All rights reserved, and more of the like.</p></footer></body></html>"""


def test_a_page_with_all_kinds_of_boilerplate():
    assert H.main_text(PAGE).split("\n") == [
        "The head­line",
        "First <paragraph> with bold, a link and a line break here.",
        "Second paragraph, a short one",
        "An item of the article that says something.",
        "Another",
        "Quoted words, 3 < 4 && 5 > 4.",
    ]


def test_a_page_without_an_article_element():
    text = "Some sentence of the page that goes on for a while, so that it looks like prose."
    page = f"<body><div><a href=1>Home</a> <a href=2>News</a></div><div><h2>Head</h2><p>{text}</p><p>Short.</p><p>{text}</p></div><div class=footer>{text}</div></body>"
    assert H.main_text(page).split("\n") == ["Head", text, "Short.", text]


LONG = "This paragraph of the article is long enough to be taken for prose, and it ends with a full stop as prose does."


@pytest.mark.parametrize(
    "page",
    [
        '<div data-hidden="false"><p>%s</p></div>',
        '<article data-state="hidden"><p>%s</p></article>',
        '<article class="blog-post has-sidebar"><p>%s</p></article>',
        '<div class="layout-sidebar-right"><article><p>%s</p></article><div class="sidebar"><p>A text beside it that is long enough, and ends with a stop.</p></div></div>',
        '<div class="content-sidebar-wrap"><main><p>%s</p></main></div>',
        '<div class="main-content no-sidebar"><p>%s</p></div>',
        '<div class="content has-sidebar"><p>%s</p></div>',
        '<article class="post comments-open"><p>%s</p></article>',
        '<article><section id="related-work"><p>%s</p></section></article>',
        '<article><p class="notice-of-intent">%s</p></article>',
        '<article><p>%s <span class="advertisement">Buy now, it is cheap!</span></p></article>',
        '<article><p><span hidden>no</span>%s<i style="display:none">no</i></p></article>',
        '<form id="aspnetForm"><div class="article"><p>%s</p></div></form>',
        '<div class="sidebar"><p>%s</p></div>',
        '<article title="a > b" class=x><p>%s</p></article>',
        '<div class="wrapper"><p>%s</p></div><div class="comments"><p>A reader says so at some length, and in whole sentences, too.</p><p>Another reader says the opposite, at no less length than the first.</p></div>',
    ],
)
def test_marks_are_weighed(page):
    assert H.main_text(page % LONG) == LONG
    assert H.main_text("<body><nav><a href=/>Home</a></nav>" + page % LONG + "<footer>Imprint</footer></body>") == LONG


@pytest.mark.parametrize(
    "plain",
    [
        '<div class="comments">%s</div>', '<section id="comment-12"><article class="comment-body">%s</article></section>', '<div class="ad-slot">%s</div>', '<aside>%s</aside>', '<form>%s</form>',
        '<div class="cookie-notice">%s</div>', '<div class="newsletter-signup-box">%s</div>', '<div class="related-posts">%s</div>', '<div role="alert">%s</div>', '<p class="disclaimer">%s</p>',
    ],
)
def test_boilerplate_within_and_beside_an_article(plain):
    other = "A text that is just as long as prose would be, with several words and a stop at its end."
    assert H.main_text(f"<body><article><p>{LONG}</p>{plain % other}<p>{LONG}</p></article></body>") == f"{LONG}\n{LONG}"
    assert H.main_text(f"<body><article><p>{LONG}</p></article>{plain % other}</body>") == LONG


def generated(rng):
    """A page without an article element, and its text."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."
    want, body = [], []
    for _ in range(rng.randint(2, 8)):
        text = prose(rng.randint(15, 60))
        want.append(text)
        cut = rng.randrange(5, len(text) - 5)
        body.append(rng.choice([f"<p>{text}</p>", f"<p>{text[:cut]}<b>{text[cut:]}</b></p>", f"<div><p>{text}</div>", f"<p>{text[:cut]}<!-- x --><span>{text[cut:]}</span>"]))
    links = "".join(f"<li><a href=/{i}>{rng.choice(words)}</a></li>" for i in range(rng.randint(2, 9)))
    around = [f"<ul>{links}</ul>", f'<div class="{rng.choice(["sidebar", "site-footer", "cookie-notice", "ad-slot", "comment-list"])}"><p>{prose(12)}</p></div>']
    rng.shuffle(around)
    return f"<html><body>{around[0]}<div>{''.join(body)}</div>{around[1]}</body></html>", "\n".join(want)


@pytest.mark.parametrize("seed", range(60))
def test_generated_pages_without_an_article(seed):
    html, want = generated(random.Random(seed))
    assert H.main_text(html) == want


@pytest.mark.parametrize("unit", ['<a x="', '<a "\'> ', "<div>x", "</b>", "<li>a", "<p><b>", "<!", "<td>", '<span class="ad">x</span>', "<ul><li><a>x</a>"])
def test_a_megabyte_of_bad_markup_is_read_in_time(unit):
    start = time.time()
    H.main_text("<p>first</p>" + unit * ((1 << 20) // len(unit)))
    assert time.time() - start < 60
    if unit == '<a x="':
        assert time.time() - start < 1


@pytest.mark.parametrize("html", [None, "", " ", "<", "<p", "</p>", "<!--", "<script>x", "a < b", "<b><p></b>x", "&#xZZ;&amp", "<a title=\"x>y\">t</a>", "<p class='a\">x", "\x00<\x00>"])
def test_odd_pages_do_not_fail(html):
    assert isinstance(H.main_text(html), str)


def test_random_markup_does_not_fail_or_invent():
    rng = random.Random(9)
    bits = ["<p>", "</p>", "<div class=ad>", "</div>", "<article>", "</article>", "word ", "&amp;", "<b>", "<li>", "<ul>", "</ul>", "<td>", "<table>", "</table>", "<br>", "<script>", "</script>", "<!--", "-->", "<a href='", "'>", "\n"]
    for _ in range(300):
        html = "".join(rng.choice(bits) for _ in range(80))
        for line in H.main_text(html).split("\n"):
            assert line == " ".join(line.split())


def test_deep_markup():
    assert "deep" in H.main_text("<article>" + "<div>" * 3000 + "deep words in the middle of the page." + "</div>" * 3000)


def test_rows(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "t"), (2, None, None, None), (None, "u", "", ""), (1, "u", PAGE, "t")], "page_id bigint, url string, html string, text string")
    got = H.extract(df).collect()
    assert len(got) == 4 and {(r.page_id, r.text, r.n_chars) for r in got if r.page_id != 1} == {(2, "", 0), (None, "", 0)}
    assert all(r.n_chars == len(r.text) > 100 for r in got if r.page_id == 1)
    assert H.extract(df.limit(0)).collect() == []


NOTICES = ["Copyright 2024 Foo Inc. All rights reserved.", "We use cookies to make this site better. By going on you accept our privacy policy.", "Subscribe to our newsletter, and never miss a story again."]


@pytest.mark.parametrize("notice", NOTICES)
def test_notices_without_marks(notice):
    body = f"<div>{LONG}</div><div>A short line</div><div>{LONG}</div>"
    for page in (f"<body>{body}<div>{notice}</div></body>", f'<body><div class="x1">{notice}</div>{body}</body>', f'<body><div class="x1">{notice}</div><article>{body}</article></body>'):
        assert H.main_text(page).split("\n") == [LONG, "A short line", LONG]


def test_texts_on_notices_stay():
    said = "The new law asks that sites that use cookies say so in a privacy policy, which a lawyer called overdue when we spoke about it on Tuesday morning at some length."
    assert H.main_text(f"<body><article><p>{LONG}</p><p>{said}</p><p>{LONG}</p></article></body>").split("\n") == [LONG, said, LONG]


def test_prose_beside_an_article_goes_with_what_surrounds_it():
    prose = "A text without any mark, which is long enough to look like prose by itself and ends with a full stop, but stands beside the article of the page and so isn't part of it at all."
    assert H.main_text(f'<body><div class="x1"><p>{prose}</p></div><article><p>{LONG}</p><p>{LONG}</p></article></body>').split("\n") == [LONG, LONG]
    # an article element that holds little doesn't rule out the rest
    assert prose in H.main_text(f"<body><article><p>Read this, too.</p></article>{f'<p>{prose}</p>' * 9}</body>")


def test_marks_and_neighbours_decide_what_a_text_leaves_open():
    page = H.Page(PAGE)
    costs, edges = H.graph(page)
    labels = H.min_cut(costs, edges)
    near = [0] * len(costs)
    for (i, j), c in edges.items():
        near[i] += c
        near[j] += c
    texts = range(len(page.runs))
    flipped = [i for i in texts if (costs[i] > 0) != labels[i]]
    assert sum(abs(costs[i]) < near[i] for i in texts) > len(texts) / 2 and len(flipped) >= 4


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no tables")
def test_articles_of_the_test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for r in pages.collect():
        body = re.search("<article>(.*)</article>", r.html, re.DOTALL)[1]
        parts = [" ".join(unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", body)]
        want[r.page_id] = "\n".join(p for p in parts if p)
    got = {r.page_id: r.text for r in H.op6_html_extraction(spark, "/root/testdata/sf0.01").collect()}
    assert got == want
    # by their text alone many blocks would be labelled otherwise
    texts = flipped = 0
    for r in pages.collect():
        page = H.Page(r.html)
        labels = H.min_cut(*H.graph(page))
        texts += len(page.runs)
        flipped += sum((H.cost(run) > 0) != label for run, label in zip(page.runs, labels, strict=False))
    assert flipped > texts / 20
