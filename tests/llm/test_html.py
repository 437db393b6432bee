"""Main text of whole pages against expected texts that owe nothing to the classifier, and hostile pages in linear time."""

import html as html_lib
import random
import re
import time

import pytest

from skerry.llm import html


def plain(page):
    """The article of the driver's pages: nothing but headings and paragraphs."""
    article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    pieces = (re.sub(r"<[^>]*>", lambda m: " " if m[0] == "<br>" else "", x) for x in re.split(r"</?(?:p|h1)>", article))
    return "\n".join(x for x in (re.sub(r"\s+", " ", html_lib.unescape(x)).strip() for x in pieces) if x)


def test_pages_equal_the_plain_version(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    want = {r.page_id: plain(r.html) for r in pages.collect()}
    assert {r.page_id: r.text for r in html.find(pages).collect()} == want


#: Boilerplate of every kind, by hand.
AROUND = [
    '<nav id="main-nav"><ul><li><a href="/">Home</a></li><li><a href="/about">About us</a></li></ul></nav>',
    '<div class="breadcrumbs"><a href="/">Start</a> / <a href="/n">News</a></div>',
    '<header class="site-header"><div class="logo">Daily Paper</div><p>All the news</p></header>',
    '<aside class="sidebar"><h3>Most read</h3><ul><li><a href="/1">The first story of the day</a></li></ul></aside>',
    '<div id="cookie-consent"><p>We use cookies to make this site better. By going on you agree.</p><button>Accept</button></div>',
    '<div class="advertisement">Save up to 50 % on shoes today!</div>',
    '<form action="/s"><label>Your email</label><input name="q"><button>Send</button></form>',
    '<section id="comments"><h2>3 comments</h2><div class="comment"><p>I agree with all that was said here, thanks.</p></div></section>',
    '<div class="newsletter-signup"><p>Get our newsletter every morning, for free.</p></div>',
    '<script>var x = "<p>never shown</p>";</script><style>p { color: red }</style>',
    '<div class="related-posts"><h3>Related</h3><a href="/2">Another story</a></div>',
    "<footer><p>&copy; 2024 Daily Paper. All rights reserved.</p></footer>",
    '<div hidden><p>Hidden words that nobody sees.</p></div>',
]
#: Pieces of an article and their text.
INSIDE = [
    ("<p>The council met on Tuesday, and it voted for the new bridge after a long debate.</p>", "The council met on Tuesday, and it voted for the new bridge after a long debate."),
    ("<h2>What comes next</h2>", "What comes next"),
    ("<p>Work starts in <b>May</b> &amp; ends\n in <a href='/d'>December</a>.</p>", "Work starts in May & ends in December."),
    ("<ul><li><a href='/a'>Plan of the bridge</a></li><li><a href='/b'>Costs</a></li></ul>", "Plan of the bridge\nCosts"),
    ("<blockquote>It is a good day for the town, said the mayor.</blockquote>", "It is a good day for the town, said the mayor."),
    ("<p>No.</p>", "No."),
    ("<table><tr><td>Length</td><td>120 m</td></tr></table>", "Length\n120 m"),
    ("<p>D&eacute;j&agrave; vu &#8212; again</p>", "Déjà vu — again"),
]


@pytest.mark.parametrize("seed", range(12))
def test_every_kind_of_boilerplate(seed):
    r = random.Random(seed)
    around = r.sample(AROUND, len(AROUND))
    k = r.randint(2, len(around) - 2)
    first = [("<h1>Town gets a new bridge</h1>", "Town gets a new bridge"), INSIDE[0]]
    inside = first + r.sample(INSIDE[1:], r.randint(2, len(INSIDE) - 1))
    wrap = r.choice(["<article>{}</article>", '<main><article class="post">{}</article></main>', '<div class="content"><article>{}</article></div>'])
    page = f"<!doctype html><html><head><title>Town</title></head><body>{''.join(around[:k])}{wrap.format(''.join(x for x, _ in inside))}{''.join(around[k:])}</body></html>"
    assert html.extract(page, html.classifier()) == "\n".join(t for _, t in inside)


HOSTILE = {
    "open quotes": "<a title='x " * 80_000, "marks in quotes": "<a '>' " * 140_000, "deep": "<div>" * 200_000 + "</p>" * 10_000, "lists": "<ul>" + "<li><div>" * 100_000, "terms": "<dl><dd>" + "<div>" * 50_000 + "<dd></dd>" * 50_000,
    "cdata": "<![CDATA[" * 100_000, "less": "<" * 1_000_000, "declarations": "<!" * 500_000, "noscript": "<noscript>" * 100_000, "comments": "<!--" * 250_000,
}


@pytest.mark.parametrize("name", list(HOSTILE))
def test_time_is_linear(name):
    """A megabyte takes no more than some four times a quarter of it."""
    page, weights = HOSTILE[name], html.classifier()
    times = []
    for part in (page[: len(page) // 4], page):
        began = time.process_time()
        html.extract(part, weights)
        times.append(time.process_time() - began)
    assert times[1] < 12 * times[0] + 0.5


def test_open_quotes_lose_no_text():
    page = "<article><p title='never closed>First paragraph, with some words.</p><p>Second paragraph, with more words.</p></article>"
    assert html.extract(page, html.classifier()) == "First paragraph, with some words.\nSecond paragraph, with more words."


def test_text_below_the_nesting_limit_stays():
    page = "<article>" + "<div>" * 1000 + "<p>Deep words stay where they are, of course.</p>" + "</div>" * 1000 + "<p>After them comes this.</p></article>"
    assert html.extract(page, html.classifier()) == "Deep words stay where they are, of course.\nAfter them comes this."
