import itertools
import random
import re
from html import unescape

import numpy as np
import pytest

from innlake.llm import queries
from innlake.llm.html_text import PRIOR, blocks_of, hinted, main_texts, page_text, source_side

RICH = """<!doctype html><html><head><title>T</title><style>p{}</style><script>if (a<b) document.write("</p>")</script></head>
<body class="page has-sidebar"><header><h2>Site name</h2><p>All the news that fits, every single day of the year.</p></header>
<nav><ul><li><a href=/>Home</a></li><li><a href=/x>World</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies to make this site better for you. Please accept them all today.</p></div>
<div id="wrapper"><div class="content"><h1>Rivers &amp; trees</h1>
<p>The   first paragraph &lt;tag&gt; has<br>two lines, and a <a href="/l">link</a> in it.
<div class="ad">Buy our wonderful soap, it is the best soap that money can buy.</div>
<p>The second paragraph &eacute;t&#233; is here, and it goes on for some more words.
<ul><li>A point that is made in the list of the article.</li><li>Another point of it.</li></ul>
<form><label>Mail</label><input name=q><button>Go</button></form>
<div class="comments"><h3>Comments</h3><p>I disagree with everything that was said here, and so does my dog.</p></div></div>
<aside><h3>More</h3><p>Another long story that you may like to read after this one.</p></aside></div>
<footer>&copy; 2024 Somebody. All rights reserved.</footer></body></html>"""
WANT = [
    "Rivers & trees", "The first paragraph <tag> has two lines, and a link in it.", "The second paragraph été is here, and it goes on for some more words.",
    "A point that is made in the list of the article.", "Another point of it.",
]


def test_page_without_article_element():
    assert page_text(RICH, PRIOR).split("\n\n") == WANT


WRAPPERS = ["layout has-sidebar", "overflow-hidden", "page-header-fixed", "tags-page", "search-page", "social-site", "site-wrapper", "no-comments", "with-banner", "hidden"]
CONTENTS = ["content", "post-body", "entry-content"]


def test_layouts_without_article():
    """Thirty layouts: what is found of the text, and how much of what is found is text."""
    found = right = wanted = 0
    for k, (wrapper, inner) in enumerate(itertools.product(WRAPPERS, CONTENTS)):
        paragraphs = [f"Paragraph {n} of story {k} tells at some length what happened on that day, and why it mattered to everybody." for n in range(3 + k % 4)]
        extra = ["Read our other stories about the very same thing right here, every day.", "We use cookies to make this site better for all of you.", "I disagree with every single word of it."]
        html = (f'<html><body><div class="{wrapper}"><div class="site-header"><p>The daily site of all news</p></div><div class="nav-list"><a href=/>Home</a> <a href=/w>World</a></div>'
                f'<div class="{inner}"><h1>Story {k}</h1>{"".join(f"<p>{p}</p>" for p in paragraphs)}</div><div class="sidebar-left"><p>{extra[0]}</p></div>'
                f'<div id="cookie-notice"><p>{extra[1]}</p></div><div class="comment-list"><p class="comment-body">{extra[2]}</p></div><div class="site-footer">© Somebody</div></div></body></html>')
        got, want = page_text(html, PRIOR).split("\n\n"), [f"Story {k}", *paragraphs]
        found, right, wanted = found + len([g for g in got if g]), right + len(set(got) & set(want)), wanted + len(want)
    assert right / wanted >= 0.9 and right / found >= 0.9


def test_whole_names():
    assert [n for n in ("site-header", "sidebar-left", "cookieNotice", "comment-body", "nav", "main-menu", "ads") if not hinted(n)[0]] == []
    assert [n for n in ("has-sidebar", "overflow-hidden", "page-header-fixed", "tags-page", "search-page", "social-site", "shadow", "navy", "loader") if hinted(n)[0]] == []
    assert hinted("post-content") == (False, True) and hinted("x1") == (False, False)


def test_long_comments_stay_out():
    html = '<body><div class="story"><h1>News</h1><p>A short story was told by somebody, and it ended well.</p></div><section class="comments"><h3>Comments</h3>' + (
        '<div class="comment-body"><p>I have a lot to say about all of this, and I will say it again and again.</p></div>' * 40) + "</section></body>"
    assert page_text(html, PRIOR).split("\n\n") == ["News", "A short story was told by somebody, and it ended well."]


def test_hidden_is_an_attribute():
    text = "<p>A sentence of the story that has quite a few words in it.</p>"
    assert page_text(f'<div class="content"><div hidden>{text}</div></div>', PRIOR) == page_text(f'<div class="content"><div style="display: none">{text}</div></div>', PRIOR) == ""
    assert page_text(f'<div class="content" data-x="hidden" title="a hidden thing">{text}</div>', PRIOR) != ""


@pytest.mark.parametrize("html", [None, "", "   ", "<p>", "<script>x", "<!-- never closed", "<nav>a</nav>", "</div></p>", "<" * 50, "&nbsp;"])
def test_odd_pages_do_not_crash(html):
    assert page_text(html, PRIOR) in ("", "<" * 50)


def test_long_and_deep_pages():
    long = "<article>" + "<p>A sentence with several plain words in it.</p>" * 5000 + "</article>"
    assert page_text(long, PRIOR).count("\n\n") == 4999
    assert page_text("<div>" * 5000 + "<article><p>Deep text with several words in it.</p>", PRIOR) == "Deep text with several words in it."


def test_minimum_cut_against_all_labellings():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randint(1, 8)
        a, b = (np.array([rng.random() * 3 for _ in range(n)]) for _ in range(2))
        edges = [(u, v, rng.random()) for u, v in itertools.combinations(range(n), 2) if rng.random() < 0.5]
        cost = lambda m: sum(b[k] if m[k] else a[k] for k in range(n)) + sum(w for u, v, w in edges if m[u] != m[v])
        best = min(cost(m) for m in itertools.product([False, True], repeat=n))
        assert cost(source_side(a, b, edges)) == pytest.approx(best)


def test_query_gives_the_articles(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    got = {r.page_id: r for r in queries.op5_html_text(spark, sf_dir).collect()}
    assert len(got) == len(pages)
    for page in pages:
        article = re.search(r"<article>(.*)</article>", page.html, re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[page.page_id].text == "\n\n".join(b for b in blocks if b)
        assert got[page.page_id].n_chars == len(got[page.page_id].text)


def test_tables(spark):
    rows = spark.createDataFrame([(1, None, 5), (1, RICH, 5), (1, RICH, 5), (2, "", 5)], "page_id long, html string, text int")
    assert sorted(r.text for r in main_texts(rows).collect())[:2] == ["", ""]
    assert main_texts(rows.limit(0)).count() == 0


def test_blocks_keep_page_order():
    assert blocks_of("<div>a<p>b</p>c</div>d")[0] == ["a", "b", "c", "d"]
