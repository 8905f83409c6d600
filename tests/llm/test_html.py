import html
import re

import duckdb
import pytest

from kabuto.llm import html_extract as H
from kabuto.llm.queries import queries

from .conftest import SF

PAGE = """<html><head><title>T</title></head><body><header class=site><h1>Site</h1></header><div id="main">
<div class="sidebar"><p>Side links here and more words for you</p></div><div class="cookie-notice">We use cookies</div>
<p>One two  three\nfour five &lt;six&gt; seven.<p>Next &amp; more text <a href=x>linked</a> here<script>var a="<p>";</script></p>
<form><p>subscribe now please</p></form><p>Last words of the article, a few of them.</p>
<div class="comments"><p>I like this article a lot</p></div></div><footer>foot</footer>"""


def test_page_without_labels():
    expected = "One two three four five <six> seven.\n\nNext & more text linked here\n\nLast words of the article, a few of them."
    assert H.extract(PAGE, H.Weights({})) == expected


@pytest.mark.parametrize("page", [None, "", " ", "<", "<p", "plain words of a page", "<script>", "<!-- open", "</p></div>", "<p>" * 3000 + "deep words", "&am &#x41; a < b"])
def test_odd_pages(page):
    assert isinstance(H.extract(page, H.Weights({})), str)


@pytest.mark.parametrize("layout", [
    '<div class="page has-sidebar"><article>%s</article>%s</div>',
    '<main class="content with-nav">%s%s</main>',
    '<main class="with-nav"><article class="post share-enabled">%s</article>%s</main>',
    '<div class="page has-sidebar"><article class="post share-enabled">%s</article>%s</div>',
    '<form id="form1"><div class="wrap search-on">%s</div>%s</form>',
    '<main><div class="share-enabled">%s</div>%s</main>',
    '<div data-id="sidebar" data-role="nav">%s</div>%s',
])
def test_markers_of_the_layout(layout):
    body = "".join(f"<p>Paragraph {k} of the article has some more words.</p>" for k in range(8))
    rest = '<div class="comments"><article class="comment"><p>I like this a lot.</p></article></div><div class="sidebar">Other links</div>'
    page = f"<html><body><nav>Home</nav>{layout % (body, rest)}<footer>foot</footer></body></html>"
    expected = "\n\n".join(f"Paragraph {k} of the article has some more words." for k in range(8))
    assert H.extract(page, H.Weights({})) == expected


@pytest.mark.parametrize("inline", ['<div class="newsletter"><p>%s</p></div>', "<form><p>%s</p></form>", '<aside class="ad">%s</aside>'])
def test_boilerplate_inside_the_article_does_not_part_it(inline):
    lead, rest = "lead " * 60, "rest " * 70
    page = f"<body><nav>Home</nav><div><p>{lead}</p>{inline % ('form ' * 100)}<p>{rest}</p></div><footer>foot</footer></body>"
    pages = [f"<body><nav>Home</nav><article><p>{'some words ' * 20}</p>{inline % 'our letter'}</article><footer>{'foot ' * 50}</footer></body>"] * 5
    counts = H.Counter()
    for x in pages:
        H.count_labels(x, counts)
    for weights in (H.Weights({}), H.Weights(counts)):
        for x in (page, page.replace("<div><p>", "<article><p>").replace("</div><footer>", "</article><footer>")):
            assert H.extract(x, weights) == f"{lead.strip()}\n\n{rest.strip()}"


def test_best_stretch_is_the_maximum():
    weights = H.Weights({})
    tokens = [(t, H.block_text(t)) if isinstance(t, H.Block) else (t, None) for t in H.read_tokens(PAGE)]
    score = [weights.tag(t) if x is None else weights.word(t.context) * len(x.split()) for t, x in tokens]
    best = max(((sum(score[i:j]), i - j, i, j) for i in range(len(score)) for j in range(i + 1, len(score) + 1)))
    blocks = [x for t, x in tokens[best[2] : best[3]] if x and weights.word(t.context) > 0]
    assert H.extract(PAGE, weights) == "\n\n".join(blocks)


def test_query_gives_the_articles(spark):
    rows = queries()["op2_html_extraction"](spark, SF).collect()
    pages = duckdb.connect().execute(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall()
    assert len(rows) == len(pages)
    got = {r.page_id: r for r in rows}
    for i, page in pages:
        inside = re.search(r"<article>(.*)</article>", page, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
        assert got[i].text == "\n\n".join(b for b in blocks if b)
        assert got[i].n_chars == len(got[i].text)


def test_null_rows_and_empty_table(spark):
    pages = spark.createDataFrame([(None, None, None, "z"), (1, "u", "", "z"), (1, "u", PAGE, "z"), (1, "u", PAGE, "z")], "page_id long, url string, html string, text string")
    out = H.extract_text(pages, H.fit_weights(pages)).collect()
    assert sorted(len(r.text) > 0 for r in out) == [False, False, True, True]
    none = pages.limit(0)
    assert H.extract_text(none, H.fit_weights(none)).count() == 0


def test_an_articles_own_text_is_not_taken_for_a_marker():
    """Ids of headings, and compound names on paragraphs and sections, inside an article; formulas."""
    own = '<h1 id="notice">Notice to readers</h1><h2 id="search">How search works</h2><p class="social-history">A social history.</p><section id="related-work"><p>Work of others.</p></section><p>It holds where <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds.</p>'
    ads = '<p class="ad">Buy now</p><section class="related">More of this</section><p class="cookie-notice">We use cookies</p><ul class="share-buttons"><li>Mail</li></ul>'
    body = "".join(f"<p>Paragraph {k} has some more words of the article.</p>" for k in range(6))
    page = f"<html><body><nav>Home</nav><article>{own}{ads}{body}</article><footer>foot</footer></body></html>"
    expected = ["Notice to readers", "How search works", "A social history.", "Work of others.", "It holds where x=1 holds."]
    expected += [f"Paragraph {k} has some more words of the article." for k in range(6)]
    assert H.extract(page, H.Weights({})) == "\n\n".join(expected)


def test_a_very_long_page():
    page = "<article>" + "".join(f"<p>Paragraph {k} of a long article.</p>" for k in range(60_000)) + "</article><footer>foot</footer>"
    got = H.extract(page, H.Weights({}))
    assert got.count("\n\n") == 59_999 and got.endswith("Paragraph 59999 of a long article.")
