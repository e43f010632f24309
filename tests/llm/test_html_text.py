from __future__ import annotations

import html
import re

import pytest

from staylake.llm import queries as Q
from staylake.llm.html_text import FEATURES, LABELLED, blocks, extract_text, fit_block_tree, is_main, main_text

from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def tree(spark):
    return fit_block_tree(spark)


def test_tree_fits_its_table(tree):
    assert all(is_main(tree, r[:-1]) == bool(r[-1]) for r in LABELLED)


def test_pages_give_their_article(spark, tree):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    for r in extract_text(pages, tree=tree).collect():
        body = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        spaced = re.sub(r"</?(?:p|h1|br)\b[^>]*>", " ", body)
        assert r["text"] == " ".join(html.unescape(re.sub(r"<[^>]*>", "", spaced)).split())


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<p>", ""),
        ("<article><h1>A &amp; B</h1><p>c<b>d</b>e&nbsp;f &#8212; g<p>h", "A & B cde f — g h"),
        ("<header>Site</header><nav><a href=x>Home</a></nav><main><p>Body text.</p></main><footer>us</footer>", "Body text."),
        ("<div class='cookie-banner'>We set cookies on this page and others</div><article><p>Text.</p></article>", "Text."),
        ("<div class='ad'>buy<article><p>Text of the page.</p></article></div>", "Text of the page."),
        ("<article><p>Text.</p><aside>Aside</aside><form>Mail <input><button>Go</button></form><p>End.</p></article>", "Text. End."),
        ("<article><p>Text.</p></article><section id='comments'><article class='comment'><p>Nice one!</p></article></section>", "Text."),
        ("<article><script>var a='<p>no</p>'</script><style>p{}</style><!-- no --><p>yes</p></article>", "yes"),
        ("<article><header><h1>Title</h1></header><p>One <a href=x>two</a> three.</p></article>", "Title One two three."),
        ("<article><p>a</p><![if x]><p>b</p><![endif]></article>", "a b"),
        ("<article><p>a</p><datalist><option value=a><option value=b></datalist><p>Rest of it.</p></article>", "a Rest of it."),
        ("<article><p>a</p><option>x<p>y</article><p>b c</p>", "a b c"),
        ("<article><svg><g><p>x</p></g>z</svg><p>a</p><select><option>1<option>2</select><p>b</p></article>", "a b"),
        ("<article><p>See</p><ul><li><a href=1>One</a></li><li><a href=2>Two a</a></li><li><a href=3>Three</a></li><li><a href=4>Four</a></li></ul></article>", "See One Two a Three Four"),
        ("<article><div class='article-header'><h1>My title</h1></div><p>Text.</p></article>", "My title Text."),
        ("<article><section class='social-history'><p>Of people.</p></section><div class='share-buttons'>Share</div></article>", "Of people."),
        ("<body><p>A first sentence.</p><p>Short.</p><p>Tiny one.</p>", "A first sentence. Short. Tiny one."),
        ("<article><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>", "So x=2 holds."),
        ("<div class='site-header'>Site name</div><main><p>Body.</p></main><div id='page-footer'>us</div>", "Body."),
    ],
)
def test_cases(tree, page, text):
    assert main_text(page, tree) == text


def test_long_pages_and_edges(spark, tree):
    long = "<article>" + "<p>some words of a long page</p>" * 20_000 + "</article>"
    assert len(blocks(long)) == 20_000
    df = spark.createDataFrame([(1, None, "a"), (2, long, "b"), (2, long, "b")], "page_id long, html string, text string")
    got = sorted(len(r["text"]) for r in extract_text(df, tree=tree).collect())
    whole = len(" ".join(["some words of a long page"] * 20_000))
    assert got == [0, whole, whole]
    assert extract_text(df.limit(0), tree=tree).count() == 0


WORDS = "the quick brown fox jumps over the lazy dog and then it goes home to sleep for a very long time".split()


def _words(n, k=0):
    return " ".join(WORDS[(i + k) % len(WORDS)] for i in range(n)) + "."


def _links(n):
    return "".join(f"<div><a href=/{i}>{WORDS[i]} {WORDS[i + 1]}</a></div>" for i in range(n))


@pytest.mark.parametrize("k", range(12))
def test_pages_whose_elements_tell_nothing(tree, k):
    """Only words, link density and neighbours tell the article from the links and lines around it."""
    paragraphs = ["Title of page", _words(25 + 3 * k, k), _words(40, k), _words(4 + k % 5), _words(30 + k), _words(18 + 2 * k)]
    body = "".join(f"<div>{p}</div>" for p in paragraphs)
    linked = paragraphs[2].replace("quick", "<a href=/x>quick</a>", 1)
    page = f"<div><div>{_links(3 + k % 4)}</div>{body.replace(paragraphs[2], linked)}<div>{_links(2 + k % 5)}</div><div>Some rights kept</div></div>"
    assert main_text(page, tree) == " ".join(paragraphs)


def test_tree_is_more_than_the_tags(tree):
    """Below the flags the tree asks for words, links and neighbours."""
    used = set()

    def walk(node):
        if isinstance(node, tuple):
            used.add(FEATURES[node[0]])
            walk(node[2])
            walk(node[3])

    walk(tree)
    assert {"words", "links"} <= used and used & {"links_before", "links_after", "words_before", "words_after"}


def test_query(spark):
    rows = {r["page_id"]: r for r in Q.op3_html_text(spark, SF_SMALL).collect()}
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    assert len(rows) == len(pages) and all(rows[p["page_id"]]["n_chars"] == len(rows[p["page_id"]]["text"]) > 0 for p in pages)
