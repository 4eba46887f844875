"""Main text of pages."""

import html
import re
from itertools import product
from math import exp

import pytest

from tidemark.llm.html_text import CLOSED, Tree, extracted, learned, main_text
from tidemark.llm.labelled_pages import PAGES
from tidemark.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

ARTICLE = "<article><h1>A title</h1><p>First &amp; best.</p><p>Second\n  one&nbsp;<b>bold</b></p></article>"
TEXT = "A title\n\nFirst & best.\n\nSecond one bold"

BOILERPLATE = [
    "<nav><ul><li><a href=/>Home</a></li></ul></nav>",
    "<header><p>The site</p></header>",
    "<footer>&copy; them</footer>",
    "<aside><p>aside</p></aside>",
    '<div class="sidebar"><p>about</p></div>',
    '<div class="cookie-notice"><p>We use cookies.</p></div>',
    '<div class="ad">Buy.</div>',
    "<form><label>Name</label><input><select><option>x</select><textarea>y</textarea></form>",
    '<section id="comments"><div class="comment"><p>' + "I read this and liked it. " * 30 + "</p></div></section>",
    "<script>var t='</p>';</script><style>p{}</style><!-- a comment -->",
]


@pytest.mark.parametrize("part", BOILERPLATE)
def test_boilerplate_goes_beside_and_without_an_article_element(part):
    body = ARTICLE.removeprefix("<article>").removesuffix("</article>")
    assert main_text(f"<html><body>{part}{ARTICLE}{part}</body></html>") == TEXT
    assert main_text(f"<body>{part}<div class=text>{body}</div>{part}</body>") == TEXT


@pytest.mark.parametrize("part", [p for p in BOILERPLATE if "<header" not in p])
def test_boilerplate_goes_inside_the_article(part):
    assert main_text(ARTICLE.replace("<p>Second", part + "<p>Second")) == TEXT


@pytest.mark.parametrize(
    "name", ["share-of-market", "related-work", "comment-policy", "popular-science", "search-algorithms", "advertising-history"]
)
@pytest.mark.parametrize("attribute", ["class", "id"])
def test_chapters_are_not_dropped_for_a_word_of_their_name(name, attribute):
    part = f'<section {attribute}="{name}"><h2>More</h2><p>It is a chapter of its own.</p></section>'
    wanted = TEXT.replace("Second", "More\n\nIt is a chapter of its own.\n\nSecond")
    assert main_text("<body>" + ARTICLE.replace("<p>Second", part + "<p>Second") + "</body>") == wanted
    assert main_text(f"<body><main>{ARTICLE.replace('<p>Second', part + '<p>Second')}</main></body>") == wanted


@pytest.mark.parametrize("name", ["comment", "share", "related-posts", "cookie-notice", "sidebar widget", "comment unheard-of"])
def test_names_that_are_clear_still_tell(name):
    part = f'<div class="{name}"><p>It is not part of the text.</p></div>'
    assert main_text("<body>" + ARTICLE.replace("<p>Second", part + "<p>Second") + "</body>") == TEXT


def test_labelled_pages_are_learned():
    model = learned()
    for page in PAGES:
        nodes = Tree(page).nodes
        for wanted, p, node in zip(model._labels(nodes), model.marginals(nodes), nodes):
            assert node.hidden or wanted == (p >= 0.5), (node.tag, node.tokens)


def test_a_page_left_out_of_training_is_labelled_well():
    right = seen = 0
    for n, page in enumerate(PAGES):
        model = type(learned())(PAGES[:n] + PAGES[n + 1 :])
        tree = Tree(page)
        wanted, p = model._labels(tree.nodes), model.marginals(tree.nodes)
        for node, w, x in zip(tree.nodes, wanted, p):
            right, seen = right + node.own * (w == (x >= 0.5)), seen + node.own
    assert right / seen > 0.85


def test_messages_give_the_marginals_of_all_labellings():
    """Against a sum over every labelling of a small tree."""
    model = learned()
    nodes = Tree("<div><p>some text</p><nav><a href=/>x</a></nav><aside>yy</aside></div>").nodes
    own, to_yes, to_no = model.potentials(nodes)
    weights = [0.0] * len(nodes)
    total = 0.0
    for labels in product((0, 1), repeat=len(nodes)):
        score = sum(own[n] * labels[n] for n in range(len(nodes)))
        for n in range(1, len(nodes)):
            below_content = to_yes[n] if labels[n] else to_no[n]
            score += below_content if labels[nodes[n].parent] else -CLOSED * labels[n]
        total += exp(score)
        weights = [w + exp(score) * y for w, y in zip(weights, labels)]
    assert model.marginals(nodes) == pytest.approx([w / total for w in weights])


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain <b>text</b>", "plain text"),
        ("<p>one<p>two<br>three", "one\n\ntwo three"),
        ("<p>a &lt;b&gt; &#233; &copy 2020", "a <b> é © 2020"),
        ("<p>a<!-- open <p>b", "a"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a\n\nb\n\nc\n\nd"),
        ("<nav>only a menu</nav>", ""),
        ("</p></div><p>x</b>", "x"),
        ("<style>/* <!-- */ p{}</style><p>a</p>", "a"),
        ("<p title='a <!-- b'>c</p><p>d</p>", "c\n\nd"),
        ("<script>'<!--'</script><p>a</p>", "a"),
        ("<title>x <!-- y</title><body><p>a</p>", "a"),
        ("<textarea>x <!-- y</textarea><p>a</p>", "a"),
        ("<p>a<!-- b --><p>c<!-- open <p>d", "a\n\nc"),
        ("<p>a<!--> b", "a b"),
        ("<p>If <math><mi>x</mi><mo>=</mo><mn>1</mn></math> then</p>", "If x=1 then"),
    ],
)
def test_defined_results(page, text):
    assert main_text(page) == text


def test_deep_and_long_pages():
    assert main_text("<div>" * 20_000 + "deep") == "deep"
    assert len(main_text("<p>" + "word " * 300_000 + "</p>")) == 1_499_999


def test_rows(spark):
    rows = [(1, "u", f"<body>{ARTICLE}</body>", 9), (1, "u", f"<body>{ARTICLE}</body>", 9), (None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    got = sorted(map(tuple, extracted(pages).collect()), key=str)
    assert got == [(1, "u", TEXT, len(TEXT))] * 2 + [(None, None, "", 0)]
    assert extracted(pages.limit(0)).count() == 0


def test_query_against_the_article_elements(spark):
    """The test pages have an article element each, whose blocks are the main text."""
    got = {r.page_id: r for r in QUERIES["op1_html"](spark, SF_DIR).collect()}
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:
        inside = re.search("<article>(.*)</article>", page.html, re.S)[1]
        blocks = [re.sub("<br>", " ", b) for b in re.split("</?(?:p|h1)>", inside)]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks]
        text = "\n\n".join(b for b in blocks if b)
        assert (got[page.page_id].text, got[page.page_id].n_chars) == (text, len(text))
