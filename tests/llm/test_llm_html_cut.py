import itertools
import random
import time

import pytest

from dialogue_engine.llm import html_cut as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><h1>Site name</h1><a href=x>Home</a></header>
<nav><ul><li><a href="/a">First menu entry</a></li><li><a>Second</a></ul></nav>
<div class="cookie-notice">We use cookies &amp; more, as every site does these days.</div>
<main><div class="post"><h2>Head &lt;x&gt;</h2><p>Hello   world, this is the <b>main</b> text.</p>
<p>Short.</p><div class=ad>Buy now</div><ul><li>one<li>two</ul><script>var a = "</p>";</script>
<!-- hidden <p>comment</p> --></div>
<section id="comments"><h3>Comments</h3><article class="comment"><p>I really like this long article,
it is a great one, thanks for writing it.</p></article></section></main>
<aside class=sidebar><p>A related story that is long enough to look like content of the page.</p></aside>
<form><label>Name</label><input></form><footer>&copy; 2020 all rights reserved</footer></body></html>"""


def test_page():
    assert H.main_text(PAGE) == "Head <x> Hello world, this is the main text. Short. one two"


def test_unclosed_and_cut_markup():
    assert H.main_text("<article><p>One sentence here.<p>Another <b>bold one.<p>Third one") == (
        "One sentence here. Another bold one. Third one"
    )
    assert H.main_text("<article><p>A text that is cut off in the mid<scr") .startswith("A text that")
    assert H.main_text("<article><p>Keep this text.</p><script>never closed <p>x</p>") == "Keep this text."


def test_references_and_white_space():
    html = "<article><p>a&nbsp;&amp;&#233;&lt;b&gt;\n\t c&hellip; and so on it goes.</p></article>"
    assert H.main_text(html) == "a &é<b> c… and so on it goes."


SENTENCE = "This paragraph is long enough to be content all by itself."


@pytest.mark.parametrize(
    "middle",
    [
        "<svg/>",
        '<svg class="icon" />',
        "<svg><title>Icon</title><text>label</text></svg>",
        "<math><mi>x</mi></math>",
        "<noscript><p>Please turn on scripts.</p></noscript>",
        "<template><p>Row of a list to fill in.</p></template>",
        "<SCRIPT>if (a < b) { c = '</p>'; }</SCRIPT >",
    ],
)
def test_text_after_elements_that_are_not_text(middle):
    got = H.main_text(f"<article><p>First {SENTENCE}{middle} Then more.</p><p>{SENTENCE}</p></article>")
    inside = "x" if "math" in middle else ""
    assert got == f"First {SENTENCE}{inside} Then more. {SENTENCE}"


@pytest.mark.parametrize("name", ["noscript", "template", "svg"])
def test_unclosed_hidden_elements_end_with_their_parent(name):
    html = f"<article><p>{SENTENCE}</p><div><{name}><p>Turn on scripts to see this page.</div><p>Next {SENTENCE}</p></article>"
    assert H.main_text(html) == f"{SENTENCE} Next {SENTENCE}"


@pytest.mark.parametrize(
    "name, kept",
    [
        ("related-work", True),
        ("comment-quote", True),
        ("notice-board-history", True),
        ("search-algorithms", True),
        ("article-header", True),
        ("related-posts", False),
        ("comments", False),
        ("comment-list", False),
        ("cookie-notice", False),
        ("ad", False),
        ("adBanner", False),
        ("sidebar-left wide", False),
        ("share-buttons", False),
    ],
)
def test_names_inside_an_article(name, kept):
    html = f'<article><p>{SENTENCE}</p><section class="{name}"><p>Of this, too: {SENTENCE}</p></section><p>End: {SENTENCE}</p></article>'
    assert ("Of this" in H.main_text(html)) == kept


def test_quotes_and_angles():
    assert H.main_text(f'<article><p title="a > b">{SENTENCE}</p></article>') == SENTENCE
    assert H.main_text(f'<article><p class="x>{SENTENCE}</p><p>Next.</p></article>') == f"{SENTENCE} Next."
    assert H.main_text("<article><p>If 1 < 2 and 3 > 2, then all is well with it.</p></article>") == (
        "If 1 < 2 and 3 > 2, then all is well with it."
    )
    assert H.main_text(f"<article><p>{SENTENCE}</p><!-- never <p>closed") == SENTENCE


@pytest.mark.parametrize(
    "piece",
    ["<a ", '<a "', "<a '\">", '<a ">"', "<b>", "</i>", "<b></i>", "<svg>", "<noscript><p>x", "<!--", "<![", "< ", "<p>a", "<div>", "<script>", "&", "</"],
)
def test_broken_pages_take_no_longer(piece):
    """A megabyte of one fault in a row."""
    html = f"<article><p>{SENTENCE}</p>" + piece * (1_000_000 // len(piece))
    start = time.process_time()
    H.main_text(html)
    assert time.process_time() - start < 8


def cut_cost(lost, kept, edges, content):
    total = sum(k if c else l for l, k, c in zip(lost, kept, content))
    return total + sum(w for a, b, w in edges if content[a] != content[b])


def test_cut_against_all_labellings():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randrange(1, 9)
        lost, kept = ([rng.randrange(0, 30) for _ in range(n)] for _ in range(2))
        edges = [
            (a, b, rng.randrange(0, 20))
            for a, b in itertools.combinations(range(n), 2)
            if rng.random() < 0.5
        ]
        got = H.minimum_cut(lost, kept, edges)
        best = min(
            cut_cost(lost, kept, edges, labels) for labels in itertools.product((False, True), repeat=n)
        )
        assert cut_cost(lost, kept, edges, got) == best


def test_neighbours_decide_for_a_weak_block():
    """The same short line is content between paragraphs and boilerplate between links."""
    prose = "<p>This paragraph is long enough to be content all by itself, without any doubt.</p>"
    inside = f"<div>{prose}<div>see more</div>{prose}</div>"
    links = '<div><a href=x>one link here</a><div>see more</div><div><a href=y>another link there</a></div></div>'
    assert "see more" in H.main_text(inside)
    assert "see more" not in H.main_text(links)


@pytest.mark.parametrize("html", [None, "", "   ", "<html></html>", "<", "<p>", "</p></div>", "&", "<!--", "<a"])
def test_empty(html):
    assert H.main_text(html).strip() in ("", "&", "<", "<a")


def test_query(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", "<p>" + "long text. " * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = H.extract(pages).collect()
    assert len(got) == 5
    assert all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    assert by[2] == "" and by[None] == "" and len(by[3]) == 11 * 50_000 - 1
    assert H.extract(pages.where("false")).collect() == []
