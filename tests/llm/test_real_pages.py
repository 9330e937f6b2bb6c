"""Pages as sites write them, and the minimum cut against all cuts of small graphs."""

import itertools
import random

import pytest

from paperloom.llm.html_text import main_text, minimum_cut

LONG = "A paragraph of the article with as many words as paragraphs have, so that it is read as text and nothing else, whatever stands around it."
READER = "A reader writes something here that is about as long as what readers usually write below an article, and signs it."
ARTICLE = f"<article><h1>Title</h1><p>{LONG}</p><p>{LONG}</p></article>"
WANTED = "\n".join(("Title", LONG, LONG))


@pytest.mark.parametrize("name", [
    "comment-list", "user-comments", "comments-area", "article-comments", "post-comments", "comment-body", "comments", "sidebar-left", "right-sidebar",
    "article-sidebar", "site-footer", "cookie-banner", "newsletter-box", "related-posts", "share-bar",
])
def test_compound_names_of_boilerplate(name):
    text = READER if "comment" in name else "Something else of the site that is not long."
    assert main_text(f'<body>{ARTICLE}<div class="{name}"><p>{text}</p><p>{text}</p></div></body>') == WANTED
    assert main_text(f'<body>{ARTICLE}<section id={name}><div><p>{text}</p></div></section></body>') == WANTED


@pytest.mark.parametrize("name", ["entry-header", "post-header", "entry-content", "post-body", "content-sidebar-wrap", "has-sidebar", "comments-open", "ad-free-content"])
def test_compound_names_of_content(name):
    assert main_text(f'<body><article><div class="{name}"><h1>Title</h1><p>{LONG}</p><p>{LONG}</p></div></article></body>') == WANTED


@pytest.mark.parametrize("attributes", ["title=it's", "title=don't class=x", "data-x='a>b'", 'alt="x > y" title=o\'clock', "title=", "a=b=c'", "'", '"odd', "title = it's"])
def test_quotes_in_attributes(attributes):
    assert main_text(f"<body><article><p {attributes}>{LONG}</p><p>It's {LONG}</p></article>") == f"{LONG}\nIt's {LONG}"


@pytest.mark.parametrize("page, text", [
    ("Plain text without any markup.", "Plain text without any markup."), ("  two\n words &amp; more ", "two words & more"), ("a < b and b > c", "a < b and b > c"),
    ("", ""), (None, ""), ("<!-- only a comment -->", ""), ("<p", ""),
])
def test_pages_without_markup(page, text):
    assert main_text(page) == text


def test_minimum_cut_is_the_least_of_all_cuts():
    draw = random.Random(11)
    for _ in range(300):
        n = draw.randrange(1, 8)
        scores = [draw.randrange(-60, 61) for _ in range(n)]
        edges = [(a, b, draw.randrange(0, 40)) for a, b in itertools.combinations(range(n), 2) if draw.random() < 0.5]

        def cost(kept):
            return sum(max(s, 0) if not k else max(-s, 0) for s, k in zip(scores, kept, strict=True)) + sum(w for a, b, w in edges if kept[a] != kept[b])

        assert cost(minimum_cut(scores, edges)) == min(cost(kept) for kept in itertools.product([False, True], repeat=n))
