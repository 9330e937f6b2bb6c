"""Names of the page's own layout do not make its article boilerplate."""

import pytest

from paperloom.llm.html_text import main_text

LONG = "A paragraph of the article with as many words as paragraphs have, so that it is read as text and nothing else, whatever stands around it."
SHORT = "A short one."
TEXT = f"<p>{LONG}</p><p>{SHORT}</p><p>{LONG}</p>"
WANTED = "\n".join((LONG, SHORT, LONG))


@pytest.mark.parametrize("page", [
    f'<body class="right-sidebar"><article>{TEXT}</article></body>',
    f'<html class="ad"><body class="sidebar"><main class="widget"><div>{TEXT}</div></main></body>',
    f'<body><article class="post comments-open">{TEXT}</article></body>',
    f'<body><div id="content-sidebar-wrap">{TEXT}</div></body>',
    f'<body><div class="page has-sidebar">{TEXT}</div></body>',
    f'<body><div class="sidebar"><div class="page"><div class="inner">{TEXT}</div></div></div></body>',
    f'<article><p>{LONG}</p><p class="related">{LONG}</p><p>{LONG}</p></article>',  # smoothness outweighs it
])
def test_layout_names(page):
    assert main_text(page) == (WANTED if 'class="related"' not in page else "\n".join([LONG] * 3))


@pytest.mark.parametrize("name", ["ad", "comments", "sidebar", "related"])
def test_boilerplate_still_goes(name):
    page = f'<body class="right-sidebar"><article>{TEXT}<div class="{name}">Buy it now</div></article><div class="{name}"><p>{SHORT}</p></div></body>'
    assert main_text(page) == WANTED
