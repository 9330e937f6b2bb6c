"""Elements without text of the page end where they end, and take nothing else along."""

import pytest

from paperloom.llm.html_text import main_text

WORDS = "words of the article that go on for a while and then some more"
AFTER = f"<p>After {WORDS}.</p>"


@pytest.mark.parametrize("dropped", [
    "<svg class='i'/>", "<svg class='i' />", "<button>Like", "<object data='x'>", "<select><option>one<option>two", "<canvas>", "<audio src='a'>", "<video src='v'>",
    "<svg><path d='M0'/><title>icon</title><g/></svg>", "<button><div>Like</div></button>", "<noscript><p>No script</p></noscript>", "<template><div><p>x</p></div></template>",
    "<object><object><p>x</p></object><p>y</p></object>", "<script>if (a < b) document.write('<p>x</p>')</script>", "<select><option>one</select>",
])
def test_text_after_a_dropped_element_stays(dropped):
    assert main_text(f"<body><article><p>Before {WORDS}.</p>{dropped}{AFTER}</article>") == f"Before {WORDS}.\nAfter {WORDS}."
    assert main_text(f"<body><article><p>Before {WORDS}.{dropped}</p>{AFTER}</article>") == f"Before {WORDS}.\nAfter {WORDS}."


def test_a_far_end_tag_takes_nothing():
    page = f"<body><article><p>Before <span><button>Like</span> {WORDS}.</p>{AFTER}<button>More</button></article>"
    assert main_text(page) == f"Before {WORDS}.\nAfter {WORDS}."


def test_formulas_stay():
    page = f"<article><p>Let <math><mi>x</mi><mspace/><mo>=</mo><mn>1</mn></math> be {WORDS}.</p></article>"
    assert main_text(page) == f"Let x=1 be {WORDS}."
