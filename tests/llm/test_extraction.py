"""The densities decide, whatever article elements a page has."""

import pytest

from tidemark.llm import extraction

LONG = [f"Paragraph {i} of the main text goes on for long enough, " + "and on with words, " * 12 + "to its end." for i in range(5)]
MAIN = "".join(f"<p>{x}</p>" for x in LONG)


@pytest.mark.parametrize(
    "page",
    [
        f"<body><article><h2>Teaser</h2><p>Read this too</p></article><div class=text>{MAIN}</div></body>",
        f"<body><div class=text>{MAIN}</div><article><a href=x>Another card</a></article></body>",
        f"<body><main><article><p>Short card</p></article></main><div>{MAIN}</div></body>",
        f"<body><div>{MAIN}</div></body>",
    ],
)
def test_main_text_in_plain_divs(page):
    found = extraction.main_text(page).split("\n")
    assert [x for x in found if x in LONG] == LONG
    assert not {"Teaser", "Another card"} & set(found)


def test_the_densest_article_is_whole():
    page = f"<body><div><p>Some words beside it</p></div><article><h1>Title</h1>{MAIN}<p>Short end.</p></article></body>"
    assert extraction.main_text(page).split("\n") == ["Title", *LONG, "Short end."]
