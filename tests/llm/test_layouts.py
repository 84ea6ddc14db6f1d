"""Extraction from layouts written by hand, and from a family of layouts left out of the training."""

import pytest

from asthen.llm import extraction, htmltrain

P1 = "The council voted on Tuesday to rebuild the old bridge, which has been closed since the flood of last spring."
P2 = "Engineers expect the work to take two years, and the town has set aside money for a ferry in the meantime."
P3 = "Shopkeepers on the far bank, who lost most of their trade, said that they were glad of the news."
HEAD = "Bridge to be rebuilt"
PAGES = {
    "aside in the article": (
        f"<header><h1>Daily</h1></header><article><h1>{HEAD}</h1><p>{P1}</p><aside><h3>Related story</h3>"
        f"<p>Last year the flood took away three houses and a mill, as we reported then.</p></aside><p>{P2}</p></article>",
        [HEAD, P1, P2]),
    "bare table": (
        "<table><tr><td><a href=/>Home</a> | <a href=/n>News</a> | <a href=/s>Sport</a></td></tr><tr><td>"
        f"<h2>{HEAD}</h2><p>{P1}</p><p>{P2}</p></td></tr><tr><td>&copy; 2024 The Daily Paper</td></tr></table>",
        [HEAD, P1, P2]),
    "bare boxes": (
        "<div><div><a href=/>Home</a></div><div><a href=/n>News</a></div></div>"
        f"<div><h1>{HEAD}</h1><p>{P1}</p><p>{P2}</p><p>{P3}</p></div>"
        "<div>Copyright 2023 Daily Paper. All rights reserved.</div>", [HEAD, P1, P2, P3]),
    "notices in the article": (
        f'<nav><a href=/>Home</a></nav><article><p>{P1}</p><div class="cookie-notice">We use cookies to make this '
        f"site better. By reading on you accept them.</div><p>{P2}</p><div class=ad>Buy our new shoes, they are the "
        f"best shoes of all.</div><p>{P3}</p></article>", [P1, P2, P3]),
    "comments": (
        f"<main><h1>{HEAD}</h1><p>{P1}</p><p>{P2}</p></main><div id=comments><h3>2 comments</h3><div>I think that "
        "this is good news for all of us, and high time too.</div><p>It will cost far too much, as it always does."
        "</p></div><footer>&copy; 2024 Paper</footer>", [HEAD, P1, P2]),
    "sidebar": (
        f"<div id=content><h1>{HEAD}</h1><p>{P1}</p><p>{P2}</p></div><div class=sidebar><h3>Most read</h3><p>A dog "
        "was found on the roof of the church, and no one knows how it got there.</p><ul><li><a href=/1>One</a></li>"
        "</ul></div>", [HEAD, P1, P2]),
}


@pytest.fixture(scope="module")
def field():
    return extraction.fit(htmltrain.labelled_pages())


@pytest.mark.parametrize("name", PAGES)
def test_pages_by_hand(field, name):
    body, want = PAGES[name]
    assert extraction.main_text(field, f"<html><body>{body}</body></html>").split("\n") == want


def test_license_lines_of_an_article_stay(field):
    page = f"<article><p>{P1}</p><p>All rights reserved.</p><p>{P2}</p></article>"
    assert extraction.main_text(field, page).split("\n") == [P1, "All rights reserved.", P2]


def rates(field, pages):
    """Share of blocks taken that are main text, and of main text that is taken."""
    both = taken = main = 0
    for page in map(extraction.blocks, pages):
        for x, b in zip(field.main(page), page):
            both, taken, main = both + (x and b.main), taken + x, main + b.main
    return both / taken, both / main


def test_other_pages_of_the_same_kinds(field):
    precision, recall = rates(field, htmltrain.labelled_pages(300, seed=9))
    assert precision >= 0.97 and recall >= 0.98


def test_a_family_left_out_of_the_training():
    """No page with a bare table for its layout is trained on; such pages are tested. Main text is found;
    what surrounds it is told from it less well than where the family was seen."""
    def is_table(page):
        return "<body><table>" in page

    train = [p for p in htmltrain.labelled_pages(400, seed=2) if not is_table(p)]
    test = [p for p in htmltrain.labelled_pages(800, seed=3) if is_table(p)]
    assert len(test) > 30
    precision, recall = rates(extraction.fit(train), test)
    assert precision >= 0.5 and recall >= 0.95, (precision, recall)
