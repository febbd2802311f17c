"""Names of layout wrappers and words inside other attributes don't make an article boilerplate."""

import pytest

from tidemark.llm.html_text import PRIOR, main_text

STORY = "The tide came in before dawn and covered the whole of the lower harbour wall."
MENU = "<div class='menu'><a href='/'>Home</a> <a href='/x'>About us</a></div>"


@pytest.mark.parametrize(
    "wrapper",
    ["class='layout has-sidebar'", "class='no-sidebar'", "class='container with-ads'", "class='layout with-header'", "class='sidebar'", "id='search'", "class='navy'"],
)
@pytest.mark.parametrize("mark", ["article", "main"])
def test_wrappers(wrapper, mark):
    assert main_text(f"<body>{MENU}<div {wrapper}><{mark}><p>{STORY}</p></{mark}></div></body>", PRIOR) == STORY


@pytest.mark.parametrize("tag", ["article class='post comments-open'", "main class='search'", "article title='Hidden gems'"])
def test_marked_itself(tag):
    assert main_text(f"<body>{MENU}<{tag}><p>{STORY}</p></{tag.split()[0]}></body>", PRIOR) == STORY


@pytest.mark.parametrize("part", ["section id='related-work'", "section id='search-algorithms'", "div class='legal-text'", "div class='navy'", "a href='/the-hidden-lake'", "div data-x=\"class='menu'\""])
def test_parts_of_an_article(part):
    made = main_text(f"<article><p>{STORY}</p><{part}>Second part of it.</{part.split()[0]}></article>", PRIOR)
    assert "Second part of it." in made


@pytest.mark.parametrize("name", ["related-posts", "site-footer", "comment-list", "left_sidebar", "ad", "ad-slot-2", "side-bar", "sign-up", "share-buttons", "comments"])
def test_boilerplate_stays_out(name):
    page = f"<article><p>{STORY}</p><div class='{name}'><article>Another story</article> and more</div></article>"
    assert main_text(page, PRIOR) == STORY


def test_plain_form_and_cards_stay_out():
    page = f"<div><p>{STORY}</p></div><form>Your name please</form><div class='related'><article>One card</article><article>Two cards</article></div>"
    assert main_text(page, PRIOR) == STORY
