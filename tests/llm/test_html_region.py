"""The scan decides the region; the registered query against a plain reading of the pages' articles."""

import random
from html.parser import HTMLParser

import pytest

from tidemark.llm import html_text
from tidemark.llm.html_text import PRIOR, Reading, best_reading, fit, labelled, main_text, read_page, trusted_marks
from tidemark.llm.queries import op8_html_text

STORY = "The tide came in before dawn and covered the whole of the lower harbour wall."
REST = "Boats that had been left on the mud floated again, and nobody was there to see it."
MENU = "<nav><a href='/'>Home</a> <a href='/x'>About us</a></nav>"
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "wrapper",
    ["div class='container has-sidebar'", "div class='layout with-sidebar'", "div id='no-sidebar'", "div class='search-page'", "div class='nav-open page'", "div class='legal-news'", "div class='promo-off'", "form id='aspnetForm'"],
)
@pytest.mark.parametrize("mark", ["article", "main class='content alert-free'", "div itemprop='articleBody'", "div"])
def test_wrapped_articles(wrapper, mark):
    page = f"<body>{MENU}<{wrapper}><{mark}><p>{STORY}</p><p>{REST}</p></{mark.split()[0]}></{wrapper.split()[0]}><footer>Site</footer></body>"
    assert main_text(page, PRIOR) == f"{STORY}\n{REST}"


def test_nothing_of_the_article_is_lost():
    assert main_text(f"<article><p>Energy is <math><mi>E</mi><mo>=</mo><mi>m</mi></math> here.</p><p>{STORY}</p></article>", PRIOR) == f"Energy is E=m here.\n{STORY}"
    unmarked = f"<body>{MENU}<div><p>In short:</p><p>{STORY}</p><p><a href='/y'>One whole link of it</a></p><p>{REST}</p><div><div><p>The last one.</p></div></div></div><footer>Site</footer></body>"
    assert main_text(unmarked, PRIOR) == f"In short:\n{STORY}\nOne whole link of it\n{REST}\nThe last one."
    parts = f"<article><p>{STORY}</p></article><div class='ad'>Buy now</div><article><p>{REST}</p></article><section class='related'><article><p>A card</p></article></section>"
    assert main_text(parts, PRIOR) == f"{STORY}\n{REST}"
    lead = f"<article><p>Ok.</p><div class='ad'>{'buy this ' * 50}</div><p>{STORY}</p><table>{'<tr><td></td></tr>' * 500}</table><p>End.</p></article>"
    assert main_text(lead, PRIOR) == f"Ok.\n{STORY}\nEnd."


@pytest.mark.parametrize("name", ["search", "widget", "social", "banner-wrapper"])
def test_wrapper_of_a_page_without_marks(name):
    """A boilerplate name around the whole page says nothing; names inside of it, and of a page that is but a notice, still do."""
    page = f"<body>{MENU}<div class='{name}'><h1>Tides</h1><p>{STORY}</p><div class='advert'><p>Buy now</p></div><p>{REST}</p></div><footer>Site</footer></body>"
    assert main_text(page, PRIOR) == f"Tides\n{STORY}\n{REST}"
    assert main_text(f"<body>{MENU}<div class='{name}'><p>{STORY}</p></div><div class='comments'><p>{REST}</p></div></body>", PRIOR) == ""
    assert main_text(f"<body><nav><h1>Site</h1><p>{STORY}</p></nav></body>", PRIOR) == ""


def test_small_mark_beside_a_long_story():
    page = f"<body><div>{''.join(f'<p>{STORY}</p>' for _ in range(9))}</div><article><p>One card</p></article></body>"
    assert main_text(page, PRIOR).startswith("\n".join([STORY] * 9))


def test_the_scan_decides(monkeypatch):
    """Boilerplate without a name is left out by the scan alone; so is all that lies outside marked content."""
    link = "<div><a href='/1'>One</a></div><div><a href='/2'>Two</a></div><div><a href='/3'>Three more</a></div>"
    pages = [f"<body>{link}<div><p>{STORY}</p><p>{REST}</p></div>{link}</body>", f"<body>{MENU}<article><p>{STORY}</p><p>{REST}</p></article><footer>Site</footer></body>"]
    assert [main_text(p, PRIOR) for p in pages] == [f"{STORY}\n{REST}"] * 2
    monkeypatch.setattr(html_text, "best_span", lambda v: (0, len(v)))
    assert all(main_text(p, PRIOR) != f"{STORY}\n{REST}" for p in pages)


def some_page(rng):
    out = []
    for _ in range(rng.randrange(2, 9)):
        tag = rng.choice(["p", "div", "li", "a", "nav", "article", "form", "div class='ad'", "div class='x'", "section id=comments"])
        out.append(f"<{tag}>{'word ' * rng.randrange(6)}{'<p>in it</p>' * rng.randrange(2)}</{tag.split()[0]}>")
    return "<body>" + "".join(out)


def test_region_against_all_regions():
    rng = random.Random(4)
    for _ in range(300):
        runs, elements = read_page(some_page(rng))
        readings = [Reading(runs, elements, PRIOR, marks) for marks in ({*()}, trusted_marks(elements, PRIOR))]
        for r in readings:
            assert r.score == pytest.approx(max([0.0] + [r.scores[i:j].sum() for i in range(len(runs)) for j in range(i + 1, len(runs) + 1)]))
        assert best_reading(runs, elements, PRIOR).score == pytest.approx(max(r.score for r in readings))


def test_weights_follow_the_pages():
    """A class that the prior doesn't know turns into boilerplate, and a known one into content, if labelled pages say so."""
    page = f"<body><div class='zork'>{'Some words of the site ' * 5}</div><div class='legal'><article><p>{STORY}</p></article></div></body>"
    examples = [(*e[:3], e[3] * 5000) for e in labelled(page)]
    weights = fit(examples)
    assert weights["names"][".zork"] < html_text.INSET < weights["names"]["*legal"]
    plain = f"<body><div><p>{STORY}</p><div class='zork'>Some words</div><p>{REST}</p></div></body>"
    assert "Some words" in main_text(plain, PRIOR) and main_text(plain, weights) == f"{STORY}\n{REST}"


class Plain(HTMLParser):
    """Blocks of text inside of article."""

    def __init__(self):
        super().__init__()
        self.depth, self.blocks = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        if tag == "br":
            self.blocks[-1] += " "
        elif tag not in ("b", "i", "em", "a", "span"):
            self.blocks.append("")

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        if tag not in ("b", "i", "em", "a", "span"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.depth:
            self.blocks[-1] += data


def test_query_against_a_plain_reading(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    made = {(r.page_id, r.url, r.text, r.n_chars) for r in op8_html_text(spark, SF).collect()}
    want = set()
    for r in pages:
        reader = Plain()
        reader.feed(r.html or "")
        reader.close()
        text = "\n".join(b for b in (" ".join(b.split()) for b in reader.blocks) if b)
        want.add((r.page_id, r.url, text, len(text)))
    assert made == want
