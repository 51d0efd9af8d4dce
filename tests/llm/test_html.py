"""Which part of a page its scores choose."""

import time

import numpy as np
import pyarrow.parquet as pq
import pytest

from pixeltally.llm import html_extract as html

TEXT = "<p>A first sentence, with commas, of some length.</p><p>Short.</p>"
PLAIN = "A first sentence, with commas, of some length.\n\nShort."
UNNAMED = f"""<body><div><ul><li><a href=/>Home</a></li><li>About</li><li>News</li><li>Sport</li></ul></div>
    <div><h1>Title</h1>{TEXT * 3}<ul><li>one</li></ul></div><div>Copyright 2020</div></body>"""


def test_scores_choose_where_nothing_is_marked(monkeypatch):
    expected = "\n\n".join(["Title", *[PLAIN] * 3, "one"])
    assert html.main_text(UNNAMED) == expected
    # The same page with equal scores for all paths: menu and footer come along.
    monkeypatch.setattr(html, "path_scores", lambda page, radius=1: np.ones(len(page)))
    text = html.main_text(UNNAMED)
    assert "Home" in text and "Copyright" in text


@pytest.fixture(scope="module")
def pages():
    return [page for page in pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist() if page]


def unmarked(page):
    """The page with all its marks gone: menu, advert, article and footer are plain boxes."""
    for tag in ("nav", "article", "footer"):
        page = page.replace(f"<{tag}>", "<div>").replace(f"</{tag}>", "</div>")
    return page.replace(' class="ad"', "")


def test_given_pages_without_their_marks(pages, monkeypatch):
    marked = [html.main_text(page) for page in pages]
    same = sum(a == html.main_text(unmarked(page)) for a, page in zip(marked, pages))
    assert same >= 0.85 * len(pages)
    monkeypatch.setattr(html, "path_scores", lambda page, radius=1: np.ones(len(page)))
    assert sum(a == html.main_text(unmarked(page)) for a, page in zip(marked, pages)) <= 0.6 * len(pages)


@pytest.mark.parametrize("part", [
    '<p class="social-lead">Kept text.</p>', '<div class="search-results-explained">Kept text.</div>', '<p class="share-price">Kept text.</p>',
    '<section id="comments-on-the-law"><p>Kept text.</p></section>'])
def test_names_that_say_something_else_keep_their_part(part):
    assert html.main_text(f"<article>{TEXT}{part}</article>") == f"{PLAIN}\n\nKept text."


@pytest.mark.parametrize("name", ["share-links", "sidebar", "related-posts", "main-menu", "cookie_notice", "postComments", "site-header", "ad"])
def test_names_of_other_parts(name):
    other = f'<div class="{name}"><p>Other text, rather long, with commas, and more.</p></div>'
    assert html.main_text(f"<article>{TEXT}{other}</article>") == PLAIN
    assert html.main_text(f"<body>{other}<div>{TEXT * 2}</div></body>") == f"{PLAIN}\n\n{PLAIN}"


def test_long_comments_are_not_the_article():
    comments = "".join(f"<div><p>A reader says, at length, that number {i} is wrong, and why, and how.</p></div>" for i in range(200))
    assert html.main_text(f'<body><div>{TEXT * 4}</div><div class="comments">{comments}</div></body>') == "\n\n".join([PLAIN] * 4)


def test_a_box_between_content_stays_and_one_of_links_goes():
    page = f"<body><div>{TEXT}<div>Aside of the writer</div><div><ul><li><a>Read this</a></li><li><a>And that</a></li></ul></div>{TEXT}</div></body>"
    assert html.main_text(page) == f"{PLAIN}\n\nAside of the writer\n\n{PLAIN}"


@pytest.mark.parametrize("page", [
    "<div>" * 100_000 + "text, here." + "</div>" * 100_000, "<div>x" * 50_000, "<p>a, b.</p></span></li>" * 100_000,
    "<section><div>" * 50_000 + TEXT, "".join(f'<div class="menu m{i}"><p>Entry {i}.</p></div>' for i in range(30_000)),
    "".join(f'<div class="{a} {b}"><p>Text, {a}.</p></div>' for a in sorted(html.OTHER_PARTS) for b in sorted(html.OTHER_PARTS))])
def test_large_and_deep_pages(page):
    start = time.perf_counter()
    html.main_text(page)
    assert time.perf_counter() - start < 20


def test_deeply_nested_text_is_found():
    assert html.main_text("<div>" * 20_000 + TEXT + "</div>" * 20_000) == PLAIN
