import itertools
import time

import numpy as np
import pytest

from paddockflow.llm import html_text

TEXT = " ".join(["word"] * 80)


@pytest.mark.parametrize("opening", [
    "<article class='post category-legal'>", "<div class='content has-sidebar'>", "<main class='no-banner'>",
    "<article class='tag-social with_comments'>", "<main id='banner'>",
])
def test_names_that_tell_what_an_article_has(opening):
    assert html_text.main_text(f"<body>{opening}<p>{TEXT}</p></body>") == TEXT


def test_names_of_furniture_still_count():
    for name in ("sidebar", "cookie-notice", "no-print sidebar", "tag"):
        kept = html_text.main_text(f"<article><p>{TEXT}</p><div class='{name}'><p>Some words of no use here</p></div></article>")
        assert ("no use" in kept) == (name == "tag")


def test_paragraph_after_a_linked_one():
    linked = "<p>" + "<a href=x>go there</a> " * 4 + "and twelve more words that stand here without any link in it all</p>"
    assert TEXT in html_text.main_text(f"<article>{linked}<p>{TEXT}</p><p>{TEXT}</p></article>").split("\n\n")


def test_article_holds_whatever_stands_beside():
    sizes, shares = (0, 1, 3, 5, 9, 20, 60, 200), (0.0, 0.1, 0.3, 0.5, 0.8, 1.0)
    rows = [
        (w, s, pw, ps, nw, ns, 0, 1, h)
        for w, s, pw, ps, nw, ns, h in itertools.product(sizes[1:], (0.0, 0.2), sizes, shares, sizes, shares, (0, 1))
    ]
    assert (html_text.trained().predict(np.array(rows, float)) >= 0.5).all()


def test_self_closing_svg():
    page = f"<article><p>{TEXT}</p><svg class='i' viewBox=\"0 0 1 1\" /><p>{TEXT}</p><svg><text>no</text></svg><p>{TEXT}</p></article>"
    assert html_text.main_text(page) == "\n\n".join([TEXT] * 3)


@pytest.mark.parametrize("name", [
    "legal-history", "social-science", "alert", "search-for-truth", "entry-content widget-area-main", "has-sidebar",
    "commentary-on-law", "header-image-story",
])
def test_names_that_articles_use_too(name):
    for kind in ("class", "id"):
        page = f"<article><p>{TEXT}</p><div {kind}='{name}'><p>{TEXT}</p></div></article>"
        assert html_text.main_text(page) == f"{TEXT}\n\n{TEXT}"


@pytest.mark.parametrize("name", [
    "comments", "comment-list", "ad-slot", "adBox", "cookie-notice", "newsletter-signup", "sidebar right", "site-footer",
    "related-links", "top nav", "sponsored", "pagination", "replies",
])
def test_names_that_only_furniture_has(name):
    for body in (TEXT, "Some words of no use here"):
        kept = html_text.main_text(f"<article><p>{TEXT}</p><div class='{name}'><p>{body}</p></div></article>")
        assert kept == TEXT


@pytest.mark.parametrize("name", ["alert", "legal-notice", "social", "search-box", "promo banner"])
def test_short_or_linked_text_under_a_doubtful_name_goes(name):
    links = "<a href=x>share this on a site</a> " * 6
    for body in ("Watch out, this page has moved to another place.", links):
        kept = html_text.main_text(f"<article><p>{TEXT}</p><div class='{name}'><p>{body}</p></div><p>{TEXT}</p></article>")
        assert kept == f"{TEXT}\n\n{TEXT}"


def test_unclosed_quotes_take_time_in_proportion():
    began = time.time()
    for start in ("<title '", "<script \"", "<svg a='", "<a href='", "<div class=\""):
        assert isinstance(html_text.main_text("<article><p>x</p>" + start * (1_000_000 // len(start))), str)
    assert time.time() - began < 10


def test_scripts_with_odd_attributes():
    page = f"<article><script data-x='a<b'>var no = 1;</script><p>{TEXT}</p><style title=\"<\">p {{}}</style><p>{TEXT}</p></article>"
    assert html_text.main_text(page) == f"{TEXT}\n\n{TEXT}"
