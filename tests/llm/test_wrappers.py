"""Pages whose wrappers have names that look like boilerplate."""

import pytest

from isobar.llm import html

TITLE = "A title of the page"
ONE = "First paragraph with a fair number of words to read, so that it is content of the page."
TWO = "Short one."
ARTICLE = f"<article><h1>{TITLE}</h1><p>{ONE}</p><p>{TWO}</p></article>"
WHOLE = f"{TITLE} {ONE} {TWO}"


def text(body):
    return " ".join(b.text for b in html.main_blocks(f"<html><body>{body}</body></html>"))


@pytest.mark.parametrize("name", ["layout has-sidebar", "content with-sidebar", "container no-sidebar", "sidebar-layout", "nav-open", "page-overlay"])
def test_a_wrapper_does_not_lose_its_article(name):
    around = '<nav><a href=x>Home page</a> <a href=y>More</a></nav><div class="sidebar"><p>Some more things to look at on this site, in a column of its own.</p></div>'
    assert text(f'<div class="{name}">{around}{ARTICLE}<footer><p>© Somebody</p></footer></div>') == WHOLE


def test_a_form_around_the_page():
    assert text(f"<form id=aspnetForm>{ARTICLE}</form>") == WHOLE


def test_a_good_name_inside_a_bad_one():
    assert text(f'<div class="sidebar-layout"><div class="content"><p>{ONE}</p></div></div>') == ONE


@pytest.mark.parametrize("name", ["post-header", "entry-header", "header"])
def test_header_of_an_article_keeps_the_title(name):
    assert text(f'<article><div class="{name}"><h1>{TITLE}</h1></div><p>{ONE}</p><p>{TWO}</p></article>') == WHOLE


@pytest.mark.parametrize("name", ["tag-news", "post tag-news", "no-comments"])
def test_article_with_names_of_its_subject(name):
    article = ARTICLE.replace("<article>", f'<article class="{name}">')
    assert text(article) == text(f'<div class="layout sidebar">{article}</div>') == WHOLE


@pytest.mark.parametrize("part", ['<div class="related"><p>{}</p></div>', '<aside><article><p>{}</p></article></aside>', '<div class="comments"><article class="comment"><p>{}</p></article></div>', '<div class="share">{}</div>'])
def test_boilerplate_stays_out(part):
    inside = part.format("Something else that is no part of the text, though it is as long as that.")
    assert text(ARTICLE.replace("</article>", inside + "</article>")) == WHOLE
    assert text(ARTICLE + inside) == WHOLE
