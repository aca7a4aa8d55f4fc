"""Short pages, pages within a form, pages without content, and columns whose names have dots."""

import pytest

from isobar.llm import html

LONG = "This paragraph goes on and on about what happened there on that day, who said it and why it matters to everybody else who came by in the end. " * 2


def text(page):
    return " ".join(b.text for b in html.main_blocks(page))


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<div><p>Short one.</p><p>Short one.</p><p>Short one.</p></div>", "Short one. Short one. Short one."),
        ("<p>a b.</p>", "a b."),
        ("<html><body>Hello</body></html>", "Hello"),
        (f"<form id=aspnet><div><h1>T</h1><p>{LONG}</p><p>{LONG}</p></div></form>", f"T {LONG.strip()} {LONG.strip()}"),
        (f"<form id=aspnet><input type=hidden><input type=hidden><nav><a href=x>Home</a></nav><div><p>{LONG}</p></div><div class=sidebar><p>{LONG}</p></div></form>", LONG.strip()),
        ("<nav><a href=x>Home</a> <a href=y>News</a></nav><p>Gone fishing.</p><footer>© us</footer>", "Gone fishing."),
    ],
)
def test_the_only_text_stays(page, want):
    assert text(page) == want


@pytest.mark.parametrize(
    "page",
    [
        "<nav><ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul></nav>", "<div><a href=a>One page</a> <a href=b>Another page</a></div>", "<header><h1>Site</h1></header><footer>© Us 2020</footer>",
        "<form action=login><label>Name</label><input><label>Password</label><input><button>Go</button></form>", '<div class="cookie-notice"><p>We use cookies on this site.</p></div>', "<p>© Somebody. All rights reserved.</p>",
        "<aside><p>Some words beside nothing.</p></aside>", "<p>...</p>", "<p>***</p><nav>x</nav>", "", "<", "<p", "</p", "<!-- text -->",
        "<form><p>Please log in to read this.</p><input name=a><input name=b></form>",
    ],
)
def test_pages_without_content_stay_empty(page):
    assert text(page) == ""


def test_a_form_beside_the_article_is_left_out():
    article = f"<div><h1>Title</h1><p>{LONG}</p></div>"
    assert text(f"{article}<form><p>Write to us about anything that you would like to say.</p><input></form>") == f"Title {LONG.strip()}"


def test_columns_with_dots(spark):
    df = spark.createDataFrame([(1, "x", "<p>a b.</p>")], ["a.b", "text", "html"])
    row = html.extract(df).first()
    assert row["a.b"] == 1 and row.text == "a b." and len(row.spans) == 1
