"""The minimum cut decides where tags and names say nothing; markup that is broken or nested deeply."""

import itertools
import random
import time

import pytest
from isobar.llm import html

LONG = "This paragraph has quite a few more words than a dozen, so that its length alone speaks for it."
OTHER = "Another one follows here, with enough words and a full stop at its end, as paragraphs of an article have."
SHORT = "He nodded slowly."
HEAD = "A plain heading"
LINKS = "".join(f"<div><a href=/{k}>Section number {k}</a></div>" for k in range(6))
FOOT = "Our offices are open from nine to five on all weekdays of the year, and closed on holidays."


def text(body, **edges):
    return " ".join(b.text for b in html.main_blocks(f"<html><body>{body}</body></html>", **edges))


PAGES = [
    (f'<div class="q1">{LINKS}</div><div class="q2"><p>{LONG}</p><p>{SHORT}</p><p>{OTHER}</p></div>', f"{LONG} {SHORT} {OTHER}"),
    (f"<div>{LINKS}</div><div><div>{LONG}</div><div>{SHORT}</div><div>{OTHER}</div></div>", f"{LONG} {SHORT} {OTHER}"),
    (f'<div>{LINKS}</div><div class="x"><h2>{HEAD}</h2><p>{LONG}</p><p>{OTHER}</p></div>', f"{HEAD} {LONG} {OTHER}"),
    (f'<div><p>{LONG}</p><p>{OTHER}</p></div><div class="z"><span><a href=a>About the people here</a></span><p>{FOOT}</p><p><a href=b>All of the other pages</a></p></div>', f"{LONG} {OTHER}"),
]


@pytest.mark.parametrize("page, want", PAGES)
def test_neighbours_decide_where_names_say_nothing(page, want):
    assert text(page) == want
    assert text(page, adjacent=0.0, same_container=0.0) != want


def test_labelling_is_the_cheapest_of_all():
    """Against every labelling of small pages, with the same scores and edges."""
    rng = random.Random(4)
    for _ in range(30):
        parts = [rng.choice([f"<p>{LONG}</p>", f"<p>{SHORT}</p>", "<div><a href=x>A link of some words</a></div>", f"<div><p>{SHORT}</p><p>{OTHER}</p></div>", f'<div class="ad">{OTHER}</div>']) for _ in range(6)]
        page = "<body>" + "".join(parts) + "</body>"
        blocks = html.blocks_of(page)
        scores, last, edges = html.scores_of(blocks), {}, []
        for i, b in enumerate(blocks):
            if i:
                edges.append((i - 1, i, 0.8 * (1 + b.shared) / (1 + max(b.depth, blocks[i - 1].depth))))
            if b.container in last:
                edges.append((last[b.container], i, 1.2))
            last[b.container] = i
        cost = lambda kept: sum(-s if k and s < 0 else s if not k and s > 0 else 0 for k, s in zip(kept, scores, strict=True)) + sum(w for a, c, w in edges if kept[a] != kept[c])  # noqa: B023, E731
        best = min(cost(kept) for kept in itertools.product((False, True), repeat=len(blocks)))
        starts = {b.start for b in html.main_blocks(page)}
        assert abs(cost([b.start in starts for b in blocks]) - best) < 1e-9


def test_scripts_and_signs_in_prose():
    article = f"<article><h1>{HEAD}</h1><p>{LONG}</p></article>"
    whole = f"{HEAD} {LONG}"
    assert text(f"<script>for(var i=0;i<a.length;i++){{x(i)}}</script>{article}") == whole
    assert text(f'<script>s = "<article><p>no</p>" + "</div>";</script>{article}<style>a<b{{}}</style>') == whole
    assert text('<article><p>If a<b then it is fine, and "quoted text here.</p><p class="x">It goes on &lt;b&gt; here.</p></article>') == 'If a<b then it is fine, and "quoted text here. It goes on <b> here.'
    assert text('<article><p>1 < 2 and 3<4, said <a title="x > y < z" href=q>they</a>.</p></article>') == "1 < 2 and 3<4, said they."
    assert text(f"<noscript><p>{OTHER}</p></noscript><svg><svg><text>a</text></svg><text>b</text></svg>{article}") == whole
    assert text(f"<button>{article}") == whole
    assert text(f"{article}<script>{OTHER}") == whole


def test_long_and_broken_pages_take_time_in_proportion():
    for page in ("<div>" * 8000 + "text here" + "</div>" * 8000, "<div>text here" * 4000, "<b>" * 8000 + "</i>" * 8000 + "<p>x" * 4000, '<a href="' * 4000 + "='<" * 4000, "<button>a" * 4000):
        start = time.process_time()
        html.main_blocks(page)
        assert time.process_time() - start < 2


def test_reader_comments_and_articles_within():
    article = f"<article><h1>{HEAD}</h1><p>{LONG}</p></article>"
    assert text(f'{article}<article class="comment"><p>{OTHER}</p></article>') == f"{HEAD} {LONG}"
    assert text(f'<div class="page"><div id="comments-wrapper" class="wide">{article}</div></div>') == f"{HEAD} {LONG}"
