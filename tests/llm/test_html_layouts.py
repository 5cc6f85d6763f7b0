"""Articles in layouts without the usual elements, unclosed markup, and deep pages."""

import time

import pytest

from gridtally.llm import html_extract
from gridtally.llm.html_tree import parse

W = "lorem ipsum dolor sit amet consectetur, adipiscing elit sed do eiusmod tempor incididunt ut labore."
LONG = " ".join([W] * 3)
P = f"<h1>Title here</h1><p>{LONG}</p>"

PAGES = {
    "divs": (f'<nav><ul><li><a href=x>Home</a></li></ul></nav><div class="article-body">{f"<div>{LONG}</div>" * 4}</div><footer>Copyright</footer>', [LONG] * 4),
    "one div": (f'<div class="article-body">{LONG} {LONG}</div>', [f"{LONG} {LONG}"]),
    "br": (f'<div class="content">{LONG}<br><br>{LONG}</div><footer>x</footer>', [f"{LONG} {LONG}"]),
    "plain": (f"{LONG}", [LONG]),
    "loose text": (f"<article>{P}<div>{W}</div><p>{LONG}</p></article>", ["Title here", LONG, W, LONG]),
    "a linked paragraph": (f"<article>{P}<p><a href=x>one whole paragraph is a link</a></p><p>{LONG}</p></article>", ["Title here", LONG, "one whole paragraph is a link", LONG]),
    "quote": (f'<article>{P}<div class="pull-quote">{W}</div></article>', ["Title here", LONG, W]),
    "unclosed comment": (f"<article><p>{LONG}</p></article><!-- not closed<p>zzz", [LONG]),
    "unclosed svg": (f"<article><p>{LONG}</p><svg><path d=x><p>{LONG}</p></article>", [LONG, LONG]),
    "hr": (f"<article><p>{LONG}</p>{W}<hr>{LONG}</article>", [LONG, W, LONG]),
    "comments in German": (f'<article>{P}</article><div id="kommentare"><div>{W}</div><div>{W}</div></div>', ["Title here", LONG]),
}


@pytest.mark.parametrize("name", PAGES)
def test_layout(name):
    html, blocks = PAGES[name]
    page = f"<html><body>{html}</body></html>" if name not in ("plain", "unclosed comment") else html
    assert html_extract.extract([page], html_extract.default_model()) == ["\n\n".join(blocks)]


@pytest.mark.parametrize("tag", ["<div>", "<p><button>", "<li>", "<table><tr><td>", "<b>", "<svg>", "<p><label>"])
def test_parsing_is_linear_in_the_depth(tag):
    start = time.perf_counter()
    parse(tag * 100_000 + LONG)
    assert time.perf_counter() - start < 8  # a search of the open elements would take minutes


def test_implied_ends():
    tree = parse("<table><tr><td>a<td>b<tr><td><p>c<p>d</table><ul><li>e<ul><li>f</ul><li>g</ul><dl><dt>h<dd>i</dl>j")
    parents = {text: tree.tags[tree.parents[node]] for node, text in tree.texts.items()}
    assert parents == {"a": "td", "b": "td", "c": "p", "d": "p", "e": "li", "f": "li", "g": "li", "h": "dt", "i": "dd", "j": "html"}
    owner = {text: tree.parents[node] for node, text in tree.texts.items()}
    up = [tree.parents[owner[x]] for x in "egf"]
    assert up[0] == up[1] and tree.parents[up[2]] == owner["e"]
