"""The tree of blocks of a page, with the features of the graphical model.

A node is a block element or a run of text in one (its leaf). Inline elements join the run around
them; scripts, styles and the head give no node. End tags that may be left out are supplied.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from html.parser import HTMLParser
from math import log1p

import numpy as np

_DROPPED = {"script", "style", "head", "title", "template", "noscript", "svg", "iframe", "object"}
_VOID = {"area", "base", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_GROUPS = (
    {"article", "main"}, {"section", "div", "body", "html", "center"}, {"p"},
    {"h1", "h2", "h3", "h4", "h5", "h6"}, {"li", "dd", "dt"}, {"ul", "ol", "dl"},
    {"table", "tbody", "thead", "tr", "td", "th", "caption"}, {"nav", "menu"}, {"header", "hgroup"}, {"footer", "address"},
    {"aside"}, {"form", "fieldset", "label", "button", "select", "option", "textarea", "legend"},
    {"blockquote", "pre", "figure", "figcaption", "details", "summary", "dialog"},
)
_GROUP = {tag: k for k, tags in enumerate(_GROUPS) for tag in tags}
#: What names and roles of elements tend to say; a part of a name counts if it starts so.
_HINTS = (
    "article|content|post|entry|story|main|text|body",
    "nav|menu|breadcrumb|pager|toolbar",
    "header|masthead|top|logo|brand",
    "footer|foot|copyright|legal|bottom|contentinfo",
    "side|widget|rail|aside|related|recommend|more|complementary|toc",
    "notice|cookie|consent|alert|popup|modal|message|warning|overlay|gdpr",
    "ad|ads|advert|sponsor|promo|banner|adsense|dfp",
    "comment|reply|respons|discuss|disqus|reader|feedback|kommentar|commentaire|comentario|commento",
    "form|search|login|subscribe|newsletter|signup|contact",
    "share|social|tags|meta|byline|author|date",
)
_HINT = [re.compile(rf"(?:^|[\s_\-])(?:{h})(?:$|[\s_\-\d]|(?:e|es|i|en|s)?\b)", re.I) for h in _HINTS]
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_NOT_IN_P = set(_GROUP) - {"label", "button", "select", "option", "textarea", "body", "html"}
#: What may be left open by mistake: no block stands in a drawing.
_NO_BLOCKS = {"svg"}
_CUT_OFF = re.compile(r"<[a-zA-Z/!?][^>]*\Z")
N_FEATURES = 2 * (len(_GROUPS) + 1) + 2 * len(_HINTS) + 9


class Tree(HTMLParser):
    """Arrays of one page's nodes, parents before children, in page order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.hints, self.labels = ["html"], [-1], [()], [0]
        self.texts: dict[int, str] = {}
        self.linked: dict[int, int] = {}
        self.open = [0]
        #: Where in `open` the elements of each tag stand, so that no search walks a deep page.
        self.standing: dict[str, list[int]] = {}
        self.run: list[str] = []
        self.in_link = self.dropping = self.run_linked = 0
        self.dropped = ""

    def _flush(self) -> None:
        text = " ".join("".join(self.run).split())
        if text:
            node = len(self.tags)
            parent = self.open[-1]
            self.tags.append("")
            self.parents.append(parent)
            self.hints.append(())
            self.labels.append(self.labels[parent])
            self.texts[node] = text
            self.linked[node] = min(self.run_linked, len(text))
        self.run, self.run_linked = [], 0

    def _close_to(self, at: int) -> None:
        self._flush()
        for node in self.open[at:]:
            self.standing[self.tags[node]].pop()
        del self.open[at:]
        self.in_link = 0

    def _last(self, tags: Iterable[str]) -> int:
        """Where in `open` the innermost element of these tags stands; 0 if none does."""
        return max((self.standing[t][-1] for t in tags if self.standing.get(t)), default=0)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _DROPPED:
            self.dropping += tag not in ("head",)
            self.dropped = tag
            return
        if self.dropping and self.dropped in _NO_BLOCKS and tag in _NOT_IN_P:
            self.dropping = 0  # it was not closed
        if self.dropping:
            return
        if tag == "hr":
            self._flush()
            return
        if tag == "br" or tag in _VOID:
            self.run.append(" ")
            return
        if tag == "a":
            self.in_link = 1
        if tag not in _GROUP or tag == "html":
            return
        if tag in _NOT_IN_P:
            at = self._last(("p",))
            if at > self._last(("td", "th", "button", "li")):
                self._close_to(at)
        closes, until = _CLOSES.get(tag, ((), ()))
        while (at := self._last(closes)) > self._last(until):
            self._close_to(at)
            if tag != "tr":
                break
        self._flush()
        given = dict(attrs)
        names = " ".join(given.get(k) or "" for k in ("class", "id", "role"))
        found = tuple(k for k, h in enumerate(_HINT) if h.search(names)) if names.strip() else ()
        self.tags.append(tag)
        self.parents.append(self.open[-1])
        self.hints.append(found)
        self.labels.append(int("data-main" in given))
        self.standing.setdefault(tag, []).append(len(self.open))
        self.open.append(len(self.tags) - 1)

    def handle_endtag(self, tag: str) -> None:
        if tag in _DROPPED:
            self.dropping = max(0, self.dropping - (tag not in ("head",)))
            return
        if self.dropping:
            return
        if tag == "a":
            self.in_link = 0
        elif tag in _GROUP and tag not in ("html", "body"):
            at = self._last((tag,))
            if at:
                self._close_to(at)

    def handle_data(self, data: str) -> None:
        if not self.dropping and data:
            self.run.append(data)
            if self.in_link:
                self.run_linked += len(data.strip())


def parse(html: str | None) -> Tree:
    tree = Tree()
    if html:
        comment = html.rfind("<!--")
        if comment > html.rfind("-->"):  # it has no end, so it goes to the end of the page
            html = html[:comment]
        tree.feed(_CUT_OFF.sub("", html))
        tree.close()
    tree._flush()
    return tree


def features(tree: Tree) -> np.ndarray:
    """A row of N_FEATURES numbers for each node."""
    n = len(tree.tags)
    size, linked, stops, runs = ([0] * n for _ in range(4))
    for node, text in tree.texts.items():
        size[node], linked[node], runs[node] = len(text), tree.linked[node], 1
        stops[node] = text.count(".") + text.count(",") + text.count("!") + text.count("?")
    for node in range(n - 1, 0, -1):
        parent = tree.parents[node]
        size[parent] += size[node]
        linked[parent] += linked[node]
        stops[parent] += stops[node]
        runs[parent] += runs[node]
    out = np.zeros((n, N_FEATURES))
    groups = len(_GROUPS) + 1
    whole, before = max(size[0], 1), 0
    for node in range(n):
        row = out[node]
        tag, leaf = tree.tags[node], node in tree.texts
        owner = tree.tags[tree.parents[node]] if leaf else tag
        row[_GROUP.get(owner, groups - 1) + (groups if leaf else 0)] = 1
        for h in tree.hints[tree.parents[node] if leaf else node]:
            row[2 * groups + h + (len(_HINTS) if leaf else 0)] = 1
        at = 2 * groups + 2 * len(_HINTS)
        share = linked[node] / size[node] if size[node] else 0.0
        row[at] = 1
        row[at + 1] = 0 if leaf else 1
        row[at + 2] = log1p(size[node]) / 8
        row[at + 3] = share
        row[at + 4] = share > 0.5
        row[at + 5] = min(stops[node] / (size[node] / 20 + 1), 1)
        row[at + 6] = size[node] / whole
        row[at + 7] = before / whole
        row[at + 8] = min(runs[node], 8) / 8
        before += size[node] if leaf else 0
    return out
