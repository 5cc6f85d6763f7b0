"""Main text of web pages by a tree-structured graphical model.

Every block and every run of text of a page is a node that is content or not. A node's features
give its own potential; each edge has a potential for the pair of parent and child. Sum-product
message passing, once up the tree and once down, yields each node's marginal. The same passes give
the gradient of the likelihood, so the parameters are trained with them, on pages whose content is
marked. Runs with a marginal of one half or more are the text.

The labelled pages are made here from layouts (`labelled_pages`), a bounded number of them; a user
with pages of their own marks content elements with `data-main` and passes them to `train`.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.cluster import ship
from gridtally.llm.html_tree import N_FEATURES, Tree, features, parse

#: Labelled pages that the model is trained on, and steps of the training.
N_PAGES, STEPS, SEED = 240, 150, 11


@dataclass
class Forest:
    """Nodes of many pages: parent (-1 for roots), nodes by depth, kind of the edge to the parent."""

    parents: np.ndarray
    levels: list[np.ndarray]
    kinds: np.ndarray
    x: np.ndarray

    @classmethod
    def of(cls, trees: Sequence[Tree]) -> Forest:
        parents, kinds, depth = [], [], []
        base = 0
        for tree in trees:
            deep = [0] * len(tree.tags)
            for node, parent in enumerate(tree.parents):
                if node:
                    deep[node] = deep[parent] + 1
            parents.extend(p + base if p >= 0 else -1 for p in tree.parents)
            kinds.extend(int(node in tree.texts) for node in range(len(tree.tags)))
            depth.extend(deep)
            base += len(tree.tags)
        deep = np.array(depth)
        order = np.argsort(deep, kind="stable")
        cuts = np.searchsorted(deep[order], np.arange(1, deep.max() + 1))
        return cls(np.array(parents), np.split(order, cuts), np.array(kinds), np.vstack([features(t) for t in trees]))


@dataclass
class Model:
    """Weights of the features for 'content', and edge potentials [kind, parent, child]."""

    weights: np.ndarray
    edges: np.ndarray


def marginals(forest: Forest, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Probability of content of each node; of each (parent, child) pair for each edge."""
    n = len(forest.parents)
    up = np.zeros((n, 2))
    up[:, 1] = forest.x @ model.weights
    sent = np.zeros((n, 2))
    for level in reversed(forest.levels[1:]):
        pair = model.edges[forest.kinds[level]] + up[level][:, None, :]
        sent[level] = np.logaddexp(pair[:, :, 0], pair[:, :, 1])
        np.add.at(up, forest.parents[level], sent[level])
    down = np.zeros((n, 2))
    pairs = np.zeros((n, 2, 2))
    for level in forest.levels[1:]:
        parent = forest.parents[level]
        above = up[parent] + down[parent] - sent[level]
        pair = model.edges[forest.kinds[level]] + above[:, :, None]
        down[level] = np.logaddexp(pair[:, 0, :], pair[:, 1, :])
        both = pair + up[level][:, None, :]
        both = np.exp(both - both.max(axis=(1, 2), keepdims=True))
        pairs[level] = both / both.sum(axis=(1, 2), keepdims=True)
    belief = up + down
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -50, 50))), pairs


def train(pages: Sequence[str], steps: int = STEPS) -> Model:
    """Maximum likelihood on pages whose content elements carry `data-main`, by gradient steps."""
    trees = [parse(p) for p in pages]
    for tree in trees:  # an element with content inside is content
        for node in range(len(tree.tags) - 1, 0, -1):
            tree.labels[tree.parents[node]] |= tree.labels[node]
    forest = Forest.of(trees)
    y = np.concatenate([t.labels for t in trees]).astype(float)
    child = np.flatnonzero(forest.parents >= 0)
    truth = np.zeros((2, 2, 2))
    np.add.at(truth, (forest.kinds[child], y[forest.parents[child]].astype(int), y[child].astype(int)), 1)
    model = Model(np.zeros(N_FEATURES), np.zeros((2, 2, 2)))
    theta = np.zeros(N_FEATURES + 8)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        p, pairs = marginals(forest, model)
        expected = np.stack([pairs[child][forest.kinds[child] == k].sum(axis=0) for k in (0, 1)])
        gradient = np.concatenate([forest.x.T @ (y - p), (truth - expected).ravel()]) - 0.5 * theta
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        theta = theta + 0.15 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        model = Model(theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2, 2))
    return model


def labelled_pages(n: int = N_PAGES, seed: int = SEED) -> list[str]:
    """Pages in many layouts, content elements marked with `data-main`."""
    r = random.Random(seed)
    syllables = [a + b for a in "bdfglmnprstv" for b in ("a", "e", "i", "o", "u", "an", "er")]

    def words(low: int, high: int) -> str:
        out = ["".join(r.choices(syllables, k=r.randint(1, 4))) for _ in range(r.randint(low, high))]
        text = " ".join(w + r.choices(["", ",", ".", "!!", "***", " |"], [60, 6, 8, 1, 1, 1])[0] for w in out)
        return text[0].upper() + text[1:] + r.choice([".", ".", ""])

    def named(tag: str, names: Sequence[str], inner: str, bare: float = 0.2) -> str:
        at = r.random()
        name = r.choice(names)
        given = "" if at < bare else f' id="{name}"' if at < 0.5 else f' class="{name} {r.choice(["", "x1", "block", "col"])}"'
        return f"<{tag}{given}>{inner}</{tag}>"

    def links(k: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/x">{words(1, 2)}</a></li>' for _ in range(k)) + "</ul>"

    def menu() -> str:
        inner = links(r.randint(3, 8))
        return f"<nav>{inner}</nav>" if r.random() < 0.6 else named("div", ["menu", "navbar", "nav-main", "breadcrumb"], inner)

    def head() -> str:
        inner = f"{words(1, 4)}" + (menu() if r.random() < 0.4 else "")
        return f"<header>{inner}</header>" if r.random() < 0.5 else named("div", ["header", "masthead", "top-bar"], inner, 0)

    def foot() -> str:
        inner = r.choice(["&copy; ", "", "Copyright "]) + words(2, 20) + (links(3) if r.random() < 0.3 else "")
        return f"<footer>{inner}</footer>" if r.random() < 0.7 else named("div", ["footer", "copyright", "site-footer"], inner, 0)

    def advert() -> str:
        return named(r.choice(["div", "div", "aside", "section"]), ["ad", "ads", "advert", "sponsor", "promo", "banner-ad"], words(3, 30), 0)

    def notice() -> str:
        return named("div", ["notice", "cookie-consent", "alert", "message", "gdpr"], f"{'<p>' * r.randint(0, 1)}{words(5, 30)}", 0)

    def form() -> str:
        return named("form", ["search", "login", "newsletter", "signup"], f"<label>{words(1, 4)}</label><input><button>{words(1, 2)}</button>", 0.5)

    def side() -> str:
        inner = f"<h3>{words(1, 4)}</h3>" + (links(r.randint(2, 6)) if r.random() < 0.6 else f"<p>{words(5, 40)}</p>")
        return f"<aside>{inner}</aside>" if r.random() < 0.5 else named("div", ["sidebar", "widget", "related", "rail"], inner, 0)

    def remarks() -> str:
        inner = f"<h3>{words(1, 3)}</h3>" + "".join(
            named(r.choice(["div", "li"]), ["comment", "reply", "comment-body"], f"<p>{words(3, 60)}</p>", 0.2)
            for _ in range(r.randint(1, 6))
        )
        return named(r.choice(["div", "section", "ol"]), ["comments", "discussion", "responses", "reader-comments"], inner, 0)

    def loose() -> str:
        """Content that no element of its own kind holds."""
        kind = r.random()
        if kind < 0.4:
            return f"<div data-main>{words(4, r.choice([20, 60, 150]))}</div>"
        if kind < 0.55:
            return f"<div data-main>{words(10, 60)}<br><br>{words(10, 60)}</div>"
        if kind < 0.7:
            return "<ul>" + "".join(f'<li data-main><a href="/z">{words(2, 8)}</a></li>' for _ in range(r.randint(2, 4))) + "</ul>"
        if kind < 0.8:
            return f'<p data-main><a href="/z">{words(3, 15)}</a></p>'
        if kind < 0.9:
            return f'<p data-main class="{r.choice(["message", "lead", "summary", "note"])}">{words(5, 60)}</p>'
        return f'<div data-main class="{r.choice(["pull-quote", "quote", "intro", "paragraph"])}">{words(5, 40)}</div>'

    def block() -> str:
        if r.random() < 0.2:
            return loose()
        kind = r.random()
        if kind < 0.74:
            close = r.choice(["</p>", "</p>", ""])
            wrap = r.choice(["{}", "{}", "<b>{}", "<b>{}</b>", "<em>{}</em><br>", '{} <a href="/y">x</a>'])
            return f"<p data-main>{wrap.format(words(1, r.choice([6, 40, 150])))}{close}"
        if kind < 0.82:
            return f"<h{(k := r.randint(2, 4))} data-main>{words(1, 8)}</h{k}>"
        if kind < 0.89:
            return "<ul>" + "".join(f"<li data-main>{words(1, 25)}</li>" for _ in range(r.randint(2, 5))) + "</ul>"
        if kind < 0.94:
            return f"<blockquote data-main>{words(5, 60)}</blockquote>"
        if kind < 0.97:
            return "<table><tr>" + "".join(f"<td data-main>{words(1, 6)}</td>" for _ in range(4)) + "</tr></table>"
        return f"<pre data-main>{words(4, 30)}</pre>"

    def article() -> str:
        parts = [f"<h1 data-main>{words(1, 10)}</h1>"] if r.random() < 0.9 else []
        for _ in range(r.choice([0, 1, 2, 4, 8, 14])):
            parts.append(block())
            if r.random() < 0.06:
                parts.append(r.choice([advert, notice, form, side])())
        parts = parts or [block()]
        if r.random() < 0.15:  # no element but the usual ones for boxes
            parts = [f"<div data-main>{words(5, 100)}</div>" for _ in range(r.choice([1, 2, 4, 8]))]
        if r.random() < 0.15:
            parts.append(remarks())
        inner = "".join(parts)
        style = r.random()
        if style < 0.45:
            inner = f"<article>{inner}</article>"
            return f"<main>{inner}</main>" if r.random() < 0.3 else inner
        if style < 0.6:
            return f"<main>{inner}</main>"
        if style < 0.9:
            inner = named("div", ["content", "post", "entry-content", "story", "article-body", "main"], inner, 0.15)
            return f"<div>{inner}</div>" if r.random() < 0.3 else inner
        return f"<section>{inner}</section>"

    pages = []
    for k in range(n):
        before = [f() for f in (head, menu, notice, advert, form) if r.random() < 0.4]
        after = [f() for f in (side, remarks, advert, form, foot, notice) if r.random() < 0.4]
        r.shuffle(before)
        main = article() if k % 12 else ""
        around = "".join(before) + (side() if r.random() < 0.15 else "") + main + "".join(after)
        body = f'<div class="wrapper">{around}</div>' if r.random() < 0.3 else around
        html = f"<!DOCTYPE html><html><head><title>{words(2, 6)}</title><script>var x='</p>';</script></head><body>{body}</body></html>"
        pages.append(html[: r.randint(len(html) * 3 // 4, len(html))] if r.random() < 0.1 else html)
    return pages


@lru_cache(maxsize=1)
def default_model() -> Model:
    return train(labelled_pages())


def extract(pages: Sequence[str | None], model: Model) -> list[str]:
    """The main text of each page."""
    trees = [parse(p) for p in pages]
    if not trees:
        return []
    forest = Forest.of(trees)
    content = marginals(forest, model)[0] >= 0.5
    out, base = [], 0
    for tree in trees:
        out.append("\n\n".join(text for node, text in tree.texts.items() if content[base + node]))
        base += len(tree.tags)
    return out


def _extract(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = batch.column("html").to_pylist()
            texts = []
            for begin in range(0, len(pages), 200):
                texts.extend(extract(pages[begin : begin + 200], model))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    return run


def main_text(pages: DataFrame, keep: list[str], model: Model | None = None) -> DataFrame:
    """The columns `keep` of each row of `pages` (html), text and n_chars (its code points).

    Character references are decoded, white space in a block becomes one space, blocks are joined in
    page order by two line feeds. Null and empty pages, and pages without content, have an empty
    text. Rows are independent, repeated ones included. A column of `keep` called text or n_chars
    gives way to the new one.
    """
    ship(pages.sparkSession)
    rows = pages.select(F.struct(*keep).alias("row"), "html")
    kind = rows.schema["row"].dataType.simpleString()
    done = rows.mapInArrow(_extract(model or default_model()), f"row {kind}, text string")
    out = [F.col("row")[c].alias(c) for c in keep if c not in ("text", "n_chars")]
    return done.select(*out, "text", F.length("text").cast("long").alias("n_chars"))
