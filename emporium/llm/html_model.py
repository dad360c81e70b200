"""Main text of web pages by a tree-structured graphical model.

Every node of a page's tree (block elements and blocks of text) has a hidden
label: does it hold main content or not.  Node potentials weigh its tag, names
(class, id, role) and text measures; parent-child potentials connect the nodes.
Sum-product messages pass from the leaves up and from the root down, which
gives each node's exact marginal; a block of text whose content marginal is
over one half is kept.

The weights are trained on labelled pages.  ``labelled_pages``
builds these pages by rule: the usual page layouts with the usual names of menus,
headers, footers, sidebars, notices, adverts, forms and reader comments.  Pages
with ``data-content`` / ``data-boiler`` marks of one's own can be given to
``main_text`` instead.

Defined results: blocks are joined in page order by one space; white space in a
block is one space; a null or empty page, or one without content, gives an
empty text; null ids and urls stay null; repeated rows give a row each.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import exp, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import slices
from emporium.llm.html_tree import Tree

# Names that the labelled pages use (fixed values).
BOILER = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs topbar toolbar pager pagination toc tabs",
    "header": "header masthead banner logo branding top hero",
    "footer": "footer bottom copyright legal colophon credits foot",
    "aside": "sidebar aside widget rail related recommended trending popular archive tags tagcloud",
    "ad": "ad ads advert advertisement adsense sponsor sponsored promo promotion commercial",
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay paywall warning disclaimer newsletter subscribe signup",
    "form": "form search login contact register feedback",
    "comments": "comments comment commentlist discussion respond replies reply disqus reviews thread reader",
    "share": "share social sharing follow buttons meta byline author",
}
CONTENT = "article content main post entry story body text page maincontent articlebody"

VARIANTS = 4  # labelled pages for each name of boilerplate
ROUNDS = 12

SENTENCE = "The council met on Tuesday to talk about the new bridge and the road that leads to it."
LONG = " ".join([SENTENCE] * 3)


def _paragraphs(n: int, turn: int) -> str:
    sized = [LONG, "It rained.", SENTENCE, f"{LONG} <a href='x'>A source</a> says so.", "Not so fast", f"<b>{SENTENCE}</b> {LONG}", "The mayor was there too, he said."]
    return "".join(f"<p>{sized[(turn + i) % len(sized)]}</p>" for i in range(n))


def _boiler(kind: str, name: str, i: int) -> str:
    links = "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in ("Home", "News", "Sport", "About us", "Contact")[: 3 + i % 3])
    say = (LONG, SENTENCE, LONG, "Read more", SENTENCE, "All rights reserved 2024")[i % 6]
    inner = {
        "nav": f"<ul>{links}</ul>",
        "header": "<h1><a href='/'>The Daily</a></h1><p>News for all.</p>" if i % 2 else "<div>The Daily</div>",
        "footer": f"&copy; example.com &middot; {say}" if i % 2 else f"<p>{say}</p><ul>{links}</ul>",
        "aside": f"<h3>Related</h3><ul>{links}</ul>" if i % 2 else f"<h3>About</h3><p>{say}</p>",
        "ad": say,
        "notice": f"<p>{say} <button>Accept</button></p>" if i % 2 else f"{say}",
        "form": "<form><label>Name</label><input><p>Fill in all fields.</p><button>Send</button></form>",
        "comments": (f"<h3>Comments</h3><ol><li><p>{LONG}</p></li><li><p>{SENTENCE}</p></li></ol>", f"<div>{LONG}</div><p>{SENTENCE}</p>", f"<article><p>{LONG}</p></article>")[i % 3],
        "share": "<a href='a'>Share</a> <a href='b'>Tweet</a>" if i % 2 else "<span>By A. Writer</span>",
    }[kind]
    own = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}.get(kind, "section")
    tag = ("div", own, own, "section")[i % 4]
    names = "" if tag == own and i % 3 < 2 and kind in ("nav", "header", "footer", "aside", "form") else f" {'id' if i % 5 == 0 else 'class'}='{name}'"
    return f"<{tag}{names} data-boiler>{inner}</{tag}>"


def labelled_pages() -> Iterator[str]:
    """Pages of known labels: every boilerplate name before, beside, inside or
    after the content, content in every kind of container."""
    yield from _neutral_pages()
    names, around_names = CONTENT.split(), ("wrapper", "container", "site", "layout")
    every = [(kind, name) for kind, all_names in BOILER.items() for name in all_names.split()]
    bare = [("nav", "nav"), ("header", "header"), ("footer", "footer"), ("aside", "aside")]
    variants = [(kind, name, 7 * v) for v in range(VARIANTS) for kind, name in every]
    for at, (kind, name, turn) in enumerate(variants):
        i = at + turn
        box = lambda html, i=i: f"<div class='{around_names[i % 4]}'>{html}</div>" if i % 3 else html
        tag = ("article", "main", "div", "section", "div", "article")[i % 6]
        holder = f"<{tag} data-content" + ("" if tag in ("article", "main") and i % 4 else f" {'id' if i % 8 == 0 else 'class'}='{names[i % len(names)]}'")
        title = f"<h1>{SENTENCE if i % 2 else 'A new bridge'}</h1>" if i % 9 else ""
        title = f"<header>{title}</header>" if i % 7 == 3 else title
        lists = ("<ol><li>Step one</li><li>Step two of it</li></ol>", "", "", f"<ul><li>{SENTENCE}</li><li>One point</li><li>Two <i>points</i> here</li></ul>", "")[i % 5]
        quote = f"<blockquote><p>{SENTENCE}</p></blockquote><h2>More</h2>" if i % 4 == 1 else ""
        table = "<table><tr><th>Year</th><td>1999</td></tr></table>" if i % 7 == 2 else ""
        this = _boiler(kind, name, i)
        inside, after = (this, "") if i % 3 == 2 else ("", this)
        content = f"{holder}>{title}{_paragraphs((1, 2, 1, 4, 6)[at % 5], at)}{inside}{quote}{lists}{table}{_paragraphs(at % 2, at + 3)}</{tag}>"
        around = [_boiler(k, n, i + j) for j, (k, n) in enumerate(bare)]
        body = box(around[0] + (around[1] if i % 3 else ""), i + 1) + box(content + after) + (around[3] if i % 2 == 0 else "") + box(around[2], i + 2)
        yield f"<body>{body if i % 4 else '<div class=page>' + body + '</div>'}</body>"


def _neutral_pages() -> Iterator[str]:
    """Short articles of one to three paragraphs beside a few links or a line of
    small print, all under names that say nothing: text and links decide."""
    body = (SENTENCE, LONG, f"{SENTENCE} <i>So</i> they said.", "It rained all day in the town, and they went home.")
    for i in range(48):
        links = "".join((f"<li><a href='/{w}'>{w}</a></li>", f"<a href='/{w}'>{w}</a> ")[i % 2] for w in ("Home", "News", "Sport", "About us")[: 2 + i % 3])
        links = f"<ul>{links}</ul>" if i % 2 == 0 else links
        own = "".join(f"<p>{body[(i + j) % 4]}</p>" for j in range(1 + i % 3))
        tag = ("div", "section", "article", "main")[i % 4]
        letters = "abcdefghijklmnopqrstuvwxyz"
        content = f"<{tag} data-content class='k{letters[i % 26]}'>{own}</{tag}>"
        beside = f"<div data-boiler class='k{letters[(i + 7) % 26]}'>{links}</div>"
        small = "<div data-boiler><p>&copy; 2024</p></div>" if i % 5 == 0 else ""
        parts = (beside + content, content + beside)[i // 4 % 2] + small
        yield f"<body>{parts if i % 3 else '<div>' + parts + '</div>'}</body>"


class Model:
    """Weights of the features for the label content, and of label pairs."""

    def __init__(self, weights: dict[str, float], pairs: dict[tuple[int, int], float]):
        self.weights = weights
        self.pairs = tuple(tuple(exp(pairs[p, c]) for c in (0, 1)) for p in (0, 1))
        self.likelihood = lru_cache(maxsize=50_000)(self._likelihood)

    @staticmethod
    def features(key: tuple) -> tuple:
        if key[0] == "#text":
            return key[1:]
        return (f"tag-{key[0]}", *(f"name-{w}" for w in key[1:]))

    def _like_known(self, feature: str) -> float:
        """An unknown name counts as the longest known name of four letters or
        more in it (leftmenu: menu); other unknown features say nothing."""
        known = [f for f in self.weights if f.startswith("name-") and len(f) >= 9 and f[5:] in feature] if feature.startswith("name-") else []
        return self.weights[max(known, key=lambda f: (len(f), f))] if known else 0.0

    def _likelihood(self, key: tuple) -> tuple[float, float]:
        """Potentials of a node's two labels, up to a factor."""
        odds = sum(self.weights[f] if f in self.weights else self._like_known(f) for f in self.features(key))
        p = 1 / (1 + exp(-max(-30.0, min(30.0, odds))))
        return 1 - p, p

    def messages(self, tree: Tree) -> tuple[list, list, list]:
        """Per node: its potential with what its children say, the message to
        its parent, and its marginal."""
        (a00, a01), (a10, a11) = self.pairs
        parent, n = tree.parent, len(tree.parent)
        up = [self.likelihood(k) for k in tree.key]
        message = [(1.0, 1.0)] * n
        for i in range(n - 1, 0, -1):
            x0, x1 = up[i]
            m0, m1 = a00 * x0 + a01 * x1, a10 * x0 + a11 * x1
            s = m0 + m1
            message[i] = m0, m1 = m0 / s, m1 / s
            y0, y1 = up[parent[i]]
            y0, y1 = y0 * m0, y1 * m1
            s = y0 + y1
            up[parent[i]] = y0 / s, y1 / s
        belief = up[:]
        for i in range(1, n):
            m0, m1 = message[i]
            b0, b1 = belief[parent[i]]
            b0, b1 = b0 / m0, b1 / m1  # the parent without this child
            x0, x1 = up[i]
            c0, c1 = x0 * (a00 * b0 + a10 * b1), x1 * (a01 * b0 + a11 * b1)
            s = c0 + c1
            belief[i] = (c0 / s, c1 / s)
        return up, message, belief

    def marginals(self, tree: Tree) -> list[float]:
        """Content probability of each node: messages up, then down."""
        return [b[1] for b in self.messages(tree)[2]]

    def blocks(self, html: str) -> list[str]:
        tree = Tree(html)
        return [t for t, p in zip(tree.text, self.marginals(tree), strict=True) if t is not None and p > 0.5]


def node_labels(tree: Tree) -> list[int]:
    """Labels of a labelled page: an element holds content if a block of text
    below it does."""
    labels = [int(bool(x) and t is not None) for x, t in zip(tree.label, tree.text, strict=True)]
    for i in range(len(labels) - 1, 0, -1):
        labels[tree.parent[i]] |= labels[i]
    return labels


def fit(pages: Iterable[str], rounds: int = ROUNDS, rate: float = 0.5, decay: float = 1e-3) -> Model:
    """Weights that make the labels of the pages likely: ascent by page on the
    conditional likelihood, whose gradient is what the labels show less what
    the marginals of nodes and of parent-child pairs expect."""
    trees = [(t, node_labels(t)) for t in map(Tree, pages)]
    weights = {f: 0.0 for t, _ in trees for k in t.key for f in Model.features(k)}
    pairs = {(p, c): 0.0 for p in (0, 1) for c in (0, 1)}
    steps: dict = defaultdict(lambda: 1e-2)

    def move(table: dict, key, gradient: float) -> None:
        gradient -= decay * table[key]
        steps[key] += gradient * gradient
        table[key] += rate * gradient / steps[key] ** 0.5

    for _ in range(rounds):
        for tree, labels in trees:
            model = Model(weights, pairs)
            up, message, belief = model.messages(tree)
            seen: dict = defaultdict(float)
            for i, key in enumerate(tree.key):
                for f in Model.features(key):
                    seen[f] += labels[i] - belief[i][1]
            for i in range(1, len(labels)):
                q = tree.parent[i]
                joint = [belief[q][p] / message[i][p] * model.pairs[p][c] * up[i][c] for p in (0, 1) for c in (0, 1)]
                for at, (p, c) in enumerate(pairs):
                    seen[p, c] += (labels[q] == p and labels[i] == c) - joint[at] / sum(joint)
            for key, gradient in seen.items():
                move(pairs if isinstance(key, tuple) else weights, key, gradient)
    return Model(weights, pairs)


@lru_cache(maxsize=1)
def default_model() -> Model:
    return fit(labelled_pages())


MOST_PAGES = 5000
SCHEMA = "page_id long, url string, text string, n_blocks long"


def main_text(
    pages: DataFrame,
    model_pages: tuple[str, ...] | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """One row per page: id, url, the main text and its number of blocks.  One
    pass, no shuffle.  The driver fits the model once from labelled pages, the
    built-in ones (some 300) or at most ``MOST_PAGES`` given as ``model_pages``."""
    if model_pages is not None and len(model_pages) > MOST_PAGES:
        raise ValueError(f"at most {MOST_PAGES} labelled pages")
    model = default_model() if model_pages is None else fit(model_pages)
    weights, pairs = model.weights, {(p, c): log(model.pairs[p][c]) for p in (0, 1) for c in (0, 1)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(weights, pairs)
        for batch in slices(batches, 500):
            found = [model.blocks(h or "") for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url").cast(pa.string()), pa.array([" ".join(b) for b in found], pa.string()), pa.array(map(len, found), pa.int64())],
                names=["page_id", "url", "text", "n_blocks"],
            )

    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return own.mapInArrow(run, SCHEMA)
