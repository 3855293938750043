"""Main text of web pages by a tree-structured graphical model.

Block elements of a page are the nodes of a tree; each is content or not. A node's features give its
own potential, a table of four figures the potential between a parent and a child. Messages go up
from the leaves and down from the root (sum-product, exact on trees), which yields for every node
the probability of being content under all evidence of its page.

The model is trained, by the gradient of the likelihood, on pages of the corpus that mark their
article with ``<article>`` or ``<main>``, on copies of them without those marks, and on pages built
from the layouts below, filled with texts of the sample. The sample is bounded: of the marked pages
of at most ``LONGEST`` characters the ``PAGES`` first in the order of a hash of the whole row, so it
does not depend on how rows are dealt. Texts of all pages are extracted whole, however long.

Cases: null or empty html gives an empty text; broken markup is read as far as it goes, in time
linear in its length; elements nested deeper than ``html_tree.DEEPEST`` count as children of the
one at that depth; rows without page_id or url are judged like others; repeated rows are judged
each; an empty table gives an empty result; without marked pages the layouts alone teach the model.
"""

import re

import numpy as np
from pyspark.sql import DataFrame, functions as F

from stillwell.llm.common import Shared, map_arrow
from stillwell.llm.html_tree import Page

PAGES, LONGEST = 120, 100_000
STEPS = 250
#: Kinds of elements and of words in class and id, as features.
TAGS = ("#page html body article main section div p h1 h2 h3 h4 ul ol li nav header footer aside "
        "form fieldset figure figcaption table tr td th blockquote pre dl dd dt details").split()
WORDS = {
    "menu": "nav menu breadcrumb toc pagination pager tabs skip topbar toolbar",
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion banner dfp",
    "notice": "cookie consent notice gdpr alert popup modal overlay newsletter subscribe paywall",
    "comment": "comment comments reply replies disqus discussion respond responses",
    "side": "sidebar side aside widget related recommended more popular trending rail",
    "foot": "footer foot copyright legal colophon bottom",
    "head": "header masthead logo brand top site-header",
    "form": "form login search signup signin input",
    "share": "share social follow tags tag byline meta author",
    "body": "article content post entry story text main body page-content prose",
}
_GROUP = {w: g for g, words in WORDS.items() for w in words.split()}
_WORD = re.compile(r"[a-z]+")
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_LENGTHS = (1, 25, 80, 250, 1000)
FEATURES = ["bias", *(f"tag {t}" for t in TAGS), "tag other", *(f"word {g}" for g in WORDS),
            *(f"length {n}" for n in _LENGTHS), "linked", "sentence", "paragraphs below"]
_AT = {name: i for i, name in enumerate(FEATURES)}
#: Layouts: elements marked + are content, others take their parent's mark; ~ is a text.
LAYOUTS = (
    "<header><div class=logo>~</div><nav><ul><li><a>~</a><li><a>~</a></ul></nav></header>"
    "<main><article+><h1>~</h1><p>~</p><p>~</p><ul><li>~<li>~</ul><p>~</p></article></main>"
    "<aside><h3>~</h3><ul><li><a>~</a><li><a>~</a></ul></aside><footer><p>~</p></footer>",
    "<div class='cookie-notice'><p>~</p></div><div id=menu><a>~</a> <a>~</a></div>"
    "<div id=content+><h2>~</h2><p>~</p><p>~</p><blockquote><p>~</p></blockquote><p>~</p></div>"
    "<div class=sidebar><p>~</p><ul><li><a>~</a></ul></div><div id=footer>~</div>",
    "<div class=banner>~</div><div class=wrapper><div class='post-body'+><p>~</p><h3>~</h3><p>~</p>"
    "</div><div id=comments><h3>~</h3><div class=comment><p>~</p></div><div class=comment><p>~</p>"
    "</div><form><p>~</p></form></div></div><div class=copyright>~</div>",
    "<nav><a>~</a><a>~</a></nav><section+><h1>~</h1><div><p>~</p><p>~</p></div></section>"
    "<section class=comments><p>~</p><p>~</p></section><form class=newsletter><p>~</p></form>",
    "<table><tr><td class=nav><a>~</a><a>~</a></td><td class=main+><p>~</p><p>~</p><p>~</p></td>"
    "</tr></table><div class=legal>~</div>",
    "<article+><h1>~</h1><p>~</p><figure><figcaption>~</figcaption></figure><p>~</p>"
    "</article><div class='ad'>~</div><div class='related'><ul><li><a>~</a><li><a>~</a></ul></div>"
    "<aside class=notice>~</aside><section id=comments><article class=comment><p>~</p></article>"
    "<article class=comment><p>~</p></article></section>",
)
_MARKED = re.compile(r"<(\w+)([^<>+]*)\+>")
_BAD = frozenset("nav header footer aside form".split())


def node_features(pages: list[Page]) -> np.ndarray:
    """(nodes, features) of all nodes, page after page."""
    sizes = [len(p.tags) for p in pages]
    first = np.r_[0, np.cumsum(sizes)]
    x = np.zeros((first[-1], len(FEATURES)))
    x[:, 0] = 1
    memo: dict[tuple, list[int]] = {}
    letters, linked = np.zeros(len(x)), np.zeros(len(x))
    for start, page in zip(first, pages):
        for i, kind in enumerate(zip(page.tags, page.attributes)):
            if kind not in memo:
                own = {_AT.get(f"tag {kind[0]}", _AT["tag other"])}
                for _, value in _ATTRIBUTE.findall(kind[1]):
                    own |= {_AT[f"word {_GROUP[w]}"] for w in _WORD.findall(value.lower())
                            if w in _GROUP}
                memo[kind] = sorted(own)
            x[start + i, memo[kind]] = 1
            if kind[0] == "p":
                x[start + page.parents[i], _AT["paragraphs below"]] = 1
        for node, text, inside in page.segments:
            letters[start + node] += len(text)
            linked[start + node] += inside
            if text[-1] in ".!?":
                x[start + node, _AT["sentence"]] = 1
    for n in _LENGTHS:
        x[:, _AT[f"length {n}"]] = letters >= n
    x[:, _AT["linked"]] = np.minimum(1, linked / np.maximum(1, letters))
    return x


class Forest:
    """Parents of all nodes of several pages, by depth."""

    def __init__(self, pages: list[Page]):
        first = np.r_[0, np.cumsum([len(p.tags) for p in pages])]
        self.parent = np.concatenate([
            np.array(p.parents) + np.where(np.array(p.parents) < 0, 0, start)
            for start, p in zip(first, pages)])
        depth = np.zeros(len(self.parent), int)
        for i, up in enumerate(self.parent):  # parents stand before their children
            if up >= 0:
                depth[i] = depth[up] + 1
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.cumsum(np.bincount(depth))[:-1])

    def marginals(self, own: np.ndarray, pair: np.ndarray):
        """Probability of each node being content, and of each (parent, child) pair of states.

        ``own``: log-odds of the nodes; ``pair[a, b]``: log-potential of parent a and child b."""
        w = np.exp(pair)
        up = np.clip(own, -30, 30).copy()
        sent = np.zeros(len(own))
        for level in self.levels[:0:-1]:
            odds = np.exp(np.clip(up[level], -30, 30))
            sent[level] = np.log((w[1, 0] + w[1, 1] * odds) / (w[0, 0] + w[0, 1] * odds))
            np.add.at(up, self.parent[level], sent[level])
        belief = up.copy()
        pairs = np.zeros((len(own), 2, 2))
        for level in self.levels[1:]:
            cavity = belief[self.parent[level]] - sent[level]
            odds = np.exp(np.clip(cavity, -30, 30))
            belief[level] += np.log((w[0, 1] + w[1, 1] * odds) / (w[0, 0] + w[1, 0] * odds))
            below = np.exp(np.clip(up[level], -30, 30))
            joint = np.stack([np.full(len(level), w[0, 0]), w[0, 1] * below,
                              w[1, 0] * odds, w[1, 1] * odds * below], axis=1)
            pairs[level] = (joint / joint.sum(axis=1, keepdims=True)).reshape(-1, 2, 2)
        return 1 / (1 + np.exp(-np.clip(belief, -30, 30))), pairs


def trained(pages: list[Page], labels: list[list[int]], steps: int = STEPS):
    """Weights of the features and the pair table, by gradient ascent with momentum."""
    x, forest, y = node_features(pages), Forest(pages), np.concatenate(labels).astype(float)
    child = np.flatnonzero(forest.parent >= 0)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[forest.parent[child]].astype(int), y[child].astype(int)), 1)
    weights, pair = np.zeros(x.shape[1]), np.zeros((2, 2))
    moved, moved_pair = np.zeros_like(weights), np.zeros_like(pair)
    for _ in range(steps):
        p, pairs = forest.marginals(x @ weights, pair)
        gradient = x.T @ (y - p) / len(y) - 1e-4 * weights
        gradient_pair = (seen - pairs[child].sum(axis=0)) / len(y) - 1e-4 * pair
        moved, moved_pair = 0.9 * moved + gradient, 0.9 * moved_pair + gradient_pair
        weights, pair = weights + moved, pair + moved_pair
    return weights, pair


def marked(page: Page) -> list[int]:
    """1 for nodes within an article or main element, but not within parts that never belong."""
    out = []
    for tag, attributes, parent in zip(page.tags, page.attributes, page.parents):
        inside = parent >= 0 and out[parent] == 1
        if tag in ("article", "main") and "comment" not in attributes:
            inside = True
        out.append(int(inside and tag not in _BAD))
    return out


def built(texts: list[str]) -> tuple[list[Page], list[list[int]]]:
    """Labelled pages from the layouts, filled with ``texts``: long ones into content."""
    texts = sorted(texts or ["Lorem ipsum.", "Dolor sit amet, consectetur adipiscing elit, sed do."],
                   key=len)
    short, rng = texts[:max(1, len(texts) // 2)], np.random.default_rng(3)
    pages, labels = [], []
    for turn in range(8):
        for layout in LAYOUTS:
            source = _MARKED.sub(r"<\1\2 data-content>", layout)
            parts = re.split(r"(<p>~)|(~)", source)
            filled = "".join(
                "" if part is None else
                "<p>" + texts[rng.integers(len(texts))] if part == "<p>~" else
                short[rng.integers(len(short))] if part == "~" else part for part in parts)
            page = Page(f"<html><body>{filled}</body></html>")
            own = []
            for tag, attributes, parent in zip(page.tags, page.attributes, page.parents):
                own.append(int("data-content" in attributes or parent >= 0 and own[parent] == 1))
            page.attributes = [a.replace(" data-content", "") for a in page.attributes]
            pages.append(page)
            labels.append(own)
    return pages, labels


def training_pages(sources: list[str]) -> tuple[list[Page], list[list[int]]]:
    pages, labels, texts = [], [], []
    for source in sources:
        page = Page(source)
        own = marked(page)
        texts += [s[1] for s in page.segments if len(s[1]) < 2000][:20]
        if not any(own):
            continue
        bare = Page(source)
        bare.tags = ["div" if t in ("article", "main") else t for t in bare.tags]
        pages += [page, bare]
        labels += [own, own]
    more_pages, more_labels = built(texts)
    return pages + more_pages, labels + more_labels


def main_texts(pages: list[Page], weights: np.ndarray, pair: np.ndarray) -> list[str]:
    if not pages:
        return []
    p, _ = Forest(pages).marginals(node_features(pages) @ weights, pair)
    out, start = [], 0
    for page in pages:
        out.append(" ".join(text for node, text, _ in page.segments if p[start + node] >= 0.5))
        start += len(page.tags)
    return out


def html_text(table: DataFrame, pages: int = PAGES) -> DataFrame:
    """page_id, url, text, n_chars of each row of ``table``."""
    rows = table.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce("html", F.lit("")).alias("html"))
    place = F.xxhash64("page_id", "url", "html")
    marked_ = rows.filter(F.col("html").rlike("(?i)<(article|main)[\\s>]") & (
        F.length("html") <= LONGEST)).select("html", place.alias("place"))
    # First the places alone, so that no task sends pages that are not chosen in the end.
    first = [r[0] for r in marked_.select("place").distinct().orderBy("place").limit(pages).collect()]
    chosen = marked_.filter(F.col("place") <= max(first)).groupBy("place").agg(
        F.min("html").alias("html")).orderBy("place").collect() if first else []
    model = Shared(table.sparkSession, trained(*training_pages([r["html"] for r in chosen])))

    def extract(batches):
        weights, pair = model.value
        for b in batches:
            texts = main_texts([Page(h or "") for h in b["html"].to_pylist()], weights, pair)
            yield {"page_id": b["page_id"], "url": b["url"], "text": texts,
                   "n_chars": [len(t) for t in texts]}

    return map_arrow(rows, extract, "page_id long, url string, text string, n_chars long")
