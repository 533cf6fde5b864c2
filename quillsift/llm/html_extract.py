"""Main text of web pages: boosted trees over the page's elements, then one consistent choice per page.

Method: each element has features of its subtree (text, link share, density of text, number and length
of its blocks), its tag and attribute words, its depth, its siblings, and its ancestors. Gradient-boosted trees give
the log odds that it belongs to the article. Decoding is hierarchical: an element can be kept only if
its parent is, so the best choice is a pass up the tree that keeps a subtree if the sum of its log odds,
weighted by text, is above 0. A kept element's own blocks are the main text.

The trees are fitted on a bounded sample: ``SAMPLE`` pages, chosen by a hash of their id, whose article
is marked up as such (article, main), each also in ``VARIANTS`` altered forms: the article's markup and
the names of the other parts are replaced, and headers, menus, side bars, notices, forms, comments and
adverts made of the blocks of other sampled pages are put around and into it. Labels follow from the
construction. Without such pages only the tag and attribute words decide.

Blocks: white space inside a block becomes one space, character references are decoded, a line break
element is a space, blocks are joined by newlines in page order.

Defined results: null and empty pages have an empty text; text outside any element counts as the root's;
unclosed elements end with their parent; repeated rows give equal texts; other columns pass through.
"""

from __future__ import annotations

import hashlib
import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsift.llm.html_tree import Page, parse

SAMPLE = 300
VARIANTS = 4
SEED = 3
TREES, DEPTH, RATE, BINS, LEAF = 40, 4, 0.25, 32, 8
PENALTY = 1.0
CLIP = 6.0
PAGES_AT_ONCE = 100

BAD_WORDS = set(
    "nav navigation navbar menu menus topbar toolbar breadcrumb breadcrumbs pagination pager header masthead banner footer foot "
    "colophon copyright sidebar side rail aside widget widgets ad ads adv advert adverts advertisement advertising sponsor "
    "sponsored promo promotion cookie cookies consent gdpr notice notices notification alert popup modal overlay form search "
    "login signup subscribe subscription newsletter comment comments reply replies respond discussion disqus reader readers share "
    "sharing social related recommended recommendations more tags tag meta hidden skip legal privacy survey feedback contact "
    "teaser outbrain taboola trending popular links blogroll".split()
)
GOOD_WORDS = set("article content post entry story body main text news blog page hentry prose paragraph maincontent articlebody".split())
BAD_TAGS = set("nav header footer aside form menu button fieldset dialog legend option head".split())
GOOD_TAGS = set("article main".split())
LISTS = set("ul ol li dl dt dd table tr td th".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
FEATURES = 30


def features(pages: list[Page]) -> tuple[np.ndarray, list[int]]:
    """(elements of all pages, FEATURES) and where each page begins: once up and once down each tree."""
    first = [0]
    for page in pages:
        first.append(first[-1] + len(page.tags))
    n = first[-1]
    tags = [t for page in pages for t in page.tags]
    words = [w for page in pages for w in page.words]
    parents = [base + max(up, 0) for page, base in zip(pages, first) for up in page.parents]
    chars, links, count, spaces, marks = ([0.0] * n for _ in range(5))
    for page, base in zip(pages, first):
        for element, text, link in page.blocks:
            k = base + element
            chars[k] += len(text)
            links[k] += link
            count[k] += 1
            spaces[k] += text.count(" ") + 1
            marks[k] += text.count(".") + text.count(",")
    own, own_links = np.array(chars), np.array(links)
    size, children, paragraphs = [1.0] * n, [0.0] * n, [0.0] * n
    roots = set(first)
    for k in range(n - 1, 0, -1):
        if k not in roots:
            up = parents[k]
            chars[up] += chars[k]
            links[up] += links[k]
            count[up] += count[k]
            spaces[up] += spaces[k]
            marks[up] += marks[k]
            size[up] += size[k]
            children[up] += 1
            paragraphs[up] += tags[k] == "p"
    bad = [len(BAD_WORDS.intersection(w)) if w else 0 for w in words]
    good = [len(GOOD_WORDS.intersection(w)) if w else 0 for w in words]
    bad_tag, good_tag = [t in BAD_TAGS for t in tags], [t in GOOD_TAGS for t in tags]
    depth, place, seen, under = [0] * n, [0] * n, [0] * n, [0] * n
    above = [(0, 0, 0, 0)] * n
    for k in range(n):
        if k in roots:
            continue
        up = parents[k]
        depth[k] = depth[up] + 1
        place[k] = seen[up]
        seen[up] += 1
        over = above[up]
        if bad[up] or good[up] or bad_tag[up] or good_tag[up]:
            over = (over[0] + bad[up], over[1] + good[up], over[2] + bad_tag[up], over[3] + good_tag[up])
        above[k] = over
        under[k] = 1 if under[up] or bad[k] or bad_tag[k] else 0
    up = np.array(parents, dtype=np.int64)
    root = np.repeat(np.array(first[:-1], dtype=np.int64), np.diff(first))
    total, link, size_, kids, paras = map(np.array, (chars, links, size, children, paragraphs))
    beside = (total[up] - own[up] - total) / np.maximum(kids[up] - 1, 1)
    over = np.array(above, dtype=float).reshape(n, 4)
    columns = [
        np.log1p(total), total / np.maximum(total[root], 1), link / np.maximum(total, 1), total / size_, np.log1p(size_),
        np.log1p(own), own_links / np.maximum(own, 1), np.array(marks) / np.maximum(np.array(spaces), 1),
        total / np.maximum(np.array(count), 1), np.log1p(np.array(count)), np.array(depth), np.array(place) / np.maximum(kids[up], 1), np.log1p(kids),
        np.log1p(np.maximum(beside, 0)), total / np.maximum(total[up], 1), np.log1p(paras), np.log1p(paras[up]),
        np.array(bad), np.array(good), np.array(bad_tag), np.array(good_tag), over[:, 0], over[:, 1], over[:, 2], over[:, 3], np.array(under),
        np.array([t == "p" for t in tags]), np.array([t in HEADINGS for t in tags]),
        np.array([t in LISTS for t in tags]), np.array([t in ("div", "section") for t in tags]),
    ]
    return np.stack([c.astype(np.float32) for c in columns], axis=1), first


class Trees:
    """Boosted regression trees for log odds, fitted by histograms of binned features."""

    def __init__(self):
        self.base = 0.0
        self.feature: list[np.ndarray] = []
        self.border: list[np.ndarray] = []
        self.value: list[np.ndarray] = []

    def raw(self, x: np.ndarray) -> np.ndarray:
        """A tree is an array: the children of slot s are 2 s + 1 and 2 s + 2; a closed slot sends all to the left."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, border, value in zip(self.feature, self.border, self.value):
            slot = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                slot = 2 * slot + 1 + (x[rows, feature[slot]] > border[slot])
            out += value[slot - (2**DEPTH - 1)]
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
        borders = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        bins = np.stack([np.searchsorted(b, x[:, j], side="left") for j, b in enumerate(borders)], axis=1)
        share = np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        score = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            gradient, curve = weight * (y - p), weight * p * (1 - p)
            score += self._grow(bins, borders, gradient, curve)
        return self

    def _grow(self, bins: np.ndarray, borders: list[np.ndarray], gradient: np.ndarray, curve: np.ndarray) -> np.ndarray:
        inner = 2**DEPTH - 1
        feature, border = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        slot = np.zeros(len(bins), dtype=np.int64)
        for level in range(DEPTH):
            first, count = 2**level - 1, 2**level
            cell = (slot - first) * BINS
            best = np.zeros(count)
            cut = np.full(count, BINS, dtype=np.int64)
            for j in range(bins.shape[1]):
                g, h, n = (
                    np.bincount(cell + bins[:, j], w, count * BINS).reshape(count, BINS).cumsum(axis=1) for w in (gradient, curve, None)
                )
                gain = _gain(g, h, n)
                at = gain.argmax(axis=1)
                top = gain[np.arange(count), at]
                better = top > best + 1e-9
                best[better], cut[better] = top[better], at[better]
                feature[first : first + count][better] = j
            for k in range(count):
                if cut[k] < BINS:
                    border[first + k] = borders[feature[first + k]][cut[k]]
            slot = 2 * slot + 1 + (bins[np.arange(len(bins)), feature[slot]] > cut[slot - first])
        leaf = slot - inner
        g, h = np.bincount(leaf, gradient, inner + 1), np.bincount(leaf, curve, inner + 1)
        value = RATE * g / (h + PENALTY)
        self.feature.append(feature)
        self.border.append(border)
        self.value.append(value)
        return value[leaf]


def _gain(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Gain of cutting each cell after each bin; 0 where a side would be too small."""
    gr, hr, nr = g[:, -1:] - g, h[:, -1:] - h, n[:, -1:] - n
    gain = g**2 / (h + PENALTY) + gr**2 / (hr + PENALTY) - g[:, -1:] ** 2 / (h[:, -1:] + PENALTY)
    return np.where((n >= LEAF) & (nr >= LEAF), gain, 0.0)


def decode(page: Page, odds: list[float]) -> list[bool]:
    """The kept elements: the best subtree with the root in which no element is kept without its parent."""
    n = len(page.tags)
    weight = [1.0] * n
    for element, text, _ in page.blocks:
        weight[element] += math.log1p(len(text))
    best = [o * w for o, w in zip(odds, weight)]
    for k in range(n - 1, 0, -1):
        best[page.parents[k]] += max(0.0, best[k])
    kept = [False] * n
    kept[0] = True
    for k in range(1, n):
        kept[k] = kept[page.parents[k]] and best[k] > 0
    return kept


def main_texts(sources: list, trees: Trees) -> list[str]:
    """Main text of each page; the trees see the elements of all pages at once."""
    pages = [parse(source) for source in sources]
    if not pages:
        return []
    x, first = features(pages)
    odds = np.clip(trees.raw(x), -CLIP, CLIP).tolist()
    out = []
    for page, begin, end in zip(pages, first, first[1:]):
        kept = decode(page, odds[begin:end])
        out.append("\n".join(text for element, text, _ in page.blocks if kept[element]))
    return out


CONTENT_NAMES = (
    'class="content"', 'class="post-content"', 'class="entry-content"', 'id="content"', 'class="article-body"', 'class="story"', 'class="post"',
    'id="main"', 'class="main-content"', 'itemprop="articleBody"', "", 'class="text"', 'role="main"', 'class="c-12"',
)
PARTS = {
    "menu": ('<nav>{l}</nav>', '<div class="menu">{l}</div>', '<ul id="navigation">{i}</ul>', '<div class="navbar">{l}</div>', '<div class="breadcrumbs">{l}</div>', '<div id="top">{l}</div>', '<ul>{i}</ul>', '<div>{l}</div>'),
    "head": ('<header>{l}{p}</header>', '<div id="header">{p}{l}</div>', '<div class="masthead">{h}</div>', '<header><h1>{t}</h1></header>'),
    "foot": ('<footer>{p}</footer>', '<div class="footer">{p}{l}</div>', '<div id="copyright">{t}</div>', '<footer>{t}</footer>'),
    "side": ('<aside>{h}{l}</aside>', '<div class="sidebar">{p}{l}</div>', '<div id="widgets">{h}{p}</div>', '<aside class="related">{h}{l}</aside>', '<aside>{p}{p}</aside>'),
    "note": ('<div class="cookie-notice">{p}</div>', '<div id="consent">{t}</div>', '<div class="alert">{t}</div>', '<div class="notice"><p>{t}</p></div>', '<div role="alert">{p}</div>'),
    "ad": ('<div class="ad">{t}</div>', '<div class="advert">{p}</div>', '<section class="sponsored">{h}{p}</section>', '<div id="ads">{l}</div>', '<div class="promo">{t}</div>'),
    "form": ('<form>{p}<label>{t}</label><input></form>', '<div class="newsletter"><form>{t}<button>{t}</button></form></div>', '<form class="search"><input><button>{t}</button></form>'),
    "talk": (
        '<section class="comments">{h}<div class="comment">{p}{p}</div><div class="comment">{p}</div></section>',
        '<div id="comments"><ul><li>{p}</li><li>{p}</li></ul></div>', '<ol class="comment-list"><li class="reply">{p}</li></ol>',
        '<div class="discussion"><article class="comment">{p}</article>{p}</div>',
    ),
}
MARK = "data-quillsift"


def altered(page: Page, kept: list[bool], pool: list[str], rng: random.Random) -> str:
    """The page's article in new markup among parts made of the pool's texts, which are marked as such."""
    blocks = [(page.tags[e], t) for e, t, _ in page.blocks if kept[e]]

    def fill(form: str) -> str:
        def text() -> str:
            return _escaped(rng.choice(pool))

        def short() -> str:
            return " ".join(text().split()[: rng.randint(1, 8)])

        for slot, make in (
            ("{l}", lambda: "".join(f"<a href='/x'>{short()}</a> " for _ in range(rng.randint(2, 8)))),
            ("{i}", lambda: "".join(f"<li><a href='/x'>{short()}</a></li>" for _ in range(rng.randint(2, 8)))),
            ("{p}", lambda: f"<p>{text()}</p>"), ("{h}", lambda: f"<h3>{short()}</h3>"), ("{t}", lambda: text() if rng.random() < 0.5 else short()),
        ):
            while slot in form:
                form = form.replace(slot, make(), 1)
        return form

    def part(kind: str) -> str:
        form = rng.choice(PARTS[kind])
        cut = form.index(">") if " " not in form[: form.index(">")] else form.index(" ")
        return fill(form[:cut] + f" {MARK}='0'" + form[cut:])

    body = []
    for tag, text in blocks:
        tag = tag if tag in HEADINGS or tag in ("p", "li", "blockquote", "pre") else "p"
        inner = _escaped(text).split(" ")
        if rng.random() < 0.15:
            at = rng.randrange(len(inner))
            inner[at] = f"<a href='/x'>{inner[at]}</a>"
        body.append(f"<{tag}>{' '.join(inner)}</{tag}>")
        if rng.random() < 0.06:
            body.append(part(rng.choice(["ad", "side", "form", "note"])))
    if rng.random() < 0.4:
        body.append(part(rng.choice(["talk", "side", "form", "ad"])))
    tag = rng.choice(["div", "div", "section", "article", "main"])
    name = rng.choice(CONTENT_NAMES) if tag in ("div", "section") else ""
    article = f"<{tag} {name}>{''.join(body)}</{tag}>"
    for _ in range(rng.randint(0, 2)):
        article = f"<div class='{rng.choice(['wrap', 'container', 'row', 'page', 'layout', 'inner'])}'>{article}</div>"
    before = [part(k) for k in ("note", "head", "menu", "ad", "side", "form") if rng.random() < 0.5]
    after = [part(k) for k in ("talk", "side", "ad", "form", "note", "foot") if rng.random() < 0.5]
    rng.shuffle(before)
    return f"<html><body>{''.join(before)}{article}{''.join(after)}</body></html>"


def _escaped(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def marked_kept(page: Page) -> list[bool] | None:
    """What the markup itself says: the article or main element and its ancestors; null if there is none."""
    inside, n = [False] * len(page.tags), len(page.tags)
    for k in range(n):
        up = page.parents[k]
        inherited = up >= 0 and inside[up]
        bad = page.tags[k] in BAD_TAGS or bool(BAD_WORDS.intersection(page.words[k]))
        inside[k] = (inherited or (page.tags[k] in GOOD_TAGS)) and not bad
    kept = inside[:]
    for k in range(n - 1, 0, -1):
        kept[page.parents[k]] |= kept[k]
    return kept if any(inside[e] for e, _, _ in page.blocks) else None


def constructed_kept(page: Page) -> list[bool]:
    """Of an altered page: everything but the marked parts."""
    out = [False] * len(page.tags)
    for k in range(len(page.tags)):
        out[k] = (page.parents[k] < 0 or out[page.parents[k]]) and "marked" not in page.words[k]
    return out


def fit(sources: list[str], seed: int = SEED) -> Trees:
    rng = random.Random(seed)
    pages = list(map(parse, sources))
    kept = [marked_kept(p) for p in pages]
    pool = sorted({t for p in pages for _, t, _ in p.blocks})
    x, y, w = [], [], []

    def add(page: Page, truth: list[bool]) -> None:
        weight = np.ones(len(page.tags))
        for element, text, _ in page.blocks:
            weight[element] += np.log1p(len(text))
        x.append(features([page])[0])
        y.append(np.array(truth, dtype=float))
        w.append(weight)

    for page, truth in zip(pages, kept):
        if truth is not None:
            add(page, truth)
            for _ in range(VARIANTS):
                source = altered(page, truth, pool, rng)
                marked = parse(source.replace(f"{MARK}='0'", "data-x='marked'"))
                plain = parse(source.replace(f" {MARK}='0'", ""))
                add(plain, constructed_kept(marked))
    if not x:
        page = parse("<body><article><p>x</p></article><nav><p>x</p></nav></body>")
        add(page, [t not in ("nav",) for t in page.tags])
    return Trees().fit(np.concatenate(x), np.concatenate(y), np.concatenate(w))


def sample(pages: DataFrame, key: str = "page_id", html: str = "html") -> list[str]:
    """About SAMPLE pages with an article or main element, chosen by a hash of their key."""
    known = pages.where(F.col(html).rlike("(?i)<(article|main)[\\s>]")).select(F.col(key).cast("string").alias("key"), F.col(html).alias("html"))
    count = max(1, pages.count())
    chance = F.pmod(F.xxhash64("key", F.lit(SEED)), F.lit(1 << 30)) / float(1 << 30)
    rows = known.where(chance < SAMPLE / count).select("html").limit(4 * SAMPLE).collect()
    return sorted((r["html"] for r in rows), key=lambda s: hashlib.md5(s.encode("utf-8", "surrogatepass")).hexdigest())


def train(pages: DataFrame, key: str = "page_id", html: str = "html") -> Trees:
    return fit(sample(pages, key, html))


def text_of(html: Column, trees: Trees) -> Column:
    """Main text of each whole page; the trees are small and travel with the function."""

    @F.arrow_udf("string")
    def extracted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            sources = batch.to_pylist()
            texts = [t for k in range(0, len(sources), PAGES_AT_ONCE) for t in main_texts(sources[k : k + PAGES_AT_ONCE], trees)]
            yield pa.array(texts, pa.string())

    return extracted(html.cast("string"))


def extract(pages: DataFrame, trees: Trees, html: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with a column ``into``, the main text."""
    return pages.withColumn(into, text_of(F.col(html), trees))
