"""Main text of web pages: boosted trees over DOM nodes, decoded over the tree.

Every element becomes a row of features: text, link and punctuation density of
its subtree, tag kind, depth, sibling position, words of its class, id and role,
and the same of its ancestors. Boosted trees (trained here, in numpy, on a
bounded sample of pages) give each element log odds of being article text.
Labels come from the pages themselves: elements inside an ``article`` or
``main`` element, or inside a marked menu, footer, advert and so on, in pages
that use such marks (inside an article only whole names of containers count as
marks, so ``related-work`` or ``article-header`` stay with the article). Every training page is used three times: as it is, with all
marks hidden (so that pages without marks are judged by density and place), and
with its texts rearranged under other marks and layouts.

Decoding chooses for each subtree: keep all, drop all, or let its parts decide,
by dynamic programming over summed log odds. An element dropped as a whole
cannot keep a descendant, nor the other way round.

The text: references decoded, white space inside a block one space, blocks
joined by one space in page order; nothing else is cut.

Edge cases: null and empty pages and pages without text give the empty string;
unclosed, crossed and unknown tags are accepted; without any marked page in the
sample every element counts as text unless it carries a mark of its own or
hides its text; repeated rows are extracted each time; extra columns are dropped.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosting
from . import textvec as tv
from .dom import HIDDEN, INLINE, Page, attribute_names, attribute_tokens

#: bounds of the training sample (documented parameters): pages, bytes of a page, elements of each use of a page
MAX_TRAIN_PAGES = 600
MAX_TRAIN_HTML = 1 << 20
MAX_TRAIN_ELEMENTS = 500
TOKEN_BUCKETS = 8
#: words of tags, classes, ids and roles that mark what is no article text (fixed values)
ASIDE_WORDS = frozenset("""
ad ads advert adverts advertisement advertising alert aside banner breadcrumb breadcrumbs byline comment comments complementary
consent contentinfo cookie cookies copyright discussion disqus feedback footer form gdpr header hidden legal login masthead menu menubar
modal nav navbar navigation newsletter notice notification pager pagination popup promo promotion recommended related replies
reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toc toolbar
tracking widget
""".split())
#: words that mark article text (fixed values)
ARTICLE_WORDS = frozenset("article articlebody content entry main post story".split())
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
LISTS = frozenset("ul ol li dl dt dd menu".split())
TABLES = frozenset("table thead tbody tfoot tr td th caption".split())
CONTAINERS = frozenset("#page html body div section article main center".split())
PUNCTUATION = str.maketrans("", "", ".,;:!?")

NAMES = ["depth", "sibling", "siblings", "children", "own_chars", "chars", "tags", "density", "link_density", "in_link",
         "punctuation", "share", "place", "paragraph", "heading", "list", "table", "inline", "container", "parent_link_density",
         "parent_share", "article_mark", "article_above", "aside_mark", "aside_above",
         *[f"token_{k}" for k in range(TOKEN_BUCKETS)]]
MARKS = slice(NAMES.index("article_mark"), len(NAMES))


class Features:
    """Feature rows and tree of one page."""

    def __init__(self, html: str):
        page = self.page = Page(html)
        n = len(page.tag)
        parent = page.parent
        own, links, stops = [0] * n, [0] * n, [0] * n
        place = [0] * n
        in_link, hidden = [False] * n, [False] * n
        depth, sibling, children, seen_at = [0] * n, [0] * n, [0] * n, 0
        article, aside, article_up, aside_up = [0] * n, [0] * n, [0] * n, [0] * n
        tokens = np.zeros((n, TOKEN_BUCKETS), np.float32)
        for i in range(1, n):
            up, tag = parent[i], page.tag[i]
            depth[i] = depth[up] + 1
            sibling[i] = children[up]
            children[up] += 1
            in_link[i] = in_link[up] or tag == "a"
            hidden[i] = hidden[up] or tag in HIDDEN
            article_up[i], aside_up[i] = article_up[up] + article[up], aside_up[up] + aside[up]
            if tag in ("html", "body"):
                continue
            words = attribute_tokens(page.attributes[i])
            for w in words:
                tokens[i, zlib.crc32(w.encode()) % TOKEN_BUCKETS] = 1
            article[i] = int(tag in ARTICLE_WORDS or bool(words & ARTICLE_WORDS))
            # inside an article only whole names of containers count, and its heading group belongs to it
            names = attribute_names(page.attributes[i]) if words & ASIDE_WORDS and article_up[i] else words
            own_marks = (names | {tag}) & ASIDE_WORDS
            aside[i] = int(bool(own_marks - {"header"} if article_up[i] else own_marks))
        for element, text, _ in page.runs:
            size = 0 if hidden[element] else len("".join(text.split()))
            if size:
                own[element] += size
                stops[element] += len(text) - len(text.translate(PUNCTUATION))
                links[element] += size if in_link[element] else 0
        chars, link_chars, punctuation, tags = own[:], links[:], stops[:], [1] * n
        for i in range(n - 1, 0, -1):
            up = parent[i]
            chars[up] += chars[i]
            link_chars[up] += link_chars[i]
            punctuation[up] += punctuation[i]
            tags[up] += tags[i]
        for i in range(n):
            place[i] = seen_at
            seen_at += own[i]
        self.own, self.hidden, self.parent = own, hidden, parent
        up = np.array(parent)
        up[0] = 0
        total = max(chars[0], 1)
        c = np.array(chars, float)
        link = np.array(link_chars) / np.maximum(c, 1)
        t = np.array(tags, float)
        kind = page.tag
        x = np.zeros((n, len(NAMES)), np.float32)
        columns = [depth, sibling, np.array(children)[up], children, np.log1p(own), np.log1p(c), np.log1p(t), np.log1p(c / t),
                   link, in_link, np.array(punctuation) / np.maximum(c, 1), c / total, np.array(place) / total,
                   [k == "p" for k in kind], [k in HEADINGS for k in kind], [k in LISTS for k in kind],
                   [k in TABLES for k in kind], [k in INLINE for k in kind], [k in CONTAINERS for k in kind],
                   link[up], c[up] / total, article, article_up, aside, aside_up]
        for k, values in enumerate(columns):
            x[:, k] = values
        x[:, len(columns):] = tokens
        self.x = x
        marked_aside = (x[:, NAMES.index("aside_mark")] + x[:, NAMES.index("aside_above")]) > 0
        marked_article = (x[:, NAMES.index("article_mark")] + x[:, NAMES.index("article_above")]) > 0
        #: 1 article, 0 aside, -1 unknown
        self.label = np.where(marked_aside, 0, np.where(marked_article, 1, -1))
        self.label[(c == 0) | np.array(hidden)] = -1


def keep_elements(features: Features, logit: np.ndarray) -> list[bool]:
    """Elements whose own text stays: the best consistent choice over the tree."""
    n = len(logit)
    logit = np.clip(logit, -6, 6)
    own = (logit * np.sqrt(np.array(features.own, float))).tolist()
    whole = [o + v for o, v in zip(own, logit.tolist(), strict=True)]
    mixed = [abs(o) for o in own]
    parent = features.parent
    for i in range(n - 1, 0, -1):
        if features.hidden[i]:
            continue
        up = parent[i]
        whole[up] += whole[i]
        # a choice of its own costs a little, so equal subtrees stay together
        mixed[up] += max(abs(whole[i]), mixed[i] - 0.5)
    keep = [False] * n
    state = [0] * n
    for i in range(n):
        above = state[parent[i]] if i else 0
        if features.hidden[i]:
            state[i] = -1
        elif above:
            state[i] = above
        elif abs(whole[i]) >= mixed[i] - 0.5:
            state[i] = 1 if whole[i] > 0 else -1
        keep[i] = state[i] > 0 or (state[i] == 0 and own[i] > 0)
    return keep


def text_of(page: Page, keep: list[bool]) -> str:
    """Kept runs: white space inside a block one space, blocks joined by one space."""
    parts: list[str] = []
    block = -1
    for element, text, number in page.runs:
        if keep[element]:
            if number != block:
                parts.append(" ")
                block = number
            parts.append(text)
    return " ".join("".join(parts).split())


def extract(htmls: list[str | None], model: boosting.Boosted | None) -> list[str]:
    pages = [Features(h or "") for h in htmls]
    if not pages:
        return []
    if model is None:
        logits = [np.where(p.x[:, NAMES.index("aside_mark")] + p.x[:, NAMES.index("aside_above")] > 0, -3.0, 3.0) for p in pages]
    else:
        scores = model.logit(np.concatenate([p.x for p in pages]))
        logits = np.split(scores, np.cumsum([len(p.x) for p in pages])[:-1])
    return [text_of(p.page, keep_elements(p, v)) for p, v in zip(pages, logits, strict=True)]


def rearranged(html: str, features: Features) -> str:
    """The article texts of a page in another layout, with other marks from the word lists.

    Shows the trees marks and layouts that few pages of the sample have; the
    choice depends on the page alone.
    """
    rng = random.Random(zlib.crc32(html.encode("utf-8", "replace")))
    blocks: dict[int, list[str]] = {}
    for element, text, number in features.page.runs:
        if features.label[element] == 1:
            blocks.setdefault(number, []).append(text)
    texts = [t for t in (" ".join("".join(b).split()) for b in blocks.values()) if t]
    if not texts:
        return ""

    def some(n: int) -> str:
        words = rng.choice(texts).split()
        at = rng.randrange(len(words))
        return escape(" ".join(words[at:at + n]))

    def inside() -> str:
        """Text of an element in one of the usual shapes: paragraphs, lists, tables, links."""
        shape = rng.randrange(7)
        if shape == 0:
            return "".join(f"<p>{some(rng.choice((5, 40, 200)))}</p>" for _ in range(rng.randint(1, 4)))
        if shape == 1:
            return "<ul>" + "".join(f"<li>{some(rng.randint(2, 20))}</li>" for _ in range(rng.randint(2, 6))) + "</ul>"
        if shape == 2:
            return some(rng.choice((3, 15, 60)))
        if shape == 3:
            return f"<h{rng.randint(2, 4)}>{some(4)}</h3><p>{some(rng.choice((10, 80)))}</p><p>{some(60)} <a href=x>{some(2)}</a> {some(5)}</p>"
        if shape == 4:
            return "<table>" + "".join(f"<tr><td>{some(2)}</td><td>{some(3)}</td></tr>" for _ in range(3)) + "</table>"
        if shape == 5:
            return f"<blockquote>{some(30)}</blockquote><div>{some(rng.choice((8, 100)))}</div>"
        return f"<div><span>{some(4)}</span> <b>{some(2)}</b></div><pre>{some(20)}</pre>"

    def links() -> str:
        return "<ul>" + "".join(f"<li><a href=x>{some(rng.randint(1, 4))}</a></li>" for _ in range(rng.randint(2, 8))) + "</ul>"

    def aside() -> str:
        tag = rng.choice(("div", "div", "section", "aside", "nav", "footer", "form", "p", "span"))
        word = rng.choice(sorted(ASIDE_WORDS))
        mark = rng.choice((f' class="{word}"', f' id="{word}"', f' class="x-{word} wide"', f' role="{word}"'))
        body = links() if rng.random() < 0.4 else inside()
        return f"<{tag}{mark}>{body}</{tag}>"

    word = rng.choice(sorted(ARTICLE_WORDS - {"articlebody"}))
    tag, mark = rng.choice((("article", ""), ("main", ""), ("div", f' class="{word}"'), ("section", f' id="{word}"')))
    body = f"<h1>{some(6)}</h1>" + "".join(
        aside() if rng.random() < 0.2 else f"<p>{escape(rng.choice(texts))}</p>" if rng.random() < 0.5 else inside()
        for _ in range(rng.randint(2, 7)))
    around = [aside() for _ in range(rng.randint(2, 6))]
    cut = rng.randint(0, len(around))
    wrap = rng.choice((("", ""), ("<div>", "</div>"), ('<div class="page"><div>', "</div></div>")))
    return ("<html><body>" + wrap[0] + "".join(around[:cut]) + f"<{tag}{mark}>{body}</{tag}>" + "".join(around[cut:]) + wrap[1]
            + "</body></html>")


def training_rows(html: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Feature rows and labels of a page: as it is, with its marks hidden, and rearranged."""
    features = Features(html)
    out = []
    for f, bare in ((features, False), (features, True), (Features(rearranged(html, features)), False)):
        at = np.flatnonzero(f.label >= 0)
        at = at[:: max(1, -(-len(at) // MAX_TRAIN_ELEMENTS))]
        x = f.x[at].copy()
        if bare:
            x[:, MARKS] = 0
        out.append((x, f.label[at]))
    return out


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in tv.pieces(batches, "html", 1 << 20):
        for html in tv.column(part, "html").to_pylist():
            for x, y in training_rows(html or ""):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r.tobytes() for r in x], pa.binary()), pa.array(y.astype(np.int32))], ["x", "y"])


def fit(pages: DataFrame, max_pages: int = MAX_TRAIN_PAGES) -> boosting.Boosted | None:
    """Trees learnt from the marked elements of at most ``max_pages`` pages, in hash order of the id."""
    picked = (pages.where("page_id IS NOT NULL").select("page_id").distinct()
              .orderBy(F.xxhash64("page_id"), "page_id").limit(max_pages))
    sample = pages.join(F.broadcast(picked), "page_id").where(F.length("html") <= MAX_TRAIN_HTML).select("html").distinct()
    rows = sample.mapInArrow(_training_rows, "x binary, y int").collect()
    if not rows:
        return None
    x = np.frombuffer(b"".join(r["x"] for r in rows), np.float32).reshape(len(rows), len(NAMES)).astype(float)
    y = np.array([r["y"] for r in rows], float)
    if y.min() == y.max():
        return None
    # order of collected rows must not matter
    order = np.lexsort((*x.T, y))
    return boosting.fit(x[order], y[order])


def main_text(pages: DataFrame, max_train_pages: int = MAX_TRAIN_PAGES) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    shared = rows.sparkSession.sparkContext.broadcast(fit(rows, max_train_pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tv.pieces(batches, "html", 1 << 20):
            texts = extract(tv.column(part, "html").to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays(
                [tv.column(part, "page_id"), tv.column(part, "url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
