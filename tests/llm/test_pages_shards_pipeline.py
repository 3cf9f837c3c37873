import itertools
import random

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from staffline.llm import boosting
from staffline.llm import op8_html_extraction as op8
from staffline.llm import op3_decontamination as op3
from staffline.llm import op4_jaccard_join as op4
from staffline.llm import op9_sharding as op9
from staffline.llm.dom import Page
from staffline.llm.queries import ORACLE_SQL, QUERIES

from .helpers import awkward, empty, labels_for, plain, words, write


# ------------------------------------------------------------------- op 8

def fitted(n=200):
    htmls = pd.read_parquet("/root/testdata/sf0.01/pages.parquet")["html"][:n]
    rows = [r for h in htmls for r in op8.training_rows(h)]
    return boosting.fit(np.concatenate([x for x, _ in rows]).astype(float), np.concatenate([y for _, y in rows]).astype(float))


@pytest.fixture(scope="module")
def model():
    return fitted()


def test_main_text_of_held_out_pages(model):
    htmls = pd.read_parquet("/root/testdata/sf0.01/pages.parquet")["html"][200:]
    right = 0
    for html in htmls:
        features = op8.Features(html)
        inside = [tag == "article" for tag in features.page.tag]
        for i in range(1, len(inside)):
            inside[i] = inside[i] or inside[features.parent[i]]
        right += op8.extract([html], model)[0] == op8.text_of(features.page, inside)
    assert right / len(htmls) > 0.97


TEXT = "Lorem ipsum dolor sit amet, consectetur adipiscing elit. Sed do eiusmod tempor incididunt ut labore, et dolore magna. "


def test_main_text_of_other_layouts(model):
    page = (f"<body><div class='masthead'><a href=/>Home</a></div><div class='cookie-notice'>We use cookies.</div><div id=content>"
            f"<h1>A title</h1><p>{TEXT}<p>{TEXT} &amp; more<br>lines</div><aside><ul><li><a href=1>Related</a></ul></aside>"
            f"<div class=comments><p>{TEXT}</p></div><form><label>Name</label></form><footer>&copy; 2024</footer>")
    once = TEXT.strip()
    assert op8.extract([page], model)[0] == f"A title {once} {once} & more lines"


def test_formulas_and_fallback_texts_stay(model):
    once = TEXT.strip()
    page = (f"<head><noscript>Head only</noscript></head><body><nav><a href=/>Home</a></nav><article><h1>A title</h1>"
            f"<p>{TEXT}Then <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>x=2 again</annotation></semantics></math> holds.</p>"
            f"<object data=a.pdf><p>{TEXT}</p></object><noscript><p>{TEXT}</p></noscript><p>{TEXT}<button>Send</button>"
            f"<template><p>Inert <template>too</template> and this</p></template></article>")
    assert op8.extract([page], model)[0] == f"A title {once} Then x=2 holds. {once} {once} {once}"
    page = Page("<p>a<noscript><b>b</b></noscript><svg><text>c</text></svg><xmp>d<i>&amp;</xmp>")
    assert [text for _, text, _ in page.runs] == ["a", "b", "c", "d<i>&amp;"]


def test_page_edges(spark, model):
    assert op8.extract([None, "", "<p>", "<!-- x -->", "<script>a<b</script><style>p</style>", "a < b & c"], model)[:5] == [""] * 5
    rows = [(1, "u", "<article><p>One  two</p><p>three</article>", 9), (1, "u", "<article><p>One  two</p><p>three</article>", 9),
            (2, None, None, 9), (None, "v", "<b>x", 9), (4, "w", "<div>" * 3000 + TEXT, 9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars long")
    got = op8.main_text(pages).collect()
    assert len(got) == 5 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert [r["text"] for r in got if r["page_id"] == 1] == ["One two three"] * 2
    assert op8.main_text(pages.where("page_id > 10")).count() == 0


def test_deep_and_unmatched_markup_takes_linear_time():
    import time

    start = time.perf_counter()
    for html in ("<div>" * 100_000 + "x", "<div>" * 50_000 + "</x>" * 50_000, "<p><table>" + "<div>" * 50_000, "<li>" * 50_000):
        op8.Features(html)
    assert time.perf_counter() - start < 40


@pytest.mark.parametrize(("inside", "kept"), [
    ("<div class='header'><h1>My big title</h1></div>", True), ("<header class='article-header'><h1>My big title</h1></header>", True),
    ("<section id='related-work'><h2>Related work</h2><p>Earlier work did this, and more of that, for years.</p></section>", True),
    ("<div class='binary-search'><p>The search halves the range, step by step, until it ends.</p></div>", True),
    ("<div class='comments'><p>I liked this one, thanks for the long read and so on.</p></div>", False),
    ("<aside><p>Read our newsletter, every day, for nothing at all.</p></aside>", False)])
def test_article_parts_stay_and_containers_go(model, inside, kept):
    body = "<p>The quick brown fox jumps over the lazy dog, and the story goes on for a while with many words in it.</p>"
    page = ("<html><body><nav><ul><li><a href=a>Home</a></li><li><a href=b>About</a></li></ul></nav><article>"
            f"<h1>Top</h1>{body}{inside}{body}</article><footer>&copy; x</footer></body></html>")
    text, = op8.extract([page], model)
    words_in = " ".join(op8.text_of(p := op8.Page(inside), [True] * len(p.tag)).split())
    assert (words_in in text) == kept and text.count("lazy dog") == 2


def test_dom_repairs():
    page = Page("<ul><li>a<li>b</ul><p>c<div>d</div><p>e<b>f<p>g</b><table><tr><td>1<td>2<tr><td>3</table>")
    shape = [(page.tag[e], t) for e, t, _ in page.runs]
    assert shape == [("li", "a"), ("li", "b"), ("p", "c"), ("div", "d"), ("p", "e"), ("b", "f"), ("p", "g"), ("td", "1"), ("td", "2"),
                     ("td", "3")]


def test_decoding_is_the_best_consistent_choice():
    """Against all choices keep / drop / by parts of a small tree."""
    rng = random.Random(0)
    for _ in range(60):
        features = op8.Features("<div>aa<p>bbbb</p><p>c<b>dddd</b></p></div><div>eee</div>")
        n = len(features.parent)
        logit = np.array([rng.uniform(-3, 3) for _ in range(n)])
        keep = op8.keep_elements(features, logit)
        own = logit * np.sqrt(features.own)

        def score(states):
            total, kept = 0.0, []
            for i, s in enumerate(states):
                above = states[features.parent[i]] if i else 0
                if above and s != above:
                    return None
                # an element that leaves the choice to its parts costs a half
                total += s * (own[i] + logit[i]) if s else abs(own[i]) - 0.5
                kept.append(s > 0 or (s == 0 and own[i] > 0))
            return total, kept

        found = [x for x in map(score, itertools.product((-1, 0, 1), repeat=n)) if x]
        best = max(x[0] for x in found)
        assert keep in [k for v, k in found if v > best - 1e-9]


def test_boosting_learns_and_is_deterministic():
    rng = np.random.RandomState(0)
    x = rng.rand(800, 4)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    a, b = boosting.fit(x, y, trees=30, depth=3), boosting.fit(x, y, trees=30, depth=3)
    assert ((a.logit(x) > 0) == y).mean() > 0.97
    assert (a.logit(x) == b.logit(x)).all()


# ------------------------------------------------------------------- op 9

def laws(rows, n):
    shards = {}
    for r in rows:
        shards.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(shards.get(k, [])) for k in range(n)]
    assert sum(sizes) == len(rows) and set(shards) <= set(range(n))
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())


def test_shards_are_even_and_keep_copies_together(spark):
    rng = random.Random(2)
    copies = [words(rng, 8) for _ in range(30)]
    texts = [words(rng, 10) for _ in range(300)] + [c for k, c in enumerate(copies) for _ in range(2 + k % 4)] + ["hot text"] * 200
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = op9.shard_documents(docs, 16).collect()
    laws(rows, 16)
    where = {}
    for r in rows:
        where.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
    assert sum(len(where[c]) > 1 for c in copies) <= 3
    assert len(where["hot text"]) <= 8
    assert all(r["law"] == "rows" and r["grown_shard"] is None for r in rows)


def test_propagation_follows_links_within_quotas(spark):
    links = [(10 * g + k, 10 * g + k + 1) for g in range(12) for k in range(7)]
    places, counts = op9.propagate(spark.createDataFrame(links, "a long, b long"), op9.quotas_for(96, 4), rounds=3)
    rows = {r["row"]: r["shard"] for r in places.collect()}
    assert len(rows) == 96 and counts == [24] * 4
    cut = sum(rows[a] != rows[b] for a, b in links)
    assert cut < len(links) / 2


def test_shard_edges(spark):
    docs = awkward(spark)
    rows = op9.shard_documents(docs).collect()
    laws(rows, 16)
    assert len(rows) == docs.count()
    sizes = sorted(r["size"] for r in rows)
    assert sizes == sorted(len((t or "").encode()) + 1 for _, t in plain(docs))
    assert op9.shard_documents(empty(spark)).count() == 0
    # null and empty texts are equal texts, so a group like any other
    texts = [None, ""] * 8 + [f"text {i}" for i in range(400)]
    blank = op9.shard_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len({r["shard"] for r in blank if r["size"] == 1}) <= 2
    laws(op9.shard_documents(docs.limit(3)).collect(), 16)


# --------------------------------------------------------------- pipeline

def test_short_items_match_whole_words_and_reject_nothing(spark):
    docs = spark.createDataFrame([(1, "there was yesterday"), (2, "Yes. It is a cat"), (3, "the long passage of the benchmark stands here")],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(1, "A"), (2, "Yes."), (3, "long passage of the benchmark stands")], "item_id long, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in op3.contaminated(docs, items).collect()) == [(2, 1), (2, 2), (3, 3)]
    assert sorted(r["doc_id"] for r in op3.drop_contaminated(docs, items).collect()) == [1, 2]


def test_pipeline_against_planted_cases(spark, tmp_path):
    rng = random.Random(11)
    en = ("the", "and", "of", "tion", "ing", "er")
    fr = ("eau", "que", "les", "oi", "é", "ment")
    rows, marks = [], []
    for i in range(400):
        toxic = i % 6 == 1
        lang = "en" if i % 3 else "fr"
        text = words(rng, 40, en if lang == "en" else fr).split()
        for _ in range(3 * toxic):
            text.insert(rng.randrange(len(text)), rng.choice(["idiot", "moron", "scum"]))
        rows.append((i, " ".join(text), lang, "s", 0))
        marks.append((i, 1, int(toxic)))
    item = words(rng, 25, en)
    clean = [r for r in rows if r[0] % 6 != 1]
    planted = [(1000, clean[3][1], "en", "s", 0), (1001, clean[5][1] + " extra words", "en", "s", 0),
               (1002, "!!! 123 ???", "en", "s", 0), (1003, words(rng, 30, en) + " " + item.upper() + " " + words(rng, 10, en), "en", "s", 0),
               (1004, words(rng, 30, en) + " 1d10t m0r0n", "en", "s", 0), (1005, None, "en", "s", 0)]
    path = str(tmp_path)
    write(spark.createDataFrame(rows + planted, "doc_id long, text string, lang string, source string, n_chars long"), path, "documents")
    write(labels_for(spark, marks), path, "labels")
    write(spark.createDataFrame([(1, item)], "item_id long, text string"), path, "benchmark")
    got = corpus_pipeline.run(spark, path).collect()
    texts = {r[0]: r[1] for r in rows + planted}
    kept = {r["doc_id"] for r in got}
    assert not kept & {1000, 1001, 1002, 1003, 1004, 1005}
    want = {r[0] for r in clean}
    assert len(kept & want) / len(want) > 0.98
    assert len(kept - want) <= 0.02 * len(rows)
    assert all(r["text"] == texts[r["doc_id"]] and r["n_tokens"] == len(r["ids"]) for r in got)


def test_near_duplicates_keep_one_row_of_each_component(spark):
    rng = random.Random(31)
    a, b = words(rng, 40), words(rng, 40)
    rows = [(3, a, "x"), (3, a, "y"), (None, a, "z"), (5, b, "x"), (None, b, "y"), (4, b + " end", "x"), (None, None, "n"), (None, None, "m"),
            (7, "", "e"), (7, "other words that stand alone in here", "o")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    left = sorted(((r["doc_id"], r["text"]) for r in op4.drop_near_duplicates(docs).collect()), key=repr)
    assert left == sorted([(3, a), (4, b + " end"), (None, None), (None, None), (7, ""), (7, rows[-1][1])], key=repr)


def test_pipeline_on_an_empty_table(spark, tmp_path):
    path = str(tmp_path)
    write(spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long"), path, "documents")
    write(labels_for(spark, []), path, "labels")
    write(spark.createDataFrame([], "item_id long, text string"), path, "benchmark")
    assert corpus_pipeline.run(spark, path).count() == 0


def test_stages_name_the_dealt_operators():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near_duplicates", "decontamination", "encoding"]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_oracle(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name_ in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name_} AS SELECT * FROM '/root/testdata/sf0.001/{name_}.parquet'")
    want = con.sql(ORACLE_SQL[name]).df()
    got = QUERIES[name](spark, "/root/testdata/sf0.001").toPandas()[list(want.columns)]
    order = list(want.columns[:2])
    want, got = (x.sort_values(order).reset_index(drop=True) for x in (want, got))
    pd.testing.assert_frame_equal(got, want, check_dtype=False)
