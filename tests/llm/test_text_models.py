import collections
import math
import random
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from staffline.llm import op2_language_id as op2
from staffline.llm import op5_token_counts as op5
from staffline.llm import op6_suffix_tree_lm as op6
from staffline.llm import op7_sentencepiece as op7
from staffline.llm import op10_toxicity as op10
from staffline.llm.common import table

from .helpers import awkward, empty, labels_for, plain, words

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------- op 2

def test_language_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    want = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = op2.identify(docs).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(want) and held
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang_pred"] == want[r["doc_id"]] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def grams(text):
    """Hashed grams of one text, one by one."""
    s = [ord(c) if c.isalpha() else 32 for c in f" {text.lower()} "]
    out = []
    for n in op2.ORDERS:
        for i in range(len(s) - n + 1):
            g = s[i:i + n]
            if (n == 1 and g[0] == 32) or any(a == b == 32 for a, b in zip(g[:-1], g[1:], strict=True)):
                continue
            v = 0
            for c in g:
                v = (v * 0x100000001B3 + c) % 2**64
            out.append((((v + n) * 0x9E3779B97F4A7C15) % 2**64 >> 48) % op2.BUCKETS)
    return out


def test_language_equals_plain_naive_bayes(spark):
    rows = [(1, "The cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, "and then", "en"), (4, "été là", "fr"),
            (5, "x", None), (6, None, "en"), (7, "", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = op2.fit(op2.training_texts(docs))
    counts = {lang: collections.Counter(g for _, t, l in rows if l == lang and t for g in grams(t)) for lang in ("en", "fr")}
    seen = {lang: sum(1 for _, t, l in rows if l == lang and t is not None) for lang in ("en", "fr")}
    probes = ["the cheval", "chat noir et blanc", "12 !!", "", None, "Été the 7 dogs"]
    langs, scores = op2.score_texts(probes, model)
    for text, lang, score in zip(probes, langs, scores, strict=True):
        if not any(c.isalpha() for c in text or ""):
            assert (lang, score) == ("und", 0)
            continue
        total = {k: math.log((seen[k] + 1) / (sum(seen.values()) + 2)) + sum(
            math.log((counts[k][g] + 0.1) / (sum(counts[k].values()) + 0.1 * op2.BUCKETS)) for g in grams(text)) for k in counts}
        best = max(total, key=total.get)
        assert lang == best
        assert score == pytest.approx(1 / sum(math.exp(v - total[best]) for v in total.values()), rel=1e-4)


def test_language_edges(spark):
    docs = awkward(spark)
    got = op2.identify(docs).collect()
    assert len(got) == docs.count()
    texts = plain(docs)
    blank = {i for i, t in texts if not any(c.isalpha() for c in t or "")}
    assert {r["doc_id"] for r in got if r["lang_pred"] == "und"} == blank
    assert op2.identify(empty(spark)).count() == 0
    assert {r["lang_pred"] for r in op2.identify(docs.withColumn("lang", docs.lang.substr(9, 1))).collect()} == {"", "und"}
    untaught = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in op2.identify(untaught).collect()} == {"und"}
    kept = op2.drop_unknown(docs)
    assert kept.columns == docs.columns and not {r["doc_id"] for r in kept.collect()} & blank


# ------------------------------------------------------------- ops 5 and 7

@pytest.fixture(scope="module")
def encoder():
    return op7.Encoder(*op7.model_of(op7.MODEL_PATH))


def samples():
    rng = random.Random(8)
    return ["", " ", "  a  b\n c ", "▁▁ a ▁b", "日本語 テスト 😀\t\x00 é", "a" * 300, " " * 50, "line\n\nline", words(rng, 200),
            "<0x41> <s> </s>", "naïve café — “quote”", "".join(chr(rng.randint(32, 0x2FFF)) for _ in range(200))]


def test_encoding_round_trip_and_batches(encoder):
    surfaces = encoder_surfaces()
    for text, coded in zip(samples(), encoder.texts(samples()), strict=True):
        ids = np.frombuffer(coded, "<i4")
        assert op7.decode_ids(ids, surfaces) == text
        assert ids.tolist() == [i for c in (op7.cut(text) if text else []) for i in encoder.pieces(c)]


def encoder_surfaces():
    return op7.Vocabulary.load().surfaces()


def test_encoding_is_the_best_path_of_the_library(encoder):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    vocabulary = op7.Vocabulary.load()
    score = {i: s for i, _, s in vocabulary.pieces}
    model = pb.ModelProto()
    with open(op7.MODEL_PATH, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    for i, p in enumerate(model.pieces):
        p.score = score.get(i, p.score)
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    rng = random.Random(1)
    for text in [words(rng, 80) for _ in range(20)] + ["été où ça", "Hello, World! 123"]:
        ours, theirs = np.frombuffer(encoder.texts([text])[0], "<i4").tolist(), library.encode(text)
        assert sum(score.get(i, 0) for i in ours) == pytest.approx(sum(score.get(i, 0) for i in theirs), abs=1e-3)


def test_double_array_holds_exactly_its_keys():
    keys = sorted({bytes(random.Random(k).choices(range(1, 255), k=1 + k % 4)) for k in range(500)})
    trie = op7.DoubleArray(keys)

    def get(key):
        node = 0
        for b in key:
            to = trie.base[node] + b + 1
            if to >= len(trie.check) or trie.check[to] != node:
                return -1
            node = to
        return trie.value[node]

    assert [get(k) for k in keys] == list(range(len(keys)))
    assert get(b"\x00nothing") == -1 and get(b"") == -1


def test_token_counts_equal_encoding(spark, encoder):
    scores = op5.Scores(op7.Vocabulary.load())
    for text, (_, n) in zip(samples(), op5.count_texts(samples(), scores, {}), strict=True):
        assert n == len(encoder.texts([text])[0]) // 4
    docs = awkward(spark)
    counts = sorted((str(r["doc_id"]), r["n_tokens"]) for r in op5.token_counts(docs).collect())
    trips = op7.round_trip(docs).collect()
    assert counts == sorted((str(r["doc_id"]), r["n_tokens"]) for r in trips)
    assert all(r["round_trip"] for r in trips)
    assert op5.token_counts(empty(spark)).count() == 0 and op7.round_trip(empty(spark)).count() == 0
    coded = op7.encode(docs)
    clash = docs.withColumnRenamed("lang", "decoded")
    both = op7.encode_decode(clash)
    assert both.columns.count("ids") == both.columns.count("decoded") == 1
    assert sorted(map(repr, both.select("doc_id", "text", "ids", "decoded").collect())) == sorted(
        map(repr, op7.decode(op7.encode(clash)).select("doc_id", "text", "ids", "decoded").collect()))
    assert coded.columns == [*(c for c in docs.columns if c != "ids"), "ids"]


def test_trie_shares_prefixes():
    trie = op5.Trie(["abc", "abd", "ab", "x", ""])
    assert len(trie.children) == 6
    assert set(trie.terminal.values()) == {"abc", "abd", "ab", "x", ""}


# ------------------------------------------------------------------- op 6

def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def brute_tree(rows, depth, min_share, min_next, min_divergence):
    """The same model with dictionaries: (score of a token list, n, v, counts)."""
    train = [tokens(t) for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    count = collections.Counter(w for t in train for w in t)
    n, v = sum(count.values()), len(count)
    least = min_share * n
    strings = collections.Counter()
    for t in train:
        seq = ["<start>", *t]
        for d in range(1, depth + 1):
            for k in range(d, len(seq)):
                strings[tuple(seq[k - d:k]), seq[k]] += 1
    contexts = collections.Counter()
    for (c, _), m in strings.items():
        contexts[c] += m
    states = {}

    def prob(history, w):
        for d in range(min(depth, len(history)), 0, -1):
            c = tuple(history[-d:])
            if c in states:
                entries, rest = states[c]
                return entries[w] if w in entries else rest * prob(history[-(d - 1):] if d > 1 else [], w)
        return (count[w] + 1) / (n + v + 1)

    for d in range(1, depth + 1):
        new = {}
        for c, m in contexts.items():
            if len(c) != d or None in c or m < max(least, 1) or (d > 1 and m < 2):
                continue
            got = {w: k for (c2, w), k in strings.items() if c2 == c and k >= min_next * m and k >= 2}
            if not got:
                continue
            p = {w: k / m for w, k in got.items()}
            q = {w: prob(list(c[1:]), w) for w in got}
            rest_p, rest_q = max(1 - sum(p.values()), 0), max(1 - sum(q.values()), 1e-12)
            gain = sum(p[w] * math.log(p[w] / q[w]) for w in got)
            if rest_p > 1e-12:
                gain += rest_p * math.log(rest_p / rest_q)
            e = len(got)
            if gain >= min_divergence and 2 * m * gain >= e + 3 * math.sqrt(2 * e) + 6:
                cut = {w: (k - 0.5) / m for w, k in got.items()}
                new[c] = (cut, (1 - sum(cut.values())) / rest_q)
        states.update(new)
    return prob, n, v, count, states


def test_suffix_tree_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["p m n s", "q m n t", words(rng, 2)]) for _ in range(20))) for i in range(60)]
    rows += [(100, None), (101, ""), (None, "the of")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    settings = dict(depth=3, min_share=2e-3, min_next=0.02, min_divergence=0.01)
    prob, n, v, count, states = brute_tree(rows, **settings)
    assert any(len(c) == 3 for c in states) and any(len(c) == 1 for c in states)
    got = {r["doc_id"]: r for r in op6.score_documents(docs, **settings).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        t = tokens(text)
        r = got[i]
        assert (r["n_tokens"], r["train_tokens"], r["n_known"]) == (len(t), n, sum(count[w] > 0 for w in t))
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t), rel=1e-9)
        seq = ["<start>", *t]
        assert r["score"] == pytest.approx(sum(math.log10(prob(seq[max(0, k - 3):k], seq[k])) for k in range(1, len(seq))), rel=1e-9)
    for c in list(states)[:5]:
        assert sum(prob(list(c), w) for w in count) + prob(list(c), "never seen") == pytest.approx(1, rel=1e-9)


def check_production_scores(spark, rows, min_next):
    """Scores with the production settings against the brute-force tree; returns its states."""
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    n = sum(len(tokens(t)) for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2)
    prob, _, _, _, states = brute_tree(rows, 3, 2 / n, min_next, 0.01)
    got = {r["doc_id"]: r["score"] for r in op6.score_documents(docs).collect()}
    for i, text in rows:
        seq = ["<start>", *tokens(text)]
        want = sum(math.log10(prob(seq[max(0, k - 3):k], seq[k])) for k in range(1, len(seq)))
        assert got[i] == pytest.approx(want, rel=1e-9)
    return states


def test_suffix_tree_keeps_rare_contexts_of_a_large_corpus(spark):
    """Contexts seen four or five times among 200,000 tokens."""
    states = check_production_scores(spark, [(i, "a " * 1200 + f"c{i % 40} d{i % 40}") for i in range(200)], 0)
    assert sum(c[0].startswith("c") for c in states) == 40


def test_suffix_tree_keeps_wide_contexts(spark):
    """Next words far below one hundredth of their context, seen more than once."""
    rng = random.Random(7)
    rows = [(i, " ".join(f"wide n{rng.randrange(150)}" if rng.random() < 0.5 else f"c{rng.randrange(300)}" for _ in range(80)))
            for i in range(70)]
    assert len(check_production_scores(spark, rows, 0)[("wide",)][0]) > 100


def test_language_model_edges(spark):
    assert op6.score_documents(empty(spark)).count() == 0
    docs = awkward(spark)
    got = op6.score_documents(docs)
    assert got.count() == docs.count() and got.columns == op6.SCORE_COLUMNS
    untaught = spark.createDataFrame([(k, "some text") for k in range(200) if zlib.crc32(str(k).encode()) % 7 == 2],
                                     "doc_id long, text string")
    assert {(r["train_tokens"], r["n_known"], r["score"]) for r in op6.score_documents(untaught).collect()} == {(0, 0, 0.0)}


def test_squeeze_round_trip():
    for dtype in ("<u4", "<i8"):
        x = np.arange(1000).astype(dtype) * 77
        assert (op6.expand(op6.squeeze(x), dtype) == x).all()
    assert len(op6.expand(op6.squeeze(np.zeros(0, "<u4")), "<u4")) == 0


# ------------------------------------------------------------------ op 10

def char_model(text):
    grams = collections.Counter()
    for n in range(1, 5):
        grams.update(text[i:i + n] for i in range(len(text) - n + 1))
    return op10.CharModel(dict(grams))


def test_restoring():
    model = char_model("you are an idiot and a moron loser trash stupid clown scum the and of to is that " * 20)
    hidden = {"1d10t": "idiot", "m0r0n": "moron", "$tup!d": "stupid", "tr@sh": "trash", "i d i o t": "idiot", "i.d.i.o.t": "idiot",
              "idiooooot": "idiot", "l-o-s-e-r": "loser", "$cum": "scum"}
    assert {k: op10.restore(k, model) for k in hidden} == hidden


def test_restore_is_the_cheapest_path():
    model = char_model("aab abba baab " * 5)
    for span in ("4aaa8", "a.b.a", "aaab88", "8 a 4 b"):
        edges = op10.lattice(span)

        def paths(i, out, cost, context):
            if i == len(span):
                yield cost + model.cost(context, " "), out
                return
            for text, channel, to in edges[i]:
                total, last = cost + channel, context
                for c in text:
                    total += model.cost(last, c)
                    last = (last + c)[-3:]
                yield from paths(to, out + text, total, last)

        best = min(paths(0, "", 0.0, " "))
        restored = op10.restore(span, model)
        assert best[0] == pytest.approx(min(c for c, o in paths(0, "", 0.0, " ") if o == restored))


def test_long_runs_take_linear_time():
    import time

    model = char_model("aab abba baab " * 5)
    start = time.perf_counter()
    assert len(op10.restore("a" * 300_000, model)) in (1, 2)
    assert time.perf_counter() - start < 30


def test_character_counts_cover_all_texts(spark):
    """The character model counts every document, labelled or not, as a plain count does."""
    docs = awkward(spark)
    got = op10.CharModel(op10.count_grams(docs))
    text = ["".join(c if c.isalpha() and ord(c) < 65536 else " " for c in (r["text"] or "").lower()) for r in docs.collect()]
    for gram in ("t", "th", "the", "tion", "ü", "xxxx", "zq"):
        want = sum(t[i:i + len(gram)] == gram for t in text for i in range(len(t)))
        assert got.count(gram) == (want if want >= op10.LEAST_COUNT else 0), gram


def test_suspicious_spans():
    batch = pa.RecordBatch.from_pydict({"text": ["hello i d i o t there 1d10t", "", "a b", "x", None, "m.o.r.o.n ok", "a", "b", "c", "d"]})
    found = op10.suspicious(op10.tv.words_of(batch))
    data = op10.tv.words_of(batch).low
    assert sorted((data[a:b].tobytes(), int(t)) for a, b, t in found) == [(b"1d10t", 0), (b"i d i o t", 0), (b"m.o.r.o.n", 5)]


def test_toxicity_held_out(spark):
    rng = random.Random(6)
    bad = ["idiot", "moron", "scum", "loser"]
    rows, marks = [], []
    for i in range(600):
        toxic = i % 5 == 1 or i % 7 == 3
        text = words(rng, 30).split()
        for _ in range(2 * toxic):
            text.insert(rng.randrange(len(text)), rng.choice(bad))
        rows.append((i, " ".join(text)))
        marks.append((i, 1, int(toxic)))
    rows += [(1000, words(rng, 20) + " you 1d10t and m0r0n"), (1001, "total i d i o t l.o.s.e.r " + words(rng, 10)), (1002, None), (1003, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = labels_for(spark, [*marks, (2, 0, None), (None, 1, 1)])
    got = {r["doc_id"]: r for r in op10.score_documents(docs, labels).collect()}
    assert len(got) == len(rows)
    held = [(got[i]["predicted"], t) for i, _, t in marks if got[i]["held_out"]]
    assert len(held) > 50 and sum(p == t for p, t in held) / len(held) > 0.95
    assert got[1000]["predicted"] == got[1001]["predicted"] == 1
    assert got[1002]["score"] == got[1003]["score"] < 0.5
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    kept = {r["doc_id"] for r in op10.drop_toxic(docs, labels).collect()}
    assert 1000 not in kept and 1002 in kept


def test_toxicity_edges(spark):
    docs = awkward(spark)
    none = labels_for(spark, [])
    got = op10.score_documents(docs, none).collect()
    assert len(got) == docs.count() and {r["score"] for r in got} == {0.0}
    assert op10.score_documents(empty(spark), none).count() == 0
    assert op10.drop_toxic(docs, none).columns == docs.columns


def test_chunks_gather_batches(monkeypatch):
    monkeypatch.setattr(op6, "CHUNK_BYTES", 100)
    texts = ["x" * 10, None, "y" * 30, "", "z" * 250, *["w" * 20] * 12]
    batches = [pa.RecordBatch.from_pydict({"doc_id": [i], "text": pa.array([t], pa.string())}) for i, t in enumerate(texts)]
    got = [b.to_pydict() for b in op6.gathered(iter(batches))]
    assert [i for b in got for i in b["doc_id"]] == list(range(len(texts))) and [t for b in got for t in b["text"]] == texts
    # one batch a row came in; runs hold as many rows as fit
    assert [sum(len(t or "") for t in b["text"]) for b in got] == [40, 250, 100, 100, 40]


def test_chunks_are_not_shuffled_again(spark):
    rows = spark.range(40).select(F.col("id").alias("chunk"), F.array("id").alias("doc_ids"))
    kept = op6.in_buckets(rows, "op6-test", "chunk", 4)
    other = spark.range(40).select(F.col("id").alias("chunk"))
    both = kept.groupBy("chunk").cogroup(other.groupBy("chunk")).applyInPandas(
        lambda a, b: pd.DataFrame({"n": [len(a) + 10 * len(b)], "s": [sum(x[0] for x in a["doc_ids"])]}), "n long, s long")
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert both.agg(F.sum("n"), F.sum("s"), F.count("*")).first()[:] == (440, 780, 40)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("op6_test")]


@pytest.mark.parametrize("n", [0, 1, 2, 5000])
def test_grouped_keys_equal_unique(n):
    """Repeated keys, and keys that differ in the lowest bits alone, which give way to positions while sorting."""
    rng = np.random.RandomState(n)
    keys = rng.randint(0, 2**62, max(n // 20, 1)).astype(np.uint64)[rng.randint(0, max(n // 20, 1), n)]
    keys[n // 2:] ^= rng.randint(0, 3, n - n // 2).astype(np.uint64)
    want = np.unique(keys, return_index=True, return_inverse=True)
    for got, expected in zip(op6.grouped(keys), want, strict=True):
        assert (got == expected).all() and len(got) == len(expected)


def test_first_answers_are_read_beside_the_chunks(spark):
    docs = spark.createDataFrame([(k, "a b c a b c d " * (k + 1)) for k in range(12)], "doc_id long, text string")
    scored = op6.score_documents(docs)
    lines = scored._jdf.queryExecution().executedPlan().toString().splitlines()
    # one exchange, of the last passes' answers; the tables beside the chunks and the chunks need none
    assert sum("Exchange hashpartitioning" in x for x in lines) == 1
    assert sum("op6_answers_" in x for x in lines) == op6.DEPTH
    assert op6.score_documents(docs, depth=0).count() == 12


def test_words_are_hashed_a_few_texts_at_a_time(monkeypatch):
    texts = ["One two  two", None, "", "x" * 300 + " y", "two Three"]
    part = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    whole = op6.tv.words_of(part)
    sizes, real = [], op6.tv.words_of
    monkeypatch.setattr(op6, "HASH_BYTES", 16)
    monkeypatch.setattr(op6.tv, "words_of", lambda x: sizes.append(x.num_rows) or real(x))
    hashes, counts = op6.word_hashes(part)
    assert (hashes == whole.hashes).all() and (counts == whole.counts()).all()
    assert len(sizes) > 1 and sum(sizes) == len(texts)
