import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest

from staffline.llm import op11_phrase_collocations as op11
from staffline.llm import op12_importance_resampling as op12
from staffline.llm import op13_quality_classifier as op13
from staffline.llm.common import table

from .helpers import awkward, empty, labels_for, words

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ------------------------------------------------------------------ op 11

def pieces(text):
    out, word, piece = [], "", []
    for c in (text or "").translate(LOWER) + "\n":
        end = c in ".,;:!?\n\x0b\x0c\r"
        if end or c in " \t":
            if word:
                piece.append(word)
            word = ""
            if end:
                out.append(piece)
                piece = []
        else:
            word += c
    return out


def plain_collocations(rows, max_words=3, support=10, top=2000, percent=50):
    counts, total = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for p in pieces(text):
            total[lang] += len(p)
            for m in range(1, max_words + 1):
                for i in range(len(p) - m + 1):
                    counts[lang, tuple(p[i:i + m])] += 1
    kept = {k: f for k, f in counts.items() if len(k[1]) > 1 and f >= support}
    inside = collections.defaultdict(int)
    for (lang, w), f in kept.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                inside[lang, w[i:i + m]] = max(inside[lang, w[i:i + m]], f)
    found = collections.defaultdict(list)
    for (lang, w), a in kept.items():
        if 100 * inside[lang, w] >= percent * a:
            continue
        cuts = [(1_000_000 * a * a // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        found[lang].append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
    return sorted((lang, n + 1, p.decode(), -a, lo, r, total[lang], -s)
                  for lang, all_ in found.items() for n, (s, a, p, lo, r) in enumerate(sorted(all_)[:top]))


def collocation_rows(frame):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in frame.collect())


def phrase_docs(spark):
    rng = random.Random(11)
    rows = [(("en", "de", None)[i % 3], words(rng, 200, ("a", "b", "c", "é", "ou")) + ". New York City, New  York\tCity! new york") for i in range(40)]
    rows += [("en", None), ("en", ""), (None, " \t ;;"), ("fr", "X" * 5000), ("", "a b a b a b a b a b a b a b a b a b a b a b"), rows[0], rows[0]]
    return rows, spark.createDataFrame([(t, g, 7, "x") for g, t in rows], "text string, lang string, n long, phrase string")


@pytest.mark.parametrize("settings", [{}, {"support": 3, "top": 25}, {"support": 12, "max_words": 4, "shards": 2, "contained_percent": 80}])
def test_collocations_equal_plain_counting(spark, settings):
    rows, docs = phrase_docs(spark)
    want = plain_collocations(rows, settings.get("max_words", 3), settings.get("support", 10), settings.get("top", 2000),
                              settings.get("contained_percent", 50))
    assert want
    assert collocation_rows(op11.collocations(docs.repartition(5), **settings)) == want


def test_collocations_edges(spark):
    assert op11.collocations(empty(spark)).count() == 0
    got = collocation_rows(op11.collocations(awkward(spark), support=2))
    rows = [(r["lang"], r["text"]) for r in awkward(spark).select("lang", "text").collect()]
    assert got == plain_collocations(rows, support=2)


def test_phrase_runs_survive_packing():
    keys = np.unique(np.random.RandomState(1).randint(0, 2**48 - 1, 1000).astype(np.uint64))
    counts = np.arange(len(keys)) % 400 + 1
    got, some = op11.unpack(op11.pack(keys, counts))
    assert (got == keys).all() and (some == np.minimum(counts, 255)).all()


def test_local_support_keeps_every_frequent_phrase(spark):
    """Whatever the deal of the rows, mining misses nothing (pigeonhole over the shards)."""
    rows = [("en", "x y z")] * 4 + [("en", "x y")] * 3 + [("en", "q")] * 20 + [("en", "x y z x y z x y z")]
    want = plain_collocations(rows)
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        docs = spark.createDataFrame([(t, g) for g, t in rows], "text string, lang string").repartition(3 + seed)
        assert collocation_rows(op11.collocations(docs)) == want


def phrase_batches(n=30):
    rng = random.Random(21)
    rows = [(words(rng, 120, ("a", "b", "é", "ou")) + (". " if i % 2 else "  \t") + "New  York", ("en", "de")[i % 2]) for i in range(n)]
    rows += [("ab", "en"), ("cd", "en"), ("", "en"), (";", "fr")]
    return rows, [pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows[i:i + 4], strict=True)], ["text", "lang"]) for i in range(0, len(rows), 4)]


def plain_counts(rows, max_words=3):
    counts = collections.Counter()
    for text, lang in rows:
        counts[lang, ""] += 0
        for p in pieces(text):
            counts[lang, ""] += len(p)
            counts.update((lang, " ".join(p[i:i + m])) for m in range(1, max_words + 1) for i in range(len(p) - m + 1))
    return counts


def every(hashes):
    return np.arange(len(hashes))


@pytest.mark.parametrize(("run", "chunk", "held"), [(1 << 21, 6 << 20, 24 << 20), (1, 1, 1 << 20), (300, 700, 2000)])
def test_counted_phrases_leave_a_task_packed(monkeypatch, run, chunk, held):
    """A task sends a few packed runs, not a row for each phrase of each run of texts."""
    for name, value in (("RUN_BYTES", run), ("CHUNK_BYTES", chunk), ("HELD_BYTES", held), ("SENT_RUNS", 3)):
        monkeypatch.setattr(op11, name, value)
    rows, batches = phrase_batches()
    want = plain_counts(rows)
    sent = pa.Table.from_batches(list(op11.counted(iter(batches), every, 2, 3)))
    flushes = sum(len(t.encode()) for t, _ in rows) // held + 1
    assert sent.num_rows <= flushes * (4 * 2 + 3) < len(want)
    got = {}
    for bucket in set(sent["bucket"].to_pylist()):
        group = op11._total(1)(sent.filter(pa.compute.equal(sent["bucket"], bucket)))
        for r in group.to_pylist():
            assert (r["lang"], r["phrase"]) not in got
            assert r["words"] == len(r["phrase"].split())
            got[r["lang"], r["phrase"]] = r["f"]
    assert got == dict(want)


def test_counts_are_added_up_by_text_and_language(monkeypatch):
    """Phrases of one bucket stay apart whatever their hashes; the support holds for their sum."""
    def packed(*found):
        return op11.pack_counts(np.array([n for _, n in found]), np.array([len(p.encode()) for p, _ in found]), "".join(p for p, _ in found).encode())

    runs = [("en", packed(("a b", 6), ("é", 300), ("x", 2))), ("de", packed(("a b", 70_000))), ("en", packed(("a b", 5), ("x", 7))), ("fr", packed(("", 0)))]
    rows = pa.table({"bucket": pa.array([0] * 4, pa.int32()), "lang": [x for x, _ in runs], "run": pa.array([r for _, r in runs], pa.binary())})
    want = [("de", 2, "a b", 70_000), ("en", 1, "é", 300), ("en", 2, "a b", 11), ("fr", 0, "", 0)]
    for most in (1 << 28, 1):
        monkeypatch.setattr(op11, "ARRAY_BYTES", most)
        assert sorted(tuple(r.values()) for r in op11._total(10)(rows).to_pylist()) == sorted(want)


def test_each_shard_is_mined_by_itself():
    """Three of a shard and three of another are not four of one."""
    def mined(*runs):
        rows = pd.DataFrame({"shard": [s for s, _, _ in runs], "bucket": 0, "run": [op11.pack(np.array([k], np.uint64), np.array([n])) for _, k, n in runs]})
        out = op11._frequent(0, 20, 4)(rows)
        return int(out["frequent"].iloc[0]), np.flatnonzero(np.unpackbits(np.frombuffer(out["bits"].iloc[0], np.uint8), bitorder="little")).tolist()

    key = 77 << (op11.HASH_BITS - 20)
    assert mined((0, key, 3), (1, key, 3), (0, 5, 1)) == (0, [])
    assert mined((0, key, 3), (1, key, 3), (0, key, 1)) == (1, [77])
    assert mined((2, key, 400), (1, key, 4), (0, 0, 255)) == (3, [0, 77])


def test_ranks_come_from_slices(spark, monkeypatch):
    """Many tasks rank a language; its last ranking sees the first ``top`` of each slice alone."""
    monkeypatch.setattr(op11, "SLICES", 3)
    rows, docs = phrase_docs(spark)
    got = op11.collocations(docs, support=2, top=7)
    assert collocation_rows(got) == plain_collocations(rows, support=2, top=7)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(lang" in plan and any("windowspecdefinition" in x and "slice#" in x for x in plan.splitlines())


# ------------------------------------------------------------------ op 12

def word_list(text):
    out, word = [], ""
    for c in (text or "").translate(LOWER) + " ":
        if c in "0123456789abcdefghijklmnopqrstuvwxyz" or ord(c) >= 128:
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def plain_features(text, max_n, buckets):
    w = word_list(text)
    return w, [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


def plain_resample(rows, target, max_n, buckets, percent=10, min_words=20, seed=2024):
    source, wanted = collections.Counter(), collections.Counter()
    for _, t in rows:
        source.update(plain_features(t, max_n, buckets)[1])
    for t in target:
        wanted.update(plain_features(t, max_n, buckets)[1])
    big_s, big_t = sum(source.values()), sum(wanted.values())
    out = []
    for i, t in rows:
        w, f = plain_features(t, max_n, buckets)
        gain = sum(math.floor(1000 * math.log((wanted[b] + 1) * (big_s + buckets) / ((source[b] + 1) * (big_t + buckets)))) for b in f)
        weight = gain // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(f), weight, score, len(w)))
    able = sorted((x for x in out if x[4] >= min_words), key=lambda x: (-x[3], x[0] is None, x[0], x[1], x[2]))
    drawn = able[:percent * len(able) // 100]
    ranked = [(*x[:4], n + 1) for n, x in enumerate(drawn)]
    rest = [(*x[:4], None) for x in out]
    for x in drawn:
        rest.remove((*x[:4], None))
    return sorted(ranked + rest, key=repr)


@pytest.mark.parametrize(("max_n", "buckets", "percent"), [(1, 10_000, 10), (3, 97, 50), (2, 1000, 100)])
def test_resampling_equals_plain_version(spark, max_n, buckets, percent):
    rng = random.Random(12)
    docs = awkward(spark, extra=[f"{words(rng, 30)}\nsame line here\n\n{words(rng, 9)}\nsame line here\nÉté 12" for _ in range(30)])
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    target = [words(rng, 40), "same line here", None, ""]
    got = op12.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), max_n, buckets, percent=percent)
    assert [c for c in got.columns] == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in got.collect()), key=repr) \
        == plain_resample(rows, target, max_n, buckets, percent)


def test_resampling_ties_and_empty_tables(spark):
    assert op12.resample(empty(spark), empty(spark)).count() == 0
    text = "one two three four five six seven eight nine ten " * 3
    docs = spark.createDataFrame([(5, text)] * 6 + [(4, text)] * 4, "doc_id long, text string")
    got = sorted((r["rank"], r["doc_id"]) for r in op12.resample(docs, empty(spark), percent=50).collect() if r["rank"])
    assert [r for r, _ in got] == [1, 2, 3, 4, 5]
    want = plain_resample([(5, text)] * 6 + [(4, text)] * 4, [], 1, 10_000, percent=50)
    assert got == sorted((x[4], x[0]) for x in want if x[4])
    assert all(r["rank"] is None for r in op12.resample(docs, docs, percent=0).collect())


def test_crc32_of_words():
    data = [b"a", b"abc", b"", b"x" * 47, b"y" * 48, b"z" * 49, b"q" * 1000, "é".encode()]
    raw = np.frombuffer(b"".join(data), np.uint8)
    ends = np.cumsum([len(d) for d in data])
    starts = ends - [len(d) for d in data]
    assert op12.crc32(raw, starts, ends).tolist() == [zlib.crc32(d) for d in data]


def test_repeated_lines_are_hashed_once():
    texts = pa.array(["a b\nc d\na b", "a b", None, "x\n\n\ny"])
    lines = op12.Lines(texts, 2, 1000)
    assert lines.lines == 5  # "a b", "c d", "", "x", "y"
    want = collections.Counter(b for t in texts.to_pylist() for b in plain_features(t, 2, 1000)[1])
    assert {b: int(n) for b, n in enumerate(lines.totals(1000)) if n} == dict(want)


# ------------------------------------------------------------------ op 13

def plain_tokens(text):
    out, run, kind = [], b"", None
    for b in (text or "").encode() + b" ":
        now = None if b in b" \t\n\x0b\x0c\r" else bool(op13.WORD[b])
        if now != kind and run:
            out.append((kind, run))
            run = b""
        kind = now
        if now is not None:
            run += bytes([b])
    return out


def test_features_follow_tokens():
    texts = ["THE!! cat cat  cat sat *** on", "", None, "a", "x" * 70 + " y"]
    owner, feature, value = op13.features(pa.array(texts))
    for i, t in enumerate(texts):
        tokens = [x if k == 0 or x != y or not x[0] else "<repeat>" for k, (x, y) in
                  enumerate(zip(plain_tokens(t), [None, *plain_tokens(t)[:-1]], strict=False))]
        grams = collections.Counter([(x,) for x in tokens] + list(zip(tokens[:-1], tokens[1:], strict=True)))
        own = value[owner == i]
        assert len(own) == len(grams)
        if len(own):
            raw = np.sort(np.log1p(np.array(sorted(grams.values()), float)))
            assert np.allclose(np.sort(own), raw / np.sqrt((raw ** 2).sum()))
    assert (np.diff(owner) >= 0).all()


def test_ftrl_follows_the_update_rule():
    model = op13.Ftrl()
    z, n = {}, {}
    rng = np.random.RandomState(3)
    for _ in range(50):
        at = np.unique(rng.randint(0, 40, 6))
        x, y = rng.rand(len(at)), float(rng.rand() < 0.5)
        w = {}
        for i in at:
            zi, ni = z.get(i, 0.0), n.get(i, 0.0)
            w[i] = 0.0 if abs(zi) <= op13.L1 else -(zi - math.copysign(op13.L1, zi)) / ((op13.BETA + math.sqrt(ni)) / op13.ALPHA + op13.L2)
        p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in zip(at, x, strict=True))))
        for i, v in zip(at, x, strict=True):
            g = (p - y) * v
            sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / op13.ALPHA
            z[i], n[i] = z.get(i, 0.0) + g - sigma * w[i], n.get(i, 0.0) + g * g
        model.update(at, x, y)
    assert np.allclose(model.z[list(z)], list(z.values())) and np.allclose(model.n[list(n)], list(n.values()))


def quality_table(spark):
    rng = random.Random(13)
    rows, marks = [], []
    for i in range(900):
        bad = i % 4 == 0
        text = words(rng, 40)
        rows.append((i, "".join(f"{w}*** " for w in text.split()) if bad else text, "en"))
        marks.append((i, int(not bad), 0))
    rows += [(2000, rows[0][1], "fr"), (2001, rows[1][1], None), (2002, None, "en"), (2003, "", "en"), (None, rows[0][1], "en"), (0, rows[0][1], "en")]
    marks += [(i, 0, 0) for i in range(5000, 9000)] + [(None, 0, 0), (7, None, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), labels_for(spark, marks), marks


def test_quality_held_out(spark):
    docs, labels, marks = quality_table(spark)
    got = op13.score_documents(docs, labels).collect()
    assert len(got) == docs.count()
    by_id = {r["doc_id"]: r for r in got}
    held = [(by_id[i]["predicted"], y) for i, y, _ in marks if i is not None and i < 900 and y is not None and by_id[i]["held_out"]]
    assert len(held) > 200 and sum(p == y for p, y in held) / len(held) > 0.98
    assert by_id[2000]["predicted"] == by_id[None]["predicted"] == 0 and by_id[2001]["predicted"] == 1
    assert by_id[2002]["score"] == by_id[2003]["score"]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert all(r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 3 == 1) for r in got)
    again = {r["doc_id"]: r["score"] for r in op13.score_documents(docs.repartition(7), labels).collect()}
    assert all(again[i] == pytest.approx(r["score"], abs=1e-9) for i, r in by_id.items())


def test_quality_labels_without_documents_take_no_place(spark):
    docs, labels, _ = quality_table(spark)
    rows = op13.training_rows(docs, labels, max_rows=300)
    assert 200 < rows.count() < 400
    assert rows.count() == rows.select("doc_id", "digest").distinct().count()


def test_quality_edges(spark):
    none = labels_for(spark, [])
    got = op13.score_documents(awkward(spark), none).collect()
    assert len(got) == awkward(spark).count() and {r["score"] for r in got} == {0.5}
    assert op13.score_documents(empty(spark), none).count() == 0
    one = labels_for(spark, [(i, 1, 0) for i in range(20)])
    assert all(r["score"] > 0.99 for r in op13.score_documents(awkward(spark), one).collect())


def test_quality_of_the_test_tables(spark):
    got = {r["doc_id"]: r for r in op13.score_documents(table(spark, SF, "documents"), table(spark, SF, "labels")).collect()}
    held = [(got[r["doc_id"]]["predicted"], r["quality"]) for r in table(spark, SF, "labels").collect() if got[r["doc_id"]]["held_out"]]
    assert sum(p == y for p, y in held) / len(held) > 0.9
