import collections
import math
import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from staffline.llm import op1_bm25_search as op1
from staffline.llm import op3_decontamination as op3
from staffline.llm import op4_jaccard_join as op4
from staffline.llm.graph import components

from .helpers import awkward, empty, plain, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ------------------------------------------------------------------- op 1

def brute_bm25(rows, queries, k):
    bags = [(i, collections.Counter(WORD.findall(lower(t)))) for i, t in rows]
    n, mean = len(bags), sum(sum(b.values()) for _, b in bags) / len(bags)
    df = collections.Counter(w for _, b in bags for w in b)
    out = {}
    for q, text in queries.items():
        found = []
        for i, bag in bags:
            norm = 1.2 * (0.25 + 0.75 * sum(bag.values()) / mean)
            points = sum(round(1e6 * math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * bag[w] * 2.2 / (bag[w] + norm))
                         for w in set(WORD.findall(lower(text))) if w in bag)
            if points > 0:
                found.append((-points, math.inf if i is None else i))
        out[q] = sorted(found)[:k]
    return out


def test_bm25_equals_brute_force(spark):
    docs = awkward(spark).repartition(3)
    queries = docs.where("doc_id % 4 = 0")
    got = collections.defaultdict(list)
    for r in op1.top_k(docs, queries, 5).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((-round(r["score"] * 1e6), math.inf if r["doc_id"] is None else r["doc_id"]))
    asked = {}
    for i, t in plain(queries):
        asked[i] = min(asked.get(i, t), t) if t is not None and asked.get(i) is not None else (t or asked.get(i))
    want = brute_bm25(plain(docs), {i: t for i, t in asked.items() if WORD.search(t or "")}, 5)
    assert dict(got) == want


def test_bm25_prunes_and_stays_exact():
    rng = random.Random(2)
    texts = [words(rng, 30) for _ in range(400)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(400)), "text": texts})
    row = next(op1.build(iter([batch]))).to_pylist()[0]
    shard = op1.Shard(row, 30.0)
    terms = np.sort(np.array(rng.sample(range(len(shard.terms)), 6)))
    idf = np.array([rng.random() + 0.1 for _ in terms])
    best = op1.Best(3)
    scored = op1.search(shard, terms, idf, best)
    total = np.zeros(400)
    for t, w in zip(terms, idf, strict=True):
        a, b = shard.first[t], shard.first[t + 1]
        total[shard.docs[a:b]] += np.rint(1e6 * w * shard.weight[a:b])
    order = np.lexsort((shard.ids, -total))[:3]
    assert best.doc.tolist() == shard.ids[order].tolist() and best.score.tolist() == total[order].tolist()
    assert scored < np.count_nonzero(total)


def test_bm25_floor_of_the_first_shards(spark, monkeypatch):
    rng = random.Random(8)
    docs = spark.createDataFrame([(i, words(rng, rng.randint(5, 30))) for i in range(400)], "doc_id long, text string").repartition(8)
    queries = docs.where("doc_id % 40 = 0")
    floors, own = [], op1._floors
    monkeypatch.setattr(op1, "_floors", lambda *x: floors.append(own(*x)) or floors[-1])
    found = []
    for share in (2, 1 << 60):  # with first shards, and without any
        monkeypatch.setattr(op1, "SEED_SHARE", share)
        found.append([tuple(r) for r in op1.top_k(docs, queries, 5).orderBy("query_id", "rank").collect()])
    assert found[0] == found[1] and len(found[0]) == 50
    fifth = {q: s for q, rank, _, s in found[0] if rank == 5}
    # known before the other shards are searched, and never above the fifth best of all
    assert (floors[0] > 1).any() and all(f <= 1e6 * fifth[q] + 0.5 for f, q in zip(floors[0], sorted(fifth), strict=True))
    assert (floors[1] == 1).all()


def shard_of(texts, mean):
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    return op1.Shard(next(op1.build(iter([batch]))).to_pylist()[0], mean)


def every_score(shard, terms, idf):
    total = np.zeros(len(shard.ids))
    for t, w in zip(terms, idf, strict=True):
        a, b = shard.first[t], shard.first[t + 1]
        total[shard.docs[a:b]] += np.rint(1e6 * w * shard.weight[a:b])
    return total


def test_bm25_scores_few_documents_in_full():
    rng = random.Random(21)
    shard = shard_of([words(rng, 60, ("the", "and", "of", "a", "in", "re")) for _ in range(600)], 60.0)
    counts = np.diff(shard.first)
    for _ in range(10):
        # a whole text as the query: mostly terms of many documents
        terms = np.sort(np.array(rng.sample(range(len(shard.terms)), 40) + np.argsort(-counts)[:30].tolist()))
        terms = np.unique(terms)
        idf = np.log(1 + 600 / counts[terms])
        total = every_score(shard, terms, idf)
        order = np.lexsort((shard.ids, -total))[:5]
        best = op1.Best(5)
        assert op1.search(shard, terms, idf, best) <= 20
        assert best.doc.tolist() == shard.ids[order].tolist() and best.score.tolist() == total[order].tolist()


@pytest.mark.parametrize("postings", [1 << 21, 50])
def test_bm25_batch_equals_single_queries(monkeypatch, postings):
    monkeypatch.setattr(op1, "BATCH_POSTINGS", postings)
    rng = random.Random(22)
    texts = [words(rng, rng.randint(1, 60)) for _ in range(300)] + [words(rng, 40)] * 30 + [None, "", "one"]
    shard = shard_of(texts, 40.0)
    asked = [np.sort(rng.sample(range(len(shard.terms)), n)) for n in (1, 80, 3, 200, 20)] + [np.zeros(0, np.int64)]
    idf = [np.array([rng.random() + 0.01 for _ in t]) for t in asked]
    best = [op1.Best(4, floor) for floor in (1.0, 1.0, 2e6, 1.0, 1e12, 1.0)]
    owner = np.repeat(np.arange(len(asked)), [len(t) for t in asked])
    op1.search_many(shard, owner, np.concatenate(asked).astype(np.int64), np.concatenate(idf), best)
    for q, (t, w) in enumerate(zip(asked, idf, strict=True)):
        total = every_score(shard, t, w)
        floor = best[q].floor
        order = [i for i in np.lexsort((shard.ids, -total)) if total[i] >= floor][:4]
        assert best[q].doc.tolist() == shard.ids[order].tolist() and best[q].score.tolist() == total[order].tolist()


def test_bm25_of_nothing(spark):
    assert op1.top_k(empty(spark), empty(spark)).count() == 0
    assert op1.top_k(awkward(spark), empty(spark)).columns == ["query_id", "rank", "doc_id", "score"]


# ------------------------------------------------------------------- op 3

def substring_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_myers_equals_dynamic_programming():
    rng = random.Random(1)
    for _ in range(150):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 70)))
        t = "".join(rng.choice("abc") for _ in range(rng.randint(0, 90)))
        assert op3.myers(p, t)[0] == substring_distance(p, t)


def edited(rng, text, n):
    for _ in range(n):
        at = rng.randrange(len(text))
        text = text[:at] + rng.choice(["", "q", text[at] + "q"]) + text[at + 1:]
    return text


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(9)
    items = [(k, words(rng, rng.randint(3, 30)).capitalize() + ".") for k in range(12)] + [(90, None), (91, "?!"), (92, "")]
    items.append((93, items[0][1]))
    extra = [words(rng, 20) + "\n" + edited(rng, items[k % 12][1], k % 7) + " " + words(rng, 10) for k in range(30)]
    docs = awkward(spark, [*extra, items[3][1].upper(), items[4][1].replace(" ", " -- ")])
    benchmark = spark.createDataFrame([*items, (None, "lost")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in op3.contaminated(docs, benchmark).collect()}
    want = {}
    for i, t in plain(docs):
        if t and len(t) > 2500:
            continue
        for item, text in items:
            pattern = op3.normal_text(text)
            if pattern:
                d = substring_distance(pattern, op3.normal_text(t))
                if d <= op3.budget(pattern, op3.ERROR_SHARE):
                    want[i, item] = min(d, want.get((i, item), d))
    assert want and {k: v for k, v in got.items() if k in want} == want
    assert set(got) == set(want)
    kept = op3.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    hit = {i for i, _ in want}
    assert sorted(map(str, (r[0] for r in kept.select("doc_id").collect()))) == sorted(
        str(i) for i, _ in plain(docs) if i not in hit)


def test_decontamination_of_nothing(spark):
    no_items = spark.createDataFrame([], "item_id long, text string")
    items = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    assert op3.contaminated(awkward(spark), no_items).count() == 0
    assert op3.contaminated(empty(spark), items).count() == 0
    assert op3.drop_contaminated(awkward(spark), no_items).count() == awkward(spark).count()


# ------------------------------------------------------------------- op 4

def brute_components(rows):
    sets = []
    for i, t in rows:
        w = WORD.findall(lower(t))
        sets.append((i, {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            (i, s), (j, t) = sets[a], sets[b]
            if s and t and None not in (i, j) and 100 * len(s & t) >= 75 * len(s | t):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted((str(i), len(s), str(find(i))) for i, s in sets)


def family(rng, n):
    """Near copies of one text: some linked directly, some only through others."""
    base = words(rng, 60).split()
    out = []
    for k in range(n):
        text = base[:]
        for _ in range(k % 5):
            text[rng.randrange(len(text))] = words(rng, 1)
        out.append(" ".join(text))
    return out


def test_join_equals_brute_force(spark):
    rng = random.Random(4)
    passage = words(rng, 40)
    extra = family(rng, 30) + family(rng, 6) + [passage + " " + words(rng, rng.randint(5, 60)) for _ in range(20)]
    extra += ["a b c d", "a b c d", "A b C d", "a b c", "a b c d e f", "a b c d e f g", "a b c d e"]
    docs = awkward(spark, extra).repartition(4)
    got = sorted((str(r[0]), r[1], str(r[2])) for r in op4.join_classes(docs).collect())
    assert got == brute_components(plain(docs))
    kept = op4.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert {r[0] for r in kept.select("doc_id").collect()} == {
        None if i == "None" else int(i) for i, _, c in got if i == c}


def test_linked_sets_always_share_a_key():
    rng = np.random.RandomState(0)
    linked = 0
    for _ in range(1500):
        n = int(rng.choice([1, 2, 3, 4, 5, 6, 8, 10, 15, 20, 30, 60, 120, 300]))
        a = np.unique(rng.randint(1, 2**62, n).astype(np.uint64))
        d = int(rng.randint(0, n // 3 + 2))
        cut = rng.randint(0, d + 1)
        b = np.unique(np.concatenate([a[:max(0, len(a) - cut)], rng.randint(1, 2**62, d - cut).astype(np.uint64)]))
        if not len(b) or not op4.links(len(np.intersect1d(a, b)), len(a), len(b)):
            continue
        linked += 1
        popular = np.sort(a[rng.rand(len(a)) < rng.choice([0, 0, 0.3, 0.9])])
        hashes, owner = np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)])
        starts = np.array(op4.band_table(max(len(a), len(b))))
        own = np.searchsorted(starts, [len(a), len(b)], "right") - 1
        keys = [set(), set()]
        for prefix in (False, True):
            for band in (own, np.where(own > 0, own - 1, -1)):
                for key, text in op4.signatures(hashes, owner, op4.is_rare(hashes, popular), band, prefix):
                    for x, y in zip(key.tolist(), text.tolist(), strict=True):
                        keys[y].add((prefix, x))
        assert keys[0] & keys[1]
    assert linked > 500


class Shared:
    def __init__(self, value):
        self.value = value


def met_in_cells(docs, rows, popular=()):
    """Rows of all cells for (doc_id, text), with about ``rows`` signatures a cell."""
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in docs], pa.int64()), pa.array([t for _, t in docs], pa.string())],
                                       ["doc_id", "text"])
    sizes = np.diff(op4.shingle_sets(batch)[1])
    cells = op4.Cells(*np.unique(sizes[sizes > 0], return_counts=True), rows=rows)
    signed = pd.concat([b.to_pandas() for b in op4._sign(Shared(np.array(popular, np.uint64)), cells)([batch])])
    return pd.concat([op4._meet(pdf, cells) for _, pdf in signed.groupby("bucket")]), cells


@pytest.mark.parametrize("rows", [10**9, 3000, 300, 40])
def test_cells_give_every_linked_pair_and_few_others(rows):
    rng = random.Random(rows)
    passage, texts = words(rng, 40), []
    for n in (6, 9, 14, 40, 120, 400):
        for _ in range(6):
            base = words(rng, n).split()
            for _ in range(8):
                copy = base[:]
                for _ in range(rng.randrange(1 + n // 60)):
                    copy[rng.randrange(len(copy))] = words(rng, 1)
                texts.append(" ".join(copy + words(rng, 1 + rng.randrange(1 + n // 10)).split()))
    # these share a passage and are no copies
    texts += [f"{words(rng, 60)} {passage} {words(rng, 60)}" for _ in range(12)]
    docs = list(enumerate(texts))
    sets = [{tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} for w in (WORD.findall(lower(t)) for t in texts)]
    linked = {(i, j) for j in range(len(sets)) for i in range(j)
              if sets[i] != sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    met, cells = met_in_cells(docs, rows)
    assert (cells.parts.max() > 1) == (rows < 10**9)
    pairs = list(met[met["b"] >= 0][["a", "b"]].itertuples(index=False, name=None))
    # equal sets stand for each other: the smallest id of each set
    least = {}
    for i, x in enumerate(sets):
        least.setdefault(frozenset(x), i)
    name = [least[frozenset(x)] for x in sets]
    missing = {(min(name[i], name[j]), max(name[i], name[j])) for i, j in linked} - set(pairs)
    odd = set(irregular(docs))
    assert len(linked) > 60 and all(i in odd and j in odd for i, j in missing)
    if rows > 1000:
        assert not [p for p in pairs if min(p) >= len(texts) - 12]


def irregular(docs):
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in docs], pa.int64()), pa.array([t for _, t in docs], pa.string())],
                                       ["doc_id", "text"])
    return [i for b in op4._sign_irregular(Shared(np.zeros(0, np.uint64)))([batch]) for i in b.column(1).to_pylist()]


def test_least_units_of_a_part():
    rng = np.random.RandomState(3)
    for _ in range(3000):
        units = rng.randint(1, 6, rng.randint(1, 7))
        spoiled = np.minimum(rng.randint(0, 6, len(units)), units)
        total = int(spoiled.sum()) + int(rng.randint(0, 3))
        if total < units.sum():  # more units than can be spoiled: some part shows the pair
            assert any(u - s >= op4.least_units(units, k, np.array([total]))[0]
                       for k, (u, s) in enumerate(zip(units, spoiled, strict=True)))


def test_folded_sketches_never_exceed_the_difference():
    rng = np.random.RandomState(5)
    for size in (3, 120, 400, 3000):
        left = np.unique(rng.randint(1, 2**62, size).astype(np.uint64))
        right = np.unique(np.concatenate([left[size // 5:], rng.randint(1, 2**62, size // 3).astype(np.uint64)]))
        both = [op4.folded(op4.sketches(x, np.array([0, len(x)]))[0]).view(np.uint64) for x in (left, right)]
        assert np.bitwise_count(both[0] ^ both[1]).sum() <= len(np.setxor1d(left, right))


def test_repeated_shingles_of_a_task():
    rng = np.random.RandomState(7)
    for top in (3, 60, 4000):
        parts = [np.unique(rng.randint(0, top, 200).astype(np.uint64)) for _ in range(5)]
        wanted = {h: c for h, c in collections.Counter(np.concatenate(parts).tolist()).items() if c > 1}
        found = [b for b in op4._repeated(list(parts))]
        assert {i: n for b in found for i, n in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)} == wanted
    assert list(op4._repeated([])) == []
    assert [b.num_rows for b in op4._repeated([np.arange(4, dtype=np.uint64)])] == [0]


def test_only_plausible_pairs_across_components(spark):
    rng = np.random.RandomState(6)
    base = np.unique(rng.randint(1, 2**62, 100).astype(np.uint64))
    other = np.unique(rng.randint(1, 2**62, 100).astype(np.uint64))
    sets = {1: base, 2: base[3:], 3: other, 4: base[2:]}
    texts = spark.createDataFrame([(i, bytearray(op4.sketches(x, np.array([0, len(x)]))[0])) for i, x in sets.items()],
                                  "doc_id long, sketch binary")
    # 2 stands twice, once with the sketch of another text: any of its texts may link
    texts = texts.unionByName(texts.where("doc_id = 3").selectExpr("2L AS doc_id", "sketch"))
    large = spark.createDataFrame([(-1, 7, i, len(x), i) for i, x in sets.items()],
                                  "bucket long, grp long, a long, n long, comp long")
    large = large.withColumn("comp", F.when(F.col("a") == 4, 1).otherwise(F.col("comp")).cast("long"))
    found = {tuple(r) for r in op4.across_components(large, texts).distinct().collect()}
    assert found == {(1, 2), (2, 3), (2, 4)}


def test_pairs_across_components_meet_in_few_of_their_groups(spark):
    rng = random.Random(12)
    base = np.unique(np.random.RandomState(7).randint(1, 2**62, 100).astype(np.uint64))
    # every set is near every other one; odd ones share all groups, the others only some
    texts = spark.createDataFrame([(i, bytearray(op4.sketches(base, np.array([0, len(base)]))[0])) for i in range(8)],
                                  "doc_id long, sketch binary")
    members = [(-1, g, i, len(base), i) for g in range(60) for i in range(8) if i % 2 or rng.random() < 0.04]
    large = spark.createDataFrame(members, "bucket long, grp long, a long, n long, comp long")
    held = collections.defaultdict(set)
    for _, g, i, _, _ in members:
        held[i].add(g)
    shared = {(a, b): len(held[a] & held[b]) for a in held for b in held if a < b and held[a] & held[b]}
    got = collections.Counter((r["a"], r["b"]) for r in op4.across_components(large, texts).collect())
    assert set(got) == set(shared)
    assert all(got[a, b] == 1 for a, b in got if a % 2 and b % 2)
    assert sum(got.values()) < sum(shared.values()) / 3


def test_join_of_nothing(spark):
    assert op4.join_classes(empty(spark)).count() == 0


@pytest.mark.parametrize("edges", [[(1, 2), (2, 3), (3, 4), (9, 8), (5, 5)], [(k, k + 1) for k in range(40)], []])
def test_components(spark, edges):
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r["id"]: r["component"] for r in components(frame, "test").collect()}
    parent = {x: x for e in edges for x in e}
    for _ in edges:
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == {x: c for x, c in parent.items() if any(x in e and e[0] != e[1] for e in edges)}


def test_bands_cover_links():
    for band in range(20):
        low, high = op4.band_bounds(band)
        assert (high - 1) * 100 // 75 < op4.band_bounds(band + 1)[1]
        plan = op4.scheme(band)
        assert plan.units - (plan.spare) >= op4.most_differences(high) + 1


def test_shingle_sizes(spark):
    docs = spark.createDataFrame([(1, "a a a a a a a"), (2, "a b c d e a b c d e")], "doc_id long, text string")
    got = {r["doc_id"]: r["n_shingles"] for r in op4.join_classes(docs).select("doc_id", F.col("n_shingles")).collect()}
    assert got == {1: 1, 2: 5}
