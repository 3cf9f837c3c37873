"""Exact top-k BM25 search over an inverted index with block-max pruning.

The index is a table of shards, one row each: the postings of a run of texts of
about ``SHARD_BYTES``, term by term, with document lengths. It is built in one
narrow pass (texts are not shuffled) and written to the shared folder.

Queries come in blocks of bounded size that are broadcast. For each block the
shards first add up the document frequencies of its terms, so every shard
scores with the same global statistics (documents, mean length, frequencies).
Then each shard takes the queries in batches, over blocks of ``BLOCK_DOCS``
neighbouring documents (ordered by their most frequent word and length, so that
neighbours are alike; so are the queries of a batch). Rare terms are summed by
their postings. The block's best such sum and its largest weights of the frequent
terms bound what a document there can score: blocks that cannot reach the k-th
best score so far of any query of the batch are skipped, in the others the
frequent terms' weights are multiplied as a matrix. This is block-max pruning as in
MaxScore, with the rare terms as the essential ones, not WAND's pivot per document.
Those sums are of limited precision and compared with slack; a document that can
reach the threshold is scored in full. A task carries the threshold from shard to
shard. One shard in ``SEED_SHARE`` is searched first, and the k-th best score found
there is the floor that the tasks of all other shards start with. The best k of all
tasks are merged by rank; nothing is approximate.

score = sum over the query's distinct terms of
round(1e6 * ln(1 + (N - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))) / 1e6,
so sums are exact whatever their order. Words are lower-cased (A-Z)
``[^\\x20\\x09-\\x0D]+``, told apart by 64-bit hashes.

Edge cases: null and empty texts match nothing (but count in N and avgdl);
queries without words or id give no rows; rows with one query id ask with the
smallest of their texts; ties in score go to the smaller doc_id; a document
without any query term is no result; repeated rows are results of their own;
extra columns are dropped.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textvec as tv
from .common import documents, materialize
from .op6_suffix_tree_lm import expand, lookup, squeeze

K = 10
K1, B = 1.2, 0.75
SHARD_BYTES = 6 << 20
BLOCK_DOCS = 8
#: a term in this share of a shard's documents, and in so many, is frequent; cells of the matrix of frequent terms
OFTEN, LEAST_OFTEN = 0.06, 8
DENSE_CELLS = 4 << 20
#: queries searched together, and sums and postings held at a time
BATCH_QUERIES = 256
BATCH_CELLS = 1 << 19
BATCH_POSTINGS = 1 << 21
#: bounds of one broadcast block of queries
BLOCK_QUERIES = 4096
BLOCK_TERMS = 1_000_000
SLICE = 1 << 15
#: one shard in so many is searched before the others, for a first threshold
SEED_SHARE = 8
SCALE = 1e6
_U = np.uint64

INDEX_SCHEMA = ("doc_ids array<long>, lengths binary, terms binary, counts binary, docs binary, tfs binary, "
                "n_docs long, n_words long")


def arrange(terms: np.ndarray, docs: np.ndarray, tf: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Order of a shard's documents: by their most frequent word (mostly the language), then by length.

    Neighbours are then alike, so the bounds of a block are close to its documents' scores.
    """
    most = np.zeros(len(lengths), tf.dtype)
    np.maximum.at(most, docs, tf)
    top = np.flatnonzero(tf == most[docs])
    word = np.full(len(lengths), np.iinfo(np.uint64).max, _U)
    np.minimum.at(word, docs[top], terms[top])
    return np.lexsort((lengths, word))


def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to shard rows."""
    for part in tv.pieces(batches, max_bytes=SHARD_BYTES):
        words = tv.words_of(part)
        owner = words.owner()
        order = np.lexsort((owner, words.hashes))
        h, o = words.hashes[order], owner[order]
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
        at = np.flatnonzero(fresh)
        tf = np.diff(np.append(at, len(h)))
        h, o = h[at], o[at]
        first = np.ones(len(h), bool)
        first[1:] = h[1:] != h[:-1]
        starts = np.flatnonzero(first)
        place = arrange(h, o, tf, words.counts())
        moved = np.empty(len(place), np.int64)
        moved[place] = np.arange(len(place))
        o = moved[o]
        term = np.cumsum(first)
        order = np.lexsort((o, term))
        o, tf = o[order], tf[order]
        yield pa.RecordBatch.from_arrays(
            [pa.array([tv.column(part, "doc_id").take(pa.array(place)).to_pylist()], pa.list_(pa.int64())),
             pa.array([squeeze(words.counts()[place].astype(np.uint32))], pa.binary()),
             pa.array([h[starts].tobytes()], pa.binary()),
             pa.array([squeeze(np.diff(np.append(starts, len(h))).astype(np.uint32))], pa.binary()),
             pa.array([squeeze(o.astype(np.uint32))], pa.binary()), pa.array([squeeze(tf.astype(np.uint32))], pa.binary()),
             pa.array([part.num_rows], pa.int64()), pa.array([len(words.hashes)], pa.int64())],
            ["doc_ids", "lengths", "terms", "counts", "docs", "tfs", "n_docs", "n_words"])


def build_index(docs: DataFrame) -> DataFrame:
    return materialize(documents(docs).mapInArrow(build, INDEX_SCHEMA), "op1-index")


def query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in tv.pieces(batches):
        words = tv.words_of(part)
        terms = [np.unique(words.hashes[a:b]).tobytes() for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([tv.column(part, "doc_id"), pa.array(terms, pa.binary())], ["query_id", "terms"])


class Queries:
    """A block of queries: their ids, the distinct terms of all of them, and each query's places in those."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        self.ids = np.array([i for i, _ in rows], np.int64)
        every = [np.frombuffer(t, _U) for _, t in rows]
        self.first = np.concatenate(([0], np.cumsum([len(t) for t in every])))
        self.terms, self.places = np.unique(np.concatenate(every), return_inverse=True)
        self.idf = np.zeros(len(self.terms))
        #: 0 for the most frequent term
        self.rank = np.arange(len(self.terms))
        #: a score that k documents are known to reach, for each query
        self.floor = np.ones(len(self.ids))

    def together(self, most: int) -> Iterator[np.ndarray]:
        """The queries in batches, those with the same most frequent word (mostly the language) next to each other."""
        order = np.argsort(np.minimum.reduceat(self.rank[self.places], self.first[:-1]), kind="stable")
        step = min(max(most, 1), BATCH_QUERIES)
        for a in range(0, len(order), step):
            yield order[a:a + step]


def query_blocks(queries: DataFrame) -> Iterator[Queries]:
    """Queries (doc_id, text) in blocks of bounded size, by id."""
    rows = documents(queries).where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("text").alias("text"))
    rows = materialize(rows.mapInArrow(query_terms, "query_id long, terms binary"), "op1-queries")
    block, size = [], 0
    for row in rows.where(F.octet_length("terms") > 0).orderBy("query_id").toLocalIterator():
        block.append((row["query_id"], bytes(row["terms"])))
        size += len(row["terms"]) // 8
        if len(block) >= BLOCK_QUERIES or size >= BLOCK_TERMS:
            yield Queries(block)
            block, size = [], 0
    if block:
        yield Queries(block)


def _frequencies(shared):
    """Document frequencies of the block's terms, over the shards of a task, in slices."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for coded, counts in zip(tv.column(batch, "terms").to_pylist(), tv.column(batch, "counts").to_pylist(), strict=True):
                at = lookup(np.frombuffer(coded, _U), terms)
                df = expand(counts, "<u4").astype(np.int64)
                found = at >= 0
                total[found] += df[at[found]]
        cuts = range(0, len(terms), SLICE)
        yield pa.RecordBatch.from_arrays([pa.array([c // SLICE for c in cuts], pa.int64()),
                                          pa.array([total[c:c + SLICE].tobytes() for c in cuts], pa.binary())], ["slice", "n"])

    return run


def _add(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(x, np.int64) for x in pdf["n"]], axis=0)
    return pd.DataFrame({"slice": [int(pdf["slice"].iloc[0])], "n": [total.tobytes()]})


class Shard:
    """Postings of a shard by term, and the weights of its frequent terms as a matrix with its blocks' largest weights."""

    def __init__(self, row: dict, mean_length: float):
        self.ids = np.array([np.iinfo(np.int64).max if i is None else i for i in row["doc_ids"]], np.int64)
        length = expand(row["lengths"], "<u4").astype(float)
        self.terms = np.frombuffer(row["terms"], _U)
        self.counts = expand(row["counts"], "<u4").astype(np.int64)
        self.docs = expand(row["docs"], "<u4").astype(np.int64)
        tf = expand(row["tfs"], "<u4").astype(float)
        norm = K1 * (1 - B + B * length / max(mean_length, 1e-9))
        self.weight = tf * (K1 + 1) / (tf + norm[self.docs])
        #: first posting of each term
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        n = len(self.ids)
        often = np.flatnonzero(self.counts >= max(n * OFTEN, LEAST_OFTEN))
        often = often[np.argsort(-self.counts[often], kind="stable")][:DENSE_CELLS // max(n, 1)]
        #: column of each frequent term, -1 for the others
        self.column = np.full(len(self.terms), -1)
        self.column[often] = np.arange(len(often))
        posting = positions(self.first[often], self.counts[often])
        self.dense = np.zeros((n, len(often)), np.float32)
        self.dense[self.docs[posting], np.repeat(np.arange(len(often)), self.counts[often])] = self.weight[posting]
        self.block_starts = np.arange(0, n, BLOCK_DOCS)
        self.block_top = np.maximum.reduceat(self.dense, self.block_starts, axis=0)
        #: relative error of a sum of that many products of singles, twice over
        self.slack = 2 * (len(often) + 8) * 2.0 ** -24

    @functools.cached_property
    def by_doc(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(term, weight) of all postings in order of their documents, and the first of each document."""
        order = np.argsort(self.docs.astype(np.uint16 if len(self.ids) <= 1 << 16 else np.int64), kind="stable")
        term = np.repeat(np.arange(len(self.terms)), self.counts)[order]
        first = np.concatenate(([0], np.cumsum(np.bincount(self.docs, minlength=len(self.ids)))))
        return term, self.weight[order], first

    @functools.cached_property
    def blank(self) -> np.ndarray:
        """A zero for every term, lent to one query at a time."""
        return np.zeros(len(self.terms))


def positions(starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All indices of the ranges of these starts and sizes, one after the other."""
    end = np.cumsum(size)
    at = np.repeat(starts - end + size, size)
    at += np.arange(len(at))
    return at


class Best:
    """The k best (score, doc id) of one query so far; ``floor`` is a score that k documents are known to reach."""

    def __init__(self, k: int, floor: float = 1.0):
        self.k, self.floor = k, floor
        self.score, self.doc = np.zeros(0), np.zeros(0, np.int64)

    @property
    def threshold(self) -> float:
        return max(self.floor, self.score[-1]) if len(self.score) == self.k else self.floor

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.concatenate([self.score, score]), np.concatenate([self.doc, doc])
        order = np.lexsort((doc, -score))[:self.k]
        self.score, self.doc = score[order], doc[order]


def _exact(shard: Shard, docs: np.ndarray, terms: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Scores of some documents of a shard."""
    term, weight, first = shard.by_doc
    shard.blank[terms] = SCALE * idf
    score = np.zeros(len(docs))
    for i, (a, b) in enumerate(zip(first[docs], first[docs + 1], strict=True)):
        part = shard.blank[term[a:b]]
        part *= weight[a:b]
        score[i] = np.rint(part, out=part).sum()
    shard.blank[terms] = 0
    return score


def search_many(shard: Shard, owner: np.ndarray, terms: np.ndarray, idf: np.ndarray, best: list[Best]) -> int:
    """Update ``best`` of some queries; returns the pairs of query and document scored in full.

    Query ``owner[i]`` (ascending) holds the term at place ``terms[i]`` of the shard. The rare terms are summed
    by their postings. With a block's largest weights of the frequent terms they bound what its documents can
    reach; the frequent terms are summed only in the blocks that can reach the threshold of one of the queries.
    Sums are of limited precision up to there, with the slack that takes; documents that can still reach a
    query's threshold are scored in full.
    """
    n, k = len(shard.ids), best[0].k
    held = np.bincount(owner, minlength=len(best))
    column = shard.column[terms]
    rare = column < 0
    size = shard.counts[terms[rare]]
    if len(best) > 1 and size.sum() > BATCH_POSTINGS:
        half = len(best) // 2
        cut = np.searchsorted(owner, half)
        return (search_many(shard, owner[:cut], terms[:cut], idf[:cut], best[:half])
                + search_many(shard, owner[cut:] - half, terms[cut:], idf[cut:], best[half:]))
    posting = positions(shard.first[terms[rare]], size)
    key = np.repeat(owner[rare] * n, size)
    key += shard.docs[posting]
    part = np.repeat(idf[rare], size)
    part *= shard.weight[posting]
    sums = np.bincount(key, part, len(best) * n).astype(float, copy=False).reshape(len(best), n)
    asked = np.zeros((len(best), shard.dense.shape[1]), np.float32)
    asked[owner[~rare], column[~rare]] = idf[~rare]

    # what a sum must reach; a document without any of the terms is no result
    need = np.array([x.threshold for x in best])
    need = np.maximum((need - 1 - 0.5 * held) / (SCALE * (1 + shard.slack)), 1e-7)
    top = np.maximum.reduceat(sums, shard.block_starts, axis=1)
    top += asked @ shard.block_top.T
    starts = shard.block_starts[(top >= need[:, None]).any(axis=0)]
    docs = positions(starts, np.minimum(starts + BLOCK_DOCS, n) - starts)
    sums = sums[:, docs]
    sums += asked @ shard.dense[docs].T
    hit = sums >= need[:, None]

    # k documents of many reach the k-th best sum less the slack
    many = np.flatnonzero(hit.sum(axis=1) > 2 * k)
    if len(many):
        kth = np.partition(sums[many], len(docs) - k, axis=1)[:, len(docs) - k]
        least = SCALE * kth * (1 - shard.slack) - 0.5 * held[many] - 1
        need[many] = np.maximum(need[many], (least - 1 - 0.5 * held[many]) / (SCALE * (1 + shard.slack)))
        hit[many] = sums[many] >= need[many, None]
    at = np.concatenate(([0], np.cumsum(held)))
    found = hit.sum(axis=1)
    for q in np.flatnonzero(found):
        mine = docs[hit[q]]
        score = _exact(shard, mine, terms[at[q]:at[q + 1]], idf[at[q]:at[q + 1]])
        enough = score >= best[q].threshold
        if enough.any():
            best[q].add(score[enough], shard.ids[mine[enough]])
    return int(found.sum())


def search(shard: Shard, terms: np.ndarray, idf: np.ndarray, best: Best) -> int:
    """Update ``best`` with one query's terms (their places in the shard); returns the documents scored in full."""
    return search_many(shard, np.zeros(len(terms), np.int64), terms, idf, [best])


def _search(shared, mean_length: float, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = shared.value
        best = [Best(k, floor) for floor in queries.floor]
        for batch in batches:
            for n in range(batch.num_rows):
                shard = Shard(batch.slice(n, 1).to_pylist()[0], mean_length)
                place = lookup(shard.terms, queries.terms)
                for some in queries.together(BATCH_CELLS // len(shard.ids)):
                    size = queries.first[some + 1] - queries.first[some]
                    term = queries.places[positions(queries.first[some], size)]
                    at = place[term]
                    there = at >= 0
                    owner = np.repeat(np.arange(len(some)), size)[there]
                    search_many(shard, owner, at[there], queries.idf[term[there]], [best[q] for q in some])
        if not best:
            return
        sizes = [len(x.score) for x in best]
        doc = np.concatenate([x.doc for x in best])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(queries.ids, sizes)), pa.array(doc, mask=doc == np.iinfo(np.int64).max),
             pa.array(np.concatenate([x.score for x in best]).astype(np.int64))], ["query_id", "doc_id", "points"])

    return run


def _found(index: DataFrame, block: Queries, mean_length: float, k: int) -> DataFrame:
    """The best k of each task over its shards, for the queries of a block."""
    shared = index.sparkSession.sparkContext.broadcast(block)
    return index.drop("seed").mapInArrow(_search(shared, mean_length, k), "query_id long, doc_id long, points long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("points"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _floors(first: DataFrame, ids: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score of each query in ``first``, 1 where it has fewer."""
    last = first.where(F.col("rank") == k).select("query_id", "points").toPandas()
    floor = np.ones(len(ids))
    floor[np.searchsorted(ids, last["query_id"].to_numpy(np.int64))] = last["points"].to_numpy(float)
    return floor


def top_k(docs: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, doc_id, score: the k best rows of ``docs`` for every query (doc_id, text)."""
    spark = docs.sparkSession
    index = build_index(docs).withColumn("seed", F.pmod(F.xxhash64("doc_ids"), F.lit(SEED_SHARE)) == 0)
    size = index.agg(F.sum("n_docs").alias("n"), F.sum("n_words").alias("w")).first()
    n, mean_length = size["n"] or 0, (size["w"] or 0) / max(size["n"] or 0, 1)
    found = None
    for block in query_blocks(queries):
        terms = spark.sparkContext.broadcast(block.terms)
        counted = (index.select("terms", "counts").mapInArrow(_frequencies(terms), "slice long, n binary")
                   .groupBy("slice").applyInPandas(_add, "slice long, n binary").orderBy("slice").collect())
        df = np.concatenate([np.frombuffer(r["n"], np.int64) for r in counted]).astype(float)
        block.idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        block.rank = np.argsort(np.argsort(-df, kind="stable"))
        first = materialize(_ranked(_found(index.where("seed"), block, mean_length, k), k), "op1-first")
        block.floor = np.maximum(block.floor, _floors(first, block.ids, k))
        part = first.drop("rank").unionByName(_found(index.where("NOT seed"), block, mean_length, k))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, doc_id long, score double")
    return _ranked(found, k).select("query_id", "rank", "doc_id", (F.col("points") / F.lit(SCALE)).alias("score"))
