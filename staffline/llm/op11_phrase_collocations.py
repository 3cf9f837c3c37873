"""Phrase collocations by SON partitioning.

The corpus is dealt into a few shards of whole input splits. A phrase (up to
``max_words`` consecutive words of one piece, per language) that occurs
``support`` times in all occurs ``ceil(support / shards)`` times in one shard
at least: the local support.

1. Mine: every shard is mined completely at the local support. Tasks hash the
   phrases of runs of texts (language included) and send sorted, packed runs of
   (hash, count) to hash buckets; a bucket adds up the runs of each shard by
   itself and keeps the locally frequent hashes.
2. Union: the candidates of all shards become one bitmap over the hash space;
   its size follows the corpus up to ``MAX_FILTER_BITS`` (128 MB, broadcast).
   A fuller bitmap lets more phrases through to step 3 and changes no result.
3. Count: a second pass over all texts counts every candidate. A task adds up a
   few runs of texts and sends the phrases with their counts, packed, to the
   hash buckets of the corpus; a bucket adds up by the phrase's own text, so
   that two phrases of one hash stay two phrases. No phrase is a row of Spark's
   before it is known to be frequent.

Cuts, scores and containment are joins over the table of frequent phrases, in
decimals of 38 digits; the ranks of a language follow from the first of each
of ``SLICES`` slices of its phrases. With ``shards`` = 3 and support 10 the local support is 4; more
shards lower it towards 1, where mining prunes nothing.

Edge cases: null and empty texts have no words; a null language is ``und``;
repeated rows count each time; ties go as the order says (score, a, phrase in
byte order); an empty table gives an empty result; extra columns never enter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textvec as tv
from .common import materialize

MAX_WORDS = 3
SUPPORT = 10
CONTAINED_PERCENT = 50
TOP = 2000
SHARDS = 3
#: bytes of text that are split into words and hashed together
RUN_BYTES = 1 << 20
#: bytes of text whose phrases are sorted and counted together
CHUNK_BYTES = 6 << 20
#: bytes of text behind one hash bucket
BUCKET_BYTES = 24 << 20
#: bytes of text whose counted phrases a task holds before it sends them
HELD_BYTES = 24 << 20
#: bytes of text behind one hash bucket of the exact counts
COUNT_BUCKET_BYTES = 12 << 20
#: packed runs in one batch that a task sends
SENT_RUNS = 512
#: bytes of phrases in one Arrow array, whose offsets have 32 bits: only such strings are grouped fast
ARRAY_BYTES = 1 << 28
#: slices of a language that are ranked apart before the first of all are taken
SLICES = 64
MIN_FILTER_BITS, MAX_FILTER_BITS = 20, 30
#: bits of a phrase hash that mining keeps
HASH_BITS = 48

_U = np.uint64
PIECE_END = np.zeros(256, bool)
PIECE_END[[*map(ord, ".,;:!?"), *range(0x0A, 0x0E)]] = True
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09]] = True
GAP = PIECE_END | BLANK
#: bytes of words as they are, all others a space
SPACED = np.where(GAP, 0x20, np.arange(256)).astype(np.uint8)
CODE = np.where(GAP, _U(0), tv.mix(np.arange(1, 257, dtype=np.uint64)))


class Phrases:
    """Words of a run of texts and the hashes of their phrases within pieces."""

    def __init__(self, texts: pa.Array, langs: pa.Array, max_words: int):
        raw, offs = tv.utf8(texts)
        # tables are taken from: that is faster than indexing by bytes
        self.low = low = tv.LOWER.take(raw)
        n = len(low)
        self.solid = solid = ~GAP.take(low)
        begin, stop = solid.copy(), solid.copy()
        begin[1:] &= ~solid[:-1]
        stop[:-1] &= ~solid[1:]
        inner = offs[1:-1]
        first, last = inner[inner < n], inner[inner > 0] - 1
        begin[first], stop[last] = solid[first], solid[last]
        self.starts, self.ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        self.first = np.searchsorted(self.starts, offs)
        self.max_words = max_words
        coded = langs.dictionary_encode()
        self.langs = coded.dictionary.to_pylist()
        self.text_lang = coded.indices.to_numpy(zero_copy_only=False)
        self.lang = np.repeat(self.text_lang, np.diff(self.first))
        if not len(self.starts):
            self.words = np.zeros(0, _U)
            self.linked = np.zeros(0, bool)
            return
        pow_, inv = tv.powers(n)
        seed = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little")
                         for x in self.langs], _U)
        self.words = tv.mix(np.add.reduceat(CODE.take(low) * pow_, self.starts) * inv[self.starts]) ^ seed[self.lang]
        # a word is linked to the one before it in the same piece of the same text
        ends_before = np.concatenate(([0], np.cumsum(PIECE_END.take(low), dtype=np.int32)))[self.starts]
        text = np.repeat(np.arange(len(offs) - 1), np.diff(self.first))
        self.linked = np.zeros(len(self.starts), bool)
        self.linked[1:] = (ends_before[1:] == ends_before[:-1]) & (text[1:] == text[:-1])

    def lengths(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(words, first word of each phrase, hash of each phrase) for every length."""
        value, whole = self.words, np.ones(len(self.words), bool)
        for m in range(1, self.max_words + 1):
            if m > 1:
                size = len(self.words) - m + 1
                if size <= 0:
                    return
                whole = whole[:size] & self.linked[m - 1:]
                value = value[:size] * _U(0x9E3779B97F4A7C15) + self.words[m - 1:]
            at = np.flatnonzero(whole)
            yield m, at, tv.mix(value[at] + _U(m))

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes of the words with one byte between them, where each word begins and ends in these).

        The words of a phrase lie side by side, so its text is one slice.
        """
        kept = self.solid.copy()
        kept[self.ends[self.ends < len(kept)]] = True
        raw = SPACED.take(self.low[kept])
        begin = (np.cumsum(kept, dtype=np.int32) - 1)[self.starts]
        return raw, begin, begin + (self.ends - self.starts).astype(np.int32)


def slices(raw: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """raw[begin[i]:begin[i] + size[i]] for every i, one after the other."""
    size = size.astype(np.int64)
    before = np.cumsum(size) - size
    return raw.take(np.arange(size.sum()) + np.repeat(begin - before, size))


def nearly_sorted(keys: np.ndarray) -> np.ndarray:
    """An order by the high bits of ``keys`` (the low ones hold positions): sorting values is far cheaper than argsort.

    Equal keys can lie apart where others share their high bits.
    """
    low = _U((1 << max(1, len(keys).bit_length())) - 1)
    return (np.sort(keys & ~low | np.arange(len(keys), dtype=np.uint64)) & low).astype(np.int64)


def runs_of(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)


# ------------------------------------------------------------------- mining

def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys of HASH_BITS and small counts as byte planes, which compress well."""
    planes = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BITS // 8]
    return np.ascontiguousarray(planes.T).tobytes() + np.minimum(counts, 255).astype(np.uint8).tobytes()


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    width = HASH_BITS // 8
    planes = np.frombuffer(blob, np.uint8).reshape(width + 1, -1)
    keys = np.zeros((planes.shape[1], 8), np.uint8)
    keys[:, :width] = planes[:width].T
    return keys.view("<u8").ravel(), planes[width]


def _mine(bucket_bits: int, max_words: int, shards: int):
    """Texts to (shard, bucket, packed hashes and counts) of each run of texts."""

    def packed(hashes: list[np.ndarray], shard: int) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(hashes), return_counts=True)
        cuts = np.searchsorted(keys, np.arange(1 << bucket_bits, dtype=np.uint64) << _U(HASH_BITS - bucket_bits))
        cuts = np.append(cuts, len(keys))
        full = np.flatnonzero(np.diff(cuts))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(full), shard, np.int32)), pa.array(full.astype(np.int32)),
             pa.array([pack(keys[cuts[b]:cuts[b + 1]], counts[cuts[b]:cuts[b + 1]]) for b in full], pa.binary())],
            ["shard", "bucket", "run"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() % shards
        hashes, size = [], 0
        for part in tv.pieces(batches, max_bytes=RUN_BYTES):
            phrases = Phrases(tv.column(part, "text"), tv.column(part, "lang"), max_words)
            hashes += [h >> _U(64 - HASH_BITS) for _, _, h in phrases.lengths()]
            size += len(phrases.low)
            if size >= CHUNK_BYTES and hashes:
                yield packed(hashes, shard)
                hashes, size = [], 0
        if hashes:
            yield packed(hashes, shard)

    return tv.tidy(run)


def _frequent(bucket_bits: int, filter_bits: int, local_support: int):
    """One bucket to its slice of the candidate bitmap: the hashes that are frequent in some shard."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        bits, frequent = np.zeros(1 << (filter_bits - bucket_bits), bool), 0
        for _, shard in rows.groupby("shard"):
            # key and count in one number: sorting values is far cheaper than argsort
            both = np.concatenate([keys << _U(8) | counts for keys, counts in map(unpack, shard["run"])])
            both.sort()
            keys, counts = both >> _U(8), (both & _U(255)).astype(np.int32)
            first = runs_of(keys)
            kept = keys[first][np.add.reduceat(counts, first) >= local_support]
            slots = (kept >> _U(HASH_BITS - filter_bits)) & _U((1 << (filter_bits - bucket_bits)) - 1)
            bits[slots.astype(np.int64)] = True
            frequent += len(kept)
        return pd.DataFrame({"bucket": [int(rows["bucket"].iloc[0])], "bits": [np.packbits(bits, bitorder="little").tobytes()],
                             "frequent": [frequent]})

    return run


def candidates(docs: DataFrame, text_bytes: int, max_words: int, support: int, shards: int) -> tuple[np.ndarray, int]:
    """Bitmap of the phrases that are frequent in some shard, and its bits."""
    filter_bits = min(MAX_FILTER_BITS, max(MIN_FILTER_BITS, int(text_bytes // 8).bit_length()))
    bucket_bits = min(filter_bits - 6, max(3, int(text_bytes // BUCKET_BYTES).bit_length()))
    runs = docs.mapInArrow(_mine(bucket_bits, max_words, shards), "shard int, bucket int, run binary")
    mined = runs.groupBy("bucket").applyInPandas(
        _frequent(bucket_bits, filter_bits, -(-support // shards)), "bucket int, bits binary, frequent long")
    # one slice per bucket, 2**filter_bits bits in all
    union = np.zeros(1 << (filter_bits - 3), np.uint8)
    width = 1 << (filter_bits - bucket_bits - 3)
    for row in materialize(mined, "op11-candidates").toLocalIterator(prefetchPartitions=True):
        at = row["bucket"] * width
        union[at:at + width] = np.frombuffer(row["bits"], np.uint8)
    return union, filter_bits


# ----------------------------------------------------------------- counting

def planes(values: np.ndarray) -> bytes:
    """Numbers below 2**32 as byte planes, which compress well."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(blob: bytes, at: int, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8, 4 * n, at).reshape(4, n).T).view("<u4").ravel()


def pack_counts(counts: np.ndarray, sizes: np.ndarray, raw: bytes) -> bytes:
    """Counts, sizes and bytes of phrases of one language."""
    return len(counts).to_bytes(4, "little") + planes(counts) + planes(sizes) + raw


def unpack_counts(blob: bytes) -> tuple[np.ndarray, np.ndarray, bytes]:
    n = int.from_bytes(blob[:4], "little")
    return from_planes(blob, 4, n), from_planes(blob, 4 + 4 * n, n), blob[4 + 8 * n:]


class Held:
    """Counted phrases of a few runs of texts."""

    def __init__(self, bucket_bits: int):
        self.bucket_bits = bucket_bits
        self.codes: dict[str, int] = {}
        self.totals: dict[str, int] = {}
        self.raws: list[np.ndarray] = []
        #: hash, begin and size of the text, language of the phrases of the last runs of texts
        self.fresh: list[tuple[np.ndarray, ...]] = []
        #: the same with counts, each phrase of a chunk once
        self.found: list[tuple[np.ndarray, ...]] = []
        self.size = self.read = self.unsettled = 0

    def add(self, phrases: Phrases, hit: Callable[[np.ndarray], np.ndarray]) -> None:
        for lang, n in zip(phrases.langs, np.bincount(phrases.lang, minlength=len(phrases.langs)).tolist(), strict=True):
            self.totals[lang] = self.totals.get(lang, 0) + n
        code = np.array([self.codes.setdefault(x, len(self.codes)) for x in phrases.langs], np.int32)
        raw, begin, end = phrases.joined()
        for m, at, hashes in phrases.lengths():
            some = hit(hashes)
            at = at[some]
            self.fresh.append((hashes[some], begin[at].astype(np.uint32) + np.uint32(self.size),
                               (end[at + (m - 1)] - begin[at]).astype(np.uint32), code[phrases.lang[at]]))
        self.raws.append(raw)
        self.size += len(raw)
        self.read += len(phrases.low)
        self.unsettled += len(phrases.low)
        if self.unsettled >= CHUNK_BYTES:
            self.settle()

    def settle(self) -> None:
        """Each phrase of the last runs of texts once, with its count."""
        self.unsettled = 0
        if not any(len(x[0]) for x in self.fresh):
            self.fresh = []
            return
        keys, begin, size, lang = (np.concatenate(x) for x in zip(*self.fresh, strict=True))
        self.fresh = []
        order = nearly_sorted(keys)
        keys = keys[order]
        first = runs_of(keys)
        at = order[first]
        self.found.append((keys[first], np.diff(np.append(first, len(keys))).astype(np.uint32), begin[at], size[at], lang[at]))

    def send(self) -> Iterator[pa.RecordBatch]:
        """(bucket, language, packed phrases and counts) of all that is held, and the words of each language as its phrase without words."""
        yield self.batch([(0, lang, pack_counts(np.array([n]), np.array([0]), b"")) for lang, n in self.totals.items()])
        self.settle()
        if self.found:
            keys, counts, begin, size, lang = (np.concatenate(x) for x in zip(*self.found, strict=True))
            raw = np.concatenate(self.raws)
            self.found, self.raws = [], []
            order = nearly_sorted(keys)
            keys = keys[order]
            first = runs_of(keys)
            counts = np.add.reduceat(counts[order], first)
            keys, order = keys[first], order[first]
            bucket = keys >> _U(64 - self.bucket_bits) if self.bucket_bits else np.zeros(len(keys), _U)
            group = bucket.astype(np.int64) * len(self.codes) + lang[order]
            again = np.argsort(group, kind="stable")
            group, counts, order = group[again], counts[again], order[again]
            cuts = np.append(runs_of(group), len(group))
            begin, size = begin[order], size[order]
            names = list(self.codes)
            for a in range(0, len(cuts) - 1, SENT_RUNS):
                some = cuts[a:a + SENT_RUNS + 1]
                text = memoryview(slices(raw, begin[some[0]:some[-1]], size[some[0]:some[-1]]))
                offs = np.concatenate(([0], np.cumsum(size[some[0]:some[-1]], dtype=np.int64)))
                yield self.batch([(int(group[i]) // len(names), names[group[i] % len(names)],
                                   pack_counts(counts[i:j], size[i:j], bytes(text[offs[i - some[0]]:offs[j - some[0]]])))
                                  for i, j in zip(some[:-1].tolist(), some[1:].tolist(), strict=True)])

    @staticmethod
    def batch(rows: list[tuple[int, str, bytes]]) -> pa.RecordBatch:
        bucket, lang, run = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(lang, pa.string()), pa.array(run, pa.binary())],
                                          ["bucket", "lang", "run"])


def counted(batches: Iterator[pa.RecordBatch], hit: Callable[[np.ndarray], np.ndarray], bucket_bits: int,
            max_words: int) -> Iterator[pa.RecordBatch]:
    """Texts to packed counts of the phrases whose hashes ``hit`` points out."""
    held = Held(bucket_bits)
    for part in tv.pieces(batches, max_bytes=RUN_BYTES):
        held.add(Phrases(tv.column(part, "text"), tv.column(part, "lang"), max_words), hit)
        if held.read >= HELD_BYTES:
            yield from held.send()
            held = Held(bucket_bits)
    if held.totals:
        yield from held.send()


def _total(support: int) -> Callable[[pa.Table], pa.Table]:
    """One bucket of packed counts to its frequent phrases, added up by their text."""

    def run(rows: pa.Table) -> pa.Table:
        langs = rows["lang"].combine_chunks().dictionary_encode()
        tables, code, counts, sizes, raws = [], [], [], [], []
        for lang, blob in zip([*langs.indices.to_pylist(), None], chain(rows["run"], [None]), strict=True):
            if raws and (blob is None or sum(map(len, raws)) + len(blob.as_buffer()) > ARRAY_BYTES):
                offs = np.concatenate(([0], np.cumsum(np.concatenate(sizes), dtype=np.int32)), dtype=np.int32)
                phrase = pa.StringArray.from_buffers(len(offs) - 1, pa.py_buffer(offs), pa.py_buffer(b"".join(raws)))
                tables.append(pa.table({"code": np.repeat(np.array(code, np.int32), list(map(len, counts))), "phrase": phrase,
                                        "f": np.concatenate(counts).astype(np.int64)}))
                code, counts, sizes, raws = [], [], [], []
            if blob is not None:
                count, size, raw = unpack_counts(blob.as_py())
                code.append(lang), counts.append(count), sizes.append(size), raws.append(raw)
        found = pa.concat_tables(tables).group_by(["code", "phrase"], use_threads=False).aggregate([("f", "sum")])
        found = found.filter(pc.or_(pc.greater_equal(found["f_sum"], support), pc.equal(found["phrase"], "")))
        words = pc.if_else(pc.equal(found["phrase"], ""), 0, pc.add(pc.count_substring(found["phrase"], " "), 1))
        return pa.table({"lang": langs.dictionary.take(found["code"].combine_chunks()), "words": words.cast(pa.int32()),
                         "phrase": found["phrase"], "f": found["f_sum"]})

    return run


def exact_counts(docs: DataFrame, text_bytes: int, union: np.ndarray, filter_bits: int, max_words: int, support: int) -> DataFrame:
    """(lang, words, phrase, f) of every candidate with f >= support and the words of each language (words 0)."""
    shared = docs.sparkSession.sparkContext.broadcast(union)
    bucket_bits = min(16, int(text_bytes // COUNT_BUCKET_BYTES).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value

        def hit(hashes: np.ndarray) -> np.ndarray:
            slot = hashes >> _U(64 - filter_bits)
            return np.flatnonzero((bitmap[(slot >> _U(3)).astype(np.int64)] >> (slot & _U(7)).astype(np.uint8)) & 1)

        yield from counted(batches, hit, bucket_bits, max_words)

    return (docs.mapInArrow(tv.tidy(run), "bucket int, lang string, run binary")
            .groupBy("bucket").applyInArrow(_total(support), "lang string, words int, phrase string, f long"))


def frequent_phrases(docs: DataFrame, max_words: int = MAX_WORDS, support: int = SUPPORT,
                     shards: int = SHARDS) -> DataFrame:
    """(lang, words, phrase, f) of every phrase of 1 to ``max_words`` words with f >= support, and of each language (words 0)."""
    rows = docs.select(F.col("text").cast("string").alias("text"),
                       F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    union, filter_bits = candidates(rows, size, max_words, support, shards)
    return materialize(exact_counts(rows, size, union, filter_bits, max_words, support), "op11-frequent")


# ------------------------------------------------------------------ scoring

def scored_phrases(frequent: DataFrame) -> DataFrame:
    """(lang, words, phrase, a, l, r, score) of every phrase of two words or more, by its lowest-scoring cut."""
    part = frequent.where("words > 0").select("lang", "phrase", "f")
    cuts = (frequent.where("words >= 2").withColumnRenamed("f", "a")
            .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
            .withColumn("left", F.expr("substring_index(phrase, ' ', k)"))
            .withColumn("right", F.expr("substring_index(phrase, ' ', k - words)")))
    # every part of a frequent phrase is frequent; the phrase leads the keys, as a sort compares the first bytes of the first key
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["left", "lang"])
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["right", "lang"])
    a, left, right = (F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r"))
    cuts = cuts.withColumn("top", F.lit(1_000_000).cast("decimal(7,0)") * a * a).withColumn("bottom", left * right)
    cuts = cuts.withColumn("score", F.expr("top div bottom"))
    best = cuts.groupBy("phrase", "lang").agg(
        F.max("words").alias("words"), F.max("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return best.select("lang", "words", "phrase", "a", "best.l", "best.r", "best.score")


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, support: int = SUPPORT, top: int = TOP,
                 contained_percent: int = CONTAINED_PERCENT, shards: int = SHARDS) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    A phrase is dropped if a phrase one word longer that contains it has
    ``contained_percent`` of its occurrences; a longer one still that has so
    many contains such a phrase.
    """
    frequent = frequent_phrases(docs, max_words, support, shards)
    longer = frequent.where("words >= 3").select(
        "lang", F.col("f").alias("longest"),
        F.explode(F.array(F.expr("substring_index(phrase, ' ', words - 1)"),
                          F.expr("substring_index(phrase, ' ', 1 - words)"))).alias("phrase"))
    longer = longer.groupBy("phrase", "lang").agg(F.max("longest").alias("longest"))
    kept = (scored_phrases(frequent).join(longer, ["phrase", "lang"], "left")
            .where(F.col("longest").isNull() | (F.col("longest") * 100 < F.col("a") * contained_percent)))
    # the first ``top`` of a language are among the first ``top`` of its slices, which many tasks rank
    order = [F.desc("score"), F.desc("a"), "phrase"]
    kept = kept.withColumn("slice", F.crc32("phrase") % SLICES)
    first = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).where(F.col("rank") <= top)
    ranked = (first.drop("slice").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
              .where(F.col("rank") <= top))
    total = frequent.where("words = 0").select("lang", F.col("f").alias("n"))
    return (ranked.join(total, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
