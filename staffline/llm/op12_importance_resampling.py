"""Importance resampling towards a target distribution, with segment deduplication.

Features are hashed word n-grams: words are the runs of ASCII digits, letters
(A-Z lower-cased) and non-ASCII characters, an n-gram is 1 to ``max_n``
consecutive words of a text joined by one space, its bucket the crc32 of those
bytes modulo ``buckets``. Both passes over the corpus cut texts into lines at
newlines (a separator of words, so no word spans two lines). The distinct lines
of a run of texts are found once (Arrow dictionary), their n-grams are hashed
and counted once, and the counts are multiplied by the lines' occurrences;
n-grams that cross lines are added separately, text by text.

1. bucket counts of the corpus and of the target: fixed-size count vectors per
   task, summed by bucket (at most ``buckets`` rows per task are shuffled);
2. gains per bucket (``buckets`` integers, broadcast), then each text's weight
   in a narrow pass;
3. Gumbel noise from a hash of the id gives the score; the draw is an exact
   global top-k by a histogram of the integer scores (a score lies within a
   range given by the formula, so it has a bounded number of rows) and a rank
   inside each score.

Edge cases: null and empty texts have no features, weight 0 and are never
drawn when ``min_words`` is positive; a null id counts as empty text in the
hash and sorts after all ids; rows that repeat an id are ranked side by side
(score, id, then n_features and weight); with an empty target every target
count is 0; an empty corpus gives an empty result; extra columns never enter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textvec as tv
from .common import documents, materialize

BUCKETS = 10_000
SEED = 2024
MAX_N = 1
MIN_WORDS = 20
PERCENT = 10
CHUNK_BYTES = 4 << 20
#: words of more bytes than this are hashed one by one
LONG_WORD = 48

#: bytes that belong to a word [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


CRC = _crc_table()


def crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unsigned crc32 of data[starts[i]:ends[i]] for every i, byte position by byte position."""
    out = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    size = ends - starts
    order = np.argsort(-np.minimum(size, LONG_WORD + 1), kind="stable")
    ranked = -size[order]
    longest = int(min(size.max(initial=0), LONG_WORD))
    at, crc = starts[order], out[order]
    for k in range(longest):
        live = int(np.searchsorted(np.maximum(ranked, -LONG_WORD - 1), -k, "left"))
        crc[:live] = CRC[(crc[:live] ^ data[at[:live] + k]) & 0xFF] ^ (crc[:live] >> 8)
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = zlib.crc32(data[starts[i]:ends[i]].tobytes())
    return out


class Lines:
    """The distinct lines of a run of texts: their words and in-line n-grams, and which text holds which line.

    ``line`` is the distinct line of every line occurrence, ``text`` the text of it, in order.
    ``feature``/``owner``: bucket and distinct line of every in-line n-gram.
    ``crossing``/``holder``: bucket and text of every n-gram over two or more lines.
    """

    def __init__(self, texts: pa.Array, max_n: int, buckets: int):
        cut = pc.split_pattern(pc.fill_null(texts.cast(pa.large_string()), ""), "\n")
        self.text = pc.list_parent_indices(cut).to_numpy(zero_copy_only=False)
        coded = pc.list_flatten(cut).dictionary_encode()
        self.line = coded.indices.to_numpy(zero_copy_only=False)
        raw, offs = tv.utf8(coded.dictionary)
        self.lines = len(offs) - 1
        self.texts = len(texts)
        self._words(raw, offs)
        parts = [(self._bucket(self.starts, self.ends, buckets), self.word_line)]
        for n in range(2, max_n + 1):
            first = np.flatnonzero(self.word_line[n - 1:] == self.word_line[:len(self.word_line) - n + 1]) \
                if len(self.word_line) >= n else np.zeros(0, np.int64)
            parts.append((self._grams(first[:, None] + np.arange(n), buckets), self.word_line[first]))
        self.feature = np.concatenate([p[0] for p in parts])
        self.owner = np.concatenate([p[1] for p in parts])
        self._cross(max_n, buckets)

    def _words(self, raw: np.ndarray, offs: np.ndarray) -> None:
        self.low = low = tv.LOWER[raw]
        solid = WORD[low]
        begin, stop = solid.copy(), solid.copy()
        begin[1:] &= ~solid[:-1]
        stop[:-1] &= ~solid[1:]
        inner = offs[1:-1]
        first, last = inner[inner < len(low)], inner[inner > 0] - 1
        begin[first], stop[last] = solid[first], solid[last]
        self.starts, self.ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        self.first_word = np.searchsorted(self.starts, offs)
        self.word_line = np.repeat(np.arange(len(offs) - 1), np.diff(self.first_word))

    def _bucket(self, starts: np.ndarray, ends: np.ndarray, buckets: int) -> np.ndarray:
        return crc32(self.low, starts, ends).astype(np.int64) % buckets

    def _grams(self, words: np.ndarray, buckets: int) -> np.ndarray:
        """Buckets of word sequences (rows of word positions), joined by one space."""
        out = np.zeros(len(words), np.int64)
        for i, row in enumerate(words):
            joined = b" ".join(self.low[self.starts[w]:self.ends[w]].tobytes() for w in row)
            out[i] = zlib.crc32(joined) % buckets
        return out

    def _cross(self, max_n: int, buckets: int) -> None:
        """N-grams whose first and last word stand in different lines of a text."""
        self.crossing, self.holder = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if max_n < 2 or not len(self.starts):
            return
        count = np.diff(self.first_word)[self.line]
        occurrence = np.repeat(np.arange(len(self.line)), count)
        inside = np.arange(len(occurrence)) - np.repeat(np.cumsum(count) - count, count)
        word, text = self.first_word[self.line][occurrence] + inside, self.text[occurrence]
        found, holders = [], []
        for n in range(2, max_n + 1):
            last = len(word) - n + 1
            if last <= 0:
                break
            at = np.flatnonzero((text[:last] == text[n - 1:]) & (occurrence[:last] != occurrence[n - 1:]))
            found.append(self._grams(word[at[:, None] + np.arange(n)], buckets))
            holders.append(text[at])
        self.crossing, self.holder = np.concatenate(found), np.concatenate(holders)

    def totals(self, buckets: int) -> np.ndarray:
        """Features per bucket: those of each distinct line times its occurrences, and those across lines."""
        times = np.bincount(self.line, minlength=self.lines)
        return (np.bincount(self.feature, times[self.owner], minlength=buckets).astype(np.int64)
                + np.bincount(self.crossing, minlength=buckets))

    def per_text(self, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words, features, sum of gains) of every text, exact in 64-bit integers."""
        words = np.diff(self.first_word)
        features = np.bincount(self.owner, minlength=self.lines)
        # sums of integers far below 2**53: exact in doubles
        line_gain = np.bincount(self.owner, gains[self.feature], minlength=self.lines)
        text_gain = (np.bincount(self.text, line_gain[self.line], minlength=self.texts)
                     + np.bincount(self.holder, gains[self.crossing], minlength=self.texts)).astype(np.int64)
        n_words = np.bincount(self.text, words[self.line], minlength=self.texts).astype(np.int64)
        n_features = np.bincount(self.text, features[self.line], minlength=self.texts).astype(np.int64)
        return n_words, n_features + np.bincount(self.holder, minlength=self.texts), text_gain


def bucket_counts(texts: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of all texts; map-side vectors of ``buckets`` counts, summed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in tv.pieces(batches, max_bytes=CHUNK_BYTES):
            total += Lines(tv.column(part, "text"), max_n, buckets).totals(buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    return (texts.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def _vector(counts: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, np.int64)
    for row in counts.collect():  # at most ``buckets`` rows
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))), in doubles."""
    size = float(len(corpus))
    ratio = ((target + 1.0) * (float(corpus.sum()) + size)) / ((corpus + 1.0) * (float(target.sum()) + size))
    return np.floor(1000.0 * np.log(ratio)).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, max_n: int = MAX_N) -> DataFrame:
    """doc_id, n_words, n_features, weight of every row, in a narrow pass."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tv.pieces(batches, max_bytes=CHUNK_BYTES):
            words, features, total = Lines(tv.column(part, "text"), max_n, buckets).per_text(shared.value)
            mean = np.floor_divide(total, np.maximum(features, 1))
            yield pa.RecordBatch.from_arrays([tv.column(part, "doc_id"), *map(pa.array, (words, features, mean))],
                                             ["doc_id", "n_words", "n_features", "weight"])

    return documents(docs).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 * Gumbel) from the first 32 bits of sha256("<seed>:<doc_id>")."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def draw(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``scored`` with ``rank``: the highest floor(percent*N/100) scores of the N rows of enough words.

    A histogram of the scores fixes how many rows stand before each score; the
    rows of one score are then ranked among themselves. A score is an integer
    within (range of gains) + (range of the noise, -3,102 to 22,873), so the
    histogram is bounded whatever the corpus; the noise spreads even equal
    texts over some thousands of scores.
    """
    scored = materialize(scored, "op12-scored")
    able = scored.where(F.col("n_words") >= min_words)
    steps = able.groupBy("score").agg(F.count("*").alias("here"))
    before = F.coalesce(F.sum("here").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0))
    steps = steps.withColumn("before", before)
    quota = able.agg(F.count("*").alias("n")).first()["n"] * percent // 100
    steps = steps.where(F.col("before") < quota).select("score", "before")
    within = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "weight")
    drawn = (able.join(F.broadcast(steps), "score").withColumn("rank", F.col("before") + F.row_number().over(within))
             .withColumn("rank", F.when(F.col("rank") <= quota, F.col("rank"))).drop("before"))
    # the rows that no drawn score can reach keep no rank
    least = steps.agg(F.min("score").alias("least")).first()["least"]
    reached = (F.col("n_words") >= min_words) & (F.col("score") >= F.lit(least).cast("long"))
    rest = scored.where(~F.coalesce(reached, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return drawn.select(*scored.columns, "rank").unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS, seed: int = SEED,
             percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every row of ``docs``; ``target`` has a column text."""
    corpus = _vector(bucket_counts(docs, max_n, buckets), buckets)
    wanted = _vector(bucket_counts(target, max_n, buckets), buckets)
    scored = weights(docs, gains(corpus, wanted), max_n)
    return draw(scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), percent, min_words)
