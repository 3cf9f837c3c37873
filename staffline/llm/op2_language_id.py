"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language in one pass (partial counts per task, then
a shuffle of at most languages x buckets rows per task); the log-probability
matrix (languages x buckets, a fixed size) is broadcast; scoring is a narrow
pass that adds matrix rows per text in numpy.

Edge cases: a null text, or a text without any letter, gets ``und`` with score
0; rows whose language is null teach nothing (an empty one is a language); with no training row
every text gets ``und``; repeated rows are scored (and counted) each time; ties
go to the first language in sort order. Only ``doc_id`` and ``text`` enter a
prediction, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .common import fold

UNKNOWN = "und"
ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
#: bound of the broadcast matrix: labels x buckets float32
MAX_LANGUAGES = 512
CHUNK_CHARS = 1 << 19


def letter_table() -> np.ndarray:
    """Lower-cased letter of each code point, or a space."""
    if "letters" not in tv._TABLES:
        points = np.arange(0x110000, dtype=np.uint32)
        keep = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        tv._TABLES["letters"] = np.where(keep, points, 32).astype(np.uint32)
    return tv._TABLES["letters"]


def grams(texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Per order: bucket of each n-gram and first n-gram of each text; last, the letters of each text.

    Texts are lower-cased; everything but letters is a space; n-grams with two
    spaces side by side, or of one space alone, are left out.
    """
    lowered = [(t or "").lower() for t in texts]
    # a space on both sides: word borders count as characters
    sizes = np.fromiter((len(t) + 2 for t in lowered), np.int64, len(lowered))
    joined = "".join(f" {t} " for t in lowered)
    codes = letter_table()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.uint64)
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    blank = codes == 32
    letters = tv.segment_sums(~blank, bounds) if len(codes) else np.zeros(len(lowered), np.int64)
    spaced = np.zeros(len(codes), bool)
    spaced[:-1] = blank[:-1] & blank[1:]
    buckets, firsts = [], []
    value = np.zeros(len(codes), np.uint64)
    bad = blank.copy()
    for n in range(1, max(ORDERS) + 1):
        size = len(codes) - n + 1
        if size <= 0:
            buckets.append(np.zeros(0, np.int64))
            firsts.append(np.zeros(len(bounds), np.int64))
            continue
        value = value[:size] * np.uint64(0x100000001B3) + codes[n - 1:]
        if n == 2:
            bad = spaced[:size]
        elif n > 2:
            bad = bad[:size] | spaced[n - 2:n - 2 + size]
        if n not in ORDERS:
            continue
        at = np.flatnonzero(~bad[:size])
        hashed = ((value[at] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
        # neighbouring texts meet in two spaces, so no n-gram spans two texts
        buckets.append(hashed.astype(np.int64) % BUCKETS)
        firsts.append(np.searchsorted(at, bounds))
    return buckets, firsts, letters


def _runs(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= CHUNK_CHARS:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) rows to (lang, bucket, n) counts of the whole task; bucket -1 counts texts."""
    totals: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for batch in batches:
        langs = tv.column(batch, "lang").to_pylist()
        texts = tv.column(batch, "text").to_pylist()
        order = sorted(range(len(langs)), key=langs.__getitem__)
        langs, texts = [langs[i] for i in order], [texts[i] for i in order]
        for a, b in _runs(texts):
            buckets, firsts, _ = grams(texts[a:b])
            part = np.array(langs[a:b], object)
            cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1), b - a]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                lang = part[lo]
                total = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
                rows[lang] = rows.get(lang, 0) + hi - lo
                for got, first in zip(buckets, firsts, strict=True):
                    total += np.bincount(got[first[lo]:first[hi]], minlength=BUCKETS)
    for lang, total in totals.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * (len(at) + 1)), pa.array(np.append(at, -1)), pa.array(np.append(total[at], rows[lang]))],
            ["lang", "bucket", "n"])


class Model:
    """Languages in sort order, log probabilities (buckets x languages), log priors."""

    def __init__(self, languages: list[str], matrix: np.ndarray, prior: np.ndarray):
        self.languages, self.matrix, self.prior = languages, matrix, prior


def fit(texts: DataFrame, smoothing: float = 0.1) -> Model:
    """Learn from (lang, text) rows."""
    rows = texts.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    counts = rows.mapInArrow(tv.tidy(count_grams), "lang string, bucket long, n long")
    per_language = (counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
                    .groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("cells")))
    languages, tables, texts_seen = [], [], []
    # one row per language, each of at most BUCKETS + 1 cells
    for row in per_language.orderBy("lang").limit(MAX_LANGUAGES + 1).toLocalIterator():
        languages.append(row["lang"])
        table = np.zeros(BUCKETS, np.float64)
        seen = 0
        for bucket, n in row["cells"]:
            if bucket < 0:
                seen = n
            else:
                table[bucket] = n
        tables.append(np.log((table + smoothing) / (table.sum() + smoothing * BUCKETS)))
        texts_seen.append(seen)
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} distinct languages: the matrix would not be bounded")
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    prior = np.log((np.array(texts_seen, float) + 1) / (sum(texts_seen) + len(languages)))
    return Model(languages, np.stack(tables, 1).astype(np.float32), prior)


def score_texts(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Most likely language and its posterior for each text."""
    out: list[str] = []
    scores = np.zeros(len(texts))
    for a, b in _runs(texts):
        buckets, firsts, letters = grams(texts[a:b])
        if not model.languages:
            out += [UNKNOWN] * (b - a)
            continue
        total = np.tile(model.prior, (b - a, 1))
        for got, first in zip(buckets, firsts, strict=True):
            for k in range(len(model.languages)):
                total[:, k] += tv.segment_sums(np.take(model.matrix[:, k], got).astype(np.float64), first)
        best = total.argmax(1)
        posterior = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        known = letters > 0
        out += [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)]
        scores[a:b] = np.where(known, posterior, 0.0)
    return out, scores


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id", "held_out"), text: str = "text") -> DataFrame:
    """The columns ``keep`` of every row with lang_pred and score (which replace columns so named)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    keep = tuple(c for c in keep if c not in ("lang_pred", "score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        m.matrix = np.asfortranarray(m.matrix)
        for batch in tv.pieces(batches, text, 4 << 20):
            langs, scores = score_texts(tv.column(batch, text).to_pylist(), m)
            yield pa.RecordBatch.from_arrays(
                [*(tv.column(batch, c) for c in keep), pa.array(langs, pa.string()), pa.array(scores)],
                [*keep, "lang_pred", "score"])

    rows = docs.select(*keep, *([text] if text not in keep else []))
    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(tv.tidy(run), schema)


def training_texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))


def drop_unknown(docs: DataFrame, least_score: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (all columns) in one of the learnt languages with at least ``least_score``."""
    model = fit(training_texts(docs.where(F.coalesce(fold(F.col("doc_id"), 4) != 2, F.lit(True)))))
    names = [f"c{k}" for k in range(len(docs.columns))]
    text = names[docs.columns.index("text")]
    kept = predict(docs.toDF(*names).withColumn(text, F.col(text).cast("string")), model, tuple(names), text)
    return (kept.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score))
            .drop("lang_pred", "score").toDF(*docs.columns))


def identify(docs: DataFrame, held_out: Column | None = None) -> DataFrame:
    """Learn from the rows that are not held out, predict all rows.

    ``docs`` has doc_id, text and lang; ``held_out`` defaults to crc32(doc_id) mod 4 = 2.
    """
    held = fold(F.col("doc_id"), 4) == 2 if held_out is None else held_out
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"), F.coalesce(held, F.lit(False)).alias("held_out"))
    model = fit(rows.where(~F.col("held_out")))
    return predict(rows, model)
