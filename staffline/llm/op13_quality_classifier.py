"""Quality classifier: hashed word n-gram logistic regression learnt by FTRL.

A token is a run of letters, digits and non-ASCII characters, or a run of other
signs; case is kept, and a word equal to the word token before it becomes a
repeat mark. Features are runs of 1 to 2 tokens, hashed to ``2**FEATURE_BITS``
weights, valued log(1 + count) and scaled to unit length per text.

Training follows the regularised leader (FTRL-proximal: per-coordinate rates, L1
and L2). The labelled texts are dealt to ``SHARDS`` partitions; each task passes
once over its rows, in hash order, from the common state (z, n) and returns its
state; the driver adds up the shards' changes, as if their gradients had
arrived late, and the next pass starts there. A state is 2 x 2**FEATURE_BITS
doubles, whatever the corpus. Scoring is a narrow pass: a sparse dot product per
text with the broadcast weights.

Bound of the fit: about ``MAX_TRAIN_ROWS`` distinct labelled (id, text) pairs,
chosen by a hash threshold (all of them while there are fewer).

Edge cases: null and empty texts have the constant alone; null labels are left
out, labels without a document teach nothing, several labels of one id count as
quality 1 only if all do; equal (id, text) rows teach once and are scored each
time; with one class only (or none) every score is the share of label 1, 0.5
when there is no label; extra columns never enter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .common import documents, fold, materialize

FEATURE_BITS = 18
MAX_TRAIN_ROWS = 20_000
SHARDS = 4
PASSES = 6
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
CHUNK_BYTES = 2 << 20

_U = np.uint64
SIZE = 1 << FEATURE_BITS
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True
#: one random value per byte, so that a token's hash follows its bytes; white space counts nothing
CODE = np.where(tv.SPACE, _U(0), tv.mix(np.arange(1, 257, dtype=np.uint64)))
REPEAT = _U(0x5BD1E995)


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value) of the distinct features of a run of texts, values of unit length per text."""
    raw, offs = tv.utf8(column)
    n = len(raw)
    solid, word = ~tv.SPACE[raw], WORD[raw]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1] | (word[1:] != word[:-1])
    edge = offs[1:-1]
    edge = edge[edge < n]
    begin[edge] = solid[edge]
    starts = np.flatnonzero(begin)
    first = np.searchsorted(starts, offs)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    # bytes between two token starts are the token and white space, which counts nothing
    pow_, inv = tv.powers(n)
    token = tv.mix(np.add.reduceat(CODE[raw] * pow_, starts) * inv[starts])
    text = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    is_word = word[starts]
    same = np.zeros(len(starts), bool)
    same[1:] = is_word[1:] & (token[1:] == token[:-1]) & (text[1:] == text[:-1])
    token = np.where(same, REPEAT, token)
    shift = _U(64 - FEATURE_BITS)
    one = (tv.mix(token) >> shift).astype(np.int64)
    pair = np.flatnonzero(text[1:] == text[:-1])
    two = (tv.mix(token[pair] * _U(0x9E3779B97F4A7C15) + token[pair + 1]) >> shift).astype(np.int64)
    keys, counts = np.unique(np.concatenate([(text << FEATURE_BITS) | one, (text[pair] << FEATURE_BITS) | two]),
                             return_counts=True)
    owner, value = keys >> FEATURE_BITS, np.log1p(counts)
    length = np.sqrt(np.bincount(owner, value * value, minlength=len(offs) - 1))
    return owner, keys & (SIZE - 1), value / length[owner]


class Ftrl:
    """FTRL-proximal logistic regression; the last coordinate is the constant."""

    def __init__(self, z: np.ndarray | None = None, n: np.ndarray | None = None):
        self.z = np.zeros(SIZE + 1) if z is None else z.copy()
        self.n = np.zeros(SIZE + 1) if n is None else n.copy()

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def update(self, at: np.ndarray, x: np.ndarray, y: float) -> None:
        w, n = self.weights(at), self.n[at]
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def learn_batch(model: Ftrl, column: pa.Array, labels: np.ndarray) -> None:
    owner, feature, value = features(column)
    cuts = np.searchsorted(owner, np.arange(len(column) + 1))
    for i, y in enumerate(labels):
        at, x = feature[cuts[i]:cuts[i + 1]], value[cuts[i]:cuts[i + 1]]
        model.update(np.append(at, SIZE), np.append(x, 1.0), y)


def score_batch(weights: np.ndarray, column: pa.Array) -> np.ndarray:
    owner, feature, value = features(column)
    total = np.bincount(owner, weights[feature] * value, minlength=len(column)) + weights[SIZE]
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """About ``max_rows`` distinct labelled (doc_id, text, quality) outside the held-out fold."""
    marks = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), 3) != 1))
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.col("quality").cast("int")).alias("quality")))
    digest = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
    pairs = documents(docs).select("doc_id", digest.alias("digest")).join(marks, "doc_id").distinct()
    pairs = materialize(pairs, "op13-pairs")
    share = min(1.0, max_rows / max(1, pairs.count()))
    picked = pairs.where(F.pmod(F.xxhash64("digest"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # about max_rows ids: bounded by the parameter
    texts = documents(docs).withColumn("digest", digest).join(F.broadcast(picked), ["doc_id", "digest"])
    # equal (id, text) rows teach once
    return materialize(texts.groupBy("doc_id", "digest", "quality").agg(F.first("text").alias("text")), "op13-train")


def _pass(rows: DataFrame, state: Ftrl, shards: int) -> Ftrl:
    shared = rows.sparkSession.sparkContext.broadcast((state.z, state.n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, shard = Ftrl(*shared.value), None
        for part in tv.pieces(batches, max_bytes=CHUNK_BYTES):
            shard = tv.column(part, "shard")[0].as_py()
            learn_batch(model, tv.column(part, "text"), np.array(tv.column(part, "quality").to_pylist(), float))
        if shard is not None:
            z, n = shared.value
            at = np.flatnonzero((model.z != z) | (model.n != n))
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([at.astype(np.int32).tobytes()]),
                 pa.array([(model.z - z)[at].tobytes()]), pa.array([(model.n - n)[at].tobytes()])],
                ["shard", "at", "z", "n"])

    ordered = (rows.repartition(shards, "shard").sortWithinPartitions("shard", F.xxhash64("digest"), "doc_id")
               .select("shard", "text", "quality"))
    out = Ftrl(state.z, state.n)
    # one row per task at most, each of at most 2**FEATURE_BITS + 1 coordinates
    for r in sorted(ordered.mapInArrow(run, "shard int, at binary, z binary, n binary").collect(), key=lambda r: r["shard"]):
        at = np.frombuffer(r["at"], np.int32)
        out.z[at] += np.frombuffer(r["z"])
        out.n[at] += np.frombuffer(r["n"])
    shared.destroy()
    return out


def fit(docs: DataFrame, labels: DataFrame, shards: int = SHARDS, passes: int = PASSES) -> np.ndarray:
    """Weights (the constant last), learnt from the labelled rows outside the held-out fold."""
    rows = training_rows(docs, labels).withColumn("shard", F.pmod(F.xxhash64("digest", F.lit(1)), F.lit(shards)).cast("int"))
    seen = {r["quality"]: r["n"] for r in rows.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(seen) < 2:
        out = np.zeros(SIZE + 1)
        out[SIZE] = {None: 0.0, 0: -35.0, 1: 35.0}[next(iter(seen), None)]
        return out
    state = Ftrl()
    for _ in range(passes):
        state = _pass(rows, state, shards)
    return state.weights()


def predict(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, held_out, score, predicted of every row (doc_id, text, held_out) in a narrow pass."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tv.pieces(batches, max_bytes=CHUNK_BYTES):
            score = score_batch(shared.value, tv.column(part, "text"))
            yield pa.RecordBatch.from_arrays(
                [tv.column(part, "doc_id"), tv.column(part, "held_out"), pa.array(score),
                 pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()),
                           T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.select("doc_id", "text", "held_out").mapInArrow(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labelled rows outside the fold crc32(doc_id) mod 3 = 1, score all rows."""
    weights = fit(docs, labels.select("doc_id", "quality"))
    return predict(documents(docs).withColumn("held_out", fold(F.col("doc_id"), 3) == 1), weights)
