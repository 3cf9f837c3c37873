"""Toxicity with a noisy-channel deobfuscation step.

A character language model (up to four characters, hashed counts of fixed size)
is counted over all texts; a classifier over word features is learnt from a
bounded sample of labelled rows (at most ``MAX_TRAIN_ROWS`` rows; features are
hashed, so at most ``2**FEATURE_BITS`` hold evidence). Every whole text is
then scored in one narrow pass: tokens that can hide a word (leetspeak signs
between letters, letters spaced out or joined by separators, a letter three
times in a row) become a character lattice that a Viterbi search restores under
the language model and the channel costs; all other tokens have a lattice of
one path and stay as they are. Word features of the restored text (whole word
and word beginnings, hashed) carry learnt evidence, which a logistic model
turns into the score.

Edge cases: null and empty texts have no evidence and get the base score;
labels that are null are left out, several labels of one document count as
toxic if one does; without training rows (or with one class only) every score
is the share of toxic rows, 0 when there is none; repeated rows are scored each
time; extra columns never enter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .common import documents, fold, materialize

#: bounds of the model and of the labelled rows it is fitted on (documented parameters)
MAX_TRAIN_ROWS = 20_000
#: the character model: cells of each of two hash functions, cells of a shuffled block, least count of a seen gram
GRAM_BITS = 20
GRAM_BLOCK = 1 << 14
GRAM_STEP = 0x100000001B3
GRAM_HASHES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
LEAST_COUNT = 2
FEATURE_BITS = 20
PREFIXES = (4, 5, 6, 8)

#: letters a sign can stand for
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
SEPARATORS = " .-_*"
#: channel costs in nats
COST_SIGN = 0.7
COST_SIGN_KEPT = 1.5
COST_JOIN = 0.4
COST_COLLAPSE = 0.5

_U = np.uint64
LETTER = np.zeros(256, bool)
LETTER[97:123] = True
LETTER[128:] = True
SIGN = np.zeros(256, bool)
SIGN[[ord(c) for c in LEET if ord(c) < 128]] = True
TAIL_SIGN = np.zeros(256, bool)
TAIL_SIGN[[*range(48, 58), ord("@")]] = True
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[ord(c) for c in SEPARATORS if c != " "]] = True


# ---------------------------------------------------------------- restoring

def letter_units() -> np.ndarray:
    """UTF-16 units that are letters stand for themselves, all others for a space."""
    if "units" not in tv._TABLES:
        keep = np.fromiter((chr(c).isalpha() for c in range(65536)), bool, 65536)
        tv._TABLES["units"] = np.where(keep, np.arange(65536, dtype=np.uint64), _U(32))
    return tv._TABLES["units"]


class CharModel:
    """Back-off character model over hashed grams of 1 to 4 characters.

    ``counts`` has a row of 2**GRAM_BITS counts for each of two hash functions;
    a gram's count is the smaller of its two cells, and counts below LEAST_COUNT
    are none, so that a gram that only shares cells with others stays unseen.
    A dict of gram counts is accepted as well.
    """

    BACKOFF = math.log(0.4)

    def __init__(self, counts: np.ndarray | dict[str, int]):
        if isinstance(counts, dict):
            given, counts = counts, np.zeros((2, 1 << GRAM_BITS), np.int64)
            for gram, n in given.items():
                counts[[0, 1], self.cells(gram)] += n
                if len(gram) == 1:
                    counts[[0, 1], self.cells("")] += n
        self.counts = counts
        self.total = max(self.count(""), 1)
        self.floor = -math.log(self.total + 256.0)
        self._memo: dict[str, float] = {}

    @staticmethod
    def cells(gram: str) -> list[int]:
        value = 0
        for c in gram:
            value = (value * GRAM_STEP + (ord(c) if c.isalpha() and ord(c) < 65536 else 32)) & (2**64 - 1)
        return [((value + len(gram)) * f & (2**64 - 1)) >> (64 - GRAM_BITS) for f in GRAM_HASHES]

    def count(self, gram: str) -> int:
        n = int(min(self.counts[k, c] for k, c in enumerate(self.cells(gram))))
        return n if n >= LEAST_COUNT else 0

    def cost(self, context: str, char: str) -> float:
        key = context + char
        found = self._memo.get(key)
        if found is None:
            if len(self._memo) > 200_000:
                self._memo.clear()
            found = self._memo[key] = self._cost(context, char)
        return found

    def _cost(self, context: str, char: str) -> float:
        penalty = 0.0
        for k in range(len(context) + 1):
            n = self.count(context[k:] + char)
            if n:
                return -(math.log(n / max(n, self.count(context[k:]) or self.total)) + penalty)
            penalty += self.BACKOFF
        return -(self.floor + penalty)


def lattice(span: str) -> list[list[tuple[str, float, int]]]:
    """Edges (restored characters, channel cost, next position) leaving each position."""
    out: list[list[tuple[str, float, int]]] = []
    n = len(span)
    single = [i for i in range(n) if span[i] not in SEPARATORS]
    # end of the run of one character that each position stands in
    ends = list(range(1, n + 1))
    for i in range(n - 2, -1, -1):
        if span[i] == span[i + 1]:
            ends[i] = ends[i + 1]
    alone = {i for i in single if (i == 0 or span[i - 1] in SEPARATORS) and (i + 1 == n or span[i + 1] in SEPARATORS)}
    for i, c in enumerate(span):
        edges = []
        if c in LEET:
            edges.append((c, COST_SIGN_KEPT, i + 1))
            edges += [(x, COST_SIGN, i + 1) for x in LEET[c]]
        elif c in SEPARATORS:
            edges.append((" ", 0.0, i + 1))
            if i - 1 in alone and i + 1 in alone:
                edges.append(("", COST_JOIN, i + 1))
        else:
            edges.append((c, 0.0, i + 1))
            if (i == 0 or span[i - 1] != c) and ends[i] - i >= 3 and c.isalpha():
                edges += [(c, COST_COLLAPSE, ends[i]), (c + c, COST_COLLAPSE, ends[i])]
        out.append(edges)
    return out


def restore(span: str, model: CharModel) -> str:
    """The cheapest path through the lattice of a span under the character model."""
    edges = lattice(span)
    # per position: last three characters -> (cost, end of the back chain)
    states: list[dict[str, tuple[float, tuple | None]]] = [{} for _ in range(len(span) + 1)]
    states[0] = {" ": (0.0, None)}
    for i, leaving in enumerate(edges):
        for context, (cost, chain) in states[i].items():
            for text, channel, to in leaving:
                total, last = cost + channel, context
                for c in text:
                    total += model.cost(last, c)
                    last = (last + c)[-3:]
                old = states[to].get(last)
                if old is None or total < old[0]:
                    states[to][last] = (total, (chain, text))
        states[i] = {}
    best = min(((cost + model.cost(last, " "), chain) for last, (cost, chain) in states[-1].items()),
               key=lambda x: x[0])[1]
    parts = []
    while best is not None:
        best, text = best
        parts.append(text)
    return "".join(reversed(parts))


def lower_bytes(raw: np.ndarray) -> np.ndarray:
    """Lower-case A-Z and the Latin letters of U+00C0..U+00DE."""
    low = tv.LOWER[raw]
    at = np.flatnonzero(low[:-1] == 0xC3) + 1
    up = at[(low[at] >= 0x80) & (low[at] <= 0x9E) & (low[at] != 0x97)]
    low[up] += 0x20
    return low


def suspicious(words: tv.Words) -> np.ndarray:
    """(start, end, text) byte spans that can hide a word."""
    low, n = words.low, len(words.low)
    if n < 2 or not len(words.starts):
        return np.zeros((0, 3), np.int64)
    letter, sign = LETTER[low], SIGN[low]
    flag = np.zeros(n, bool)
    flag[:-1] = (sign[:-1] & letter[1:]) | (letter[:-1] & TAIL_SIGN[low[1:]])
    if n >= 3:
        flag[:-2] |= letter[:-2] & (low[:-2] < 128) & (low[:-2] == low[1:-1]) & (low[1:-1] == low[2:])
    if n >= 5:
        between = SEPARATOR[low]
        flag[:-4] |= letter[:-4] & between[1:-3] & letter[2:-2] & between[3:-1] & letter[4:]
    # a mark only counts when what it compares lies in one word, within one text
    size = words.ends - words.starts
    hit = np.zeros(len(words.starts), bool)
    at = np.flatnonzero(flag)
    word = np.searchsorted(words.starts, at, "right") - 1
    ok = word >= 0
    at, word = at[ok], word[ok]
    inside = at + 1 < words.ends[word]
    hit[word[inside]] = True
    solid = (letter | sign)[words.starts]
    wide = (low[words.starts] >= 0xC0) & (size == 2)
    lone = solid & ((size == 1) | wide)
    owner = words.owner()
    spans = [np.stack([words.starts[hit], words.ends[hit], owner[hit]], 1)]
    if lone.any():
        edge = np.flatnonzero(np.diff(np.concatenate(([0], lone.view(np.int8), [0]))))
        for a, b in zip(edge[::2], edge[1::2], strict=True):
            # runs of lone characters, cut where texts meet
            cuts = [a, *(a + 1 + np.flatnonzero(np.diff(owner[a:b]))), b]
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                if y - x >= 4:
                    spans.append(np.array([[words.starts[x], words.ends[y - 1], owner[x]]]))
    return np.concatenate(spans).astype(np.int64)


# ----------------------------------------------------------------- features

def word_features(low: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of each word, first word of each text); words are runs of letters, -1 is no feature."""
    n = len(low)
    letter = LETTER[low]
    begin = letter.copy()
    begin[1:] &= ~letter[:-1]
    stop = letter.copy()
    stop[:-1] &= ~letter[1:]
    inner = offs[1:-1]
    first, last = inner[inner < n], inner[inner > 0] - 1
    begin[first], stop[last] = letter[first], letter[last]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    out = np.full((len(starts), 1 + len(PREFIXES)), -1, np.int64)
    if len(starts):
        pow_, inv = tv.powers(n)
        sums = np.zeros(n + 1, _U)
        np.cumsum(tv.BYTE_CODE[low] * pow_, out=sums[1:])
        shift = _U(64 - FEATURE_BITS)
        out[:, 0] = tv.mix((sums[ends] - sums[starts]) * inv[starts]) >> shift
        for k, m in enumerate(PREFIXES):
            long = np.flatnonzero(ends - starts >= m)
            at = starts[long]
            out[long, k + 1] = tv.mix((sums[at + m] - sums[at]) * inv[at] + _U(m)) >> shift
    return out, np.searchsorted(starts, offs)


def restored_features(batch: pa.RecordBatch, model: CharModel | None,
                      cache: dict[str, str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of each word and the text it is in, after restoring suspicious spans."""
    raw, offs = tv.utf8(tv.column(batch, "text"))
    low = lower_bytes(raw)
    extra: list[str] = []
    owner: list[int] = []
    if model is not None:
        for a, b, text in suspicious(tv.Words(low, offs)):
            span = low[a:b].tobytes().decode("utf-8", "replace")
            if span not in cache:
                if len(cache) > 100_000:
                    cache.clear()
                cache[span] = restore(span, model)
            extra.append(cache[span])
            owner.append(int(text))
            low[a:b] = 32
    features, first = word_features(low, offs)
    texts = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    if extra:
        coded = [x.encode() for x in extra]
        sizes = np.concatenate(([0], np.cumsum([len(x) for x in coded])))
        more, at = word_features(lower_bytes(np.frombuffer(b"".join(coded), np.uint8)), sizes)
        features = np.concatenate([features, more])
        texts = np.concatenate([texts, np.repeat(np.array(owner), np.diff(at))])
    return features, texts


def evidence(batch: pa.RecordBatch, weights: np.ndarray, model: CharModel | None, cache: dict[str, str]) -> np.ndarray:
    """Per text: largest word evidence, log of their sum, log of words with evidence, their share."""
    n = batch.num_rows
    features, texts = restored_features(batch, model, cache)
    value = weights[features].max(1) if len(features) else np.zeros(0)
    hit = value > 0
    out = np.zeros((n, 4))
    count = np.bincount(texts, minlength=n)
    hits = np.bincount(texts[hit], minlength=n)
    np.maximum.at(out[:, 0], texts[hit], value[hit])
    out[:, 1] = np.log1p(np.bincount(texts[hit], value[hit], minlength=n))
    out[:, 2] = np.log1p(hits)
    out[:, 3] = hits / np.maximum(count, 1)
    return out


# ------------------------------------------------------------------ fitting

class Model:
    def __init__(self, chars: CharModel | None, weights: dict[int, float], coefficients: np.ndarray | None, base: float):
        self.chars, self.sparse, self.coefficients, self.base = chars, weights, coefficients, base

    def dense(self) -> np.ndarray:
        """Weights by feature; the last entry stands for no feature (index -1)."""
        out = np.zeros((1 << FEATURE_BITS) + 1)
        out[list(self.sparse)] = list(self.sparse.values())
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.coefficients is None:
            return np.full(len(x), self.base)
        return 1 / (1 + np.exp(-np.clip(self.coefficients[0] + x @ self.coefficients[1:], -30, 30)))


def _count_chars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gram counts of a task, as blocks of GRAM_BLOCK cells of each hash function."""
    total = np.zeros((2, 1 << GRAM_BITS), np.int64)
    units, space = letter_units(), _U(32)
    for part in tv.pieces(batches):
        text = " ".join((t or "").lower() for t in tv.column(part, "text").to_pylist())
        codes = units[np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16)]
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != space) | (codes[:-1] != space)
        codes = codes[keep]
        value = np.zeros(len(codes), _U)
        for k, c in enumerate(CharModel.cells("")):
            total[k, c] += len(codes)
        for n in range(1, 5):
            if len(codes) < n:
                break
            value = value[:len(codes) - n + 1] * _U(GRAM_STEP) + codes[n - 1:]
            for k, f in enumerate(GRAM_HASHES):
                at = ((value + _U(n)) * _U(f)) >> _U(64 - GRAM_BITS)
                total[k] += np.bincount(at.astype(np.int64), minlength=1 << GRAM_BITS)
    blocks = total.reshape(-1, GRAM_BLOCK)
    full = np.flatnonzero(blocks.any(1))
    yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array([blocks[b].tobytes() for b in full], pa.binary())],
                                     ["block", "counts"])


def _add_blocks(key: tuple, runs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros(GRAM_BLOCK, np.int64)
    for rows in runs:
        for counts in rows["counts"]:
            total += np.frombuffer(counts, np.int64)
    yield pd.DataFrame({"block": [int(key[0])], "counts": [total.tobytes()]})


def count_grams(docs: DataFrame) -> np.ndarray:
    """Hashed gram counts of all texts, a table of fixed size (2 x 2**GRAM_BITS)."""
    runs = docs.select("text").mapInArrow(tv.tidy(_count_chars), "block int, counts binary")
    total = np.zeros((2, 1 << GRAM_BITS), np.int64)
    blocks = total.reshape(-1, GRAM_BLOCK)
    # one row per block of the table
    for r in runs.groupBy("block").applyInPandas(_add_blocks, "block int, counts binary").collect():
        blocks[r["block"]] = np.frombuffer(r["counts"], np.int64)
    return total


def _count_features(language):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, 1 << FEATURE_BITS), np.int64)
        cache: dict[str, str] = {}
        for part in tv.pieces(batches):
            toxic = np.array(tv.column(part, "toxic").to_pylist(), np.int64)
            features, texts = restored_features(part, language.value, cache)
            for y in (0, 1):
                rows = features[toxic[texts] == y]
                of = np.broadcast_to(texts[toxic[texts] == y][:, None], rows.shape)[rows >= 0]
                once = np.unique((of.astype(np.int64) << FEATURE_BITS) | rows[rows >= 0])
                totals[y] += np.bincount(once & ((1 << FEATURE_BITS) - 1), minlength=1 << FEATURE_BITS)
        at = np.flatnonzero(totals.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(totals[0][at]), pa.array(totals[1][at])],
                                         ["feature", "clean", "toxic"])

    return run


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the first coefficient is the constant."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """About ``max_rows`` distinct labelled (doc_id, text) outside the held-out fold, by a hash threshold.

    Labels meet their documents first, so labels without a document take no place.
    """
    marks = (labels.where(F.col("toxic").isNotNull() & (fold(F.col("doc_id"), 5) != 0) & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    digest = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
    pairs = materialize(docs.select("doc_id", digest.alias("digest")).join(marks, "doc_id").distinct(), "op10-pairs")
    share = min(1.0, max_rows / max(1, pairs.count()))
    picked = pairs.where(F.pmod(F.xxhash64("digest"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # bounded by max_rows
    texts = docs.select("doc_id", "text", digest.alias("digest")).join(F.broadcast(picked), ["doc_id", "digest"])
    return texts.groupBy("doc_id", "digest", "toxic").agg(F.first("text").alias("text")).drop("digest")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    spark = docs.sparkSession
    rows = materialize(training_rows(docs, labels).withColumn("calibrate", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(10)) < 4),
                       "op10-train")
    seen = {(r["toxic"], r["calibrate"]): r["n"]
            for r in rows.groupBy("toxic", "calibrate").agg(F.count("*").alias("n")).collect()}
    n = sum(seen.values())
    base = sum(v for (y, _), v in seen.items() if y == 1) / n if n else 0.0
    if not all(seen.get((y, c)) for y in (0, 1) for c in (False, True)):
        return Model(None, {}, None, base)
    chars = CharModel(count_grams(docs))
    clean, toxic = (float(seen[y, False]) for y in (0, 1))
    odds = (F.log((F.col("toxic") + 0.5) / F.lit(toxic + 1)) - F.log((F.col("clean") + 0.5) / F.lit(clean + 1))
            - F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5)))
    language = spark.sparkContext.broadcast(chars)
    picked = (rows.where("NOT calibrate").select("text", "toxic")
              .mapInArrow(tv.tidy(_count_features(language)), "feature long, clean long, toxic long")
              .groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
              .where("toxic >= 3").withColumn("weight", odds).where("weight > 0.5")
              .collect())  # hashed: 2**FEATURE_BITS rows at most
    language.destroy()
    model = Model(chars, {r["feature"]: r["weight"] for r in picked}, None, base)
    shared = spark.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, cache = shared.value.dense(), {}
        for part in tv.pieces(batches):
            x = evidence(part, weights, shared.value.chars, cache)
            yield pa.RecordBatch.from_arrays([*(pa.array(x[:, k]) for k in range(4)), tv.column(part, "toxic")],
                                             ["a", "b", "c", "d", "toxic"])

    table = rows.where("calibrate").select("text", "toxic").mapInArrow(
        tv.tidy(measure), "a double, b double, c double, d double, toxic int").toPandas().sort_values(["a", "b", "c", "d", "toxic"])
    shared.destroy()
    model.coefficients = logistic(table[["a", "b", "c", "d"]].to_numpy(), table["toxic"].to_numpy(float))
    return model


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id", "held_out"), text: str = "text") -> DataFrame:
    """The columns ``keep`` of every row with its score and predicted label (which replace columns so named)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = tuple(c for c in keep if c not in ("score", "predicted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        weights, cache = m.dense(), {}
        for part in tv.pieces(batches, text):
            score = m.score(evidence(part.select([text]).rename_columns(["text"]), weights, m.chars, cache))
            yield pa.RecordBatch.from_arrays(
                [*(tv.column(part, c) for c in keep), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                [*keep, "score", "predicted"])

    rows = docs.select(*keep, *([text] if text not in keep else []))
    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    return rows.mapInArrow(tv.tidy(run), schema)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that the model learnt from them does not call toxic."""
    model = fit(documents(docs), labels.select("doc_id", "toxic"))
    names = [f"c{k}" for k in range(len(docs.columns))]
    text = names[docs.columns.index("text")]
    renamed = docs.toDF(*names).withColumn(text, F.col(text).cast("string"))
    kept = predict(renamed, model, tuple(names), text).where("predicted = 0")
    return kept.drop("score", "predicted").toDF(*docs.columns)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labelled rows outside the fold crc32(doc_id) mod 5 = 0, score all rows."""
    rows = documents(docs)
    model = fit(rows, labels.select("doc_id", "toxic"))
    return predict(rows.withColumn("held_out", fold(F.col("doc_id"), 5) == 0), model)
