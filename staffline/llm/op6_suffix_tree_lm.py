"""Language-model scores from a probabilistic suffix tree over words.

Texts are packed once into chunks of about ``CHUNK_BYTES`` (ids into a chunk's
own dictionary), written in buckets under the shared folder; every later pass reads
those where they lie, and only answers are shuffled to them.

1. Strings of 1 to DEPTH + 1 tokens, one length after the other: each chunk sends
   its distinct strings with their training counts to hash buckets; a bucket adds
   them up and answers every chunk. A longer string is sent if its first words were
   seen ``MIN_CONTEXT`` times (they are a possible context) and its last words
   ``MIN_COUNT`` times (else it cannot be an entry). Both are absolute counts, so
   contexts and entries grow with the corpus; none of them is collected or broadcast.
2. Divergence test: the chunk that a bucket names for a string puts its terms into
   the sums of its context, which a second set of buckets adds up. A context stays
   when the next-word distribution differs from that of its longest kept suffix by
   at least ``MIN_DIVERGENCE`` nats and the G statistic is significant for its number
   of entries; each chunk is told what is left for the suffix. Kept entries are
   discounted; the mass left goes to the suffix state, down to the add-one unigram
   root (words not seen share one more count), so every state is a proper distribution.
3. Scoring: every token is scored in the longest suffix state of its history, from
   the answers to its chunk.

The sums of length d travel with the strings of length d + 2, so DEPTH + 2 passes
join the chunks with their answers.

Edge cases: a null or empty text is the end token alone; without training rows
every base probability is 1; words are told apart by 64-bit hashes; repeated
rows are counted and scored each time; ties in a chunk's dictionary order do not
change any result; extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textvec as tv
from ..session import scratch_path
from .common import fold, materialize

DEPTH = 3
#: times a context, and a next word within it, are seen at least
MIN_CONTEXT = 2
MIN_COUNT = 2
MIN_DIVERGENCE = 0.01
DISCOUNT = 0.5
#: text of a chunk: strings that repeat within one are sent once, so larger chunks send fewer
CHUNK_BYTES = 8 << 20
#: text whose words are hashed at a time
HASH_BYTES = 1 << 19
#: strings of all chunks that meet in one bucket, about
BUCKET_ROWS = 400_000

_U = np.uint64
_K = _U(0xD6E8FEB86659FD93)
END = _U(tv.mix_int(0x0E0D))
START = _U(tv.mix_int(0x57A27))


def squeeze(values: np.ndarray) -> bytes:
    """Byte planes of an integer array, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def expand(data: bytes, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


# ------------------------------------------------------------------ packing

def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about ``CHUNK_BYTES`` of text, across the batches of a task."""
    held, size = [], 0

    def together() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for part in tv.pieces(batches, max_bytes=max(CHUNK_BYTES // 8, 1)):
        n = pc.sum(pc.binary_length(tv.column(part, "text"))).as_py() or 0
        if held and size + n > CHUNK_BYTES:
            yield together()
            held, size = [], 0
        held.append(part)
        size += n
    if held:
        yield together()


def word_hashes(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The words of a chunk's texts and how many each has, hashed some texts at a time: that takes many bytes a byte of text."""
    found = [(words.hashes, words.counts()) for words in map(tv.words_of, tv.pieces(iter([part]), max_bytes=HASH_BYTES))]
    return np.concatenate([h for h, _ in found]), np.concatenate([c for _, c in found])


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to chunks: word ids by frequency, one end token behind each text."""
    task, number = TaskContext.get().partitionId(), 0
    for part in gathered(batches):
        hashes, counts = word_hashes(part)
        stream = np.empty(len(hashes) + len(counts), _U)
        ends = np.cumsum(counts + 1) - 1
        inner = np.ones(len(stream), bool)
        inner[ends] = False
        stream[inner] = hashes
        stream[ends] = END
        distinct, _, ids = grouped(stream)
        seen = np.bincount(ids, minlength=len(distinct))
        order = np.argsort(-seen, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        held = tv.column(part, "held_out").to_numpy(zero_copy_only=False).astype(bool)
        train = int((counts + 1)[~held].sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array([(task << 32) | number], pa.int64()), pa.array([tv.column(part, "doc_id").to_pylist()], pa.list_(pa.int64())),
             pa.array([held.tolist()], pa.list_(pa.bool_())), pa.array([squeeze((counts + 1).astype(np.uint32))], pa.binary()),
             pa.array([squeeze(rank[ids])], pa.binary()), pa.array([distinct[order].tobytes()], pa.binary()),
             pa.array([len(distinct)], pa.int64()), pa.array([train], pa.int64()), pa.array([int((~held).sum())], pa.int64())],
            CHUNK_COLUMNS)
        number += 1


CHUNK_COLUMNS = ["chunk", "doc_ids", "held_out", "sizes", "ids", "words", "n_words", "n_train", "n_texts"]
CHUNK_SCHEMA = ("chunk long, doc_ids array<long>, held_out array<boolean>, sizes binary, ids binary, words binary, "
                "n_words long, n_train long, n_texts long")


class Chunk:
    def __init__(self, row: dict):
        self.words = np.frombuffer(row["words"], _U)
        self.ids = expand(row["ids"], "<u4").astype(np.int64)
        self.sizes = expand(row["sizes"], "<u4").astype(np.int64)
        self.held = np.array(row["held_out"], bool)
        self.first = np.concatenate(([0], np.cumsum(self.sizes)))
        self.train = np.repeat(~self.held, self.sizes)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def cuts_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Where each of n equal ranges of the key space begins and ends in sorted keys."""
    return np.searchsorted(keys, np.array([k * 2**64 // n for k in range(n)], _U)).tolist() + [len(keys)]


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct sorted keys, where each is first, which of them each key is), as ``np.unique`` gives them.

    The highest bits of a key and its position are sorted as one integer, which takes a fraction of the time of
    sorting positions by keys. Different keys that agree in those bits are few, and put right afterwards.
    """
    n = len(keys)
    if not n:
        return keys, np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = _U((1 << max(n - 1, 1).bit_length()) - 1)
    packed = (keys & ~place) | np.arange(n, dtype=_U)
    packed.sort()
    order = (packed & place).astype(np.int64)
    packed &= ~place  # in place: a worker holds few arrays of all positions at a time
    ordered = keys[order]
    changes = ordered[1:] != ordered[:-1]
    for at in np.unique(packed[1:][changes & (packed[1:] == packed[:-1])]):
        lo, hi = np.searchsorted(packed, at), np.searchsorted(packed, at, "right")
        order[lo:hi] = order[lo:hi][np.argsort(keys[order[lo:hi]], kind="stable")]
        ordered[lo:hi] = keys[order[lo:hi]]
        changes[lo:hi - 1] = ordered[lo + 1:hi] != ordered[lo:hi - 1]
    starts = np.concatenate(([0], np.flatnonzero(changes) + 1))
    which = np.empty(n, np.int64)
    which[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
    return ordered[starts], order[starts], which


def lookup(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Index of each value in a sorted table, -1 where it is not there."""
    if not len(table):
        return np.full(len(values), -1, np.int64)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return np.where(table[at] == values, at, -1)


def lift(rest: np.ndarray) -> np.ndarray:
    """log10, 0 where nothing is kept."""
    return np.log10(np.where(rest > 0, rest, 1.0))


# ------------------------------------------------------------- one chunk

@dataclass(frozen=True)
class Model:
    """What all chunks know: training tokens, texts and words, and the settings."""

    n: int
    texts: int
    v: int
    depth: int
    least: float
    min_next: float
    min_divergence: float
    word_buckets: int
    buckets: int


class Strings:
    """Distinct strings of one length in a chunk by sorted key; ``at`` is the one that ends at a position, or -1."""

    def __init__(self, raw: np.ndarray, keys: np.ndarray, at: np.ndarray, first: np.ndarray | None = None):
        self.raw, self.keys, self.at, self.first = raw, keys, at, first
        self.totals = self.owned = None

    @classmethod
    def of_words(cls, chunk: Chunk) -> Strings:
        """Single tokens: the chunk's dictionary is distinct already."""
        keys = tv.mix(chunk.words)
        order = np.argsort(keys)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return cls(chunk.words[chunk.ids], keys[order], rank[chunk.ids])

    @classmethod
    def of_positions(cls, raw: np.ndarray, ok: np.ndarray) -> Strings:
        keys, first, which = grouped(tv.mix(raw[ok]))
        at = np.full(len(raw), -1, np.int64)
        at[ok] = which
        return cls(raw, keys, at, np.flatnonzero(ok)[first])

    def answered(self, data: np.ndarray) -> None:
        self.totals, self.owned = data >> 1, (data & 1).astype(bool)


class Walk:
    """The positions of a chunk, as many lengths on as there are answers (by step: 2d for strings of d context
    words and the next one, 2d + 1 for the sums of the contexts of d words)."""

    def __init__(self, chunk: Chunk, model: Model, answers: dict[int, list[bytes]]):
        self.chunk, self.model, self.answers = chunk, model, answers
        self.last = Strings.of_words(chunk)
        self.tokens = self.last.raw
        chunk.ids = None  # the walk goes on with places in sorted keys
        self.begins = np.zeros(len(self.tokens), bool)
        self.begins[chunk.first[:-1]] = True

    def answer(self, step: int, dtype: str) -> np.ndarray:
        return np.concatenate([np.zeros(0, dtype), *(expand(x, dtype) for x in self.answers.get(step, []))])

    def before(self, values: np.ndarray, start) -> np.ndarray:
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.begins] = start
        return out

    def run(self, upto: int) -> list[tuple[int, np.ndarray, list[np.ndarray]]]:
        """Uses the answers of the passes before ``upto``; what this pass asks (step, keys, columns)."""
        model, last = self.model, self.last
        if upto == 0:
            return [self.ask(0, last)]
        last.answered(self.answer(0, "<i8"))
        self.root = np.log10((last.totals + 1.0) / (model.n + model.v + 1.0))[last.at]
        self.known, self.logp = (last.totals > 0)[last.at], self.root
        asked = []
        for d in range(1, model.depth + 1):
            if d > upto:
                break
            # the contexts of d words are the strings of that length that end one position before
            start = len(last.keys) if d == 1 else -1
            keys = np.append(last.keys, tv.mix(np.array([START], _U)))
            sizes = np.append(last.totals, model.texts if d == 1 else 0)
            context = self.before(last.at, start)
            context[(context < 0) | (sizes < max(model.least, MIN_COUNT if d > 1 else 1))[context]] = -1
            inside = context >= 0
            often = np.append(last.totals >= MIN_COUNT, False)[last.at]
            now = Strings.of_positions(self.before(last.raw, START) * _K + self.tokens, inside & often)
            if d == upto:
                asked.append(self.ask(2 * d, now))
                break
            now.answered(self.answer(2 * d, "<i8"))
            of = context[now.first]
            entry = (now.totals >= MIN_COUNT) & (now.totals >= model.min_next * sizes[of])
            used = np.zeros(len(keys), bool)
            used[context[inside]] = True
            used = np.flatnonzero(used)
            used = used[np.argsort(keys[used])]
            if d + 1 == upto:
                asked.append(self.sums(2 * d + 1, keys, sizes, used, of, now, entry))
            else:
                rest = np.zeros(len(keys) + 1)
                rest[used] = self.answer(2 * d + 1, "<f8")
                kept_at = (rest > 0)[context] & inside
                own = np.append(np.where(entry, lift((now.totals - DISCOUNT) / np.maximum(sizes[of], 1)), np.nan), np.nan)[now.at]
                self.logp = np.where(kept_at, np.where(np.isnan(own), lift(rest)[context] + self.logp, own), self.logp)
            last = now
        return asked

    def ask(self, step: int, strings: Strings) -> tuple[int, np.ndarray, list[np.ndarray]]:
        seen = np.bincount(strings.at[self.chunk.train & (strings.at >= 0)], minlength=len(strings.keys))
        return step, strings.keys, [seen.astype(np.uint32)]

    def sums(self, step: int, keys: np.ndarray, sizes: np.ndarray, used: np.ndarray, of: np.ndarray,
             now: Strings, entry: np.ndarray) -> tuple[int, np.ndarray, list[np.ndarray]]:
        """Terms of the divergence test from the entries that this chunk owns, for each context in it."""
        mine = entry & now.owned
        of, totals, q = of[mine], now.totals[mine], 10 ** self.logp[now.first[mine]]
        p = totals / sizes[of]

        def by(x: np.ndarray | None, dtype: str) -> np.ndarray:
            return np.bincount(of, x, len(keys))[used].astype(dtype)

        entries = by(None, "<i8")
        return step, keys[used], [np.where(entries > 0, sizes[used], 0).astype("<i8"), entries, by(totals, "<i8"), by(q, "<f8"),
                                  by(p * np.log(p / q), "<f8")]


ASK_COLUMNS = ["step", "bucket", "chunk", "keys", "c0", "c1", "c2", "c3", "c4"]
ASK_SCHEMA = "step int, bucket long, chunk long, keys binary, c0 binary, c1 binary, c2 binary, c3 binary, c4 binary"
ANSWER_SCHEMA = "step int, chunk long, bucket long, data binary, seen long"


def _asked(number: int, asked: list[tuple[int, np.ndarray, list[np.ndarray]]], model: Model) -> pd.DataFrame:
    out = []
    for step, keys, columns in asked:
        cuts = cuts_of(keys, model.buckets if step else model.word_buckets)
        out += [(step, b, number, squeeze(keys[lo:hi]), *(squeeze(x[lo:hi]) for x in columns), *[None] * (5 - len(columns)))
                for b, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if hi > lo]
    return pd.DataFrame(out, columns=ASK_COLUMNS)


def _ask_words(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("step", pa.int32()), *((c, pa.int64()) for c in ASK_COLUMNS[1:3]), *((c, pa.binary()) for c in ASK_COLUMNS[3:])])
        for row in _rows(batches):
            asked = Walk(Chunk(row), model, {}).run(0)
            yield pa.RecordBatch.from_pandas(_asked(row["chunk"], asked, model), schema, preserve_index=False)

    return run


def _walks(left: pd.DataFrame, right: pd.DataFrame, model: Model, upto: int) -> Iterator[tuple[dict, Walk, list]]:
    for row in left.to_dict("records"):
        held = [] if row["held"] is None else [(x["step"], x["bucket"], x["data"]) for x in row["held"]]
        answers: dict[int, list[bytes]] = {}
        for step, _, data in sorted([*held, *right[["step", "bucket", "data"]].itertuples(index=False, name=None)], key=lambda x: x[:2]):
            answers.setdefault(step, []).append(data)
        walk = Walk(Chunk(row), model, answers)
        yield row, walk, walk.run(upto)


def _ask(model: Model, upto: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [_asked(row["chunk"], asked, model) for row, _, asked in _walks(left, right, model, upto)]
        tv.release_memory()
        return pd.concat(out) if out else pd.DataFrame(columns=ASK_COLUMNS)

    return run


# ------------------------------------------------------------- one bucket

def _answer(model: Model):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk")
        keys = [expand(k, "<u8") for k in pdf["keys"]]
        ends = np.cumsum([len(k) for k in keys])
        # every chunk's keys are sorted, which a merge sort makes use of
        distinct, first, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        step = int(pdf["step"].iloc[0])

        def total(column: str, dtype: str) -> np.ndarray:
            return np.bincount(inverse, np.concatenate([expand(x, dtype) for x in pdf[column]]), len(distinct))

        if step % 2 == 0:
            sums = total("c0", "<u4").astype(np.int64)
            seen = int((sums > 0).sum())
            answer = sums[inverse] << 1
            answer[first] += 1  # the chunk that puts the string into its context's sums
        else:
            sizes = np.zeros(len(distinct), np.int64)
            np.maximum.at(sizes, inverse, np.concatenate([expand(x, "<i8") for x in pdf["c0"]]))
            rest = kept(np.maximum(sizes, 1).astype(float), total("c1", "<i8"), total("c2", "<i8"), total("c3", "<f8"), total("c4", "<f8"), model.min_divergence)
            seen, answer = int((rest > 0).sum()), rest[inverse]
        tv.release_memory()
        return pd.DataFrame({
            "step": step, "chunk": [*pdf["chunk"], -1], "bucket": int(pdf["bucket"].iloc[0]),
            "data": [*(squeeze(answer[e - len(k):e]) for e, k in zip(ends, keys, strict=True)), None],
            "seen": [0] * len(keys) + [seen]})

    return run


def kept(size: np.ndarray, entries: np.ndarray, covered: np.ndarray, sum_q: np.ndarray, gain: np.ndarray,
         min_divergence: float) -> np.ndarray:
    """The factor for the suffix state of each context that passes the divergence test, 0 for the others."""
    rest_p, rest_q = np.maximum(size - covered, 0) / size, np.maximum(1 - sum_q, 1e-12)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = gain + np.where(rest_p > 1e-12, rest_p * np.log(rest_p / rest_q), 0)
    g = 2 * size * gain
    passed = (entries > 0) & (gain >= min_divergence) & (g >= entries + 3 * np.sqrt(2 * entries) + 6)
    return np.where(passed, (size - covered + DISCOUNT * entries) / size / rest_q, 0.0)


# ----------------------------------------------------------------- together

def _score(model: Model):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row, walk, _ in _walks(left, right, model, model.depth + 2):
            chunk = walk.chunk
            out.append(pd.DataFrame({
                "doc_id": pd.array(list(row["doc_ids"]), "Int64"), "held_out": chunk.held, "n_tokens": chunk.sizes,
                "n_known": tv.segment_sums(walk.known, chunk.first), "train_tokens": model.n,
                "base_score": tv.segment_sums(walk.root, chunk.first), "score": tv.segment_sums(walk.logp, chunk.first)}))
        tv.release_memory()
        return pd.concat(out) if out else pd.DataFrame(columns=SCORE_COLUMNS)

    return run


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the query that made them has ended: each pass is written, so none is read again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    former = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if former is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, former)


def in_buckets(df: DataFrame, name: str, key: str, n: int) -> DataFrame:
    """Written under the shared folder in ``n`` buckets of the key, so that joins on it need not shuffle it again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(table)
    out = spark.table(table)
    # the files stay: only the name goes
    spark.sql(f"DROP TABLE {table}")
    return out


SCORE_COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
SCORE_SCHEMA = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double")


def score_documents(docs: DataFrame, held_out: Column | None = None, depth: int = DEPTH, min_share: float = 0.0,
                    min_next: float = 0.0, min_divergence: float = MIN_DIVERGENCE) -> DataFrame:
    """Learn from the rows that are not held out (crc32(doc_id) mod 7 = 2 by default), score all rows.

    ``min_share`` (of the training tokens, for a context) and ``min_next`` (of its context, for a next word) cut
    further by share; by default they cut nothing.
    """
    held = fold(F.col("doc_id"), 7) == 2 if held_out is None else held_out
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.coalesce(held, F.lit(False)).alias("held_out"))
    n_files = max(1, rows.rdd.getNumPartitions())
    with shuffles_released(docs.sparkSession):
        chunks = in_buckets(rows.mapInArrow(tv.tidy(pack), CHUNK_SCHEMA), "op6-chunks", "chunk", n_files)
    seen = chunks.agg(F.sum("n_words").alias("w"), F.sum("n_train").alias("n"), F.sum("n_texts").alias("t")).first()
    n = seen["n"] or 0
    model = Model(n, seen["t"] or 0, 0, depth, max(min_share * n, MIN_CONTEXT), min_next, min_divergence,
                  max(1, -(-(seen["w"] or 0) // BUCKET_ROWS)), max(1, -(-n // (2 * BUCKET_ROWS))))
    packed = chunks.select("chunk", "ids", "sizes", "words", "held_out")
    asked = packed.mapInArrow(tv.tidy(_ask_words(model)), ASK_SCHEMA)
    beside, sent = [], None
    for upto in range(depth + 2):
        if upto:
            asked = with_answers(packed, beside, sent, _ask(model, upto), ASK_SCHEMA)
        answered = asked.groupBy("step", "bucket").applyInPandas(_answer(model), ANSWER_SCHEMA)
        # the first answers are read by every pass: they lie beside the chunks. The last ones would be shuffled there
        # while all that was asked is still on disk, which takes more than sending them to the one or two passes left
        with shuffles_released(docs.sparkSession):
            got = in_buckets(answered, "op6-answers", "chunk", n_files) if upto < max(depth, 1) else materialize(answered, "op6-answers")
        if upto == 0:
            model = replace(model, v=got.agg(F.sum("seen").alias("v")).first()["v"] or 0)
        got = got.where("chunk >= 0").select("step", "chunk", "bucket", "data")
        if upto < max(depth, 1):
            beside.append(got)
        else:
            sent = got if sent is None else sent.unionByName(got)
    return with_answers(chunks, beside, sent, _score(model), SCORE_SCHEMA).select(*SCORE_COLUMNS)


def with_answers(chunks: DataFrame, beside: list[DataFrame], sent: DataFrame | None, run: Callable, schema: str) -> DataFrame:
    """``run`` over each chunk and its answers: those in the chunks' own buckets, read in place, and those ``sent`` to them."""
    lists = [got.groupBy("chunk").agg(F.collect_list(F.struct("step", "bucket", "data")).alias(f"held{k}"))
             for k, got in enumerate(beside)]
    # the first pass answers every chunk; the wide rows of the chunks join last
    held = reduce(lambda a, b: a.join(b, "chunk", "left"), lists).select(
        "chunk", F.concat(*[F.coalesce(F.col(f"held{k}"), F.array()) for k in range(len(beside))]).alias("held"))
    left = chunks.join(held, "chunk", "left").select(*chunks.columns, "held").groupBy("chunk")
    if sent is None:
        none = pd.DataFrame(columns=["step", "chunk", "bucket", "data"])
        return left.applyInPandas(lambda pdf: run(pdf, none), schema)
    return left.cogroup(sent.groupBy("chunk")).applyInPandas(run, schema)
