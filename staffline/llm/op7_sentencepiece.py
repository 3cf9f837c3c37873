"""SentencePiece encoding and decoding with unigram Viterbi over a double-array trie.

The pieces come from a public model file (path is a parameter; nothing is
trained). That file is a BPE model whose scores are merge ranks, so the log
score of a piece is taken by Zipf's law from its rank: -ln(rank + 1) - ln(H).
A character no piece covers costs the least score minus 10 and is written as
byte pieces. Spaces become the marker U+2581, with one marker before the text;
decoding turns markers into spaces and takes the first one off again. A literal
U+2581 in a text is written in byte pieces, so decode(encode(text)) == text for
every text.

No piece has a marker after another character or holds a line feed (checked
when loading), so a text is cut before marker runs and at line feeds without
changing the best path, and distinct cuts are encoded once.

Edge cases: null and empty texts have no pieces and decode to the empty text;
ties go to the path whose last piece is longest; repeated rows are encoded each
time; a text is never shortened; extra columns are kept by ``encode`` and
``decode`` (they read and replace only the columns they name).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .common import documents

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_ENTRIES = 200_000
#: cuts encoded side by side, and the longest (in characters) that are
BATCH_CUTS = 20_000
SHORT_CUT = 48
#: cells tried for a node of the double array before it goes to the end
TRIES = 64
_CUT = re.compile(r"\n| *[^ \n]+| +")


class Vocabulary:
    """Ids, texts and log scores of the pieces of a model file."""

    def __init__(self, pieces: list[tuple[int, bytes, float]], byte_ids: list[int], size: int):
        self.pieces, self.byte_ids, self.size = pieces, byte_ids, size
        self.unknown = min((s for _, _, s in pieces), default=0.0) - UNKNOWN_PENALTY

    @classmethod
    def load(cls, path: str = MODEL_PATH) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        normal = [i for i in range(size)
                  if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        texts = {i: model.id_to_piece(i) for i in normal}
        bad = [p for p in texts.values() if "\n" in p or re.search(f"[^{MARKER}]{MARKER}", p)]
        if bad:
            raise ValueError(f"pieces that cross word borders: {bad[:3]}")
        harmonic = float(np.log(np.sum(1 / np.arange(1, len(normal) + 1))))
        pieces = [(i, texts[i].replace(MARKER, " ").encode(), -float(np.log(rank + 1)) - harmonic)
                  for rank, i in enumerate(normal)]
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        return cls(pieces, byte_ids, size)

    def surfaces(self) -> list[bytes]:
        """Bytes each id decodes to; control pieces decode to nothing."""
        out = [b""] * self.size
        for i, text, _ in self.pieces:
            out[i] = text
        for b, i in enumerate(self.byte_ids):
            out[i] = bytes([b])
        return out


class DoubleArray:
    """Double-array trie over bytes: child of node s by byte b is base[s] + b + 1 if check there is s.

    ``value`` holds the number of the piece ending at a node, or -1.
    """

    def __init__(self, keys: list[bytes]):
        tree: dict = {}
        for number, key in enumerate(keys):
            node = tree
            for b in key:
                node = node.setdefault(b, {})
            node[-1] = number
        base, check, value = [0], [-1], [-1]
        free, queue = 1, [(0, tree)]
        while queue:
            following = []
            for at, node in queue:
                value[at] = node.pop(-1, -1)
                if not node:
                    continue
                labels = sorted(node)
                while free < len(check) and check[free] >= 0:
                    free += 1
                # a few places from the first free cell on, else behind the last cell
                start = max(1, free - labels[0] - 1)
                for start in range(start, start + TRIES):
                    if all(start + b + 1 >= len(check) or check[start + b + 1] < 0 for b in labels):
                        break
                else:
                    start = len(check)
                    free = max(free, start - 4 * TRIES)
                more = start + labels[-1] + 2 - len(check)
                if more > 0:
                    base += [0] * more
                    check += [-1] * more
                    value += [-1] * more
                base[at] = start
                for b in labels:
                    check[start + b + 1] = at
                    following.append((start + b + 1, node[b]))
            queue = following
        self.base, self.check, self.value = (np.array(x, np.int32) for x in (base, check, value))


class Encoder:
    """Viterbi over the trie: of one cut (``pieces``), or of many short cuts side by side (``batch``)."""

    def __init__(self, vocabulary: Vocabulary, trie: DoubleArray):
        self.trie = trie
        self.base, self.check, self.value = trie.base.tolist(), trie.check.tolist(), trie.value.tolist()
        self.id_array = np.array([i for i, _, _ in vocabulary.pieces], np.int32)
        self.score_array = np.array([s for _, _, s in vocabulary.pieces], np.float64)
        self.ids = [i for i, _, _ in vocabulary.pieces]
        self.scores = [s for _, _, s in vocabulary.pieces]
        self.byte_ids, self.unknown = vocabulary.byte_ids, vocabulary.unknown
        self.cache: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[int]:
        data = text.encode("utf-8", "surrogatepass")
        n = len(data)
        base, check, value, scores = self.base, self.check, self.value, self.scores
        size = len(check)
        low = float("-inf")
        best, back = [low] * (n + 1), [(0, -1)] * (n + 1)
        best[0] = 0.0
        literal = MARKER.encode()
        for i in range(n):
            here = best[i]
            if here == low:
                continue
            lead = data[i]
            width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            single = False
            if not data.startswith(literal, i):
                node, j = 0, i
                while j < n:
                    to = base[node] + data[j] + 1
                    if to >= size or check[to] != node:
                        break
                    node = to
                    j += 1
                    number = value[node]
                    if number >= 0:
                        if j == i + width:
                            single = True
                        score = here + scores[number]
                        if score > best[j]:
                            best[j] = score
                            back[j] = (i, number)
            if not single and here + self.unknown > best[i + width]:
                best[i + width] = here + self.unknown
                back[i + width] = (i, -1)
        out: list[int] = []
        j = n
        while j > 0:
            i, number = back[j]
            out += [self.ids[number]] if number >= 0 else [self.byte_ids[b] for b in reversed(data[i:j])]
            j = i
        out.reverse()
        return out

    def batch(self, cuts: list[str]) -> list[bytes]:
        """Little-endian int32 ids of each cut; one step per start position, over all cuts at once."""
        coded = [c.encode("utf-8", "surrogatepass") for c in cuts]
        size = np.array([len(c) for c in coded], np.int64)
        order = np.argsort(-size, kind="stable")
        size = size[order]
        data = np.frombuffer(b"".join(coded[k] for k in order) + b"\0\0\0", np.uint8)
        start = np.concatenate(([0], np.cumsum(size)))[:-1]
        n = len(data) - 3
        literal = (data[:n] == 0xE2) & (data[1:n + 1] == 0x96) & (data[2:n + 2] == 0x81)
        width = np.select([data[:n] < 0x80, data[:n] < 0xE0, data[:n] < 0xF0], [1, 2, 3], 4)
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        # best[k] belongs to the position before byte k of its cut; ends have places of their own
        place = start + np.arange(len(size))
        best = np.full(n + len(size), -np.inf)
        origin, piece = np.zeros(len(best), np.int64), np.full(len(best), -1, np.int64)
        best[place] = 0.0
        for i in range(int(size[0]) if len(size) else 0):
            cut_ = np.arange(np.searchsorted(-size, -i, "left"))
            cut_ = cut_[np.isfinite(best[place[cut_] + i])]
            here = best[place[cut_] + i]
            single = np.zeros(len(cut_), bool)
            live = np.flatnonzero(~literal[start[cut_] + i])
            node = np.zeros(len(live), np.int64)
            j = i
            while len(live):
                inside = j < size[cut_[live]]
                live, node = live[inside], node[inside]
                to = base[node] + data[start[cut_[live]] + j].astype(np.int64) + 1
                ok = to < len(check)
                ok[ok] = check[to[ok]] == node[ok]
                live, node = live[ok], to[ok]
                j += 1
                number = value[node]
                ends = np.flatnonzero(number >= 0)
                at, number = live[ends], number[ends]
                single[at[width[start[cut_[at]] + i] == j - i]] = True
                score, target = here[at] + self.score_array[number], place[cut_[at]] + j
                better = score > best[target]
                best[target[better]] = score[better]
                origin[target[better]] = i
                piece[target[better]] = number[better]
            lone = np.flatnonzero(~single)
            step = width[start[cut_[lone]] + i]
            score, target = here[lone] + self.unknown, place[cut_[lone]] + i + step
            better = score > best[target]
            best[target[better]] = score[better]
            origin[target[better]] = i
            piece[target[better]] = -1
        ids, where = [], []
        cut_, j = np.arange(len(size)), size.copy()
        cut_, j = cut_[j > 0], j[j > 0]
        while len(cut_):
            i, number = origin[place[cut_] + j], piece[place[cut_] + j]
            known = number >= 0
            ids.append(self.id_array[number[known]])
            where.append(start[cut_[known]] + i[known])
            for k in range(4):
                more = ~known & (j - i > k)
                at = start[cut_[more]] + i[more] + k
                ids.append(np.array(self.byte_ids, np.int32)[data[at]])
                where.append(at)
            cut_, j = cut_[i > 0], i[i > 0]
        if not ids:
            return [b""] * len(cuts)
        ids, where = np.concatenate(ids), np.concatenate(where)
        arranged = np.argsort(where)
        flat = ids[arranged].astype("<i4").tobytes()
        bounds = (np.searchsorted(where[arranged], np.append(start, n)) * 4).tolist()
        out = [b""] * len(cuts)
        for k, o in enumerate(order.tolist()):
            out[o] = flat[bounds[k]:bounds[k + 1]]
        return out

    def texts(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian int32; distinct cuts are encoded once."""
        cuts = [cut(t) if t else [] for t in texts]
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        missing = list(set().union(*cuts).difference(self.cache))
        short = [c for c in missing if len(c) <= SHORT_CUT]
        for at in range(0, len(short), BATCH_CUTS):
            some = short[at:at + BATCH_CUTS]
            self.cache.update(zip(some, self.batch(some), strict=True))
        for c in missing:
            if len(c) > SHORT_CUT:
                self.cache[c] = np.array(self.pieces(c), "<i4").tobytes()
        return [b"".join(map(self.cache.__getitem__, c)) for c in cuts]


def cut(text: str) -> list[str]:
    """The text with its leading space, cut before runs of spaces and at line feeds."""
    return _CUT.findall(" " + text)


def decode_ids(ids: np.ndarray, surfaces: list[bytes]) -> str:
    data = b"".join(map(surfaces.__getitem__, ids.tolist()))
    return data[1:].decode("utf-8", "replace")


def model_of(path: str) -> tuple[Vocabulary, DoubleArray]:
    vocabulary = Vocabulary.load(path)
    return vocabulary, DoubleArray([p for _, p, _ in vocabulary.pieces])


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", model_path: str = MODEL_PATH) -> DataFrame:
    """``docs`` with the array column ``ids`` (replaced if there) of piece ids of ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(model_of(model_path))
    kept = docs.drop(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*shared.value)
        for part in tv.pieces(batches, text):
            coded = encoder.texts(tv.column(part, text).to_pylist())
            offsets = np.concatenate(([0], np.cumsum([len(c) // 4 for c in coded]))).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(coded), "<i4"))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(pa.array(offsets), values)],
                                             [*part.schema.names, ids])

    return kept.mapInArrow(tv.tidy(run), T.StructType([*kept.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def decode(frame: DataFrame, ids: str = "ids", decoded: str = "decoded", model_path: str = MODEL_PATH) -> DataFrame:
    """``frame`` with the text column ``decoded`` (replaced if there) of the pieces in ``ids``."""
    vocabulary = Vocabulary.load(model_path)
    shared = frame.sparkSession.sparkContext.broadcast(vocabulary.surfaces())
    kept = frame.drop(decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = tv.column(batch, ids)
            values = column.values.to_numpy(zero_copy_only=False) if len(column) else np.zeros(0, np.int32)
            offsets = column.offsets.to_numpy()
            texts = [decode_ids(values[a:b], shared.value) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             [*batch.schema.names, decoded])

    return kept.mapInArrow(tv.tidy(run), T.StructType([*kept.schema.fields, T.StructField(decoded, T.StringType())]))


def encode_decode(docs: DataFrame, text: str = "text", ids: str = "ids", decoded: str = "decoded",
                  model_path: str = MODEL_PATH) -> DataFrame:
    """``decode(encode(docs))`` in one pass: the columns ``ids`` and ``decoded`` (replaced if there).

    One Python worker a task instead of two that hold the text side by side.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model_of(model_path))
    kept = docs.drop(ids, decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, trie = shared.value
        encoder, surfaces = Encoder(vocabulary, trie), vocabulary.surfaces()
        for part in tv.pieces(batches, text):
            coded = encoder.texts(tv.column(part, text).to_pylist())
            texts = [decode_ids(np.frombuffer(c, "<i4"), surfaces) for c in coded]
            offsets = np.concatenate(([0], np.cumsum([len(c) // 4 for c in coded]))).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(coded), "<i4"))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.ListArray.from_arrays(pa.array(offsets), values), pa.array(texts, pa.string())],
                [*part.schema.names, ids, decoded])

    return kept.mapInArrow(tv.tidy(run), T.StructType([*kept.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType())),
                                                       T.StructField(decoded, T.StringType())]))


def round_trip(docs: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """doc_id, n_chars, n_tokens, ids_crc32 (of the little-endian int32 ids), round_trip of every row."""
    rows = documents(docs).withColumn("text", F.coalesce("text", F.lit("")))
    shared = docs.sparkSession.sparkContext.broadcast(model_of(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, trie = shared.value
        encoder, surfaces = Encoder(vocabulary, trie), vocabulary.surfaces()
        for part in tv.pieces(batches):
            texts = tv.column(part, "text").to_pylist()
            coded = encoder.texts(texts)
            same = [decode_ids(np.frombuffer(c, "<i4"), surfaces) == t for c, t in zip(coded, texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [tv.column(part, "doc_id"), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([len(c) // 4 for c in coded], pa.int64()), pa.array([zlib.crc32(c) for c in coded], pa.int64()),
                 pa.array(same, pa.bool_())], ["doc_id", "n_chars", "n_tokens", "ids_crc32", "round_trip"])

    return rows.mapInArrow(tv.tidy(run), "doc_id long, n_chars long, n_tokens long, ids_crc32 long, round_trip boolean")
