"""Benchmark decontamination by pigeonhole edit matching.

An item of m characters may differ by ``k = floor(ERROR_SHARE * m)`` edits. It
is cut into k + 1 pieces; a text that holds the item within k edits holds one
piece unchanged. Piece hits are found with rolling hashes over the whole text
(vectorised, then compared byte by byte), and every hit is verified with
Myers' bit-parallel approximate matching in a window around it. The benchmark
is broadcast in blocks of bounded size; documents are never shuffled.

Texts and items are compared lower-cased (A-Z and Latin-1 letters), every run
of signs and white space being one space.

Edge cases: null texts and items without a letter or digit match nothing;
an item too short
for an edit (16 characters) matches as whole words only, and one under
``LEAST_CHARS`` characters is reported but rejects no document in
``drop_contaminated``; items of the same text are all reported; repeated rows give one match per
(doc_id, item_id), the closest; null item ids are left out; ties go to the
first place in the text; extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import documents
from .op10_toxicity import lower_bytes

ERROR_SHARE = 0.06
#: bound of one broadcast block of benchmark text; larger benchmarks take several passes
BLOCK_BYTES = 2 << 20
#: items of fewer normalised characters say nothing about a text: they are reported, but reject no document
LEAST_CHARS = 20
_KEEP = np.zeros(256, bool)
_KEEP[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_CLASSES = (24, 16, 12, 10, 8, 6, 4, 3, 2, 1)
_FILTER_BITS = 20


def normalise(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(normalised bytes, offsets); each text ends with one space."""
    low = lower_bytes(raw) if len(raw) else raw
    solid = _KEEP[low]
    low = np.where(solid, low, np.uint8(32))
    keep = solid.copy()
    keep[1:] |= solid[:-1]
    first = offs[:-1][(offs[:-1] < len(low))]
    keep[first] = solid[first]
    kept = np.concatenate(([0], np.cumsum(keep)))
    return low[keep], kept[offs]


def normal_text(text: str | None) -> str:
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    out, _ = normalise(raw, np.array([0, len(raw)]))
    return out.tobytes().decode("utf-8", "replace").strip()


def myers(pattern: str, text: str) -> tuple[int, int]:
    """(least edit distance of the pattern to a substring of the text, end of the first such substring)."""
    m = len(pattern)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    mask, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = mask, 0, m, m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph <<= 1
        pv = ((mh << 1) | ~(xv | ph)) & mask
        mv = ph & xv & mask
        if score < best:
            best, end = score, j + 1
    return best, end


def budget(item: str, error_share: float) -> int:
    return int(len(item) * error_share + 1e-9)


def cut(item: str, n: int) -> list[tuple[int, str]]:
    """(start, piece) of n pieces of nearly equal length."""
    bounds = [len(item) * k // n for k in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


class Index:
    """Pieces of a block of items, by length class of their hashed beginning."""

    def __init__(self, items: list[tuple[int, str]], error_share: float):
        self.items = [(i, normal_text(t)) for i, t in items]
        self.items = [(i, t) for i, t in self.items if t]
        self.budgets = [budget(t, error_share) for _, t in self.items]
        found: dict[int, dict[bytes, list[tuple[int, int]]]] = {}
        for number, ((_, text), k) in enumerate(zip(self.items, self.budgets, strict=True)):
            for at, piece in cut(text, k + 1):
                coded = piece.encode()
                q = next(c for c in _CLASSES if c <= len(coded))
                start = len(text[:at].encode())
                found.setdefault(q, {}).setdefault(coded, []).append((number, start))
        self.classes = []
        for q, pieces in sorted(found.items()):
            coded = list(pieces)
            heads = np.frombuffer(b"".join(p[:q] for p in coded), np.uint8)
            _, inv = tv.powers(max(len(heads), 1))
            sums = _prefix(heads)
            at = np.arange(len(coded)) * q
            hashes = (sums[at + q] - sums[at]) * inv[at]
            order = np.argsort(hashes, kind="stable")
            bits = np.zeros(1 << _FILTER_BITS, bool)
            bits[(tv.mix(hashes) >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
            self.classes.append((q, hashes[order], [coded[i] for i in order], [pieces[coded[i]] for i in order], bits))


def _prefix(low: np.ndarray) -> np.ndarray:
    codes = _CODE[low]
    pow_, _ = tv.powers(max(len(low), 1))
    sums = np.zeros(len(low) + 1, np.uint64)
    np.cumsum(codes * pow_[:len(low)], out=sums[1:])
    return sums


_CODE = tv.BYTE_CODE.copy()
_CODE[32] = np.uint64(0x5851F42D4C957F2D)


def matches(part: pa.RecordBatch, index: Index) -> list[tuple[int, int, int, int, int]]:
    """(row, item id, distance, start, end) of the closest match of each text and item, in normalised bytes."""
    low, offs = normalise(*tv.utf8(tv.column(part, "text")))
    if not len(low):
        return []
    data = low.tobytes()
    sums = _prefix(low)
    _, inv = tv.powers(len(low))
    tried: set[tuple[int, int, int]] = set()
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for q, hashes, coded, owners, bits in index.classes:
        n = len(low) - q + 1
        if n <= 0:
            continue
        window = (sums[q:] - sums[:n]) * inv[:n]
        at = np.flatnonzero(bits[(tv.mix(window) >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        if not len(at):
            continue
        lo = np.searchsorted(hashes, window[at], "left")
        hi = np.searchsorted(hashes, window[at], "right")
        real = np.flatnonzero(hi > lo)
        rows = np.searchsorted(offs, at[real], "right") - 1
        for p, a, b, row in zip(at[real].tolist(), lo[real].tolist(), hi[real].tolist(), rows.tolist(), strict=True):
            for piece in range(a, b):
                if not data.startswith(coded[piece], p):
                    continue
                for number, start in owners[piece]:
                    _verify(data, int(offs[row]), int(offs[row + 1]), row, p - start, number, index, tried, best)
    return [(row, index.items[number][0], d, s, e) for (row, number), (d, s, e) in best.items()]


def _verify(data: bytes, lo: int, hi: int, row: int, start: int, number: int, index: Index,
            tried: set, best: dict) -> None:
    """Match one item around ``start``; each window is tried once."""
    item, k = index.items[number][1], index.budgets[number]
    coded = len(item.encode())
    # windows of the same item start on a grid, wide enough to hold every match of a hit
    slack = 4 * k + 4
    cell = (start - lo) // slack
    key = (row, number, cell)
    if key in tried:
        return
    tried.add(key)
    a = max(lo, lo + cell * slack - slack)
    b = min(hi, lo + (cell + 1) * slack + coded + slack)
    text = data[a:b].decode("utf-8", "ignore")
    if k:
        exact = text.find(item)
    else:  # too short for an edit: it must stand as whole words (every text ends with a space)
        lead = " " if a == lo else ""
        found_at = (lead + text).find(f" {item} ")
        if found_at < 0:
            return
        exact = found_at + 1 - len(lead)
    if exact >= 0:
        d, s = 0, exact
        e = exact + len(item)
    else:
        d, e = myers(item, text)
        s = max(0, e - len(item))
    if d <= k:
        found = (d, a - lo + len(text[:s].encode()), a - lo + len(text[:e].encode()))
        if (row, number) not in best or found < best[row, number]:
            best[row, number] = found


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of at most ``block_bytes`` of text (one item at least)."""
    rows = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    block, size = [], 0
    for row in rows.orderBy("item_id").toLocalIterator():
        block.append((row["item_id"], row["text"]))
        size += len(row["text"].encode("utf-8", "replace"))
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, error_share: float = ERROR_SHARE) -> DataFrame:
    """doc_id, item_id, distance, match_start, match_end: the closest match of every item a text holds."""
    rows = documents(docs)
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, distance int, match_start long, match_end long"
    found = None
    for block in blocks(benchmark):
        shared = spark.sparkContext.broadcast((block, error_share))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(*shared.value)
            for part in tv.pieces(batches):
                hits = matches(part, index)
                if not hits:
                    continue
                row, item, d, s, e = (np.array(x, np.int64) for x in zip(*hits, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [tv.column(part, "doc_id").take(pa.array(row)), pa.array(item), pa.array(d.astype(np.int32)),
                     pa.array(s), pa.array(e)], ["doc_id", "item_id", "distance", "match_start", "match_end"])

        part = rows.mapInArrow(tv.tidy(run), schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], schema)
    best = F.min(F.struct("distance", "match_start", "match_end")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, error_share: float = ERROR_SHARE,
                      least_chars: int = LEAST_CHARS) -> DataFrame:
    """The rows of ``docs`` (all columns) that hold no benchmark item; one narrow pass per block of items."""
    spark = docs.sparkSession
    columns = docs.columns
    names = [f"c{k}" for k in range(len(columns))]
    text = names[columns.index("text")]
    rows = docs.toDF(*names).withColumn(text, F.col(text).cast("string"))
    for block in blocks(benchmark):
        block = [(i, t) for i, t in block if len(normal_text(t)) >= least_chars]
        shared = spark.sparkContext.broadcast((block, error_share))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(*shared.value)
            for part in tv.pieces(batches, text):
                clean = np.ones(part.num_rows, bool)
                found = matches(part.select([text]).rename_columns(["text"]), index)
                clean[[row for row, *_ in found]] = False
                yield part.filter(pa.array(clean))

        rows = rows.mapInArrow(tv.tidy(run), rows.schema)
    return rows.toDF(*columns)
