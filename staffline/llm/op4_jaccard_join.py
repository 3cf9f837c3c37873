"""N-gram Jaccard join by a universe-partition pigeonhole.

A document's set holds the 64-bit hashes of its distinct 5-word shingles. Two
sets link when 100 * |a & b| >= 75 * |a | b|, so sets of n and m shingles differ
in at most H = (n + m) / 7 shingles.

Scheme. Sizes fall into bands (each a third wider than the last), so linked sets
lie in the same or in neighbouring bands; a set signs under its own band and
under the band below. A band's scheme cuts the hash universe into ``exact``
segments, matched as they are, and ``loose`` segments, matched by themselves or
with one shingle deleted. Differences that leave every segment unequal number
at least exact + 2 * loose, so with exact + 2 * loose >= H + 1 + E a linked pair
agrees in at least one segment that is not empty, unless both sets have more
than E empty units. A cost model per band chooses between exact and loose
segments by signatures written and chance collisions expected; small bands
take one loose segment. Sets beyond E in a scheme ("irregular", a fraction of a
per mille) also meet under a prefix filter: a linked pair shares one of the
n - ceil(0.75 n) + 1 smallest hashes.

Popular shingles (those of about ``POPULAR_SHARE`` of the documents, counted over
all parts of the input) form one segment more that is never matched. Differences
in the other segments are still at most H, so nothing else changes; a text with
few other shingles has many empty units and is irregular. So common passages
make no large groups, and no group of segments holds more than that share.

Cells. The segments of a band are dealt into parts, as many as keep the
signatures of a part within ``BUCKET_ROWS``; a part's signatures meet in one
task (a cell), where the segments that two sets have in common are counted. Of
two linked sets, at most the H of *their* sizes and the empty units of one of them
fall on all parts together, so in some part they agree in all units but a part's
share of those; pairs that agree in fewer are given by no cell. Sets that only
share a passage agree in few segments and are dropped there. A band too large
for parts of one segment deals each segment by key ranges.

Volume. Equal sets are one class from the start. Groups of near copies are
linked early: classes that share a minimum hash are verified against the
smallest of the group. In each large signature group, members in one component need
no pairs; only pairs of different components become candidates. Parity sketches
drop candidates that provably differ too much, without any loss: folded to 512
bits inside the join of the members, and at two bits a shingle after it; the
rest are verified exactly. Components come from min-label rounds on the links.

Edge cases: null and empty texts have no shingles and stand alone; a text of
fewer than five words is one shingle of all its words; every row gets a
result, and rows of one doc_id link as one document if any of them does; null ids are kept as rows without links; extra columns are
dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textvec as tv
from .common import documents, materialize
from .graph import components

WIDTH = 5
#: a link needs at least NUM / DEN of the union
NUM, DEN = 75, 100
POPULAR_SHARE = 1 / 4000
#: shingles a task counts at a time
COUNT_ROWS = 6_000_000
#: signatures that meet in one bucket, about
BUCKET_ROWS = 1_000_000
#: groups up to this size give their pairs at once; larger ones first drop pairs of one component
SMALL_GROUP = 64
#: pairs that a bucket counts at most; beyond, the larger groups are treated as large ones
MEET_PAIRS = 4_000_000
#: groups before it that a member of a large group remembers: a pair that met in one of them is not given again
REMEMBERED = 8
#: segments of a band in one bucket at most: their number takes the lowest bits of a key
SEGMENT_BITS = 8
#: text whose signatures are packed together
CHUNK_BYTES = 4 << 20
MINIMA = 3
#: what names a signature group
GROUP = ["bucket", "grp"]
#: bits of the smallest sketch, to which every sketch folds; they join as so many 64-bit words
LEAST_SKETCH = 512
FOLDED = [f"folded_{k}" for k in range(LEAST_SKETCH // 64)]
FILTER_BITS = 1 << 23
#: bytes of a set's digest beside a signature; equal sets are those of one signature, digest and size
DIGEST_BYTES = 6

_U = np.uint64
_STEP = _U(0x9E6C63D0876A9A4B)
_SHORT = _U(0x51ED270B7F4A7C15)


# ----------------------------------------------------------------- shingles

def shingle_sets(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the sorted distinct shingle hashes of text d are hashes[first[d]:first[d + 1]]."""
    words = tv.words_of(part)
    h, counts = words.hashes, words.counts()
    n = len(h)
    value = np.zeros(n, _U)
    for j in range(WIDTH):
        shifted = np.zeros(n, _U)
        shifted[:n - j] = h[j:]
        value = value * _STEP + shifted
    value = tv.mix(value)
    left = np.repeat(words.first[1:], counts) - np.arange(n)
    full = left >= WIDTH
    owner = words.owner()
    short = np.flatnonzero((counts > 0) & (counts < WIDTH))
    extra = np.zeros(len(short), _U)
    for k in range(WIDTH - 1):
        # the k-th word of every short text that has one
        more = short[counts[short] > k]
        at = np.searchsorted(short, more)
        extra[at] = (extra[at] + _SHORT) * _STEP + h[words.first[more] + k]
    hashes = np.concatenate([value[full], tv.mix(extra)])
    docs = np.concatenate([owner[full], short])
    order = np.lexsort((hashes, docs))
    hashes, docs = hashes[order], docs[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
    hashes, docs = hashes[fresh], docs[fresh]
    return hashes, np.searchsorted(docs, np.arange(part.num_rows + 1))


def links(common: int, n: int, m: int) -> bool:
    return DEN * common >= NUM * (n + m - common)


# ------------------------------------------------------------------ schemes

class Scheme:
    """Segments of one size band [low, high): ``exact`` + ``loose``, and the empty units allowed."""

    def __init__(self, band: int, low: int, high: int, exact: int, loose: int, spare: int):
        self.band, self.low, self.high = band, low, high
        self.exact, self.loose, self.spare = exact, loose, spare

    @property
    def units(self) -> int:
        return self.exact + 2 * self.loose


def band_bounds(band: int) -> tuple[int, int]:
    """Sizes of a band: the next one starts where a link to this one's smallest set ends."""
    low = 1
    for _ in range(band):
        low = low * DEN // NUM + 1
    return low, low * DEN // NUM + 1


def band_table(largest: int) -> list[int]:
    """Starts of the bands up to the one that holds ``largest``."""
    starts = [1]
    while starts[-1] <= largest:
        starts.append(starts[-1] * DEN // NUM + 1)
    return starts


def most_differences(high: int) -> int:
    """Most shingles in which two linked sets differ, the smaller one below ``high``."""
    n = high - 1
    return (n + n * DEN // NUM) * (DEN - NUM) // (DEN + NUM)


def scheme_of(band: int, low: int, high: int) -> Scheme:
    """The cheapest scheme of a band: signatures written plus chance collisions expected."""
    need = most_differences(high) + 1
    n = float(low)
    best: tuple[float, Scheme] | None = None
    for share in (0.0, 0.25, 0.5, 1.0):
        loose = math.ceil(need * share / 2)
        exact = max(0, need - 2 * loose)
        spare = 0
        # the smallest sets of the band have the most empty units; a whole set in one segment has none
        while exact + loose > 1:
            empty = (exact + spare + 2 * loose) * math.exp(-n / (exact + spare + loose))
            enough = math.ceil(empty + 4 * math.sqrt(empty) + 1)
            if enough <= spare or spare > 2 * need + 8:
                break
            spare = enough
        segments = exact + spare + loose
        weight = n / segments
        empty, alone = math.exp(-weight), weight * math.exp(-weight)
        # rows written: filled segments, and one per shingle of the loose ones
        written = segments * (1 - empty) + loose * (weight - alone)
        # a signature of one shingle meets every set that holds it alone
        cost = written + segments * alone / 2
        if best is None or cost < best[0]:
            best = (cost, Scheme(band, low, high, exact + spare, loose, spare))
    assert best is not None
    return best[1]


_SCHEMES: dict[int, Scheme] = {}


def scheme(band: int) -> Scheme:
    if band not in _SCHEMES:
        _SCHEMES[band] = scheme_of(band, *band_bounds(band))
    return _SCHEMES[band]


def is_rare(hashes: np.ndarray, popular: np.ndarray) -> np.ndarray:
    if not len(popular):
        return np.ones(len(hashes), bool)
    at = np.minimum(np.searchsorted(popular, hashes), len(popular) - 1)
    return popular[at] != hashes


class Filled:
    """The segments of the texts of one band: the rare shingles of each, and the units lost to a match."""

    def __init__(self, b: int, hashes: np.ndarray, owner: np.ndarray, rare: np.ndarray, band: np.ndarray):
        self.plan = plan = scheme(b)
        self.texts = np.flatnonzero(band == b)
        self.number = np.full(len(band), -1, np.int64)
        self.number[self.texts] = np.arange(len(self.texts))
        self.mine = np.flatnonzero(self.number[owner] >= 0)
        mine_rare = self.mine[rare[self.mine]]
        self.h, self.o = hashes[mine_rare], self.number[owner[mine_rare]]
        self.segments = segments = plan.exact + plan.loose
        self.salt = _U(tv.mix_int(1000 + b))
        self.cell = self.o * segments + (tv.mix(self.h ^ self.salt) % _U(segments)).astype(np.int64)
        self.filled = np.bincount(self.cell, minlength=len(self.texts) * segments)
        self.loose = np.tile(np.arange(segments) >= plan.exact, len(self.texts))
        # units that can agree without a signature: empty segments, and loose ones that lose their only shingle
        self.lost = np.where(self.filled == 0, 1 + self.loose, (self.filled == 1) & self.loose).reshape(-1, segments).sum(1)


def segment_signatures(hashes: np.ndarray, owner: np.ndarray, rare: np.ndarray, band: np.ndarray,
                       ) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(band, keys, owner, segment, lost units of the owner) under the scheme ``band[d]`` of each text (-1: none)."""
    for b in np.unique(band[band >= 0]).tolist():
        x = Filled(b, hashes, owner, rare, band)
        code = tv.mix(x.h + x.salt)
        total = np.zeros(len(x.filled), _U)
        np.add.at(total, x.cell, code)
        tag = tv.mix(np.tile(np.arange(x.segments), len(x.texts)).astype(_U) * _STEP + x.salt)
        whole = np.flatnonzero(x.filled)
        of = whole // x.segments
        yield b, tv.mix(total[whole] ^ tag[whole]), x.texts[of], whole % x.segments, x.lost[of]
        # with one shingle deleted; deleting the only one leaves nothing to sign
        cut = np.flatnonzero(x.loose[x.cell] & (x.filled[x.cell] > 1))
        if len(cut):
            at = x.cell[cut]
            yield b, tv.mix((total[at] - code[cut]) ^ tag[at]), x.texts[x.o[cut]], at % x.segments, x.lost[x.o[cut]]


def signatures(hashes: np.ndarray, owner: np.ndarray, rare: np.ndarray, band: np.ndarray, prefix: bool,
               ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, owner) under the scheme ``band[d]`` of each text (-1: none): of the segments, or with
    ``prefix`` the prefix keys of the irregular texts."""
    if not prefix:
        yield from ((key, text) for _, key, text, _, _ in segment_signatures(hashes, owner, rare, band))
        return
    for b in np.unique(band[band >= 0]).tolist():
        x = Filled(b, hashes, owner, rare, band)
        odd = x.lost > x.plan.units - most_differences(x.plan.high) - 1
        pick = x.mine[odd[x.number[owner[x.mine]]]]
        if len(pick):
            ph, po, common = hashes[pick], x.number[owner[pick]], ~rare[pick]
            size = np.bincount(po, minlength=len(x.texts))
            # one fixed order for all texts: rare shingles first, then by hash
            arranged = np.lexsort((ph, common, po))
            first = np.searchsorted(po[arranged], np.arange(len(x.texts)))
            rank = np.arange(len(ph)) - first[po[arranged]]
            chosen = arranged[rank < (size - -(-NUM * size // DEN) + 1)[po[arranged]]]
            yield tv.mix(ph[chosen] ^ tv.mix_int_u(7 + b)), x.texts[po[chosen]]


# -------------------------------------------------------------------- cells

class Cells:
    """How the segments of each band are dealt: ``parts`` of them by their number, and each part into key ``ranges``.

    Cells are numbered from ``first`` of their band, part by part. Bands without sets of their own have none:
    their scheme would only match sets of the band above, which meet under that band's.
    """

    def __init__(self, sizes: np.ndarray, counts: np.ndarray, rows: int | None = None):
        rows = rows or BUCKET_ROWS
        own = np.bincount(np.searchsorted(band_table(int(sizes.max())), sizes, "right") - 1, counts) if len(sizes) else np.zeros(1)
        self.parts, self.ranges = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        for b in np.flatnonzero(own).tolist():
            plan = scheme(b)
            segments = plan.exact + plan.loose
            # a text signs each segment, and the loose ones once more for each shingle
            a_text = plan.exact + plan.loose * (1 + plan.high / segments)
            total = (own[b] + (own[b + 1] if b + 1 < len(own) else 0)) * a_text
            least = -(-segments >> SEGMENT_BITS)
            self.parts[b] = min(max(math.ceil(total / rows), least, 1), segments)
            self.ranges[b] = math.ceil(total / rows / self.parts[b]) if self.parts[b] == segments else 1
        self.first = np.cumsum(self.parts * self.ranges) - self.parts * self.ranges

    def of(self, b: int, key: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each signature, and the 48 bits that tell it from others there."""
        parts, ranges = self.parts[b], self.ranges[b]
        at = (((key >> _U(32)) * _U(ranges)) >> _U(32)).astype(np.int64)
        low = (key & _U((1 << (48 - SEGMENT_BITS)) - 1)) << _U(SEGMENT_BITS) | (segment // parts).astype(_U)
        return self.first[b] + segment % parts * ranges + at, low

    def place(self, cell: int) -> tuple[int, int]:
        """Band and part of a cell."""
        b = int(np.flatnonzero((self.parts > 0) & (self.first <= cell))[-1])
        return b, int((cell - self.first[b]) // self.ranges[b])


def units_of_parts(plan: Scheme, parts: int) -> np.ndarray:
    segment = np.arange(plan.exact + plan.loose)
    return np.bincount(segment % parts, 1 + (segment >= plan.exact), parts).astype(np.int64)


def least_units(units: np.ndarray, part: int, spoiled: np.ndarray) -> np.ndarray:
    """Units of a part in which pairs agree at least if no other part shows them.

    ``spoiled``: units of all parts together that a pair's differences and one set's empty units spoil at most.
    If every part u_j had min(u_j, t + 1) spoiled units, for a t where these add up to more than ``spoiled``,
    that would be too many; so some part has fewer, and agrees in u_j - t or more (and at least one).
    """
    reach = np.array([np.minimum(units, t + 1).sum() for t in range(int(units.max()))])
    return np.maximum(units[part] - np.searchsorted(reach, spoiled, "right"), 1)


# -------------------------------------------------------------------- tasks

def sketches(hashes: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Per text, the parity of its shingles in each of w cells, w a power of two of 2n or more.

    A shingle that only one of two sets holds flips one bit, so two sketches
    (the wider one folded) differ in at most as many bits as the sets in shingles.
    """
    out = []
    cells = tv.mix(hashes + _U(555)) >> _U(32)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        width = max(LEAST_SKETCH, 1 << (2 * (b - a) - 1).bit_length()) if b > a else LEAST_SKETCH
        bits = np.bincount((cells[a:b] & _U(width - 1)).astype(np.int64), minlength=width).astype(np.uint8) & 1
        out.append(np.packbits(bits).tobytes())
    return out


def sketch_distance(a: np.ndarray, b: np.ndarray) -> int:
    """Bits in which two sketches differ; the wider one is folded by halves."""
    while len(a) != len(b):
        if len(a) < len(b):
            a, b = b, a
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    return int(np.bitwise_count(a ^ b).sum())


def folded(sketch: bytes) -> np.ndarray:
    """A sketch folded to the width of the smallest one, as 64-bit words."""
    bits = np.frombuffer(sketch, np.int64)
    return np.bitwise_xor.reduce(bits.reshape(-1, len(FOLDED)), axis=0)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = np.array([folded(x.as_buffer()) for x in tv.column(batch, "sketch")], np.int64).reshape(-1, len(FOLDED))
        yield pa.RecordBatch.from_arrays([tv.column(batch, "a"), *(pa.array(words[:, k]) for k in range(len(FOLDED)))],
                                         ["a", *FOLDED])


def _not_ruled_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches allow a link: linked sets differ in at most (n + m) / 7 shingles."""
    for batch in batches:
        n, m = (tv.column(batch, c).to_numpy() for c in ("n", "m"))
        far = [sketch_distance(np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8))
               for x, y in zip(tv.column(batch, "left"), tv.column(batch, "right"), strict=True)]
        keep = (NUM + DEN) * np.array(far, np.int64) <= (DEN - NUM) * (n + m)
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text (kind 0): size, digest, minima, sketch; and locally repeated shingles (kind 1)."""
    seen, held = [], 0
    for part in tv.pieces(batches):
        hashes, first = shingle_sets(part)
        size = np.diff(first)
        mixed = tv.mix(hashes + _U(99))
        digest = [tv.segment_sums(mixed, first), tv.segment_sums(tv.mix(hashes ^ _STEP), first)]
        minima = []
        for k in range(MINIMA):
            value = tv.mix(hashes + _U(tv.mix_int(k + 31)))
            least = np.zeros(len(size), _U)
            full = size > 0
            if full.any():
                least[full] = np.minimum.reduceat(value, first[:-1][full])
            minima.append(least)
        n = part.num_rows
        yield _profile_batch(tv.column(part, "doc_id"), np.zeros(n, np.int32), size, *digest, *minima, sketch=sketches(hashes, first))
        seen.append(hashes)
        held += len(hashes)
        if held >= COUNT_ROWS:
            yield from _repeated(seen)
            held = 0
    yield from _repeated(seen)


def _repeated(seen: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Shingles that several texts of a task hold, with the number of texts (kind 1)."""
    if not seen:
        return
    hashes = np.concatenate(seen)
    seen.clear()
    hashes.sort()  # in place: np.unique would hold several copies
    again = np.flatnonzero(hashes[1:] == hashes[:-1])
    # runs of positions whose successor is equal; a run of k of them is a shingle of k + 1 texts
    starts = np.flatnonzero(np.diff(again, prepend=-2) != 1)
    # neighbouring runs of different shingles never touch: the last text of a run has no equal successor
    counts = np.diff(np.append(starts, len(again))) + 1
    distinct = hashes[again[starts]]
    m = len(distinct)
    none = np.zeros(m, _U)
    yield _profile_batch(pa.array(distinct.view(np.int64)), np.ones(m, np.int32), counts, *[none] * (2 + MINIMA))


def _profile_batch(ids, kind, size, *longs, sketch=None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(kind), pa.array(np.asarray(size, np.int64)), *(pa.array(x.view(np.int64)) for x in longs),
         pa.array(sketch or [None] * len(kind), pa.binary())], _PROFILE)


_PROFILE = ["doc_id", "kind", "n_shingles", "digest_a", "digest_b", *[f"minimum_{k}" for k in range(MINIMA)], "sketch"]
_PROFILE_TYPES = {"kind": "int", "sketch": "binary"}
_PROFILE_SCHEMA = ", ".join(f"{c} {_PROFILE_TYPES.get(c, 'long')}" for c in _PROFILE)


def planes(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of each value, byte by byte, so that like bytes stand together and compress."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def from_planes(blob: bytes, width: int) -> np.ndarray:
    found = np.frombuffer(blob, np.uint8).reshape(width, -1)
    out = np.zeros((found.shape[1], 8), np.uint8)
    out[:, :width] = found.T
    return out.view("<u8").ravel()


def _banded(part: pa.RecordBatch, popular: np.ndarray):
    """Shingles, owners, rare ones, sizes, digests and both bands of a run of texts."""
    hashes, first = shingle_sets(part)
    size = np.diff(first)
    owner = np.repeat(np.arange(len(size)), size)
    starts = np.array(band_table(int(size.max()) if len(size) else 1))
    own = np.searchsorted(starts, size, "right") - 1
    own[tv.column(part, "doc_id").is_null().to_numpy(zero_copy_only=False)] = -1
    digest = tv.segment_sums(tv.mix(hashes + _U(99)), first)
    return hashes, owner, is_rare(hashes, popular), size, digest, (own, np.where(own > 0, own - 1, -1))


def _sign(popular_shared, cells: Cells):
    """Segment signatures packed per cell: key bits, text numbers, and the texts' digests, sizes and lost units."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tv.pieces(batches, max_bytes=CHUNK_BYTES):
            hashes, owner, rare, size, digest, bands = _banded(part, popular_shared.value)
            found = []
            for band in bands:
                dealt = np.where(band >= 0, cells.parts[np.maximum(band, 0)], 0) > 0
                for b, key, text, segment, lost in segment_signatures(hashes, owner, rare, np.where(dealt, band, -1)):
                    found.append((*cells.of(b, key, segment), text, lost))
            if not found:
                continue
            cell, low, text, lost = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(cell, kind="stable")
            cell, low, text, lost = cell[order], low[order], text[order], lost[order]
            cuts = np.append(np.flatnonzero(np.diff(cell, prepend=-1)), len(cell)).tolist()
            ids = tv.column(part, "doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            out = []
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                used, at, local = np.unique(text[lo:hi], return_index=True, return_inverse=True)
                out.append((int(cell[lo]), (low[lo:hi] >> _U(16)).astype(np.uint32).tobytes(), low[lo:hi].astype(np.uint16).tobytes(),
                            local.astype(np.uint16 if len(used) < 65536 else np.uint32).tobytes(),
                            planes(ids[used].view(_U), 8), planes(digest[used], DIGEST_BYTES), planes(size[used].astype(_U), 4),
                            planes(lost[lo:hi][at].astype(_U), 4)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64()), *(pa.array([x[k] for x in out], pa.binary()) for k in range(1, 8))],
                ["bucket", "high", "low", "texts", "ids", "digests", "sizes", "lost"])

    return run


def _sign_irregular(popular_shared):
    """Prefix keys of the irregular texts, one row each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tv.pieces(batches, max_bytes=CHUNK_BYTES):
            hashes, owner, rare, size, digest, bands = _banded(part, popular_shared.value)
            found = [x for band in bands for x in signatures(hashes, owner, rare, band, True)]
            if not found:
                continue
            key, text = (np.concatenate(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), tv.column(part, "doc_id").take(pa.array(text)),
                 pa.array(digest[text].view(np.int64)), pa.array(size[text].astype(np.int64))], ["grp", "a", "digest", "n"])

    return run


def _meet(pdf: pd.DataFrame, cells: Cells) -> pd.DataFrame:
    """Signature groups of a cell: pairs of small groups (group null), members of large ones (b null)."""
    cell = int(pdf["bucket"].iloc[0])
    band, part = cells.place(cell)
    plan, parts = scheme(band), int(cells.parts[band])
    keys, ids, digests, sizes, lost_units = [], [], [], [], []
    for row in pdf.itertuples():
        own = from_planes(row.ids, 8).view(np.int64)
        high, low = np.frombuffer(row.high, np.uint32), np.frombuffer(row.low, np.uint16)
        local = np.frombuffer(row.texts, np.uint16 if len(row.texts) == 2 * len(high) else np.uint32)
        keys.append((high.astype(_U) << _U(16)) | low)
        ids.append(own[local])
        digests.append(from_planes(row.digests, DIGEST_BYTES)[local])
        sizes.append(from_planes(row.sizes, 4)[local].astype(np.uint32))
        lost_units.append(from_planes(row.lost, 4)[local].astype(np.uint32))
    key, doc, digest, size, lost = (np.concatenate(x) for x in (keys, ids, digests, sizes, lost_units))
    order = np.argsort(key, kind="stable")
    # only keys that occur again matter
    same = key[order[1:]] == key[order[:-1]]
    again = np.zeros(len(key), bool)
    again[1:] |= same
    again[:-1] |= same
    order = order[again]
    key, doc, digest, size, lost = key[order], doc[order], digest[order], size[order], lost[order]
    # one member per set: the smallest id of equal sets
    order = np.lexsort((doc, size, digest, key))
    key, doc, digest, size, lost = key[order], doc[order], digest[order], size[order].astype(np.int64), lost[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (digest[1:] != digest[:-1]) | (size[1:] != size[:-1])
    key, doc, digest, size, lost = key[fresh], doc[fresh], digest[fresh], size[fresh], lost[fresh]
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    counts = np.diff(np.append(starts, len(key)))
    # the sets of the cell: equal ones have one number (they have the same member in every group)
    _, at, number = np.unique(digest | size.astype(_U) << _U(8 * DIGEST_BYTES), return_index=True, return_inverse=True)
    doc_of, size_of, lost_of = doc[at], size[at], lost[at].astype(np.int64)
    met, made, limit = [np.zeros(0, np.int64)], 0, 1
    for n in np.unique(counts[(counts > 1) & (counts <= SMALL_GROUP)]).tolist():
        group = starts[counts == n]
        made += len(group) * n * (n - 1) // 2
        if made > MEET_PAIRS and n > 2:
            break
        limit = n
        members = number[group[:, None] + np.arange(n)]
        x, y = np.triu_indices(n, 1)
        left, right = members[:, x].ravel(), members[:, y].ravel()
        small, large = np.minimum(size_of[left], size_of[right]), np.maximum(size_of[left], size_of[right])
        # two sets of the band above meet under that band's scheme
        near = (DEN * small >= NUM * large) & (small < plan.high)
        pair = np.minimum(left, right)[near] * len(at) + np.maximum(left, right)[near]
        segment = np.repeat((key[group] & _U((1 << SEGMENT_BITS) - 1)).astype(np.int64), len(x))[near]
        met.append(np.unique(pair << SEGMENT_BITS | segment))
    # a loose segment counts once, whichever of its signatures agree
    met = np.unique(np.concatenate(met))
    pair = met >> SEGMENT_BITS
    first = np.flatnonzero(np.diff(pair, prepend=-1))
    weight = 1 + ((met & ((1 << SEGMENT_BITS) - 1)) * parts + part >= plan.exact)
    agreed = np.add.reduceat(weight, first) if len(first) else weight
    left, right = np.divmod(pair[first], max(len(at), 1))
    spoiled = (size_of[left] + size_of[right]) * (DEN - NUM) // (DEN + NUM) + np.minimum(lost_of[left], lost_of[right])
    enough = agreed >= least_units(units_of_parts(plan, parts), part, spoiled)
    a, b = doc_of[left[enough]], doc_of[right[enough]]
    big = (np.repeat(counts, counts) > limit) & (np.repeat(np.minimum.reduceat(size, starts) if len(starts) else size, counts) < plan.high)
    return pd.DataFrame({
        "bucket": cell,
        "grp": np.concatenate([np.full(len(a), -1), key[big].astype(np.int64)]),
        "a": np.concatenate([np.minimum(a, b), doc[big]]), "b": np.concatenate([np.maximum(a, b), np.full(int(big.sum()), -1)]),
        "n": np.concatenate([np.zeros(len(a), np.int64), size[big]])})


def _meet_and_release(cells: Cells):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = _meet(pdf, cells)
        tv.release_memory()
        return out

    return run


# ------------------------------------------------------------- verification

def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in tv.pieces(batches):
        hashes, first = shingle_sets(part)
        data = [hashes[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([tv.column(part, "doc_id"), pa.array(data, pa.binary())], ["doc_id", "tokens"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = tv.column(batch, "left"), tv.column(batch, "right")
        ok = []
        for x, y in zip(left, right, strict=True):
            p, q = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
            ok.append(links(len(np.intersect1d(p, q, assume_unique=True)), len(p), len(q)))
        yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def verified(docs: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """The pairs (a, b) of doc ids that link, written to the shared folder.

    Only texts that occur in a pair are read into sets: a bitmap of fixed size
    (FILTER_BITS bits over the hashed ids) is broadcast; the joins drop the few
    texts that only share a bit.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    wanted = materialize(wanted, f"{name}-wanted")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    bitmap = (wanted.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    some = (docs.join(F.broadcast(bitmap), F.bitmap_bucket_number(place) == F.col("bucket"))
            .where(F.getbit(byte, (at % 8).cast("int")) == 1).select("doc_id", "text"))
    # sets of the few texts the bitmap lets through; texts themselves are never shuffled
    sets = materialize(some.mapInArrow(tv.tidy(_set_rows), "doc_id long, tokens binary"), f"{name}-sets")
    joined = (pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("left")), "a")
              .join(sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("right")), "b")
              .select("a", "b", "left", "right"))
    return materialize(joined.mapInArrow(tv.tidy(_verify), "a long, b long"), f"{name}-links")


# ----------------------------------------------------------------- together

def plausible(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs that the sketches of the profile do not rule out."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("n"), F.col("sketch").alias("left"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("m"), F.col("sketch").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "n", "m", "left", "right")
    return both.mapInArrow(tv.tidy(_not_ruled_out), "a long, b long").distinct()


def across_components(large: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of members of one signature group that lie in different components.

    Sizes and folded sketches are compared inside the join, so pairs that
    cannot link are never rows: linked sets differ in at most (n + m) / 7
    shingles, and folded sketches in at most as many bits. The groups have one
    order for all members; a pair that shares one of the last ``REMEMBERED``
    groups of both has met before. The first group of a pair always gives it.
    """
    members = materialize(large.select("a").distinct(), "op4-mixed-members")
    # rows that repeat an id bring one sketch each, and meet under all of them
    sketched = members.join(texts.select(F.col("doc_id").alias("a"), "sketch"), "a").distinct()
    words = materialize(sketched.mapInArrow(tv.tidy(_fold), "a long, " + ", ".join(f"{c} long" for c in FOLDED)), "op4-folded")
    before = Window.partitionBy("a", "n").orderBy("place").rowsBetween(-REMEMBERED, -1)
    large = large.withColumn("place", F.xxhash64(*GROUP)).withColumn("earlier", F.collect_list("place").over(before)).drop("place")
    large = large.join(words, "a")
    far = " + ".join(f"bit_count(l.{c} ^ r.{c})" for c in FOLDED)
    apart = (F.expr("l.bucket = r.bucket AND l.grp = r.grp AND l.comp < r.comp")
             & F.expr(f"{DEN} * least(l.n, r.n) >= {NUM} * greatest(l.n, r.n)")
             & F.expr(f"{NUM + DEN} * ({far}) <= {DEN - NUM} * (l.n + r.n)")
             & ~F.arrays_overlap("l.earlier", "r.earlier"))
    return large.alias("l").join(large.alias("r"), apart).select(F.least("l.a", "r.a").alias("a"), F.greatest("l.a", "r.a").alias("b"))


def _label(frame: DataFrame, column: str, labels: DataFrame, out: str) -> DataFrame:
    named = labels.select(F.col("id").alias(column), F.col("component").alias("found_"))
    return frame.join(named, column, "left").withColumn(out, F.coalesce("found_", column)).drop("found_")


def join_classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text)."""
    rows = documents(docs)
    spark = rows.sparkSession
    profile = materialize(rows.mapInArrow(tv.tidy(_profile), _PROFILE_SCHEMA), "op4-profile")
    texts = profile.where("kind = 0")
    sizes = texts.groupBy("n_shingles").agg(F.count("*").alias("n"), F.count("doc_id").alias("named")).toPandas().astype("int64")
    n, real_sizes = int(sizes["n"].sum()), sizes[(sizes["n_shingles"] > 0) & (sizes["named"] > 0)]
    # popular from n / 4000 texts on, so there are at most 4000 times the mean set size of them
    popular = (profile.where("kind = 1").groupBy("doc_id").agg(F.sum("n_shingles").alias("c"))
               .where(F.col("c") >= F.lit(max(8.0, n * POPULAR_SHARE))).select("doc_id").toPandas()["doc_id"]
               .to_numpy(np.int64).view(_U))
    popular = spark.sparkContext.broadcast(np.sort(popular))

    real = texts.where("n_shingles > 0 AND doc_id IS NOT NULL")
    key = ["n_shingles", "digest_a", "digest_b"]
    classes = materialize(real.groupBy(*key).agg(F.min("doc_id").alias("rep"),
                                                 *[F.first(c).alias(c) for c in _PROFILE[5:5 + MINIMA]]),
                          "op4-classes")
    # near copies of large groups: against the smallest class with the same minimum
    early = None
    for k in range(MINIMA):
        hub = (classes.groupBy(f"minimum_{k}").agg(F.min(F.struct("rep", "n_shingles")).alias("hub"), F.count("*").alias("c"))
               .where("c > 1").select(f"minimum_{k}", F.col("hub.rep").alias("a"), F.col("hub.n_shingles").alias("m")))
        hub = materialize(hub, "op4-hubs")
        near = (classes.join(hub, f"minimum_{k}").where("rep <> a")
                .where(f"{DEN} * least(n_shingles, m) >= {NUM} * greatest(n_shingles, m)")
                .select("a", F.col("rep").alias("b")))
        early = near if early is None else early.unionByName(near)
    early = materialize(plausible(early.distinct(), texts), "op4-early")
    found = verified(rows, early, "op4-early")
    labels = components(found, "op4-early")

    cells = Cells(real_sizes["n_shingles"].to_numpy(), real_sizes["named"].to_numpy())
    met = materialize(
        rows.mapInArrow(tv.tidy(_sign(popular, cells)),
                        "bucket long, high binary, low binary, texts binary, ids binary, digests binary, sizes binary, lost binary")
        .groupBy("bucket").applyInPandas(_meet_and_release(cells), "bucket long, grp long, a long, b long, n long"), "op4-groups")
    # equal sets sign alike, so the member left of each set is the smallest id of its class
    odd = (rows.mapInArrow(tv.tidy(_sign_irregular(popular)), "grp long, a long, digest long, n long")
           .groupBy("grp", "digest").agg(F.min("a").alias("a"), F.first("n").alias("n"))
           .select(F.lit(-1).cast("long").alias("bucket"), "grp", "a", "n"))
    large = met.where("b < 0").select("bucket", "grp", "a", "n").unionByName(odd)
    large = materialize(large, "op4-signed")
    large = _label(large, "a", labels, "comp")
    # per group and component its smallest member against the group's smallest: most near copies meet here
    few = materialize(large.groupBy(*GROUP, "comp").agg(F.min("a").alias("a")), "op4-few")
    hub = materialize(few.groupBy(*GROUP).agg(F.min("a").alias("hub"), F.count("*").alias("c")).where("c > 1"), "op4-few-hub")
    star = few.join(hub, GROUP).where("a <> hub").select(F.col("hub").alias("x"), "a")
    star = materialize(plausible(star.select(F.least("x", "a").alias("a"), F.greatest("x", "a").alias("b")).distinct(), texts),
                       "op4-star")
    found = materialize(found.unionByName(verified(rows, star, "op4-star")), "op4-found")
    labels = components(found, "op4-star")
    large = materialize(_label(large.drop("comp"), "a", labels, "comp"), "op4-members")
    mixed = large.groupBy(*GROUP).agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select(*GROUP)
    large = materialize(large.join(mixed, GROUP), "op4-large")
    across = across_components(large, texts)
    pairs = met.where("b >= 0").select("a", "b").distinct()
    pairs = _label(_label(pairs, "a", labels, "ca"), "b", labels, "cb").where("ca <> cb").select("a", "b")
    candidates = materialize(plausible(pairs.unionByName(across).distinct(), texts), "op4-candidates")
    late = verified(rows, candidates, "op4-late")
    labels = components(found.unionByName(late), "op4-all")

    whole = texts.select("doc_id", "n_shingles", "digest_a", "digest_b").join(
        classes.select(*key, "rep"), key, "left")
    out = _label(whole.withColumn("rep", F.coalesce("rep", "doc_id")), "rep", labels, "component_id")
    # a component's label is the smallest representative, which is the smallest id of its class
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id"))
                      .otherwise(F.col("doc_id")).alias("component_id"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns), one of each component: the smallest doc_id, null ids last.

    Rows whose id is null or repeated get numbers of their own first (written, so
    that they stay), so copies among them go as well.
    """
    odd_ids = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("odd_"))
    odd_ids = materialize(odd_ids, "op4-odd-ids")
    same = F.col("doc_id").eqNullSafe(F.col("odd_"))
    plain, largest = docs, docs.agg(F.max(F.col("doc_id").cast("long")).alias("m")).first()["m"]
    rows = docs.select("*", F.col("doc_id").cast("long").alias("row_"))
    if not odd_ids.isEmpty():
        number = F.monotonically_increasing_id() + F.lit((largest or 0) + 1)
        odd = materialize(docs.join(odd_ids, same, "left_semi").withColumn("row_", number), "op4-odd")
        plain = docs.join(odd_ids, same, "left_anti")
        rows = plain.withColumn("row_", F.col("doc_id").cast("long")).unionByName(odd)
    classes = join_classes(rows.select(F.col("row_").alias("doc_id"), "text")).select(
        F.col("doc_id").alias("row_"), "component_id")
    if odd_ids.isEmpty():
        gone = classes.where("row_ > component_id").select("row_")
    else:
        known = rows.select("row_", F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast("long").alias("id"))
        classes = materialize(classes.join(known, "row_"), "op4-classes-by-row")
        first = classes.groupBy("component_id").agg(F.min(F.struct("none", "id", "row_")).alias("best"))
        gone = classes.join(first, "component_id").where("row_ <> best.row_").select("row_")
    gone = materialize(gone, "op4-gone")
    return rows.join(gone, "row_", "left_anti").select(*docs.columns)
