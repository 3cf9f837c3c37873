"""Vectorised text work inside tasks: UTF-8 buffers of Arrow columns, words and
their 64-bit hashes, without one Python object per word."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_RNG = np.random.RandomState(20240229)
_P = U64(0x9E3779B97F4A7C15)
_TABLES: dict[str, np.ndarray] = {}
#: powers that a worker keeps between tasks
KEPT_POWERS = 1 << 16

#: white space of a word pattern [^\x20\x09-\x0D]+
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: one random 64-bit value per byte; white space counts nothing
BYTE_CODE = _RNG.randint(1, 2**62, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
BYTE_CODE[SPACE] = 0


def release_memory() -> None:
    """Give what a finished task has freed back to the system: workers are reused, and wait with what they hold.

    Powers beyond the usual run of texts go as well; the next task that needs them computes them anew.
    """
    if len(_TABLES.get("pow", ())) > KEPT_POWERS:
        _TABLES.pop("pow"), _TABLES.pop("inv")
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def tidy(run: Callable) -> Callable:
    """A function over Arrow batches that releases its memory once its task ends."""
    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return wrapped


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and its inverse modulo 2**64, for i < n."""
    if "pow" not in _TABLES or len(_TABLES["pow"]) < n:
        size = max(n, KEPT_POWERS)
        inverse = U64(pow(int(_P), -1, 2**64))
        for name, base in (("pow", _P), ("inv", inverse)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _TABLES[name] = np.multiply.accumulate(steps)
    return _TABLES["pow"][:n], _TABLES["inv"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x = x * U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def mix_int(x: int) -> int:
    return int(mix(np.array([x & (2**64 - 1)], U64))[0])


def mix_int_u(x: int) -> np.uint64:
    return U64(mix_int(x))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8, int(offs[-1] - offs[0]), int(offs[0])) if data is not None and offs[-1] > offs[0] \
        else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text",
           max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows of about ``max_bytes`` of text each; a row is never cut."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offs = utf8(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offs, offs[at] + max_bytes, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


class Words:
    """The words of a run of texts: lower-cased ASCII, split at white space.

    ``starts``/``ends`` index ``low``; ``first[d]:first[d+1]`` are the words of
    text ``d``; ``hashes`` are 64-bit word hashes.
    """

    def __init__(self, raw: np.ndarray, offs: np.ndarray):
        self.offs = offs
        self.low = low = LOWER[raw]
        n = len(low)
        solid = ~SPACE[low]
        begin = solid.copy()
        begin[1:] &= ~solid[:-1]
        inner = offs[1:-1]
        inner = inner[inner < n]
        begin[inner] = solid[inner]
        self.starts = np.flatnonzero(begin)
        self.first = np.searchsorted(self.starts, offs)
        if len(self.starts):
            stop = solid.copy()
            stop[:-1] &= ~solid[1:]
            edge = offs[1:-1]
            edge = edge[edge > 0] - 1
            stop[edge] = solid[edge]
            self.ends = np.flatnonzero(stop) + 1
            pow_, inv = powers(n)
            codes = BYTE_CODE[low]
            codes *= pow_
            self.hashes = mix(np.add.reduceat(codes, self.starts) * inv[self.starts])
        else:
            self.ends = np.zeros(0, np.int64)
            self.hashes = np.zeros(0, U64)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def words_of(batch: pa.RecordBatch, text: str = "text") -> Words:
    return Words(*utf8(column(batch, text)))


def segment_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of values[first[i]:first[i+1]] for every i; empty runs give 0."""
    sizes = np.diff(first)
    out = np.zeros((len(sizes), *values.shape[1:]), values.dtype if values.dtype != bool else np.int64)
    full = sizes > 0
    if full.any():
        out[full] = np.add.reduceat(values, first[:-1][full], axis=0, dtype=out.dtype)
    return out
