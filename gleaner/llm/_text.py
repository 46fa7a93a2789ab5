"""Texts as numpy arrays: UTF-8 bytes, words and rolling hashes of whole Arrow batches.

A word is `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z lower-cased: digits, a-z and every
code point from U+0080 on. In UTF-8 that is a test on single bytes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Multiplier of the polynomial hashes (odd, so that it has an inverse modulo 2^64), and that inverse.
BASE = 0x9E3779B97F4A7C55
INVERSE = pow(BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD_BYTE = np.zeros(256, dtype=bool)
WORD_BYTE[48:58] = WORD_BYTE[65:91] = WORD_BYTE[97:123] = True
WORD_BYTE[128:] = True

_powers: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """base^0 .. base^(count-1) modulo 2^64; kept, since every block asks for them."""
    have = _powers.get(base)
    if have is None or len(have) < count:
        factors = np.full(1 << max(20, (count - 1).bit_length()), base, dtype=U64)
        factors[0] = 1
        have = _powers[base] = np.multiply.accumulate(factors)
    return have[:count]


#: What a worker remembers from task to task, by operator.
memories: dict[str, object] = {}


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keep: str = "") -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run` for a worker that lives on: it begins without the memories of operators other than `keep`, and what is
    free at its end goes back to the system. Spark keeps workers, and an idle one's memory counts like a busy one's."""

    def lean_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name in memories.keys() - {keep}:
            del memories[name]
        give_back()
        try:
            yield from run(batches)
        finally:
            give_back()

    return lean_run


def give_back() -> None:
    """Freed memory of Arrow and of the C library goes to the system; without glibc, Arrow's only."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, one after another, and len + 1 offsets; null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of about `limit` text bytes, a single longer text being its own piece."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = utf8(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and len + 1 offsets of each text's words. No word crosses texts."""
    inside = np.zeros(len(raw) + 2, dtype=bool)
    inside[1:-1] = WORD_BYTE[raw]
    starts_here, ends_here = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(raw))]
    cut = edges[inside[edges] & inside[edges + 1]]
    starts_here[cut] = ends_here[cut] = True
    starts, ends = np.flatnonzero(starts_here), np.flatnonzero(ends_here)
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of raw[start:end] for all spans at once, by prefix sums of a polynomial."""
    sums = np.zeros(len(raw) + 1, dtype=U64)
    np.cumsum((raw.astype(U64) + U64(1)) * powers(BASE, len(raw)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(INVERSE, len(raw) + 1)[starts])


def window_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` neighbouring values (len - size + 1 of them), order counting."""
    count = len(values) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=U64)
    out = np.zeros(count, dtype=U64)
    for k in range(size):
        out *= U64(BASE)
        out += values[k : k + count]
    return mix(out)


def word_hashes(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column, and the len + 1 offsets of each row's words."""
    raw, offsets = utf8(batch.column(column))
    lowered = LOWER[raw]
    starts, ends, rows = word_spans(lowered, offsets)
    return span_hashes(lowered, starts, ends), rows
