"""Simple-8b with escapes, in blocks, as numpy operations on whole arrays.

Every 64-bit word has a selector in its upper four bits and `count` values of `bits` bits below them, the
first value lowest. Selector 1 is the escape: its value needs more than 60 bits and is the next one of a
separate array. Every block holds BLOCK values (the last one fewer) and starts a word of its own, so blocks
are packed and unpacked side by side; the offset of each block's first word is stored.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1024
U64 = np.uint64
ESCAPE = 1
#: Fixed values of the format: values and bits per word, by selector.
COUNTS = np.array([240, 1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])


def narrowest(values: np.ndarray) -> np.ndarray:
    """For each value the first selector whose width holds it; 16 if none does."""
    widths = np.searchsorted(BITS[2:], np.arange(66)) + 2
    widths[0] = 0
    widths = widths.astype(np.int8)
    if values.max() < 1 << 16:
        table = widths[np.frexp(np.arange(1 << 16, dtype=np.float64))[1]]
        return table[values]
    return widths[np.frexp(values.astype(np.float64))[1]]


def selectors(values: np.ndarray) -> np.ndarray:
    """For each position the selector that a word starting there would take: the most values that fit.

    Every word is full and ends inside its block.
    """
    need = np.full(-(-len(values) // BLOCK) * BLOCK, 100, dtype=np.int8)
    need[: len(values)] = narrowest(values)
    need = need.reshape(-1, BLOCK)
    chosen = np.full(need.shape, ESCAPE, dtype=np.int8)
    here = np.arange(len(need))
    widest = {1: need}
    for selector in range(len(COUNTS) - 1, -1, -1):
        if selector == ESCAPE:
            continue
        count, size = COUNTS[selector], max(widest)
        while size < count:
            step = min(size, count - size)
            widest = {size + step: np.maximum(widest[size][:, : BLOCK - size - step + 1], widest[size][:, step : BLOCK - size + 1])}
            size += step
        fits = widest[size] <= selector
        useful = fits.any(axis=1)
        if not useful.all():
            here, fits, widest = here[useful], fits[useful], {size: widest[size][useful]}
            if not len(here):
                break
        mine = chosen if len(here) == len(chosen) else chosen[here]
        np.copyto(mine[:, : fits.shape[1]], selector, where=fits)
        if mine is not chosen:
            chosen[here] = mine
    return chosen.ravel()


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, escaped values and the word offset of each block."""
    values = np.ascontiguousarray(values, dtype=U64)
    if not len(values):
        return np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, np.int32)
    chosen = selectors(values)
    at = np.arange(0, len(chosen), BLOCK)
    ends = np.minimum(at + BLOCK, len(values))
    steps = COUNTS[chosen]
    taken = np.zeros(len(chosen), dtype=bool)
    while len(at):
        taken[at] = True
        at = at + steps[at]
        going = at < ends
        at, ends = at[going], ends[going]
    starts = np.flatnonzero(taken)
    kinds = chosen[starts]
    words = kinds.astype(U64) << U64(60)
    for selector in np.unique(kinds):
        if BITS[selector] in (0, 64):
            continue
        mine = np.flatnonzero(kinds == selector)
        first = starts[mine]
        packed = np.zeros(len(mine), dtype=U64)
        for k in range(COUNTS[selector]):
            packed |= values[first + k] << U64(k * BITS[selector])
        words[mine] |= packed
    offsets = np.searchsorted(starts, np.arange(0, len(values), BLOCK)).astype(np.int32)
    return words, values[starts[kinds == ESCAPE]], offsets


def unpack(words: np.ndarray, escapes: np.ndarray, offsets: np.ndarray, count: int) -> np.ndarray:
    """The `count` values that pack() has packed."""
    out = np.zeros(count, dtype=U64)
    if not count:
        return out
    kinds = (words >> U64(60)).astype(np.int64)
    counts = COUNTS[kinds]
    starts = np.cumsum(counts) - counts
    out[starts[kinds == ESCAPE]] = escapes
    for selector in np.unique(kinds):
        bits = int(BITS[selector])
        if bits in (0, 64):
            continue
        mine = np.flatnonzero(kinds == selector)
        mask = U64((1 << bits) - 1)
        payload, first = words[mine], starts[mine]
        for k in range(COUNTS[selector]):
            out[first + k] = (payload >> U64(k * bits)) & mask
    return out


def unpack_block(words: np.ndarray, escapes: np.ndarray, offsets: np.ndarray, count: int, block: int) -> np.ndarray:
    """The values of one block, found by its offset."""
    first, last = offsets[block], offsets[block + 1] if block + 1 < len(offsets) else len(words)
    skipped = int(((words[:first] >> U64(60)) == ESCAPE).sum())
    return unpack(words[first:last], escapes[skipped : skipped + int(((words[first:last] >> U64(60)) == ESCAPE).sum())], offsets, min(BLOCK, count - block * BLOCK))
