"""Benchmark decontamination with suffix arrays of the training texts.

Each task builds, shard by shard, a suffix array over the word numbers of its training texts and
binary-searches every test suffix in it. A shard is a block of documents; nothing is shuffled. Of the
training suffixes only those are sorted whose first words start some test window: no other suffix can
match one, so the array is sparse but the matches are complete. Test suffixes with equal windows are searched
once, and a place is listed once for each item that has its window, however often it has it.

Matches are the longest verbatim ones from the left: from the first place of an item's window the match goes on as
long as the item has the same words at one place, the first of equal ones; the next match starts at the next window
after it. In an item that repeats a window the longest match is found in the item's own suffix array, by narrowing
its interval window by window, so that equal words cost no more than their number.

Definitions. A window is `words` consecutive words of a test item, or all words of a shorter item that has
any. A document word inside any occurrence of a window is hit; a document is contaminated if
`share_of * hits >= words` and there is a hit. Null and empty texts have no words, are never hit and stay.
Repeated items and repeated documents count like any other row; an item without an id hits but isn't listed.
An empty benchmark hits nothing. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm._frame import unused
from gleaner.llm._text import blocks, lean, window_hashes, word_hashes

#: Test text that goes to all tasks at once. A larger benchmark is searched in several such blocks.
BLOCK_BYTES = 32 << 20
LEAD = 3
#: Training suffixes in one array.
SHARD = 1 << 18

MATCH = T.StructType([
    T.StructField("item_id", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("item_start", T.LongType()), T.StructField("n_words", T.LongType()),
])


class Windows(NamedTuple):
    """The windows of one size: distinct ones in order, and for each the items that have it with their first place."""

    size: int
    suffixes: np.ndarray
    leads: np.ndarray
    seen: np.ndarray
    offsets: np.ndarray
    items: np.ndarray
    starts: np.ndarray
    #: The distinct windows of item after item, and where an item's begin and end.
    sequence: np.ndarray
    edges: dict[int, tuple[int, int]]
    #: Items that have a window twice.
    repeating: np.ndarray


class TestSuffixes:
    """The windows of a block of test items, grouped by their number of words."""

    __test__ = False

    def __init__(self, items: list[tuple[str | None, str | None]], words: int):
        batch = pa.RecordBatch.from_pydict({"text": pa.array([t for _, t in items], pa.large_string())})
        hashes, rows = word_hashes(batch, "text")
        self.ids = [i for i, _ in items]
        self.arrays: dict[int, list[int]] = {}
        lengths = np.diff(rows)
        self.groups = []
        for size in np.unique(np.minimum(lengths[lengths > 0], words)):
            of = np.flatnonzero(np.minimum(lengths, words) == size)
            counts = lengths[of] - size + 1
            ends = np.cumsum(counts)
            item = np.repeat(of, counts)
            start = np.arange(counts.sum()) - np.repeat(ends - counts, counts)
            suffixes = hashes[(rows[item] + start)[:, None] + np.arange(size)]
            order = np.lexsort(suffixes.T[::-1])
            new = np.ones(len(order), dtype=bool)
            new[1:] = (suffixes[order[1:]] != suffixes[order[:-1]]).any(axis=1)
            window = np.empty(len(order), dtype=np.int64)
            window[order] = np.cumsum(new) - 1
            suffixes = suffixes[order[new]]
            leads = np.unique(window_hashes_of(suffixes[:, : min(LEAD, size)]))
            seen = np.zeros(1 << 20, dtype=bool)
            seen[leads & np.uint64(len(seen) - 1)] = True
            order = np.lexsort((start, item, window))
            first = np.ones(len(order), dtype=bool)
            first[1:] = (window[order[1:]] != window[order[:-1]]) | (item[order[1:]] != item[order[:-1]])
            own = order[first]
            edges = dict(zip(of.tolist(), zip((ends - counts).tolist(), ends.tolist(), strict=True), strict=True))
            self.groups.append(Windows(
                int(size), suffixes, leads, seen, np.searchsorted(window[own], np.arange(len(suffixes) + 1)), item[own], start[own],
                window, edges, np.unique(item[order[~first]]),
            ))

    def array_of(self, group: Windows, item: int) -> list[int]:
        """The suffix array of an item's windows, made when it is needed first."""
        if item not in self.arrays:
            self.arrays[item] = suffix_array(group.sequence[slice(*group.edges[item])]).tolist()
        return self.arrays[item]


def suffix_array(values: np.ndarray) -> np.ndarray:
    """By doubling; a suffix that ends stands before the longer ones."""
    rank = np.unique(values, return_inverse=True)[1]
    step = 1
    while True:
        after = np.full(len(rank), -1)
        after[:-step] = rank[step:]
        order = np.lexsort((after, rank))
        more = (rank[order[1:]] != rank[order[:-1]]) | (after[order[1:]] != after[order[:-1]])
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(more)))
        if more.all():
            return order
        step *= 2


def window_hashes_of(suffixes: np.ndarray) -> np.ndarray:
    return window_hashes(np.ascontiguousarray(suffixes).ravel(), suffixes.shape[1])[:: suffixes.shape[1]]


def before(a: np.ndarray, b: np.ndarray, or_equal: bool) -> np.ndarray:
    """Row-wise a < b (or a <= b) in the order of the suffix array."""
    unlike = a != b
    first = unlike.argmax(axis=1)
    at = np.arange(len(a))
    return np.where(unlike.any(axis=1), a[at, first] < b[at, first], or_equal)


def bound(array: np.ndarray, suffixes: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of all test suffixes at once in a sorted array of training suffixes."""
    low = np.zeros(len(suffixes), dtype=np.int64)
    high = np.full(len(suffixes), len(array), dtype=np.int64)
    while len(open_ := np.flatnonzero(low < high)):
        middle = (low[open_] + high[open_]) // 2
        goes_on = before(array[middle], suffixes[open_], right)
        low[open_[goes_on]] = middle[goes_on] + 1
        high[open_[~goes_on]] = middle[~goes_on]
    return low


def occurrences(hashes: np.ndarray, rows: np.ndarray, tests: TestSuffixes) -> list[tuple[Windows, np.ndarray, np.ndarray]]:
    """For each group of windows: the training places where one occurs, and which."""
    found = []
    ends = np.repeat(rows[1:], np.diff(rows))
    for group in tests.groups:
        size = group.size
        keys = window_hashes(hashes, min(LEAD, size))
        at = np.flatnonzero(group.seen[keys & np.uint64(len(group.seen) - 1)])
        at = at[(at + size <= ends[at]) & np.isin(keys[at], group.leads)]
        for k in range(0, len(at), SHARD):
            shard = at[k : k + SHARD]
            array = hashes[shard[:, None] + np.arange(size)]
            order = np.lexsort(array.T[::-1])
            array, shard = array[order], shard[order]
            low, high = bound(array, group.suffixes, False), bound(array, group.suffixes, True)
            counts = high - low
            window = np.repeat(np.arange(len(low)), counts)
            place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
            if len(window):
                found.append((group, shard[place], window))
    return found


def narrowed(at: list[int], windows: list[int], values: list[int], array: list[int]) -> Iterator[tuple[int, int, int]]:
    """Places of an item's windows in one document as longest matches: first place, place in the item, windows."""
    k = 0
    while k < len(at):
        low, high, size = 0, len(array), 0
        while k + size < len(at) and at[k + size] == at[k] + size:

            def sign(suffix: int, size=size) -> int:
                return values[suffix + size] if suffix + size < len(values) else -1

            left = bisect_left(array, windows[k + size], low, high, key=sign)
            right = bisect_right(array, windows[k + size], left, high, key=sign)
            if left == right:
                break
            low, high, size = left, right, size + 1
        yield at[k], min(array[low:high]), size
        k += size


def longest(found: list[tuple[Windows, np.ndarray, np.ndarray]], rows: np.ndarray, tests: TestSuffixes) -> list[list[dict]]:
    """The longest verbatim matches of each document with each item."""
    out: list[list[dict]] = [[] for _ in range(len(rows) - 1)]
    by_size: dict[int, list[tuple]] = {}
    for group, at, window in found:
        by_size.setdefault(group.size, []).append((group, at, window))
    for parts in by_size.values():
        group = parts[0][0]
        at, window = (np.concatenate([p[k] for p in parts]) for k in (1, 2))
        counts = group.offsets[window + 1] - group.offsets[window]
        own = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(group.offsets[window], counts)
        at, window, item, start = np.repeat(at, counts), np.repeat(window, counts), group.items[own], group.starts[own]
        order = np.lexsort((at, item))
        at, window, item, start = at[order], window[order], item[order], start[order]
        row = np.searchsorted(rows, at, side="right") - 1
        repeating = np.isin(item, group.repeating)
        breaks = np.ones(len(at) + 1, dtype=bool)
        breaks[1:-1] = (item[1:] != item[:-1]) | (row[1:] != row[:-1])
        follows = (at[1:] == at[:-1] + 1) & (start[1:] == start[:-1] + 1)
        breaks[1:-1] |= ~repeating[1:] & ~follows
        edges = np.flatnonzero(breaks)
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            r, i = row[a], int(item[a])
            if repeating[a]:
                values = group.sequence[slice(*group.edges[i])].tolist()
                runs = narrowed(at[a:b].tolist(), window[a:b].tolist(), values, tests.array_of(group, i))
            else:
                runs = [(int(at[a]), int(start[a]), int(b - a))]
            out[r] += [{"item_id": tests.ids[i], "start": int(p - rows[r]), "item_start": s, "n_words": n - 1 + group.size} for p, s, n in runs]
    return out


def test_blocks(benchmark: DataFrame, item: str, text: str) -> list[DataFrame]:
    """The benchmark in blocks of at most about BLOCK_BYTES, one if it is that small."""
    size = benchmark.agg(F.sum(F.octet_length(F.col(text)) + 64).alias("bytes")).first()["bytes"] or 0
    count = max(1, -(-int(size) // BLOCK_BYTES))
    pairs = benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t"))
    if count == 1:
        return [pairs]
    return [pairs.where(F.pmod(F.xxhash64("i", "t"), F.lit(2 * count)) == k) for k in range(2 * count)]


def find_matches(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id",
    item_text: str = "text", words: int = 13,
) -> tuple[DataFrame, str, str]:
    """All rows and columns of `docs`, with the number of words and the longest verbatim matches of each.

    Returns the frame and the names of its two new columns: a long, and an array of structs (item_id as
    text, start and item_start in words, n_words).
    """
    n_words, matches = unused(docs, "n_words"), unused(docs, "matches")
    context = docs.sparkSession.sparkContext
    out = docs
    for number, block in enumerate(test_blocks(benchmark, item, item_text)):
        tests = context.broadcast(TestSuffixes([tuple(r) for r in block.collect()], words))
        first = number == 0

        def search(batches: Iterator[pa.RecordBatch], tests=tests, first=first) -> Iterator[pa.RecordBatch]:
            for batch in blocks(batches, text, 1 << 20):
                hashes, rows = word_hashes(batch, text)
                found = longest(occurrences(hashes, rows, tests.value), rows, tests.value)
                if first:
                    columns = [*batch.columns, pa.array(np.diff(rows))]
                else:
                    columns = list(batch.columns[:-1])
                    found = [a + b for a, b in zip(batch.columns[-1].to_pylist(), found, strict=True)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, ARROW_MATCHES)], names=names)

        schema = T.StructType([*docs.schema.fields, T.StructField(n_words, T.LongType()), T.StructField(matches, T.ArrayType(MATCH))])
        names = schema.names
        out = out.mapInArrow(lean(search), schema)
    return out, n_words, matches


ARROW_MATCHES = pa.list_(pa.struct([
    ("item_id", pa.string()), ("start", pa.int64()), ("item_start", pa.int64()), ("n_words", pa.int64()),
]))


def hit_words(matches):
    """Column: words inside any of the matches. Matches are walked by start; overlaps count once."""
    ordered = F.array_sort(F.transform(matches, lambda m: F.struct(m["start"].alias("a"), (m["start"] + m["n_words"]).alias("b"))))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(
        ordered, zero,
        lambda s, m: F.struct(
            (s["n"] + F.greatest(F.lit(0).cast("long"), m["b"] - F.greatest(s["end"], m["a"]))).alias("n"),
            F.greatest(s["end"], m["b"]).alias("end"),
        ),
        lambda s: s["n"],
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, share_of: int = 20, **names) -> DataFrame:
    """`docs` without the contaminated rows; all its columns and no other."""
    found, n_words, matches = find_matches(docs, benchmark, **names)
    hits = hit_words(F.col(matches))
    return found.where(~((hits > 0) & (hits * share_of >= F.col(n_words)))).drop(n_words, matches)


def op6_decontaminate(spark, sf_dir: str) -> DataFrame:
    """The verdict on every document against the whole benchmark."""
    from gleaner.llm._frame import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, n_words, matches = find_matches(docs, table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.array_distinct(F.filter(F.transform(matches, lambda m: m["item_id"]), lambda i: i.isNotNull())))
    return found.select(
        "doc_id", F.col(n_words).alias("n_words"), hit_words(F.col(matches)).alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
    ).select("*", ((F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))).alias("contaminated"))
