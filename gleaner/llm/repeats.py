"""Repeated passages by the interval tree of an enhanced suffix array over sampled suffixes.

Every LENGTH-byte string of a text holds an anchor: the SEED-byte string with the smallest hash among its
own. Equal strings have equal anchors, so the suffixes that start at anchors (one byte in about sixteen) are
a sparse suffix array that loses no repeat of LENGTH bytes. Rows meet by anchor. What surrounds an anchor as
far as a string of LENGTH bytes can reach is its context: LENGTH bytes to the right, LENGTH - SEED to the left.

1. Anchors travel with a hash of their context. Where a whole context repeats, its occurrences are known.
2. Only where one anchor has several contexts, the first occurrence of each sends its bytes. These suffixes
   are sorted; a stack over their longest common prefixes finds the intervals of the array, each a repeat to
   the right with all its occurrences. Within an interval the bytes to the left are scanned in the same way:
   where they part, the repeat can't be extended to the left, and each set with LENGTH bytes in all is a
   maximal repeat group. Anchors with more than HOT contexts are cut into their strings of LENGTH bytes,
   which are aggregated by hash, so that no group has to fit in a task.

A group's first text is the one with the smallest key; its other occurrences are spans that can go. Equal
texts are one text, that of the smallest key; with LENGTH bytes or more the others are spans as a whole.

Definitions. Texts are UTF-8 bytes; null is empty. Matches never cross texts, and are judged on the input. A
text shorter than LENGTH has no repeat. Rows with one key are one text if equal, else each is judged against
smaller keys only. Rows without a key keep all and repeat nothing. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm._frame import release, settle, stored, table
from gleaner.llm._text import BASE, INVERSE, U64, blocks, mix, powers, utf8

LENGTH, SEED = 50, 16
HOT = 100_000
#: Keys and hashes of texts that all tasks may get; more are joined by shuffle.
BROADCAST_ROWS = 500_000
#: A place is variant * PLACE + position: texts of one key differ in the variant.
PLACE = 1 << 40


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    size = 1
    while size < width:
        step = min(size, width - size)
        values = pick(values[:-step], values[step:])
        size += step
    return values


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(raw) + 1, dtype=U64)
    np.cumsum((raw.astype(U64) + U64(1)) * powers(BASE, len(raw)), out=sums[1:])
    return sums


def anchors_of(raw: np.ndarray, offsets: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Positions of all anchors of a block of texts, their rows, keys and hashes of their contexts."""
    none = np.zeros(0, dtype=np.int64)
    if len(raw) < length:
        return none, none, none, none
    width = length - seed + 1
    sums = prefix_sums(raw)
    hashes = (sums[seed:] - sums[:-seed]) * powers(INVERSE, len(raw) + 1)[: len(raw) - seed + 1]
    order = ((hashes * U64(0xBF58476D1CE4E5B9)) >> U64(32)).astype(np.uint32)
    least = sliding(order, width, np.minimum)
    start = np.zeros(len(least) + 1, dtype=np.int32)  # strings that cross the end of a text don't count
    lows, highs = np.maximum(offsets[1:] - length + 1, offsets[:-1]), np.minimum(offsets[1:], len(least))
    crossing = lows < highs
    np.add.at(start, lows[crossing], 1)
    np.add.at(start, highs[crossing], -1)
    least[np.cumsum(start[:-1]) > 0] = 0
    edge = np.zeros(width - 1, dtype=np.uint32)
    chosen = sliding(np.concatenate([edge, least, edge]), width, np.maximum) == order
    at = np.flatnonzero(chosen & (order > 0))
    row = np.searchsorted(offsets, at, side="right") - 1
    left, right = np.maximum(at - (length - seed), offsets[row]), np.minimum(at + length, offsets[row + 1])
    context = mix((sums[right] - sums[left]) * powers(INVERSE, len(raw) + 1)[left]) ^ mix((at - left).astype(U64) * U64(256) + (right - at).astype(U64))
    return at, row, mix(hashes[at]).view(np.int64), context.view(np.int64)


def find_anchors(texts: DataFrame, length: int, seed: int) -> DataFrame:
    """(anchor, context, id, at) of each anchor of each row of (id, variant, t)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "t", 1 << 20):
            raw, offsets = utf8(batch.column("t"))
            at, row, anchor, context = anchors_of(raw, offsets, length, seed)
            variant = batch.column("variant").to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(context), batch.column("id").take(pa.array(row)), pa.array(variant[row] * PLACE + at - offsets[row])],
                names=["anchor", "context", "id", "at"],
            )

    return texts.select("id", "variant", "t").mapInArrow(run, f"anchor long, context long, id {texts.schema['id'].dataType.simpleString()}, at long")


def contexts_of(places: DataFrame, length: int, seed: int) -> DataFrame:
    """(anchor, hot, bytes, id, at): the bytes around each place of rows (id, t, places)."""
    reach = length - seed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "t", 1 << 20):
            raw, offsets = utf8(batch.column("t"))
            lists = batch.column("places")
            flat = lists.flatten()
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            anchor, at, hot = (flat.field(k) for k in range(3))
            here = offsets[row] + at.to_numpy(zero_copy_only=False) % PLACE
            padded = np.concatenate([np.zeros(reach, np.uint8), raw, np.zeros(length, np.uint8)])
            out = np.empty((len(here), length + reach + 2), dtype=np.uint8)
            to_right, to_left = np.minimum(offsets[row + 1] - here, length), np.minimum(here - offsets[row], reach)
            out[:, :length] = padded[here[:, None] + reach + np.arange(length)]
            out[:, length:-2] = padded[here[:, None] + reach - 1 - np.arange(reach)]
            out[:, :length][np.arange(length) >= to_right[:, None]] = 0
            out[:, length:-2][np.arange(reach) >= to_left[:, None]] = 0
            out[:, -2], out[:, -1] = to_right, to_left
            packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(out.shape[1]), len(out), [None, pa.py_buffer(out)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([anchor, hot, packed, batch.column("id").take(pa.array(row)), at], names=["anchor", "hot", "bytes", "id", "at"])

    return places.select("id", "t", "places").mapInArrow(run, f"anchor long, hot boolean, bytes binary, id {places.schema['id'].dataType.simpleString()}, at long")


def intervals(common: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of the intervals of a sorted array with at least `least` common bytes.

    `common` holds the common prefix of each neighbouring pair. One scan with a stack (Abouelhoda, Kurtz and
    Ohlebusch): an interval closes when the common prefix falls below its depth.
    """
    stack: list[tuple[int, int]] = []
    for k, depth in enumerate([*common, -1]):
        first = k
        while stack and stack[-1][0] > depth:
            closed, first = stack.pop()
            if closed >= least:
                yield closed, first, k
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def common_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    unlike = a != b
    return np.where(unlike.any(axis=1), unlike.argmax(axis=1), a.shape[1])


def maximal_groups(right: np.ndarray, left: np.ndarray, least: int, length: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(bytes to the left, bytes to the right, members) of the maximal repeats of the contexts of one anchor.

    The contexts are distinct and sorted by their right sides.
    """
    for depth, first, last in intervals(common_prefix(right[1:], right[:-1]).tolist(), least):
        mine = left[first : last + 1]
        order = np.lexsort(mine.T[::-1])
        mine = mine[order]
        shared = common_prefix(mine[1:], mine[:-1])
        if shared.min() == left.shape[1]:  # nothing parts to the left
            yield left.shape[1], depth, np.arange(first, last + 1)
            continue
        for back, a, b in intervals(shared.tolist(), max(length - depth, 0)):
            yield back, depth, first + order[a : b + 1]


def scan(group: pa.Table, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions in the group and bytes to the left and right of each covered occurrence."""
    anchor = group.column("anchor").to_numpy()
    data = np.frombuffer(b"".join(group.column("bytes").to_pylist()), dtype=np.uint8).reshape(len(anchor), -1)
    rank = group.column("id").combine_chunks().dictionary_encode()
    names = rank.dictionary.to_numpy(zero_copy_only=False)
    places = np.empty(len(names), dtype=np.int64)
    places[np.argsort(names, kind="stable")] = np.arange(len(names))
    key = places[rank.indices.to_numpy()]
    new_anchor = np.concatenate([[True], anchor[1:] != anchor[:-1]])
    new_class = new_anchor | np.concatenate([[True], (data[1:] != data[:-1]).any(axis=1)])
    of_class = np.cumsum(new_class) - 1
    heads = np.flatnonzero(new_class)
    lowest = np.minimum.reduceat(key, heads)
    right, left, sizes = data[heads, :length], data[heads, length:-2], data[heads, -2:].astype(np.int64)
    back, ahead = np.full(len(heads), -1), np.zeros(len(heads), dtype=np.int64)
    starts = np.flatnonzero(new_anchor[heads])
    counts = np.diff(np.append(starts, len(heads)))
    two = starts[counts == 2]
    if len(two):
        a, b = two, two + 1
        depth = np.minimum(common_prefix(right[a], right[b]), np.minimum(sizes[a, 0], sizes[b, 0]))
        shared = np.minimum(common_prefix(left[a], left[b]), np.minimum(sizes[a, 1], sizes[b, 1]))
        ok = (depth + shared >= length) & (lowest[a] != lowest[b])
        later = np.where(lowest[a] > lowest[b], a, b)[ok]
        back[later], ahead[later] = shared[ok], depth[ok]
    for start, count in zip(starts[counts > 2], counts[counts > 2], strict=True):
        here = slice(start, start + count)
        for shared, depth, members in maximal_groups(right[here], left[here], seed, length):
            extend(back, ahead, members + start, lowest, sizes, shared, depth, length)
    # All spans of a place hold the anchor, so their union is one span.
    rows = np.flatnonzero((back[of_class] >= 0) & (key == lowest[of_class]))
    return rows, back[of_class[rows]], ahead[of_class[rows]]


def extend(back: np.ndarray, ahead: np.ndarray, members: np.ndarray, lowest: np.ndarray, sizes: np.ndarray, shared: int, depth: int, length: int) -> None:
    """Stretch the spans of the members that a smaller key precedes to what they share with it inside both texts."""
    s, d = np.minimum(shared, sizes[members, 1]), np.minimum(depth, sizes[members, 0])
    fits = s + d >= length
    members, s, d = members[fits], s[fits], d[fits]
    if not len(members):
        return
    if s.min() == shared and d.min() == depth:
        cuts = [(shared, depth)]
    else:
        cuts = list({(int(x), int(y)) for x, y in zip(s, d, strict=True)})
    for x, y in cuts:
        some = members if len(cuts) == 1 else members[(s >= x) & (d >= y)]
        low = lowest[some]
        later = some[low > low.min()]
        back[later] = np.maximum(back[later], x)
        ahead[later] = np.maximum(ahead[later], y)


def part_repeats(contexts: DataFrame, length: int, seed: int) -> DataFrame:
    """(id, at, back, ahead): the places of contexts that share LENGTH bytes or more with one of a smaller key."""
    kind = contexts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(group: pa.Table) -> Iterator[pa.RecordBatch]:
            rows, back, ahead = scan(group, length, seed)
            if len(rows):
                some = group.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([some.column("id").combine_chunks(), some.column("at").combine_chunks(), pa.array(back), pa.array(ahead)], names=["id", "at", "back", "ahead"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            anchor = batch.column("anchor").to_numpy(zero_copy_only=False)
            cut = int(np.searchsorted(anchor, anchor[-1]))
            if cut or anchor[0] != held[0].column("anchor")[0].as_py():
                whole = pa.Table.from_batches([*held[:-1], batch.slice(0, cut)])
                held = [batch.slice(cut)]
                if whole.num_rows:
                    yield from done(whole)
        if held:
            yield from done(pa.Table.from_batches(held))

    spread = contexts.select("anchor", "bytes", "id", "at").repartition("anchor").sortWithinPartitions("anchor", "bytes", "id", "at")
    return spread.mapInArrow(run, f"id {kind}, at long, back long, ahead long")


def string_repeats(contexts: DataFrame, length: int, seed: int) -> DataFrame:
    """The same for anchors with very many contexts: all their strings of LENGTH bytes, aggregated by hash."""
    kind = contexts.schema["id"].dataType.simpleString()
    reach = length - seed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = np.frombuffer(b"".join(batch.column("bytes").to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1)
            line = np.hstack([data[:, length:-2][:, ::-1], data[:, :length]])
            for back in range(reach + 1):
                row = np.flatnonzero((data[:, -1] >= back) & (data[:, -2] >= length - back))
                text = line[row, reach - back : reach - back + length]
                one, two = np.zeros(len(row), dtype=U64), np.zeros(len(row), dtype=U64)
                for column in text.T:
                    one = one * U64(BASE) + column + U64(1)
                    two = two * U64(0xD6E8FEB86659FD93) + column + U64(1)
                picked = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mix(one).view(np.int64)), pa.array(mix(two).view(np.int64)), picked.column("id"), picked.column("at"), pa.array(np.full(len(row), back))],
                    names=["h1", "h2", "id", "at", "back"],
                )

    strings = contexts.select("bytes", "id", "at").mapInArrow(run, f"h1 long, h2 long, id {kind}, at long, back long")
    first = strings.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    return strings.join(first, ["h1", "h2"]).where("id > first").select("id", "at", "back", (F.lit(length) - F.col("back")).alias("ahead"))


def with_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = LENGTH, seed: int = SEED, hot: int = HOT) -> DataFrame:
    """(id, t, copy, spans) for each row: its bytes, whether its text has a smaller key, and the spans
    (start, end) that repeat a text with a smaller key; unsorted, overlapping, and not yet cut to the text."""
    rows = docs.select(F.col(key).alias("id"), F.coalesce(text, F.lit("")).cast("binary").alias("t"))
    nameless = rows.where("id is null")
    rows = rows.where("id is not null").withColumn("c", F.unhex(F.md5("t")))
    names = rows.select("id", "c").distinct()
    firsts = names.groupBy("c").agg(F.min("id").alias("first"))
    variant = F.row_number().over(Window.partitionBy("first").orderBy("c")) - 1
    known = settle(names.join(firsts.withColumn("variant", variant), "c").select("id", "c", "first", "variant"))
    if known.count() <= BROADCAST_ROWS:
        unique = rows.join(F.broadcast(known.where("id = first")), ["id", "c"])
    else:
        unique = rows.join(known.where("id = first"), ["id", "c"])
    by_anchor, by_context = Window.partitionBy("anchor"), Window.partitionBy("anchor", "context")
    found = find_anchors(unique.select("id", "variant", "t"), length, seed).select(
        "*", F.min("id").over(by_anchor).alias("low"), F.max("id").over(by_anchor).alias("high"),
        (F.min("context").over(by_anchor) < F.max("context").over(by_anchor)).alias("several"), F.count("*").over(by_anchor).alias("n"),
    ).where("low < high").withColumn("first", F.min("id").over(by_context))
    whole = F.col("id") > F.col("first")
    found = stored(found.where(whole | F.col("several")).select(F.when(~whole, F.col("anchor")).alias("anchor"), "id", "at", whole.alias("whole"), (F.col("n") > hot).alias("hot")), "anchors")
    del unique
    release(docs.sparkSession)
    whole = found.where("whole").select("id", "at", F.lit(length - seed).alias("back"), F.lit(length).alias("ahead"))

    def around(places: DataFrame) -> DataFrame:
        """The contexts of some places; the texts they are cut from are shuffled once for all uses."""
        lists = places.withColumn("variant", F.floor(F.col("at") / PLACE).cast("int")).groupBy("id", "variant").agg(F.collect_list(F.struct("anchor", "at", "hot")).alias("places"))
        lists = lists.join(known.where("id = first").select("id", "c", "variant"), ["id", "variant"])
        return contexts_of(rows.join(lists, ["id", "c"]).select("id", "t", "places"), length, seed)

    part = part_repeats(around(found.where("not whole and not hot")), length, seed)
    if found.where("not whole and hot").limit(1).count():
        part = part.union(string_repeats(around(found.where("not whole and hot")), length, seed))
    start = F.col("at") % PLACE
    spans = whole.union(part).select("id", F.floor(F.col("at") / PLACE).cast("int").alias("variant"), F.struct((start - F.col("back")).alias("s"), (start + F.col("ahead")).alias("e")).alias("span"))
    spans = spans.groupBy("id", "variant").agg(F.collect_list("span").alias("spans"))
    plan = known.join(spans, ["id", "variant"], "left").select("id", "c", (F.col("id") > F.col("first")).alias("copy"), F.when(F.col("id") == F.col("first"), F.col("spans")).alias("spans"))
    out = rows.join(plan, ["id", "c"]).select("id", "t", "copy", "spans")
    return out.union(nameless.select("id", "t", F.lit(False), F.lit(None).cast("array<struct<s:bigint,e:bigint>>")))


def covered(offsets: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray, length: int) -> np.ndarray:
    """Which bytes of a block of texts lie in a span, spans being cut to their text first. A span that is then
    shorter than `length` was no repeat."""
    size = np.diff(offsets)[row]
    start, end = np.maximum(start, 0), np.minimum(end, size)
    real = end - start >= length
    edges = np.zeros(offsets[-1] + 1, dtype=np.int32)
    np.add.at(edges, (offsets[row] + start)[real], 1)
    np.add.at(edges, (offsets[row] + end)[real], -1)
    return np.cumsum(edges[:-1]) > 0


def without_repeats(docs: DataFrame, *, key: str = "doc_id", length: int = LENGTH, **options) -> DataFrame:
    """(key, n_bytes, removed, kept) for each row: the spans that go, and the bytes that stay."""
    found = with_repeats(docs, key=key, length=length, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "t"):
            raw, offsets = utf8(batch.column("t"))
            copy = np.flatnonzero(batch.column("copy").to_numpy(zero_copy_only=False))
            lists = batch.column("spans")
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = lists.flatten()
            start, end = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(2))
            row = np.concatenate([np.repeat(np.arange(batch.num_rows), counts), copy])
            start, end = np.concatenate([start, np.zeros(len(copy), np.int64)]), np.concatenate([end, np.diff(offsets)[copy]])
            gone = covered(offsets, row, start, end, length)
            before, after = np.concatenate([[False], gone[:-1]]), np.concatenate([gone[1:], [False]])
            before[offsets[:-1][offsets[:-1] < len(raw)]] = False
            after[offsets[1:][offsets[1:] > 0] - 1] = False
            starts, ends = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after) + 1
            runs = np.searchsorted(starts, offsets)
            base = offsets[np.searchsorted(offsets, starts, side="right") - 1]
            removed = pa.ListArray.from_arrays(pa.array(runs, pa.int32()), pa.StructArray.from_arrays([pa.array(starts - base), pa.array(ends - base)], names=["start", "end"]))
            stays = np.concatenate([[0], np.cumsum(~gone)])[offsets]
            kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer(stays), pa.py_buffer(raw[~gone].tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.diff(offsets)), removed, kept.cast(pa.binary())], names=["id", "n_bytes", "removed", "kept"])

    kind = found.schema["id"].dataType.simpleString()
    return found.mapInArrow(run, f"id {kind}, n_bytes long, removed array<struct<start: long, end: long>>, kept binary").withColumnRenamed("id", key)


def op1_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to passages of 50 bytes that a document with a smaller id holds."""
    found = without_repeats(table(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return found.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
