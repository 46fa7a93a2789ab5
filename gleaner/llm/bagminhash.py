"""Near-duplicate documents by BagMinHash signatures of their shingle multisets.

A document is a multiset of shingles of five words (all words of a shorter text that has any). Its signature
has one minimum per slot over Poisson processes, one process for each shingle and dyadic interval of weights
[0,1), [1,2), [2,4), ...; a point of an interval counts if it lies below the shingle's weight. Equal slots of
two signatures have the weighted Jaccard similarity as their chance. Points are generated in rising order
and only up to a bound at which all slots are filled, so a long text costs little more than one pass.

Signatures are cut into bands; documents that share a band are candidates, and every link is verified on the
whole multisets. Copies of a text are one node. In each bucket the member with most candidates, the pivot, is
compared with all others first. The members of buckets that these links don't connect are then joined by prefixes of
their shingles in a common order, an exact join that compares hardly any pair below the threshold.

Definitions. Words are as in `_text`; null, empty and wordless texts link with nothing. A row without an id
is its own class with a null id. Rows with one id are one node. Any other column is ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm._frame import release, settle, table, unused
from gleaner.llm._text import U64, blocks, lean, mix, window_hashes, word_hashes
from gleaner.llm.graph import components

WORDS, SIMILARITY = 5, 0.8
#: 40 bands of 6: two documents at similarity 0.8 share no band once in 200,000 times, at 0.5 they do once in 2.
BANDS, ROWS = 40, 6
#: Pairs or keys that all tasks may get.
BROADCAST_ROWS = 500_000


def uniform(seeds: np.ndarray) -> np.ndarray:
    """(0, 1], from the upper 53 bits."""
    return ((mix(seeds) >> U64(11)).astype(np.float64) + 1.0) * 2.0**-53


def shingles(batch: pa.RecordBatch, text: str, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, shingles and weights of a batch, sorted by document and shingle."""
    hashes, rows = word_hashes(batch, text)
    lengths = np.diff(rows)
    counts = np.where(lengths >= words, lengths - words + 1, lengths > 0)
    doc = np.repeat(np.arange(len(lengths)), counts)
    at = rows[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    padded = np.concatenate([hashes, np.zeros(words, U64)])
    short = lengths < words
    if short.any():  # words beyond a short text don't belong to it
        size = lengths[doc]
        out = np.zeros(len(doc), dtype=U64)
        for k in range(words):
            out *= U64(0x9E3779B97F4A7C55)
            out += np.where(k < size, padded[at + k], U64(0))
        values = mix(out)
    else:
        values = window_hashes(padded, words)[at]
    order = np.lexsort((values, doc))
    doc, values = doc[order], values[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (values[1:] != values[:-1])
    first = np.flatnonzero(new)
    return doc[first], values[first], np.diff(np.append(first, len(doc)))


def signatures(doc: np.ndarray, values: np.ndarray, weights: np.ndarray, count: int, slots: int) -> np.ndarray:
    """(count, slots) minima; documents without shingles keep infinity."""
    out = np.full((count, slots), np.inf)
    total = np.bincount(doc, weights=weights, minlength=count)
    todo = total > 0
    reach = np.log(slots) + 6.0
    while todo.any():
        out[todo] = np.inf
        bound = np.where(todo, reach / np.maximum(total, 1), -1.0)
        lower = 0
        while True:
            width = max(lower, 1)
            mine = np.flatnonzero((weights > lower) & todo[doc])
            if not len(mine):
                break
            fill(out, doc[mine], values[mine] + U64(lower * 0xD6E8FEB86659FD93 % (1 << 64)), weights[mine], lower, width, bound)
            lower += width
        todo &= np.isinf(out).any(axis=1)
        reach *= 2
    return out


def fill(out: np.ndarray, doc: np.ndarray, seeds: np.ndarray, weights: np.ndarray, lower: int, width: int, bound: np.ndarray) -> None:
    """The processes of one interval of weights: points in rising order, each in a slot, up to the bounds."""
    slots, limits = out.shape[1], bound[doc]
    seeds = mix(seeds)
    at = np.zeros(len(doc))
    number = 0
    while len(doc):
        number += 1
        at = at - np.log(uniform(seeds + U64(3 * number))) / (slots * width)
        inside = np.flatnonzero(at <= limits)
        if len(inside) < len(doc):
            doc, seeds, weights, limits, at = doc[inside], seeds[inside], weights[inside], limits[inside], at[inside]
        slot = (mix(seeds + U64(3 * number + 1)) >> U64(32)) * U64(slots) >> U64(32)
        if width == 1:
            np.minimum.at(out, (doc, slot.astype(np.int64)), at)
        else:
            kept = lower + width * uniform(seeds + U64(3 * number + 2)) <= weights
            np.minimum.at(out, (doc[kept], slot[kept].astype(np.int64)), at[kept])


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    bits = np.ascontiguousarray(signature).view(U64).reshape(-1, bands, rows)
    keys = np.broadcast_to(np.arange(bands, dtype=U64), bits.shape[:2]).copy()
    for k in range(rows):
        keys = mix(keys * U64(0x9E3779B97F4A7C55) + bits[:, :, k])
    return keys.view(np.int64)


def sign(docs: DataFrame, bands: int, rows: int, words: int) -> DataFrame:
    """(id, copy, keys) of each row of (id, t); copy is equal for equal texts, keys empty without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "t", 1 << 20):
            doc, values, weights = shingles(batch, "t", words)
            signature = signatures(doc, values, weights, batch.num_rows, bands * rows)
            keys = band_keys(signature, bands, rows)
            has = np.bincount(doc, minlength=batch.num_rows) > 0
            edges = np.concatenate([[0], np.cumsum(has * bands)])
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(keys[has].ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("copy"), lists], names=["id", "copy", "keys"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.withColumn("copy", F.unhex(F.md5("t"))).mapInArrow(lean(run), f"id {kind}, copy binary, keys array<long>")


def bags(docs: DataFrame, words: int) -> DataFrame:
    """(id, bag): the sorted 64-bit shingles of each row, a repeated one in a different shape each time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "t", 1 << 20):
            doc, values, weights = shingles(batch, "t", words)
            doc, values = np.repeat(doc, weights), np.repeat(values, weights)
            copy = np.arange(len(doc)) - np.repeat(np.cumsum(weights) - weights, weights)
            values = np.where(copy == 0, values, mix(values + copy.astype(U64)))
            order = np.lexsort((values, doc))
            edges = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            values = values[order]
            packed = [values[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(packed, pa.binary())], names=["id", "bag"])

    return docs.select("id", "t").mapInArrow(lean(run), f"id {docs.schema['id'].dataType.simpleString()}, bag binary")


def similar(pairs: DataFrame, contents: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose multisets overlap enough, with their similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros(batch.num_rows)
            for k, (x, y) in enumerate(zip(batch.column("bag"), batch.column("bag_b"), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), dtype=U64), np.frombuffer(y.as_buffer(), dtype=U64)
                if min(len(x), len(y)) >= similarity * max(len(x), len(y)):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    found[k] = common / (len(x) + len(y) - common)
            kept = pa.array(found >= similarity)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found)], names=["a", "b", "similarity"]).filter(kept)

    kind = pairs.schema["a"].dataType.simpleString()
    small = pairs.count() <= BROADCAST_ROWS
    joined = contents.withColumnRenamed("id", "a").join(F.broadcast(pairs) if small else pairs, "a")
    joined = joined.join(contents.select(F.col("id").alias("b"), F.col("bag").alias("bag_b")), "b")
    return joined.select("a", "b", "bag", "bag_b").mapInArrow(lean(run), f"a {kind}, b {kind}, similarity double")


def prefix_pairs(members: DataFrame, similarity: float) -> DataFrame:
    """(a, b): all pairs of (id, part, bag) from different parts that can be similar enough, and few others.

    A set-similarity join by prefixes. Shingles are put in one order for all members: first those that only one part
    has, then from rare to frequent. Two similar multisets of x and y shingles have an overlap of s / (1 + s) * (x + y)
    at least, so they share a shingle before the place from which on too few are left in either. Members meet by
    shingle and by both sizes (in steps of a fiftieth), for those partners' sizes only for which the place is early
    enough. Near copies whose changes differ have their own shingles in front and don't meet at all.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 100):
                some = batch.slice(start, 100)
                values = [np.frombuffer(x.as_buffer(), dtype=np.int64) for x in some.column("bag")]
                sizes = np.array([len(v) for v in values])
                row = pa.array(np.repeat(np.arange(len(values)), sizes))
                yield pa.RecordBatch.from_arrays(
                    [some.column("id").take(row), some.column("part").take(row), pa.array(np.repeat(sizes, sizes).astype(np.int32)), pa.array(np.concatenate(values))],
                    names=["id", "part", "size", "shingle"],
                )

    kind = members.schema["id"].dataType.simpleString()
    rows = members.select("id", "part", "bag").mapInArrow(lean(listed), f"id {kind}, part {kind}, size int, shingle long")
    shared = rows.groupBy("shingle").agg(F.count("*").alias("n"), F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high")
    ordered = rows.join(shared.select("shingle", "n"), "shingle").groupBy("id", "part", "size").agg(F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("order"))
    s, step = similarity, 1.02
    tiny = 1e-9
    longest = (F.col("size") - F.ceil(F.col("size") * s - tiny) + 1).cast("int")
    own = F.col("size") - F.size("order")
    places = ordered.where(longest > own).select("id", "part", "size", own.alias("own"), F.posexplode(F.slice("order", F.lit(1), longest - own)).alias("at", "entry"))
    level = lambda n: F.floor(F.log(n.cast("double")) / math.log(step) + tiny).cast("int")
    smallest, largest = F.ceil(F.col("size") * s - tiny), F.floor(F.col("size") / s + tiny)
    needed = lambda x, y: F.ceil((x + y) * (s / (1 + s)) - tiny)
    left = F.col("size") - F.col("own") - F.col("at")
    least = F.greatest(F.ceil(F.pow(F.lit(step), F.col("other")) - 1e-6), smallest)
    met = (
        places.select("id", "part", "size", left.alias("left"), F.col("entry.shingle").alias("shingle"), F.explode(F.sequence(level(smallest), level(largest))).alias("other"))
        .where(F.col("left") >= needed(F.col("size"), least))
        .select("shingle", F.least(level(F.col("size")), "other").alias("lower"), F.greatest(level(F.col("size")), "other").alias("upper"), "id", "part", "size", "left")
    )
    keys = ["shingle", "lower", "upper"]
    met = settle(met)
    other = met.select(*keys, *[F.col(c).alias(f"{c}_b") for c in ("id", "part", "size", "left")])
    enough = F.least("left", "left_b") >= needed(F.col("size"), F.col("size_b"))
    apart = F.least("size", "size_b") >= F.greatest("size", "size_b") * s - tiny
    return met.join(other, keys).where((F.col("part") < F.col("part_b")) & enough & apart).select(*pair("id", "id_b")).distinct()


def pair(a, b):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def near_duplicates(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = WORDS,
    similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """(key, class): the smallest key that each document reaches by links. One row for each key of `docs`.

    Between the steps the shuffle files of settled ones go, so disk holds one step's files and not those of all.
    """
    texts = docs.select(F.col(key).alias("id"), F.coalesce(text, F.lit("")).alias("t"))
    signed = settle(sign(texts.where("id is not null"), bands, rows, words))
    copies = signed.where(F.size("keys") > 0).groupBy("copy").agg(F.min("id").alias("rep"))
    member = settle(signed.join(copies, "copy").select("id", "rep", F.when(F.col("id") == F.col("rep"), F.col("keys")).alias("keys")))
    keys = member.where("keys is not null").select("id", F.explode("keys").alias("key")).distinct()
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = settle(keys.join(sizes, "key"))
    degrees = shared.groupBy("id").agg(F.sum("n").alias("degree"))
    ids = settle(degrees.select("id"))
    if ids.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    contents = settle(bags(texts.join(ids, "id", "left_semi"), words).distinct())
    release(docs.sparkSession)
    ranked = shared.join(degrees, "id")
    pivots = settle(ranked.groupBy("key").agg(F.max_by("id", F.struct("degree", "id")).alias("pivot")))
    to_pivot = shared.select("key", "id").join(pivots, "key").where("id <> pivot").select(*pair("id", "pivot")).distinct()
    measured = similar(settle(to_pivot), contents, similarity)
    links = settle(member.select(F.col("id").alias("a"), F.col("rep").alias("b")).union(measured.select("a", "b")))
    release(docs.sparkSession)
    parts = settle(components(links)).withColumnsRenamed({"node": "id", "component": "part"})
    joined = shared.select("key", "id").join(parts, "id")
    mixed = joined.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("key")
    release(docs.sparkSession)
    open_ = settle(joined.join(mixed, "key", "left_semi").select("id", "part").distinct())
    candidates = settle(prefix_pairs(contents.join(open_, "id"), similarity))
    release(docs.sparkSession)
    links = settle(links.union(similar(candidates, contents, similarity).select("a", "b")))
    release(docs.sparkSession)
    parts = settle(components(links))
    found = texts.select("id").join(parts, F.col("id") == F.col("node"), "left")
    return found.select(F.col("id").alias(key), F.coalesce("component", "id").alias("class"))


def deduplicate(docs: DataFrame, *, key: str = "doc_id", **names) -> DataFrame:
    """`docs` with one row of each class: of those with the class's smallest key. All its columns and no other.

    Rows without a key stay. Of several rows with the smallest key, the first in the order of their hashes.
    """
    classes = near_duplicates(docs, key=key, **names).where(F.col(key) == F.col("class")).select(key).distinct()
    number = unused(docs, "row_number")
    order = F.xxhash64(F.to_json(F.struct(*docs.columns)))
    kept = docs.where(F.col(key).isNotNull()).join(classes, key, "left_semi")
    kept = kept.withColumn(number, F.row_number().over(Window.partitionBy(key).orderBy(order))).where(F.col(number) == 1).drop(number)
    return kept.select(docs.columns).union(docs.where(F.col(key).isNull()))


def op3_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("class").alias("class_id"), (F.col("doc_id") == F.col("class")).alias("kept"))
