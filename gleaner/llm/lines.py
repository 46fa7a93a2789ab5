"""Lines that many documents share, dropped by sharded minimal perfect hashes.

The key of a line is the line without white space (U+0009-U+000D, U+0020) at its ends and with A-Z in lower case;
lines end at \\n only. One aggregate counts the documents that hold each key, as 128 bits of its hash. The keys of
at least two documents (a key of one document can't be common) are dealt to shards by their hash, and each shard is
built in one task: a minimal perfect hash in levels of bits (a key takes the bit that no other key of its level
asks for, the rest go one level down; its slot is the number of set bits before it), and two arrays by slot, 64-bit
fingerprints and counts. A document hashes its lines and looks them up there; a key outside the shard's set is told
by its fingerprint, up to a chance of 2^-64.

Shards hold SHARD_KEYS keys on average, so that one is a few MB. While all of them are below BROADCAST_BYTES
every task gets them. Beyond that, the probes travel: keys that hold more than one in HEAVY of all counts (fewer than HEAVY keys, a small
index of their own) are decided in place, the others are sent to the task of
their shard, with the hash of the document's text, and only the hits come back.

Definitions. Null is the empty text, an empty text is one empty line. Rows are documents: a row that occurs twice
counts twice, whatever its id, null ids too. An empty table gives no rows. Other columns pass through; the added
ones get an underscore where a name is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm._frame import stored, table, unused
from gleaner.llm._text import U64, blocks, mix, utf8

MIN_DOCS, MIN_CHARS = 10, 1
SHARD_KEYS, BROADCAST_BYTES, HEAVY = 1 << 17, 32 << 20, 4096
#: Bits for each key of a level; after LEVELS levels the few keys left would be listed (never seen: 0.5^LEVELS).
SPREAD, LEVELS = 1.5, 60
WHITE = b" \t\n\x0b\x0c\r"
SHARD_COLUMNS = ["shard", "sizes", "bits", "fingerprints", "counts"]
SHARD_DDL = "shard int, sizes array<int>, bits binary, fingerprints binary, counts binary"


# -- keys ----------------------------------------------------------------


def line_keys(lines: list[bytes], min_chars: int) -> list[bytes]:
    """16 bytes for each line, none for a key that is too short to count."""
    digest, out = xxhash.xxh3_128_digest, []
    for line in lines:
        key = line.strip(WHITE).lower()
        short = not key or min_chars > 1 and len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars
        out.append(b"" if short else digest(key))
    return out


def halves(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(keys), dtype="<u8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def line_counts(docs: DataFrame, text: str, min_chars: int) -> DataFrame:
    """(a, b, n): the halves of each key's hash and the number of rows of `docs` that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "t"):
            raw, edges = utf8(batch.column(0))
            data, found = raw.tobytes(), []
            for start, end in zip(edges[:-1], edges[1:], strict=True):
                found += set(line_keys(data[start:end].split(b"\n"), min_chars)) - {b""}
            a, b = halves(found)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return docs.select(F.col(text).alias("t")).mapInArrow(run, "a long, b long").groupBy("a", "b").agg(F.count("*").alias("n"))


# -- minimal perfect hash ------------------------------------------------


def level_bits(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(a + mix(b + U64(level + 1))) % U64(size)).astype(np.int64)


@dataclass
class Shard:
    """One shard: its levels as words of bits with the number of set bits before each word, and its arrays."""

    sizes: list[int]
    words: np.ndarray
    before: np.ndarray
    fingerprints: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, sizes, bits: bytes, fingerprints: bytes, counts: bytes) -> Shard:
        words = np.frombuffer(bits, dtype="<u8")
        before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        return cls(list(sizes), words, before, np.frombuffer(fingerprints, dtype="<u8"), np.frombuffer(counts, dtype="<u4"))

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slot of each key of the set, its own; -1 or any slot for other keys."""
        out, left, start = np.full(len(a), -1, dtype=np.int64), np.arange(len(a)), 0
        for level, size in enumerate(self.sizes):
            at = start + level_bits(a[left], b[left], level, size)
            word, inside = at >> 6, (at & 63).astype(U64)
            hit = (self.words[word] >> inside) & U64(1) == 1
            lower = self.words[word] & ((U64(1) << inside) - U64(1))
            out[left[hit]] = (self.before[word] + np.bitwise_count(lower))[hit]
            left, start = left[~hit], start + size
        return out

    def documents(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of documents of each key, 0 for keys outside the set."""
        if not len(self.counts):
            return np.zeros(len(a), dtype=np.int64)
        slot = self.slots(a, b)
        found = (slot >= 0) & (self.fingerprints[slot] == b)
        return np.where(found, self.counts[slot], 0).astype(np.int64)


def build_shard(a: np.ndarray, b: np.ndarray, counts: np.ndarray) -> tuple[list[int], bytes, bytes, bytes]:
    """Sizes of the levels, bits, fingerprints and counts of distinct keys. Both halves of a key enter its places,
    so that no two keys can meet on all levels."""
    sizes, parts, left = [], [], np.arange(len(a))
    while len(left):
        if len(sizes) == LEVELS:
            raise ValueError("the keys of a shard aren't distinct")
        size = -(-int(SPREAD * len(left) + 64) // 64) * 64
        at = level_bits(a[left], b[left], len(sizes), size)
        taken = np.bincount(at, minlength=size) == 1
        parts.append(np.packbits(taken, bitorder="little").view("<u8"))
        sizes.append(size)
        left = left[~taken[at]]
    bits = np.concatenate(parts) if parts else np.zeros(0, "<u8")
    shard = Shard.of(sizes, bits.tobytes(), b"", b"")
    slot = shard.slots(a, b)
    fingerprints, documents = np.zeros(len(a), "<u8"), np.zeros(len(a), "<u4")
    fingerprints[slot], documents[slot] = b, np.minimum(counts, (1 << 32) - 1)
    return sizes, bits.tobytes(), fingerprints.tobytes(), documents.tobytes()


def shard_index(counts: DataFrame, shards: int) -> DataFrame:
    """A row for each shard that has keys: its arrays, built where its keys meet."""

    def finish(shard: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        a, b, n = (np.concatenate([p.column(c).to_numpy() for p in parts]) for c in ("a", "b", "n"))
        sizes, bits, fingerprints, documents = build_shard(a.view(U64), b.view(U64), n)
        return pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([sizes], pa.list_(pa.int32())), pa.array([bits], pa.binary()),
             pa.array([fingerprints], pa.binary()), pa.array([documents], pa.binary())],
            names=["shard", "sizes", "bits", "fingerprints", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts = None, []
        for batch in batches:
            numbers = batch.column("shard").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for start, end in zip(edges[:-1], edges[1:], strict=True):
                if start == end:
                    continue
                if parts and numbers[start] != shard:
                    yield finish(shard, parts)
                    parts = []
                shard = int(numbers[start])
                parts.append(batch.slice(start, end - start))
        if parts:
            yield finish(shard, parts)

    dealt = counts.select(F.pmod("a", F.lit(shards)).cast("int").alias("shard"), "a", "b", "n")
    return dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, SHARD_DDL)


class Index:
    """All shards of an index in memory."""

    def __init__(self, shards: int, rows: list[tuple]):
        self.number = shards
        self.shards = {row[0]: Shard.of(*row[1:]) for row in rows}

    def documents(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), dtype=np.int64)
        shard = np.mod(a.view(np.int64), self.number)
        order = np.argsort(shard, kind="stable")
        numbers, starts = np.unique(shard[order], return_index=True)
        for number, mine in zip(numbers.tolist(), np.split(order, starts[1:]), strict=True):
            if number in self.shards:
                out[mine] = self.shards[number].documents(a[mine], b[mine])
        return out


def gathered(index: DataFrame, shards: int) -> Index:
    """A small index for all tasks. Callers have checked its size."""
    return Index(shards, [tuple(r) for r in index.select(SHARD_COLUMNS).toLocalIterator()])


# -- documents -----------------------------------------------------------


def bytes_of(index: DataFrame) -> int:
    size = F.length("bits") + F.length("fingerprints") + F.length("counts")
    return index.agg(F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()[0]


def sent_probes(docs: DataFrame, text: str, index: DataFrame, heavy, shards: int, min_docs: int, min_chars: int) -> DataFrame:
    """(t, keys): by hash of a text, its keys in the index that enough documents hold, heavy ones left out.

    Arrays and probes meet in the shard's task, the arrays first; a probe is a text's hash and a key, once for each
    text. No shard gets more than its share and one HEAVYth of all probes for each of its keys.
    """

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "t"):
            raw, edges = utf8(batch.column("t"))
            data = raw.tobytes()
            found = [sorted(set(line_keys(data[x:y].split(b"\n"), min_chars)) - {b""}) for x, y in zip(edges[:-1], edges[1:], strict=True)]
            a, b = halves([k for keys in found for k in keys])
            row = np.repeat(np.arange(len(found)), [len(keys) for keys in found])
            rest = heavy.value.documents(a, b) == 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest").take(pa.array(row[rest])), pa.array(a[rest].view(np.int64)), pa.array(b[rest].view(np.int64))],
                names=["digest", "a", "b"],
            )

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = None, None
        for batch in batches:
            numbers = batch.column("shard").to_numpy()
            opens = batch.column("digest").is_null().to_numpy(zero_copy_only=False)
            edges = np.unique(np.concatenate([[0, len(numbers)], np.flatnonzero(opens), np.flatnonzero(opens) + 1, np.flatnonzero(np.diff(numbers)) + 1]))
            for start, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if opens[start]:
                    row = batch.slice(start, 1).select(SHARD_COLUMNS).to_pylist()[0]
                    number, shard = row["shard"], Shard.of(*[row[c] for c in SHARD_COLUMNS[1:]])
                elif number == numbers[start]:  # else no key of this shard is in the index
                    part = batch.slice(start, end - start).select(["digest", "a", "b"])
                    a, b = (part.column(c).to_numpy().view(U64) for c in ("a", "b"))
                    yield part.filter(pa.array(shard.documents(a, b) >= min_docs))

    texts = docs.select(F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("digest"), F.coalesce(text, F.lit("")).alias("t"))
    asked = texts.mapInArrow(probes, "digest binary, a long, b long").distinct()
    asked = asked.withColumn("shard", F.pmod("a", F.lit(shards)).cast("int"))
    both = index.unionByName(asked, allowMissingColumns=True)
    met = both.repartition("shard").sortWithinPartitions("shard", F.col("digest").isNotNull())
    hits = met.mapInArrow(look, "digest binary, a long, b long")
    return hits.groupBy(F.col("digest").alias("t")).agg(F.collect_list(F.struct("a", "b")).alias("keys"))


def drop_common_lines(
    docs: DataFrame, *, text: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
    shard_keys: int = SHARD_KEYS, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """`docs` without the lines whose key at least `min_docs` rows hold, with `n_lines` and `n_dropped`.

    Keys of fewer than `min_chars` code points are never dropped. The lines left are joined by \\n; a text of
    common lines only becomes empty, null stays null.
    """
    spark = docs.sparkSession
    counts = stored(line_counts(docs, text, min_chars).where(F.col("n") >= min(2, min_docs)), "line-counts")
    keys, total = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    shards = max(1, -(-keys // shard_keys))
    index = stored(shard_index(counts, shards), "line-shards")
    rows, lists = docs, None
    if bytes_of(index) <= broadcast_bytes:
        known = spark.sparkContext.broadcast(gathered(index, shards))
    else:
        heaviest = shard_index(counts.where(F.col("n") * HEAVY > total).coalesce(1), 1)
        known = spark.sparkContext.broadcast(gathered(heaviest, 1))
        lists, digest = unused(docs, "line_keys"), unused(docs, "line_digest")
        found = sent_probes(docs, text, index, known, shards, min_docs, min_chars).withColumnsRenamed({"keys": lists, "t": digest})
        hashed = docs.withColumn(digest, F.unhex(F.md5(F.coalesce(text, F.lit("")))))
        rows = hashed.join(found, digest, "left").select(*docs.columns, lists)
    names, place = docs.columns, docs.columns.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text):
            raw, edges = utf8(batch.column(place))
            data = raw.tobytes()
            texts = [data[a:b].split(b"\n") for a, b in zip(edges[:-1], edges[1:], strict=True)]
            keyed = [line_keys(lines, min_chars) for lines in texts]
            each = [k for ks in keyed for k in ks if k]
            common = dict(zip(each, (known.value.documents(*halves(each)) >= min_docs).tolist(), strict=True))
            if lists is not None:
                for found in batch.column(lists).to_pylist():
                    for key in found or ():
                        common[np.array([key["a"], key["b"]], "<i8").tobytes()] = True
            left = [[line for line, k in zip(lines, ks, strict=True) if not common.get(k)] for lines, ks in zip(texts, keyed, strict=True)]
            missing = batch.column(place).is_null().to_pylist()
            kept = [None if no else b"\n".join(lines).decode() for no, lines in zip(missing, left, strict=True)]
            n = np.array([len(lines) for lines in texts], dtype=np.int64)
            dropped = n - np.array([len(lines) for lines in left], dtype=np.int64)
            columns = batch.columns[: len(names)]
            columns[place] = pa.array(kept, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n), pa.array(dropped)], names=[*names, *added])

    added = [unused(docs, "n_lines"), unused(docs, "n_dropped")]
    schema = docs.select("*", *[F.lit(0).cast("long").alias(c) for c in added]).schema
    return rows.mapInArrow(cut, schema)


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in at least ten documents, dropped from every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_common_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


SQL = r"""
WITH lines AS (
    SELECT d.rowid AS row, d.doc_id, i, string_split(coalesce(d.text, ''), chr(10))[i] AS line
    FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents) d,
         unnest(range(1, len(string_split(coalesce(d.text, ''), chr(10))) + 1)) AS r(i)
), keyed AS (
    SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), common AS (
    SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT row) >= 10
)
SELECT k.doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN common c USING (key)
GROUP BY k.row, k.doc_id
"""
