"""Token ids of all documents in one order, as Simple-8b files, and back.

A token table is a folder of Parquet files. A row is a run of documents that follow each other: the part and
the run's number in it, the ids before it in its part, the documents' ids and lengths, the packed words, the
escaped values and the offset of each block's first word (see simple8b). Parts follow each other in the
order of the documents. Every task writes its part through Spark's own commit, so a lost executor costs a
part's second run and no more.

Definitions. Null is the empty text; every document has at least the end id. Documents are in ascending
order of the key, null first; equal keys by the hash of their texts. An empty table gives an empty folder of
files and no rows. Keys are integers; others are an error. Special tokens' names in a text give their ids.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from gleaner.llm._frame import fresh_folder, table
from gleaner.llm._text import LOWER, blocks, lean, memories, utf8
from gleaner.llm.simple8b import pack, unpack

#: Strings whose ids a worker remembers; then it starts anew.
REMEMBERED = 500_000
END_ID = 1
#: Bytes that end a chunk.
WHITE = np.zeros(256, dtype=bool)
WHITE[list(b" \t\n\r\x0b\x0c")] = True
#: Signs that the tokenizer splits from the letters before them (no apostrophe, which may start a short form).
SIGNS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

LETTERS, SIGN = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
LETTERS[65:91] = LETTERS[97:123] = True
SIGN[list(SIGNS)] = True

ROW = pa.schema([
    ("part", pa.int32()), ("run", pa.int32()), ("before", pa.int64()), ("keys", pa.list_(pa.int64())),
    ("lengths", pa.list_(pa.int64())), ("words", pa.binary()), ("escapes", pa.binary()), ("offsets", pa.list_(pa.int32())),
])
ROW_DDL = "part int, run int, before long, keys array<long>, lengths array<long>, words binary, escapes binary, offsets array<int>"
IDS = pa.schema([("part", pa.int32()), ("key", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def parted(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chunks of ASCII letters, or of such and signs after them, in lower case and with the signs as chunks of
    their own: what the tokenizer does to them anyway, so that fewer distinct chunks are left."""
    if not len(starts):
        return data, starts
    letters, signs = LETTERS[data], SIGN[data]
    turns = np.zeros(len(data), dtype=bool)  # letters after signs
    turns[1:] = signs[:-1] & letters[1:]
    turns[starts] = False
    sizes = np.diff(np.append(starts, len(data)))
    counts = [np.add.reduceat(x, starts, dtype=np.int64) for x in (letters, signs, turns)]
    plain = np.repeat((counts[0] + counts[1] == sizes) & (counts[0] > 0) & (counts[2] == 0), sizes)
    cuts = plain.copy()
    cuts[1:] &= letters[:-1] & signs[1:]
    cuts[0] = False
    cuts[starts] = True
    return np.where(plain, LOWER[data], data), np.flatnonzero(cuts)


class Encoder:
    """The tokenizer, with a memory of what it has encoded.

    White space is dropped and ends words, so what stands between blanks is encoded by itself; letters and
    the signs after them are split before the merges, so they are encoded by themselves too, as long as they
    stay letters in lower case (U+0130 doesn't).
    """

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(name if os.path.isabs(name) else public_tokenizers.path(name))
        size = self.tokenizer.get_vocab_size()
        self.ends_word = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.chunks: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece. Pieces of letters or of signs go as one text, cut where words end."""
        found = np.array(self.tokenizer.encode_batch_fast([" ".join(pieces)], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.flatnonzero(self.ends_word[found]) + 1
        if len(ends) != len(pieces):
            found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
            return [np.array(e.ids, dtype="<u4").tobytes() for e in found]
        data, edges = found.tobytes(), [0, *(4 * ends).tolist()]
        return [data[x:y] for x, y in zip(edges[:-1], edges[1:], strict=True)]

    def learn(self, chunks: list[bytes]) -> None:
        split: list[tuple[bytes, str, str]] = []
        for chunk in chunks:
            word = chunk.lower().rstrip(SIGNS)
            letters = word.decode("utf-8", "replace")
            if not word or letters.isalpha() and (word.isascii() or is_normalized("NFC", letters) and letters.lower().isalpha()):
                split.append((chunk, letters, chunk[len(word) :].decode()))
            else:
                found = self.tokenizer.encode(chunk.decode("utf-8", "replace"), add_special_tokens=False)
                self.chunks[chunk] = np.array(found.ids, dtype="<u4").tobytes()
        if len(self.pieces) > REMEMBERED:
            self.pieces = {}
        wanted = {p for _, word, signs in split for p in (word, signs)}
        known = {p: self.pieces[p] for p in wanted if p in self.pieces}
        known[""] = b""
        new = [p for p in wanted if p not in known]
        for start in range(0, len(new), 1000):
            known.update(zip(new[start : start + 1000], self.ids(new[start : start + 1000]), strict=True))
        self.chunks.update([(chunk, known[word] + known[signs]) for chunk, word, signs in split])
        self.pieces.update([(p, known[p]) for _, word, signs in split if word and signs for p in (word, signs)])  # others are chunks

    def encode(self, raw: np.ndarray, edges: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block of texts, each text with the end id, and the number of ids of each text.

        Arrow finds the distinct chunks of the block; each is looked up once and its ids are dealt out by place.
        """
        inside = ~WHITE[raw]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        first = edges[:-1][edges[:-1] < len(raw)]
        begins[first] = inside[first]
        before = np.concatenate([[0], np.cumsum(inside)])
        data, starts = parted(raw[inside], before[np.flatnonzero(begins)])
        places = np.append(starts, len(data))
        chunks = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(data)]).dictionary_encode()
        words = chunks.dictionary.to_pylist()
        if len(self.chunks) > REMEMBERED:
            self.chunks = {}
        new = [w for w in words if w not in self.chunks]
        if new:
            self.learn(new)
        coded = [*map(self.chunks.__getitem__, words), np.array([end_id], dtype="<u4").tobytes()]
        sizes = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded)) // 4
        table, offsets = np.frombuffer(b"".join(coded), dtype="<u4"), np.concatenate([[0], np.cumsum(sizes)[:-1]])
        upto = np.searchsorted(starts, before[edges])  # chunks before each text
        order = np.insert(chunks.indices.to_numpy(), upto[1:], len(words))
        size = sizes[order]
        total = np.concatenate([[0], np.cumsum(size)])
        ids = table[np.repeat(offsets[order] - total[:-1], size) + np.arange(total[-1])]
        return ids, np.diff(total[upto + np.arange(len(edges))])


def encoder(name: str) -> Encoder:
    """The worker's encoder, which stays until a task of another operator begins."""
    known = memories.setdefault("tokens", {})
    if name not in known:
        known[name] = Encoder(name)
    return known[name]


def write_tokens(
    docs: DataFrame, folder: str, *, key: str = "doc_id", text: str = "text",
    tokenizer: str = "word_bpe_49k.json", end_id: int = END_ID, parts: int | None = None,
) -> None:
    """Encode all rows of `docs` and write them to `folder` in ascending order of the key.

    `tokenizer` is a file of the tokenizers library: a path, or a name in the public collection. It must lower
    the case, drop white space and split letters from signs, as the word tokenizer does. `parts`: number of files, else Spark's number of shuffle partitions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer)
        part, number, before = TaskContext.get().partitionId(), 0, 0
        for batch in blocks(batches, "t"):
            raw, edges = utf8(batch.column("t"))
            ids, sizes = tool.encode(raw, edges, end_id)
            lengths = sizes.tolist()
            words, escapes, offsets = pack(ids)
            yield pa.RecordBatch.from_pylist([{
                "part": part, "run": number, "before": before, "keys": batch.column("k").to_pylist(), "lengths": lengths,
                "words": words.astype("<u8").tobytes(), "escapes": escapes.astype("<u8").tobytes(), "offsets": offsets,
            }], schema=ROW)
            number, before = number + 1, before + sum(lengths)

    if not isinstance(docs.schema[key].dataType, IntegralType):
        raise ValueError(f"the key {key!r} must be of an integer type")
    rows = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(text, F.lit("")).alias("t"))
    order = (F.col("k").asc_nulls_first(), F.xxhash64("t"))
    spread = rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)
    spread.sortWithinPartitions(*order).mapInArrow(lean(run, "tokens"), ROW_DDL).write.option("compression", "zstd").parquet(folder)


def segments(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(ROW_DDL).parquet(folder)


def decode(row: dict) -> np.ndarray:
    """All ids of one row of a token table."""
    words, escapes = (np.frombuffer(row[c], dtype="<u8") for c in ("words", "escapes"))
    return unpack(words, escapes, np.asarray(row["offsets"], dtype=np.int64), int(sum(row["lengths"])))


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each document: key, start (ids before it), ids."""

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int32()), ("key", pa.int64()), ("before", pa.int64()), ("ids", pa.list_(pa.int64()))])
        for batch in batches:
            for row in batch.to_pylist():
                values, at = decode(row).astype(np.int64), np.cumsum([0, *row["lengths"]])
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["part"]] * len(row["keys"]), pa.int32()), pa.array(row["keys"], pa.int64()),
                    pa.array(at[:-1] + row["before"]), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values)),
                ], schema=schema)

    found = segments(spark, folder).mapInArrow(lean(ids, "tokens"), "part int, key long, before long, ids array<long>")
    return with_starts(spark, folder, found).select("key", "start", "ids")


def with_starts(spark: SparkSession, folder: str, found: DataFrame) -> DataFrame:
    """`start` from the ids before a document in its part and in all earlier parts (one small row a part)."""
    length = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b)
    parts = segments(spark, folder).groupBy("part").agg(F.sum(length).alias("n"))
    earlier = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("earlier"))
    return found.join(earlier, "part").withColumn("start", F.col("earlier") + F.col("before"))


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each document of a token table, from its files: key, start, n_tokens, ids_crc32."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data = memoryview(decode(row).astype("<u4").tobytes())
                at = np.cumsum([0, *row["lengths"]])
                sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["part"]] * len(sums), pa.int32()), pa.array(row["keys"], pa.int64()), pa.array(at[:-1] + row["before"]),
                    pa.array(row["lengths"], pa.int64()), pa.array(sums, pa.int64()),
                ], schema=IDS)

    found = segments(spark, folder).mapInArrow(lean(digests, "tokens"), "part int, key long, before long, n_tokens long, ids_crc32 long")
    return with_starts(spark, folder, found).select("key", "start", "n_tokens", "ids_crc32")


def encode_table(docs: DataFrame) -> DataFrame:
    """Write all documents to a token table in the shared folder and return the digests read back from it."""
    folder = fresh_folder(docs.sparkSession, "tokens")
    write_tokens(docs, folder)
    return token_digests(docs.sparkSession, folder).withColumnRenamed("key", "doc_id")


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids in Simple-8b files, read back."""
    return encode_table(table(spark, sf_dir, "documents"))
