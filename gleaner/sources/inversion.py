"""Postings of documents in sorted blocks with a row for each term: each batch of documents is inverted by itself, so nothing is shuffled."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.spec import FieldSpec, IndexSpec

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

#: A row of a block: the postings of a term in the documents of one site, with their number and words.
BLOCK = "site string, field string, term string, df long, total long, postings array<struct<doc_key:string,tf:int,positions:array<int>,len:int,weight:double>>"

#: Bytes that end a word of a text that is cut at blanks.
BLANK = np.zeros(256, dtype=bool)
BLANK[list(b" \t\n\r\x0b\x0c")] = True


def is_direct(f: FieldSpec) -> bool:
    """Fields whose terms are words of the text as they stand: cheaper to read off the text again than to store."""
    return f.is_text and f.type != "tokens" and not f.multi and f.chain.is_plain


def _is_cut_at_blanks(f: FieldSpec) -> bool:
    """Fields whose texts are split in Arrow: the blanks of ``SPACES`` are those of ASCII."""
    return f.chain.tokenizer == "whitespace"


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(words in each text, all words in order) of texts without nulls, split at ASCII blanks."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    sizes, words = lists.value_lengths().to_numpy(zero_copy_only=False), lists.flatten()
    blank = pc.equal(words, "").to_numpy(zero_copy_only=False)  # all there is of a text without words
    if blank.any():
        sizes = sizes - np.add.reduceat(blank, np.cumsum(sizes) - sizes, dtype=np.int32)
        words = words.filter(pa.array(~blank))
    return sizes, words


def _cut_sizes(texts: pa.Array) -> np.ndarray:
    """Words in each text without nulls, split at ASCII blanks: the bytes that begin a word are counted and no word is made."""
    if not len(texts):
        return np.zeros(0, dtype=np.int64)
    texts = texts.cast(pa.large_binary())
    edges = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[edges[0] : edges[-1]] if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    edges = edges - edges[0]
    inside = ~BLANK[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = edges[:-1][edges[:-1] < len(raw)]
    begins[first] = inside[first]
    return np.diff(np.searchsorted(np.flatnonzero(begins), edges))


def _fitting(words: pa.Array, low: int, high: int) -> np.ndarray:
    length = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    return (length >= low) & (length <= (high or 2**31 - 1))


def word_count(f: FieldSpec) -> Column:
    """Number of the words that the chain of a direct field keeps, 0 where the text is missing."""
    chain = f.chain
    if not _is_cut_at_blanks(f):
        return F.size(chain.kept_words(F.coalesce(f.name, F.lit(""))))
    low, high = chain.min_length, chain.max_length
    text = F.coalesce(f.name, F.lit(""))

    @F.arrow_udf("int")
    def count(texts: pa.Array) -> pa.Array:
        return pa.array(_cut_sizes(texts), pa.int32())

    @F.arrow_udf("int")
    def count_fitting(texts: pa.Array) -> pa.Array:
        sizes, words = _words(texts)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        return pa.array(np.bincount(doc[_fitting(words, low, high)], minlength=len(sizes)), pa.int32())

    return count_fitting(F.lower(text)) if low or high else count(text)  # small letters have the same blanks


def block_postings(docs: DataFrame, spec: IndexSpec, names: list[str]) -> DataFrame:
    """``(site, field, term, df, total, postings)`` of direct fields: each batch has a row for each term, sorted by
    (field, term), which holds the term's documents in their order."""

    def sent(f: FieldSpec) -> Column:
        if _is_cut_at_blanks(f):
            return F.lower(F.coalesce(f.name, F.lit("")))
        return F.coalesce(f.chain.words(F.col(f.name)), F.array().cast("array<string>"))

    words = [sent(spec[n]).alias(f"w{i}") for i, n in enumerate(names)]
    chains = [(n, spec[n].chain) for n in sorted(names)]
    column = {n: f"w{i}" for i, n in enumerate(names)}
    kept = [(n, column[n], c.min_length, c.max_length, c.frequencies, c.norms) for n, c in chains]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners = batch.column("site")
            for site in owners.unique().to_pylist():
                own = pc.is_null(owners) if site is None else pc.fill_null(pc.equal(owners, site), False)
                rows = batch.filter(own)
                for field in kept:
                    yield _inverted(rows, site, *field)

    return docs.select("site", "doc_key", *words).mapInArrow(blocks, BLOCK)


def _inverted(
    batch: pa.RecordBatch, site: str | None, field: str, column: str, low: int, high: int, frequencies: bool, norms: bool,
) -> pa.RecordBatch:
    given = batch.column(column)
    if pa.types.is_list(given.type):
        sizes, listed = given.value_lengths().to_numpy(zero_copy_only=False), given.flatten()
    else:
        sizes, listed = _words(given)
    coded = listed.dictionary_encode()
    words, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    pos = np.arange(len(doc), dtype=np.int32) - np.repeat(np.cumsum(sizes) - sizes, sizes).astype(np.int32)
    if low or high:
        fits = _fitting(words, low, high)[codes]
        codes, doc, pos = codes[fits], doc[fits], pos[fits]
    in_order = pc.sort_indices(words).to_numpy(zero_copy_only=False)
    rank = np.empty(len(words), dtype=np.int32)
    rank[in_order] = np.arange(len(words), dtype=np.int32)
    rank = rank[codes]
    # words of a batch come by document and position: their number behind the rank keeps that order
    both = np.sort(rank.astype(np.int64) << 32 | np.arange(len(rank), dtype=np.int64))
    order = both & 0xFFFFFFFF
    rank, doc_of, pos = both >> 32, doc[order], pos[order]
    first = np.flatnonzero(np.r_[True, (rank[1:] != rank[:-1]) | (doc_of[1:] != doc_of[:-1])][: len(rank)])
    ends = np.r_[first[1:], len(rank)].astype(np.int32) if len(first) else np.zeros(0, dtype=np.int32)
    n = len(first)
    tf = (ends - first).astype(np.int32)
    if frequencies:
        positions = pa.ListArray.from_arrays(pa.array(np.r_[np.int32(0), ends].astype(np.int32)), pa.array(pos))
    else:
        tf = np.ones(n, dtype=np.int32)
        positions = pa.ListArray.from_arrays(pa.array(np.zeros(n + 1, dtype=np.int32)), pa.array([], pa.int32()))
    length = np.bincount(doc, minlength=len(sizes)).astype(np.int32)[doc_of[first]] if norms else np.ones(n, dtype=np.int32)
    postings = pa.StructArray.from_arrays(
        [batch.column("doc_key").take(pa.array(doc_of[first])), pa.array(tf), positions, pa.array(length), pa.array(np.ones(n))],
        names=["doc_key", "tf", "positions", "len", "weight"],
    )
    term = rank[first]
    begins = np.flatnonzero(np.r_[True, term[1:] != term[:-1]][:n]).astype(np.int32)
    df = np.diff(np.r_[begins, np.int32(n)])
    terms = len(begins)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([site], pa.string()).take(pa.array(np.zeros(terms, dtype=np.int32))), pa.repeat(pa.scalar(field), terms),
            words.take(pa.array(in_order[term[begins]])), pa.array(df.astype(np.int64)),
            pa.array(np.add.reduceat(tf, begins, dtype=np.int64) if terms else np.zeros(0, dtype=np.int64)),
            pa.ListArray.from_arrays(pa.array(np.r_[begins, np.int32(n)].astype(np.int32)), postings),
        ],
        names=["site", "field", "term", "df", "total", "postings"],
    )


def single_rows(postings: DataFrame) -> DataFrame:
    """Postings ``(site, doc_key, field, term, tf, positions, len, weight)`` in the form of a block, one for each row."""
    one = F.struct("doc_key", "tf", "positions", "len", "weight")
    return postings.select(
        "site", "field", "term", F.lit(1).cast("long").alias("df"), F.col("tf").cast("long").alias("total"), F.array(one).alias("postings"))


def term_counts(blocks: DataFrame) -> DataFrame:
    """``(index_id, part, site, field, term, df, tf)``, a row for each row of a block: the narrow columns, no posting is read."""
    return blocks.select("index_id", "part", "site", "field", "term", "df", F.col("total").alias("tf"))


def unblocked(rows: DataFrame) -> DataFrame:
    """Rows of blocks -> one row for each posting; filters on the term reach the blocks."""
    rest = [c for c in rows.columns if c not in ("df", "total", "postings")]
    one = rows.select(*rest, F.explode("postings").alias("_p"))
    return one.select(*rest, *[F.col(f"_p.{c}").alias(c) for c in ("doc_key", "tf", "positions", "len", "weight")])
