"""Toxicity by class-conditional Kneser-Ney models over the bytes of words.

Two models of order N give each byte of a word its chance after the N - 1 bytes before it (blanks before the
word's start), one learnt from toxic, one from ordinary labelled texts. Each takes absolute discounting of
its own counts and backs off to one Kneser-Ney model of order N - 1 over both classes' continuation counts,
so an expression that is rare in either class gets nearly the same chance from both. A word's log-likelihood
ratio then depends on the word alone: a table of ratios for the sequences seen, and one for the contexts of
the others, answer it.

A text's log-likelihood difference is taken per word, so that length doesn't count: its mean, and three forms of
its peaks that a language's own offset doesn't move: the mean of what words have above 1, the mean of what they
have 3 above the text's median, and the first one in its highest window of WINDOW words (a few hostile lines in a
long text count like a short text). A logistic curve over the mean and the logarithms of the peaks gives the
score; it is fitted on labelled texts that the models have not seen.

Counting takes all labelled training texts. Tasks receive the table of ratios in blocks of about TABLE rows,
cut by context, which go through the driver one by one; a text's sums go from one block to the next. No more than
HELD blocks are out at once: after as many, the sums are written and the blocks released. The curve is fitted on
about SAMPLE texts at most.

Definitions. Words are as in `_text`. Null, empty and wordless texts have ratio 0 and the curve's value
there. Labels that are null, or whose document is missing, teach nothing; a repeated label counts again.
Without labels of both classes every score is 0.5. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm._frame import settle, stored, table, unused
from gleaner.llm._text import LOWER, U64, blocks, lean, span_hashes, utf8, word_spans

ORDER, DISCOUNT, BLANK = 6, 0.75, 32
#: What the class models take off a count of 1, of 2, and of more: one text alone proves nothing.
CLASS_DISCOUNTS = (1.0, 1.5, 1.75)
WINDOW, FLOOR = 48, 0.01
#: For labels whose held-out share has one class only.
DEFAULT_CURVE = np.array([1.0, 0.0, 1.0, 0.0, 0.0])
TABLE, HELD, SAMPLE = 2_000_000, 8, 20_000
#: Labels up to this many rows go to all tasks; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000
THRESHOLD = 0.7


def distinct_words(batch: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and ends of a batch's distinct words; the number of each word; offsets of the rows."""
    raw, offsets = utf8(batch.column(text))
    raw = LOWER[raw]
    starts, ends, rows = word_spans(raw, offsets)
    _, first, number = np.unique(span_hashes(raw, starts, ends), return_index=True, return_inverse=True)
    return raw, starts[first], ends[first], number, rows


def sequences(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of each word: the word's number, and the byte with the ORDER - 1 before it in one integer."""
    lengths = ends - starts
    word = np.repeat(np.arange(len(starts)), lengths)
    inside = np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = np.repeat(starts, lengths) + inside
    packed = np.zeros(len(word), dtype=U64)
    for back in range(ORDER):
        value = np.where(inside >= back, raw[np.maximum(at - back, 0)], np.uint8(BLANK))
        packed |= value.astype(U64) << U64(8 * back)
    return word, packed


def count_sequences(texts: DataFrame) -> DataFrame:
    """(gram, toxic, ordinary): counts over all rows of (t, y)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "t"):
            raw, starts, ends, number, rows = distinct_words(batch, "t")
            if not len(starts):
                continue
            doc = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
            pairs = np.unique(doc * len(starts) + number)  # a word counts once in each text
            number, label = pairs % len(starts), batch.column("y").to_numpy(zero_copy_only=False)[pairs // len(starts)]
            word, packed = sequences(raw, starts, ends)
            counts = [np.bincount(number[label == c], minlength=len(starts))[word] for c in (1, 0)]
            grams, where = np.unique(packed, return_inverse=True)
            sums = [np.bincount(where, weights=c, minlength=len(grams)).astype(np.int64) for c in counts]
            yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), *map(pa.array, sums)], names=["gram", "toxic", "ordinary"])

    found = texts.select("t", "y").mapInArrow(lean(run), "gram long, toxic long, ordinary long")
    return found.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def suffix(gram: str, length: int):
    return F.col(gram).bitwiseAND(F.lit((1 << 8 * length) - 1))


def shared_model(counts: DataFrame) -> DataFrame:
    """(gram, shared): the chance of each sequence's last byte after ORDER - 2 bytes, from continuation counts."""
    levels = {ORDER: counts.select("gram")}
    for length in range(ORDER - 1, 0, -1):
        levels[length] = settle(levels[length + 1].select(suffix("gram", length).alias("gram")).groupBy("gram").agg(F.count("*").alias("n")))
    model = None
    for length in range(1, ORDER):
        level = levels[length].withColumn("context", F.shiftright("gram", 8))
        level = level.join(level.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")), "context")
        if model is None:
            level = level.withColumn("below", F.lit(1 / 256))
        else:
            level = level.withColumn("end", suffix("gram", length - 1)).join(model.select(F.col("gram").alias("end"), F.col("shared").alias("below")), "end")
        model = level.select("gram", ((F.col("n") - DISCOUNT + DISCOUNT * F.col("kinds") * F.col("below")) / F.col("total")).alias("shared"))
    return model


def ratios(counts: DataFrame) -> DataFrame:
    """(context, gram, ratio): ln P(toxic) / P(ordinary) of each sequence seen; gram null: of all others of a context."""
    rows = counts.select("*", F.shiftright("gram", 8).alias("context"), suffix("gram", ORDER - 1).alias("end"))

    def discount(c: str):
        one, two, more = CLASS_DISCOUNTS
        return F.when(F.col(c) == 0, 0.0).when(F.col(c) == 1, one).when(F.col(c) == 2, two).otherwise(more)

    contexts = rows.groupBy("context").agg(
        *[F.sum(c).cast("double").alias(f"{c}_total") for c in ("toxic", "ordinary")],
        *[F.sum(discount(c)).alias(f"{c}_rest") for c in ("toxic", "ordinary")],
        F.count("*").alias("kinds"),
    )

    def rest(c: str):
        return F.when(F.col(f"{c}_total") > 0, F.col(f"{c}_rest") / F.col(f"{c}_total")).otherwise(F.lit(1.0))

    def chance(c: str):
        own = F.when(F.col(c) > 0, (F.col(c) - discount(c)) / F.col(f"{c}_total")).otherwise(F.lit(0.0))
        return own + rest(c) * F.col("both")

    both = (F.col("toxic") + F.col("ordinary") - DISCOUNT + DISCOUNT * F.col("kinds") * F.col("shared")) / (F.col("toxic_total") + F.col("ordinary_total"))
    shared = shared_model(counts).withColumnRenamed("gram", "end")
    seen = rows.join(contexts, "context").join(shared, "end").withColumn("both", both)
    seen = seen.select("context", "gram", F.ln(chance("toxic") / chance("ordinary")).alias("ratio"))
    return seen.union(contexts.select("context", F.lit(None).cast("long"), F.ln(rest("toxic") / rest("ordinary"))))


class Ratios:
    """A block of the ratio table as sorted arrays."""

    def __init__(self, rows: pa.Table):
        gram, context, ratio = (rows.column(c).combine_chunks() for c in ("gram", "context", "ratio"))
        seen = gram.is_valid().to_numpy(zero_copy_only=False)
        ratio = ratio.to_numpy(zero_copy_only=False).astype(np.float32)
        grams = gram.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)[seen]
        contexts = context.to_numpy(zero_copy_only=False).astype(np.int64)[~seen]
        order = np.argsort(grams), np.argsort(contexts)
        self.grams, self.gram_ratio = grams[order[0]], ratio[seen][order[0]]
        self.contexts, self.context_ratio = contexts[order[1]], ratio[~seen][order[1]]

    def of(self, packed: np.ndarray) -> np.ndarray:
        packed = packed.view(np.int64)
        out, known = lookup(self.grams, self.gram_ratio, packed)
        rest, _ = lookup(self.contexts, self.context_ratio, packed[~known] >> 8)
        out[~known] = rest
        return out


def lookup(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(asked), np.float32), np.zeros(len(asked), bool)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    known = keys[at] == asked
    return np.where(known, values[at], np.float32(0)), known


def features(words: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For each text four numbers; see the module."""
    lengths = np.diff(rows)
    out = np.zeros((len(lengths), 4))
    out[:, 1:] = np.log(FLOOR)
    for k in np.flatnonzero(lengths):
        ratio = words[rows[k] : rows[k + 1]]
        above = np.maximum(ratio - 1, 0)
        size = min(WINDOW, len(ratio))
        sums = np.concatenate([[0.0], np.cumsum(above)])
        peaks = above.mean(), np.maximum(ratio - np.median(ratio) - 3, 0).mean(), (sums[size:] - sums[:-size]).max() / size
        out[k] = ratio.mean(), *np.log(np.array(peaks) + FLOOR)
    return out


@dataclass
class Block:
    """A block of the ratio table, written; broadcast from its first use until it is released."""

    rows: DataFrame
    sent: Broadcast | None = None

    def send(self) -> Broadcast:
        self.sent = self.sent or self.rows.sparkSession.sparkContext.broadcast(Ratios(self.rows.toArrow()))
        return self.sent

    def release(self) -> None:
        if self.sent:
            self.sent.unpersist()  # a frame that has not run yet may still ask for it
        self.sent = None


@dataclass
class Model:
    """The blocks of the ratio table, and the curve: an intercept and a weight for each feature."""

    tables: list[Block]
    curve: np.ndarray


def with_features(docs: DataFrame, text: str, tables: list[Block]) -> tuple[DataFrame, list[str]]:
    """All columns of `docs` and the features. The words' sums so far go from one block of the table to the next."""
    names, sums = [unused(docs, f"ratio_{k}") for k in range(4)], unused(docs, "word_sums")
    out = docs
    for number, table_block in enumerate(tables):
        if number and number % HELD == 0:
            out = stored(out, "word-sums")
            for done in tables[number - HELD : number]:
                done.release()
        block, first, last = table_block.send(), number == 0, number == len(tables) - 1
        fields = [T.StructField(n, T.DoubleType()) for n in names] if last else [T.StructField(sums, T.BinaryType())]
        schema = T.StructType([*docs.schema.fields, *fields])

        def run(batches: Iterator[pa.RecordBatch], block=block, first=first, last=last, names=schema.names) -> Iterator[pa.RecordBatch]:
            for batch in blocks(batches, text):
                raw, starts, ends, number, rows = distinct_words(batch, text)
                word, packed = sequences(raw, starts, ends)
                of_word = np.bincount(word, weights=block.value.of(packed), minlength=len(starts))
                total = of_word[number] if len(starts) else np.zeros(0)
                columns = list(batch.columns)
                if not first:
                    total = total + np.frombuffer(b"".join(columns.pop().to_pylist()), dtype=np.float64)
                if last:
                    columns += [pa.array(c) for c in features(total, rows).T]
                else:
                    columns.append(pa.array([total[a:b].tobytes() for a, b in zip(rows[:-1], rows[1:], strict=True)], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

        out = out.mapInArrow(lean(run), schema)
    return out, names


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    """Newton steps on standardised features; intercept first. The classes weigh as they occur."""
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.hstack([np.ones((len(x), 1)), (x - centre) / scale])
    w = np.zeros(z.shape[1])
    ridge = penalty * len(x) * np.diag([0.0, *np.ones(x.shape[1])])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p) + 1e-9)[:, None]) + ridge, z.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return np.concatenate([[w[0] - (w[1:] * centre / scale).sum()], w[1:] / scale])


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Model | None:
    """The model of all labelled rows of `docs`; None without texts of both classes.

    One label in five, up to about `sample` of them, is kept from the counts for the curve.
    """
    marks = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("key"), (F.col(label) != 0).cast("int").alias("y"))
    rows = marks.count()
    share = F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < int(1_000_000 * min(0.2, sample / max(rows, 1)))
    texts = docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("t"))

    def joined(marks: DataFrame) -> DataFrame:
        return texts.join(F.broadcast(marks) if rows <= BROADCAST_ROWS else marks, "key").select("t", "y")

    counts = settle(count_sequences(joined(marks.where(~share))))
    size, toxic, ordinary = counts.agg(F.count("*"), F.sum("toxic"), F.sum("ordinary")).first()
    if not toxic or not ordinary:
        return None
    found = settle(ratios(counts))
    number = -(-2 * size // TABLE)
    if number == 1:
        parts = [found]
    else:
        parts = [found.where(F.pmod(F.xxhash64("context"), F.lit(number)) == k) for k in range(number)]
    tables = [Block(part) for part in parts]
    held, names = with_features(joined(marks.where(share)), "t", tables)
    rows = held.select("y", *names).toArrow()
    y, x = rows.column("y").to_numpy().astype(float), np.column_stack([rows.column(c).to_numpy() for c in names])
    curve = logistic(x, y) if len(set(y.tolist())) > 1 else DEFAULT_CURVE
    return Model(tables, curve)


def score(docs: DataFrame, model: Model | None, *, text: str = "text") -> tuple[DataFrame, str]:
    """All rows and columns of `docs`, and the name of the new column with the score."""
    name = unused(docs, "score")
    if model is None:
        return docs.withColumn(name, F.lit(0.5)), name
    found, names = with_features(docs, text, model.tables)
    height = F.lit(float(model.curve[0]))
    for weight, column in zip(model.curve[1:], names, strict=True):
        height = height + float(weight) * F.col(column)
    value = 1 / (1 + F.exp(-height))
    return found.select(*docs.columns, value.alias(name)), name


def drop_toxic(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, **names) -> DataFrame:
    """`docs` without the rows scored `threshold` or more; all its columns and no other."""
    found, name = score(docs, fit(docs, labels, **names), text=names.get("text", "text"))
    return found.where(F.col(name) < threshold).select(docs.columns)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every document by a model of two thirds of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(3))
    model = fit(docs.where(fold != 1), table(spark, sf_dir, "labels").where(fold != 1))
    found, name = score(docs, model)
    return found.select("doc_id", (fold == 1).alias("held_out"), F.col(name).alias("score"), (F.col(name) >= THRESHOLD).cast("int").alias("predicted"))
