"""Spelling variants by permuterm rotations.

Every word, ended by a terminator, is written as all its rotations. Sorted, the rotations that agree in all but
their last character stand together: a prefix range that skips the edited character. Two words in one range differ by
the replacement of that character; a whole rotation that is the range's prefix itself belongs to the word without the
character, so the words of the range have it as a deletion, and it has them as insertions. A deletion inside a
run of equal characters leads to one word from each character of the run: only the run's first one counts.

One range holds one word for each character of the alphabet at most, and one whole rotation. A scan of the range
gives each of its words the number of its neighbours there and the best of them, so no pairs are written.
Ranges are dealt out by their prefix; a frequent word has no more rotations than a rare one of its length.

Definitions. Words are compared by code points. Null and empty words are ignored, a word that occurs in several rows
has the sum of their counts (null counts are 0). Words may not hold U+0000, the terminator; those that do have no
neighbours. A word without neighbours, or whose best one isn't frequent enough, is its own root.
Texts: null is empty; a null document id is the empty string in the hash; rows with equal ids count alike.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm._frame import settle, stored, table

END = "\0"
RATIO = 5
RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH, MIN_COUNT, ONE_IN = 6, 5, 199


def rotations(words: DataFrame) -> DataFrame:
    """(range, edited, head, n, word): each rotation without its last character, the edited one; and each whole
    rotation, without an edited character."""
    size = F.char_length("word")
    at = lambda start, n: F.substring("word", start, n)

    def rotated(first: Column, gap: int) -> Column:
        """The word from `first + gap` on (from 1), the terminator, and the word before `first`."""
        return F.concat(at(first + gap, size), F.lit(END), at(F.lit(1), first - 1))

    skipping = F.transform(
        F.sequence(F.lit(1), size),
        lambda i: F.struct(
            rotated(i, 1).alias("range"), at(i, F.lit(1)).alias("edited"),
            ((i == 1) | (at(i, F.lit(1)) != at(i - 1, F.lit(1)))).alias("head"),
        ),
    )
    whole = F.transform(
        F.sequence(F.lit(1), size + 1),
        lambda i: F.struct(rotated(i, 0).alias("range"), F.lit(None).cast("string").alias("edited"), F.lit(False).alias("head")),
    )
    return words.select("word", "n", F.inline(F.concat(skipping, whole)))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, n_near, near, near_n) of (word, n): number of words at one edit, and the most frequent of them
    (of those, the first by code points)."""
    usable = words.where(F.length("word") > 0).groupBy("word").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    usable = settle(usable)
    rotated = rotations(usable.where(~F.contains("word", F.lit(END))))
    # smallest first: most frequent, then by code points
    rank = F.struct((-F.col("n")).alias("m"), F.col("word").alias("w"))
    rows = rotated.select("range", "edited", "head", "word", rank.alias("rank"))
    is_range = F.col("edited").isNotNull()
    everyone = Window.partitionBy("range")
    ordered = Window.partitionBy("range").orderBy(F.when(is_range, 0).otherwise(1), "rank")
    scanned = rows.select(
        "word", is_range.alias("in_range"), "head", "rank",
        F.count_if(is_range).over(everyone).alias("size"), F.min(F.when(is_range, F.col("rank"))).over(everyone).alias("best"),
        F.count_if("head").over(everyone).alias("heads"), F.min(F.when(F.col("head"), F.col("rank"))).over(everyone).alias("best_head"),
        F.min(F.when(~is_range, F.col("rank"))).over(everyone).alias("whole"),
        F.lead(F.when(is_range, F.col("rank"))).over(ordered).alias("second"),
    )
    other = F.when(F.col("best") == F.col("rank"), F.col("second")).otherwise(F.col("best"))
    shorter = F.when(F.col("head"), F.col("whole"))
    found = scanned.select(
        "word",
        F.when(F.col("in_range"), F.col("size") - 1 + F.when(shorter.isNotNull(), 1).otherwise(0)).otherwise(F.col("heads")).alias("near"),
        F.when(F.col("in_range"), F.least(other, shorter)).otherwise(F.col("best_head")).alias("best"),
    ).where("near > 0")
    by_word = found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    return usable.join(by_word, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.col("best.w").alias("near"), (-F.col("best.m")).alias("near_n"),
    )


def with_roots(forms: DataFrame) -> DataFrame:
    """`root`: from each word along `form` to the last one, by doubling: each step follows what is known of the form.

    A form is RATIO times as frequent as its word, so chains are as short as the logarithm of the counts.
    """
    links = settle(forms.where("form IS NOT NULL").select("word", F.col("form").alias("to")))
    while True:
        further = links.select(F.col("word").alias("to"), F.col("to").alias("further"))
        step = settle(links.join(further, "to", "left").select("word", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")))
        links = step.select("word", "to")
        if not step.where("moved").limit(1).count():
            break
    return forms.join(links, "word", "left").withColumn("root", F.coalesce("to", "word")).drop("to")


def spelling_variants(words: DataFrame, *, ratio: float = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n): the most frequent word at one edit, if it is at least
    `ratio` times as frequent, and the end of the chain of forms."""
    if not (math.isfinite(ratio) and ratio > 1):
        raise ValueError("ratio must be above 1, or chains of forms could be circles")
    found = stored(near_words(words), "near-words")
    is_form = F.col("near_n") >= F.col("n") * F.lit(ratio)
    forms = found.where("n > 0").select("word", "n", "n_near", F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n"))
    return with_roots(stored(forms, "forms")).select("word", "form", "root", "n", "n_near", "form_n")


def damaged_words(docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): lower-cased runs of letters of all texts, one in ONE_IN of them (by the hash of document and run)
    with a letter missing; of at least `min_length` code points and `min_count` occurrences."""
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("d"), F.explode(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.char_length("run") >= min_length)
    run = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run"))
    hashed = runs.select(run.alias("run"), F.crc32(F.concat("d", F.lit(":"), run)).alias("h"))
    place = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.char_length("run")))
    words = hashed.select(F.when(F.col("h") % ONE_IN == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words of all documents, with their standard forms and roots."""
    words = damaged_words(table(spark, sf_dir, "documents"))
    return spelling_variants(words).select(
        "word", "form", "root", "n", "n_near", F.col("form_n").cast("long").alias("form_n")
    )


SQL = r"""
WITH RECURSIVE crc(k) AS (
    SELECT list_transform(range(256), lambda i: list_reduce(
        list_prepend(i::UBIGINT, list_transform(range(8), lambda x: x::UBIGINT)),
        lambda c, x: CASE WHEN c % 2 = 1 THEN xor(3988292384::UBIGINT, c // 2) ELSE c // 2 END))
), runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents
), counted AS (
    SELECT doc_id, run, count(*) AS times, coalesce(doc_id::VARCHAR, '') || ':' || run AS s
    FROM runs WHERE length(run) >= 6 GROUP BY ALL
), hashed AS (
    SELECT run, times, xor(4294967295::UBIGINT, list_reduce(
        list_prepend(4294967295::UBIGINT, list_transform(range(octet_length(encode(s))),
            lambda i: ('0x' || hex(encode(s))[2 * i + 1 : 2 * i + 2])::UBIGINT)),
        lambda c, b: xor(k[(xor(c % 256, b) + 1)::BIGINT], c // 256))) AS h
    FROM counted, crc
), words AS (
    SELECT word, sum(times)::BIGINT AS n FROM (
        SELECT times, CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
                      ELSE run END AS word FROM hashed)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
), cuts AS (
    SELECT DISTINCT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
    FROM words, unnest(range(1, length(word) + 1)) AS r(i)
), near AS (
    SELECT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, count(*) AS n_near, max(n) AS near_n, min(other) FILTER (WHERE place = 1) AS other
    FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY n DESC, other) AS place FROM near) GROUP BY word
), forms AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 5 * w.n THEN b.other END AS form,
           CASE WHEN b.near_n >= 5 * w.n THEN b.near_n END AS form_n
    FROM words w LEFT JOIN best b USING (word)
), chains AS (
    SELECT word, word AS here, 0 AS depth FROM forms
    UNION ALL SELECT c.word, f.form, depth + 1 FROM chains c JOIN forms f ON c.here = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.here AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN (SELECT word, arg_max(here, depth) AS here FROM chains GROUP BY word) c USING (word)
"""
