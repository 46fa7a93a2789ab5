"""Reading source tables, word lists and small side inputs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder the session names."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="gleaner-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/gleaner/{name}-{uuid.uuid4().hex}"


def read_word_table(spark: SparkSession, path: str) -> DataFrame:
    """A word list of any size as a table ``(word)``, for ``without_stopwords`` and ``expand_synonyms``."""
    line = F.trim("value").alias("word")
    return spark.read.text(path).select(line).where((F.col("word") != "") & ~F.col("word").startswith("#"))


def _lines(spark: SparkSession, path: str) -> list[str]:
    """All lines of a list that becomes part of a chain's configuration."""
    return [r.word for r in read_word_table(spark, path).collect()]


def read_word_list(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Stop words or protected words: one per line, ``#`` starts a comment line."""
    return tuple(_lines(spark, path))


def read_synonyms(spark: SparkSession, path: str) -> dict[str, tuple[str, ...]]:
    """``a, b, c`` makes all of them synonyms; ``a => b, c`` maps one way."""
    out: dict[str, list[str]] = {}
    for line in _lines(spark, path):
        left, arrow, right = line.partition("=>")
        words = [w.strip().lower() for w in left.split(",") if w.strip()]
        targets = [w.strip().lower() for w in right.split(",") if w.strip()] if arrow else words
        for word in words:
            out.setdefault(word, []).extend(t for t in targets if t != word)
    return {k: tuple(dict.fromkeys(v)) for k, v in out.items()}


def read_char_map(spark: SparkSession, path: str) -> dict[str, str]:
    """Lines of the form ``"é" => "e"``."""
    pairs = (line.partition("=>") for line in _lines(spark, path))
    return {a.strip().strip('"'): b.strip().strip('"') for a, sep, b in pairs if sep}


def read_elevation(spark: SparkSession, path: str) -> DataFrame:
    """``<query text="..."><doc id="..."/>...</query>`` lists -> (query_text, doc_key, rank)."""
    schema = "_text string, doc array<struct<_id string>>"
    queries = spark.read.format("xml").option("rowTag", "query").schema(schema).load(path)
    return queries.select(F.col("_text").alias("query_text"), F.posexplode("doc").alias("rank", "doc")).select(
        "query_text", F.col("doc._id").alias("doc_key"), "rank")


def read_external_ranks(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``document=number`` -> (doc_key, rank)."""
    line = F.col("value")
    return spark.read.text(path).where(line.contains("=")).select(
        F.regexp_extract(line, r"^(.*)=[^=]*$", 1).alias("doc_key"),
        F.regexp_extract(line, r"=([^=]*)$", 1).try_cast("double").alias("rank"),
    )


def without_stopwords(postings: DataFrame, stopwords: DataFrame, word: str = "word") -> DataFrame:
    """Drop the rows of a stop word table of any size; positions keep their gaps.

    Spark broadcasts the list when its measured size allows, else it shuffles.
    """
    words = stopwords.select(F.lower(word).alias("term")).distinct()
    return postings.join(words, "term", "left_anti")


def expand_synonyms(terms: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Query terms plus their synonyms: ``(term)`` joined to ``(term, synonym)``."""
    asked = terms.select("term").distinct()
    extra = asked.join(synonyms.select("term", F.lower("synonym").alias("synonym")).distinct(), "term")
    return asked.unionByName(extra.select(F.col("synonym").alias("term"))).distinct()


def normalized(text: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(text, r"\s+", " ")))
