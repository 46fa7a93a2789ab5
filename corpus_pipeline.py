"""A training corpus from raw documents: each stage applies one operator of gleaner.llm to what is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleaner.llm._frame import fresh_folder, table
from gleaner.llm.bagminhash import deduplicate
from gleaner.llm.decontaminate import decontaminate
from gleaner.llm.mixing import repeated
from gleaner.llm.tokens import encode_table
from gleaner.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of the labelled ones rejects go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: the one with the smallest id."""
    return deduplicate(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a benchmark passage contaminates go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a document taken in part has its first words."""
    return repeated(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus as token files; a row for each document as read back from them."""
    return encode_table(docs)


STAGES = [
    ("toxicity", toxicity), ("near_dedup", near_dedup), ("decontamination", benchmark_decontamination),
    ("mixing", source_mix), ("tokens", token_output),
]
#: The tokenizer and the language models are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again by the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = fresh_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
