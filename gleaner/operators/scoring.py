"""Relevance: TF-IDF or BM25 per phrase and field, best field per phrase, summed.

Collection numbers (documents, document frequency, average length) come from one
aggregate over the whole index.  It enters the plan as a scalar subquery, so
scoring adds no join and no driver round trip.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.columns import largest, total
from gleaner.sources.tables import normalized

DIGITS = 6
K1, B = 1.2, 0.75


def tfidf(tf: Column, df: Column, n: Column, length: Column) -> Column:
    """sqrt(tf) * (1 + ln(N / (df + 1)))^2 / sqrt(len)"""
    idf = 1 + F.log(n.cast("double") / (df + 1))
    return F.sqrt(tf.cast("double")) * F.pow(idf, F.lit(2.0)) / F.sqrt(length.cast("double"))


def bm25(tf: Column, df: Column, n: Column, length: Column, average: Column) -> Column:
    idf = F.log(1 + (n - df + 0.5) / (df + 0.5))
    norm = K1 * (1 - B + B * length / average)
    return idf * tf * (K1 + 1) / (tf + norm)


@dataclass(frozen=True)
class Measure:
    """Columns holding one phrase's frequency and the length in one field."""

    phrase: str
    field: str
    tf: str
    length: str
    boost: float
    norms: bool
    weight: str | None = None  # column with the phrase's weight, of pre-tokenized text


def collection_stats(rows: DataFrame, measures: list[Measure]) -> Column:
    """Struct of ``df_i`` per measure and ``avg_<field>`` as a scalar subquery.

    For document frequencies alone ``rows`` may leave out documents without a hit.
    """
    lengths = {m.field: m.length for m in measures}
    stats = [F.count_if(F.col(m.tf) > 0).alias(f"df_{i}") for i, m in enumerate(measures)]
    stats += [
        F.avg(F.when(F.col(c) > 0, F.col(c).cast("double"))).alias(f"avg_{f}") for f, c in lengths.items()
    ]
    return rows.agg(*stats).select(F.struct("*").alias("stats")).scalar()


def score(measures: list[Measure], stats: Column, n: Column, model: str = "tfidf") -> Column:
    """Sum over phrases of the best field's boosted score."""
    per_phrase: dict[str, list[Column]] = {}
    for i, m in enumerate(measures):
        tf, df = F.col(m.tf), stats[f"df_{i}"]
        length = F.col(m.length) if m.norms else F.lit(1)
        if model == "bm25":
            average = stats[f"avg_{m.field}"] if m.norms else F.lit(1.0)
            value = bm25(tf, df, n, length, average)
        else:
            value = tfidf(tf, df, n, length)
        if m.weight:
            value = value * F.col(m.weight)
        per_phrase.setdefault(m.phrase, []).append(F.when(tf > 0, value * m.boost).otherwise(F.lit(0.0)))
    return F.round(total(largest(values) for values in per_phrase.values()), DIGITS)


def elevation_rank(hits: DataFrame, elevation: DataFrame, query_text: str) -> DataFrame:
    """Attach ``elev_rank``: the listed place of a document for this query text, else null."""
    listed = elevation.where(normalized(F.col("query_text")) == normalized(F.lit(query_text)))
    return hits.join(
        listed.groupBy("doc_key").agg(F.min("rank").alias("elev_rank")), "doc_key", "left"
    )
