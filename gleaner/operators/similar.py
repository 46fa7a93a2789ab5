"""Documents similar to one document, by its most telling terms."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.columns import compute_once, let, total
from gleaner.operators.scoring import DIGITS
from gleaner.sources.index import SearchIndex, document_key, row_keys, with_words

MAX_TERMS = 25


@dataclass(frozen=True)
class Similar:
    item_id: str
    fields: tuple[str, ...]
    max_terms: int = MAX_TERMS  # the feature's own number of telling terms
    site: str | None = None  # of the source document, if not the index's own
    index_id: str | None = None

    def key(self, index: SearchIndex) -> Column:
        """Ids are unique within a site and index only."""
        site, index_id = self.site or index.spec.site, self.index_id or index.spec.index_id
        return document_key(F.lit(site), F.lit(index_id), F.lit(self.item_id))


def usable_fields(index: SearchIndex, fields: tuple[str, ...]) -> list[str]:
    """Dates and places are not compared; other values count as one term each."""
    skipped = ("date", "location", "point", "binary")
    return [f for f in fields if not index.spec[f].type.startswith(skipped)]


def _chosen(own: DataFrame, df: DataFrame, n: Column, limit: int) -> DataFrame:
    """The source's best terms: ``(field, term, weight, idf2)``, at most ``limit`` rows."""
    idf = 1 + F.log(F.col("_n").cast("double") / (F.col("df") + 1))
    return (
        compute_once(own.join(df, ["field", "term"]), {"_n": n})
        .withColumns({"weight": F.round(F.col("own_tf") * idf, DIGITS), "idf2": F.pow(idf, F.lit(2.0))})
        .orderBy(F.col("weight").desc(), F.col("field").asc(), F.col("term").asc())
        .limit(limit)
    )


def _term_score(weight: Column, idf2: Column, tf: Column, length: Column) -> Column:
    return weight * F.sqrt(tf.cast("double")) * idf2 / F.sqrt(length.cast("double"))


def similar_scores(index: SearchIndex, similar: Similar) -> DataFrame:
    """``(doc_key[, version], score)`` of the documents that share a chosen term with the source."""
    fields = usable_fields(index, similar.fields)
    n = index.docs.agg(F.count("*").alias("n")).scalar()
    source = index.docs.where(F.col("doc_key") == similar.key(index))
    if index.stored_postings is not None:
        return _from_postings(index, source, fields, n, similar)
    return _from_rows(index, source, fields, n, similar)


def _from_postings(index: SearchIndex, source: DataFrame, fields: list[str], n: Column, similar: Similar) -> DataFrame:
    """Only postings of the source's terms are read; the chosen ones are joined for the scores."""
    terms = index.term_rows(fields)
    own_rows = SearchIndex(index.spec, source, index.stored_postings).term_rows(fields)
    own = own_rows.select("field", "term", F.col("tf").alias("own_tf"), F.col("doc_key").alias("own_key"))
    df = (
        terms.join(own.select("field", "term"), ["field", "term"], "left_semi")
        .groupBy("field", "term").agg(F.count("*").alias("df"))
    )
    chosen = _chosen(own, df, n, similar.max_terms)
    hits = index.term_rows(fields, checked=False).join(chosen, ["field", "term"])
    # the caller joins the scores to live documents, write by write
    keys = row_keys(hits)
    return hits.where(F.col("doc_key") != F.col("own_key")).groupBy(*keys).agg(
        F.round(F.sum(_term_score(F.col("weight"), F.col("idf2"), F.col("tf"), F.col("len"))), DIGITS - 2).alias("score")
    )


def _from_rows(index: SearchIndex, source: DataFrame, fields: list[str], n: Column, similar: Similar) -> DataFrame:
    """Without stored postings: two scans, no join of the corpus.

    The first counts the source's terms, the second scores every document inside
    its own row.  The source's terms and the chosen ones (one document's worth and
    at most ``max_terms``) enter as scalar subqueries.
    """
    own_words = with_words(source, index.spec, fields)
    own_lists = {
        f"_own_{f}": own_words.agg(F.flatten(F.collect_list(f"_words_{f}")).alias("w")).scalar() for f in fields
    }
    own = (
        own_words.select(F.inline(F.concat(*[
            F.transform(f"_words_{f}", lambda w: F.struct(F.lit(f).alias("field"), w.alias("term"))) for f in fields
        ])))
        .groupBy("field", "term").agg(F.count("*").alias("own_tf"))
    )
    rows = with_words(index.docs, index.spec, fields)
    shared = compute_once(rows, own_lists).select(F.inline(F.concat(*[
        F.transform(
            F.array_intersect(f"_words_{f}", f"_own_{f}"),
            lambda w: F.struct(F.lit(f).alias("field"), w.alias("term")),
        )
        for f in fields
    ])))
    df = shared.groupBy("field", "term").agg(F.count("*").alias("df"))
    chosen = _chosen(own, df, n, similar.max_terms).agg(
        F.collect_list(F.struct("field", "term", "weight", "idf2")).alias("c")).scalar()
    rows = compute_once(rows.where(F.col("doc_key") != similar.key(index)), {"_chosen": chosen})
    scored = compute_once(rows, {"score": total(_row_score(index, f) for f in fields)})
    return scored.where("score > 0").select("doc_key", F.round("score", DIGITS - 2).alias("score"))


def _row_score(index: SearchIndex, field: str) -> Column:
    """Score of one field: its words are cut down to the chosen terms, then counted."""
    f = index.spec[field]
    wanted = F.filter("_chosen", lambda c: c["field"] == field)
    terms = F.transform(wanted, lambda c: c["term"])
    words = F.col(f"_words_{field}")
    length = F.size(words) if f.is_text and f.chain.norms else F.lit(1)
    def best(selected: Column) -> Column:
        return F.aggregate(
            wanted, F.lit(0.0),
            lambda acc, c: acc + F.when(
                F.array_contains(selected, c["term"]),
                _term_score(c["weight"], c["idf2"], F.size(F.filter(selected, lambda w: w == c["term"])), length),
            ).otherwise(F.lit(0.0)),
        )

    return let(terms, lambda t: let(F.filter(words, lambda w: F.array_contains(t, w)), best))
