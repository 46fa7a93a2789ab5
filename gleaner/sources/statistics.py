"""Numbers of a stored index that are counted when a part is written and added up when it is searched."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.columns import any_of


def summary(docs: DataFrame, text_fields: list[str]) -> DataFrame:
    """(index_id, site, field, docs, total) of one part: under the empty field its documents and deletes, under
    each text field the documents with a value and the sum of their lengths."""
    alive = F.col("op") != "D"
    sums = [F.count_if(alive).alias("n"), F.count_if(~alive).alias("gone")]
    for name in text_fields:
        length = F.when(alive & (F.col(f"len__{name}") > 0), F.col(f"len__{name}"))
        sums += [F.count(length).alias(f"n_{name}"), F.coalesce(F.sum(length), F.lit(0)).cast("long").alias(f"len_{name}")]
    entries = [F.struct(F.lit("").alias("field"), F.col("n").alias("docs"), F.col("gone").alias("total"))]
    entries += [F.struct(F.lit(n).alias("field"), F.col(f"n_{n}").alias("docs"), F.col(f"len_{n}").alias("total")) for n in text_fields]
    return docs.groupBy("index_id", "site").agg(*sums).select("index_id", "site", F.inline(F.array(*entries)))


@dataclass(frozen=True)
class StoredCounts:
    """Collection numbers of a stored index without a look at its documents.

    ``terms`` (a row for each block that holds a term) and ``lengths`` add up to all rows of all parts; ``dead`` holds the rows among them that were
    rewritten or deleted since, whose share is taken off again.  None means that there are none.
    """

    terms: DataFrame
    lengths: DataFrame
    postings: DataFrame
    dead: DataFrame | None = None

    def scoped(self, scope: Column) -> StoredCounts:
        dead = None if self.dead is None else self.dead.where(scope)
        return replace(self, terms=self.terms.where(scope), lengths=self.lengths.where(scope), postings=self.postings.where(scope), dead=dead)

    def documents(self) -> Column:
        """Number of documents, as a scalar subquery."""
        n = self.lengths.where("field = ''").agg(F.coalesce(F.sum("docs"), F.lit(0))).scalar()
        return n if self.dead is None else n - self.dead.agg(F.count("*")).scalar()

    def collection(self, words: list[tuple[str, str]], lengths: dict[str, bool]) -> Column:
        """Struct of ``df_i`` for each (field, term) and ``avg_<field>`` for each field wanted."""
        wanted = any_of((F.col("field") == f) & (F.col("term") == t) for f, t in dict.fromkeys(words))
        one = {
            f"df_{i}": F.coalesce(F.sum(F.when((F.col("field") == f) & (F.col("term") == t), F.col("df"))), F.lit(0))
            for i, (f, t) in enumerate(words)
        }
        found = self.terms.where(wanted).agg(*[c.alias(n) for n, c in one.items()]).select(F.struct("*").alias("s")).scalar()
        parts = {n: found[n] for n in one}
        if self.dead is not None:
            gone = self.postings.where(wanted).join(self.dead.select("doc_key", "part"), ["doc_key", "part"], "left_semi")
            off = gone.agg(*[
                F.count_if((F.col("field") == f) & (F.col("term") == t)).alias(f"df_{i}") for i, (f, t) in enumerate(words)
            ]).select(F.struct("*").alias("s")).scalar()
            parts = {n: c - off[n] for n, c in parts.items()}
        averaged = [f for f, needed in lengths.items() if needed]
        if averaged:
            sums = self.lengths.where(F.col("field").isin(*averaged)).agg(*[
                c for f in averaged for c in (
                    F.sum(F.when(F.col("field") == f, F.col("docs"))).alias(f"n_{f}"),
                    F.sum(F.when(F.col("field") == f, F.col("total"))).alias(f"len_{f}"))
            ]).select(F.struct("*").alias("s")).scalar()
            off = None
            if self.dead is not None:
                off = self.dead.agg(*[
                    c for f in averaged for c in (
                        F.count_if(F.col(f"len__{f}") > 0).alias(f"n_{f}"),
                        F.coalesce(F.sum(f"len__{f}"), F.lit(0)).alias(f"len_{f}"))
                ]).select(F.struct("*").alias("s")).scalar()
            for f in averaged:
                n, length = sums[f"n_{f}"], sums[f"len_{f}"]
                if off is not None:
                    n, length = n - off[f"n_{f}"], length - off[f"len_{f}"]
                parts[f"avg_{f}"] = F.when(n > 0, length.cast("double") / n)
        return F.struct(*[c.alias(n) for n, c in parts.items()])

    def document_frequency(self) -> DataFrame:
        """(field, term, df) of all terms: the stored counts, less those of dead rows."""
        counts = self.terms.select("field", "term", "df")
        if self.dead is not None:
            gone = self.postings.join(self.dead.select("doc_key", "part"), ["doc_key", "part"], "left_semi")
            counts = counts.unionByName(gone.groupBy("field", "term").agg((-F.count("*")).alias("df")))
        return counts.groupBy("field", "term").agg(F.sum("df").alias("df")).where("df > 0")
