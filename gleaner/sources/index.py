"""Documents, postings and dictionaries built from any source DataFrame.

Everything here is lazy.  A ``SearchIndex`` is either derived from its source on
the fly (terms are then found inside the document rows, without a shuffle) or
backed by stored postings clustered by term (a query then reads the row groups
of its terms only).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions.analysis import analyzer, group_terms
from gleaner.functions.coerce import coerce_values, first_value
from gleaner.functions.columns import compute_once, is_array, largest, let, sort_key, total
from gleaner.operators.keys import phrase_frequency
from gleaner.sources.inversion import is_direct
from gleaner.sources.statistics import StoredCounts
from gleaner.spec import FieldSpec, IndexSpec


def document_key(site: Column, index_id: Column, item_id: Column) -> Column:
    return F.concat_ws("-", site, index_id, item_id)


def _field_value(f: FieldSpec) -> Column:
    if f.copies and not f.source:
        return F.lit(None).cast(f.spark_type)
    value = F.expr(f.source or f"`{f.name}`")
    if f.type == "tokens":
        return value
    if f.multi:
        value = F.filter(value, lambda v: v.isNotNull())
    if f.type == "date":
        value = F.transform(value, lambda v: F.date_trunc("second", v)) if f.multi else F.date_trunc("second", value)
    return value.cast(f.spark_type)


def build_documents(source: DataFrame, spec: IndexSpec, site: str | None = None) -> DataFrame:
    """Source rows -> document rows: reserved columns, fields, derived columns.

    ``site`` names a source column holding the site; by default all rows belong
    to the site of the index.
    """
    keep = [c for c in ("version", "op") if c in source.columns]
    docs = source.select(
        F.lit(spec.index_id).alias("index_id"),
        (F.col(site) if site else F.lit(spec.site)).cast("string").alias("site"),
        F.col(spec.key).cast("string").alias("item_id"),
        *keep,
        *[_field_value(f).alias(f.name) for f in spec.fields],
    )
    docs = docs.withColumn("doc_key", document_key(F.col("site"), F.col("index_id"), F.col("item_id")))
    docs = with_derived(with_copies(docs, spec), spec)
    return docs.transform(lambda d: spec.on_documents(d, spec)) if spec.on_documents else docs


def with_copies(docs: DataFrame, spec: IndexSpec) -> DataFrame:
    """Fill the fields that copy others: own values first, then those of the copied fields in the order of the spec.

    A single-valued field takes the first value.  Copies see copies made before them, whatever the order of the spec.
    """

    def values(f: FieldSpec, kind: T.DataType) -> Column:
        if f.type == "tokens":
            own = F.transform(f.name, lambda x: x["value"])
        else:
            own = F.col(f.name) if f.multi else F.array(f.name)
        several = own.cast(T.ArrayType(kind))
        return F.coalesce(F.filter(several, lambda v: v.isNotNull()), F.array().cast(T.ArrayType(kind)))

    for f in spec.copy_order():
        kind = f.field_type.spark_type
        taken = F.concat(*[values(s, kind) for s in [f, *spec.copied(f)]])
        docs = docs.withColumn(f.name, F.when(F.size(taken) > 0, taken if f.multi else F.get(taken, F.lit(0))))
    return docs


def with_derived(docs: DataFrame, spec: IndexSpec) -> DataFrame:
    """First-value columns, sort companions and the spelling source."""
    first = {f.first_column: F.get(F.col(f.name), F.lit(0)) for f in spec.fields if f.multi and f.type != "tokens"}
    docs = docs.withColumns(first) if first else docs
    sort = {
        f.sort_column: sort_key(F.col(f.first_column))
        for f in spec.fields
        if f.sort_column and f.sort_column.startswith("sort__") and not f.is_text  # a text is no second copy of itself
    }
    return docs.withColumns(sort) if sort else docs


def spell_texts(spec: IndexSpec) -> Column:
    """All texts of a row that feed the spelling dictionary, nulls dropped."""
    parts = [
        F.col(f.name) if f.multi else F.array(F.col(f.name))
        for f in spec.text_fields
        if f.copy_to_spell and f.type != "tokens"
    ]
    joined = F.concat(*[F.coalesce(p, F.array().cast("array<string>")) for p in parts])
    return F.filter(joined, lambda v: v.isNotNull())


def split_unknown(source: DataFrame, spec: IndexSpec, values: str = "fields") -> tuple[DataFrame, DataFrame]:
    """Rows of a ``map<string, array<string>>`` column -> (accepted, rejected)."""
    known = F.array(*[F.lit(f.name) for f in spec.fields])
    unknown = F.array_except(F.map_keys(values), known)
    marked = source.withColumn("unknown_fields", unknown)
    return (
        marked.where(F.size("unknown_fields") == 0).drop("unknown_fields"),
        marked.where(F.size("unknown_fields") > 0),
    )


def coerce_documents(source: DataFrame, spec: IndexSpec, values: str = "fields") -> DataFrame:
    """Rows with raw text values per field -> typed document rows."""
    raw = {f.name: F.try_element_at(F.col(values), F.lit(f.name)) for f in spec.fields}
    docs = source.select(
        F.lit(spec.index_id).alias("index_id"),
        F.lit(spec.site).alias("site"),
        F.col(spec.key).cast("string").alias("item_id"),
        *[coerce_values(raw[f.name], f.type).alias(f.name) for f in spec.fields],
        *[first_value(raw[f.name], f.type).alias(f"first__{f.name}") for f in spec.fields],
    )
    return docs.withColumn("doc_key", document_key(F.col("site"), F.col("index_id"), F.col("item_id")))


def documents_from_text(source: DataFrame, spec: IndexSpec, values: str = "fields") -> DataFrame:
    """Rows with raw text values per field -> documents that can be searched and stored: every field in its
    own type, single or multi-valued, with its derived columns, and ``version`` and ``op`` if the rows have them."""
    raw = {f.name: F.try_element_at(F.col(values), F.lit(f.name)) for f in spec.fields}
    keep = [c for c in ("version", "op") if c in source.columns]
    docs = source.select(
        F.lit(spec.index_id).alias("index_id"),
        F.lit(spec.site).alias("site"),
        F.col(spec.key).cast("string").alias("item_id"),
        *keep,
        *[
            (coerce_values(raw[f.name], f.type) if f.multi else first_value(raw[f.name], f.type)).cast(f.spark_type).alias(f.name)
            for f in spec.fields
        ],
    )
    docs = docs.withColumn("doc_key", document_key(F.col("site"), F.col("index_id"), F.col("item_id")))
    return with_derived(docs, spec)


# -- maintenance -------------------------------------------------------------


def row_keys(rows: DataFrame) -> list[str]:
    """The columns that name one write of a document: its key, and in a store its part, else its version."""
    return ["doc_key", *[c for c in ("part", "version") if c in rows.columns][:1]]


def latest(log: DataFrame, key: str = "doc_key", order: tuple[str, ...] = ("version",)) -> DataFrame:
    """Last write per key.  Partial aggregation keeps one row per key and task,
    so a key with a third of all writes costs no more than the others."""
    row = F.struct(*log.columns)
    newest = log.groupBy(key).agg(F.max_by(row, F.struct(*order)).alias("_row"))
    return newest.select("_row.*")


def current_view(log: DataFrame, key: str = "doc_key", order: tuple[str, ...] = ("version",)) -> DataFrame:
    """Latest write per key without the deleted ones."""
    return latest(log, key, order).where(F.col("op") != "D")


def delete_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return docs.join(ids.select("doc_key").distinct(), "doc_key", "left_anti")


def tombstones(ids: DataFrame, docs_schema: T.StructType, version: Column) -> DataFrame:
    """Delete markers with the layout of the log."""
    made = {"op": F.lit("D"), "version": version}
    present = set(ids.columns)
    return ids.select(
        *[
            (made.get(f.name, F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType)).alias(f.name)
            for f in docs_schema.fields
        ]
    )


def delete_where(docs: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition holds go; unknown counts as not holding."""
    return docs.where(~F.coalesce(condition, F.lit(False)))


def delete_all(docs: DataFrame) -> DataFrame:
    """An empty snapshot with the same layout."""
    return docs.where(F.lit(False))


def delete_index(docs: DataFrame, spec: IndexSpec) -> DataFrame:
    """Drop the rows of one index (all sites share the table), unless read-only."""
    if spec.read_only:
        return docs
    return delete_where(docs, (F.col("index_id") == spec.index_id) & (F.col("site") == spec.site))


def remaining_items(source: DataFrame, indexed: DataFrame, keys: tuple[str, ...] = ("item_id", "version")) -> DataFrame:
    """Tracked items whose current version is not in the index yet."""
    return source.join(indexed.select(*keys), list(keys), "left_anti")


def index_statistics(log: DataFrame) -> DataFrame:
    """Writes, deletes and live documents per index and site."""
    per_document = log.groupBy("index_id", "site", "doc_key").agg(
        F.count("*").alias("n"), F.count_if(F.col("op") == "D").alias("d"), F.max_by("op", "version").alias("last"))
    return per_document.groupBy("index_id", "site").agg(
        F.sum("n").alias("log_rows"), F.sum("d").alias("deletes"), F.count_if(F.col("last") != "D").alias("docs"))


def with_external_rank(docs: DataFrame, ranks: DataFrame, default: float = 1.0) -> DataFrame:
    """Attach ``rank`` by id; documents that are not listed get the default."""
    return docs.join(ranks.select("doc_key", "rank"), "doc_key", "left").withColumn(
        "rank", F.coalesce("rank", F.lit(default))
    )


def ranked_by(hits: DataFrame, ranks: DataFrame, default: float = 1.0) -> DataFrame:
    """Multiply the score by the external rank of each document."""
    ranked = with_external_rank(hits, ranks, default)
    return ranked.withColumn("score", F.col("score") * F.col("rank")).drop("rank")


def with_site_url(docs: DataFrame, urls: DataFrame, on: list[str]) -> DataFrame:
    """Attach the base URL of the site (per language)."""
    return docs.join(urls, on, "left")


# -- terms -------------------------------------------------------------------


@dataclass(frozen=True)
class Lookup:
    """What to look up in one text field: its terms, and phrases as slots of term indexes."""

    terms: list[str]
    phrases: dict[str, list[list[int]]]

    def columns(self, field: str, found: Column, tokens: Column | None = None) -> list[Column]:
        weights = [] if tokens is None else [
            self.weight(slots, lambda terms: last_weight(tokens, terms)).alias(f"_w_{field}_{j}")
            for j, slots in enumerate(self.phrases.values())
        ]
        return [
            F.coalesce(found["len"], F.lit(0)).alias(f"_len_{field}"),
            *[F.coalesce(found[f"t{j}"], F.lit(0)).alias(f"_tf_{field}_{j}") for j in range(len(self.phrases))],
            *weights,
        ]

    def weight(self, slots: list[list[int]], of: Callable[[list[str]], Column]) -> Column:
        """Of a phrase: the mean weight of its words."""
        used = [slot for slot in slots if slot]
        return total(of([self.terms[i] for i in slot]) for slot in used) / max(1, len(used))


def _raw_tokens(f: FieldSpec) -> Column:
    """Tokens of a text field before stemming; empty where the field is missing."""
    if f.type == "tokens":
        tokens = F.transform(
            F.col(f.name), lambda x, i: F.struct(F.lower(x["value"]).alias("term"), i.alias("pos"))
        )
    else:
        tokens = f.chain.tokens(F.col(f.name), f.multi)
    return F.coalesce(tokens, F.array().cast("array<struct<term:string,pos:int>>"))


def with_tokens(docs: DataFrame, spec: IndexSpec, names: list[str], prefix: str = "_tok_") -> DataFrame:
    """Add the token column ``<prefix><field>`` of text fields, computed in the row."""
    return _with_tokens(docs, spec, names, prefix)


def _with_tokens(
    docs: DataFrame, spec: IndexSpec, names: list[str], prefix: str = "_tok_", given: dict[str, Column] | None = None,
) -> DataFrame:
    raw = {prefix + n: given[n] if given and n in given else _raw_tokens(spec[n]) for n in names}
    stemmed = {prefix + n: spec[n].chain for n in names if spec[n].type != "tokens" and spec[n].chain.stemmer}
    docs = docs.withColumns(raw)
    return docs.withColumns({c: chain.stemmed(F.col(c)) for c, chain in stemmed.items()}) if stemmed else docs


def with_words(
    docs: DataFrame, spec: IndexSpec, names: list[str], prefix: str = "_words_", distinct: bool = False
) -> DataFrame:
    """Add ``array<string>`` columns with the terms of any fields, repeats included unless ``distinct``.

    Values of other fields are one term each.  Documents read from a store carry
    term vectors of the fields that are costly to analyze, which then replace the analysis.
    """
    held = [n for n in names if distinct and "terms" in docs.columns and spec[n].is_text and not is_direct(spec[n])]
    stemmed = [
        n for n in names
        if spec[n].is_text and n not in held and spec[n].type != "tokens" and spec[n].chain.stemmer
    ]
    if stemmed:
        docs = _with_tokens(docs, spec, stemmed)

    def stored(n: str) -> Column:
        own = F.filter("terms", lambda t: t["field"] == n)
        return F.transform(own, lambda t: t["term"])

    def analyzed(n: str) -> Column:
        f = spec[n]
        if is_direct(f):
            words = f.chain.kept_words(F.coalesce(F.col(n), F.lit("")))
        else:
            words = F.transform(F.col(f"_tok_{n}") if n in stemmed else _raw_tokens(f), lambda x: x["term"])
        return F.array_distinct(words) if distinct else words

    text = {prefix + n: stored(n) if n in held else analyzed(n) for n in names if spec[n].is_text}
    plain = {prefix + n: value_array(docs, n).cast("array<string>") for n in names if not spec[n].is_text}
    return compute_once(docs, {**text, **plain}).drop(*[f"_tok_{n}" for n in names])


def scored_tokens(docs: DataFrame, name: str) -> DataFrame:
    """Pre-tokenized text: one row per value, the last score of a value wins."""
    return (
        docs.select("item_id", F.posexplode(name).alias("pos", "token"))
        .groupBy("item_id", F.lower("token.value").alias("term"))
        .agg(F.count("*").alias("tf"), F.max_by("token.score", "pos").alias("weight"))
    )


def last_weight(tokens: Column, terms: list) -> Column:
    """The score of the last value that is one of the terms; 1 where it has none."""
    own = F.filter(tokens, lambda x: F.lower(x["value"]).isin(*terms))
    return F.coalesce(F.try_element_at(own, F.lit(-1))["score"], F.lit(1.0))


def term_vectors(docs: DataFrame, spec: IndexSpec, names: list[str]) -> DataFrame:
    """Add ``terms``: per text field and distinct term its frequency, positions, the field length and the term's weight."""
    rows = with_tokens(docs, spec, names)
    entries = []
    for n in names:
        chain = spec[n].chain

        def entry(size: Column, g: Column) -> Column:
            return F.struct(
                F.lit(n).alias("field"),
                g["term"].alias("term"),
                (F.size(g["positions"]) if chain.frequencies else F.lit(1)).alias("tf"),
                (g["positions"] if chain.frequencies else F.array().cast("array<int>")).alias("positions"),
                (size if chain.norms else F.lit(1)).alias("len"),
                (last_weight(F.col(n), [g["term"]]) if spec[n].type == "tokens" else F.lit(1.0)).alias("weight"),
            )

        entries.append(let(
            F.col(f"_tok_{n}"),
            lambda t: F.transform(group_terms(t), lambda g: entry(F.size(t), g)),
        ))
    return compute_once(rows, {"terms": F.concat(*entries)}).drop(*[f"_tok_{n}" for n in names])


def distinct_terms(docs: DataFrame, spec: IndexSpec, names: list[str]) -> DataFrame:
    """``(doc_key, field, term)``, once per document: postings for those who only count documents."""
    rows = with_words(docs, spec, names, distinct=True)
    pairs = [F.transform(f"_words_{n}", lambda w: F.struct(F.lit(n).alias("field"), w.alias("term"))) for n in names]
    return rows.select("doc_key", F.inline(F.concat(*pairs)))


def doc_frequency(postings: DataFrame) -> DataFrame:
    """Documents per field and term: one posting is one document."""
    return postings.groupBy("field", "term").agg(F.count("*").alias("df"))


def field_statistics(postings: DataFrame) -> DataFrame:
    """Per field: documents with a value, distinct terms and postings."""
    terms = doc_frequency(postings).groupBy("field").agg(
        F.count("*").alias("terms"), F.sum("df").alias("postings"))
    docs = postings.select("field", "doc_key").distinct().groupBy("field").agg(F.count("*").alias("docs"))
    return terms.join(docs, "field")


def top_terms(postings: DataFrame, n: int) -> DataFrame:
    """The n most frequent terms per field."""
    from gleaner.operators.grouping import top_n

    return top_n(doc_frequency(postings), ["field"], [F.col("df").desc(), F.col("term").asc()], n)


def spell_dictionary(docs: DataFrame, spec: IndexSpec, by: tuple[str, ...] = ()) -> DataFrame:
    """Terms of the spelling chain with their document frequency (per ``by`` column)."""
    chain = analyzer("spell")
    words = F.array_distinct(F.flatten(F.transform(
        spell_texts(spec),
        lambda v: F.filter(chain.words(v), lambda w: F.length(w).between(chain.min_length, chain.max_length)),
    )))
    rows = docs
    return rows.select(*by, F.explode(words).alias("term")).groupBy(*by, "term").agg(F.count("*").alias("df"))


def dictionary_from_lines(lines: DataFrame) -> DataFrame:
    """A word file (``spark.read.text``) as a dictionary."""
    return lines.select(F.lower(F.trim("value")).alias("term")).where("term <> ''").groupBy("term").agg(
        F.count("*").alias("df")
    )


@dataclass(frozen=True)
class SearchIndex:
    """Documents of one or several indexes plus access to their terms."""

    spec: IndexSpec
    docs: DataFrame
    stored_postings: DataFrame | None = None
    counts: StoredCounts | None = None  # of the stored postings
    index_ids: tuple[str, ...] | None = None  # what a request without index ids searches, by default the spec's

    @classmethod
    def build(cls, source: DataFrame, spec: IndexSpec, site: str | None = None, partitions: int | None = None) -> "SearchIndex":
        """``partitions`` spreads the source's rows first, e.g. a small file that Spark reads as one task."""
        source = source.repartition(partitions) if partitions else source
        return cls(spec, build_documents(source, spec, site))

    @property
    def spark(self) -> SparkSession:
        return self.docs.sparkSession

    def scoped(self, sites: tuple[str, ...] | None = None, index_ids: tuple[str, ...] | None = None) -> "SearchIndex":
        """Restrict to the index (always) and to sites (unless all are wanted)."""
        ids = index_ids or self.index_ids or (self.spec.index_id,)
        scope = F.col("index_id").isin(*ids)
        if sites is not None:
            scope = scope & F.col("site").isin(*sites)
        counts = None if self.counts is None else self.counts.scoped(scope)
        stored = None if self.stored_postings is None else self.stored_postings.where(scope)
        return replace(self, docs=self.docs.where(scope), stored_postings=stored, counts=counts)

    def document_frequency(self, fields: list[str] | None = None) -> DataFrame:
        """``(field, term, df)``; a stored index reads its term counts only."""
        names = fields or [f.name for f in self.spec.text_fields]
        if self.counts is not None:
            return self.counts.document_frequency().where(F.col("field").isin(*names))
        return doc_frequency(distinct_terms(self.docs, self.spec, names))

    def postings(self, fields: list[str] | None = None, checked: bool = True) -> DataFrame:
        """``(doc_key, field, term, tf, positions, len)`` of the text fields.

        Unchecked stored postings may belong to documents that are gone; a later
        join with the documents drops them.
        """
        names = fields or [f.name for f in self.spec.text_fields]
        if self.stored_postings is not None and not checked:
            return self.stored_postings.where(F.col("field").isin(*names))
        if self.stored_postings is not None:
            # A stored posting belongs to one write of a document; the semi join
            # keeps those of live, scoped documents.
            keys = row_keys(self.stored_postings)
            return self.stored_postings.where(F.col("field").isin(*names)).join(
                self.docs.select(*keys), keys, "left_semi"
            )
        return term_vectors(self.docs, self.spec, names).select(*row_keys(self.docs), F.inline("terms"))

    def term_rows(self, fields: list[str], checked: bool = True) -> DataFrame:
        """``(doc_key, field, term, tf, len)`` of any fields; other values are one term each."""
        text = [n for n in fields if self.spec[n].is_text]
        plain = [n for n in fields if not self.spec[n].is_text]
        parts = []
        if text:
            parts.append(self.postings(text, checked).select(*row_keys(self.docs), "field", "term", "tf", "len"))
        if plain:
            values = F.concat(*[
                F.transform(
                    value_array(self.docs, n),
                    lambda v: F.struct(
                        F.lit(n).alias("field"), v.cast("string").alias("term"),
                        F.lit(1).alias("tf"), F.lit(1).alias("len"),
                    ),
                )
                for n in plain
            ])
            parts.append(self.docs.select(*row_keys(self.docs), F.inline(values)))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def with_frequencies(
        self, lookups: dict[str, Lookup], need_match: bool = False, tokens: dict[str, Column] | None = None,
    ) -> DataFrame:
        """Documents plus ``_len_<field>`` and one ``_tf_<field>_<i>`` per phrase.

        ``need_match`` says that documents without any of the terms cannot match,
        so stored postings may be joined from the inside.  ``tokens`` replace those of stemmed fields.
        """
        if not lookups:
            return self.docs
        if self.stored_postings is not None:
            return self._frequencies_from_postings(lookups, need_match)
        stemmed = [n for n in lookups if self.spec[n].is_text and self.spec[n].chain.stemmer]
        rows = _with_tokens(self.docs, self.spec, stemmed, given=tokens or {}) if stemmed else self.docs
        found = compute_once(rows, {
            f"_x_{n}": _row_frequencies(self.spec[n], lookup, F.col(f"_tok_{n}") if n in stemmed else None)
            for n, lookup in lookups.items()
        })
        return found.select(
            *self.docs.columns,
            *[
                c for n, lookup in lookups.items()
                for c in lookup.columns(n, F.col(f"_x_{n}"), F.col(n) if self.spec[n].type == "tokens" else None)
            ],
        )

    def with_hits(self, lookups: dict[str, Lookup]) -> DataFrame:
        """``with_frequencies`` for those who ask only whether a frequency is above 0: of fields that are looked up for
        single words, the words that can't be one of them aren't analyzed, and no length is right."""
        few = {}
        for n, lookup in lookups.items():
            f = self.spec[n]
            if f.type != "tokens" and not f.multi and f.chain.stemmer and all(len(slots) <= 1 for slots in lookup.phrases.values()):
                tokens = f.chain.tokens_like(F.col(n), lookup.terms)
                if tokens is not None:
                    few[n] = F.coalesce(tokens, F.array().cast("array<struct<term:string,pos:int>>"))
        return self.with_frequencies(lookups, True, few)

    def _frequencies_from_postings(self, lookups: dict[str, Lookup], need_match: bool) -> DataFrame:
        wanted = F.lit(False)
        for n, lookup in lookups.items():
            wanted = wanted | ((F.col("field") == n) & F.col("term").isin(*lookup.terms))
        keys = row_keys(self.stored_postings)
        # Single words need their count only: integers keep the aggregate hash-based.
        words_only = all(
            len(slots) <= 1 and all(len(slot) == 1 for slot in slots)
            for lookup in lookups.values() for slots in lookup.phrases.values()
        )
        value = "tf" if words_only else "positions"
        columns = [
            F.max(F.when((F.col("field") == n) & (F.col("term") == t), F.col(value))).alias(f"_p_{n}_{i}")
            for n, lookup in lookups.items() for i, t in enumerate(lookup.terms)
        ]
        weighted = [n for n in lookups if self.spec[n].type == "tokens"]
        columns += [
            F.max(F.when((F.col("field") == n) & (F.col("term") == t), F.col("weight"))).alias(f"_q_{n}_{i}")
            for n in weighted for i, t in enumerate(lookups[n].terms)
        ]
        hits = self.stored_postings.where(wanted).groupBy(*keys).agg(*columns)
        rows = self.docs.join(hits, keys, "inner" if need_match else "left")
        none = F.array().cast("array<int>")
        out = []
        for n, lookup in lookups.items():
            out.append(F.coalesce(f"len__{n}", F.lit(0)).alias(f"_len_{n}"))
            found = [F.coalesce(f"_p_{n}_{i}", F.lit(0) if words_only else none) for i in range(len(lookup.terms))]
            for j, slots in enumerate(lookup.phrases.values()):
                if words_only:
                    tf = found[slots[0][0]] if slots else F.lit(0)
                else:
                    tf = phrase_frequency([[found[i] for i in slot] for slot in slots])
                out.append(tf.alias(f"_tf_{n}_{j}"))
                if n in weighted:
                    of = {t: F.coalesce(f"_q_{n}_{i}", F.lit(1.0)) for i, t in enumerate(lookup.terms)}
                    out.append(lookup.weight(slots, lambda terms: largest([of[t] for t in terms])).alias(f"_w_{n}_{j}"))
        return rows.select(*self.docs.columns, *out)


def combined(indexes: list[SearchIndex]) -> SearchIndex:
    """One index over several ones, stored or not, to be searched together: documents, postings and collection
    numbers are added up.  Fields of one name must be of one kind; a field that an index lacks is missing there."""
    stored = [i.stored_postings is not None for i in indexes]
    if any(stored) and not all(stored):
        raise ValueError("stored indexes can only be searched together with stored ones")
    fields: dict[str, FieldSpec] = {}
    for index in indexes:
        for f in index.spec.fields:
            known = fields.setdefault(f.name, f)
            if (known.spark_type, known.is_text and known.chain) != (f.spark_type, f.is_text and f.chain):
                raise ValueError(f"field {f.name!r} is of different kinds")
    spec = replace(indexes[0].spec, fields=tuple(fields.values()))
    ids = tuple(dict.fromkeys(i for index in indexes for i in index.index_ids or (index.spec.index_id,)))

    def together(frames: list[DataFrame | None]) -> DataFrame | None:
        out = None
        for number, frame in enumerate(frames):
            if frame is None:
                continue
            if "part" in frame.columns:  # stores name their parts alike
                frame = frame.withColumn("part", F.concat(F.lit(f"{number}/"), "part"))
            out = frame if out is None else out.unionByName(frame, allowMissingColumns=True)
        return out

    docs = together([i.docs for i in indexes])
    if not all(stored):
        return SearchIndex(spec, docs, index_ids=ids)
    each = [i.counts for i in indexes]
    postings = together([i.stored_postings for i in indexes])
    counts = StoredCounts(
        together([c.terms for c in each]), together([c.lengths for c in each]), postings, together([c.dead for c in each]),
    ) if all(each) else None
    return SearchIndex(spec, docs, postings, counts, ids)


def _row_frequencies(f: FieldSpec, lookup: Lookup, tokens: Column | None) -> Column:
    """Struct of the field length and the phrase frequencies, from the row's own text."""
    words_only = f.type != "tokens" and f.chain.is_plain and not f.multi and all(
        len(slots) <= 1 for slots in lookup.phrases.values()
    )
    if words_only:
        # single words of a plain chain: no positions needed
        def count(words: Column, selected: Column) -> Column:
            return F.struct(F.size(words).alias("len"), *[
                _count(F.filter(selected, lambda w: w.isin(*[lookup.terms[i] for i in slots[0]])), slots).alias(f"t{j}")
                for j, slots in enumerate(lookup.phrases.values())
            ])

        words = f.chain.kept_words(F.coalesce(F.col(f.name), F.lit("")))
        return let(words, lambda w: let(F.filter(w, lambda x: x.isin(*lookup.terms)), lambda s: count(w, s)))

    def measure(all_tokens: Column, selected: Column) -> Column:
        def positions(slot: list[int]) -> Column:
            terms = [lookup.terms[i] for i in slot]
            return F.transform(F.filter(selected, lambda x: x["term"].isin(*terms)), lambda x: x["pos"])

        return F.struct(F.size(all_tokens).alias("len"), *[
            phrase_frequency([[positions(slot)] if slot else [] for slot in slots]).alias(f"t{j}")
            for j, slots in enumerate(lookup.phrases.values())
        ])

    if tokens is None:
        tokens = _raw_tokens(f)
    return let(
        tokens,
        lambda t: let(F.filter(t, lambda x: x["term"].isin(*lookup.terms)), lambda s: measure(t, s)),
    )


def _count(hits: Column, slots: list) -> Column:
    return F.size(hits) if slots else F.lit(0)


def value_array(docs: DataFrame, name: str) -> Column:
    """The distinct values of a field as an array, empty where it is missing."""
    if is_array(docs, name):
        values = F.array_distinct(F.filter(F.col(name), lambda v: v.isNotNull()))
        return F.coalesce(values, F.array().cast(docs.schema[name].dataType))
    return F.filter(F.array(F.col(name)), lambda v: v.isNotNull())
