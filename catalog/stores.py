"""The same searches on an index written to storage and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import NORMED, POS, SQL, TOK, documents, ids, query, table, table_changes
from catalog.features import SIMILAR
from gleaner.operators.suggest import spell_suggest
from gleaner import Condition as C
from gleaner import Facet, FieldSpec, IndexSpec, IndexStore, SearchIndex, SearchRequest, Similar, build_documents, every, search, some
from gleaner.sources.index import combined, tombstones
from gleaner.sources.tables import work_dir

STORED = IndexSpec("documents", "doc_id", NORMED.fields)


def written(spark, sf) -> IndexStore:
    store = IndexStore(spark, work_dir(spark, "store"), STORED)
    docs = documents(spark, sf, STORED).docs
    store.append(docs.withColumns({"version": F.lit(1).cast("bigint"), "op": F.lit("U")}), unique=True)
    return store


@query("store_score_tfidf", SQL["score_tfidf"])
def store_score_tfidf(spark, sf):
    return search(written(spark, sf).index(), keys="de la", where=C("lang", "fr")).hits


@query("store_score_bm25", SQL["score_bm25"])
def store_score_bm25(spark, sf):
    return search(written(spark, sf).index(), keys=some("de", "la"), scoring="bm25").hits


@query("store_phrase", f"""
WITH {POS}
SELECT DISTINCT CAST(a.doc_id AS VARCHAR) AS item_id FROM pos a JOIN pos b ON a.doc_id = b.doc_id AND b.p = a.p + 1
WHERE a.term = 'in' AND b.term = 'the'""")
def store_phrase(spark, sf):
    return ids(search(written(spark, sf).index(), keys=every("in the"), scoring=None).hits)


@query("store_more_like_this", f"WITH {SIMILAR}")
def store_more_like_this(spark, sf):
    request = SearchRequest(similar=Similar("3", ("text", "source")), where=C("n_chars", 500, ">"))
    return search(written(spark, sf).index(), request).hits


@query("store_facet_fulltext", f"""
WITH {TOK} SELECT 'text' AS facet, '"' || term || '"' AS value, count(DISTINCT doc_id) AS count
FROM tok WHERE lang = 'fr' GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 100""")
def store_facet_fulltext(spark, sf):
    return search(written(spark, sf).index(), facets=(Facet("text", limit=100),), where=C("lang", "fr")).facets


@query("store_facet_terms", f"""
WITH {TOK} SELECT 'text' AS facet, '"' || term || '"' AS value, count(DISTINCT doc_id) AS count
FROM tok WHERE starts_with(term, 'co') GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 50""")
def store_facet_terms(spark, sf):
    """A text facet over the whole index: read off the term counts, not the documents."""
    return search(written(spark, sf).index(), facets=(Facet("text", limit=50, prefix="co"),)).facets


def five_digits(score):
    """Rounded as a double, like the SQL: a sixth digit of 5 goes by the number's binary value, not by its decimal one."""
    return F.floor(score * 1e5 + 0.5) / 1e5


@query("multi_store_search", r"""
WITH t AS (
  SELECT CAST(doc_id AS VARCHAR) AS item_id, 'documents' AS index_id, unnest(string_split_regex(lower(text), '\s+')) AS term FROM documents
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'parts', unnest(string_split_regex(lower(p_name), '\s+')) FROM part),
tf AS (SELECT index_id, item_id, count(*) AS len, count(*) FILTER (term = 'blue') AS tf0, count(*) FILTER (term = 'the') AS tf1 FROM t WHERE term <> '' GROUP BY ALL),
d AS (SELECT count(*) FILTER (tf0 > 0) AS df0, count(*) FILTER (tf1 > 0) AS df1,
  (SELECT count(*) FROM documents) + (SELECT count(*) FROM part) AS n FROM tf)
SELECT index_id, item_id, round(round(
    CASE WHEN tf0 > 0 THEN sqrt(tf0) * pow(1 + ln(n::DOUBLE / (df0 + 1)), 2) / sqrt(len) ELSE 0 END
  + CASE WHEN tf1 > 0 THEN sqrt(tf1) * pow(1 + ln(n::DOUBLE / (df1 + 1)), 2) / sqrt(len) ELSE 0 END, 6), 5) AS score
FROM tf, d WHERE tf0 > 0 OR tf1 > 0""")
def multi_store_search(spark, sf):
    """One search over two stores with different fields: scores from the numbers of both."""
    parts_spec = IndexSpec("parts", "p_partkey", (
        FieldSpec("text", "text_ws", source="p_name", norms=True), FieldSpec("size", "integer", source="p_size")))
    store = IndexStore(spark, work_dir(spark, "store"), parts_spec)
    store.append(build_documents(table(spark, sf, "part"), parts_spec), unique=True)
    both = combined([written(spark, sf).index(), store.index()])
    hits = search(both, keys=some("blue", "the"), retrieve_all=True).hits
    return hits.select("index_id", "item_id", five_digits(F.col("score")).alias("score"))


def updated(spark, sf) -> IndexStore:
    """All documents; then the French ones rewritten and the German ones deleted."""
    store = written(spark, sf)
    rows = table(spark, sf, "documents")
    newer = rows.where("lang = 'fr'").withColumns({
        "text": F.concat("text", F.lit(" rewritten")), "version": F.lit(2).cast("bigint"), "op": F.lit("U")})
    store.append(build_documents(newer, STORED), 1, unique=True)
    gone = documents(spark, sf, STORED).docs.where("lang = 'de'").select("index_id", "site", "item_id", "doc_key")
    schema = build_documents(newer, STORED).schema
    store.append(tombstones(gone, schema, F.lit(3)), 2, unique=True)
    return store


UPDATED = TOK.replace(
    "unnest(string_split_regex(lower(text), '\\s+')) AS term FROM documents",
    "unnest(string_split_regex(lower(CASE WHEN lang = 'fr' THEN text || ' rewritten' ELSE text END), '\\s+')) AS term"
    " FROM documents WHERE lang <> 'de'")
MATCHED = "SELECT DISTINCT CAST(doc_id AS VARCHAR) AS item_id FROM tok WHERE term IN ('rewritten', 'der', 'the')"


@query("store_upsert", f"WITH {UPDATED} {MATCHED}")
def store_upsert(spark, sf):
    return ids(search(updated(spark, sf).index(), keys=some("rewritten", "der", "the"), scoring=None).hits)


@query("store_compact", f"WITH {UPDATED} {MATCHED}")
def store_compact(spark, sf):
    done = updated(spark, sf).compact()
    return ids(search(done.index(), keys=some("rewritten", "der", "the"), scoring=None).hits)




def halves(spark, sf) -> IndexStore:
    """Odd and even documents in two appends, neither of them numbered."""
    store = IndexStore(spark, work_dir(spark, "store"), STORED)
    docs = documents(spark, sf, STORED).docs.withColumns({"version": F.lit(1).cast("bigint"), "op": F.lit("U")})
    for k in (0, 1):
        store.append(docs.where(F.col("item_id").cast("long") % 2 == k), unique=True)
    return store


ALL_MATCHED = f"WITH {TOK} SELECT DISTINCT CAST(doc_id AS VARCHAR) AS item_id FROM tok WHERE term IN ('der', 'the')"


@query("store_two_appends", ALL_MATCHED)
def store_two_appends(spark, sf):
    return ids(search(halves(spark, sf).index(), keys=some("der", "the"), scoring=None).hits)


@query("store_score_parts", SQL["score_tfidf"])
def store_score_parts(spark, sf):
    """Scores of a store in two parts."""
    return search(halves(spark, sf).index(), keys="de la", where=C("lang", "fr")).hits


REWRITTEN = TOK.replace(
    "unnest(string_split_regex(lower(text), '\\s+')) AS term FROM documents",
    "unnest(string_split_regex(lower(CASE WHEN lang = 'fr' THEN text || ' rewritten' ELSE text END), '\\s+')) AS term"
    " FROM documents")


@query("store_same_version", f"""WITH {REWRITTEN}, m AS (SELECT DISTINCT doc_id, lang FROM tok WHERE term IN ('rewritten', 'the'))
SELECT lang AS value, count(*) AS count FROM m GROUP BY lang""")
def store_same_version(spark, sf):
    """A version sent again with other texts: the later one counts, and counts once."""
    store = halves(spark, sf)
    newer = table(spark, sf, "documents").where("lang = 'fr'").withColumns({
        "text": F.concat("text", F.lit(" rewritten")), "version": F.lit(1).cast("bigint"), "op": F.lit("U")})
    store.append(build_documents(newer, STORED), unique=True)
    found = search(store.index(), keys=some("rewritten", "the"), scoring=None, facets=(Facet("lang", limit=0),))
    return found.facets.select(F.regexp_replace("value", '"', "").alias("value"), "count")


@query("store_rerun_batch", """
SELECT lang, count(*) AS docs, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents WHERE doc_id % 3 <> 0 OR doc_id % 2 = 0 GROUP BY lang""")
def store_rerun_batch(spark, sf):
    """A batch beats an older version of another writer, then comes again without those documents."""
    store = IndexStore(spark, work_dir(spark, "store"), STORED)
    docs = documents(spark, sf, STORED).docs.withColumn("op", F.lit("U"))
    number = F.col("item_id").cast("long")
    newer, older = docs.withColumn("version", F.lit(5).cast("bigint")), docs.withColumn("version", F.lit(3).cast("bigint"))
    store.append(newer.withColumn("n_chars", F.lit(0).cast("bigint")), 0, unique=True, writer="b")
    store.append(older.where(number % 2 == 0), 0, unique=True, writer="c")
    store.append(newer.where((number % 2 == 1) & (number % 3 != 0)), 0, unique=True, writer="b")
    return store.current().groupBy("lang").agg(F.count("*").alias("docs"), F.sum("n_chars").alias("chars"))


@query("store_statistics", """
SELECT 'documents' AS index_id, 'local' AS site, count(*) + count(*) FILTER (lang = 'de') + count(*) FILTER (lang = 'fr' AND doc_id % 2 = 0) AS log_rows,
  count(*) FILTER (lang = 'de') + count(*) FILTER (lang = 'fr' AND doc_id % 2 = 0) AS deletes,
  count(*) FILTER (lang = 'fr' AND doc_id % 2 = 0) AS deletes_by_id, count(*) FILTER (lang = 'de') AS deletes_by_condition,
  count(*) FILTER (NOT coalesce(lang = 'de' OR lang = 'fr' AND doc_id % 2 = 0, false)) AS docs,
  count(*) FILTER (coalesce(lang = 'de' OR lang = 'fr' AND doc_id % 2 = 0, false)) AS pending
FROM documents""")
def store_statistics(spark, sf):
    """Writes, deletes by kind and what a tracker still has to index, from the parts' summaries."""
    store = written(spark, sf)
    store.delete_where(F.col("lang") == "de")
    store.delete(store.current().where("lang = 'fr' AND cast(item_id AS long) % 2 = 0").select("doc_key"))
    tracked = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("item_id"), F.lit(1).cast("long").alias("version"))
    return store.statistics(tracked).drop("parts", "bytes")


WEIGHTED = IndexSpec("parts", "p_partkey", (
    FieldSpec("words", "tokens", source="transform(split(p_name, ' '), (w, i) -> named_struct('value', w, 'score', double(1 + p_size % 7 + i)))"),
))
WEIGHTED_SQL = r"""
WITH t AS (SELECT p_partkey, lower(w[i]) AS term, 1 + p_size % 7 + i - 1 AS weight, i, len(w) AS n
  FROM (SELECT p_partkey, p_size, string_split(p_name, ' ') AS w FROM part), unnest(range(1, len(w) + 1)) AS r(i)),
p AS (SELECT p_partkey, term, count(*) AS tf, arg_max(weight, i) AS weight FROM t GROUP BY ALL),
d AS (SELECT count(*) AS df, (SELECT count(*) FROM part) AS n FROM p WHERE term = (SELECT term FROM p GROUP BY term ORDER BY count(*) DESC, term LIMIT 1))
SELECT CAST(p_partkey AS VARCHAR) AS item_id, round(round(sqrt(tf) * pow(1 + ln(n::DOUBLE / (df + 1)), 2) * weight, 6), 5) AS score
FROM p, d WHERE term = (SELECT term FROM p GROUP BY term ORDER BY count(*) DESC, term LIMIT 1)"""


def weighted(index, spark, sf):
    words = table(spark, sf, "part").select(F.explode(F.split("p_name", " ")).alias("w"), "p_partkey").distinct()
    word = words.groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").first()["w"]
    return search(index, keys=word).hits.withColumn("score", F.round("score", 5))


@query("score_weighted_tokens", WEIGHTED_SQL)
def score_weighted_tokens(spark, sf):
    """Pre-tokenized text: a word's score goes with the weight of its last token."""
    return weighted(SearchIndex.build(table(spark, sf, "part"), WEIGHTED), spark, sf)


@query("store_weighted_tokens", WEIGHTED_SQL)
def store_weighted_tokens(spark, sf):
    """The same from weights in stored postings."""
    store = IndexStore(spark, work_dir(spark, "weighted"), WEIGHTED)
    store.append(build_documents(table(spark, sf, "part"), WEIGHTED), unique=True)
    return weighted(store.index(), spark, sf)


@query("store_bulk_then_stream", f"""WITH {TOK}, m AS (SELECT DISTINCT doc_id FROM tok WHERE term IN ('der', 'the'))
SELECT CAST(doc_id AS VARCHAR) AS item_id FROM m""")
def store_bulk_then_stream(spark, sf):
    """Even documents loaded in bulk, then all of them from a stream."""
    from gleaner.streaming.ingest import upsert_stream

    store = IndexStore(spark, work_dir(spark, "store"), STORED)
    docs = documents(spark, sf, STORED).docs.withColumns({"version": F.lit(1).cast("bigint"), "op": F.lit("U")})
    store.append(docs.where(F.col("item_id").cast("long") % 2 == 0), unique=True)
    upsert_stream(
        table_changes(spark, sf, "documents"), store,
        lambda rows: build_documents(rows.withColumns({"version": F.lit(2).cast("bigint"), "op": F.lit("U")}), STORED),
        f"{store.path}/checkpoint", available_now=True,
    ).awaitTermination()
    return ids(search(store.index(), keys=some("der", "the"), scoring=None).hits)


@query("store_delete_ids", "SELECT CAST(doc_id AS VARCHAR) AS item_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def store_delete_ids(spark, sf):
    store = halves(spark, sf)
    gone = table(spark, sf, "labels").where("toxic = 1").select(
        F.concat(F.lit("local-documents-"), "doc_id").alias("doc_key"))
    store.delete(gone)
    return store.current().select("item_id")


@query("store_delete_where", "SELECT CAST(doc_id AS VARCHAR) AS item_id FROM documents WHERE NOT coalesce(n_chars > 1000, false)")
def store_delete_where(spark, sf):
    store = halves(spark, sf)
    store.delete_where(F.col("n_chars") > 1000)
    return store.current().select("item_id")


@query("store_clear", "SELECT lang, count(*) AS docs FROM documents WHERE lang = 'es' GROUP BY lang")
def store_clear(spark, sf):
    """Everything deleted, then the Spanish documents loaded again."""
    store = halves(spark, sf)
    store.clear()
    docs = documents(spark, sf, STORED).docs.where("lang = 'es'")
    store.append(docs.withColumns({"version": F.lit(1).cast("bigint"), "op": F.lit("U")}), unique=True)
    return store.current().groupBy("lang").agg(F.count("*").alias("docs"))


@query("store_spell_suggest", SQL["spell_suggest"])
def store_spell_suggest(spark, sf):
    """Corrections from the dictionary that the store keeps."""
    store = written(spark, sf)
    store.rebuild_dictionary()
    return spell_suggest(store.dictionary(), "whith tihs (quee) froom that")
