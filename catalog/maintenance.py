"""Index building, upserts, deletes, statistics and streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.base import ORDERS, TEXT, documents, orders, parts, query, table, table_changes
from gleaner import Condition, FieldSpec, IndexSpec, IndexStore, build_documents, search, where_all
from gleaner.sources.index import (
    coerce_documents, delete_ids, delete_index, delete_where, distinct_terms, documents_from_text, field_statistics,
    index_statistics, latest,
    remaining_items, spell_dictionary, spell_texts, split_unknown, top_terms, with_external_rank, with_site_url,
)
from gleaner.sources.tables import work_dir
from gleaner.streaming.ingest import upsert_stream

EVENTS = IndexSpec("events", "user_id", (FieldSpec("kind", source="event_type"), FieldSpec("value", "decimal")))


def changes(df):
    """Events as writes to one document per user; an error event deletes it."""
    return df.withColumn("version", F.col("event_id")).withColumn(
        "op", F.when(F.col("event_type") == "error", "D").otherwise("U"))


def event_log(spark, sf):
    return build_documents(changes(table(spark, sf, "events")), EVENTS)


LATEST = """last AS (SELECT user_id, max(event_id) AS version, arg_max(event_type, event_id) AS kind,
  arg_max(value, event_id) AS value FROM events GROUP BY user_id)"""
LIVE = f"WITH {LATEST} SELECT CAST(user_id AS VARCHAR) AS item_id, version, kind, value FROM last WHERE kind <> 'error'"


@query("index_build", """
SELECT 'orders' AS index_id, 'local' AS site, CAST(o_orderkey AS VARCHAR) AS item_id, 'local-orders-' || o_orderkey AS doc_key,
  o_orderstatus AS status, lower(trim(o_orderpriority)) AS sort__priority, o_totalprice AS price, o_custkey AS customer FROM orders""")
def index_build(spark, sf):
    return orders(spark, sf).docs.select(
        "index_id", "site", "item_id", "doc_key", "status", "sort__priority", "price", "customer")


@query("doc_key", "SELECT 'site1-pre_shop_customers-' || c_custkey AS doc_key, 'pre_shop_customers' AS index_id FROM customer")
def doc_key(spark, sf):
    spec = IndexSpec("customers", "c_custkey", (FieldSpec("c_name"),), site="site1", prefix="pre_", index_prefix="shop_")
    return build_documents(table(spark, sf, "customer"), spec).select("doc_key", "index_id")


@query("layout_projection", """
SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_name AS words, string_split(p_name, ' ')[1] AS first__words,
  p_size || ',' || (p_partkey % 50) AS codes, CAST(p_size AS BIGINT) AS first__codes, p_brand AS brand FROM part""")
def layout_projection(spark, sf):
    return parts(spark, sf).docs.select(
        "item_id", F.array_join("words", " ").alias("words"), "first__words",
        F.array_join(F.col("codes").cast("array<string>"), ",").alias("codes"), "first__codes", "brand")


@query("first_value", "SELECT CAST(p_partkey AS VARCHAR) AS item_id, string_split(p_name, ' ')[1] AS first_word FROM part")
def first_value(spark, sf):
    return parts(spark, sf).docs.select("item_id", F.col("first__words").alias("first_word"))


RAW = IndexSpec("raw", "event_id", (
    FieldSpec("flag", "boolean"), FieldSpec("when", "date"), FieldSpec("n", "integer"), FieldSpec("x", "decimal"),
    FieldSpec("kind"),
))


def raw_events(spark, sf, extra: str = ""):
    """Events with text values per field, some of them malformed."""
    return table(spark, sf, "events").selectExpr("event_id", f"""map(
        'flag', array(cast(event_id % 3 as string)),
        'when', array(cast(unix_timestamp(ts) as string), if(event_type = 'error', 'bad', '2024-05-06 07:08:09'), '0'),
        'n', array(cast(user_id as string), concat(user_id, '.9 items'), event_type),
        'x', array(cast(value as string), concat(value, 'e1 EUR')),
        'kind', array(event_type){extra}) AS fields""")


@query("coerce_types", """
SELECT CAST(event_id AS VARCHAR) AS item_id, event_id % 3 <> 0 AS flag, user_id || ',' || user_id || ',0' AS n,
  CAST(user_id AS BIGINT) AS first_n, round(value, 6) AS x1, round(value * 10, 6) AS x2, event_type AS kind FROM events""")
def coerce_types(spark, sf):
    docs = coerce_documents(raw_events(spark, sf), RAW)
    return docs.select(
        "item_id", F.col("first__flag").alias("flag"),
        F.array_join(F.col("n").cast("array<string>"), ",").alias("n"), F.col("first__n").alias("first_n"),
        F.round(F.get("x", F.lit(0)), 6).alias("x1"), F.round(F.get("x", F.lit(1)), 6).alias("x2"),
        F.col("first__kind").alias("kind"))


@query("coerce_bad_date", """
SELECT CAST(event_id AS VARCHAR) AS item_id,
  CASE WHEN event_type = 'error' THEN CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR)
       ELSE CAST(floor(epoch(ts)) AS BIGINT) || ',1714979289,0' END AS dates,
  CASE WHEN event_type = 'error' THEN NULL ELSE CAST(floor(epoch(ts)) AS BIGINT) END AS first_date FROM events""")
def coerce_bad_date(spark, sf):
    docs = coerce_documents(raw_events(spark, sf), RAW)
    epochs = F.transform("when", lambda d: F.unix_timestamp(d).cast("string"))
    return docs.select(
        "item_id", F.array_join(epochs, ",").alias("dates"), F.unix_timestamp("first__when").alias("first_date"))


COERCED = IndexSpec("coerced", "event_id", (
    FieldSpec("n", "int32", multi=True), FieldSpec("x", "float_missing_last"), FieldSpec("when", "date_missing_last"),
    FieldSpec("kind"),
))


@query("coerce_search", """
SELECT CAST(event_id AS VARCHAR) AS item_id, CAST(user_id AS INTEGER) AS n, CAST(row_number() OVER (
  ORDER BY event_type DESC, CAST(event_id AS VARCHAR)) AS INTEGER) AS place
FROM events WHERE user_id > 5 AND event_type <> 'error' AND epoch(ts) >= epoch(TIMESTAMP '2024-01-01')""")
def coerce_search(spark, sf):
    """Raw texts, coerced, stored, filtered by number and date, sorted by text."""
    source = raw_events(spark, sf).withColumns({"version": F.lit(1).cast("bigint"), "op": F.lit("U")})
    store = IndexStore(spark, work_dir(spark, "coerced"), COERCED)
    store.append_documents(documents_from_text(source, COERCED), unique=True)
    where = where_all(Condition("n", 5, ">"), Condition("when", "2024-01-01", ">="))
    hits = search(store.index(), where=where, sorts=(("kind", "desc"),), retrieve_all=True).hits
    order = Window.orderBy(F.lower("kind").desc(), "item_id")
    return hits.select("item_id", F.get("n", F.lit(0)).alias("n"), F.row_number().over(order).alias("place"))


@query("reject_unknown", """
SELECT CAST(event_id AS VARCHAR) AS item_id, event_type <> 'click' AS accepted FROM events""")
def reject_unknown(spark, sf):
    source = raw_events(spark, sf, ", if(event_type = 'click', 'surprise', 'kind2'), array('x')")
    spec = IndexSpec("raw", "event_id", (*RAW.fields, FieldSpec("kind2")))
    accepted, rejected = split_unknown(source, spec)
    return accepted.select(F.col("event_id").cast("string").alias("item_id"), F.lit(True).alias("accepted")).unionByName(
        rejected.select(F.col("event_id").cast("string").alias("item_id"), F.lit(False).alias("accepted")))


@query("copy_fields", """
SELECT CAST(p_partkey AS VARCHAR) AS item_id, trim(lower(p_brand)) AS sort__brand,
  p_name || ' | ' || p_type AS spell FROM part""")
def copy_fields(spark, sf):
    index = parts(spark, sf)
    return index.docs.select("item_id", "sort__brand", F.array_join(spell_texts(index.spec), " | ").alias("spell"))


@query("copy_rules", r"""
SELECT CAST(p_partkey AS VARCHAR) AS item_id, string_split(p_name, ' ')[1] || '|' || p_type || '|' || p_name AS taxonomy_names,
  p_name || '|' || string_split(p_name, ' ')[1] || '|' || p_type AS everything, p_brand AS first_name FROM part""")
def copy_rules(spark, sf):
    """Patterns of source fields, copies of copies, own values first, single targets take the first value."""
    spec = IndexSpec("parts", "p_partkey", (
        FieldSpec("everything", "text_ws", source="array(p_name)", multi=True, copies=("taxonomy_names",)),
        FieldSpec("vid_1_names", "text", source="array(split(p_name, ' ')[0])", multi=True), FieldSpec("vid_2_names", source="p_type"),
        FieldSpec("brand", source="p_brand"), FieldSpec("maker", source="p_type"),
        FieldSpec("first_name", copies=("brand", "maker")),
        FieldSpec("taxonomy_names", "text", multi=True, norms=False, copies=("vid_*", "title")), FieldSpec("title", source="p_name"),
    ))
    docs = build_documents(table(spark, sf, "part"), spec)
    joined = [F.array_join(c, "|").alias(c) for c in ("taxonomy_names", "everything")]
    # the second copy holds the name again, which the twin leaves out
    return docs.select("item_id", joined[0], F.regexp_replace(joined[1], r"\|[^|]*$", "").alias("everything"), "first_name")


# -- writes and deletes ---------------------------------------------------
@query("latest_version", f"WITH {LATEST} SELECT CAST(user_id AS VARCHAR) AS item_id, version, kind, value FROM last")
def latest_version(spark, sf):
    return latest(event_log(spark, sf)).select("item_id", "version", "kind", "value")


@query("delete_ids", """SELECT CAST(o_orderkey AS VARCHAR) AS item_id FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def delete_ids_query(spark, sf):
    gone = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(
        F.concat(F.lit("local-orders-"), "l_orderkey").alias("doc_key"))
    return delete_ids(orders(spark, sf).docs, gone).select("item_id")


@query("delete_where", "SELECT CAST(d.doc_id AS VARCHAR) AS item_id FROM documents d LEFT JOIN labels l USING (doc_id) WHERE NOT coalesce(l.quality = 0, false)")
def delete_where_query(spark, sf):
    return delete_where(documents(spark, sf).docs, F.col("quality") == 0).select("item_id")


@query("delete_index", "SELECT 'orders' AS index_id, count(*) AS docs FROM orders")
def delete_index_query(spark, sf):
    """Two indexes in one table, one dropped, the read-only one kept."""
    from catalog.base import PARTS

    both = orders(spark, sf).docs.select("index_id", "site", "item_id").unionByName(
        parts(spark, sf).docs.select("index_id", "site", "item_id"))
    kept = delete_index(delete_index(both, PARTS), IndexSpec("orders", "o_orderkey", ORDERS.fields, read_only=True))
    return kept.groupBy("index_id").agg(F.count("*").alias("docs"))


@query("compact", LIVE)
def compact(spark, sf):
    """The log is written in three batches, which are then compacted in place; the unused parts go."""
    store = IndexStore(spark, work_dir(spark, "log"), EVENTS)
    log = event_log(spark, sf)
    for k in (2, 0, 1):
        store.append_documents(log.where(F.col("version") % 3 == k))
    store.compact()
    store.remove_unused()
    return store.log().select("item_id", "version", "kind", "value")


def _streamed(spark, sf) -> IndexStore:
    store = IndexStore(spark, work_dir(spark, "stream"), EVENTS)
    upsert_stream(
        table_changes(spark, sf, "events"), store, lambda batch: build_documents(changes(batch), EVENTS), f"{store.path}/checkpoint",
        available_now=True, with_postings=False,
    ).awaitTermination()
    return store


@query("stream_index", LIVE)
def stream_index(spark, sf):
    return _streamed(spark, sf).current().select("item_id", "version", "kind", "value")


@query("stream_delete", f"WITH {LATEST} SELECT CAST(user_id AS VARCHAR) AS item_id, version FROM last WHERE kind = 'error'")
def stream_delete(spark, sf):
    """Documents whose last streamed change was a delete."""
    return latest(_streamed(spark, sf).log()).where("op = 'D'").select("item_id", "version")


# -- statistics -----------------------------------------------------------
@query("index_stats", f"""WITH {LATEST}
SELECT 'events' AS index_id, 'local' AS site, count(*) AS log_rows, count(*) FILTER (event_type = 'error') AS deletes,
  (SELECT count(*) FROM last WHERE kind <> 'error') AS docs FROM events""")
def index_stats(spark, sf):
    return index_statistics(event_log(spark, sf))


@query("field_top_terms", r"""
WITH t AS (SELECT DISTINCT doc_id, unnest(string_split_regex(lower(text), '\s+')) AS term FROM documents),
d AS (SELECT term, count(*) AS df FROM t WHERE term <> '' GROUP BY 1)
SELECT 'text' AS field, term, df, CAST(row_number() OVER (ORDER BY df DESC, term) AS INTEGER) AS rank FROM d
QUALIFY row_number() OVER (ORDER BY df DESC, term) <= 50""")
def field_top_terms(spark, sf):
    return top_terms(distinct_terms(documents(spark, sf, TEXT).docs, TEXT, ["text"]), 50)


@query("field_stats", r"""
WITH t AS (SELECT DISTINCT doc_id, unnest(string_split_regex(lower(text), '\s+')) AS term FROM documents)
SELECT 'text' AS field, count(DISTINCT term) AS terms, count(*) AS postings, count(DISTINCT doc_id) AS docs FROM t WHERE term <> ''""")
def field_stats(spark, sf):
    return field_statistics(distinct_terms(documents(spark, sf, TEXT).docs, TEXT, ["text"]))


SPELL = r"""spell AS (SELECT DISTINCT doc_id, lang, term FROM (
  SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM documents)
  WHERE length(term) BETWEEN 4 AND 20)"""


@query("spell_dictionary", f"WITH {SPELL} SELECT term, count(*) AS df FROM spell GROUP BY term")
def spell_dictionary_query(spark, sf):
    return spell_dictionary(documents(spark, sf, TEXT).docs, TEXT)


@query("spell_dictionary_lang", f"WITH {SPELL} SELECT lang, term, count(*) AS df FROM spell GROUP BY lang, term")
def spell_dictionary_lang(spark, sf):
    return spell_dictionary(documents(spark, sf, TEXT).docs, TEXT, by=("lang",))


# -- side tables ----------------------------------------------------------
@query("external_rank", "SELECT CAST(d.doc_id AS VARCHAR) AS item_id, coalesce(CAST(l.quality AS DOUBLE), 1.0::DOUBLE) AS rank FROM documents d LEFT JOIN labels l USING (doc_id)")
def external_rank(spark, sf):
    ranks = table(spark, sf, "labels").select(
        F.concat(F.lit("local-documents-"), "doc_id").alias("doc_key"), F.col("quality").cast("double").alias("rank"))
    return with_external_rank(documents(spark, sf, TEXT).docs, ranks).select("item_id", "rank")


@query("site_url_join", """
SELECT CAST(doc_id AS VARCHAR) AS item_id, lang, 'https://' || lower(r_name) || '.example/' AS url
FROM documents LEFT JOIN region ON r_regionkey = CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 END""")
def site_url_join(spark, sf):
    lang = F.expr("element_at(map(0, 'en', 1, 'fr', 2, 'de', 3, null, 4, null), r_regionkey)")
    urls = table(spark, sf, "region").select(
        lang.alias("lang"), F.lit("local").alias("site"),
        F.concat(F.lit("https://"), F.lower("r_name"), F.lit(".example/")).alias("url"))
    return with_site_url(documents(spark, sf, TEXT).docs, urls, ["site", "lang"]).select("item_id", "lang", "url")


@query("remaining_items", """
WITH t AS (SELECT user_id, max(event_id) AS version FROM events GROUP BY user_id),
i AS (SELECT user_id, max(event_id) AS version FROM events WHERE event_type <> 'view' GROUP BY user_id)
SELECT CAST(user_id AS VARCHAR) AS item_id, version FROM t WHERE (user_id, version) NOT IN (SELECT (user_id, version) FROM i)""")
def remaining(spark, sf):
    """Users whose newest event is not indexed because views are left out."""
    log = event_log(spark, sf)
    return remaining_items(
        latest(log).select("item_id", "version"), latest(log.where("kind <> 'view'")).select("item_id", "version"))


