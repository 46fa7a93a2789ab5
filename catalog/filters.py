"""Filters, projections, sorts, paging and index scope."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    POS, TEXT, documents, ids, orders, parts, query, table,
)
from gleaner import Condition as C
from gleaner import Facet, FieldSpec, IndexSpec, SearchIndex, SearchRequest, between, one_of, search, where_all, where_any
from gleaner.functions.dates import date_math, to_epoch
from gleaner.operators.filters import granted_by_table

PART_ID = "SELECT CAST(p_partkey AS VARCHAR) AS item_id FROM part WHERE "
DOC_LABELS = "SELECT CAST(d.doc_id AS VARCHAR) AS item_id FROM documents d LEFT JOIN labels l USING (doc_id) WHERE "
ORDER_ID = "SELECT CAST(o_orderkey AS VARCHAR) AS item_id FROM orders WHERE "
WORD = "list_contains(string_split(p_name, ' '), '{}')"


def _filter(name, index, where, sql):
    @query(name, sql)
    def run(spark, sf):
        return ids(search(index(spark, sf), where=where).hits)


_filter("filter_eq", parts, where_all(C("brand", "Brand#2"), C("words", "red")),
        PART_ID + "p_brand = 'Brand#2' AND " + WORD.format("red"))
_filter("filter_ne", documents, C("quality", 1, "<>"), DOC_LABELS + "l.quality IS NULL OR l.quality <> 1")
_filter("filter_ne_multi", parts, C("words", "red", "<>"), PART_ID + "NOT " + WORD.format("red"))
for _op, _name in (("<", "lt"), ("<=", "le"), (">=", "ge"), (">", "gt")):
    _filter(
        f"filter_{_name}", parts, where_all(C("price", 950.5, _op), C("codes", 25, _op)),
        PART_ID + f"p_retailprice {_op} 950.5 AND (p_size {_op} 25 OR p_partkey % 50 {_op} 25)",
    )
_filter("filter_is_null", documents, C("quality", None), DOC_LABELS + "l.quality IS NULL")
_filter("filter_not_null", documents, C("quality", None, "<>"), DOC_LABELS + "l.quality IS NOT NULL")
_filter("filter_bool", documents, C("toxic", "1"), DOC_LABELS + "l.toxic = 1")
_filter("filter_date", orders, where_all(C("ordered", "1998-01-01", ">="), C("ordered", 915148800, "<")),
        ORDER_ID + "o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'")
_filter("filter_and", parts, where_all(C("kind", "SMALL"), C("size", 10, "<"), C("words", "red")),
        PART_ID + "p_type = 'SMALL' AND p_size < 10 AND " + WORD.format("red"))
_filter("filter_or", parts, where_any(C("kind", "SMALL"), C("words", "red")),
        PART_ID + "p_type = 'SMALL' OR " + WORD.format("red"))
_filter(
    "filter_nested", parts,
    where_any(
        where_all(C("words", "red"), C("kind", "SMALL")),
        where_all(C("words", "hot"), where_any(C("size", 5, "<"), C("brand", "Brand#2", "<>"))),
    ),
    PART_ID + f"({WORD.format('red')} AND p_type = 'SMALL') OR ({WORD.format('hot')} AND (p_size < 5 OR p_brand <> 'Brand#2'))",
)
_filter("filter_one_of", parts, one_of("kind", ["SMALL", "PROMO"]), PART_ID + "p_type IN ('SMALL', 'PROMO')")
_filter("filter_between", parts, between("size", 10, 20), PART_ID + "p_size BETWEEN 10 AND 20")
_filter("filter_string_range", orders, where_all(C("priority", "2", ">="), C("priority", "4-NOT SPECIFIED", "<")),
        ORDER_ID + "o_orderpriority >= '2' AND o_orderpriority < '4-NOT SPECIFIED'")


@query("filter_text_phrase", f"""
WITH {POS}
SELECT DISTINCT CAST(a.doc_id AS VARCHAR) AS item_id FROM pos a JOIN pos b ON a.doc_id = b.doc_id AND b.p = a.p + 1
WHERE a.term = 'de' AND b.term = 'la'""")
def filter_text_phrase(spark, sf):
    return ids(search(documents(spark, sf, TEXT), where=C("text", "De la")).hits)


# -- scope ----------------------------------------------------------------
PARTY = IndexSpec("suppliers", "key", (FieldSpec("name"), FieldSpec("balance", "decimal"), FieldSpec("nation", "integer")))


def _parties(spark, sf) -> SearchIndex:
    """Two indexes in one table, one site per nation."""
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("nation"), F.col("n_name").alias("site_name"))
    supplier = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"),
        F.col("s_nationkey").alias("nation"))
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
        F.col("c_nationkey").alias("nation"))
    home = IndexSpec("suppliers", "key", PARTY.fields, site="NATION_1")
    other = IndexSpec("customers", "key", PARTY.fields, site="NATION_1")
    from gleaner import build_documents

    docs = build_documents(supplier.join(nation, "nation"), home, site="site_name").unionByName(
        build_documents(customer.join(nation, "nation"), other, site="site_name"))
    return SearchIndex(home, docs)


BOTH = """both_kinds AS (
  SELECT 'suppliers' AS index_id, s_suppkey AS k, s_acctbal AS balance, n_name AS site FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL
  SELECT 'customers', c_custkey, c_acctbal, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


@query("scope_index", f"WITH {BOTH} SELECT CAST(k AS VARCHAR) AS item_id, site FROM both_kinds WHERE index_id = 'suppliers'")
def scope_index(spark, sf):
    return search(_parties(spark, sf), all_sites=True, retrieve_all=True).matched.select("item_id", "site")


@query("scope_site", f"WITH {BOTH} SELECT CAST(k AS VARCHAR) AS item_id FROM both_kinds WHERE index_id = 'suppliers' AND site = 'NATION_1'")
def scope_site(spark, sf):
    return ids(search(_parties(spark, sf)).hits)


@query("multi_index", f"""WITH {BOTH} SELECT CAST(k AS VARCHAR) AS item_id, index_id, balance FROM both_kinds
WHERE site = 'NATION_1' AND balance > 5000""")
def multi_index(spark, sf):
    result = search(_parties(spark, sf), where=C("balance", 5000, ">"), index_ids=("suppliers", "customers"))
    return result.matched.select("item_id", "index_id", "balance")


@query("foreign_item_id", f"""WITH {BOTH}
SELECT CASE WHEN site <> 'NATION_1' THEN site || '--' || k ELSE CAST(k AS VARCHAR) END AS item_id, site, 1.0::DOUBLE AS score
FROM both_kinds WHERE index_id = 'suppliers'""")
def foreign_item_id(spark, sf):
    return search(_parties(spark, sf), all_sites=True).hits


@query("access_semi_join", """
SELECT CAST(c_custkey AS VARCHAR) AS item_id FROM customer
WHERE c_nationkey IN (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')
   OR c_custkey % 7 + 100 IN (SELECT n_nationkey + 100 FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')""")
def access_semi_join(spark, sf):
    spec = IndexSpec("customers", "c_custkey", (
        FieldSpec("access", "access", source="array(c_nationkey, cast(c_custkey % 7 + 100 as int))", multi=True),))
    docs = SearchIndex.build(table(spark, sf, "customer"), spec).docs
    asia = table(spark, sf, "nation").join(
        table(spark, sf, "region").where("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    grants = asia.select(F.explode(F.array(F.col("n_nationkey"), F.col("n_nationkey") + 100)).alias("grant"))
    return ids(granted_by_table(docs, grants))


# -- projections ----------------------------------------------------------
@query("project_default", "SELECT CAST(o_orderkey AS VARCHAR) AS item_id, 1.0::DOUBLE AS score FROM orders")
def project_default(spark, sf):
    return search(orders(spark, sf)).hits


@query("project_all", """
SELECT CAST(o_orderkey AS VARCHAR) AS item_id, 'orders' AS index_id, 'local' AS site, 'local-orders-' || o_orderkey AS doc_key,
  o_orderstatus AS status, o_orderpriority AS priority, CAST(floor(epoch(o_orderdate)) AS BIGINT) AS ordered,
  o_totalprice AS price, o_custkey AS customer, 1.0::DOUBLE AS score FROM orders""")
def project_all(spark, sf):
    return search(orders(spark, sf), retrieve_all=True).hits.withColumn("ordered", to_epoch(F.col("ordered")))


@query("date_to_epoch", "SELECT CAST(event_id AS VARCHAR) AS item_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch FROM events")
def date_to_epoch(spark, sf):
    spec = IndexSpec("events", "event_id", (FieldSpec("ts", "date"),))
    return SearchIndex.build(table(spark, sf, "events"), spec).docs.select("item_id", to_epoch(F.col("ts")).alias("epoch"))


@query("date_math", """
SELECT CAST(event_id AS VARCHAR) AS item_id,
  CAST(floor(epoch(date_trunc('day', ts) + INTERVAL 6 MONTH + INTERVAL 3 DAY)) AS BIGINT) AS later,
  CAST(floor(epoch(date_trunc('hour', ts - INTERVAL 1 DAY))) AS BIGINT) AS earlier FROM events""")
def date_math_query(spark, sf):
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("item_id"),
        F.unix_timestamp(date_math(ts, "NOW/DAY+6MONTHS+3DAYS")).alias("later"),
        F.unix_timestamp(date_math(ts, "-1DAY/HOUR")).alias("earlier"),
    )


# -- sorts and pages ------------------------------------------------------
def _sorted(name, index, request, sql):
    @query(name, sql)
    def run(spark, sf):
        return ids(search(index(spark, sf), request).hits)


_sorted(
    "sort_multi", parts, SearchRequest(sorts=(("kind", "asc"), ("size", "desc")), limit=500),
    "SELECT CAST(p_partkey AS VARCHAR) AS item_id FROM part"
    " ORDER BY lower(p_type) ASC NULLS LAST, p_size DESC NULLS LAST, CAST(p_partkey AS VARCHAR) LIMIT 500",
)
_sorted(
    "sort_string_ci", parts, SearchRequest(sorts=(("words", "desc"),), limit=300),
    "SELECT CAST(p_partkey AS VARCHAR) AS item_id FROM part"
    " ORDER BY trim(lower(string_split(p_name, ' ')[1])) DESC NULLS LAST, CAST(p_partkey AS VARCHAR) LIMIT 300",
)
_sorted(
    "sort_missing_numeric", documents, SearchRequest(sorts=(("quality", "asc"), ("n_chars", "desc")), limit=200),
    "SELECT CAST(d.doc_id AS VARCHAR) AS item_id FROM documents d LEFT JOIN labels l USING (doc_id)"
    " ORDER BY quality ASC NULLS FIRST, n_chars DESC NULLS LAST, CAST(d.doc_id AS VARCHAR) LIMIT 200",
)
_sorted(
    "sort_boolean_missing_last", documents, SearchRequest(sorts=(("toxic", "asc"),), limit=380),
    "SELECT CAST(d.doc_id AS VARCHAR) AS item_id FROM documents d LEFT JOIN labels l USING (doc_id)"
    " ORDER BY toxic ASC NULLS LAST, CAST(d.doc_id AS VARCHAR) LIMIT 380",
)
_sorted(
    "sort_random", orders, SearchRequest(sorts=(("_random", "asc"),), seed=42, limit=1000),
    "SELECT CAST(o_orderkey AS VARCHAR) AS item_id FROM orders ORDER BY md5(o_orderkey || '42'), item_id LIMIT 1000",
)
_sorted(
    "page", orders, SearchRequest(sorts=(("price", "desc"),), offset=100, limit=50),
    "SELECT CAST(o_orderkey AS VARCHAR) AS item_id FROM orders"
    " ORDER BY o_totalprice DESC NULLS LAST, CAST(o_orderkey AS VARCHAR) LIMIT 50 OFFSET 100",
)
_sorted(
    "top_k", orders, SearchRequest(where=C("status", "F"), sorts=(("ordered", "asc"), ("price", "desc")), limit=20),
    "SELECT CAST(o_orderkey AS VARCHAR) AS item_id FROM orders WHERE o_orderstatus = 'F'"
    " ORDER BY o_orderdate ASC NULLS FIRST, o_totalprice DESC NULLS LAST, CAST(o_orderkey AS VARCHAR) LIMIT 20",
)


@query("access_search", """
SELECT 'segment' AS facet, '"' || c_mktsegment || '"' AS value, count(*) AS count FROM customer
WHERE (c_nationkey IN (3, 7) OR c_custkey % 7 + 100 IN (3, 7, 101)) AND c_acctbal > 0 GROUP BY c_mktsegment""")
def access_search(spark, sf):
    """Facets of a request with the grants of a user."""
    spec = IndexSpec("customers", "c_custkey", (
        FieldSpec("access", "access", source="array(c_nationkey, cast(c_custkey % 7 + 100 as int))", multi=True),
        FieldSpec("segment", source="c_mktsegment"), FieldSpec("balance", "decimal", source="c_acctbal"),
    ))
    index = SearchIndex.build(table(spark, sf, "customer"), spec)
    return search(index, where=C("balance", 0, ">"), grants=(3, 7, 101), facets=(Facet("segment", limit=0),)).facets
