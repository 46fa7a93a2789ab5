"""Facets, counts and groups."""

from __future__ import annotations

from catalog.base import PLACE, TEXT, TOK, documents, km, orders, parts, places, query
from gleaner import Condition as C
from gleaner import Facet, Grouping, SearchRequest, Spatial, search, where_all, where_any


def _facet(name, index, sql, *facets, output="facets", **options):
    @query(name, sql)
    def run(spark, sf):
        return getattr(search(index(spark, sf), SearchRequest(facets=facets, **options)), output)


def texts(spark, sf):
    return documents(spark, sf, TEXT)


def q(column: str) -> str:
    return f"'\"' || {column} || '\"'"


_facet("facet_terms", orders,
       f"SELECT 'status' AS facet, {q('o_orderstatus')} AS value, count(*) AS count FROM orders"
       " WHERE o_totalprice > 250000 GROUP BY 2",
       Facet("status"), where=C("price", 250000, ">"))
_facet("facet_limit", parts,
       f"SELECT 'brand' AS facet, {q('p_brand')} AS value, count(*) AS count FROM part GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 7",
       Facet("brand", limit=7))
_facet("facet_min_count", parts,
       f"SELECT 'brand' AS facet, {q('p_brand')} AS value, count(*) AS count FROM part WHERE p_size < 25 GROUP BY 2 HAVING count(*) >= 40",
       Facet("brand", limit=0, min_count=40), where=C("size", 25, "<"))
_facet("facet_min_count_zero", parts,
       f"SELECT 'brand' AS facet, {q('p_brand')} AS value,"
       " count(*) FILTER (p_type = 'SMALL' AND p_size = 7) AS count FROM part GROUP BY 2",
       Facet("brand", limit=0, min_count=0), where=where_all(C("kind", "SMALL"), C("size", 7)))
_facet("facet_missing", documents,
       f"SELECT 'quality' AS facet, coalesce({q('quality')}, '!') AS value, count(*) AS count"
       " FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 2",
       Facet("quality", limit=2, missing=True))
_facet("facet_or_exclude", parts,
       f"""SELECT 'kind' AS facet, {q('p_type')} AS value, count(*) AS count FROM part WHERE p_size < 20 GROUP BY 2
UNION ALL SELECT 'brand', {q('p_brand')}, count(*) FROM part WHERE p_size < 20 AND p_type IN ('SMALL', 'PROMO') GROUP BY 2""",
       Facet("kind", limit=0, operator="or"), Facet("brand", limit=0),
       where=where_all(C("size", 20, "<"), where_any(C("kind", "SMALL"), C("kind", "PROMO"), tags=("facet:kind",))))
_facet("facet_multi", orders,
       f"""WITH o AS (SELECT * FROM orders WHERE o_totalprice > 100000)
SELECT 'status' AS facet, {q('o_orderstatus')} AS value, count(*) AS count FROM o GROUP BY 2
UNION ALL SELECT 'priority', {q('o_orderpriority')}, count(*) FROM o GROUP BY 2
UNION ALL (SELECT 'customer', {q('o_custkey')}, count(*) FROM o GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 25)""",
       Facet("status"), Facet("priority"), Facet("customer", limit=25), where=C("price", 100000, ">"))
_facet("facet_multivalue", parts,
       f"SELECT 'words' AS facet, {q('w')} AS value, count(DISTINCT p_partkey) AS count"
       " FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part) GROUP BY 2",
       Facet("words", limit=0))
_facet("facet_fulltext", texts,
       f"WITH {TOK} SELECT 'text' AS facet, {q('term')} AS value, count(DISTINCT doc_id) AS count"
       " FROM tok WHERE lang = 'fr' GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 100",
       Facet("text", limit=100), where=C("lang", "fr"))
_facet("facet_labels", documents,
       """SELECT 'toxic' AS facet, CASE WHEN toxic IS NULL THEN '!' WHEN toxic = 1 THEN '"1"' ELSE '"0"' END AS value, count(*) AS count
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 2""",
       Facet("toxic", limit=0, missing=True))
_facet("facet_date_labels", orders,
       f"SELECT 'ordered' AS facet, {q('CAST(floor(epoch(o_orderdate)) AS BIGINT)')} AS value, count(*) AS count"
       " FROM orders GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 30",
       Facet("ordered", limit=30))
_facet("facet_prefix", texts,
       f"WITH {TOK} SELECT 'text' AS facet, {q('term')} AS value, count(DISTINCT doc_id) AS count"
       " FROM tok WHERE starts_with(term, 'th') GROUP BY 2",
       Facet("text", limit=0, prefix="th"))

_DIST = km(-40.0, -150.0)
_facet("facet_distance", places,
       f"WITH {PLACE}, d AS (SELECT {_DIST} AS dist FROM place) SELECT * FROM ("
       + " UNION ALL ".join(
           f"SELECT 'place' AS facet, '[* {r}]' AS value, count(*) FILTER (dist <= {r} AND dist <= 6000) AS count FROM d"
           for r in (4800, 3600, 2400, 1200)) + ") WHERE count >= 1",
       Facet("place", limit=5), spatial=(Spatial("place", -40.0, -150.0, radius=6000.0),))

_facet("total_count", parts,
       "SELECT count(*) AS total FROM part WHERE p_type = 'SMALL' OR p_size < 10",
       where=where_any(C("kind", "SMALL"), C("size", 10, "<")), output="total")
_facet("group_count", parts,
       "SELECT 'brand' AS group_field, count(DISTINCT p_brand) AS groups FROM part WHERE p_size < 10",
       where=C("size", 10, "<"), grouping=Grouping(("brand",)), output="group_total")


def ranked(field: str, order: str, n: int, where: str = "true") -> str:
    return (
        f"SELECT * FROM (SELECT '{field}' AS group_field, {GROUP_COLUMNS[field]} AS group_value,"
        f" CAST(row_number() OVER (PARTITION BY {GROUP_COLUMNS[field]} ORDER BY {order}, CAST(p_partkey AS VARCHAR)) AS INTEGER) AS rank,"
        f" CAST(p_partkey AS VARCHAR) AS item_id, 1.0::DOUBLE AS score FROM part WHERE {where}) WHERE rank <= {n}"
    )


GROUP_COLUMNS = {"brand": "p_brand", "kind": "p_type"}
_facet("group_collapse", parts, ranked("brand", "1", 1).replace("1, CAST", "CAST"),
       grouping=Grouping(("brand",)), output="groups")
_facet("group_limit", parts, ranked("brand", "1", 4, "p_size < 30").replace("1, CAST", "CAST"),
       grouping=Grouping(("brand",), limit=4), where=C("size", 30, "<"), output="groups")
_facet("group_sort", parts, ranked("brand", "p_retailprice DESC NULLS LAST, p_size ASC NULLS FIRST", 3),
       grouping=Grouping(("brand",), limit=3, sort=(("price", "desc"), ("size", "asc"))), output="groups")
_facet("group_two_fields", parts,
       ranked("brand", "p_size DESC NULLS LAST", 2) + " UNION ALL " + ranked("kind", "p_size DESC NULLS LAST", 2),
       grouping=Grouping(("brand", "kind"), limit=2, sort=(("size", "desc"),)), output="groups")
_facet("group_truncate_facet", parts,
       f"""WITH heads AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_brand
  ORDER BY p_size DESC NULLS LAST, CAST(p_partkey AS VARCHAR)) AS rn FROM part) WHERE rn = 1)
SELECT 'kind' AS facet, {q('p_type')} AS value, count(*) AS count FROM heads GROUP BY 2""",
       Facet("kind"), grouping=Grouping(("brand",), sort=(("size", "desc"),), truncate=True))
_facet("group_facet", parts,
       f"SELECT 'kind' AS facet, {q('p_type')} AS value, count(DISTINCT p_brand) AS count FROM part WHERE p_size < 5 GROUP BY 2",
       Facet("kind"), where=C("size", 5, "<"), grouping=Grouping(("brand",), facet=True))
