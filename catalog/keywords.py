"""Keyword matching, scores and elevation."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import NORMED, POS, TEXT, TOK, doc_flags, documents, ids, parts, query, table
from gleaner import Condition as C
from gleaner import every, none, not_every, search, some, where_all


def _keys(name, keys, sql, **options):
    @query(name, sql)
    def run(spark, sf):
        return ids(search(documents(spark, sf, TEXT), keys=keys, scoring=None, **options).hits)


_keys("match_all", None, "SELECT CAST(doc_id AS VARCHAR) AS item_id FROM documents")
_keys("kw_and", "de la", doc_flags("de", "la", having="k0 AND k1"))
_keys("kw_or", some("der", "la"), doc_flags("der", "la", having="k0 OR k1"))
_keys("kw_nested", some("für", every("de", some("la", "le"))),
      doc_flags("für", "de", "la", "le", having="k0 OR (k1 AND (k2 OR k3))"))
_keys("kw_not_and", not_every("the", "and"),
      doc_flags("the", "and", having="NOT (coalesce(k0, false) AND coalesce(k1, false))"))
_keys("kw_not_or", none("the", "de"),
      doc_flags("the", "de", having="NOT coalesce(k0, false) AND NOT coalesce(k1, false)"))
_keys("kw_and_not", every("the", not_every("of", "to")),
      doc_flags("the", "of", "to", having="k0 AND NOT (k1 AND k2)"))
_keys("kw_unicode", "éeau", doc_flags("éeau", having="k0"))
_keys("kw_filtered", "de la",
      doc_flags("de", "la", having="k0 AND k1", extra=" AND d.lang = 'fr' AND d.n_chars < 2000"),
      where=where_all(C("lang", "fr"), C("n_chars", 2000, "<")))


@query("kw_phrase", f"""
WITH {POS}, hit AS (
  SELECT DISTINCT a.doc_id, a.p FROM pos a JOIN pos b ON a.doc_id = b.doc_id AND b.p = a.p + 1
  WHERE a.term = 'in' AND b.term = 'the')
SELECT DISTINCT CAST(doc_id AS VARCHAR) AS item_id FROM hit
UNION
SELECT DISTINCT CAST(a.doc_id AS VARCHAR) FROM pos a JOIN pos b ON a.doc_id = b.doc_id AND b.p = a.p + 1
  JOIN pos c ON a.doc_id = c.doc_id AND c.p = a.p + 2
WHERE a.term = 'de' AND b.term = 'la' AND c.term = 'et'""")
def kw_phrase(spark, sf):
    return ids(search(documents(spark, sf, TEXT), keys=some("in the", "de la et"), scoring=None).hits)


PART_WORDS = """w AS (
  SELECT p_partkey, 'name' AS field, unnest(string_split(lower(p_name), ' ')) AS term FROM part
  UNION ALL SELECT p_partkey, 'kind_text', lower(p_type) FROM part)"""


@query("kw_multi_field", f"""
WITH {PART_WORDS}, f AS (SELECT p_partkey, bool_or(term = 'small') AS a, bool_or(term = 'red') AS b FROM w GROUP BY 1)
SELECT CAST(p_partkey AS VARCHAR) AS item_id FROM f WHERE a AND b""")
def kw_multi_field(spark, sf):
    return ids(search(parts(spark, sf), keys="small red", scoring=None).hits)


@query("kw_single_field", f"""
WITH {PART_WORDS}, f AS (SELECT p_partkey, bool_or(term = 'small') AS a FROM w WHERE field = 'kind_text' GROUP BY 1)
SELECT CAST(p_partkey AS VARCHAR) AS item_id FROM f WHERE a""")
def kw_single_field(spark, sf):
    return ids(search(parts(spark, sf), keys="small", fields=("kind_text",), scoring=None).hits)


# -- scores ---------------------------------------------------------------
SCORED = f"""{TOK},
len AS (SELECT doc_id, count(*) AS len FROM tok GROUP BY 1),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok WHERE term IN ('de', 'la') GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
n AS (SELECT count(*) AS n, (SELECT avg(len) FROM len) AS avg_len FROM documents)"""
IDF = "pow(1 + ln(CAST(n AS DOUBLE) / (df + 1)), 2)"


@query("score_tfidf", f"""
WITH {SCORED}
SELECT CAST(doc_id AS VARCHAR) AS item_id, round(sum(sqrt(CAST(tf AS DOUBLE)) * {IDF} / sqrt(CAST(len AS DOUBLE))), 6) AS score
FROM tf JOIN df USING (term) JOIN len USING (doc_id) JOIN documents d USING (doc_id) CROSS JOIN n
WHERE d.lang = 'fr' GROUP BY doc_id HAVING count(*) = 2""")
def score_tfidf(spark, sf):
    return search(documents(spark, sf, NORMED), keys="de la", where=C("lang", "fr")).hits


@query("score_bm25", f"""
WITH {SCORED}
SELECT CAST(doc_id AS VARCHAR) AS item_id, round(sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * (1.2::DOUBLE + 1)
  / (tf + 1.2::DOUBLE * (1 - 0.75::DOUBLE + 0.75::DOUBLE * len / avg_len))), 6) AS score
FROM tf JOIN df USING (term) JOIN len USING (doc_id) CROSS JOIN n GROUP BY doc_id""")
def score_bm25(spark, sf):
    return search(documents(spark, sf, NORMED), keys=some("de", "la"), scoring="bm25").hits


@query("sort_relevance", f"""
WITH {SCORED}
SELECT CAST(doc_id AS VARCHAR) AS item_id, round(sum(sqrt(CAST(tf AS DOUBLE)) * {IDF} / sqrt(CAST(len AS DOUBLE))), 6) AS score
FROM tf JOIN df USING (term) JOIN len USING (doc_id) JOIN documents d USING (doc_id) CROSS JOIN n
WHERE d.lang = 'fr' GROUP BY doc_id HAVING count(*) = 2 ORDER BY score DESC, item_id LIMIT 10""")
def sort_relevance(spark, sf):
    """The flagship: two words, a filter, the ten best documents."""
    return search(documents(spark, sf, NORMED), keys="de la", where=C("lang", "fr"), limit=10).hits


BOOSTED = f"""{PART_WORDS},
tf AS (SELECT p_partkey, field, term, count(*) AS tf FROM w WHERE term IN ('small', 'red') GROUP BY ALL),
df AS (SELECT field, term, count(*) AS df FROM tf GROUP BY ALL),
n AS (SELECT count(*) AS n FROM part),
best AS (SELECT p_partkey, term, max(CASE WHEN field = 'name' THEN 5.0::DOUBLE ELSE 1.0::DOUBLE END
    * sqrt(CAST(tf AS DOUBLE)) * {IDF}) AS s
  FROM tf JOIN df USING (field, term) CROSS JOIN n GROUP BY ALL),
scored AS (SELECT CAST(p_partkey AS VARCHAR) AS item_id, round(sum(s), 6) AS score FROM best GROUP BY ALL)"""


@query("score_boost", f"WITH {BOOSTED} SELECT * FROM scored")
def score_boost(spark, sf):
    return search(parts(spark, sf), keys=some("small", "red")).hits


@query("elevate", f"""
WITH {BOOSTED},
e AS (SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_partkey AS elev_rank FROM part WHERE p_brand = 'Brand#7' AND p_size < 20)
SELECT item_id, score, elev_rank FROM scored LEFT JOIN e USING (item_id)
ORDER BY elev_rank NULLS LAST, score DESC, item_id LIMIT 60""")
def elevate(spark, sf):
    """Some parts of one brand are listed first for this query text."""
    listed = table(spark, sf, "part").where("p_brand = 'Brand#7' AND p_size < 20").select(
        F.lit(" Small  RED ").alias("query_text"),
        F.concat(F.lit("local-parts-"), "p_partkey").alias("doc_key"), F.col("p_partkey").alias("rank"),
    )
    return search(parts(spark, sf), keys=some("small", "red"), elevation=listed, limit=60).hits


@query("rank_factor", f"""
WITH {BOOSTED}
SELECT item_id, score * CASE WHEN p_size < 10 THEN 2.5::DOUBLE ELSE 1.0::DOUBLE END AS score
FROM scored JOIN part ON item_id = CAST(p_partkey AS VARCHAR)""")
def rank_factor(spark, sf):
    """The external rank of some parts multiplies their score."""
    ranks = table(spark, sf, "part").where("p_size < 10").select(
        F.concat(F.lit("local-parts-"), "p_partkey").alias("doc_key"), F.lit(2.5).alias("rank"))
    return search(parts(spark, sf), keys=some("small", "red"), ranks=ranks).hits
