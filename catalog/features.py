"""Similar documents, completions, corrections, excerpts and places."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import NORMED, PLACE, TEXT, TOK, documents, km, parts, places, query, table, unlabelled
from catalog.maintenance import SPELL
from gleaner import FieldSpec, SearchRequest, Similar, Spatial, every, search, some
from gleaner import Condition as C
from gleaner.functions.geo import bounding_box, geodist
from gleaner.functions.markup import format_highlight
from gleaner.operators.suggest import autocomplete, did_you_mean, index_dictionary, spell_suggest, spell_suggest_batch

# -- similar documents ----------------------------------------------------
SIMILAR = f"""{TOK},
len AS (SELECT doc_id, count(*) AS len FROM tok GROUP BY 1),
tf AS (SELECT doc_id, 'text' AS field, term, count(*) AS tf FROM tok GROUP BY 1, 3
  UNION ALL SELECT doc_id, 'source', source, 1 FROM documents),
flen AS (SELECT doc_id, 'text' AS field, len FROM len UNION ALL SELECT doc_id, 'source', 1 FROM documents),
df AS (SELECT field, term, count(*) AS df FROM tf GROUP BY 1, 2),
n AS (SELECT count(*) AS n FROM documents),
own AS (SELECT field, term, df, round(tf * (1 + ln(CAST(n AS DOUBLE) / (df + 1))), 6) AS weight
  FROM tf JOIN df USING (field, term) CROSS JOIN n WHERE doc_id = 3 ORDER BY weight DESC, field, term LIMIT 25)
SELECT CAST(doc_id AS VARCHAR) AS item_id, round(sum(weight * sqrt(CAST(tf AS DOUBLE))
  * pow(1 + ln(CAST(n AS DOUBLE) / (df + 1)), 2) / sqrt(CAST(len AS DOUBLE))), 4) AS score
FROM tf JOIN own USING (field, term) JOIN flen USING (doc_id, field) CROSS JOIN n JOIN documents d USING (doc_id)
WHERE doc_id <> 3 AND d.n_chars > 500 GROUP BY doc_id"""


@query("more_like_this", f"WITH {SIMILAR}")
def more_like_this(spark, sf):
    request = SearchRequest(similar=Similar("3", ("text", "source")), where=C("n_chars", 500, ">"))
    return search(documents(spark, sf, NORMED), request).hits


@query("mlt_missing", "SELECT CAST(doc_id AS VARCHAR) AS item_id, 0.0::DOUBLE AS score FROM documents WHERE doc_id < 0")
def mlt_missing(spark, sf):
    """A source that is not in the index has nothing similar."""
    return search(documents(spark, sf, NORMED), similar=Similar("-1", ("text",))).hits


# -- completions ----------------------------------------------------------
def _suggest_sql(matched: str, second: str, fragment: str, typed: str, limit: int, found2: str) -> str:
    def one(number: int, cond: str, prefix: str, extra: str) -> str:
        return f"""n{number} AS (SELECT count(DISTINCT doc_id) AS n FROM documents WHERE {cond}),
c{number} AS (SELECT term, count(DISTINCT doc_id) AS results FROM tok WHERE {cond}{prefix} GROUP BY term),
s{number} AS (SELECT {number}::INTEGER AS pass, term, results,
    CASE WHEN starts_with(term, '{fragment}') THEN substr(term, {len(fragment) + 1}) ELSE ' ' || term END AS suffix
  FROM c{number} CROSS JOIN n{number} WHERE strlen(term) >= 3 AND term NOT IN ({typed})
    AND NOT (results > 0.9::DOUBLE * n AND 0.9::DOUBLE * n < n{extra}) ORDER BY results DESC, term LIMIT {limit})"""

    return f"""WITH {TOK}, m AS ({matched}), m2 AS ({second}),
{one(1, 'doc_id IN (FROM m)', f" AND starts_with(term, '{fragment}')", ' AND 0.9::DOUBLE * n >= 1')},
{one(2, 'doc_id IN (FROM m2)', '', '')}
SELECT * FROM s1 UNION ALL
SELECT * FROM s2 WHERE term NOT IN (SELECT term FROM s1) AND (SELECT count(*) FROM s1) < {limit}"""


_HAS = "SELECT DISTINCT doc_id FROM tok WHERE term = '{}'"


@query("autocomplete", _suggest_sql(
    _HAS.format("de"), _HAS.format("de") + " INTERSECT " + _HAS.format("ré"), "ré", "'de'", 10, ""))
def autocomplete_query(spark, sf):
    return autocomplete(documents(spark, sf, TEXT), "Ré", SearchRequest(keys="de"))


@query("autocomplete_next_word", _suggest_sql(
    "SELECT doc_id FROM documents", _HAS.format("für"), "für", "''", 10, ""))
def autocomplete_next_word(spark, sf):
    """Few words start with the fragment, so next words fill the list."""
    return autocomplete(documents(spark, sf, TEXT), "für")


# -- corrections ----------------------------------------------------------
# DuckDB counts edits in bytes, so letters beyond ASCII become one byte that no
# typed word holds; the distance is then the one in characters.
def _spell_sql(words: list[str], order: str, extra: str = "true") -> str:
    rows = " UNION ALL ".join(f"SELECT '{w}' AS word" for w in words)
    return f"""WITH {SPELL}, dict AS (SELECT term, count(*) AS df FROM spell GROUP BY term HAVING {extra}),
typed AS ({rows}),
ascii AS (SELECT *, regexp_replace(term, '[^\\x00-\\x7F]', '?', 'g') AS a FROM dict),
c AS (SELECT word, term, CAST(levenshtein(a, word) AS INTEGER) AS distance, df FROM typed JOIN ascii
  ON levenshtein(a, word) BETWEEN 1 AND 2 AND word NOT IN (SELECT term FROM dict))
SELECT word, term AS suggestion, distance, df, 1::INTEGER AS place FROM c
QUALIFY row_number() OVER (PARTITION BY word ORDER BY {order}, term) = 1"""


@query("spell_suggest", _spell_sql(["whith", "tihs", "quee", "froom"], "distance, df DESC"))
def spell_suggest_query(spark, sf):
    return spell_suggest(index_dictionary(documents(spark, sf, TEXT)), "whith tihs (quee) froom that")


@query("spell_threshold", _spell_sql(
    ["whith", "tihs"], "df DESC, distance", "count(*) >= 0.01::DOUBLE * (SELECT count(*) FROM documents)"))
def spell_threshold(spark, sf):
    """Frequent terms first, terms in under 1 % of the documents left out."""
    index = documents(spark, sf, TEXT)
    n = index.docs.agg(F.count("*")).scalar()
    return spell_suggest(index_dictionary(index), "whith tihs", by_frequency=True, threshold=0.01, documents=n)


@query("did_you_mean", "SELECT replace('Whith this', 'Whith', suggestion) AS user_input FROM (" + _spell_sql(
    ["whith"], "distance, df DESC") + ")")
def did_you_mean_query(spark, sf):
    dictionary = index_dictionary(documents(spark, sf, TEXT))
    return did_you_mean(spell_suggest(dictionary, "Whith this"), "Whith this")


PART_TERMS = r"""terms AS (SELECT term, count(DISTINCT p_partkey) AS df FROM (
  SELECT p_partkey, unnest(regexp_extract_all(lower(p_name || ' ' || p_type), '[\p{L}\p{N}]+')) AS term FROM part)
  WHERE length(term) BETWEEN 4 AND 20 GROUP BY term)"""


@query("spell_suggest_batch", f"""WITH {PART_TERMS},
typed AS (SELECT DISTINCT replace(term, 'e', 'ai') AS word FROM terms),
near AS (SELECT word, term, levenshtein(word, term) AS distance, df FROM typed, terms
  WHERE word NOT IN (SELECT term FROM terms) AND length(word) BETWEEN 4 AND 20 AND levenshtein(word, term) <= 2)
SELECT word, term AS suggestion, CAST(distance AS INTEGER) AS distance, df, CAST(place AS INTEGER) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY word ORDER BY distance, df DESC, term) AS place FROM near) WHERE place <= 3""")
def spell_suggest_batch_query(spark, sf):
    """A misspelling of every word of the parts, corrected in one join; the twin compares all pairs."""
    dictionary = index_dictionary(parts(spark, sf))
    typed = dictionary.select(F.replace("term", F.lit("e"), F.lit("ai")).alias("word"))
    return spell_suggest_batch(dictionary, typed, count=3)


@query("spell_jaro_winkler", f"""WITH {PART_TERMS},
typed AS (SELECT unnest(['smal', 'lrage', 'meduim', 'wdiget', 'anvli', 'stadnard', 'econmy', 'gizom']) AS word),
near AS (SELECT word, term, round(1 - jaro_winkler_similarity(word, term), 6) AS distance, df FROM typed, terms)
SELECT word, term AS suggestion, distance, df, CAST(place AS INTEGER) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY word ORDER BY distance, df DESC, term) AS place FROM near
  WHERE distance > 0 AND distance <= 0.3) WHERE place <= 5""")
def spell_jaro_winkler(spark, sf):
    typed = "smal lrage meduim wdiget anvli stadnard econmy gizom"
    return spell_suggest(index_dictionary(parts(spark, sf)), typed, count=5, measure="jaro_winkler")


# -- excerpts -------------------------------------------------------------
STEMMED = unlabelled(FieldSpec("text", "text"))


def _page(spark, sf):
    """One page of ten hits with the texts needed to show them."""
    return search(documents(spark, sf, STEMMED), keys=every("from", "this"), limit=10).excerpts("text")


@query("excerpt")
def excerpt(spark, sf):
    return _page(spark, sf).select("item_id", "score", "excerpt")


@query("highlight")
def highlight(spark, sf):
    return _page(spark, sf).select("item_id", "highlight")


def _marked_sql(text: str, terms: str) -> str:
    """A text with its blank-separated terms between the marks of a snippet."""
    return (f"array_to_string(list_transform(regexp_extract_all({text}, '\\S+|\\s+'), lambda t: "
            f"CASE WHEN lower(t) IN ({terms}) THEN chr(57344) || t || chr(57345) ELSE t END), '')")


def _strong_sql(text: str) -> str:
    return f"replace(replace({text}, chr(57344), '<strong>'), chr(57345), '</strong>')"


@query("highlight_fields", f"""
WITH h AS (SELECT p_partkey, p_name, p_type FROM part WHERE list_has_any(string_split(lower(p_name || ' ' || p_type), ' '), ['blue', 'steel', 'red']))
SELECT CAST(p_partkey AS VARCHAR) AS item_id, {_strong_sql(_marked_sql("p_name", "'blue', 'steel', 'red'"))} AS name,
  {_strong_sql(_marked_sql("p_type", "'blue', 'steel', 'red'"))} AS kind_text FROM h""")
def highlight_fields(spark, sf):
    """All searched text fields of the hits, highlighted in place."""
    return search(parts(spark, sf), keys=some("blue", "steel", "red"), scoring=None).excerpts().select("item_id", "name", "kind_text")


_HIT = r"\x{E000}[^\x{E001}]*\x{E001}"
_SNIPPET = r"(?s)(?:(?:^|[^\p{L}\p{N}]).{0,35})?" + _HIT + r"(?:.{0,70}?" + _HIT + r")*(?:.{0,35}(?:[^\p{L}\p{N}]|$))?"
_CLEAN = (
    "regexp_replace(replace(replace(regexp_replace(regexp_replace(s, '<[^>]*>', '', 'g'), '^[^<>]*>|<[^<>]*$', '', 'g'), "
    r"chr(57344), '<strong>'), chr(57345), '</strong>'), '^[\x00-/:;=?@\[-`]+|[\x00-/:;=?@\[-`]+$', '', 'g')"
)


@query("excerpt_text", f"""
WITH m AS (SELECT doc_id, {_marked_sql("text", "'from', 'this'")} AS t FROM documents),
s AS (SELECT doc_id, regexp_extract_all(t, '{_SNIPPET}')[1:3] AS found FROM m WHERE contains(t, chr(57344)))
SELECT CAST(doc_id AS VARCHAR) AS item_id, md5(array_to_string(list_transform(found, lambda s: {_CLEAN}), ' … ')) AS excerpt FROM s""")
def excerpt_text(spark, sf):
    """Up to three snippets of every hit in a text that is split at blanks."""
    hits = search(documents(spark, sf, TEXT), keys=some("from", "this"), scoring=None).excerpts("text")
    return hits.select("item_id", F.md5("excerpt").alias("excerpt"))


@query("highlight_format", r"""
SELECT CAST(doc_id AS VARCHAR) AS item_id, md5(replace(text, ' the ', ' <strong>the</strong> ')) AS marked FROM documents""")
def highlight_format(spark, sf):
    marked = F.replace(F.col("text"), F.lit(" the "), F.lit(" [HIGHLIGHT]the[/HIGHLIGHT] "))
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("item_id"), F.md5(format_highlight(marked)).alias("marked"))


# -- places ---------------------------------------------------------------
LAT, LON = -50.0, 179.0
DIST = km(LAT, LON)


@query("geodist", f"WITH {PLACE} SELECT CAST(c_custkey AS VARCHAR) AS item_id, round({DIST}, 3) AS km FROM place")
def geodist_query(spark, sf):
    place = F.col("place")
    return places(spark, sf).docs.select(
        "item_id", F.round(geodist(place["lat"], place["lon"], LAT, LON), 3).alias("km"))


def _near(name, sql, spatial, **options):
    @query(name, sql)
    def run(spark, sf):
        return search(places(spark, sf), spatial=(spatial,), **options).hits.select("item_id")


_ID = f"WITH {PLACE} SELECT CAST(c_custkey AS VARCHAR) AS item_id FROM place WHERE "
_S, _N, _W, _E = bounding_box(LAT, LON, 3000.0)
_near("geo_radius", _ID + f"{DIST} <= 3000", Spatial("place", LAT, LON, radius=3000.0))
_near("geo_bbox", _ID + f"lat BETWEEN {_S} AND {_N} AND (lon >= {_W} OR lon <= {_E})",
      Spatial("place", LAT, LON, radius=3000.0, method="box"))
_near("geo_ring", _ID + f"{DIST} BETWEEN 2000 AND 5000", Spatial("place", LAT, LON, radius=5000.0, inner=2000.0))
_near("sort_distance", f"WITH {PLACE} SELECT CAST(c_custkey AS VARCHAR) AS item_id FROM place"
      f" ORDER BY round({DIST}, 6), CAST(c_custkey AS VARCHAR) LIMIT 25",
      Spatial("place", LAT, LON), sorts=(("place", "asc"),), limit=25)
