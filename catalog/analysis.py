"""Text analysis over the whole corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import TEXT, documents, query, table, unlabelled
from gleaner import FieldSpec, IndexSpec, SearchIndex
from gleaner.functions.analysis import (
    PROTECTED_WORDS, Delimiter, accent_map, edge_ngrams, fold_chars, word_tokens,
)
from gleaner.functions.markup import strip_html, tag_texts
from gleaner.functions.stemming import stem_terms
from gleaner.operators.suggest import matches_any_prefix
from gleaner.sources.index import distinct_terms, doc_frequency, scored_tokens, with_tokens
from gleaner.sources.tables import expand_synonyms, without_stopwords


def postings(spark, sf, type_name, **options):
    return documents(spark, sf, unlabelled(FieldSpec("text", type_name, **options))).postings()


def listed(df):
    """Postings as flat rows: the positions become their number and the first one."""
    return df.select(
        F.substring_index("doc_key", "-", -1).alias("item_id"), "term",
        F.col("tf").cast("bigint").alias("tf"), F.array_min("positions").cast("bigint").alias("first_pos"),
        F.col("len").cast("bigint").alias("len"),
    )


# The delimiting chain in SQL: words -> runs -> parts -> slots -> (term, position).
RUNS = r"\p{L}+([^\p{L}\p{N}]+\p{L}+)*|\p{N}+([^\p{L}\p{N}]+\p{N}+)*"
PROTECTED = ", ".join("'" + w.replace("'", "''") + "'" for w in PROTECTED_WORDS)
DELIMITED = rf"""
w AS (SELECT doc_id, unnest(l) AS tok, generate_subscripts(l, 1) AS wi FROM (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '\s+'), lambda t: t <> '') AS l FROM documents)),
r AS (SELECT doc_id, tok, wi, unnest(runs) AS run, generate_subscripts(runs, 1) AS ri FROM (
  SELECT *, CASE WHEN tok IN ({PROTECTED}) THEN [] ELSE
    regexp_extract_all(regexp_replace(tok, '''[sS]($|[^\p{{L}}\p{{N}}])', '\1', 'g'), '{RUNS}') END AS runs FROM w)),
p AS (SELECT doc_id, tok, wi, ri, unnest(parts) AS part, generate_subscripts(parts, 1) AS pi, len(parts) AS np,
    regexp_replace(run, '[^\p{{L}}\p{{N}}]+', '', 'g') AS joined FROM (
  SELECT *, regexp_extract_all(run, '\p{{L}}+|\p{{N}}+') AS parts FROM r)),
slots AS (
  SELECT doc_id, tok, wi, ri, pi, part, CASE WHEN np > 1 AND pi = np THEN joined END AS joined FROM p
  UNION ALL
  SELECT doc_id, tok, wi, 0, 0, NULL, NULL FROM w WHERE (doc_id, wi) NOT IN (SELECT (doc_id, wi) FROM p)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY wi, ri, pi) - 1 AS pos,
  row_number() OVER (PARTITION BY doc_id, wi ORDER BY ri, pi) = 1 AS first_of_token FROM slots),
all_terms AS (
  SELECT doc_id, part AS term, pos FROM numbered WHERE part IS NOT NULL
  UNION ALL SELECT doc_id, joined, pos FROM numbered WHERE joined IS NOT NULL),
with_original AS (
  SELECT DISTINCT * FROM (SELECT * FROM all_terms UNION ALL SELECT doc_id, tok, pos FROM numbered WHERE first_of_token)
  WHERE length(term) BETWEEN 2 AND 100),
parts_only AS (SELECT * FROM all_terms WHERE length(term) BETWEEN 2 AND 100)"""


def grouped(source: str) -> str:
    return f"""SELECT CAST(doc_id AS VARCHAR) AS item_id, term, count(*) AS tf, min(pos) AS first_pos,
  any_value(len) AS len FROM {source} JOIN (SELECT doc_id, count(*) AS len FROM {source} GROUP BY 1) USING (doc_id)
GROUP BY doc_id, term"""


@query("postings_words", f"WITH {DELIMITED} {grouped('with_original')}")
def postings_words(spark, sf):
    return listed(postings(spark, sf, "text_words"))


@query("postings_und", f"WITH {DELIMITED} {grouped('parts_only')}")
def postings_und(spark, sf):
    return listed(postings(spark, sf, "text_unstemmed"))


@query("postings_text")
def postings_text(spark, sf):
    """The full chain with English stems."""
    return listed(postings(spark, sf, "text"))


WS = r"""ws AS (SELECT doc_id, unnest(l) AS term, generate_subscripts(l, 1) - 1 AS pos FROM (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '\s+'), lambda t: t <> '') AS l FROM documents))"""


@query("postings_ws", f"""WITH {WS}
SELECT CAST(doc_id AS VARCHAR) AS item_id, term, count(*) AS tf, min(pos) AS first_pos, 1::BIGINT AS len FROM ws GROUP BY doc_id, term""")
def postings_ws(spark, sf):
    return listed(postings(spark, sf, "text_ws"))


@query("doc_freq", f"WITH {WS} SELECT 'text' AS field, term, count(DISTINCT doc_id) AS df FROM ws GROUP BY term")
def doc_freq(spark, sf):
    spec = unlabelled(FieldSpec("text", "text_ws"))
    return doc_frequency(distinct_terms(documents(spark, sf, spec).docs, spec, ["text"]))


@query("postings_positions", r"""
WITH v AS (SELECT doc_id, unnest(vs) AS value, generate_subscripts(vs, 1) - 1 AS vi FROM (
  SELECT doc_id, string_split(lower(text), chr(10)) AS vs FROM documents)),
t AS (SELECT doc_id, vi, list_filter(string_split_regex(value, '\s+'), lambda t: t <> '') AS l FROM v),
b AS (SELECT doc_id, l, 100 * vi + coalesce(sum(len(l)) OVER (
  PARTITION BY doc_id ORDER BY vi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM t),
p AS (SELECT doc_id, base, unnest(l) AS term, generate_subscripts(l, 1) - 1 AS ti FROM b)
SELECT CAST(doc_id AS VARCHAR) AS item_id, term, CAST(base + ti AS BIGINT) AS pos FROM p""")
def postings_positions(spark, sf):
    """Every line is one value of a multi-valued field; values are 100 positions apart."""
    spec = unlabelled(FieldSpec("text", "text_ws", source="split(text, '\\n')", multi=True))
    rows = with_tokens(documents(spark, sf, spec).docs, spec, ["text"])
    return rows.select("item_id", F.inline("_tok_text")).withColumn("pos", F.col("pos").cast("bigint"))


@query("word_delimiter", f"""WITH {DELIMITED}
SELECT CAST(doc_id AS VARCHAR) AS item_id, term, pos FROM with_original""")
def word_delimiter(spark, sf):
    spec = unlabelled(FieldSpec("text", "text_words"))
    rows = with_tokens(documents(spark, sf, spec).docs, spec, ["text"])
    return rows.select("item_id", F.inline("_tok_text")).withColumn("pos", F.col("pos").cast("bigint"))


@query("protected_words", r"""
WITH t AS (SELECT page_id, unnest(regexp_extract_all(html, '&[#a-z0-9]+;|\p{L}+|\p{N}+')) AS tok FROM pages),
k AS (SELECT page_id, CASE WHEN tok IN ('&amp;', '&lt;', '&gt;', '&#039;', '&quot;') OR NOT starts_with(tok, '&') THEN [tok]
  ELSE regexp_extract_all(tok, '\p{L}+|\p{N}+') END AS parts FROM t)
SELECT CAST(page_id AS VARCHAR) AS item_id, term, count(*) AS n FROM (SELECT page_id, unnest(parts) AS term FROM k) GROUP BY ALL""")
def protected_words(spark, sf):
    """Entities on the protected list stay whole, others fall into parts."""
    tokens = F.regexp_extract_all("html", F.lit(r"&[#a-z0-9]+;|\p{L}+|\p{N}+"), F.lit(0))
    split = Delimiter(catenate=False, keep_original=False)
    rows = table(spark, sf, "pages").select(
        F.col("page_id").cast("string").alias("item_id"), F.explode(tokens).alias("tok"))
    return (
        rows.select("item_id", F.explode(F.flatten(split.slots(F.col("tok"), PROTECTED_WORDS))).alias("term"))
        .groupBy("item_id", "term").agg(F.count("*").alias("n"))
    )


@query("stopwords", f"""WITH {WS},
s AS (SELECT lower(n_name) AS word FROM nation UNION SELECT unnest(['the', 'of', 'and', 'la', 'de', 'der', 'und']))
SELECT CAST(doc_id AS VARCHAR) AS item_id, term, count(*) AS tf, min(pos) AS first_pos, 1::BIGINT AS len
FROM ws WHERE term NOT IN (SELECT word FROM s) GROUP BY doc_id, term""")
def stopwords(spark, sf):
    """Stop words from a table; the remaining positions keep their gaps."""
    words = table(spark, sf, "nation").select(F.col("n_name").alias("word"))
    fixed = spark.sql("SELECT explode(array('the', 'of', 'and', 'la', 'de', 'der', 'und')) AS word")
    return listed(without_stopwords(postings(spark, sf, "text_ws"), words.unionByName(fixed)))


@query("synonym_expand", """
WITH q AS (SELECT DISTINCT lower(p_type) AS term FROM part),
s AS (SELECT DISTINCT lower(p_type) AS term, lower(string_split(p_name, ' ')[1]) AS synonym FROM part)
SELECT term FROM q UNION SELECT synonym FROM q JOIN s USING (term)""")
def synonym_expand(spark, sf):
    part = table(spark, sf, "part")
    synonyms = part.select(F.lower("p_type").alias("term"), F.split("p_name", " ")[0].alias("synonym"))
    return expand_synonyms(part.select(F.lower("p_type").alias("term")).distinct(), synonyms)


@query("edge_ngrams", """
WITH v AS (SELECT p_partkey, lower(p_name) AS v FROM part)
SELECT CAST(p_partkey AS VARCHAR) AS item_id, unnest([substr(v, 1, CAST(n AS INTEGER)) for n in range(2, 26) if n <= length(v)]) AS gram FROM v""")
def edge_ngrams_query(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("item_id"), F.explode(edge_ngrams(F.col("p_name"))).alias("gram"))


@query("prefix_match", "SELECT CAST(page_id AS VARCHAR) AS item_id, url FROM pages WHERE starts_with(lower(url), 'https://') OR starts_with(lower(url), 'http://th')")
def prefix_match(spark, sf):
    return table(spark, sf, "pages").where(matches_any_prefix(F.col("url"), ["HTTPS://", "http://th"])).select(
        F.col("page_id").cast("string").alias("item_id"), "url")


_ONE = {k: v for k, v in accent_map().items() if len(v) == 1}
_FOLDED = f"translate(text, '{''.join(_ONE)}', '{''.join(_ONE.values())}')"
for _k, _v in accent_map().items():
    if len(_v) > 1:
        _FOLDED = _FOLDED.replace("(text,", f"(replace(text, '{_k}', '{_v}'),") if "(text," in _FOLDED else (
            _FOLDED.replace("replace(text", f"replace(replace(text, '{_k}', '{_v}')"))


@query("accent_fold", f"SELECT CAST(doc_id AS VARCHAR) AS item_id, md5({_FOLDED}) AS folded FROM documents")
def accent_fold(spark, sf):
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("item_id"), F.md5(fold_chars(F.col("text"), accent_map())).alias("folded"))


@query("stem_vocab")
def stem_vocab(spark, sf):
    """Distinct words of all documents with their English stems."""
    words = F.array_distinct(word_tokens(F.lower("text")))
    rows = table(spark, sf, "documents").select(words.alias("words"))
    pairs = rows.withColumn("stems", stem_terms(F.col("words"), "english"))
    return pairs.select(F.inline(F.arrays_zip("words", "stems"))).distinct().select(
        F.col("words").alias("term"), F.col("stems").alias("stem"))


@query("analyze_by_lang")
def analyze_by_lang(spark, sf):
    """German documents through the German chain, the others through the default one."""
    rows = table(spark, sf, "documents")
    out = None
    for condition, type_name in (("lang = 'de'", "text_de"), ("NOT (lang <=> 'de')", "text")):
        spec = unlabelled(FieldSpec("text", type_name))
        part = SearchIndex.build(rows.where(condition), spec).postings()
        part = doc_frequency(part).withColumn("chain", F.lit(type_name))
        out = part if out is None else out.unionByName(part)
    return out


@query("scored_tokens", """
WITH t AS (SELECT doc_id, unnest(l) AS term, generate_subscripts(l, 1) - 1 AS pos FROM (
  SELECT p_partkey AS doc_id, string_split(p_name || ' ' || p_type || ' ' || p_name, ' ') AS l FROM part))
SELECT CAST(doc_id AS VARCHAR) AS item_id, lower(term) AS term, count(*) AS tf,
  arg_max(CAST(length(term) + pos AS DOUBLE), pos) AS weight FROM t GROUP BY doc_id, lower(term)""")
def scored_tokens_query(spark, sf):
    spec = IndexSpec("parts", "p_partkey", (FieldSpec(
        "tokens", "tokens",
        source="transform(split(concat_ws(' ', p_name, p_type, p_name), ' '), (t, i) -> "
        "named_struct('value', t, 'score', cast(length(t) + i as double)))"),))
    return scored_tokens(SearchIndex.build(table(spark, sf, "part"), spec).docs, "tokens")


@query("term_vectors", f"""WITH {WS}, v AS (SELECT doc_id, term, count(*) AS tf FROM ws GROUP BY ALL)
SELECT CAST(doc_id AS VARCHAR) AS item_id, md5(string_agg(term || ':' || tf, ' ' ORDER BY term)) AS vector, count(*) AS terms
FROM v GROUP BY doc_id""")
def term_vectors(spark, sf):
    """One vector per document, built inside the row; shown as a digest of its entries."""
    from gleaner.functions.analysis import group_terms

    spec = TEXT
    rows = with_tokens(documents(spark, sf, spec).docs, spec, ["text"])
    rows = rows.select("item_id", group_terms(F.col("_tok_text")).alias("g"))
    entries = F.transform("g", lambda x: F.concat_ws(":", x["term"], F.size(x["positions"])))
    return rows.where(F.size("g") > 0).select(
        "item_id", F.md5(F.array_join(entries, " ")).alias("vector"), F.size("g").cast("bigint").alias("terms"))


@query("strip_html", r"""
SELECT CAST(page_id AS VARCHAR) AS item_id, trim(regexp_replace(
  replace(replace(replace(replace(replace(
    regexp_replace(regexp_replace(html, '(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g'),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#039;', ''''), '&amp;', '&'), '\s+', ' ', 'g')) AS body FROM pages""")
def strip_html_query(spark, sf):
    return table(spark, sf, "pages").select(
        F.col("page_id").cast("string").alias("item_id"), strip_html(F.col("html")).alias("body"))


@query("html_tag_fields", r"""
SELECT CAST(page_id AS VARCHAR) AS item_id, tag, text FROM (
  SELECT page_id, 'h1' AS tag, unnest(regexp_extract_all(html, '<h1(?:\s[^>]*)?>([^<]*)', 1)) AS text FROM pages
  UNION ALL SELECT page_id, 'title', unnest(regexp_extract_all(html, '<title(?:\s[^>]*)?>([^<]*)', 1)) FROM pages
  UNION ALL SELECT page_id, 'a', unnest(regexp_extract_all(html, '<a(?:\s[^>]*)?>([^<]*)', 1)) FROM pages)""")
def html_tag_fields(spark, sf):
    entries = [
        F.transform(tag_texts(F.col("html"), tag), lambda t: F.struct(F.lit(tag).alias("tag"), t.alias("text")))
        for tag in ("h1", "title", "a")
    ]
    return table(spark, sf, "pages").select(
        F.col("page_id").cast("string").alias("item_id"), F.inline(F.concat(*entries)))


