"""Excerpts and highlighting for a page of hits.

Both run on the rows of the page only.  A text is cut into pieces that cover it without gaps: the surface tokens of
the field's chain and what stands between them, and a token's parts where the chain splits it.  Each distinct
piece goes through the chain by itself (character map, case, parts, stop words, lengths, stems); pieces that
yield a term of the query are marked where they stand, so the text around them stays as it was written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.analysis import CASE_PARTS, PARTS, Analyzer
from gleaner.functions.columns import compute_once, let
from gleaner.functions.markup import MARK_CLOSE, MARK_OPEN, clean_snippet, format_highlight
from gleaner.functions.stemming import stem_terms
from gleaner.spec import FieldSpec

# Snippets per excerpt, their size in characters and the joint.
SNIPPETS = 3
SIZE = 70
JOINT = " … "
#: Marks inside a text, of the private use area; they are taken out of the text first.
OPEN, CLOSE = "\ue000", "\ue001"
#: A mark, marks less than a size apart, and half a size to both sides, from and to the borders of words.
HIT = f"{OPEN}[^{CLOSE}]*{CLOSE}"
OTHER = r"[^\p{L}\p{N}]"
SNIPPET = rf"(?s)(?:(?:^|{OTHER}).{{0,{SIZE // 2}}})?{HIT}(?:.{{0,{SIZE}}}?{HIT})*(?:.{{0,{SIZE // 2}}}(?:{OTHER}|$))?"
PIECES = {"whitespace": r"\S+|\s+", "word": r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"}


def _pieces(chain: Analyzer, text: Column) -> Column:
    pattern = PIECES.get(chain.tokenizer)
    return F.array(text) if pattern is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _parts(chain: Analyzer, token: Column) -> Column:
    own = CASE_PARTS if chain.delimiter.split_case else PARTS
    return F.regexp_extract_all(token, F.lit(rf"(?:{own})|{OTHER}+"), F.lit(0))


def _forms(chain: Analyzer, piece: Column) -> Column:
    return F.array_distinct(F.flatten(chain.slots(piece)))


def _paired(piece: Column, forms: Column) -> Column:
    return F.transform(forms, lambda f: F.struct(piece.alias("piece"), f.alias("form")))


def _candidates(chain: Analyzer, values: Column) -> Column:
    """(piece, form) of all pieces; a token's parts stand for their own forms, the token for the others."""
    tokens = F.array_distinct(F.flatten(F.transform(values, lambda v: _pieces(chain, v))))

    def of_token(token: Column) -> Column:
        if chain.delimiter is None:
            return _paired(token, _forms(chain, token))

        def with_parts(parts: Column) -> Column:
            of_parts = F.flatten(F.transform(parts, lambda p: _paired(p, _forms(chain, p))))
            return let(of_parts, lambda pairs: F.concat(
                pairs, _paired(token, F.array_except(_forms(chain, token), F.transform(pairs, lambda p: p["form"])))))

        return let(_parts(chain, token), with_parts)

    return F.flatten(F.transform(tokens, of_token))


def field_values(field: FieldSpec) -> Column:
    """The texts of a field as an array without nulls."""
    if field.type == "tokens":
        values = F.transform(field.name, lambda x: x["value"])
    else:
        values = F.col(field.name) if field.multi else F.array(field.name)
    clean = F.transform(values, lambda v: F.translate(v, OPEN + CLOSE, ""))
    return F.coalesce(F.filter(clean, lambda v: v.isNotNull()), F.array().cast("array<string>"))


def with_marked(rows: DataFrame, field: FieldSpec, terms: list[str], column: str) -> DataFrame:
    """Add the field's texts with hits between OPEN and CLOSE, as an array."""
    if not terms:
        return rows.withColumn(column, field_values(field))
    chain = field.chain
    if field.type == "tokens":
        chain = Analyzer(tokenizer="keyword")  # each value is one term
    rows = compute_once(rows, {"_values": field_values(field)})
    rows = compute_once(rows, {"_pairs": _candidates(chain, F.col("_values"))})
    stems = F.transform("_pairs", lambda p: p["form"])
    if chain.stemmer:
        stems = stem_terms(stems, chain.stemmer, frozenset(chain.protected))
    rows = rows.withColumn("_stems", stems)
    zipped = F.arrays_zip(F.col("_pairs").alias("pair"), F.col("_stems").alias("stem"))
    hits = F.transform(F.filter(zipped, lambda z: z["stem"].isin(*terms)), lambda z: z["pair"]["piece"])
    rows = compute_once(rows, {"_hits": F.array_distinct(hits)})

    def marked(piece: Column, rest: Column) -> Column:
        return F.when(F.array_contains("_hits", piece), F.concat(F.lit(OPEN), piece, F.lit(CLOSE))).otherwise(rest)

    def in_token(token: Column) -> Column:
        if chain.delimiter is None:
            return marked(token, token)
        return marked(token, F.array_join(F.transform(_parts(chain, token), lambda p: marked(p, p)), ""))

    texts = F.transform("_values", lambda v: F.array_join(F.transform(_pieces(chain, v), in_token), ""))
    return compute_once(rows, {column: F.when(F.size("_hits") > 0, texts).otherwise(F.col("_values"))}).drop("_values", "_pairs", "_stems", "_hits")


def excerpt(texts: Column) -> Column:
    """Up to three marked snippets of about ``SIZE`` characters of the marked texts, null without a hit.

    A snippet reaches half a size to both sides of a hit; hits closer than one size share a snippet.
    """
    found = F.slice(F.flatten(F.transform(texts, lambda t: F.regexp_extract_all(t, F.lit(SNIPPET), F.lit(0)))), 1, SNIPPETS)
    shown = F.transform(found, lambda s: clean_snippet(_formatted(s)))
    return F.when(F.size(found) > 0, F.array_join(shown, JOINT))


def _formatted(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(OPEN), F.lit(MARK_OPEN)), F.lit(CLOSE), F.lit(MARK_CLOSE))


def highlight(texts: Column) -> Column:
    """The whole texts with hit words in ``<strong>``."""
    return F.transform(texts, lambda t: format_highlight(_formatted(t)))


def with_excerpts(rows: DataFrame, field: FieldSpec, terms: list[str]) -> DataFrame:
    """Add ``excerpt`` and ``highlight`` columns for one text field (several values joined by blanks)."""
    rows = with_marked(rows, field, terms, "_marked")
    whole = F.array_join(highlight(F.col("_marked")), " ")
    if not field.multi and field.type != "tokens":
        whole = F.when(F.col(field.name).isNotNull(), whole)
    return rows.withColumns({"excerpt": excerpt(F.col("_marked")), "highlight": whole}).drop("_marked")


def with_highlights(rows: DataFrame, fields: dict[FieldSpec, list[str]]) -> DataFrame:
    """Add one ``excerpt`` over several text fields, and put their highlighted values in the place of the fields.

    ``fields`` maps each field to the query's terms in it.  Snippets come from the fields in the given order.  A
    field keeps its shape, one text or several; of pre-tokenized text the values stay.  Null stays null.
    """
    names = {f.name: f"_marked_{f.name}" for f in fields}
    for f, terms in fields.items():
        rows = with_marked(rows, f, terms, names[f.name])
    spell = [F.col(names[f.name]) for f in fields if f.copy_to_spell]
    shown = {}
    for f in fields:
        values = highlight(F.col(names[f.name]))
        several = f.multi or f.type == "tokens"
        shown[f.name] = F.when(F.col(f.name).isNotNull(), values if several else F.get(values, F.lit(0)))
    excerpts = excerpt(F.concat(*spell)) if spell else F.lit(None).cast("string")
    return rows.withColumn("excerpt", excerpts).withColumns(shown).drop(*names.values())
