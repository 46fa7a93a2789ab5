"""Completions of a half-typed query, and corrections of misspelt words."""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.analysis import analyzer
from gleaner.functions.columns import any_of
from gleaner.functions.distance import deletion_keys, jaro_winkler
from gleaner.operators.grouping import top_n
from gleaner.operators.keys import Keys, as_keys, every
from gleaner.plans.request import SearchRequest
from gleaner.plans.search import SearchResult
from gleaner.sources.index import SearchIndex, spell_dictionary, with_words

# Fixed values of the completion rules.
KEY_BREAKS = r"""[-\s():{}\[\]\\"]+"""
MIN_BYTES = 3
MAX_OCCURRENCES = 0.9
MAX_EDITS = 2
ACCURACY = 0.7


def split_keys(text: str) -> list[str]:
    return [k for k in re.split(KEY_BREAKS, text) if k]


def autocomplete(
    index: SearchIndex, fragment: str, request: SearchRequest | None = None, limit: int = 10,
    suggest_words: bool = True, user_input: str | None = None, dictionary: DataFrame | None = None,
) -> DataFrame:
    """``(pass, term, results, suffix)``.

    Pass 1 completes the fragment among the documents matching the complete keys.
    Pass 2 offers next words among those that also match the fragment; it counts
    only when pass 1 left room, and never repeats a term.  With a ``dictionary``
    the corrected input comes first, as pass 0.

    Both passes and both result counts come from one scan: terms are counted for
    the documents of pass 1, with a flag for those of pass 2, and an empty term
    stands for the document itself.
    """
    request = request or SearchRequest()
    lowered = fragment.lower()
    keys = as_keys(request.keys)
    typed = [k.lower() for k in (split_keys(request.keys) if isinstance(request.keys, str) else keys.phrases())]
    result = SearchResult(index, replace(request, keys=every(keys, fragment) if keys.items else every(fragment)))
    fields = [f.name for f in result.fields]

    rows = result.looked_up_for(keys)
    words = with_words(rows.select(*index.docs.columns, "_also"), index.spec, fields, distinct=True)
    document = F.array(F.struct(F.lit("").alias("field"), F.lit("").alias("term")))
    pairs = [document] + [
        F.transform(
            # a term either completes the fragment or, for the flagged documents, may follow it
            F.filter(f"_words_{f}", lambda t: t.startswith(lowered) | F.col("_also")),
            lambda t: F.struct(F.lit(f).alias("field"), t.alias("term")),
        )
        for f in fields
    ]
    counts = words.select("_also", F.inline(F.concat(*pairs))).groupBy("field", "term").agg(
        F.count("*").alias("n1"), F.count_if("_also").alias("n2"))
    starts = F.col("term").startswith(lowered) | (F.col("term") == "")
    passes = F.filter(
        F.array(
            F.struct(F.lit(1).alias("pass"), F.when(starts, F.col("n1")).otherwise(F.lit(0)).alias("n")),
            F.struct(F.lit(2).alias("pass"), F.col("n2").alias("n")),
        ),
        lambda p: (p["n"] > 0) & ((p["pass"] == 1) | F.lit(suggest_words)),
    )
    by_field = counts.select("field", "term", F.inline(passes))
    # Fields are merged and terms excluded on the full counts; the cut comes last.
    merged = by_field.groupBy("pass", "term").agg(F.max("n").alias("results"))
    documents = merged.where(F.col("term") == "").select("pass", F.col("results").alias("_found"))
    most = F.col("_found") * MAX_OCCURRENCES
    too_many = (F.col("results") > most) & (most < F.col("_found")) & ((F.col("pass") == 2) | (most >= 1))
    merged = merged.join(documents, "pass").where((F.octet_length("term") >= MIN_BYTES) & ~too_many)
    if typed:
        merged = merged.where(~F.col("term").isin(*typed))
    best = top_n(merged.select("pass", "term", "results"), ["pass"], [F.col("results").desc(), F.col("term").asc()], limit).drop("rank")
    corrections = None
    if dictionary is not None:
        corrections = did_you_mean(spell_suggest(dictionary, user_input or fragment), user_input or fragment)
    taken = F.count_if(F.col("pass") == 1).over(Window.partitionBy(F.lit(1)))
    if corrections is not None:
        taken = taken + corrections.agg(F.count("*")).scalar()
    best = best.withColumn("_taken", taken).withColumn(
        "_first", F.min("pass").over(Window.partitionBy("term")))
    starts = F.lower(F.col("term")).startswith(lowered)
    shown = best.where((F.col("pass") == F.col("_first")) & ((F.col("pass") == 1) | (F.col("_taken") < limit))).select(
        "pass", "term", "results",
        F.when(starts, F.substring("term", len(fragment) + 1, 2**31 - 1))
        .otherwise(F.concat(F.lit(" "), "term")).alias("suffix"),
    )
    if corrections is None:
        return shown
    return corrections.select(
        F.lit(0).alias("pass"), F.col("user_input").alias("term"), F.lit(None).cast("bigint").alias("results"),
        F.lit(None).cast("string").alias("suffix"),
    ).unionByName(shown)


def candidates(dictionary: DataFrame, words: list[str], max_edits: int = MAX_EDITS) -> DataFrame:
    """``(word, term, distance, df)`` within ``max_edits`` edits.

    The words of one request are literals, so this is one scan of the dictionary:
    lengths are checked first, then the bounded edit distance.  Nothing is blocked
    by first letters, hence nothing is missed.
    """
    entries = F.array(*[
        F.struct(
            F.lit(w).alias("word"),
            F.when(
                F.length("term").between(len(w) - max_edits, len(w) + max_edits),
                F.levenshtein(F.col("term"), F.lit(w), max_edits),
            ).otherwise(F.lit(-1)).alias("distance"),
        )
        for w in words
    ])
    near = F.filter(entries, lambda e: e["distance"].between(1, max_edits))
    return dictionary.select("term", "df", F.inline(near)).select("word", "term", "distance", "df")


def similar_candidates(dictionary: DataFrame, words: list[str], accuracy: float = ACCURACY) -> DataFrame:
    """``(word, term, distance, df)`` of a Jaro-Winkler similarity of ``accuracy`` at least; the distance is what is missing
    to 1.  One scan of the dictionary."""
    entries = F.array(*[
        F.struct(F.lit(w).alias("word"), F.round(1 - jaro_winkler(F.lit(w), F.col("term")), 6).alias("distance")) for w in words
    ])
    near = F.filter(entries, lambda e: (e["distance"] > 0) & (e["distance"] <= F.lit(round(1 - accuracy, 6))))
    return dictionary.select("term", "df", F.inline(near)).select("word", "term", "distance", "df")


def batch_candidates(dictionary: DataFrame, words: DataFrame, max_edits: int = MAX_EDITS) -> DataFrame:
    """``(word, term, distance, df)`` within ``max_edits`` edits for a table of words of any size.

    Both sides write down what is left of a word after up to ``max_edits`` deletions; near words share one of these
    keys, so an equi-join finds all pairs, and the bounded edit distance decides.
    """
    terms = dictionary.select("term", "df", F.explode(deletion_keys(F.col("term"), max_edits)).alias("_key"))
    typed = words.select("word").where("word IS NOT NULL").distinct()
    typed = typed.select("word", F.explode(deletion_keys(F.col("word"), max_edits)).alias("_key"))
    pairs = typed.join(terms, "_key").select("word", "term", "df").distinct()
    distance = F.levenshtein("word", "term", max_edits)
    return pairs.withColumn("distance", distance).where(F.col("distance").between(1, max_edits)).select("word", "term", "distance", "df")


def spell_suggest_batch(
    dictionary: DataFrame, words: DataFrame, max_edits: int = MAX_EDITS, count: int = 1, by_frequency: bool = False,
) -> DataFrame:
    """``spell_suggest`` for a table with a column ``word``: suggestions for those missing from the dictionary."""
    chain = analyzer("spell")
    typed = words.select(F.lower("word").alias("word")).where(F.char_length("word").between(chain.min_length, chain.max_length))
    unknown = typed.distinct().join(dictionary.select(F.col("term").alias("word")), "word", "left_anti")
    order = [F.col("distance").asc(), F.col("df").desc()]
    if by_frequency:
        order.reverse()
    best = top_n(batch_candidates(dictionary, unknown, max_edits), ["word"], [*order, F.col("term").asc()], count, "place")
    return best.select("word", F.col("term").alias("suggestion"), "distance", "df", "place")


def spell_suggest(
    dictionary: DataFrame, text: str, max_edits: int = MAX_EDITS, count: int = 1, by_frequency: bool = False,
    threshold: float = 0.0, documents: Column | None = None, measure: str = "edits", accuracy: float = ACCURACY,
) -> DataFrame:
    """``(word, suggestion, distance, df, place)`` for words missing from the dictionary.

    ``measure`` is "edits" (up to ``max_edits``) or "jaro_winkler" (a similarity of ``accuracy`` at least).

    Words that are too short or too long for the dictionary are not checked.
    ``threshold`` drops dictionary terms in a smaller share of ``documents``.
    """
    chain = analyzer("spell")
    words = [w.lower() for w in split_keys(text) if chain.min_length <= len(w) <= chain.max_length]
    words = list(dict.fromkeys(words))
    if not words:
        return candidates(dictionary.where(F.lit(False)), [""]).select(
            "word", F.col("term").alias("suggestion"), "distance", "df", F.lit(1).alias("place"))
    if threshold and documents is not None:
        dictionary = dictionary.where(F.col("df") >= documents * threshold)
    known = dictionary.where(F.col("term").isin(*words)).select(F.col("term").alias("word"))
    order = [F.col("distance").asc(), F.col("df").desc()]
    if by_frequency:
        order.reverse()
    if measure not in ("edits", "jaro_winkler"):
        raise ValueError(f"unknown measure {measure!r}")
    near = candidates(dictionary, words, max_edits) if measure == "edits" else similar_candidates(dictionary, words, accuracy)
    best = top_n(near, ["word"], [*order, F.col("term").asc()], count, "place")
    return best.join(known, "word", "left_anti").select(
        "word", F.col("term").alias("suggestion"), "distance", "df", "place"
    )


def did_you_mean(suggestions: DataFrame, user_input: str) -> DataFrame:
    """One row with the corrected input, none where nothing changes.

    Only one suggestion per typed word is gathered here.
    """
    pairs = suggestions.where("place = 1").agg(
        F.array_sort(F.collect_list(F.struct("word", "suggestion"))).alias("pairs")
    )
    corrected = F.aggregate(
        "pairs", F.lit(user_input),
        lambda text, p: F.regexp_replace(text, F.concat(F.lit(r"(?iu)\Q"), p["word"], F.lit(r"\E")), p["suggestion"]),
    )
    return pairs.select(corrected.alias("user_input")).where(F.col("user_input") != user_input)


def index_dictionary(index: SearchIndex, by: tuple[str, ...] = ()) -> DataFrame:
    return spell_dictionary(index.docs, index.spec, by)


def matches_any_prefix(value: Column, prefixes: list[str]) -> Column:
    """Whole-value prefix match, as with stored edge n-grams."""
    return any_of(F.lower(value).startswith(p.lower()) for p in prefixes)


__all__ = [
    "Keys", "autocomplete", "batch_candidates", "candidates", "similar_candidates", "spell_suggest_batch", "did_you_mean", "index_dictionary", "matches_any_prefix",
    "spell_suggest", "split_keys",
]
