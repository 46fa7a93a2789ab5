"""Word distances as Column expressions, and keys under which near words meet."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.columns import let

# Fixed values of the Jaro-Winkler measure: longest prefix that counts, its weight, and the similarity it needs.
PREFIX, WEIGHT, FROM = 4, 0.1, 0.7
_TAKEN = "\0"


def jaro_winkler(x: Column, y: Column) -> Column:
    """Similarity of two words from 0 to 1; two empty words are equal, null stays null.

    A fold over the characters of ``x``: each takes the first free equal character of ``y`` within reach, which is
    blanked out there.  Matched characters of both words, in order, then give the transpositions.
    """
    nx, ny = F.char_length(x), F.char_length(y)
    reach = F.greatest(F.floor(F.greatest(nx, ny) / 2).cast("int") - 1, F.lit(0))
    start = F.struct(y.alias("left"), F.lit("").alias("matched"))

    def step(state: Column, i: Column) -> Column:
        low = F.greatest(i - reach, F.lit(1))
        window = F.substring(state["left"], low, F.least(i + reach, ny) - low + 1)
        char = F.substring(x, i, F.lit(1))

        def taken(at: Column) -> Column:
            place = low + at - 1
            left = F.concat(F.substring(state["left"], F.lit(1), place - 1), F.lit(_TAKEN), F.substring(state["left"], place + 1, ny))
            return F.when(at > 0, F.struct(left.alias("left"), F.concat(state["matched"], char).alias("matched"))).otherwise(state)

        return let(F.instr(window, char), taken)

    def places(word: Column, n: Column) -> Column:
        return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))

    def similarity(state: Column) -> Column:
        m = F.char_length(state["matched"])
        other = F.array_join(F.transform(
            F.filter(places(y, ny), lambda i: F.substring(state["left"], i, F.lit(1)) == _TAKEN), lambda i: F.substring(y, i, F.lit(1))), "")
        swapped = F.size(F.filter(
            places(other, m), lambda i: F.substring(state["matched"], i, F.lit(1)) != F.substring(other, i, F.lit(1))))
        jaro = (m / nx + m / ny + (m - F.floor(swapped / 2)) / m) / 3
        shared = F.greatest(*[
            F.when((nx >= k) & (ny >= k) & (F.substring(x, F.lit(1), F.lit(k)) == F.substring(y, F.lit(1), F.lit(k))), k).otherwise(0)
            for k in range(1, PREFIX + 1)
        ])
        return F.when(m == 0, 0.0).otherwise(let(jaro, lambda j: F.when(j > FROM, j + shared * WEIGHT * (1 - j)).otherwise(j)))

    found = let(F.aggregate(places(x, nx), start, step), similarity)
    return F.when(x.isNotNull() & y.isNotNull(), F.when((nx == 0) & (ny == 0), 1.0).otherwise(found))


def deletion_keys(word: Column, edits: int) -> Column:
    """The word and all that is left of it after up to ``edits`` deletions.  Two words within ``edits`` edits of each
    other share a key."""
    keys = F.array(word)
    for _ in range(edits):
        shorter = F.flatten(F.transform(keys, lambda k: F.when(F.char_length(k) > 0, F.transform(
            F.sequence(F.lit(1), F.char_length(k)),
            lambda i: F.concat(F.substring(k, F.lit(1), i - 1), F.substring(k, i + 1, F.char_length(k))),
        )).otherwise(F.array().cast("array<string>"))))
        keys = F.array_distinct(F.concat(keys, shorter))
    return keys
