"""Keyword expressions: trees of phrases with AND, OR and negation.

Every key is a phrase; a key of one word is a phrase of length one.  A key
matches a document when it occurs in any of the searched fields.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.columns import all_of, any_of


@dataclass(frozen=True)
class Keys:
    items: tuple = ()
    conjunction: str = "AND"
    negated: bool = False

    def phrases(self, positive_only: bool = False) -> list[str]:
        """Distinct phrases in order; optionally only those that add to the score."""
        if positive_only and self.negated:
            return []
        out: list[str] = []
        for item in self.items:
            out += [item] if isinstance(item, str) else item.phrases(positive_only)
        return list(dict.fromkeys(out))

    def evaluate(self, matched: Callable[[str], object], every, some, negate):
        """Fold the tree with the given connectives; None where it holds no key."""
        parts = []
        for item in self.items:
            part = matched(item) if isinstance(item, str) else item.evaluate(matched, every, some, negate)
            if part is not None:
                parts.append(part)
        if not parts:
            return None
        joined = some(parts) if self.conjunction == "OR" else every(parts)
        return negate(joined) if self.negated else joined

    def column(self, matched: Callable[[str], Column]) -> Column | None:
        return self.evaluate(matched, all_of, any_of, lambda c: ~c)

    def needs_a_hit(self, ignored: Callable[[str], bool] = lambda p: False) -> bool:
        """False where a document without any of the keys can match."""
        return not self.evaluate(lambda p: None if ignored(p) else False, all, any, lambda b: not b)


def _clean(items) -> tuple:
    out = []
    for item in items:
        if isinstance(item, str):
            item = item.strip()
        if item != "" and item is not None:
            out.append(item)
    return tuple(out)


def every(*items) -> Keys:
    return Keys(_clean(items), "AND")


def some(*items) -> Keys:
    return Keys(_clean(items), "OR")


def not_every(*items) -> Keys:
    return Keys(_clean(items), "AND", True)


def none(*items) -> Keys:
    return Keys(_clean(items), "OR", True)


def parse_words(text: str) -> Keys:
    """Plain user input: all words must match."""
    return every(*text.split())


def as_keys(keys: str | Keys | None) -> Keys:
    if keys is None:
        return Keys()
    return parse_words(keys) if isinstance(keys, str) else keys


def phrase_frequency(slots: list[list[Column]]) -> Column:
    """How often a phrase occurs, given per offset the position lists of the terms accepted there.

    Each list is shifted back by its offset; starts common to all offsets are
    hits.  ``array_intersect`` hashes, so long lists stay linear.
    """
    starts = None
    for offset, alternatives in enumerate(slots):
        if not alternatives:
            continue
        here = alternatives[0]
        for more in alternatives[1:]:
            here = F.array_union(here, more)
        if offset:
            here = F.transform(here, lambda p: p - F.lit(offset))
        starts = here if starts is None else F.array_intersect(starts, here)
    return F.lit(0) if starts is None else F.size(starts)
