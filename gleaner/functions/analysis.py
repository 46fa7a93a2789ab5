"""Analysis chains: text column -> positioned terms.

A chain is data (``Analyzer``); ``Analyzer.tokens`` turns it into one Column of
``array<struct<term, pos>>`` made of built-in functions, so analysis runs in the
scan stage and needs no shuffle.  Internally a text is a list of *slots*: one
slot per position, each holding every term that stands at that position (the
original token and its parts, say).  An emptied slot keeps its position, which
is how removed stop words leave a gap.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.columns import any_of, let, string_array
from gleaner.functions.stemming import ROOTS, stem_terms, stem_word

# Patterns, gaps and limits of the shipped chains.
SPACES = r"\s+"
WORDS = r"[\p{L}\p{N}]+"
RUNS = r"\p{L}+(?:[^\p{L}\p{N}]+\p{L}+)*|\p{N}+(?:[^\p{L}\p{N}]+\p{N}+)*"
PARTS = r"\p{L}+|\p{N}+"
CASE_PARTS = r"\p{Lu}*[^\p{Lu}\P{L}]+|\p{Lu}+|\p{L}+|\p{N}+"
LONE_WORD = r"^[^\p{L}\p{N}]*(\p{L}+|\p{N}+)[^\p{L}\p{N}]*$"
NOT_WORD = r"[^\p{L}\p{N}]+"
POSSESSIVE = r"'[sS]($|[^\p{L}\p{N}])"
#: What may stand inside a token between the letters of a term that is put together from the token's parts.
BETWEEN = r"(?:'s|[^\p{L}\p{N}\s])*"
VALUE_GAP = 100
PROTECTED_WORDS = ("&amp;", "&lt;", "&gt;", "&#039;", "&quot;")


def accent_map() -> dict[str, str]:
    """Latin letters with marks -> base letters, from the Unicode decompositions."""
    out = {}
    for code in range(0x00C0, 0x0180):
        letter = chr(code)
        base = "".join(c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c))
        if base != letter and base.isascii() and base.isalpha():
            out[letter] = base
    # Letters without a decomposition.
    out.update({"Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss", "Ø": "O", "ø": "o", "Ł": "L", "ł": "l"})
    return out


def fold_chars(text: Column, mapping: dict[str, str]) -> Column:
    """Apply a character map: one ``translate`` for 1:1 pairs, ``replace`` for the rest."""
    single = {k: v for k, v in mapping.items() if len(k) == 1 and len(v) == 1}
    for old, new in mapping.items():
        if old not in single:
            text = F.replace(text, F.lit(old), F.lit(new))
    if single:
        text = F.translate(text, "".join(single), "".join(single.values()))
    return text


def whitespace_tokens(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def word_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))


def edge_ngrams(value: Column, low: int = 2, high: int = 25) -> Column:
    """Prefixes of ``low`` to ``high`` characters of the whole lower-cased value."""
    sizes = F.filter(F.sequence(F.lit(low), F.lit(high)), lambda n: n <= F.length(value))
    return F.transform(sizes, lambda n: F.lower(F.substring(value, F.lit(1), n)))


@dataclass(frozen=True)
class Delimiter:
    """Split tokens at non-alphanumerics and letter/digit borders."""

    catenate: bool = True
    keep_original: bool = True
    split_case: bool = False

    def slots(self, token: Column, protected: tuple[str, ...] = ()) -> Column:
        """One token -> its slots (``array<array<string>>``)."""
        clean = F.regexp_replace(token, POSSESSIVE, "$1")
        part_pattern = F.lit(CASE_PARTS if self.split_case else PARTS)

        def run_slots(run: Column) -> Column:
            if not self.catenate:
                return F.transform(F.regexp_extract_all(run, part_pattern, F.lit(0)), lambda p: F.array(p))
            joined = F.regexp_replace(run, NOT_WORD, "")
            return let(
                F.regexp_extract_all(run, part_pattern, F.lit(0)),
                lambda parts: F.transform(
                    parts,
                    lambda p, i: F.when(
                        (i > 0) & (i == F.size(parts) - 1), F.array(p, joined)
                    ).otherwise(F.array(p)),
                ),
            )

        split = F.flatten(F.transform(F.regexp_extract_all(clean, F.lit(RUNS), F.lit(0)), run_slots))
        if self.keep_original:
            split = let(
                split,
                lambda s: F.when(F.size(s) == 0, F.array(F.array(token))).otherwise(
                    F.transform(
                        s, lambda slot, i: F.when(i == 0, F.array_union(F.array(token), slot)).otherwise(slot)
                    )
                ),
            )
        else:
            split = let(split, lambda s: F.when(F.size(s) == 0, F.array(string_array([]))).otherwise(s))
        if not self.split_case:
            # one word between punctuation: a single match finds it
            general = split
            split = let(
                F.regexp_extract(token, LONE_WORD, 1),
                lambda word: F.when(
                    word.isin("", "s", "S"), general
                ).otherwise(F.array(F.array_union(F.array(token), F.array(word)) if self.keep_original else F.array(word))),
            )
        # Most tokens are one plain word: they skip the splitting.
        plain = token.rlike(r"^(?:\p{L}+|\p{N}+)$")
        if self.split_case:
            plain = token.rlike(r"^(?:\p{Lu}?[^\p{Lu}\P{L}]+|\p{N}+)$")
        if protected:
            plain = plain | token.isin(*protected)
        return F.when(plain, F.array(F.array(token))).otherwise(split)


@dataclass(frozen=True)
class Analyzer:
    """One analysis chain; ``query`` holds the overrides of the query side."""

    tokenizer: str = "whitespace"  # whitespace | word | keyword | edge
    char_map: dict[str, str] = field(default_factory=dict, hash=False)
    stopwords: tuple[str, ...] = ()
    delimiter: Delimiter | None = None
    min_length: int = 0
    max_length: int = 0
    lowercase: bool = True
    stemmer: str | None = None
    protected: tuple[str, ...] = ()
    unique: bool = False
    norms: bool = True
    frequencies: bool = True
    synonyms: dict[str, tuple[str, ...]] = field(default_factory=dict, hash=False)

    @property
    def query_side(self) -> "Analyzer":
        changed = self
        if self.delimiter:
            changed = replace(changed, delimiter=replace(self.delimiter, catenate=False))
        if self.tokenizer == "edge":
            changed = replace(changed, tokenizer="keyword")
        return changed

    @property
    def is_plain(self) -> bool:
        """Terms are words of the lower-cased text as they stand."""
        return (
            self.tokenizer in ("whitespace", "word") and self.lowercase
            and not (self.delimiter or self.stemmer or self.char_map or self.stopwords)
        )

    def kept_words(self, text: Column) -> Column:
        """Terms of a plain chain without positions."""
        words = self.words(text)
        if self.min_length or self.max_length:
            kept = self._kept
            words = F.filter(words, lambda w: kept(w))
        return words

    def _roots(self, term: str) -> tuple[str, ...] | None:
        """Strings of which each lower-cased text with the term holds one; None if that isn't known."""
        if self.char_map or not self.lowercase or self.tokenizer not in ("whitespace", "word"):
            return None
        if self.delimiter and self.delimiter.split_case:
            return None
        if self.stemmer is None:
            return (term,)
        roots = ROOTS.get(self.stemmer)
        return (*roots(term), *((term,) if term in self.protected else ())) if roots else None

    def _spread(self, terms: list[str]) -> str | None:
        """A pattern that is found in each lower-cased token with one of the terms."""
        each = [self._roots(t) for t in terms]
        if any(roots is None for roots in each):
            return None
        between = BETWEEN if self.delimiter and self.delimiter.catenate else ""
        return "|".join(between.join(re.sub(r"[^\w\s]", r"\\\g<0>", c) for c in root) for roots in each for root in roots)

    def may_hold(self, text: Column, term: str) -> Column:
        """A cheap test that every text with the term passes."""
        roots = self._roots(term)
        if roots is None:
            return F.lit(True)
        text = F.lower(text)
        held = any_of(F.contains(text, F.lit(root)) for root in roots)
        if self.delimiter and self.delimiter.catenate:
            held = held | text.rlike(self._spread([term]))
        return held

    # -- columns ---------------------------------------------------------
    def words(self, text: Column) -> Column:
        """Tokenize one string; case is folded early unless a step needs it."""
        if self.char_map:
            text = fold_chars(text, self.char_map)
        if self.lowercase and not (self.delimiter and self.delimiter.split_case):
            text = F.lower(text)
        if self.tokenizer == "whitespace":
            return whitespace_tokens(text)
        if self.tokenizer == "word":
            return word_tokens(text)
        if self.tokenizer == "edge":
            return edge_ngrams(text)
        return F.array(text)

    def _kept(self, term: Column) -> Column | None:
        checks = []
        if self.min_length or self.max_length:
            checks.append(F.length(term).between(self.min_length, self.max_length or 2**31 - 1))
        return checks[0] if checks else None

    def _not_stop(self, term: Column) -> Column | None:
        if not self.stopwords:
            return None
        return ~F.lower(term).isin(*[w.lower() for w in self.stopwords])

    def slots(self, text: Column, keep: Callable[[Column], Column] | None = None) -> Column:
        """Slots before stemming: ``array<array<string>>``, of the words to ``keep``."""

        def one(word: Column) -> Column:
            slots = self.delimiter.slots(word, self.protected) if self.delimiter else F.array(F.array(word))
            not_stop = self._not_stop(word)
            if not_stop is not None:
                slots = F.when(not_stop, slots).otherwise(F.array(string_array([])))
            return slots

        words = self.words(text)
        slots = F.flatten(F.transform(F.filter(words, keep) if keep else words, one))
        if self.delimiter and self.delimiter.split_case and self.lowercase:
            slots = F.transform(slots, lambda s: F.transform(s, lambda t: F.lower(t)))
        kept = self._kept
        if self.min_length or self.max_length:
            slots = F.transform(slots, lambda s: F.filter(s, lambda t: kept(t)))
        return slots

    def _plain_tokens(self, text: Column) -> Column:
        """Tokens of chains without a delimiter: every word is its own slot."""
        tokens = F.transform(self.words(text), lambda t, i: F.struct(t.alias("term"), i.alias("pos")))
        for check in (self._not_stop, self._kept):
            if check(F.lit("x")) is not None:
                tokens = F.filter(tokens, lambda x: check(x["term"]))
        return tokens

    def unstemmed_tokens(self, text: Column, multi: bool = False) -> Column:
        if not multi:
            if self.delimiter is None:
                return self._plain_tokens(text)
            slots = self.slots(text)
        else:
            gap = F.array_repeat(string_array([]), VALUE_GAP)
            slots = F.flatten(F.transform(text, lambda v: F.concat(self.slots(v), gap)))
        return F.flatten(
            F.transform(
                slots,
                lambda s, i: F.transform(s, lambda t: F.struct(t.alias("term"), i.alias("pos"))),
            )
        )

    def tokens(self, text: Column, multi: bool = False) -> Column:
        """``array<struct<term string, pos int>>`` of a string (or string array), not stemmed yet."""
        tokens = self.unstemmed_tokens(text, multi)
        return without_repeats(tokens) if self.unique else tokens

    def stemmed(self, tokens: Column) -> Column:
        """Stem a token column.  ``tokens`` must be a column of its own: the Python
        step then receives the finished terms of a batch and nothing else."""
        stems = stem_terms(F.transform(tokens, lambda x: x["term"]), self.stemmer, frozenset(self.protected))
        pairs = F.arrays_zip(stems.alias("term"), F.transform(tokens, lambda x: x["pos"]).alias("pos"))
        return without_repeats(
            F.transform(pairs, lambda x: F.struct(x["term"].alias("term"), x["pos"].alias("pos")))
        )

    def tokens_like(self, text: Column, terms: list[str]) -> Column | None:
        """Those of a text's tokens that come from words that may hold one of the terms, with positions among
        themselves; None if that isn't known of the chain."""
        pattern = self._spread(terms) if self.delimiter else None
        if pattern is None:
            return None
        slots = self.slots(text, lambda w: w.rlike(pattern))
        return F.flatten(F.transform(slots, lambda s, i: F.transform(s, lambda t: F.struct(t.alias("term"), i.alias("pos")))))

    # -- query side ------------------------------------------------------
    def query_slots(self, spark, texts: list[str]) -> list[list[list[str]]]:
        """Analyze short query strings: per text its non-empty slots, in order.

        Evaluated by Spark on literals, so both sides share one definition.
        Slots emptied by a filter stay in the list to keep phrase offsets.
        """
        chain = self.query_side
        if not texts:
            return []
        row = spark.sql("SELECT 1 AS one").select(
            *[chain.slots(F.lit(t)).alias(f"t{i}") for i, t in enumerate(texts)]
        ).first()
        out = []
        for i in range(len(texts)):
            slots = [list(s) for s in row[f"t{i}"]]
            slots = [self._expand(s) for s in slots]
            if self.stemmer:
                keep = frozenset(self.protected)
                slots = [list(dict.fromkeys(stem_word(self.stemmer, t, keep) for t in s)) for s in slots]
            while slots and not slots[-1]:
                slots.pop()
            out.append(slots)
        return out

    def _expand(self, slot: list[str]) -> list[str]:
        extra = [s.lower() for t in slot for s in self.synonyms.get(t, ())]
        return list(dict.fromkeys(slot + extra))


def without_repeats(tokens: Column) -> Column:
    """Drop a token equal to one of the two before it.

    Equal tokens share a position, and a position holds a handful of neighbouring
    tokens, so this is the linear form of a distinct over the whole list.
    """
    return let(
        tokens,
        lambda all_: F.filter(
            all_,
            lambda x, i: ~F.coalesce((F.get(all_, i - 1) == x) | (F.get(all_, i - 2) == x), F.lit(False)),
        ),
    )


def group_terms(tokens: Column) -> Column:
    """Tokens -> ``array<struct<term, positions>>``, one entry per distinct term.

    Sorting inside the row and cutting the sorted list at term borders keeps
    this linear after the sort and free of any shuffle.
    """

    def cut(sorted_tokens: Column) -> Column:
        def entry(start: Column, end: Column) -> Column:
            first = F.get(sorted_tokens, start)
            several = F.transform(F.slice(sorted_tokens, start + 1, end - start), lambda x: x["pos"])
            positions = F.when(end - start == 1, F.array(first["pos"])).otherwise(several)
            return F.struct(first["term"].alias("term"), positions.alias("positions"))

        starts = F.filter(
            F.transform(sorted_tokens, lambda x, i: i),
            lambda i: (i == 0) | (F.get(sorted_tokens, i - 1)["term"] != F.get(sorted_tokens, i)["term"]),
        )
        return let(
            starts,
            lambda b: F.transform(
                b, lambda s, k: entry(s, F.coalesce(F.get(b, k + 1), F.size(sorted_tokens)))
            ),
        )

    return let(F.sort_array(tokens), cut)


# Chains by name.  New ones are added with ``register_analyzer``.
_DELIMIT = Delimiter(catenate=True, keep_original=True)
ANALYZERS: dict[str, Analyzer] = {
    "text": Analyzer(
        delimiter=_DELIMIT, min_length=2, max_length=100, stemmer="english",
        protected=PROTECTED_WORDS, unique=True,
    ),
    "text_words": Analyzer(
        delimiter=_DELIMIT, min_length=2, max_length=100, protected=PROTECTED_WORDS, unique=True,
    ),
    "text_und": Analyzer(
        delimiter=Delimiter(catenate=True, keep_original=False), min_length=2, max_length=100,
        protected=PROTECTED_WORDS,
    ),
    "text_ws": Analyzer(norms=False),
    "text_word": Analyzer(tokenizer="word", min_length=2, max_length=100),
    "edge": Analyzer(tokenizer="edge", norms=False, frequencies=False),
    "spell": Analyzer(tokenizer="word", min_length=4, max_length=20, unique=True),
    "text_de": Analyzer(
        delimiter=Delimiter(catenate=True, keep_original=True, split_case=True),
        stemmer="german", protected=PROTECTED_WORDS, unique=True,
    ),
}


def register_analyzer(name: str, analyzer: Analyzer) -> None:
    ANALYZERS[name] = analyzer


def analyzer(name: str | Analyzer) -> Analyzer:
    return name if isinstance(name, Analyzer) else ANALYZERS[name]
