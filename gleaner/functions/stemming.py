"""Stemming of term arrays.

The English algorithm is the published "Porter2" one; the German one is the
published light stemmer of the Universite de Neuchatel group.  Both work on one
lower-case word.  Spark calls them through ``stem_terms``: an Arrow UDF over
arrays of terms that dictionary-encodes each batch first, so every distinct
word of a batch is stemmed once however often it occurs.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Ship the functions below inside the UDF, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The word lists and suffixes of the published Porter2 algorithm.
_IRREGULAR = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli",
    "only": "onli", "singly": "singl", "sky": "sky", "news": "news",
    "howe": "howe", "atlas": "atlas", "cosmos": "cosmos", "bias": "bias",
    "andes": "andes",
}
_KEPT_AFTER_PLURAL = {
    "inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed",
}
_REGION_PREFIX = ("gener", "commun", "arsen")
_STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance",
    "abli": "able", "entli": "ent", "ization": "ize", "izer": "ize",
    "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al",
    "fulness": "ful", "ousli": "ous", "ousness": "ous", "iveness": "ive",
    "iviti": "ive", "biliti": "ble", "bli": "ble", "fulli": "ful",
    "lessli": "less", "ogi": "og", "li": "",
}
_STEP3 = {
    "ational": "ate", "tional": "tion", "alize": "al", "icate": "ic",
    "iciti": "ic", "ical": "ic", "ful": "", "ness": "", "ative": "",
}
_STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion",
)
_DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")

_REGION = re.compile(r"[aeiouy][^aeiouy]")
_SHORT_END = re.compile(r"(?:^[aeiouy][^aeiouy]|[^aeiouy][aeiouy][^aeiouywxY])$")
_VOWEL = re.compile(r"[aeiouy]")


def _region(word: str, start: int) -> int:
    found = _REGION.search(word, start)
    return found.end() if found else len(word)


def _longest(word: str, suffixes) -> str | None:
    hits = [s for s in suffixes if word.endswith(s)]
    return max(hits, key=len) if hits else None


def stem_english(word: str) -> str:
    if len(word) <= 2:
        return word
    if word in _IRREGULAR:
        return _IRREGULAR[word]
    word = word.lstrip("'")
    word = re.sub(r"(^|[aeiouy])y", r"\1Y", word)
    prefix = next((p for p in _REGION_PREFIX if word.startswith(p)), None)
    r1 = len(prefix) if prefix else _region(word, 0)
    r2 = _region(word, r1)

    # possessives, then plurals
    word = re.sub(r"('s'|'s|')$", "", word)
    if word.endswith("sses"):
        word = word[:-2]
    elif word.endswith(("ied", "ies")):
        word = word[:-2] if len(word) > 4 else word[:-1]
    elif word.endswith("s") and not word.endswith(("us", "ss")) and _VOWEL.search(word[:-2]):
        word = word[:-1]
    if word in _KEPT_AFTER_PLURAL:
        return word

    # past tense and participles
    ending = _longest(word, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    if ending in ("eed", "eedly"):
        if len(word) - len(ending) >= r1:
            word = word[: -len(ending)] + "ee"
    elif ending and _VOWEL.search(word[: -len(ending)]):
        word = word[: -len(ending)]
        if word.endswith(("at", "bl", "iz")):
            word += "e"
        elif word.endswith(_DOUBLES):
            word = word[:-1]
        elif r1 >= len(word) and _SHORT_END.search(word):
            word += "e"

    if len(word) > 2 and word[-1] in "yY" and word[-2] not in "aeiouy":
        word = word[:-1] + "i"

    # derivational suffixes, in three passes
    ending = _longest(word, _STEP2)
    if ending and len(word) - len(ending) >= r1:
        base = word[: -len(ending)]
        if ending == "ogi":
            word = base + "og" if base.endswith("l") else word
        elif ending == "li":
            word = base if base[-1:] in tuple("cdeghkmnrt") else word
        else:
            word = base + _STEP2[ending]
    ending = _longest(word, _STEP3)
    if ending and len(word) - len(ending) >= r1:
        if ending != "ative" or len(word) - len(ending) >= r2:
            word = word[: -len(ending)] + _STEP3[ending]
    ending = _longest(word, _STEP4)
    if ending and len(word) - len(ending) >= r2:
        base = word[: -len(ending)]
        if ending != "ion" or base.endswith(("s", "t")):
            word = base

    if word.endswith("e"):
        cut = len(word) - 1
        if cut >= r2 or (cut >= r1 and not _SHORT_END.search(word[:-1])):
            word = word[:-1]
    elif word.endswith("ll") and len(word) - 1 >= r2:
        word = word[:-1]
    return word.replace("Y", "y")


def english_root(stem: str) -> tuple[str, ...]:
    """Strings of which each word with this stem holds one.

    The steps cut a word's end, and put nothing in its place but a last "i" or "e", or "le" for "iliti", whose "e" may go.
    """
    if stem.endswith(("le", "ee")):
        root = stem[:-2]
    elif stem.endswith(("e", "i", "bl")):
        root = stem[:-1]
    else:
        root = stem
    return (root, *[w for w, s in _IRREGULAR.items() if s == stem])


_GERMAN_MARKS = str.maketrans("äàáâöòóôïìíîüùúû", "aaaaooooiiiiuuuu")


def stem_german(word: str) -> str:
    """Light stemming: marks folded, then one inflection and one plural ending."""
    word = word.translate(_GERMAN_MARKS)
    size = len(word)
    if size > 5 and word.endswith("ern"):
        word = word[:-3]
    elif size > 4 and word.endswith(("em", "en", "er", "es")):
        word = word[:-2]
    elif size > 3 and word.endswith("e"):
        word = word[:-1]
    elif size > 3 and re.search(r"[bdfghklmnt]s$", word):
        word = word[:-1]
    size = len(word)
    if size > 5 and word.endswith("est"):
        word = word[:-3]
    elif size > 4 and word.endswith(("er", "en")):
        word = word[:-2]
    elif size > 4 and re.search(r"[bdfghklmnt]st$", word):
        word = word[:-2]
    return word


STEMMERS: dict[str, Callable[[str], str]] = {"english": stem_english, "german": stem_german}


#: By stemmer, of a stem: strings of which each word with this stem holds one.  Without an entry nothing is known.
ROOTS: dict[str, Callable[[str], tuple[str, ...]]] = {"english": english_root}


def register_stemmer(name: str, stem: Callable[[str], str], roots: Callable[[str], tuple[str, ...]] | None = None) -> None:
    """Add a plug-in stemmer: a function from one lower-case word to its stem, and one from a stem to strings of which
    each of its words holds one."""
    STEMMERS[name] = stem
    ROOTS.pop(name, None)
    if roots is not None:
        ROOTS[name] = roots


def stem_word(name: str, word: str, protected: frozenset[str] = frozenset()) -> str:
    return word if word in protected else STEMMERS[name](word)


_known: dict[str, tuple[Callable, dict[str, str]]] = {}  # by name: the stemmer and the stems this worker has found
REMEMBERED = 500_000


def _stems(name: str, stem: Callable[[str], str], words: list) -> list:
    owner, known = _known.get(name, (None, {}))
    if owner is not stem or len(known) > REMEMBERED:
        known = {}  # another function under the same name has other stems
        _known[name] = (stem, known)
    for w in words:
        if w is not None and w not in known:
            known[w] = stem(w)
    return [None if w is None else known[w] for w in words]


def stem_terms(terms: Column, name: str, protected: frozenset[str] = frozenset()) -> Column:
    """Stem every string of an ``array<string>`` column."""
    stem = STEMMERS[name]

    @F.arrow_udf("array<string>")
    def apply(batch: pa.Array) -> pa.Array:
        coded = batch.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        found = _stems(name, stem, words)
        stems = pa.array([w if w in protected else s for w, s in zip(words, found, strict=True)], type=pa.string())
        sizes = batch.value_lengths().fill_null(0).to_numpy()
        offsets = pa.array([0, *sizes.cumsum()], type=pa.int32())
        return pa.ListArray.from_arrays(offsets, stems.take(coded.indices))

    # Kept where it stands: a filter on stems must not be pushed below, which
    # would stem the same text twice.
    return apply.asNondeterministic()(terms)
