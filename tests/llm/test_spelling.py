"""Neighbours, forms and roots against comparing all pairs; words against counting them one by one."""

import random
import re
import zlib
from collections import Counter

import pytest

from gleaner.llm.spelling import damaged_words, near_words, spelling_variants


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(counts, ratio=5):
    forms = {}
    for w, n in counts.items():
        near = sorted((-m, v) for v, m in counts.items() if one_edit(w, v))
        ok = near and -near[0][0] >= ratio * n
        forms[w] = (near[0][1] if ok else None, n, len(near), -near[0][0] if ok else None)
    out = []
    for w, (form, n, near, m) in forms.items():
        root = w
        while forms[root][0]:
            root = forms[root][0]
        out.append((w, form, root, n, near, m))
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    words = {"".join(rng.choices("abé" if seed else "abcdefgh\U0001f600", k=rng.randint(1, 6))) for _ in range(250)}
    counts = {w: rng.choice([1, 1, 2, 5, 5, 10, 25, 30, 150, 1000]) for w in words}
    rows = [(w, n) for w, n in counts.items()] + [(None, 4), ("", 9)]
    got = spelling_variants(spark.createDataFrame(rows, "word string, n long").repartition(3))
    assert sorted(map(tuple, got.collect())) == brute(counts)


def test_runs_ties_and_repeats(spark):
    rows = [("aab", 3), ("ab", 7), ("aaab", 7), ("aac", 7), ("ab", None), ("aab", 2), ("a\0b", 9)]
    got = {r["word"]: tuple(r)[1:] for r in near_words(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert got["aab"] == (5, 3, "aaab", 7)  # equal counts: by code points
    assert got["ab"] == (7, 1, "aab", 5) and got["a\0b"] == (9, 0, None, None)


def test_a_hub_of_many_letters(spark):
    words = {"stem" + chr(0x4E00 + i): 1 for i in range(400)} | {"stem": 1000}
    got = {r["word"]: r for r in spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert got["stem"]["n_near"] == 400 and all(r["root"] == "stem" and r["n_near"] == 400 for w, r in got.items())


def test_empty_and_bad(spark):
    nothing = spark.createDataFrame([], "word string, n long")
    assert spelling_variants(nothing).collect() == []
    with pytest.raises(ValueError, match="ratio"):
        spelling_variants(nothing, ratio=1)


def test_words(spark):
    texts = [(1, "Größe GRÖßE größe, größeren×größe ÀÿZzzzz x"), (2, None), (None, "größere " * 3), (3, ""), (4, "letters " * 4000)]
    texts += [(i, " ".join(f"wort{chr(97 + i % 4)}{chr(97 + j)}xyz" for j in range(20))) for i in range(5, 60)]
    counts = Counter()
    for d, t in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    want = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    got = damaged_words(spark.createDataFrame([(d, t, 1) for d, t in texts], "doc_id long, text string, n int"))
    assert {r[0]: r[1] for r in got.collect()} == want and len(want) > 10
