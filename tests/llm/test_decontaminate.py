import random
import re
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from gleaner.llm import decontaminate as D
from gleaner.llm.decontaminate import decontaminate, find_matches, hit_words, op6_decontaminate

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size=13):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for k in range(len(w) - n + 1) if w else ():
            windows.setdefault(tuple(w[k : k + n]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for d, text in docs:
        w, hits, found = words(text), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if (here := windows.get(tuple(w[k : k + n]))) is not None:
                    hits.update(range(k, k + n))
                    found |= here
        out.append((d, len(w), len(hits), sorted(str(i) for i in found if i is not None)))
    return sorted(out, key=repr)


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog and then it runs away from there again"), (2, "one-two"), (3, "unique"), (4, ""), (5, None), (6, "..."),
    (7, "a a a a a a a a a a a a a a"), (2, "one-two"), (None, "nameless item"),
]
DOCS = [
    (1, "x THE QUICK brown fox jumps over the lazy dog and then it runs away from there again y"), (2, "quick brown fox jumps over the lazy dog and then it runs away from"),
    (3, "quick brown fox jumps over the lazy dog and then it runs away"), (4, "one two one two"), (5, None), (6, ""), (7, "uniquely"), (8, "Unique! " * 3), (9, "a " * 40),
    (1, "one"), (10, "two\u00e9 one two"), (11, "nameless"), (12, "a nameless item"), (13, "filler " * 50_000 + "one two"),
]


def run(spark, docs, items):
    frame = spark.createDataFrame([(d, t, "x", "y") for d, t in docs], "doc_id long, text string, matches string, n_words string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found, n_words, matches = find_matches(frame, bench)
    assert found.columns[:4] == frame.columns
    rows = found.select("doc_id", F.col(n_words), hit_words(F.col(matches)), F.transform(matches, lambda m: m["item_id"])).collect()
    return sorted(((r[0], r[1], r[2], sorted({i for i in r[3] if i is not None})) for r in rows), key=repr), decontaminate(frame, bench)


def test_same_as_brute_force(spark):
    got, clean = run(spark, DOCS, ITEMS)
    want = brute(DOCS, ITEMS)
    assert got == want
    assert clean.columns == ["doc_id", "text", "matches", "n_words"]
    assert clean.count() == sum(not (h > 0 and 20 * h >= n) for _, n, h, _ in want)


def test_a_benchmark_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_BYTES", 200)
    assert run(spark, DOCS, ITEMS)[0] == brute(DOCS, ITEMS)


def test_empty_tables(spark):
    assert run(spark, DOCS, [])[0] == brute(DOCS, [])
    assert run(spark, [], ITEMS)[0] == []


def test_longest_matches_and_places(spark):
    frame = spark.createDataFrame([DOCS[0]], "doc_id long, text string")
    found, _, matches = find_matches(frame, spark.createDataFrame(ITEMS[:1], "item_id long, text string"))
    assert [m.asDict() for m in found.first()[matches]] == [{"item_id": "1", "start": 1, "item_start": 0, "n_words": 17}]


def longest_plain(doc, item, size):
    """Brute force: the longest common run from the left, its first place in the item, on from the next window."""
    out, k = [], 0
    starts = range(len(item) - size + 1)
    while k + size <= len(doc):
        best = max((next((n for n in range(min(len(doc) - k, len(item) - s), size - 1, -1) if doc[k : k + n] == item[s : s + n]), 0), -s) for s in starts)
        if best[0]:
            out.append((k, -best[1], best[0]))
        k += max(1, best[0] - size + 1)
    return out


def matched(docs, items, size):
    tests = D.TestSuffixes(list(enumerate(items)), size)
    hashes, rows = D.word_hashes(D.pa.RecordBatch.from_pydict({"t": D.pa.array(docs)}), "t")
    return D.longest(D.occurrences(hashes, rows, tests), rows, tests)


def test_longest_matches_are_those_of_brute_force(monkeypatch):
    pick = random.Random(3)
    for shard in (1 << 18, 7):
        monkeypatch.setattr(D, "SHARD", shard)
        for _ in range(60):
            docs, items = ([" ".join(pick.choices("abc"[: pick.randint(1, 3)], k=pick.randint(0, 30))) for _ in range(4)] for _ in range(2))
            for doc, found in zip(docs, matched(docs, items, 4), strict=True):
                got = sorted((m["item_id"], m["start"], m["item_start"], m["n_words"]) for m in found)
                assert got == sorted((k, *m) for k, i in enumerate(items) if i for m in longest_plain(doc.split(), i.split(), min(4, len(i.split()))))


def test_equal_words_cost_their_number():
    tracemalloc.start()
    found = matched(["a " * 20_000, "b " + "a " * 5_000 + "b"], ["a " * 20_000, "a " * 19_999], 13)
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()
    assert [[(m["item_id"], m["start"], m["item_start"], m["n_words"]) for m in f] for f in found] == [
        [(0, 0, 0, 20_000), (1, 0, 0, 19_999), (1, 19_987, 0, 13)], [(0, 1, 0, 5_000), (1, 1, 0, 5_000)],
    ]


def test_suffix_array():
    for values in ([1], [2, 1, 2, 1, 2], [0] * 50):
        assert D.suffix_array(np.array(values)).tolist() == sorted(range(len(values)), key=lambda k, v=values: v[k:])


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(k, "text").collect()] for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    rows = op6_decontaminate(spark, sf).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in rows), key=repr) == sorted(((d, n, h, len(i)) for d, n, h, i in brute(docs, items)), key=repr)
