"""Near duplicates against all pairs."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import bagminhash
from gleaner.llm._frame import release
from gleaner.llm.bagminhash import deduplicate, near_duplicates, signatures
from gleaner.llm.graph import components


def classes(rows, similarity=0.8):
    import re

    bags = {}
    for d, t in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        size = min(5, len(words))
        bags[d] = Counter(tuple(words[k : k + size]) for k in range(len(words) - size + 1)) if words else Counter()
    parent = {d: d for d, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(bags)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            common, both = sum((bags[a] & bags[b]).values()), sum((bags[a] | bags[b]).values())
            if both and common / both >= similarity:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: root(d) for d in keys}


def corpus():
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(400)]
    rows, number = [], 0
    for _ in range(12):
        base = list(rng.choice(words, int(rng.integers(30, 200))))
        for copy in range(int(rng.integers(1, 7))):
            text = list(base)
            for _ in range(copy):
                text[int(rng.integers(len(text)))] = str(rng.choice(words))
            rows.append((number, " ".join(text)))
            number += 1
    rows += [(900, "One two"), (901, "one, TWO!"), (902, "one"), (903, None), (904, ""), (905, "..."), (906, "a a a a a a a a a a"), (907, "a a a a a a a a a a a"), (908, rows[0][1]), (909, "q " * 20_000)]
    return rows


def test_classes_are_those_of_all_pairs(spark):
    rows = corpus()
    frame = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, id string")
    assert {r[0]: r[1] for r in near_duplicates(frame).collect()} == classes(rows)


def test_a_large_group_around_one_text(spark):
    """Copies that are near the first text but not near each other."""
    base = [f"b{k}" for k in range(104)]
    rows = [(50, " ".join(base))]
    for k in range(30):
        text = list(base)
        text[5 + 3 * k] = f"x{k}"
        text[(40 + 7 * k) % 104] = f"y{k}"
        rows.append((k, " ".join(text)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r[0]: r[1] for r in near_duplicates(frame).collect()} == classes(rows)


def test_one_row_of_each_class_stays(spark):
    rows = corpus()
    rows += [(rows[0][0], rows[0][1]), (None, rows[0][1])]
    frame = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, class string")
    kept = deduplicate(frame)
    assert kept.columns == frame.columns
    found = classes([r for r in rows if r[0] is not None])
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({c for c in found.values()})
    assert kept.where("doc_id is null").count() == 1


def test_shuffles_of_earlier_steps_are_gone(spark, monkeypatch):
    """The links are joined to components before the last candidates are sought; none of those shuffles is kept by then."""
    shuffles = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()
    rows, seen, sought = corpus(), [], bagminhash.prefix_pairs
    monkeypatch.setattr(bagminhash, "prefix_pairs", lambda *a: seen.append(shuffles()) or sought(*a))
    frame = spark.createDataFrame([(d, t) for d, t in rows], "doc_id long, text string")
    release(spark)
    before = shuffles()
    assert {r[0]: r[1] for r in near_duplicates(frame).collect()} == classes(rows)
    assert len(seen) == 1 and seen[0] <= before + 10


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_equal_slots_estimate_the_weighted_similarity():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 62, 60).astype(np.uint64)
    one, two = rng.integers(0, 9, 60), rng.integers(0, 9, 60)
    doc = np.repeat([0, 1], 60)
    keep = np.concatenate([one, two]) > 0
    signature = signatures(doc[keep], np.tile(values, 2)[keep], np.concatenate([one, two])[keep], 2, 4096)
    want = np.minimum(one, two).sum() / np.maximum(one, two).sum()
    assert (signature[0] == signature[1]).mean() == pytest.approx(want, abs=0.03)


def test_components(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, 101), (101, 99), (7, 7), (200, 200), (None, 3)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(frame).collect()}
    assert got == {k: 0 for k in range(31)} | {100: 99, 101: 99, 99: 99, 200: 200}
    assert components(frame.where(F.lit(False))).count() == 0
