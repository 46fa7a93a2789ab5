"""The ratio table against a direct computation; held-out accuracy; edge cases."""

from collections import Counter
from math import log

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import toxicity as X
from gleaner.llm.toxicity import CLASS_DISCOUNTS, DISCOUNT, ORDER, count_sequences, drop_toxic, fit, op9_toxicity, ratios, score

TEXTS = [("you utter moron", 1), ("what a moron you are", 1), ("a fine day", 0), ("what a day you have", 0), ("the more the better, more", 0), (None, 0), ("", 1)]


def direct(texts):
    """ln P(toxic) / P(ordinary) of each sequence seen, from the definition."""
    counts = {0: Counter(), 1: Counter()}
    for text, label in texts:
        for word in set("".join(c if c.isalnum() else " " for c in (text or "").lower()).split()):
            padded = " " * (ORDER - 1) + word
            counts[label].update(padded[k : k + ORDER] for k in range(len(word)))
    both = counts[0] + counts[1]
    kinds = {ORDER: {g: 1 for g in both}}
    for n in range(ORDER - 1, 0, -1):
        kinds[n] = Counter(g[1:] for g in kinds[n + 1])

    def shared(g):
        if not g:
            return 1 / 256
        same = [x for x in kinds[len(g)] if x[:-1] == g[:-1]]
        total = sum(kinds[len(g)][x] for x in same)
        return (kinds[len(g)][g] - DISCOUNT + DISCOUNT * len(same) * shared(g[1:])) / total

    def off(n):
        return 0 if n == 0 else CLASS_DISCOUNTS[min(n, 3) - 1]

    out = {}
    for g in both:
        same = [x for x in both if x[:-1] == g[:-1]]
        pooled = (both[g] - DISCOUNT + DISCOUNT * len(same) * shared(g[1:])) / sum(both[x] for x in same)
        chance = []
        for label in (1, 0):
            total = sum(counts[label][x] for x in same)
            rest = sum(off(counts[label][x]) for x in same) / total if total else 1.0
            chance.append((max(counts[label][g] - off(counts[label][g]), 0) / total if total else 0) + rest * pooled)
        out[g] = log(chance[0] / chance[1])
    return out


def test_ratios_are_those_of_the_definition(spark):
    frame = spark.createDataFrame(TEXTS, "t string, y int").withColumn("t", F.coalesce("t", F.lit("")))
    rows = ratios(count_sequences(frame)).where("gram is not null").collect()
    got = {r.gram.to_bytes(ORDER, "big").decode(): r.ratio for r in rows}
    want = direct(TEXTS)
    assert got.keys() == want.keys()
    assert all(got[g] == pytest.approx(want[g], abs=1e-9) for g in want)


def held_out(rows, labels):
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    some = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    hits = [s >= X.THRESHOLD for s, y in some if y]
    return np.mean(hits), np.mean([s >= X.THRESHOLD for s, y in some if not y])


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = op9_toxicity(spark, sf).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    caught, wrong = held_out(rows, spark.read.parquet(f"{sf}/labels.parquet"))
    assert caught >= 0.7 and wrong <= 0.05


def small(spark):
    rng = np.random.default_rng(1)
    words = ["the", "day", "and", "fine", "sun", "water", "road", "more", "house"]
    rows = []
    for k in range(400):
        text = list(rng.choice(words, 30))
        if k % 4 == 0:
            text[5], text[20] = "moron", "idiot"
        rows.append((k, " ".join(text), "x", int(k % 4 == 0)))
    docs = spark.createDataFrame([r[:3] for r in rows] + [(900, None, "x"), (901, "", "x"), (902, "moron " * 40_000, "x"), (None, "idiot", "x"), (3, rows[3][1], "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows] + [(5000, 1), (1, None), (None, 1), (4, 1)], "doc_id long, toxic int")
    return docs, labels


def test_scores_of_odd_rows(spark):
    docs, labels = small(spark)
    found, name = score(docs, fit(docs, labels))
    rows = found.collect()
    assert len(rows) == docs.count() and found.columns == [*docs.columns, name]
    by_id = {r.doc_id: r[name] for r in rows}
    assert by_id[902] > 0.7 and by_id[0] > 0.7 > by_id[1] and by_id[900] == by_id[901] < 0.7
    clean = drop_toxic(docs, labels)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {d for d in by_id if by_id[d] < 0.7}


def test_a_table_in_blocks_scores_the_same(spark, monkeypatch):
    docs, labels = small(spark)
    one, name = score(docs, fit(docs, labels))
    monkeypatch.setattr(X, "TABLE", 50)
    model = fit(docs, labels)
    assert len(model.tables) > 1
    two, _ = score(docs, model)
    monkeypatch.setattr(X, "HELD", 2)
    three, _ = score(docs, model)
    assert sum(b.sent is not None for b in model.tables) <= 2
    a, b, c = ({(r.doc_id, r.text): r[name] for r in f.collect()} for f in (one, two, three))
    assert a.keys() == b.keys() == c.keys() and all(pytest.approx(a[k], abs=1e-6) == b[k] and pytest.approx(a[k], abs=1e-6) == c[k] for k in a)


def test_features_are_those_of_the_definition():
    words = np.array([2.0, -3.0, 5.0, 0.5, *[1.5] * 60, -1.0])
    rows = np.array([0, 4, 4, 64, 65])
    got = X.features(words, rows)
    for k, (a, b) in enumerate(zip(rows[:-1], rows[1:])):
        own = words[a:b].tolist()
        want = [0.0, *[log(X.FLOOR)] * 3]
        if own:
            size = min(X.WINDOW, len(own))
            above = [max(r - 1, 0) for r in own]
            peak = max(sum(above[s : s + size]) / size for s in range(len(own) - size + 1))
            far = sum(max(r - float(np.median(own)) - 3, 0) for r in own) / len(own)
            want = [sum(own) / len(own), *[log(x + X.FLOOR) for x in (sum(above) / len(own), far, peak)]]
        assert got[k].tolist() == pytest.approx(want, abs=1e-9)


def test_without_labels_or_rows(spark):
    docs, labels = small(spark)
    found, name = score(docs, fit(docs, labels.where("toxic = 0")))
    assert {r[name] for r in found.collect()} == {0.5}
    assert score(docs.limit(0), fit(docs.limit(0), labels))[0].count() == 0
