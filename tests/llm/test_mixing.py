"""Water-filling against rounds of resharing; sampling against its targets."""

import re

from pyspark.sql import functions as F

from gleaner.llm import mixing
from gleaner.llm.mixing import mix, repeated, targets


def rounds(sizes, weights=(5, 2, 1), epochs=3):
    """Share by weight, clamp, share the excess again, until nothing is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    fixed, left, free = {}, float(sum(sizes.values())), set(order)
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > epochs * sizes[s]}
        if not over:
            return fixed | {s: left * weight[s] / total for s in free}
        for s in over:
            fixed[s] = float(epochs * sizes[s])
            left -= fixed[s]
        free -= over
    return fixed


def test_targets_are_those_of_the_rounds(spark):
    for sizes in ({"a": 10, "b": 1000, "c": 3000, None: 7, "d": 0}, {"x": 5}, {"a": 1, "b": 1, "c": 1}, {"é": 400, "z": 2, "Z": 90, "": 10}):
        frame = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
        got = {r.source: r.target for r in targets(frame, (5, 2, 1), 3).collect()}
        want = rounds(sizes)
        assert got.keys() == want.keys()
        assert all(abs(got[s] - want[s]) < 1e-6 for s in want)


def docs(spark):
    rows = [(k, " ".join(["w"] * (k % 13)), f"s{k % 4}" if k % 9 else None, "clash") for k in range(300)]
    rows += [(500, None, "s1", "c"), (501, "", None, "c"), (502, "long " * 30_000, "s2", "c"), (7, rows[7][1], rows[7][2], "c"), (None, "a\u00a0b c", "s0", "c")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string")


def test_words_taken_meet_the_targets(spark):
    frame = docs(spark)
    found, names = mix(frame)
    rows = found.select("source", "text", *[F.col(names[n]).alias("_" + n) for n in names]).collect()
    assert len(rows) == frame.count() and found.columns[:4] == frame.columns
    taken, goal = {}, {}
    for r in rows:
        assert r._size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        words = r._whole * r._size + r._part
        assert 0 <= words <= 3 * r._size
        taken[r.source] = taken.get(r.source, 0) + words
        goal[r.source] = r._target
    assert all(abs(taken[s] - goal[s]) <= 1 for s in goal)
    again = mix(frame.repartition(5))[0].select("doc_id", "source", "text", names["whole"], names["part"])
    assert sorted(map(repr, again.collect())) == sorted(map(repr, found.select(again.columns).collect()))


def test_more_buckets_change_nothing(spark, monkeypatch):
    def taken():
        found, names = mix(docs(spark))
        return sorted(map(repr, found.select("doc_id", "source", "text", names["whole"], names["part"]).collect()))

    few = taken()
    monkeypatch.setattr(mixing, "EDGE_ROWS", 1)
    monkeypatch.setattr(mixing, "BUCKET_BITS", 0)
    assert mixing.bucket_bits(300) == 9 and taken() == few
    monkeypatch.setattr(mixing, "EDGE_ROWS", 1000)
    assert mixing.bucket_bits(300) == 0 and taken() == few


def test_rows_are_repeated_and_cut(spark):
    frame = docs(spark).withColumn("n_chars", F.char_length("text").cast("long"))
    out = repeated(frame)
    assert out.columns == frame.columns and out.dtypes == frame.dtypes
    found, names = mix(frame)
    want = found.agg(F.sum(F.col(names["whole"]) * F.col(names["size"]) + F.col(names["part"]))).first()[0]
    count = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    assert out.agg(F.sum(count)).first()[0] == want
    assert out.where("n_chars <> char_length(text)").count() == 0


def test_empty_table(spark):
    assert mix(docs(spark).limit(0))[0].count() == 0


def test_main_path_has_no_python(spark):
    plan = mix(docs(spark))[0]._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
