"""Repeat removal against brute force over all strings."""

import hashlib

import numpy as np
import pytest

from gleaner.llm.repeats import LENGTH, intervals, maximal_groups, without_repeats

SCHEMA = "doc_id long, text string, n_bytes string"


def brute(rows):
    """What the definition says, by a table of all LENGTH-byte strings."""
    texts = [(d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, t in sorted((x for x in texts if x[0] is not None)):
        for i in range(len(t) - LENGTH + 1):
            first.setdefault(t[i : i + LENGTH], d)
    out = []
    for d, t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - LENGTH + 1):
            if d is not None and first[t[i : i + LENGTH]] < d:
                gone[i : i + LENGTH] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((d, len(t), int(gone.sum()), runs, np.frombuffer(t, np.uint8)[~gone].tobytes()))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    frame = spark.createDataFrame([(d, t, "x") for d, t in rows], SCHEMA)
    return sorted(
        ((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.removed), len(r.removed), bytes(r.kept)) for r in without_repeats(frame, **options).collect()),
        key=repr,
    )


def corpus(seed=3, count=60):
    rng = np.random.default_rng(seed)

    def noise(n):
        return "".join(rng.choice(list("abé \n"), n))

    passages = [noise(int(n)) for n in (50, 51, 60, 120, 400)]
    rows = []
    for k in range(count):
        parts = [noise(int(rng.integers(0, 90)))]
        for _ in range(int(rng.integers(0, 3))):
            p = passages[int(rng.integers(len(passages)))]
            parts += [p[: int(rng.integers(40, len(p) + 1))], noise(int(rng.integers(0, 40)))]
        rows.append((int(k * 7 % count), "".join(parts)))
    rows += [(100, rows[0][1]), (101, rows[0][1]), (102, None), (103, ""), (104, "x" * 500), (105, "x" * 49), (106, "x" * 50)]
    return rows + [(None, rows[0][1]), (100, rows[1][1]), (100, rows[0][1]), (107, "\0" * 70 + "y"), (108, "\0" * 60)]


@pytest.mark.parametrize("hot", [100_000, 2])
def test_same_as_brute_force(spark, hot):
    rows = corpus()
    assert found(spark, rows, hot=hot) == brute(rows)


def test_a_passage_in_all_texts_and_a_long_text(spark):
    passage = "the same line of more than fifty bytes, over and over. "
    rows = [(k, f"start {k} " + passage + f" end {k}") for k in range(40)] + [(90, passage * 3000)]
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_intervals_are_those_of_the_definition():
    words = sorted(["banana", "band", "bandana", "bee", "ban"])
    common = [len(__import__("os").path.commonprefix(list(p))) for p in zip(words, words[1:], strict=False)]
    assert set(intervals(common, 1)) == {(1, 0, 4), (3, 0, 3), (4, 2, 3)}


def test_groups_have_all_occurrences_and_part_to_the_left():
    right = np.array([list(b"aaaa"), list(b"aaab"), list(b"aabb")], dtype=np.uint8)
    left = np.array([list(b"xy"), list(b"xz"), list(b"xy")], dtype=np.uint8)
    groups = {(back, ahead, tuple(sorted(m.tolist()))) for back, ahead, m in maximal_groups(right, left, 1, 3)}
    assert groups == {(1, 3, (0, 1)), (1, 2, (0, 1, 2)), (2, 2, (0, 2))}


def test_digest_query(spark):
    from gleaner.llm.repeats import op1_repeats

    rows = op1_repeats(spark, "/root/testdata/sf0.001").collect()
    texts = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    want = [(d, n, g, r, hashlib.sha256(k).hexdigest()) for d, n, g, r, k in brute(texts)]
    assert sorted(map(tuple, rows), key=repr) == want
