"""Dropped lines against a plain count, both ways of probing, and the perfect hash itself."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from gleaner.llm import lines
from gleaner.llm.lines import Shard, build_shard, drop_common_lines

WS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs, min_chars):
    texts = [(t or "").split("\n") for t in rows]
    key = lambda line: line.strip(WS).translate(LOWER)
    counts = Counter(k for t in texts for k in {key(x) for x in t})
    drop = {k for k, n in counts.items() if n >= min_docs and len(k) >= max(1, min_chars)}
    out = []
    for row, t in zip(rows, texts, strict=True):
        left = [x for x in t if key(x) not in drop]
        out.append((None if row is None else "\n".join(left), len(t), len(t) - len(left)))
    return out


ROWS = [
    None, "", "\n", "  Share THIS \n body one\n\nÉté ", "share this\nété\nbody two", "share this\tx", "\x0bshare this\r\nbody ",
    "SHARE THIS\nété\nété", "ß\n" * 3 + "Ab", "ab\nß", "x" * 200_000 + "\nab", "share this", "share this",
]


@pytest.mark.parametrize("limit", [lines.BROADCAST_BYTES, -1])
@pytest.mark.parametrize(("min_docs", "min_chars"), [(2, 1), (3, 1), (2, 3), (1, 1), (50, 1)])
def test_against_counts(spark, limit, min_docs, min_chars, monkeypatch):
    monkeypatch.setattr(lines, "HEAVY", 5)
    frame = spark.createDataFrame([(i % 9, t, "clash", 1.5) for i, t in enumerate(ROWS)], "doc_id long, text string, n_lines string, t double")
    got = drop_common_lines(frame.repartition(4), min_docs=min_docs, min_chars=min_chars, shard_keys=3, broadcast_bytes=limit)
    assert got.columns == ["doc_id", "text", "n_lines", "t", "n_lines_", "n_dropped"]
    want = [(i % 9, w[0], "clash", 1.5, *w[1:]) for i, w in enumerate(brute(ROWS, min_docs, min_chars))]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_the_two_ways_agree_on_the_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    near = drop_common_lines(docs, min_docs=3)
    far = drop_common_lines(docs, min_docs=3, shard_keys=50, broadcast_bytes=-1)
    show = lambda f: sorted((r[0], hashlib.md5((r[1] or "").encode()).hexdigest(), r[2], r[3]) for r in f.collect())
    assert show(near) == show(far) and sum(r[3] for r in show(near))


def test_empty(spark):
    for limit in (0, -1):
        assert drop_common_lines(spark.createDataFrame([], "doc_id long, text string"), broadcast_bytes=limit).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_and_minimal(n):
    rng = np.random.default_rng(n)
    a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for _ in range(2))
    a[: n // 2] = 7  # equal first halves are kept apart by the second
    counts = rng.integers(1, 9, n)
    sizes, bits, fingerprints, documents = build_shard(a, b, counts)
    shard = Shard.of(sizes, bits, fingerprints, documents)
    assert sorted(shard.slots(a, b)) == list(range(n))
    assert (shard.documents(a, b) == counts).all()
    assert not shard.documents(a + np.uint64(1), b + np.uint64(3)).any()
    assert n < 1000 or len(bits) * 8 / n < 5
