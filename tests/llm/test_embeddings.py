"""Links and components against all pairs in double precision."""

import numpy as np
import pytest

from gleaner.llm import embeddings as E
from gleaner.llm.embeddings import near_vectors

SCHEMA = "vec_id long, embedding array<float>, n_links string"


def brute(rows, cosine=0.9):
    good = {}
    for k, v in rows:
        if k is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[k] = np.array(v, dtype=np.float32).astype(float)
    keys, links, parent = sorted(good), {}, {}
    parent = {k: k for k, _ in rows if k is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[:i]:
            x, y = good[a], good[b]
            if len(x) == len(y) and (x * y).sum() / (np.linalg.norm(x) * np.linalg.norm(y)) >= cosine:
                links[a], links[b] = links.get(a, 0) + 1, links.get(b, 0) + 1
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return {k: (links.get(k, 0), root(k)) for k in parent}


def corpus(size, seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for group in range(15):
        centre = rng.standard_normal(size)
        for _ in range(int(rng.integers(1, 12))):
            rows.append(centre + rng.standard_normal(size) * rng.choice([0.05, 0.3, 0.5]))
        if group % 5 == 0:
            rows += [rows[-1]] * 4
    rows = [(int(k), [float(x) for x in v]) for k, v in zip(rng.permutation(len(rows)), rows, strict=True)]
    bad = [None, [], [0.0] * size, [None] + [1.0] * (size - 1), [float("nan")] + [1.0] * (size - 1), [float("inf")] + [1.0] * (size - 1), [1.0] * (size + 1), [2.0] * (size + 1)]
    return rows + [(1000 + k, v) for k, v in enumerate(bad)] + [rows[0]]


@pytest.mark.parametrize(("size", "tile"), [(64, 1024), (6, 4), (3, 1024), (1, 3)])
def test_same_as_all_pairs(spark, monkeypatch, size, tile):
    monkeypatch.setattr(E, "TILE", tile)
    rows = corpus(size)
    found = near_vectors(spark.createDataFrame([(k, v, "x") for k, v in rows], SCHEMA)).collect()
    assert len(found) == len(rows)
    assert {r.vec_id: (r.n_links, r.component) for r in found} == brute(rows)


def test_extreme_magnitudes_keep_their_links(spark):
    rows = [(1, [1e-300, 2e-300]), (2, [2e300, 4e300]), (3, [1.0, 2.0]), (4, [5e-324, 0.0]), (5, [1.7e308, 1e-300]), (6, [-1.0, -2.0])]
    found = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id: (r.n_links, r.component) for r in found} == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (1, 4), 5: (1, 4), 6: (0, 6)}


def test_no_key_no_rows(spark):
    frame = spark.createDataFrame([(None, [1.0, 0.0], "x"), (1, [1.0, 0.0], "x")], SCHEMA)
    assert sorted(map(tuple, near_vectors(frame).collect()), key=repr) == [(1, 0, 1), (None, 0, None)]
    assert near_vectors(frame.limit(0)).count() == 0
