"""Clusters against plain Lloyd's rounds; bounds against all distances."""

import hashlib

import numpy as np
import pytest

from litsearch.llm import op13_centroid_clusters as op13
from litsearch.llm.vectors import largest, squared_distances


def plain(rows, d=64, scale=64, clusters=16, rounds=3):
    fine = [r for r in rows if r[1] is not None and len(r[1]) == d
            and all(x is not None and np.isfinite(x) for x in r[1])]
    most = largest(d)
    whole = [[max(-most, min(most, int(np.floor(float(np.float32(x)) * scale)))) for x in r[1]] for r in fine]
    first = sorted((hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1], i)
                   for i, r in enumerate(fine) if r[0] is not None)[:clusters]
    centroids = [list(whole[i]) for _, _, i in first]
    if not centroids:
        return []

    def best(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, m)), c) for c, m in enumerate(centroids))

    for _ in range(rounds):
        members = {}
        for v in whole:
            members.setdefault(best(v)[1], []).append(v)
        for c, some in members.items():
            centroids[c] = [sum(x) // len(some) for x in zip(*some)]
    found = [best(v) for v in whole]
    inertia = {}
    for away, c in found:
        inertia[c] = inertia.get(c, 0) + away
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in centroids]
    return sorted(((r[0], c, away, inertia[c], sum(inertia.values()), sha[c])
                   for r, (away, c) in zip(fine, found)), key=repr)


def query(spark, rows, monkeypatch):
    table = spark.createDataFrame([(*r, "x") for r in rows],
                                  "vec_id long, embedding array<float>, label int, cluster string")
    monkeypatch.setattr(op13, "table", lambda *_: table)
    got = op13.op13_centroid_clusters(spark, "")
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def vectors(seed, n=200):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, 64))
    rows = [(int(i), (centres[i % 5] * 0.3 + rng.normal(size=64) * 0.1).astype(np.float32).tolist(), 1)
            for i in rng.permutation(n)]
    rows += [(1000 + i, rows[0][1], 1) for i in range(100)] + [rows[1], rows[1]]
    return rows + [(None, rows[3][1], 1), (2000, None, 1), (2001, [], 1), (2002, [None] * 64, 1), (2003, [float("nan")] * 64, 1),
                   (2004, [float("inf")] * 64, 1), (2005, [1.0] * 63, 1), (2006, [1.0] * 65, 1),
                   (2007, [3e38] + [0.0] * 63, 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters(spark, monkeypatch, seed):
    rows = vectors(seed)
    assert query(spark, rows, monkeypatch) == plain(rows)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(None, [1.0] * 64, 1)], [(5, [0.5] * 64, 1)],
                                  [(i % 3, [float(i % 2)] * 64, 1) for i in range(9)]])
def test_few_rows(spark, monkeypatch, rows):
    assert query(spark, rows, monkeypatch) == plain(rows)


@pytest.mark.parametrize("seed, spread", [(0, 1), (1, 3), (2, 40), (3, 2_000_000)])
def test_bounds_are_exact(seed, spread):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-50, 50, (16, 64)) * spread
    centres[9] = centres[4]  # a tie
    vectors = (centres[rng.integers(0, 16, 500)] + rng.integers(-spread, spread + 1, (500, 64))).astype(np.int32)
    pivots = op13.choose_pivots(vectors[:100].astype(np.int64), 12)
    far, centres_far = (np.sqrt(squared_distances(x, pivots).astype(float)) for x in (vectors, centres))
    want = np.array([[sum(int(x) ** 2 for x in (v.astype(object) - c.astype(object))) for c in centres]
                     for v in vectors], object)
    cluster, away, taken = op13.nearest(vectors, far, centres, centres_far)
    assert (cluster == want.argmin(1)).all() and (away == want.min(1)).all()
    assert taken < len(vectors) * 8  # bounds spare more than half of the comparisons
