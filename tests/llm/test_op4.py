"""Links against all pairs."""

import numpy as np
import pytest

from litsearch.llm import op4_embedding_dedup as op4


def plain(rows):
    """``{vec_id: (n_links, component_id)}`` by all pairs."""
    def usable(label, v):
        return (label is not None and v is not None and len(v) > 0
                and all(x is not None and np.isfinite(x) for x in v) and any(v))

    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(rows)
    for i, (_, v, label) in enumerate(rows):
        for j, (_, u, other) in enumerate(rows[:i]):
            if usable(label, v) and usable(other, u) and label == other and len(u) == len(v):
                a, b = np.array(u, float), np.array(v, float)
                if a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= op4.COSINE:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    least = {}
    for i, row in enumerate(rows):
        least[find(i)] = min(row[0], least.get(find(i), row[0]))
    return sorted((row[0], links[i], least[find(i)]) for i, row in enumerate(rows))


def vectors(seed):
    rng = np.random.default_rng(seed)
    rows, n = [], 0
    for centre in rng.normal(size=(12, 16)):
        for spread in (0.05, 0.2, 0.25, 0.3, 0.6):
            for _ in range(4):
                rows.append((n, (centre + rng.normal(size=16) * spread).astype(np.float32).tolist(), n % 2))
                n += 1
    rows += [(n + i, rows[5][1], rows[5][2]) for i in range(6)]  # copies
    rows += [(900, None, 1), (901, [], 1), (902, [0.0] * 16, 1), (903, [None] + [1.0] * 15, 1),
             (904, [float("nan")] * 16, 1), (905, [float("inf")] * 16, 1), (906, rows[5][1], None),
             (907, [1.0] * 3, 1), (908, [2.0] * 3, 1)]
    return rows


@pytest.mark.parametrize("part", [op4.PART, 20])
def test_links(spark, monkeypatch, part):
    monkeypatch.setattr(op4, "PART", part)
    rows = vectors(4)
    table = spark.createDataFrame([(*r, "x") for r in rows],
                                  "vec_id long, embedding array<float>, label int, kept string")
    got = op4.link_vectors(table).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == plain(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_repeated_rows_and_empty(spark):
    table = spark.createDataFrame([(1, [1.0, 0.0], 3), (1, [1.0, 0.0], 3), (2, [1.0, 0.1], 3)],
                                  "vec_id long, embedding array<float>, label int")
    assert sorted(tuple(r) for r in op4.link_vectors(table).collect()) == [
        (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]
    assert op4.link_vectors(table.limit(0)).count() == 0


def test_recall_at_the_least_cosine():
    """Pairs made at the least cosine: the count loses none of many."""
    rng = np.random.default_rng(3)
    a = rng.normal(size=(500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=(500, 64))
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    c = op4.COSINE + 1e-7
    both = np.concatenate((a, c * a + np.sqrt(1 - c * c) * b))
    found = {(i, j) for x, y in op4.linked_pairs(both, np.arange(500), np.arange(500, 1000))
             for i, j in zip(x.tolist(), y.tolist())}
    assert {(i, i + 500) for i in range(500)} <= found
