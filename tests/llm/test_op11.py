"""Codes against plain Lloyd's rounds; trees against all comparisons."""

import hashlib

import numpy as np
import pytest

from litsearch.llm import op11_vector_codes as op11
from litsearch.llm.vectors import largest


def plain(rows, scale=1024, parts=4, entries=256, rounds=4):
    """``[(vec_id, code, error, label_error, sha)]`` with Python's integers."""
    fine = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    sizes = [len(r[1]) for r in fine if len(r[1]) and len(r[1]) % parts == 0]
    if not sizes:
        return []
    d = min(sorted(set(sizes)), key=lambda n: -sizes.count(n))
    most = largest(d)
    fine = [r for r in fine if len(r[1]) == d]
    whole = [[max(-most, min(most, int(np.floor(float(np.float32(x)) * scale)))) for x in r[1]] for r in fine]
    cut = [[v[k * d // parts:(k + 1) * d // parts] for k in range(parts)] for v in whole]
    first = sorted((r[0], r[1], i) for i, r in enumerate(fine) if r[0] is not None)[:entries]
    if not first:
        return []
    books = [[list(cut[i][k]) for _, _, i in first] for k in range(parts)]

    def away(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def best(part, book):
        return min((away(part, m), e) for e, m in enumerate(book))

    for _ in range(rounds):
        for k in range(parts):
            members = {}
            for v in cut:
                members.setdefault(best(v[k], books[k])[1], []).append(v[k])
            for e, some in members.items():
                books[k][e] = [sum(x) // len(some) for x in zip(*some)]
    sha = hashlib.sha256(",".join(str(x) for book in books for m in book for x in m).encode()).hexdigest()
    found = [[best(v[k], books[k]) for k in range(parts)] for v in cut]
    errors = [sum(d for d, _ in f) for f in found]
    labels = {}
    for r, e in zip(fine, errors):
        labels[r[2]] = labels.get(r[2], 0) + e
    return sorted(((r[0], "".join(f"{e:02x}" for _, e in f), err, labels[r[2]], sha)
                   for r, f, err in zip(fine, found, errors)), key=repr)


def run(spark, rows):
    table = spark.createDataFrame([(*r, "x") for r in rows],
                                  "vec_id long, embedding array<float>, label int, code string")
    found, books = op11.encode_vectors(table)
    return found, books


def vectors(seed, n=300, d=8):
    rng = np.random.default_rng(seed)
    rows = [(int(i), (rng.integers(-3, 4, d) / 1024 + rng.integers(0, 3) / 64).astype(np.float32).tolist(),
             None if i % 7 == 0 else int(i % 3)) for i in rng.permutation(n)]
    rows += [(1000 + i, rows[0][1], 1) for i in range(150)]  # copies, a third of all rows
    rows += [rows[1], rows[1]]  # repeated rows
    rows += [(None, rows[5][1], 1), (2000, None, 1), (2001, [], 1), (2002, [None] * d, 1), (2003, [float("nan")] * d, 2),
             (2004, [float("-inf")] * d, 2), (2005, [1.0] * (d + 1), 1), (2006, [1.0] * (2 * d), 1),
             (2007, [3e38] + [0.0] * (d - 1), 4), (2008, [-3e38] * d, 5)]
    return rows


def query(spark, rows, monkeypatch):
    table = spark.createDataFrame([(*r, "x") for r in rows],
                                  "vec_id long, embedding array<float>, label int, code string")
    monkeypatch.setattr(op11, "table", lambda *_: table)
    got = op11.op11_vector_codes(spark, "")
    columns = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert got.columns == columns
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("seed, block, leaf", [(1, 1024, 16), (2, 50, 2), (3, 7, 1)])
def test_codes(spark, monkeypatch, seed, block, leaf):
    monkeypatch.setattr(op11, "BLOCK", block)
    monkeypatch.setattr(op11, "LEAF", leaf)
    rows = vectors(seed)
    assert query(spark, rows, monkeypatch) == plain(rows)


@pytest.mark.parametrize("rows", [
    [], [(1, None, 1)], [(1, [1.0, 2.0, 3.0], 1)], [(None, [1.0] * 4, 1)],
    [(5, [0.5] * 4, 1)], [(3, [0.5] * 4, None), (2, [0.25] * 4, None), (2, [0.5] * 4, 7)]])
def test_few_rows(spark, monkeypatch, rows):
    assert query(spark, rows, monkeypatch) == plain(rows)


def clustered(rng, n, d=16, centres=40, noise=6):
    return (rng.integers(-500, 500, (centres, d))[rng.integers(0, centres, n)]
            + rng.integers(-noise, noise + 1, (n, d))).astype(np.int32)


@pytest.mark.parametrize("seed", range(6))
def test_tree(seed):
    rng = np.random.default_rng(seed)
    points = clustered(rng, 700) if seed % 2 else rng.integers(-4, 5, (700, 3)).astype(np.int32)
    tree, place = op11.CoverTree.build(points)
    assert (tree.points[place] == points).all() and tree.weights.sum() == len(points)
    for begin, end, centre, radius, child, children in tree.nodes:
        begin, end, centre, child, children = map(int, (begin, end, centre, child, children))
        away = np.sqrt(((tree.points[begin:end] - tree.points[centre]) ** 2.0).sum(1))
        assert begin <= centre < end and away.max() == radius
        if children:
            below = tree.nodes[child:child + children]
            centres = tree.points[below[:, op11.CENTRE].astype(int)]
            apart = np.sqrt(((centres[:, None] - centres[None]) ** 2.0).sum(2))[np.triu_indices(children, 1)]
            assert below[0, op11.BEGIN] == begin and below[-1, op11.END] == end
            assert (below[1:, op11.BEGIN] == below[:-1, op11.END]).all()
            assert (below[:, op11.RADIUS] <= radius / 2).all() and (apart > radius / 2).all()
    book = points[rng.permutation(700)[:60]].astype(np.int64)
    book[7] = book[3]  # a tie everywhere
    want = ((points[:, None] - book[None]) ** 2).sum(2).argmin(1)
    assert (tree.codes(book)[place] == want).all()
    counts, sums = np.zeros(60, np.int64), np.zeros((60, points.shape[1]), np.int64)
    tree.add_to(counts, sums, book)
    assert (counts == np.bincount(want, minlength=60)).all()
    assert all((sums[e] == points[want == e].sum(0)).all() for e in range(60))


def test_whole_subtrees():
    """On clustered vectors most points go with their subtree."""
    rng = np.random.default_rng(9)
    points = clustered(rng, 1024, noise=3)
    tree, _ = op11.CoverTree.build(points)
    book = points[:40].astype(np.int64)
    book = np.unique(book // 100 * 100 + 50, axis=0)
    assert tree.assign(book)[3] < len(points) / 4
