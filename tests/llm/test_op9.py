"""Fingerprints and links against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from litsearch.llm import op9_simhash as op9
from litsearch.llm.components import components

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(ids, values):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, k in enumerate(ids):
        least[find(i)] = min(k, least.get(find(i), k))
    return {k: least[find(i)] for i, k in enumerate(ids)}


def test_documents(spark):
    rng = random.Random(1)
    base = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(300)) for _ in range(6)]
    rows = [(100 - i, t) for i, t in enumerate([None, "", " \n", "One", "one", "a B c", "x É y z w", *base])]
    for i, text in enumerate(base * 3):
        words = text.split()
        words[rng.randrange(len(words))] = "new"
        rows.append((200 + i, " ".join(words)))
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, bits int")
    got = {r.doc_id: r for r in op9.link_documents(docs).collect()}
    prints = {i: plain_fingerprint(t) for i, t in rows}
    assert {i: r.fingerprint for i, r in got.items()} == {i: format(v, "016x") for i, v in prints.items()}
    want = plain_components(list(prints), list(prints.values()))
    assert {i: r.component_id for i, r in got.items()} == want
    assert got[100].fingerprint == "0" * 16 and got[100].component_id == 98


def test_repeated_null_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b"), (None, "other words here")],
                                 "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in op9.link_documents(docs).collect()) == [
        (0, 0), (0, 1), (1, 1), (1, 1)]
    assert op9.link_documents(docs.limit(0)).count() == 0


@pytest.mark.parametrize("shard", [op9.SHARD, 16])
def test_links_of_many(spark, monkeypatch, shard):
    """Random fingerprints with neighbours, and one large group within a few bits; also cut into parts."""
    monkeypatch.setattr(op9, "SHARD", shard)
    monkeypatch.setattr(op9, "LEAF", 4096)
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 150).tolist()
    values = set(base)
    for v in base[:60]:
        for _ in range(3):
            values.add(v ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 7), replace=False)))
    for _ in range(120):
        values.add(base[-1] ^ sum(1 << int(b) for b in rng.choice(64, 3, replace=False)))
    values = sorted(values)
    rows = [(i, int(np.uint64(v).astype(np.int64))) for i, v in enumerate(values)]
    got = op9.cluster(spark.createDataFrame(rows, "doc_id long, bits long")).collect()
    want = plain_components(list(range(len(values))), values)
    assert {r.bits: r.component_id for r in got} == {b: want[i] for i, b in rows}


@pytest.mark.parametrize("n", [10, 10**9, 10**12])
def test_masks_cover(n):
    masks = op9.block_masks(n)
    rng = np.random.default_rng(n % 7)
    for _ in range(200):
        changed = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(changed & m == 0 for m in masks)


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (200, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
