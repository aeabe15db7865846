"""Weights against the plain recursion, base scores against a dictionary."""

import functools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from litsearch.llm import op10_context_tree as op10

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_base(texts, training):
    count = Counter()
    for text in training:
        count.update(WORD.findall((text or "").translate(LOWER)))
        count["\n end"] += 1
    n, v = sum(count.values()), len(count)
    out = []
    for text in texts:
        tokens = [*WORD.findall((text or "").translate(LOWER)), "\n end"]
        out.append((len(tokens), sum(count[t] > 0 for t in tokens), n,
                    sum(math.log10((count[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)))
    return out


def log_kt(zeros, ones):
    return (math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi))


def log_add(a, b):
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def plain_tree(training, text, least=1):
    """log10 probability by the definition; ``training`` are texts with how often each occurs."""
    depth, pad = op10.DEPTH, bytes([op10.END])
    seen = {}
    for t, times in training.items():
        data = pad * depth + t.encode() + pad
        for i in range(depth, len(data)):
            for d in range(depth + 1):
                seen.setdefault(data[i - d:i], Counter())[data[i]] += times
    contexts = {c for c, n in seen.items() if sum(n.values()) >= least or not c}
    children = {}
    for c in contexts:
        if c:
            children.setdefault(c[1:], []).append(c)

    def split(n, prefix):
        k, out = len(prefix), [0, 0]
        for b, m in n.items():
            if format(b, "08b").startswith(prefix):
                out[int(format(b, "08b")[k])] += m
        return out

    def rest(context):
        n = Counter(seen[context])
        for c in children.get(context, []):
            n.subtract(seen[c])
        return n

    @functools.cache
    def weighted(context, prefix):
        own = log_kt(*split(seen[context], prefix))
        if len(context) == depth:
            return own, 1.0
        below = sum(weighted(c, prefix)[0] for c in children.get(context, [])) + log_kt(*split(rest(context), prefix))
        both = log_add(own, below) - math.log(2)
        return both, math.exp(own - math.log(2) - both)

    def estimate(n):
        return (n[1] + 0.5) / (sum(n) + 1)

    @functools.cache
    def one(data, prefix, d=0):
        context = data[depth - d:]
        p = estimate(split(seen[context], prefix))
        if d == depth:
            return p
        stop = weighted(context, prefix)[1]
        longer = data[depth - d - 1:]
        below = one(data, prefix, d + 1) if longer in contexts else estimate(split(rest(context), prefix))
        return stop * p + (1 - stop) * below

    total, data = 0.0, pad * depth + text.encode() + pad
    for i in range(depth, len(data)):
        prefix = ""
        for bit in format(data[i], "08b"):
            p = one(data[i - depth:i], prefix)
            total += math.log10(p if bit == "1" else 1 - p)
            prefix += bit
    return total


def repeated(spark, training):
    return (spark.createDataFrame(list(training.items()), "text string, times int")
            .select(F.expr("explode(array_repeat(text, times))").alias("text"), F.lit(0).alias("doc_id")))


def scores(spark, training, asked):
    """Scores of texts by the operator, training texts being rows of their own."""
    docs = spark.createDataFrame(list(enumerate(asked)), "doc_id int, text string")
    return {asked[r.doc_id]: r for r in op10.score(docs, repeated(spark, training)).collect()}


@pytest.mark.parametrize("share", [op10.NODE_SHARE, 0.02, 0.2, 1.0])
@pytest.mark.parametrize("least", [1, 3])
def test_tree(spark, monkeypatch, share, least):
    """The same with all contexts frequent, some, or none but the empty one."""
    monkeypatch.setattr(op10, "NODE_SHARE", share)
    monkeypatch.setattr(op10, "LEAST", least)
    monkeypatch.setattr(op10, "NODES_AT_ONCE", 5)
    training = {"abab cab": 2, "abba": 1, "b é": 3, "": 1}
    asked = ["abab", "", "bbq", "é", "cab cab " * 50, "q\U0001F600"]
    got = scores(spark, training, asked)
    for text in asked:
        want = plain_tree(training, text, least)
        assert got[text].score == pytest.approx(want, rel=1e-5)
        assert got[text].bits_per_byte == pytest.approx(-want / math.log10(2) / (len(text.encode()) + 1), rel=1e-5)


def test_tree_with_production_settings(spark):
    """Contexts of a share of all bytes, of at least LEAST and rarer ones all occur."""
    draw = random.Random(1)
    training = {"ab" * 3000: 3000, "".join(draw.choices("abcd ", k=6000)): 1,
                **{"".join(draw.choices("xyz", k=300)): 3 for _ in range(30)}}
    asked = ["abab", "xyzzy xyx", "zzzzabca dcb", "q"]
    tree = op10.learn_tree(op10.training_counts(repeated(spark, training)))
    assert tree.n_rare > 50 and tree.first[1] < len(tree.log10)
    assert np.allclose((10.0 ** tree.log10).sum(axis=1), 1, atol=1e-4)
    got = scores(spark, training, asked)
    for text in asked:
        assert got[text].score == pytest.approx(plain_tree(training, text, op10.LEAST), rel=1e-4)


def test_contexts_stay_when_unrelated_text_is_added(spark):
    few = spark.createDataFrame([("abcde" * 300,)], "text string")
    many = few.unionByName(spark.range(3000).select(F.repeat(F.lit("xyz"), 1000).alias("text")))

    def contexts(docs):
        found = op10.context_nodes(op10.training_counts(docs), op10.LEAST).filter("depth > 1")
        return {(r.depth, r.context) for r in found.select("depth", "context").collect()}

    assert len(contexts(few)) == 15
    assert contexts(few) < contexts(many)


TEXTS = [None, "", " \t", "The cat THE dog", "the é É \x0bcat", "x" * 5000, "word " * 3000, "same", "same"]


@pytest.mark.parametrize("hot_share", [op10.HOT_SHARE, 0.2])
def test_base(spark, monkeypatch, hot_share):
    monkeypatch.setattr(op10, "HOT_SHARE", hot_share)
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, base int")
    training = docs.filter("doc_id < 5")
    got = {r.doc_id: r for r in op10.score(docs, training).collect()}
    assert len(got) == len(TEXTS)
    for i, want in enumerate(plain_base(TEXTS, TEXTS[:5])):
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == want[:3]
        assert got[i].base_score == pytest.approx(want[3], rel=1e-9)
        assert got[i].score < 0


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "ab"), (1, "ab")], "doc_id long, text string")
    rows = op10.score(docs, docs.limit(0)).collect()
    assert len(rows) == 2
    assert rows[0].score == pytest.approx(24 * math.log10(0.5), rel=1e-5)
    assert rows[0].base_score == pytest.approx(0)
    assert op10.score(docs.limit(0), docs.limit(0)).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text("abé \n", max_size=30), max_size=5))
def test_places(values):
    data, places, text = op10.context_bytes(values)
    for i, value in enumerate(values):
        assert bytes(data[places[text == i]]) == value.encode() + b"\xff"


def test_contexts_that_occur_twice_have_a_node(spark):
    """As shipped, no context that occurs again is merged with others."""
    training = {"the cat sat on the mat": 1, "a cat and a bat": 1, "é": 2}
    found = op10.context_nodes(op10.training_counts(repeated(spark, training)), op10.LEAST)
    seen = Counter()
    for text, times in training.items():
        data = bytes([op10.END]) * op10.DEPTH + text.encode() + bytes([op10.END])
        for i in range(op10.DEPTH, len(data)):
            seen.update({(d, int.from_bytes(data[i - d:i], "big")): times for d in range(1, op10.DEPTH + 1)})
    assert {(r.depth, r.context) for r in found.filter("depth > 0").collect()} == {
        place for place, n in seen.items() if n > 1}
    asked = ["the cat", "a mat and", "é"]
    got = scores(spark, training, asked)
    for text in asked:
        assert got[text].score == pytest.approx(plain_tree(training, text, 2), rel=1e-5)
