"""Rules against the plain patterns, the field against all segmentations, held-out forms."""

import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from litsearch.llm import op6_pii as op6

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    def fits(kind, s):
        digits = re.sub("[^0-9]", "", s)
        if kind == "ip":
            return all(int(p) <= 255 for p in s.split("."))
        if kind == "card":
            total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4)
                        for i, d in enumerate(map(int, reversed(digits))))
            return 16 <= len(digits) <= 19 and total % 10 == 0
        return kind == "email" or 8 <= len(digits) <= 15

    return {kind: [m.span() for m in re.finditer(p, text) if fits(kind, m.group())]
            for kind, p in PLAIN.items()}


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["@", ".", "a", "b-", "1", "25", "256", " ", "+", "(", "é", "4495114827612972",
                                 "x@y.z", "1.2.3.4", "+1 (274) 555-9629", "@@", "-", "%", "٣"]), max_size=14))
def test_rules(parts):
    text = "".join(parts)
    assert op6.base_spans(text) == plain_spans(text)


@pytest.fixture(scope="module")
def weights():
    return op6.fit(op6.written_examples(20))


def test_gradient_is_that_of_the_likelihood(weights):
    """Sums over all segmentations, one by one."""
    text = "a (12) 3-4 b"
    lattice = op6.Lattice(text, 0, len(text))
    out, inside = weights.scores(lattice)
    n = len(lattice.tokens)

    def paths(at):
        if at == n:
            yield []
            return
        for rest in paths(at + 1):
            yield [(at, at + 1, 0, -1), *rest]
        for s, (i, j) in enumerate(lattice.segments):
            if i == at:
                for y, rest in itertools.product(range(1, 5), list(paths(j))):
                    yield [(i, j, y, s), *rest]

    def score(path):
        total, before = 0.0, 0
        for i, j, y, s in path:
            total += weights.after[before, y] + (inside[s, y] if y else out[i])
            before = y
        return total

    every = list(paths(0))
    share = np.exp([score(p) for p in every])
    share /= share.sum()
    want = np.zeros_like(inside)
    pairs = np.zeros_like(weights.after)
    for p, w in zip(every, share):
        before = 0
        for _, _, y, s in p:
            pairs[before, y] += w
            if y:
                want[s, y] += w
            before = y
    tokens, spans, used = op6.gradient(lattice, [], weights)
    assert np.allclose(-spans, want, atol=1e-6)
    assert used[:, 1:] == pytest.approx(-pairs[:, 1:], abs=1e-6)
    best = max(every, key=score)
    found = op6.best_path(lattice, weights)
    assert all((lattice.bounds[i], lattice.bounds[j]) in {f[:2] for f in found} or inside[s, y] - out[i:j].sum()
               <= op6.MARGIN for i, j, y, s in best if y)


def test_held_out_forms(weights):
    """Forms drawn anew: nearly all found with exact bounds, look-alikes left alone."""
    right = wrong = total = clean = 0
    for text, entities in op6.written_examples(10, seed=77):
        base, every = op6.all_spans(text, weights)
        if entities:
            [(a, b, kind)] = entities
            total += 1
            right += (a, b) in every[kind]
        elif not any(base.values()):
            clean += 1
            wrong += any(every.values())
    assert right / total > 0.9 and wrong / clean < 0.03


@pytest.mark.parametrize("gap", [", ", " ", "; call "])
def test_long_lists(weights, gap):
    """Of 200 numbers in a row each is found, with the bounds it has alone."""
    numbers = [f"({200 + i}) 555-{1000 + 7 * i}" for i in range(200)]
    text = gap.join(numbers)
    at, want = 0, set()
    for number in numbers:
        want.add((at, at + len(number)))
        at += len(number) + len(gap)
    _, every = op6.all_spans(text, weights)
    assert want <= set(every["phone"])
    flat = sorted(s for spans in every.values() for s in spans)
    assert all(x[1] <= y[0] for x, y in zip(flat, flat[1:]))


def test_regions_overlap():
    for text in ("12 " * 900, "1" * 5000, "ab 12 " * 400, "x" * 3000 + " 1"):
        at = None
        for start, end, first, last in op6.regions(text, []):
            assert start <= first < last <= end <= len(text) and end - start <= op6.REGION + 2 * op6.AROUND
            assert at is None or first >= at
            at = last


def test_cases(spark, weights):
    texts = [None, "", "no data here.", "Version 2.0, 2004-01-05.", "mail a.b@c.org or +1 (274) 555-9629.",
             "call (274) 555-9629 now", "ip 10.0.0.1 and 10.0.0.256", "card 4495114827612972 é x@y.co",
             "9" * 20_000, "@" * 5000, "1 " * 3000, "same a@b.c", "same a@b.c"]
    docs = spark.createDataFrame([(i, t, 3) for i, t in enumerate(texts)], "doc_id long, text string, n_ip int")
    got = {r.doc_id: r for r in op6.find_personal_data(docs, weights).collect()}
    for i, text in enumerate(texts):
        plain = plain_spans(text or "")
        assert got[i].base_spans == op6.digest(plain)
        assert (got[i].n_email, got[i].n_ip) == (len(plain["email"]), len(plain["ip"]))
        assert set(filter(None, got[i].base_spans.split(","))) <= set(got[i].spans.split(","))
    assert [got[i].spans for i in (0, 1, 2, 3)] == ["", "", "", ""]
    assert got[0].redacted is None and got[5].spans == "phone:5:19"
    assert got[4].redacted == "mail [EMAIL] or [PHONE]."
    assert op6.find_personal_data(docs.limit(0), weights).count() == 0
