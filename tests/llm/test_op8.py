"""Removed words against brute force."""

import random
import re

import pytest

from litsearch.llm import op8_substring_dedup as op8

WORD = re.compile("[^\x20\x09-\x0D]+")


def plain(rows):
    """By the definition; None sorts last."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    seen, out = {}, [None] * len(rows)
    for i in order:
        key = (rows[i][0] is None, rows[i][0] or 0)
        words = WORD.findall(rows[i][1] or "")
        gone, own = [False] * len(words), set()
        for p in range(len(words) - 19):
            window = tuple(words[p:p + 20])
            if window in own or seen.get(window, key) < key:
                gone[p:p + 20] = [True] * 20
            own.add(window)
            seen.setdefault(window, key)
        out[i] = (rows[i][0], len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g))
    return sorted(out, key=repr)


def texts(seed):
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(60)] + ["É", "日本", "Word", "word"]

    def some(n):
        return [rng.choice(vocab) for _ in range(n)]

    passages = [some(n) for n in (19, 20, 21, 29, 30, 38, 39, 40, 75)]
    rows = [(3, None), (4, ""), (5, " \t\n"), (6, "x " * 500), (7, " ".join(passages[3] * 2)),
            (None, " ".join(passages[8])), (8, "one"), (9, " ".join(some(20))), (9, " ".join(some(50)))]
    for i in range(60):
        words = some(rng.randrange(15))
        for _ in range(rng.randrange(5)):
            words += rng.choice(passages)[rng.randrange(3):] + some(rng.randrange(12))
        rows.append((100 - i, rng.choice([" ", "\n", "\x0b "]).join(words)))
    rows += [(200, rows[-1][1]), (201, rows[-2][1]), (9, rows[8][1]), (2, rows[-1][1] + "\x1c tail")]
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats(spark, monkeypatch, seed):
    monkeypatch.setattr(op8, "PART_CHARS", 700)
    rows = texts(seed)
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, bits string")
    got = sorted((tuple(r) for r in op8.remove_repeats(docs).collect()), key=repr)
    assert got == plain(rows)
    assert sum(r[2] for r in got) > 100


def test_parts_survive_a_rerun(spark, monkeypatch):
    """What is shuffled has the same parts each time it is read, as after the loss of an executor."""
    exchange, read = op8.exchange, []

    def twice(asked, *rest):
        for _ in range(2):
            read.append(sorted((r.part, r.bucket) for r in asked.select("part", "bucket").collect()))
        return exchange(asked, *rest)

    monkeypatch.setattr(op8, "exchange", twice)
    rows = texts(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in op8.remove_repeats(docs).collect()), key=repr) == plain(rows)
    assert len(read) == 4 and read[0] == read[1] and read[2] == read[3]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert op8.remove_repeats(docs).count() == 0
