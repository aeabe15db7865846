"""Viterbi against the plain recurrence; held-out accuracy; odd inputs."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from litsearch.llm import op3_language as op3

SF = "/root/testdata/sf0.01"
EN = "the house and the garden were there when they came with this thing for that other"
DE = "der garten und das haus waren schon nicht mehr auch wenn sie mit dem ding wieder gekommen sind"
RU = "дом и сад были там когда они пришли с этим"


def plain_viterbi(scores, cost):
    value, came = np.zeros(scores.shape[1]), []
    for row, c in zip(scores, cost):
        best = value.max() - c
        came.append([k if value[k] >= best else int(value.argmax()) for k in range(len(value))])
        value = np.maximum(value, best) + row
    out, state = [], int(value.argmax())
    for step in reversed(came):
        out.append(state)
        state = step[state]
    return out[::-1]


@pytest.mark.parametrize("n", [1, 5, op3.BLOCK, op3.BLOCK + 1, 700])
def test_viterbi(n):
    rng = np.random.default_rng(n)
    scores = rng.normal(size=(n, 3)) * 3
    cost = np.where(rng.random(n) < 0.05, 0.0, 4.0)
    cost[0] = 0
    assert op3.viterbi(scores, cost).tolist() == plain_viterbi(scores, cost)


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, t, lang) for i in range(3) for t, lang in ((EN, "en"), (DE, "de"), (RU, "ru"))]
    return op3.learn(spark.createDataFrame([*rows, (9, None, "en"), (10, EN, None)],
                                           "doc_id long, text string, lang string"))


def test_cases(spark, model):
    mixed = f"{EN} {DE} {EN}"
    cases = [(0, None), (1, ""), (2, "12 -- 34"), (3, EN), (4, DE), (5, mixed), (6, RU), (7, "日本"),
             (8, EN), (8, EN), (9, f"{RU} {EN}"), (10, (EN + " ") * 2000)]
    docs = spark.createDataFrame([(i, t, "zz", 1) for i, t in cases],
                                 "doc_id long, text string, lang string, lang_score int")
    got = {r.doc_id: r for r in op3.identify(docs, model).collect()}
    assert [got[i].lang_pred for i in (0, 1, 2)] == ["und"] * 3
    assert [got[i].lang_score for i in (0, 1, 2)] == [0.0] * 3
    assert [got[i].lang_pred for i in (3, 4, 6, 8, 10)] == ["en", "de", "ru", "en", "en"]
    assert got[7].lang_pred in model.languages and got[3].lang == "zz"
    spans = got[5].lang_spans
    assert [s.lang for s in spans] == ["en", "de", "en"]
    assert mixed[spans[1].begin:spans[1].end].split()[2:-2] == DE.split()[2:-2]
    assert [s.lang for s in got[9].lang_spans] == ["ru", "en"]
    assert 0.5 < got[5].lang_score < 1
    assert op3.identify(docs, model).count() == len(cases)
    assert op3.identify(docs.limit(0), model).count() == 0


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, EN, None)], "doc_id long, text string, lang string")
    [row] = op3.identify(docs, op3.learn(docs)).collect()
    assert (row.lang_pred, row.lang_score, row.lang_spans) == ("und", 0.0, [])


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")
def test_held_out_accuracy(spark):
    got = op3.op3_language(spark, SF).filter("held_out").join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert got.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0] > 0.97


def test_sample_at_any_size():
    from litsearch.llm.common import hash_limit

    for n in (1, 2000, 2001, 10 ** 6, 10 ** 10, 10 ** 13):
        share = (hash_limit(2000, n) + 2 ** 63 + 1) / 2 ** 64
        assert abs(share - min(1, 2000 / n)) <= 1e-6 * share
    assert hash_limit(2000, 0) == 2 ** 63 - 1
