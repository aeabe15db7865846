"""The pipeline's stages, each against a plain version on its own input."""

import os

import public_tokenizers
import pytest

import corpus_pipeline as cp
from litsearch.llm import op6_pii
from plain import plain_base_spans, plain_groups, tiktoken_ids

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
EN = "the house and the garden were there when they came with this thing for that other one "
DE = "der garten und das haus waren schon nicht mehr auch wenn sie mit dem ding wieder kommen "
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def small(spark):
    texts = [(1, EN * 3, "en"), (2, EN * 3, "en"), (2, EN * 3, "en"), (3, DE * 2, "de"), (4, DE * 2, None),
             (5, "12 34 --", "en"), (6, None, None), (7, "", "en"), (8, EN + "mail a.b@c.org", None),
             (None, EN * 3, None), (9, DE * 4 + "x", None)]
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in texts], SCHEMA)


def test_language(spark, small):
    kept = cp.language(spark, small, SF).collect()
    assert kept[0].__fields__ == COLUMNS
    assert sorted(r.doc_id or 0 for r in kept) == [0, 1, 2, 2, 3, 4, 8, 9]
    assert {r.doc_id: r.lang for r in kept}[4] == "de"


def test_near_duplicates(spark, small):
    kept = cp.near_duplicates(spark, small, SF).collect()
    rows = [(r.doc_id, r.text) for r in small.collect() if r.doc_id is not None]
    want = {min(g) for g in plain_groups(rows)}
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(want)
    assert [r.__fields__ for r in kept][0] == COLUMNS


def test_rows_that_share_an_id(spark):
    """Other texts of an id are other documents; rows without an id stay."""
    texts = [(1, EN * 3), (1, DE * 3), (1, DE * 3), (2, EN * 3), (3, DE * 3), (None, EN * 3), (None, EN * 3), (4, None), (4, "")]
    docs = spark.createDataFrame([(i, t, "x", "s", 0, k) for k, (i, t) in enumerate(texts)], SCHEMA + ", row_key long")
    kept = cp.near_duplicates(spark, docs, SF)
    assert kept.columns == [*COLUMNS, "row_key"]
    got = [(r.doc_id, r.text or "") for r in kept.collect()]
    assert sorted(got, key=str) == sorted([(1, EN * 3), (1, DE * 3), (None, EN * 3), (None, EN * 3), (4, "")], key=str)


def test_personal_data(spark, small):
    kept = {r.doc_id: r for r in cp.personal_data(spark, small, SF).collect()}
    assert kept[8].text == EN + "mail [EMAIL]" and kept[8].n_chars == len(kept[8].text)
    assert kept[6].text is None and kept[1].text == EN * 3
    assert not any(plain_base_spans(r.text or "") for r in kept.values())


def test_tokens(spark, small):
    path = public_tokenizers.path(cp.VOCABULARY)
    texts = {r.doc_id: r.text or "" for r in small.collect()}
    for r in cp.tokens(spark, small, SF).collect():
        assert r.text == texts[r.doc_id]
        assert [int.from_bytes(r.ids[i:i + 4], "little") for i in range(0, len(r.ids), 4)] == tiktoken_ids(
            path, r.text)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")
def test_run(spark):
    result = cp.run(spark, SF)
    before = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = result.collect()
    assert len({r.doc_id for r in rows}) == len(rows) < len(before)
    for r in rows:
        assert not any(b in before[r.doc_id].text for b in bench)
        assert not plain_base_spans(r.text)
        if not any(op6_pii.base_spans(before[r.doc_id].text).values()):
            assert r.text == before[r.doc_id].text
    # what went is without language, leaks an item or is near a kept one
    groups = {i: g for g in plain_groups([(i, d.text) for i, d in before.items()]) for i in g}
    kept = {r.doc_id for r in rows}
    unexplained = [i for i, d in before.items() if i not in kept and not groups[i] & kept
                   and not any(b in before[j].text for b in bench for j in groups[i])
                   and sum(c.isalpha() for c in d.text) > 0]
    assert len(unexplained) <= 0.01 * len(before)


def test_empty(spark, small):
    docs = small.limit(0)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
