"""Token counts against the tokenizer's own library."""

import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from litsearch.llm.op1_token_counts import PieceCounts, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "Hello  world's end\n\n\tnow ", "<|endoftext|>a<|endoftext|>", "x<|endoftext|> y",
         "naïve Übung 日本語 \U0001f600‍ é", "a" * 5000, "ab" * 3000 + " " * 400 + "x",
         "12345 6.7\x1c\x1d\x85  z", "I'll don't 'S", "same", "same"]


def test_cases(spark):
    docs = spark.createDataFrame(
        [(i, text, 7) for i, text in enumerate(TEXTS)], "doc_id long, text string, n_tokens int")
    got = {r.doc_id: r for r in count_tokens(docs, PATH).collect()}
    for i, text in enumerate(TEXTS):
        want = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes) == (want, len((text or "").encode())), text
        assert got[i].over_limit == (want > 1024)
    assert count_tokens(docs.limit(0), PATH).count() == 0


def test_repeated_rows_stay(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b")], "doc_id long, text string")
    assert count_tokens(docs, PATH).count() == 2


counts = PieceCounts(PATH)
tokenizer = Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\tthe'sab1")), max_size=60))
def test_any_text(text):
    assert counts.count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids)
