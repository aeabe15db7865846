"""Encoding against the tokenizer's own library, and exact round trips."""

import base64
import random

import public_tokenizers
import tiktoken
from hypothesis import given, settings, strategies as st

from litsearch.llm.op7_byte_bpe import codec, decode, encode

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
with open(PATH, "rb") as file:
    RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
LIBRARY = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS,
                            special_tokens={})
rng = random.Random(3)
TEXTS = [None, "", "   ", "Hello  world's end\n\n\tnow ", "<|endoftext|>a", "naïve Übung 日本語 \U0001f600 é",
         "a" * 5000, "ab" * 2000, "".join(rng.choice("abcdefgh") for _ in range(3000)),
         "".join(rng.choice("aab") for _ in range(500)), "x\x1c\x1d\x85  z", "same", "same"]


def words(blob):
    return [int.from_bytes(blob[i:i + 4], "little") for i in range(0, len(blob), 4)]


def test_cases(spark):
    docs = spark.createDataFrame([(i, t, b"") for i, t in enumerate(TEXTS)],
                                 "doc_id long, text string, ids binary")
    encoded = encode(docs, PATH)
    got = {r.doc_id: r for r in encoded.collect()}
    for i, text in enumerate(TEXTS):
        assert words(got[i].ids) == LIBRARY.encode_ordinary(text or ""), text
        assert got[i].n_tokens == len(got[i].ids) // 4
        assert bytes(got[i].decoded) == (text or "").encode()
    for r in decode(encoded, PATH).collect():
        assert bytes(r.decoded) == (TEXTS[r.doc_id] or "").encode()
    assert encode(docs.limit(0), PATH).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\tthe'sab1")), max_size=80))
def test_any_text(text):
    [(ids, decoded)] = codec(PATH).encode([text])
    assert words(ids) == LIBRARY.encode_ordinary(text)
    assert decoded == text.encode()
