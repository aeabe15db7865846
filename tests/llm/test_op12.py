"""Packing: exact round trip, first fit against a plain search, no padding."""

from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from litsearch.llm import op12_packing as op12

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, docs, length=2048):
    """All ids in exactly one piece; sequences gapless, short enough, and not padded."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, len(r.ids) // 4))
    want = defaultdict(list)
    for i, text in docs:
        want[i].append(ids_of(text))
    assert set(pieces) == set(want)
    for i, found in pieces.items():
        if len(want[i]) == 1:
            found.sort(key=lambda r: r.start)
            assert [x for r in found for x in np.frombuffer(r.ids, "<u4").tolist()] == want[i][0]
            assert all(r.doc_tokens == len(want[i][0]) for r in found)
            assert [r.start for r in found] == np.cumsum([0, *(len(r.ids) // 4 for r in found)])[:-1].tolist()
        else:
            assert sum(len(r.ids) // 4 for r in found) == sum(map(len, want[i]))
    for some in sequences.values():
        some.sort()
        ends = np.cumsum([n for _, n in some]).tolist()
        assert [o for o, _ in some] == [0, *ends[:-1]] and all(n > 0 for _, n in some)
        assert ends[-1] <= length and (ends[-1] == length or not ends[-1] & ends[-1] - 1)


def documents(seed, n=120):
    rng = np.random.default_rng(seed)
    words = ["the", "Über", "naïve,", "x1", "don't", "ΣΑΣ", "中文字", "éa", "́b", "\x1c", "<|endoftext|>", "a<|startoftext|>b",
             "<|ENDOFTEXT|>", "ﬁ", "İz", "H̱x", "🙂", "q" * 70, " ", "a b", "\x7f", "\x85c", "12,345.6", "we'll", "'S"]
    docs = [(i, " ".join(rng.choice(words, int(rng.integers(0, 900))))) for i in range(n)]
    return docs + [(900, None), (901, ""), (902, " \n\t "), (903, "word " * 30_000), (904, "x" * 100_000),
                   (905, "same text"), (905, "same text"), (None, "no id")]


@pytest.mark.parametrize("group", [4096, 10])
def test_round_trip(spark, group):
    docs = documents(1)
    table = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, offset int, ids int")
    check(op12.pack_documents(table, PATH, group=group).collect(), docs)


def test_other_length(spark):
    docs = documents(2, 30)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    check(op12.pack_documents(table, PATH, length=100).collect(), docs, 100)


def test_hot_id(spark):
    """A third of the rows under one id does not make one group."""
    docs = [(0 if i % 3 else i, f"text {i} " * 20) for i in range(300)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    found = op12.pack_documents(table, PATH, group=10).collect()
    check(found, docs)
    assert len({r.sequence_id // (4 * 10 * 2048) for r in found if r.doc_id == 0}) > 20


def test_empty_table(spark):
    assert op12.pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def ids(encoder, text):
    found, bounds = encoder.ids(pa.array(["a", text, "", text]))
    assert found[bounds[1]:bounds[2]].tolist() == found[bounds[3]:bounds[4]].tolist() and bounds[2] == bounds[3]
    return found[bounds[1]:bounds[2]].tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("aB'st <|endoftext|>\n.́Σ")), max_size=60))
def test_ids_are_the_librarys(text):
    assert ids(op12.encoder(PATH), text) == WHOLE.encode(text, add_special_tokens=False).ids


def test_plain_characters():
    """Each plain character alone, between letters and beside a mark of each kind."""
    plain = [chr(c) for c in range(0x2030) if not op12.OTHER.search(chr(c))]
    assert len(plain) > 350
    known = op12.Encoder(PATH)
    for c in plain:
        text = f"{c} a{c}b {c}{c} 1{c} '{c} {c}x. {c}."
        assert ids(known, text) == WHOLE.encode(text, add_special_tokens=False).ids, c


def test_another_vocabulary_is_encoded_whole():
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    text = "Two  words\n and 3 more "
    assert ids(op12.Encoder(path), text) == whole.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 63), max_size=80))
def test_first_fit_decreasing(sizes):
    bins = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = next((k for k, b in enumerate(bins) if sum(sizes[j] for j in b) + sizes[i] <= 64), None)
        if at is None:
            bins.append([i])
        else:
            bins[at].append(i)
    assert op12.first_fit_decreasing(sizes, 64) == bins
    filled = op12.fill(bins, sizes, 64)
    assert sorted((i, x) for b in filled for i, begin, end in b for x in range(begin, end)) == [
        (i, x) for i, n in enumerate(sizes) for x in range(n)]
    lengths = [sum(end - begin for _, begin, end in b) for b in filled]
    assert all(n == 64 or n in (1, 2, 4, 8, 16, 32) for n in lengths)
    assert len(lengths) <= -(-sum(sizes) // 64) + 6
