"""Terms found through lookup tables against all terms of a dictionary."""

import random

import pytest
from pyspark.sql import functions as F

from litsearch.operators import expansion, search
from litsearch.operators.expansion import Lookups, bucketed, gram_counts, term_deletions, term_grams
from litsearch.plans.standins import clause_table
from litsearch.sources.scratch import materialise
from test_plans import _plan

r = random.Random(3)


def _word(least, most, letters="abc"):
    return "".join(r.choice(letters) for _ in range(r.randint(least, most)))


TERMS = sorted({_word(1, 12) for _ in range(900)} | {_word(1, 5, "xyz") for _ in range(200)} | {
    "über", "überall", "中文字", "中文", "a.b", "a+b(c", "q" * 300, "q" * 150 + "z" + "q" * 150, "naïve", "naive"})


@pytest.fixture(scope="module")
def dictionary(spark):
    rows = [(f, t, 1, 1) for t in TERMS for f in ("one", "two") if f == "one" or len(t) % 2]
    return spark.createDataFrame(rows, "field string, term string, df long, cf long").cache()


@pytest.fixture(scope="module")
def lookups(dictionary):
    grams = term_grams(dictionary)
    tables = [(grams, "gram"), (gram_counts(grams), "gram"), (term_deletions(dictionary), "key")]
    return Lookups(*[materialise(bucketed(t, c, 4), "lookups") for t, c in tables], 4)


def _clauses(spark, kind, values):
    return clause_table(spark, [(f"{kind}{i}", i % 3, ("one", "two", "none")[i % 7 // 3], kind, v, "should")
                                for i, v in enumerate(values)])


WILD = ["*", "?", "", "a", "*a", "*ab", "*abc", "?bc*", "*a?b*c", "*b*", "??", "*überall", "?ber*", "*文*", "*.b", "*+b(c",
        "*zq*", "*" + "q" * 20, "a*", "ab?c*", "**abc**", "*none", "*ABC"] + [
    "*" + "".join(r.choice("abc?*") for _ in range(r.randint(1, 7))) for _ in range(60)]
FUZZY = ["", "a", "zzzzzzzz", "uber", "naive", "中", "q" * 299, "q" * 297, "ABCA"] + [
    _word(1, 12) for _ in range(60)] + [_word(1, 4, "xyz") for _ in range(10)]


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("kind, values", [("wildcard", WILD), ("fuzzy", FUZZY)])
def test_same_terms_as_without_lookups(spark, dictionary, lookups, rows, kind, values, small):
    clauses = _clauses(spark, kind, values)
    want = rows(search.term_expand(dictionary, clauses, small=small))
    assert rows(search.term_expand(dictionary, clauses, small=small, lookups=lookups)) == want
    assert len(want) > 300


def test_empty_clauses_and_dictionary(spark, dictionary, lookups):
    none = _clauses(spark, "fuzzy", ["a"]).limit(0)
    assert search.term_expand(dictionary, none, lookups=lookups).count() == 0
    empty = Lookups(*[t.limit(0) for t in (lookups.grams, lookups.gram_counts, lookups.deletions)], 4)
    clauses = _clauses(spark, "wildcard", ["*abc"]).unionByName(_clauses(spark, "fuzzy", ["abc"]))
    assert search.term_expand(dictionary.limit(0), clauses, lookups=empty).count() == 0


def test_terms_two_edits_apart_share_a_key(spark):
    """Every pair of 60,000 made by up to two random edits; a term has few keys however long."""
    pairs = []
    for _ in range(60_000):
        a = list(_word(0, 14, "abcdé"))
        b = list(a)
        for _ in range(r.randint(0, 2)):
            at, what = r.randint(0, len(b)), r.randint(0, 2)
            if what == 0:
                b.insert(at, r.choice("abcdé"))
            elif at < len(b):
                b[at:at + 1] = [] if what == 1 else [r.choice("abcdé")]
        pairs.append(("".join(a), "".join(b)))
    table = spark.createDataFrame(pairs, "a string, b string")
    keys = [expansion.deletion_keys(F.col(c)) for c in ("a", "b")]
    assert table.filter(~F.arrays_overlap(*keys)).count() == 0
    assert table.select(F.max(F.size(keys[0]))).first()[0] <= 37


def test_a_dictionary_is_not_met_as_a_whole(spark, dictionary, lookups, capsys):
    """Neither a leading wildcard nor a fuzzy word is joined with all terms of its field."""
    clauses = _clauses(spark, "wildcard", ["*abc", "?bca*"]).unionByName(_clauses(spark, "fuzzy", ["abc"]))
    text = _plan(search.term_expand(dictionary, clauses, small=True, lookups=lookups), capsys)
    physical = text[text.index("Physical Plan"):]
    joins = [line for line in physical.splitlines() if "HashJoin" in line or "SortMergeJoin" in line]
    assert joins and not any("[field#" in line and line.split("[field#")[1].split("]")[0].count("#") == 0
                             for line in joins)
    assert "df#" not in physical  # the dictionary itself is not in the plan


def test_only_the_rarest_grams_are_read(spark, dictionary, lookups):
    """A pattern of many grams is looked up by its two rarest ones."""
    patterns = spark.createDataFrame([("q", 0, "one", "*" + "abc" * 3)], "query_id string, clause_id int, field string, wanted string")
    found = expansion.wildcard_candidates(lookups, patterns, True).select("term").collect()
    grams = {g.gram: g.n for g in lookups.gram_counts.filter("field = 'one'").collect()}
    rare = sorted((grams.get(g, 0), g) for g in ("abc", "bca", "cab", "bc" + expansion.END))[:2]
    want = {t for t in TERMS if all(g in expansion.BEGIN + t + expansion.END for _, g in rare)}
    assert {f.term for f in found} == want


@pytest.fixture(scope="module")
def segmented(dictionary, lookups):
    """Lookups as an index written now has them."""
    segments = materialise(bucketed(expansion.term_segments(dictionary), "key", 4), "lookups")
    return Lookups(lookups.grams, lookups.gram_counts, None, 4, segments)


@pytest.mark.parametrize("small", [True, False])
def test_same_fuzzy_terms_by_segments(spark, dictionary, segmented, rows, small):
    clauses = _clauses(spark, "fuzzy", FUZZY)
    want = rows(search.term_expand(dictionary, clauses, small=small))
    assert rows(search.term_expand(dictionary, clauses, small=small, lookups=segmented)) == want
    assert len(want) > 300


def test_terms_two_edits_apart_share_a_segment(spark):
    pairs = []
    for _ in range(60_000):
        a = list(_word(0, 14, "abcdé"))
        b = list(a)
        for _ in range(r.randint(0, 2)):
            at, what = r.randint(0, len(b)), r.randint(0, 2)
            if what == 0:
                b.insert(at, r.choice("abcdé"))
            elif at < len(b):
                b[at:at + 1] = [] if what == 1 else [r.choice("abcdé")]
        pairs.append(("".join(a), "".join(b)))
    table = spark.createDataFrame(pairs, "a string, b string")
    shared = F.arrays_overlap(expansion.segment_keys(F.col("a")), expansion.asked_segment_keys(F.col("b")))
    assert table.filter(~shared).count() == 0
    assert table.select(F.max(F.size(expansion.segment_keys(F.col("a"))))).first()[0] == 3
