import random

import golden
import pytest
from pyspark.sql import functions as F

from litsearch.functions import bm25
from litsearch.operators import facets, index, search
from litsearch.plans.answers import compare_clauses, compare_topics, documents_by_clause
from litsearch.plans.standins import clause_table
from litsearch.sources.index_store import build_index, read_index, write_index


@pytest.fixture(scope="module")
def corpus(spark):
    lists = {"ieee_keys", "author_keys", "merged_keys", "combined_topics"}
    schema = ", ".join(
        f"{c} {'long' if c == 'doc_id' else 'array<string>' if c in lists else 'string'}"
        for c in golden.CORPUS_COLUMNS)
    return spark.createDataFrame(golden.CORPUS, schema)


@pytest.fixture(scope="module", params=["plan", "written"])
def found(request, spark, corpus, tmp_path_factory):
    built = build_index(corpus, index.GENERAL)
    if request.param == "plan":
        return built
    path = str(tmp_path_factory.mktemp("index") / "general")
    write_index(built, path)
    return read_index(spark, path)


def _by_query(df):
    answer = {}
    for r in df.collect():
        answer.setdefault(r.query_id, set()).add(r.doc_id)
    return answer


def test_six_sample_queries(spark, found):
    clauses = clause_table(spark, golden.SAMPLE_CLAUSES)
    ranked = search.search(found, clauses)
    assert _by_query(ranked) == golden.SAMPLE_ANSWERS


def test_topic_counts_of_the_sample_queries(spark, found):
    rows = [c for c in golden.SAMPLE_CLAUSES if c[0] in golden.SAMPLE_COUNTS]
    answer = compare_topics(found, clause_table(spark, rows))
    counts = {}
    for r in answer.counts.collect():
        counts.setdefault(r.query_id, []).append((r.topic, r.n_docs))
    assert counts == golden.SAMPLE_COUNTS
    # "regulation" finds document 6, which has neither topic as a whole key
    assert _by_query(answer.by_topic) == {"s2": {4, 5}, "s5": {10, 11}}
    # document 10 holds two topics and is shown under the first of them
    first = {r.doc_id: r.topic for r in answer.by_topic.filter("query_id = 's5'").collect()}
    assert first == {10: "data security", 11: "quality control"}


def test_display_holds_what_is_shown(spark, found):
    rows = [c for c in golden.SAMPLE_CLAUSES if c[0] == "s5"]
    ranked = search.search(found, clause_table(spark, rows))
    shown = facets.results_by_score(ranked, found.docs).collect()
    assert [r.rank for r in shown] == [1, 2]
    assert {r.title for r in shown} == {"Swarm analysis", "Federated systems"}
    assert shown[0].combined_topics and set(facets.SHOWN) <= set(shown[0].asDict())
    assert facets.results_by_score(ranked, found.docs, facets.SHOWN_BY_KEYS).count() == 2


def test_must_not_and_optional_should(spark, found):
    clauses = clause_table(spark, [
        ("a", 0, "title", "term", "federated", "must"),
        ("a", 1, "combined_topics", "phrase", "machine learning", "must_not"),
        ("b", 0, "title", "term", "federated", "must"),
        ("b", 1, "combined_topics", "phrase", "machine learning", "should"),
        ("c", 0, "title", "term", "federated", "must_not"),
        ("d", 0, "title", "term", "federated", "must"),
        ("d", 1, "title", "term", "absent", "must"),
        ("e", 0, None, "term", "privacy", "should"),
    ])
    ranked = search.search(found, clauses)
    assert _by_query(ranked) == {"a": {12}, "b": {11, 12}, "e": {11, 12}}
    best = ranked.filter("query_id = 'b' and rank = 1").first()
    assert best.doc_id == 11


def test_phrase_with_repeated_and_missing_words(spark, rows):
    docs = spark.createDataFrame(
        [(1, "a b a b a"), (2, "a a b"), (3, "b a")], "doc_id long, title string")
    found = build_index(docs, index.IndexConfig(text_fields=("title",)))
    clauses = clause_table(spark, [
        ("p1", 0, "title", "phrase", "a b a", "must"),
        ("p2", 0, "title", "phrase", "a a", "must"),
        ("p3", 0, "title", "phrase", "a absent", "must"),
        ("p4", 0, "title", "phrase", "b a", "must"),
    ])
    weighted = search.weigh_words(found, search.clause_words(clauses))
    hits = search.phrase_search(found, weighted)
    assert rows(hits, "query_id", "doc_id") == [("p1", 1), ("p2", 2), ("p4", 1), ("p4", 3)]


def test_phrases_span_values_unless_there_is_a_gap(spark):
    docs = spark.createDataFrame([(1, ["deep learning", "data"])], "doc_id long, keys array<string>")
    clauses = clause_table(spark, [("q", 0, "keys", "phrase", "learning data", "must")])
    for gap, n in ((0, 1), (5, 0)):
        found = build_index(docs, index.IndexConfig(list_fields=("keys",), position_gap=gap))
        assert search.search(found, clauses).count() == n


def test_rest_of_the_words_may_go_to_another_field(spark, found):
    clauses = clause_table(spark, [
        ("q", 0, "merged_keys", "any_word", "tools privacy", "should")])
    assert _by_query(search.search(found, clauses)) == {"q": {7}}
    moved = search.search(found, clauses, rest_field="combined_topics")
    assert _by_query(moved) == {"q": {7, 11, 12}}


def test_exact_keys_in_boolean_queries(spark, found):
    clauses = clause_table(spark, [
        ("q", 0, "merged_keys", "key", "Data Science", "must"),
        ("q", 1, "content", "term", "python", "must"),
        ("r", 0, "merged_keys", "key", "data", "must"),
    ])
    assert _by_query(search.search(found, clauses)) == {"q": {7}, "r": {8}}


def test_patterns(spark, found):
    clauses = clause_table(spark, [
        ("prefix", 0, "combined_topics", "prefix", "volt", "should"),
        ("wild", 0, "combined_topics", "wildcard", "w?re", "should"),
        ("star", 0, "combined_topics", "wildcard", "r*n", "should"),
        ("fuzzy", 0, "combined_topics", "fuzzy", "topolgy", "should"),
        ("range", 0, "combined_topics", "range", "water to wire", "should"),
        ("both", 0, None, "prefix", "volt", "must"),
        ("both", 1, "combined_topics", "term", "energy", "must"),
    ])
    assert _by_query(search.search(found, clauses)) == {
        "prefix": {4, 5}, "wild": {10}, "star": {5, 6}, "fuzzy": {9, 10}, "range": {6, 10},
        "both": {4}}


def test_large_clause_tables_give_the_same_hits(spark, found, rows):
    clauses = clause_table(spark, golden.SAMPLE_CLAUSES)
    words = search.clause_words(clauses)
    for operator in (search.term_search, search.phrase_search):
        hits = [rows(operator(found, search.weigh_words(found, words, small), small)
                     .withColumn("score", F.round("score", 6))) for small in (True, False)]
        assert hits[0] == hits[1] and hits[0]


def test_ranking_in_slices_equals_plain_ranking(spark):
    matches = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "q1").otherwise("q2").alias("query_id"),
        F.col("id").alias("doc_id"), (F.col("id") % 97 / 7).alias("score"))
    ranked = search.rank_bm25(matches, 1500).collect()
    for query, keep in (("q1", lambda i: i % 3 == 0), ("q2", lambda i: i % 3 != 0)):
        want = sorted((i for i in range(5000) if keep(i)), key=lambda i: (-(i % 97), i))[:1500]
        got = [r.doc_id for r in sorted((r for r in ranked if r.query_id == query),
                                        key=lambda r: r.rank)]
        assert got == want
    assert search.rank_bm25(matches, None).count() == 5000


@pytest.mark.parametrize("n", [5000, 30])
def test_every_match_has_a_rank(spark, n):
    matches = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "q1").otherwise("q2").alias("query_id"),
        F.col("id").alias("doc_id"), (F.col("id") % 97 / 7).alias("score"))
    ranked = search.rank_bm25(matches).collect()
    for query, keep in (("q1", lambda i: i % 3 == 0), ("q2", lambda i: i % 3 != 0)):
        want = sorted((i for i in range(n) if keep(i)), key=lambda i: (-(i % 97), i))
        got = sorted((r.rank, r.doc_id) for r in ranked if r.query_id == query)
        assert got == list(enumerate(want, 1))


def test_counts_are_over_all_hits(spark):
    """More hits than any page shows: counts and lists hold them all."""
    docs = spark.range(2600).select(
        F.col("id").alias("doc_id"), F.lit("same words").alias("title"),
        F.when(F.col("id") % 2 == 0, F.array(F.lit("wire"))).otherwise(F.array(F.lit("wire"), F.lit("other")))
        .alias("combined_topics"))
    found = build_index(docs, index.GENERAL)
    clauses = clause_table(spark, [
        ("q", 0, "combined_topics", "any_word", "wire", "should"),
        ("q", 1, "combined_topics", "any_word", "other", "should")])
    answer = compare_topics(found, clauses)
    assert {r.topic: r.n_docs for r in answer.counts.collect()} == {"wire": 2600, "other": 1300}
    assert answer.by_topic.count() == 2600
    hits, counts = compare_clauses(found, clauses)
    assert hits.count() == 2600 and {r.n_docs for r in counts.collect()} == {2600, 1300}
    shown = documents_by_clause(found, clauses)
    assert shown.filter("clause_id = 1").count() == 1300
    ranks = [r.rank for r in facets.results_by_score(hits, found.docs, ("title",)).collect()]
    assert ranks == list(range(1, 2601))


def test_bm25_against_plain_arithmetic(spark):
    import math
    row = spark.range(1).select(
        bm25.score(bm25.idf(F.lit(10), F.lit(3)), F.lit(2), F.lit(8), F.lit(4.0)).alias("s")).first()
    idf = math.log(1 + (10 - 3 + 0.5) / (3 + 0.5))
    assert row.s == pytest.approx(idf * 2 * 2.2 / (2 + 1.2 * (1 - 0.75 + 0.75 * 8 / 4.0)))


def test_pairs_are_trimmed_and_rejects_kept(spark, rows):
    texts = spark.createDataFrame([
        ("a", "Ieee_keys:Voltage , merged_keys: data science"), ("b", "nonsense"), ("c", "a:b:c,d:e"),
    ], "query_id string, query_text string")
    pairs = search.split_pairs(texts)
    assert {tuple(r) for r in pairs.collect()} == {
        ("a", 0, "ieee_keys", "voltage", None), ("a", 1, "merged_keys", "data science", None),
        ("b", 0, None, None, "Wrong query format"), ("c", 0, None, None, "Wrong query format"),
        ("c", 1, "d", "e", None)}
    clauses = search.pair_clauses(pairs, "key", "must")
    assert clauses.columns == ["query_id", "clause_id", "field", "kind", "value", "occur"]
    assert clauses.count() == 3


@pytest.fixture(scope="module")
def keyed(spark):
    docs = spark.createDataFrame([
        (1, ["Deep", "Net"], ["x"]), (2, ["deep"], ["net", "x"]), (3, ["net", "net"], ["deep", "y"]),
        (4, ["y"], ["y"]),
    ], "doc_id long, ieee_keys array<string>, author_keys array<string>")
    return index.build_key_postings(docs, ("ieee_keys", "author_keys"))


def test_key_and_counts_conditions_by_clause(spark, keyed, rows):
    clauses = clause_table(spark, [
        ("one", 0, "ieee_keys", "key", "deep", "must"),
        ("two", 0, "ieee_keys", "key", "deep", "must"),
        ("two", 1, "author_keys", "key", "net", "must"),
        # the same key in two columns is two conditions
        ("same", 0, "ieee_keys", "key", "y", "must"),
        ("same", 1, "author_keys", "key", "y", "must"),
        ("three", 0, "ieee_keys", "key", "net", "must"),
        ("three", 1, "author_keys", "key", "deep", "must"),
        ("three", 2, "author_keys", "key", "y", "must"),
        ("absent", 0, "ieee_keys", "key", "deep", "must"),
        ("absent", 1, "ieee_keys", "key", "zzzz", "must"),
    ])
    hits = search.key_lookup(keyed, clauses)
    assert rows(hits.filter("query_id = 'one'"), "doc_id", "tf") == [(1, 1), (2, 1)]
    assert rows(search.key_and(hits, clauses)) == [
        ("one", 1), ("one", 2), ("same", 4), ("three", 3), ("two", 2)]
    terms = index.term_dictionary(keyed)
    missing = search.key_status(terms, clauses).filter("df = 0")
    assert rows(missing, "query_id", "term", "status") == [
        ("absent", "zzzz", "Term does not exist in index")]
    order = search.clause_selectivity(terms, clauses).filter("query_id = 'three'")
    assert rows(order, "place", "term", "cf") == [(1, "deep", 1), (2, "y", 2), (3, "net", 3)]


def test_counts_by_clause_only_count_real_matches(spark, found, rows):
    clauses = clause_table(spark, [
        ("q", 0, "combined_topics", "term", "privacy", "should"),
        ("q", 1, "title", "phrase", "analysis swarm", "should"),
        ("q", 2, "title", "term", "absent", "should"),
    ])
    hits, counts = compare_clauses(found, clauses)
    assert hits.count() == 3
    assert rows(counts) == [("q", 0, 2), ("q", 1, 1)]


def test_distinct_documents_and_occurrences(spark):
    docs = spark.createDataFrame([
        (1, ["Wire", "wire "], ["WIRE"]), (2, ["wire"], []), (3, ["other"], ["wire", ""]),
    ], "doc_id long, combined_topics array<string>, merged_keys array<string>")
    found = build_index(docs, index.IndexConfig(list_fields=("combined_topics", "merged_keys")))
    clauses = clause_table(spark, [
        ("a", 0, "combined_topics", "any_word", "wire ", "should"),
        ("b", 0, "combined_topics", "any_word", "wire", "should"),
        ("b", 1, "merged_keys", "any_word", "other", "should"),
    ])
    counts = {(r.query_id, r.topic): r.n_docs
              for r in compare_topics(found, clauses).counts.collect()}
    # query b names both columns, so its topics count in either: document 3 is no hit of b
    # by words, as "other" is asked in the other column
    assert counts == {("a", "wire"): 2, ("b", "wire"): 2}
    often = compare_topics(found, clauses, distinct=False, fields=("combined_topics",)).counts
    assert {(r.query_id, r.n_docs) for r in often.collect()} == {("a", 3), ("b", 3)}


def test_text_columns_count_by_their_whole_value(spark, found):
    clauses = clause_table(spark, [
        ("q", 0, "author", "any_word", "Nobody", "should"),
        ("q", 1, "author", "any_word", "wei li", "should"),
        ("q", 2, "author", "any_word", "wei li;xu wei", "should"),
    ])
    counts = {r.topic: r.n_docs for r in compare_topics(found, clauses).counts.collect()}
    assert counts == {"nobody": 10, "wei li;xu wei": 1}


def test_counts_never_exceed_occurrences(spark, found):
    clauses = clause_table(spark, [
        ("q", i, "combined_topics", "any_word", t, "should")
        for i, t in enumerate(["voltage", "topology", "privacy", "wire", "machine learning"])])
    fields = ("combined_topics",)
    docs = {r.topic: r.n_docs for r in compare_topics(found, clauses).counts.collect()}
    often = {r.topic: r.n_docs for r in
             compare_topics(found, clauses, distinct=False, fields=fields).counts.collect()}
    assert docs.keys() == often.keys() and all(docs[t] <= often[t] for t in docs)


def test_top_n_limits_what_is_counted(spark, found):
    rows = [c for c in golden.SAMPLE_CLAUSES if c[0] == "s5"]
    clauses = clause_table(spark, rows)
    assert compare_topics(found, clauses, n=1).hits.count() == 1
    assert compare_topics(found, clauses, n=None).hits.count() == 2


def test_and_is_inside_or(spark, found):
    words = ["privacy", "learning"]
    queries = {
        "and": [("and", i, "combined_topics", "term", w, "must") for i, w in enumerate(words)],
        "or": [("or", i, "combined_topics", "term", w, "should") for i, w in enumerate(words)],
        "one": [("one", 0, "combined_topics", "term", words[0], "should")],
        "two": [("two", 0, "combined_topics", "term", words[1], "should")],
    }
    got = _by_query(search.search(found, clause_table(spark, sum(queries.values(), []))))
    assert got["and"] == got["one"] & got["two"] and got["or"] == got["one"] | got["two"]


def _random_queries(seed, values):
    r = random.Random(seed)
    out = []
    for q in range(14):
        for c in range(r.randint(1, 4)):
            kind = r.choice(["key", "term", "term", "any_word", "phrase", "prefix"])
            field = r.choice(["merged_keys", "combined_topics", None])
            out.append((f"q{q}", c, field, kind, r.choice(values), r.choice(["must", "must", "should", "must_not"])))
    return out


@pytest.mark.parametrize("most", [search.MOST_LIMITING, 3])
def test_rarest_documents_change_no_answer(spark, found, corpus, rows, monkeypatch, most):
    monkeypatch.setattr(search, "MOST_LIMITING", most)
    values = sorted({v for r in corpus.collect() for v in [*(r.merged_keys or []), *(r.combined_topics or [])]})
    clauses = clause_table(spark, _random_queries(7, [*values, "energy", "volt", "nothing here"]))
    plain = search.rank_all(search.boolean_search(search.all_clause_hits(found, clauses), clauses))
    got = search.search(found, clauses)
    def rounded(df):
        return rows(df.select("query_id", "doc_id", F.round("score", 6).alias("score"), "rank"))
    assert rounded(got) == rounded(plain) and got.count() >= 5


def test_key_search_equals_counting_all_hits(spark, keyed, rows):
    r = random.Random(5)
    keys = [(x.field, x.term) for x in keyed.select("field", "term").distinct().collect()] + [("author_keys", "none")]
    clauses = clause_table(
        spark, [(f"q{q}", c, f, "key", t, "must") for q in range(60) for c in range(r.randint(1, 4))
                for f, t in [r.choice(keys)]])
    want = rows(search.key_and(search.key_lookup(keyed, clauses), clauses))
    assert rows(search.key_search(keyed, index.term_dictionary(keyed), clauses)) == want and want
