"""What the plans must not hold, and joins of either size."""

import pytest
from pyspark.sql import functions as F

import golden
from litsearch.operators import facets, index, joins, pages, search, topics
from litsearch.plans import standins as S
from litsearch.sources import scratch
from litsearch.sources.index_store import build_index, read_index, write_index
from test_queries import SF, pytestmark  # noqa: F401


def _plan(df, capsys):
    capsys.readouterr()
    df.explain("extended")
    return capsys.readouterr().out


def test_postings_are_built_without_a_shuffle(spark, capsys):
    docs = S.table(spark, SF, "documents")
    text = _plan(index.build_token_postings(docs, index.IndexConfig(text_fields=("text",))), capsys)
    physical = text[text.index("Physical Plan"):]
    assert "Exchange" not in physical
    assert "struct<doc_id:bigint,text:string>" in physical
    # the grouped words are made once per row, and nothing is carried beside them
    assert physical.count("sort_array") == 1


def test_search_opens_only_the_buckets_it_needs(spark, tmp_path, capsys):
    docs = S.table(spark, SF, "documents").select("doc_id", "text")
    path = str(tmp_path / "index")
    write_index(build_index(docs, index.IndexConfig(text_fields=("text",))), path, buckets=16)
    found = read_index(spark, path)
    clauses = S.clause_table(spark, [("q", 0, "text", "term", "the", "should")])
    hits = search.term_search(found, search.weigh_words(found, search.clause_words(clauses), True), True)
    text = _plan(hits, capsys)
    physical = text[text.index("Physical Plan"):]
    assert "dynamicpruning" in physical
    # and in them only the terms it is asked for
    assert "term,the" in physical.replace(" ", "") or "EqualTo(term,the)" in physical
    scans = [line for line in physical.splitlines() if "FileScan" in line and "doc_len" in line]
    assert scans and all("positions" not in line.split("ReadSchema")[1] for line in scans)
    # only the few words asked for are shuffled, never postings
    shuffles = [line for line in physical.splitlines() if "Exchange hashpartitioning" in line]
    assert all("doc_id" not in line for line in shuffles)
    assert physical.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in physical


def test_key_lookups_open_only_the_buckets_they_need(spark, tmp_path, capsys):
    docs = S.papers(spark, SF)
    path = str(tmp_path / "index")
    write_index(build_index(docs, index.KEYS), path, buckets=16)
    found = read_index(spark, path)
    clauses = S.clause_table(spark, [("q", 0, "ieee_keys", "key", "the", "must")])
    for df in (search.key_lookup(found.key_postings, clauses, found.buckets),
               search.key_status(found.key_dictionary, clauses, found.buckets),
               search.clause_selectivity(found.key_dictionary, clauses, found.buckets)):
        text = _plan(df, capsys)
        assert "dynamicpruning" in text[text.index("Physical Plan"):]
        assert df.count() >= 1


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_of_either_size(spark, rows, how):
    # one key holds a third of the rows
    left = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"))
    table = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("none", 4)], "key string, v int")
    small = joins.lookup_join(left, table, ["key"], how, small=True)
    large = joins.lookup_join(left, table, ["key"], how, small=False, hot_rows=70)
    assert small.columns == large.columns
    assert rows(small) == rows(large)
    hot = {r.key: r._parts for r in joins.hot_keys(left, ["key"], 70).collect()}
    assert hot == {"hot": 15}


def test_size_is_measured_in_rows_and_bytes(spark):
    table = spark.range(100).select("id", F.repeat(F.lit("x"), 50).alias("text"))
    assert joins.fits_broadcast(table)
    assert not joins.fits_broadcast(table, max_rows=99)
    assert not joins.fits_broadcast(table, max_bytes=4000)


def test_result_pages_read_only_their_documents(spark, tmp_path, capsys):
    docs = S.table(spark, SF, "documents").select("doc_id", "text")
    path = str(tmp_path / "index")
    write_index(build_index(docs, index.IndexConfig(text_fields=("text",))), path, buckets=4)
    found = read_index(spark, path)
    hits = spark.createDataFrame([("q", 3), ("q", 5)], "query_id string, doc_id long")
    physical = _plan(facets.show_documents(hits, found.docs, ("text",)), capsys)
    scan = next(line for line in physical.splitlines() if "FileScan" in line and "PushedFilters" in line)
    assert "In(doc_id" in scan


def test_phrases_move_positions_only_of_documents_with_all_words(spark, tmp_path, capsys):
    docs = S.table(spark, SF, "documents").select("doc_id", "text")
    path = str(tmp_path / "index")
    write_index(build_index(docs, index.IndexConfig(text_fields=("text",))), path, buckets=4)
    found = read_index(spark, path)
    clauses = S.clause_table(spark, [("q", 0, "text", "phrase", "of the and", "must")])
    weighted = search.weigh_words(found, search.clause_words(clauses), True)
    physical = _plan(search.phrase_search(found, weighted, True), capsys)
    physical = physical[physical.index("Physical Plan"):]
    assert physical.index("LeftSemi") > physical.index("collect_list")


def test_page_text_is_never_shuffled(spark, capsys):
    keys = spark.createDataFrame([("the",), ("and",)], "key string")
    matched = topics.match_wiki_pages(S.wiki(spark, SF), keys, small=False)
    physical = _plan(topics.topic_dictionary(matched), capsys)
    physical = physical[physical.index("Physical Plan"):]
    # the dump was read when the pages' answers were stored
    assert "revision" not in physical and "text" not in physical.replace("texts", "")
    small = _plan(topics.topic_dictionary(topics.match_wiki_pages(S.wiki(spark, SF), keys, small=True)), capsys)
    lines = [line for line in small[small.index("Physical Plan"):].splitlines() if "Exchange hash" in line]
    assert lines and all("text" not in line for line in lines)


def test_history_of_links_is_not_shuffled(spark, capsys):
    visited = spark.range(1000).select(F.concat(F.lit("u"), "id").alias("url"))
    links = spark.createDataFrame([(1, "u1"), (2, "new"), (1, "new")], "page_id long, url string")
    small = pages.frontier(links, visited)
    physical = _plan(small, capsys)
    physical = physical[physical.index("Physical Plan"):]
    assert "LeftSemi, BuildRight" in physical and "SortMergeJoin" not in physical
    want = [("new", 1)]
    for small in (True, False):
        assert [tuple(r) for r in pages.frontier(links, visited, small=small).select("url", "page_id").collect()] == want


def test_ranking_all_hits_sorts_no_query_in_one_task(spark, capsys):
    matches = spark.range(100).select(F.lit("q").alias("query_id"), F.col("id").alias("doc_id"),
                                      F.rand(1).alias("score"))
    physical = _plan(search.rank_bm25(matches), capsys)
    physical = physical[physical.index("Physical Plan"):]
    numbered = [line for line in physical.splitlines() if "row_number()" in line and "Window " in line]
    assert numbered and all("_range" in line for line in numbered)


def test_all_hits_of_one_query_are_ranked_in_slices(spark, capsys):
    clauses = S.clause_table(spark, golden.SAMPLE_CLAUSES)
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, title string")
    found = build_index(docs, index.IndexConfig(text_fields=("title",)))
    text = _plan(search.search(found, clauses, 2000, "title"), capsys)
    physical = text[text.index("Physical Plan"):]
    windows = [line for line in physical.splitlines() if "row_number()" in line and "Window " in line]
    assert any("slice" in line for line in windows)


def test_scratch_tables_can_be_dropped(spark, tmp_path, monkeypatch):
    # in a session folder of its own, as other tests still read theirs
    monkeypatch.setattr(scratch, "_session_folder", lambda _: f"{tmp_path}/session")
    assert scratch.materialise(spark.range(3), "three").count() == 3
    assert list(tmp_path.glob("session/*/three"))
    scratch.drop_scratch(spark)
    assert not list(tmp_path.glob("session/*"))


def test_hot_postings_are_limited_by_the_rarest_clause(spark, tmp_path, capsys):
    """Postings of a frequent key are filtered by the rare key's documents before they are shuffled."""
    docs = S.papers(spark, SF)
    path = str(tmp_path / "index")
    write_index(build_index(docs, index.KEYS), path, buckets=16)
    found = read_index(spark, path)
    by_count = found.key_dictionary.filter("field = 'ieee_keys'").orderBy("df", "term").collect()
    clauses = S.clause_table(spark, [("q", 0, "ieee_keys", "key", by_count[0].term, "must"),
                                     ("q", 1, "ieee_keys", "key", by_count[-1].term, "must")])
    for df in (search.key_search(found.key_postings, found.key_dictionary, clauses, found.buckets),
               search.search(found, clauses, n=5)):
        text = _plan(df, capsys)
        physical = text[text.index("Physical Plan"):]
        lines = physical.splitlines()
        scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "doc_id#" in line and "bucket#" in line)
        above = [line for line in reversed(lines[:scan])]
        exchange = next(i for i, line in enumerate(above) if "Exchange hashpartitioning" in line)
        assert any("_inside" in line for line in above[:exchange])
