import pytest
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from litsearch.functions.runs import cut_runs, sorted_places, term_runs
from litsearch.operators import index
from litsearch.sources.index_store import build_index, read_index, write_index


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([
        (1, "The cat. The CAT!", ["Data Science", "data science", "Graphs", ""], ["graphs"]),
        (2, "a cat's 2nd life", ["DATA"], None),
        (3, "", [], ["x", "x y"]),
        (4, None, None, ["Graphs"]),
    ], "doc_id long, title string, ieee_keys array<string>, author_keys array<string>")


CONFIG = index.IndexConfig(list_fields=("ieee_keys", "author_keys"), text_fields=("title",))


def test_words_with_positions(spark, docs, rows):
    found = index.build_token_postings(docs, index.IndexConfig(text_fields=("title",)))
    assert rows(found, "term", "doc_id", "tf", "doc_len", "positions") == [
        ("2nd", 2, 1, 5, [3]),
        ("a", 2, 1, 5, [0]),
        ("cat", 1, 2, 4, [1, 3]),
        ("cat", 2, 1, 5, [1]),
        ("life", 2, 1, 5, [4]),
        ("s", 2, 1, 5, [2]),
        ("the", 1, 2, 4, [0, 2]),
    ]


def test_marks_belong_to_their_word(spark):
    text = "\u0939\u093f\u0928\u094d\u0926\u0940 cafe\u0301 don't snake_case"
    docs = spark.createDataFrame([(1, text)], "doc_id long, title string")
    found = index.build_token_postings(docs, index.IndexConfig(text_fields=("title",)))
    assert {r.term for r in found.collect()} == {
        "\u0939\u093f\u0928\u094d\u0926\u0940", "cafe\u0301", "don", "t", "snake", "case"}


@pytest.mark.parametrize("gap, graphs", [(0, [4]), (10, [24])])
def test_values_of_a_field_follow_each_other(spark, docs, gap, graphs):
    config = index.IndexConfig(list_fields=("ieee_keys",), position_gap=gap)
    found = index.build_token_postings(docs, config)
    one = {r.term: r for r in found.filter("doc_id = 1").collect()}
    assert one["graphs"].positions == graphs and one["data"].tf == 2
    assert {r.doc_len for r in one.values()} == {5}
    assert {(r.n_docs, r.avg_len) for r in index.field_stats(found).collect()} == {(2, 3.0)}


def test_whole_keys_count_repeats(spark, docs, rows):
    found = index.build_key_postings(docs, ("ieee_keys", "author_keys"))
    assert rows(found, "field", "term", "doc_id", "tf") == [
        ("author_keys", "graphs", 1, 1),
        ("author_keys", "graphs", 4, 1),
        ("author_keys", "x y", 3, 1),
        ("author_keys", "x", 3, 1),
        ("ieee_keys", "data science", 1, 2),
        ("ieee_keys", "data", 2, 1),
        ("ieee_keys", "graphs", 1, 1),
    ]


def test_dictionary_and_lengths_agree_with_postings(spark, docs):
    postings = index.build_token_postings(docs, CONFIG)
    terms = index.term_dictionary(postings)
    assert terms.filter("df > cf").isEmpty()
    total = postings.groupBy("field", "doc_id").agg(F.sum("tf").alias("n"))
    lengths = index.doc_lengths(postings)
    assert lengths.count() == total.count()
    assert lengths.join(total, ["field", "doc_id"]).filter("n <> doc_len").isEmpty()
    ordered = [(r.field, r.term) for r in index.sorted_dictionary(terms).collect()]
    assert ordered == sorted(ordered)


def test_stored_fields_are_not_searched(spark, docs, rows):
    config = index.IndexConfig(list_fields=("ieee_keys",), stored_fields=("title",))
    found = build_index(docs, config)
    assert rows(found.postings.select("field").distinct()) == [("ieee_keys",)]
    assert found.docs.columns == ["doc_id", "title", "ieee_keys"]


def test_presets_choose_columns():
    assert set(index.GENERAL.searched) >= {"title", "combined_topics", "merged_keys", "ieee_keys"}
    assert set(index.TOPICS.searched) == {"combined_topics", "merged_keys"}
    assert set(index.KEYS.searched) == {"ieee_keys", "author_keys", "merged_keys"}
    assert "title" in index.KEYS.stored_fields and "title" in index.TOPICS.stored_fields


def test_presets_leave_no_column_out(spark):
    docs = spark.createDataFrame(
        [(1, "t", "note", 3, ["k"], ["x"])],
        "doc_id long, title string, remark string, n int, ieee_keys array<string>, tags array<string>")
    general, keys = index.GENERAL.within(docs), index.KEYS.within(docs)
    assert set(general.searched) == {"title", "remark", "ieee_keys", "tags"}
    assert general.stored_fields == ("n",)
    assert set(keys.searched) == {"ieee_keys"} and set(keys.stored_fields) == {"title", "remark", "n", "tags"}
    for preset in index.PRESETS.values():
        assert set(build_index(docs, preset).docs.columns) == set(docs.columns)


def test_documents_that_share_an_id_are_refused(spark, docs, tmp_path):
    with pytest.raises(ValueError):
        write_index(build_index(docs.unionByName(docs), CONFIG), str(tmp_path / "twice"))


def test_written_index_reads_back(spark, docs, rows, tmp_path):
    path = str(tmp_path / "index")
    built = build_index(docs, CONFIG)
    write_index(built, path, buckets=3)
    stored = read_index(spark, path)
    assert stored.buckets == 3
    for name in ("postings", "dictionary", "stats", "key_postings", "key_dictionary", "docs"):
        left, right = getattr(built, name), getattr(stored, name)
        assert rows(left) == rows(right, *left.columns), name
    with pytest.raises(AnalysisException):
        write_index(built, path)


def test_catalog_tables_are_bucketed_by_unique_keys(spark, docs, rows, tmp_path):
    write_index(build_index(docs, CONFIG), str(tmp_path / "index"), buckets=2, table_prefix="small")
    try:
        assert spark.table("small_docs").count() == 4
        described = {r.col_name: r.data_type for r in
                     spark.sql("DESCRIBE EXTENDED small_dictionary").collect()}
        assert described["Num Buckets"] == "2" and "term" in described["Bucket Columns"]
    finally:
        spark.sql("DROP TABLE small_docs")
        spark.sql("DROP TABLE small_dictionary")


@pytest.mark.parametrize("most", [1, 3, 1000])
def test_runs_cut_over_many_rows_are_those_of_one_row(spark, rows, most):
    docs = spark.createDataFrame([
        (1, "a", ["b", "a", None, "b", "é", "a"]), (1, "a", ["b"]), (None, "b", ["b", "b"]), (3, "a", []),
        (4, "b", [None]), (5, "a", ["x"] * 9)], "doc_id long, field string, terms array<string>").coalesce(1)
    want = docs.select("doc_id", "field", F.explode(term_runs(F.col("terms"), with_nulls=True)).alias("run"))
    got = docs.select("doc_id", "field", sorted_places(F.col("terms"), with_nulls=True).alias("places")).mapInArrow(
        cut_runs(most), "field string, term string, doc_id long, tf long, doc_len long, positions array<int>")
    assert rows(got, "doc_id", "field", "term", "tf", "positions", "doc_len") == rows(
        want.select("doc_id", "field", "run.*"))


def test_an_index_computes_its_postings_once_and_few_keys_a_term(spark, docs, tmp_path, monkeypatch):
    """Finding ranges would compute what is written twice; a term had up to 37 keys."""
    cut = []
    plain = type(docs).repartitionByRange
    monkeypatch.setattr(type(docs), "repartitionByRange", lambda df, *on: cut.append(on) or plain(df, *on))
    write_index(build_index(docs, CONFIG), str(tmp_path / "index"), buckets=2)
    assert cut == [("doc_id",)]
    found = read_index(spark, str(tmp_path / "index"))
    assert found.lookups.deletions is None
    assert found.lookups.segments.count() == 3 * found.dictionary.count()
