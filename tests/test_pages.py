import re

import golden
from pyspark.sql import functions as F

from litsearch.fixed_values import PAPER_LISTS, PAPER_RULES
from litsearch.functions.text import decode_list, doc_key, encode_list, flatten_html
from litsearch.operators import pages
from litsearch.sources.pages import (
    count_documents, peek, read_page_files, read_page_lines, row_cap, write_page_files, write_page_lines,
)


def _pages(spark):
    return spark.createDataFrame(list(enumerate(golden.PAPER_PAGES)), "page_id long, html string")


def test_all_fields_of_a_paper(spark):
    found = {r.page_id: r for r in pages.extract_papers(_pages(spark)).collect()}
    first = found[0]
    assert (first.link, first.title, first.author, first.content, first.publisher, first.year,
            first.pages) == ("https://x.org/document/1", "First title", "Ada Byron",
                             "A first abstract.", "IEEE", "03 May 2019", "12")
    assert (first.ieee_keys, first.author_keys) == (["Deep learning", "Voltage"], ["graphs"])


def test_missing_markers_give_empty_values(spark):
    found = {r.page_id: r for r in pages.extract_papers(_pages(spark)).collect()}
    assert (found[1].title, found[1].year, found[1].content) == ("Second title", "2020", "")
    assert (found[1].ieee_keys, found[1].author_keys) == ([], ["c++", "python"])
    assert found[4].link == found[4].title == "" and found[4].author_keys == []


def test_patterns_find_what_python_finds(spark):
    """Blanks of every script count, and a dot stands for any character of the line."""
    unusual = spark.createDataFrame(
        list(enumerate(golden.PAPER_PAGES + golden.UNUSUAL_PAGES)), "page_id long, html string")
    flat = {r.page_id: r.html for r in pages.normalise_html(unusual).collect()}
    for r in pages.extract_papers(unusual).collect():
        html = flat[r.page_id]
        for column, (pattern, group) in PAPER_RULES.items():
            found = re.search(pattern, html)
            assert r[column] == (found.group(group) if found else ""), (r.page_id, column)
        for column, (block, item) in PAPER_LISTS.items():
            found = re.search(block, html)
            assert r[column] == (re.findall(item, found.group(1)) if found else []), (r.page_id, column)


def test_quality_counts_and_filter(spark, rows):
    docs = pages.extract_papers(_pages(spark))
    # an abstract of one dot is neither missing nor shortened
    assert rows(pages.extraction_quality(docs)) == [(2, 1)]
    assert rows(pages.drop_without_content(docs), "page_id") == [(0,), (2,), (3,)]


def test_flatten_strips_every_white_space(spark, rows):
    df = spark.createDataFrame(
        [("\t a\nb\tc \r\n\x0b",), ("\u2003\xa0x\ry\r\nz\u3000",), (" ",)], "html string")
    assert rows(df.select(flatten_html(F.col("html")))) == [("",), ("ab c",), ("xyz",)]


def test_list_codec_accepts_a_trailing_separator(spark, rows):
    df = spark.createDataFrame([("a;b;",), ("a;b",), ("",), (";;a",), (None,)], "t string")
    assert [r[0] for r in df.select(decode_list(F.col("t"))).collect()] == [
        ["a", "b"], ["a", "b"], [], ["a"], None]
    keys = spark.createDataFrame([(["a", "b"],), ([],)], "k array<string>")
    assert rows(keys.select(encode_list(F.col("k"), trailing=True), encode_list(F.col("k")))) == [
        ("", ""), ("a;b;", "a;b")]


def test_doc_key(spark, rows):
    df = spark.createDataFrame([("https://x.org/document/12",), ("12",)], "url string")
    assert rows(df.select(doc_key(F.col("url")))) == [("12",), ("document_12",)]


def test_frontier_names_the_first_page_and_skips_visited(spark, rows):
    result_pages = spark.createDataFrame([
        (2, '<a href="/document/1">a</a><a href="/document/2">b</a><a href="/document/2">b</a>'),
        (1, '<a href="/document/2">b</a><a href="/document/3">c</a><a href="/book/4">d</a>'),
        (3, "no links"),
    ], "page_id long, html string")
    links = pages.extract_outlinks(result_pages, base="https://x.org")
    assert links.count() == 5
    visited = pages.visited_links(spark.createDataFrame(
        [("https://x.org/document/3",), ("https://x.org/document/3",)], "url string"))
    fresh = pages.frontier(links, visited)
    assert rows(fresh, "url", "page_id") == [
        ("https://x.org/document/1", 2), ("https://x.org/document/2", 1)]
    assert rows(pages.frontier_counts(fresh)) == [(1, 1), (2, 1)]


def test_page_files_and_lines(spark, rows, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    (folder / "a.txt").write_text("one\n\ttwo\n")
    (folder / "b.txt").write_text("three")
    files = read_page_files(spark, str(folder))
    assert rows(files, "file", "value") == [("a.txt", "one two"), ("b.txt", "three")]
    lines = str(tmp_path / "lines")
    write_page_lines(files, lines)
    write_page_lines(files, lines)
    stored = read_page_lines(spark, lines)
    assert rows(stored) == [("one two",), ("one two",), ("three",), ("three",)]
    assert rows(count_documents(stored)) == [(4,)]


def test_row_cap_follows_the_order(spark, rows):
    df = spark.range(10).withColumnRenamed("id", "doc_id").orderBy(F.desc("doc_id"))
    assert rows(row_cap(df, 3)) == [(0,), (1,), (2,)]
    assert row_cap(df, -1).count() == 10 and row_cap(df).count() == 10
    assert row_cap(df, 0).count() == 0
    assert rows(peek(df)) == [(0,)]


def test_page_files_lie_beside_each_other(spark, rows, tmp_path):
    """Rows that share an id are one page, also those without one; no page has a folder of its own."""
    found = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, " b\tc\n"), (None, "x\ny"), (None, "x\ny")],
                                  "page_id long, html string")
    path = tmp_path / "pages"
    write_page_files(found, str(path), "page_id", "html")
    # an empty file, which is no page, stands for a first task without rows
    assert len([f for f in path.glob("*.txt") if f.stat().st_size]) == 4 and not [f for f in path.iterdir() if f.is_dir()]
    assert rows(read_page_files(spark, str(path)), "value") == [("",), ("aa",), ("b c",), ("xyxy",)]
