import golden
import pytest
from pyspark.sql import functions as F

from litsearch.operators.pages import extract_papers, frontier
from litsearch.sources.history import HISTORY_BUCKETS, link_bucket
from litsearch.streaming.incremental import (
    add_new_links, compact_visited, extract_incremental, refresh_frontier_stream, visited_table,
)


def _write(folder, name, *pages):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(p.replace("\n", "") + "\n" for p in pages))


def test_only_new_pages_are_extracted(spark, tmp_path, rows):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    _write(source, "1.txt", golden.PAPER_PAGES[0], golden.PAPER_PAGES[2])
    _write(source, "2.txt", golden.PAPER_PAGES[1])
    counts = []
    for step in range(3):
        if step == 1:
            _write(source, "3.txt", golden.PAPER_PAGES[3])
        extract_incremental(spark, str(source), out, checkpoint, files_per_batch=1)
        counts.append(spark.read.parquet(out).count())
    # the first line is taken too, and a run without new files adds nothing
    assert counts == [3, 4, 4]
    batch = extract_papers(spark.read.text(str(source)).withColumnRenamed("value", "html"))
    assert rows(spark.read.parquet(out), *batch.columns) == rows(batch)


def test_whole_files(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.html").write_text(golden.PAPER_PAGES[1])
    extract_incremental(spark, str(source), out, str(tmp_path / "state"), whole_files=True)
    assert [r.title for r in spark.read.parquet(out).collect()] == ["Second title"]


def test_links_are_emitted_once(spark, tmp_path, rows):
    source, visited, state = (str(tmp_path / n) for n in ("in", "visited", "state"))
    schema = "page_id long, html string"

    def arrive(*pages):
        spark.createDataFrame(list(pages), schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        refresh_frontier_stream(stream, visited, state, base="")

    arrive((1, '<a href="/document/1"> <a href="/document/2">'))
    arrive((2, '<a href="/document/2"> <a href="/document/3"> <a href="/document/3">'))
    want = [("/document/1", 1), ("/document/2", 1), ("/document/3", 2)]
    assert rows(visited_table(spark, visited), "url", "page_id") == want
    # a batch that runs again replaces its own result
    again = spark.createDataFrame([(2, '<a href="/document/2"> <a href="/document/3">')], schema)
    add_new_links(again, 1, visited, base="")
    assert rows(visited_table(spark, visited), "url", "page_id") == want
    # what was emitted seeds the next stream, which emits none of it again
    seed = compact_visited(spark, visited, str(tmp_path / "compact"))
    assert rows(seed, "url", "page_id") == want
    stream = spark.readStream.schema(schema).parquet(source)
    following = str(tmp_path / "following")
    spark.createDataFrame([(3, '<a href="/document/3"> <a href="/document/4">')], schema).write.mode(
        "append").parquet(source)
    refresh_frontier_stream(stream, following, str(tmp_path / "state2"), base="", seed=seed)
    assert rows(visited_table(spark, following), "url", "page_id") == [("/document/4", 3)]


def test_a_batch_opens_its_part_of_the_history(spark, tmp_path, rows, capsys):
    visited = str(tmp_path / "visited")
    links = "".join(f'<a href="/document/{i}"> ' for i in range(2000))
    add_new_links(spark.createDataFrame([(1, links)], "page_id long, html string"), 0, visited, base="")
    history = visited_table(spark, visited)
    assert history.filter(F.col("bucket") != link_bucket("url")).isEmpty()
    assert history.select("bucket").distinct().count() == HISTORY_BUCKETS
    few = spark.createDataFrame([(2, "/document/7"), (2, "/document/x")], "page_id long, url string")
    compact = compact_visited(spark, visited, str(tmp_path / "compact"))
    for stored in (history, compact):
        fresh = frontier(few, stored)
        assert rows(fresh, "url", "page_id") == [("/document/x", 2)]
        capsys.readouterr()
        fresh.explain("formatted")
        plan = capsys.readouterr().out
        scan = [x for x in plan.splitlines() if "PartitionFilters" in x and "bucket" in x]
        assert scan and any("In(url" in x for x in plan.splitlines() if "PushedFilters" in x)
    # many links, and links stored without folders, give the same
    for stored in (history, history.select("url"), compact.select("url", "page_id")):
        for small in (True, False):
            assert rows(frontier(few, stored, small=small), "url", "page_id") == [("/document/x", 2)]
    # a batch without new links leaves the history readable
    add_new_links(spark.createDataFrame([(3, '<a href="/document/1">')], "page_id long, html string"), 1, visited, base="")
    assert visited_table(spark, visited).count() == 2000
    empty = str(tmp_path / "empty")
    for batch in (0, 1):
        add_new_links(spark.createDataFrame([(3, "none")], "page_id long, html string"), batch, empty, base="")
    assert rows(visited_table(spark, empty)) == []
