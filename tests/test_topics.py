import golden
import pytest
from pyspark.sql import functions as F

from litsearch.fixed_values import KEY_IS_TOPIC_PHRASES, NEXT_WORD_IS_TOPIC_PHRASES
from litsearch.operators import topics
from litsearch.plans.enrich import enrich_corpus
from litsearch.operators.pages import extract_papers
from litsearch.sources.documents import (
    read_docs_tsv, require_unique, with_doc_id, with_lists, write_docs_tsv,
)
from litsearch.sources.wiki import read_wiki_dump
from litsearch.schemas import WIKI_PAGES, text_schema


@pytest.fixture(scope="module")
def wiki(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("dump")
    (folder / "part1.xml").write_text(golden.WIKI_DUMP)
    return read_wiki_dump(spark, str(folder))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([
        (1, "a", ["Voltage", "Graphs"]),
        (2, "b", ["C++", "nothing", "c++"]),
        (3, "c", []),
        (4, "d", None),
        (5, "e", ["Python", "VOLTAGE", ""]),
    ], "doc_id long, link string, author_keys array<string>")


def _dump(pages: int) -> str:
    """A dump with header and footer, pages of very different length, redirects, entities, other tags."""
    out = ['<mediawiki xmlns="http://x/export-0.10/" xml:lang="en">\n  <siteinfo><sitename>W</sitename>'
           '<pagecount>3</pagecount></siteinfo>\n']
    for i in range(pages):
        redirect = f'    <redirect title="Title &amp; {i}" />\n' if i % 4 == 0 else ""
        text = f"line {i}\n&lt;page&gt; a &lt;/page&gt; [[Category:C{i % 7}]] &quot;\u00e9\u4e2d&quot; " * (1 + i * 37 % 90)
        tag = "<page>" if i % 3 else '<page lang="x">'
        out.append(f"  {tag}\n    <title>T{i}</title>\n    <ns>0</ns>\n    <id>{i}</id>\n{redirect}"
                   f'    <revision>\n      <id>9{i}</id>\n      <text bytes="1" xml:space="preserve">{text}</text>\n'
                   "    </revision>\n  </page>\n")
    return "".join(out) + "</mediawiki>\n"


def _by_row_tag(spark, path):
    return (spark.read.format("xml").options(rowTag="page", attributePrefix="").schema(WIKI_PAGES).load(path))


def test_one_dump_is_read_by_many_tasks(spark, tmp_path, rows):
    """Also pages across splits, header and footer, redirects: the same rows as the XML reader has."""
    path = str(tmp_path / "dump.xml")
    (tmp_path / "dump.xml").write_text(_dump(300))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("4096", "20000", old):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            found = read_wiki_dump(spark, path)
            if size != old:
                assert found.rdd.getNumPartitions() > 20
            assert rows(found) == rows(_by_row_tag(spark, path))
            assert found.count() == 300 and found.schema == WIKI_PAGES
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("text", ["", "<mediawiki></mediawiki>", "<mediawiki><siteinfo>x</siteinfo></mediawiki>",
                                  "<page><id>1</id></page>", "<pages><page><id>1</id><title>a</title></page></pages>"])
def test_small_dumps(spark, tmp_path, rows, text):
    (tmp_path / "dump.xml").write_text(text)
    found = read_wiki_dump(spark, str(tmp_path))
    assert [r.id for r in found.collect()] == ([1] if "<page>" in text else [])


def test_compressed_dump(spark, tmp_path, rows):
    import bz2
    (tmp_path / "plain.xml").write_text(_dump(40))
    (tmp_path / "packed").mkdir()
    (tmp_path / "packed" / "dump.xml.bz2").write_bytes(bz2.compress(_dump(40).encode()))
    assert rows(read_wiki_dump(spark, str(tmp_path / "packed"))) == rows(
        read_wiki_dump(spark, str(tmp_path / "plain.xml")))


def test_dump_reads_redirects_and_empty_text(wiki):
    found = {r.id: r for r in wiki.collect()}
    assert len(found) == 7
    assert found[2].redirect.title == "Graphs" and found[1].redirect is None
    assert found[6].revision.text in (None, "")


@pytest.mark.parametrize("small", [True, False])
def test_title_counts_before_redirect(spark, wiki, docs, rows, small):
    keys = topics.distinct_keys(docs, "author_keys")
    assert rows(keys) == [("c++",), ("graphs",), ("nothing",), ("python",), ("voltage",)]
    matched = topics.match_wiki_pages(wiki, keys, small)
    assert rows(matched, "id", "key", "title_match") == [
        (1, "voltage", True), (2, "graphs", False), (3, "graphs", True), (4, "voltage", True),
        (5, "c++", True), (6, "python", True)]


def test_topic_rule_branches(spark):
    df = spark.createDataFrame(
        [(i, k, t) for i, (k, t, _) in enumerate(golden.TOPIC_TEXTS)], "id long, key string, text string")
    found = {r.id: r.topics for r in topics.page_topics(df).collect()}
    assert [found[i] for i in range(len(found))] == [t for _, _, t in golden.TOPIC_TEXTS]


@pytest.mark.parametrize("phrase", KEY_IS_TOPIC_PHRASES)
def test_every_phrase_that_makes_the_key_a_topic(spark, phrase):
    text = f"Say: Some Key {phrase} and more [[Category:A]] [[Category:B]]"
    df = spark.createDataFrame([(1, "some key", text), (2, "other", text)],
                               "id long, key string, text string")
    first, second = (r.topics for r in topics.page_topics(df).orderBy("id").collect())
    assert (first, second) == (["some key"], ["A", "B"])


@pytest.mark.parametrize("phrase", NEXT_WORD_IS_TOPIC_PHRASES)
def test_every_phrase_before_a_topic(spark, phrase):
    text = f"It {phrase} things [[Category:A]] [[Category:B]] [[Category:C]]"
    df = spark.createDataFrame([(1, "key", text)], "id long, key string, text string")
    assert topics.page_topics(df).first().topics == ["B", "A", "C"]


def test_documents_with_the_same_link_are_one(spark, docs, rows):
    twice = docs.unionByName(docs.withColumn("doc_id", docs.doc_id + 10))
    assert rows(topics.distinct_documents(twice), "doc_id", "link", "author_keys") == rows(docs)
    assert rows(topics.distinct_documents(twice, "link"), "doc_id", "link", "author_keys") == rows(docs)
    # an empty link says nothing about a document
    unlinked = twice.withColumn("link", F.when(F.col("link") == "a", "").otherwise(F.col("link")))
    assert topics.distinct_documents(unlinked, "link").count() == docs.count() + 1


def test_documents_without_a_link_stay_apart(spark):
    pages = spark.createDataFrame(list(enumerate(golden.PAPER_PAGES)), "page_id long, html string")
    docs = with_doc_id(extract_papers(pages).drop("page_id"))
    assert topics.distinct_documents(docs.unionByName(docs)).count() == 5
    require_unique(docs)
    with pytest.raises(ValueError):
        require_unique(docs.unionByName(docs))


def test_empty_keys_give_no_topic(spark, rows):
    docs = spark.createDataFrame([(1, ["a", ""]), (2, [""])], "doc_id long, k array<string>")
    assert rows(topics.explode_keys(docs, "k")) == [(1, "a"), (2, None)]


def test_next_word_phrase_may_be_followed_by_any_blank(spark):
    df = spark.createDataFrame(
        [(1, "x", "is a branch of\nart [[Category:A]] [[Category:B]]")], "id long, key string, text string")
    assert topics.page_topics(df).first().topics == ["B", "A"]


def test_dictionary_is_deterministic(spark, wiki, docs, rows):
    matched = topics.match_wiki_pages(wiki, topics.distinct_keys(docs, "author_keys"))
    found = topics.topic_dictionary(matched)
    assert rows(found, "key", "topics") == [
        ("c++", ["Computing", "Languages", "Code"]),
        ("graphs", ["Not found"]),         # the title match wins over the redirect
        ("python", ["Not found"]),
        ("voltage", ["voltage"]),          # the lowest page id wins
    ]
    assert ("c++", "Computing;Languages;Code") in rows(topics.export_dictionary(found))


def test_enrich_keeps_every_document(spark, wiki, docs, rows):
    found = enrich_corpus(docs, wiki)
    assert rows(found.docs, "doc_id", "link", "combined_topics") == [
        (1, "a", ["Not found", "voltage"]),
        (2, "b", ["Computing", "Not found"]),
        (3, "c", []),
        (4, "d", []),
        (5, "e", ["Not found", "voltage"]),
    ]


@pytest.mark.parametrize("small", [True, False])
def test_ordered_topics(spark, wiki, docs, rows, small):
    dictionary = enrich_corpus(docs, wiki).dictionary
    found = topics.attach_topics_ordered(docs, dictionary, "author_keys", small)
    assert rows(found, "doc_id", "topics") == [
        (1, ["voltage", "Not found"]),
        (2, ["Computing", "Computing"]),
        (3, []),
        (4, ["None"]),
        (5, ["Not found", "voltage"]),
    ]


@pytest.mark.parametrize("small", [True, False])
def test_attach_keeps_documents_without_keys(spark, docs, rows, small):
    dictionary = spark.createDataFrame(
        [("voltage", ["Physics"]), ("python", [])], "key string, topics array<string>")
    found = topics.attach_topics(topics.explode_keys(docs, "author_keys"), dictionary, small)
    assert (4, None, None) in rows(found) and (3, None, None) in rows(found)
    assert (5, "Python", "Not found") in rows(found)
    assert (5, "VOLTAGE", "Physics") in rows(found)


def test_merge_keys(spark):
    df = spark.createDataFrame(
        [(["a", "b"], ["b", "c"]), (None, ["c", "c"]), ([], None)],
        "ieee_keys array<string>, author_keys array<string>")
    assert [r.merged_keys for r in topics.merge_keys(df).collect()] == [["a", "b", "c"], ["c"], []]


def test_tsv_keeps_quotes_tabs_newlines_and_blanks(spark, tmp_path):
    columns = ["link", "title", "ieee_keys", "author_keys"]
    source = tmp_path / "in.tsv"
    source.write_text(
        "link\ttitle\tieee_keys\tauthor_keys\n"
        'l1\t"a ""quoted"" title"\ta;b;\t\n'
        'l2\t"tab\there"\t\tx\n'
        'l3\t"two\nlines"\tc\ty;\n'
        "l4\t ends \td\tz\n")
    docs = with_lists(read_docs_tsv(spark, str(source), text_schema(columns), multi_line=True),
                      ["ieee_keys", "author_keys"])
    want = [
        ("l1", 'a "quoted" title', ["a", "b"], None),
        ("l2", "tab\there", None, ["x"]),
        ("l3", "two\nlines", ["c"], ["y"]),
        ("l4", " ends ", ["d"], ["z"]),
    ]
    assert sorted(map(tuple, docs.collect()), key=repr) == want
    again = str(tmp_path / "again")
    write_docs_tsv(docs, again)
    write_docs_tsv(docs, again)
    back = with_lists(read_docs_tsv(spark, again, text_schema(columns), multi_line=True), ["ieee_keys", "author_keys"])
    # an empty list and a missing one look the same in a file
    filled = back.withColumns({c: F.coalesce(c, F.array().cast("array<string>"))
                               for c in ("ieee_keys", "author_keys")})
    assert sorted((r.link, r.title, r.ieee_keys, r.author_keys) for r in filled.collect()) == [
        (a, b, c or [], d or []) for a, b, c, d in want]
