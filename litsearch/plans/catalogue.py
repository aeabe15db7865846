"""Queries over the test tables, one or more per operator."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litsearch.functions.text import decode_list, doc_key, encode_list
from litsearch.operators import facets, index, pages, search, topics
from litsearch.plans import standins as S
from litsearch.plans.answers import (
    compare_clauses, compare_topics, documents_by_clause, ranked_hits,
)
from litsearch.schemas import ENRICHED_DOCUMENTS, text_schema
from litsearch.sources import documents as docs_io
from litsearch.sources import pages as pages_io
from litsearch.sources import wiki as wiki_io
from litsearch.sources.scratch import materialise, scratch_folder
from litsearch.streaming.incremental import (
    extract_incremental, refresh_frontier_stream, visited_table,
)

# --- clause rows of the search queries -------------------------------------------

KEY_QUERIES = [
    ("k1", 0, "ieee_keys", "key", "de", "must"),
    ("k2", 0, "ieee_keys", "key", "The", "must"),
    ("k3", 0, "ieee_keys", "key", "zzzz", "must"),
    ("k4", 0, "ieee_keys", "key", "and", "must"),
    ("k4", 1, "ieee_keys", "key", "the", "must"),
    ("k5", 0, "ieee_keys", "key", "and", "must"),
    ("k5", 1, "ieee_keys", "key", "attion", "must"),
    ("k5", 2, "ieee_keys", "key", "the", "must"),
    ("k6", 0, "ieee_keys", "key", "the", "must"),
    ("k6", 1, "author_keys", "key", "the", "must"),
    ("k7", 0, "ieee_keys", "key", "de", "must"),
    ("k7", 1, "merged_keys", "key", "zzzz", "must"),
]
TWO_KEYS = ("k4", "k6", "k7")
PAIR_TEXTS = [
    ("p1", "ieee_keys:the"),
    ("p2", "ieee_keys:And, author_keys: THE "),
    ("p3", "ieee_keys:and,ieee_keys:attion, ieee_keys:the"),
    ("p4", "the,ieee_keys:a:b, ieee_keys:de"),
]
TERM_QUERIES = [
    ("t1", 0, "text", "term", "worthless", "should"),
    ("t2", 0, None, "term", "Ertion", "should"),
    ("t3", 0, "text", "term", "the", "should"),
    ("t4", 0, "text", "term", "zzzz", "should"),
]
PAPER_TERMS = [
    ("d1", 0, None, "term", "src3", "should"),
    ("d2", 0, "title", "term", "the", "should"),
]
BOOLEAN_QUERIES = [
    ("b1", 0, "text", "term", "worthless", "must"),
    ("b1", 1, "text", "term", "ertion", "must"),
    ("b2", 0, "text", "term", "worthless", "should"),
    ("b2", 1, "text", "term", "ertion", "should"),
    ("b3", 0, "text", "term", "the", "must"),
    ("b3", 1, "text", "term", "ertion", "should"),
    ("b4", 0, "text", "term", "de", "must"),
    ("b4", 1, "text", "term", "la", "must_not"),
    ("b5", 0, "text", "phrase", "the and", "must"),
    ("b5", 1, "text", "term", "ertion", "must"),
]
PHRASE_QUERIES = [
    ("f1", 0, "text", "phrase", "the and", "must"),
    ("f2", 0, "text", "phrase", "of the and", "must"),
    ("f3", 0, "text", "phrase", "the the", "must"),
    ("f4", 0, "text", "phrase", "the zzzz", "must"),
    ("f5", 0, "text", "phrase", "worthless", "must"),
]
RANKED_QUERIES = [
    ("r1", 0, "text", "term", "worthless", "should"),
    ("r1", 1, "text", "term", "ertion", "should"),
    ("r1", 2, "text", "term", "the", "should"),
    ("r2", 0, "text", "any_word", "de la", "should"),
]
COMPARED_TOPICS = [
    ("c1", 0, "ieee_keys", "any_word", "de", "should"),
    ("c1", 1, "ieee_keys", "any_word", "The", "should"),
    ("c1", 2, "author_keys", "any_word", "in", "should"),
    ("c2", 0, "combined_topics", "any_word", "src3", "should"),
    ("c2", 1, "combined_topics", "any_word", "not found", "should"),
    ("c2", 2, "combined_topics", "any_word", "and", "should"),
    ("c3", 0, "ieee_keys", "any_word", "der dans", "should"),
    ("c3", 1, "ieee_keys", "any_word", "was", "should"),
]
COMPARED_CLAUSES = [
    ("o1", 0, "title", "term", "the", "should"),
    ("o1", 1, "combined_topics", "term", "src3", "should"),
    ("o1", 2, "ieee_keys", "term", "de", "should"),
]
PATTERN_QUERIES = [
    ("e1", 0, "text", "prefix", "worth", "should"),
    ("e2", 0, "text", "wildcard", "w*less", "should"),
    ("e3", 0, "text", "wildcard", "?rtion", "should"),
    ("e4", 0, "text", "fuzzy", "worthles", "should"),
    ("e5", 0, "text", "range", "worta to wortz", "should"),
]


def _joined(column: str):
    return encode_list(F.col(column))


def _counted(column) -> F.Column:
    return F.coalesce(column, F.lit(0)).cast("bigint")


# --- pages ---------------------------------------------------------------------

def q01_page_flatten(spark: SparkSession, sf: str) -> DataFrame:
    return S.flat_pages(spark, sf).select("page_id", F.col("html").alias("value"))


def q02_row_cap(spark: SparkSession, sf: str) -> DataFrame:
    found = S.table(spark, sf, "pages").select("page_id", "url")
    parts = [
        pages_io.row_cap(found, 20, "page_id").withColumn("cap", F.lit("first 20")),
        pages_io.row_cap(found, -1, "page_id").withColumn("cap", F.lit("all")),
        pages_io.peek(found, order_by="page_id").withColumn("cap", F.lit("peek")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q03_count(spark: SparkSession, sf: str) -> DataFrame:
    return pages_io.count_documents(S.table(spark, sf, "pages"))


def q04_extract_fields(spark: SparkSession, sf: str) -> DataFrame:
    return pages.extract_fields(S.flat_pages(spark, sf), S.PAGE_RULES).select(
        "page_id", *S.PAGE_RULES)


def q04_paper_fields(spark: SparkSession, sf: str) -> DataFrame:
    found = pages.extract_papers(S.paper_pages(spark, sf))
    return found.drop("ieee_keys", "author_keys")


def q05_extract_lists(spark: SparkSession, sf: str) -> DataFrame:
    found = pages.extract_list(S.flat_pages(spark, sf), "keys", S.NAV_BLOCK, S.NAV_ITEM)
    return found.select("page_id", _joined("keys").alias("keys"),
                        F.size("keys").cast("bigint").alias("n_keys"))


def q05_paper_lists(spark: SparkSession, sf: str) -> DataFrame:
    found = pages.extract_papers(S.paper_pages(spark, sf))
    return found.select("page_id", _joined("ieee_keys").alias("ieee_keys"),
                        _joined("author_keys").alias("author_keys"))


def q06_list_codec(spark: SparkSession, sf: str) -> DataFrame:
    found = S.papers(spark, sf).select(
        "doc_id", encode_list(F.col("ieee_keys"), trailing=True).alias("encoded"))
    decoded = found.withColumn("decoded", decode_list(F.col("encoded")))
    return decoded.select("doc_id", "encoded", F.size("decoded").cast("bigint").alias("n_keys"),
                          F.array_join("decoded", "|").alias("decoded"))


def q07_quality(spark: SparkSession, sf: str) -> DataFrame:
    return pages.extraction_quality(S.abstracts(spark, sf))


def q07_with_content(spark: SparkSession, sf: str) -> DataFrame:
    return pages.drop_without_content(S.abstracts(spark, sf)).select(
        "doc_id", F.length("content").cast("bigint").alias("n_chars"))


def q08_doc_key(spark: SparkSession, sf: str) -> DataFrame:
    return S.table(spark, sf, "pages").select("page_id", doc_key(F.col("url")).alias("doc_key"))


def _outlinks(spark: SparkSession, sf: str) -> DataFrame:
    return pages.extract_outlinks(S.flat_pages(spark, sf), S.LINK_PATTERN, S.LINK_BASE)


def _known_links(spark: SparkSession, sf: str) -> DataFrame:
    """Links on German pages stand for those visited before."""
    german = pages.extract_fields(S.flat_pages(spark, sf), S.PAGE_RULES).filter("lang = 'de'")
    return pages.visited_links(pages.extract_outlinks(german, S.LINK_PATTERN, S.LINK_BASE))


def q09_outlinks(spark: SparkSession, sf: str) -> DataFrame:
    return _outlinks(spark, sf)


def q10_visited(spark: SparkSession, sf: str) -> DataFrame:
    return pages.visited_links(_outlinks(spark, sf))


def q11_frontier(spark: SparkSession, sf: str) -> DataFrame:
    return pages.frontier(_outlinks(spark, sf), _known_links(spark, sf))


def q11_frontier_counts(spark: SparkSession, sf: str) -> DataFrame:
    return pages.frontier_counts(q11_frontier(spark, sf))


# --- topics ----------------------------------------------------------------------

def q12_merge_keys(spark: SparkSession, sf: str) -> DataFrame:
    return S.papers(spark, sf).select("doc_id", _joined("merged_keys").alias("merged_keys"))


def q13_distinct_keys(spark: SparkSession, sf: str) -> DataFrame:
    return topics.distinct_keys(S.papers(spark, sf), "merged_keys")


def _matched(spark: SparkSession, sf: str, small: bool | None = None) -> DataFrame:
    keys = materialise(topics.distinct_keys(S.stored_papers(spark, sf), "ieee_keys"), "keys")
    return topics.match_wiki_pages(S.wiki(spark, sf), keys, small)


def q14_match(spark: SparkSession, sf: str) -> DataFrame:
    return _matched(spark, sf).select(
        "id", "key", F.col("title_match").cast("int").alias("title_match"), "n_chars")


def q14_match_many_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The way taken when keys are too many to broadcast."""
    return _matched(spark, sf, small=False).select(
        "id", "key", F.col("title_match").cast("int").alias("title_match"), "n_chars",
        F.array_join("topics", ";").alias("topics"))


def q15_categories(spark: SparkSession, sf: str) -> DataFrame:
    return S.wiki(spark, sf).select("id", F.array_join(
        topics.extract_categories(F.col("revision.text")), ";").alias("categories"))


def q16_topic_rule(spark: SparkSession, sf: str) -> DataFrame:
    return _matched(spark, sf).select(
        "id", "key", F.array_join("topics", ";").alias("topics"))


def q17_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return topics.topic_dictionary(_matched(spark, sf)).select(
        "key", F.size("topics").cast("bigint").alias("n_topics"),
        F.array_join("topics", ";").alias("topics"))


def q18_attach(spark: SparkSession, sf: str) -> DataFrame:
    dictionary = S.enriched_papers(spark, sf).dictionary
    keys = topics.explode_keys(S.stored_papers(spark, sf), "ieee_keys")
    return topics.attach_topics(keys, dictionary).select("doc_id", "key", "topic")


def q19_combine(spark: SparkSession, sf: str) -> DataFrame:
    return S.enriched_papers(spark, sf).docs.select(
        "doc_id", "link", _joined("combined_topics").alias("combined_topics"))


def q19_distinct_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Papers told apart by site and number in the link."""
    docs = S.stored_papers(spark, sf).withColumn("place", F.concat_ws("/", "publisher", "year"))
    return topics.distinct_documents(docs, "place").select("doc_id", "place", "link")


def q20_ordered(spark: SparkSession, sf: str) -> DataFrame:
    dictionary = S.enriched_papers(spark, sf).dictionary
    found = topics.attach_topics_ordered(S.stored_papers(spark, sf), dictionary, "ieee_keys")
    return found.select("doc_id", _joined("topics").alias("topics"))


def q21_export(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_folder(spark, "key_topics")
    exported = topics.export_dictionary(S.enriched_papers(spark, sf).dictionary)
    docs_io.write_docs_tsv(exported, path)
    return docs_io.read_docs_tsv(spark, path, text_schema(["key", "topics"]), multi_line=False)


# --- index -----------------------------------------------------------------------

def q22_presets(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes of what each preset searches; ``remark`` is a column no preset names."""
    docs = S.enriched_papers(spark, sf).docs.withColumn(
        "remark", F.concat_ws(" ", "publisher", "year"))
    parts = []
    for name, preset in index.PRESETS.items():
        searched = index.build_token_postings(docs, preset).groupBy("field").agg(
            F.count(F.lit(1)).alias("n_postings"), F.sum("tf").alias("n_words"))
        stored = index.doc_store(docs, preset)
        kept = stored.agg(F.count("remark").alias("n_postings"),
                          F.sum(F.length("remark")).alias("n_words"))
        parts += [searched.withColumn("preset", F.lit(name)),
                  kept.select(F.lit("stored remark").alias("field"), "n_postings", "n_words",
                              F.lit(name).alias("preset"))]
    return reduce(DataFrame.unionByName, parts)


def _text_postings(spark: SparkSession, sf: str) -> DataFrame:
    docs = S.spread_scan(S.table(spark, sf, "documents").select("doc_id", "text"))
    return index.build_token_postings(docs, index.IndexConfig(text_fields=("text",)))


def q23_token_postings(spark: SparkSession, sf: str) -> DataFrame:
    return _text_postings(spark, sf).select(
        "field", "term", "doc_id", "tf", F.array_join("positions", ";").alias("positions"))


def q24_key_postings(spark: SparkSession, sf: str) -> DataFrame:
    return index.build_key_postings(S.papers(spark, sf))


def q25_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    words = index.term_dictionary(_text_postings(spark, sf))
    keys = index.term_dictionary(index.build_key_postings(S.papers(spark, sf)))
    return index.sorted_dictionary(words.unionByName(keys))


def q26_field_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = index.field_stats(_text_postings(spark, sf))
    paper_words = index.build_token_postings(S.papers(spark, sf), index.KEYS)
    return stats.unionByName(index.field_stats(paper_words)).select(
        "field", "n_docs", F.round("avg_len", 6).alias("avg_len"))


def q26_doc_lengths(spark: SparkSession, sf: str) -> DataFrame:
    return index.doc_lengths(_text_postings(spark, sf))


# --- exact keys --------------------------------------------------------------------

def _keys(spark: SparkSession, sf: str) -> DataFrame:
    return index.build_key_postings(S.stored_papers(spark, sf))


def q27_key(spark: SparkSession, sf: str) -> DataFrame:
    return search.key_lookup(_keys(spark, sf), S.clause_table(spark, KEY_QUERIES))


def q28_status(spark: SparkSession, sf: str) -> DataFrame:
    dictionary = index.term_dictionary(_keys(spark, sf))
    return search.key_status(dictionary, S.clause_table(spark, KEY_QUERIES))


def q29_and2(spark: SparkSession, sf: str) -> DataFrame:
    clauses = S.clause_table(spark, [c for c in KEY_QUERIES if c[0] in TWO_KEYS])
    return search.key_and(search.key_lookup(_keys(spark, sf), clauses), clauses)


def q30_andn(spark: SparkSession, sf: str) -> DataFrame:
    keys, clauses = _keys(spark, sf), S.clause_table(spark, KEY_QUERIES)
    return search.key_search(keys, index.term_dictionary(keys), clauses)


def q31_selectivity(spark: SparkSession, sf: str) -> DataFrame:
    dictionary = index.term_dictionary(_keys(spark, sf))
    return search.clause_selectivity(dictionary, S.clause_table(spark, KEY_QUERIES))


def q32_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pair texts answered: what each pair names, and the documents holding all of them."""
    texts = spark.createDataFrame(PAIR_TEXTS, "query_id string, query_text string")
    pairs = search.split_pairs(texts)
    clauses = search.pair_clauses(pairs, "key", "must")
    hits = search.key_lookup(_keys(spark, sf), clauses)
    found = hits.groupBy("query_id", "clause_id").agg(F.count(F.lit(1)).alias("n_docs"))
    return pairs.join(found, ["query_id", "clause_id"], "left").withColumn(
        "n_docs", _counted(F.col("n_docs")))


# --- words -------------------------------------------------------------------------

def _rounded(hits: DataFrame) -> DataFrame:
    return hits.withColumn("score", F.round("score", 6))


def q33_term(spark: SparkSession, sf: str) -> DataFrame:
    found = S.document_index(spark, sf)
    clauses = S.clause_table(spark, TERM_QUERIES)
    rows = search.weigh_words(found, search.clause_words(clauses, "text"))
    hits = search.term_search(found, rows)
    in_papers = S.paper_index(spark, sf)
    default = search.weigh_words(
        in_papers, search.clause_words(S.clause_table(spark, PAPER_TERMS)))
    return _rounded(hits.unionByName(search.term_search(in_papers, default)))


def q34_boolean(spark: SparkSession, sf: str) -> DataFrame:
    clauses = S.clause_table(spark, BOOLEAN_QUERIES)
    hits = search.all_clause_hits(S.document_index(spark, sf), clauses)
    return _rounded(search.boolean_search(hits, clauses))


def q35_phrase(spark: SparkSession, sf: str) -> DataFrame:
    found = S.document_index(spark, sf)
    rows = search.weigh_words(found, search.clause_words(S.clause_table(spark, PHRASE_QUERIES)))
    return _rounded(search.phrase_search(found, rows))


def q36_bm25(spark: SparkSession, sf: str) -> DataFrame:
    found = S.document_index(spark, sf)
    ranked = ranked_hits(found, S.clause_table(spark, RANKED_QUERIES), 50)
    return _rounded(facets.results_by_score(ranked, found.docs, ("lang", "source")))


def q36_all(spark: SparkSession, sf: str) -> DataFrame:
    """Every match ranked and shown in score order."""
    found = S.document_index(spark, sf)
    ranked = ranked_hits(found, S.clause_table(spark, RANKED_QUERIES))
    return _rounded(facets.results_by_score(ranked, found.docs, ("lang", "source")))


def q36_papers(spark: SparkSession, sf: str) -> DataFrame:
    found = S.paper_index(spark, sf)
    ranked = ranked_hits(found, S.clause_table(spark, COMPARED_CLAUSES))
    shown = facets.results_by_score(ranked, found.docs)
    return _rounded(shown.withColumns({
        "merged_keys": _joined("merged_keys"), "combined_topics": _joined("combined_topics")}))


def q37_any_word(spark: SparkSession, sf: str) -> DataFrame:
    ranked = search.search(S.paper_index(spark, sf), S.clause_table(spark, COMPARED_TOPICS))
    return _rounded(ranked)


def q38_expand(spark: SparkSession, sf: str) -> DataFrame:
    found = S.document_index(spark, sf)
    return search.term_expand(found.dictionary, S.clause_table(spark, PATTERN_QUERIES), lookups=found.lookups)


def q38_expanded_hits(spark: SparkSession, sf: str) -> DataFrame:
    clauses = S.clause_table(spark, PATTERN_QUERIES)
    return search.search(S.document_index(spark, sf), clauses).drop("rank")


# --- counts --------------------------------------------------------------------------

def q39_topic_counts(spark: SparkSession, sf: str) -> DataFrame:
    clauses = S.clause_table(spark, COMPARED_TOPICS)
    counts = compare_topics(S.paper_index(spark, sf), clauses).counts
    return counts.withColumn("place", F.col("place").cast("bigint"))


def q40_occurrences(spark: SparkSession, sf: str) -> DataFrame:
    clauses = S.clause_table(spark, COMPARED_TOPICS)
    counts = compare_topics(S.paper_index(spark, sf), clauses, distinct=False,
                            fields=("ieee_keys",)).counts
    return counts.withColumn("place", F.col("place").cast("bigint"))


def q41_clause_counts(spark: SparkSession, sf: str) -> DataFrame:
    clauses = S.clause_table(spark, COMPARED_CLAUSES)
    return compare_clauses(S.paper_index(spark, sf), clauses)[1]


def q41_by_clause(spark: SparkSession, sf: str) -> DataFrame:
    return documents_by_clause(S.paper_index(spark, sf), S.clause_table(spark, COMPARED_CLAUSES))


def q42_by_topic(spark: SparkSession, sf: str) -> DataFrame:
    found = S.paper_index(spark, sf)
    clauses = S.clause_table(spark, COMPARED_TOPICS)
    rows = compare_topics(found, clauses).by_topic
    return facets.show_documents(rows, found.docs, ("title", "link")).withColumn(
        "place", F.col("place").cast("bigint"))


def q42_by_topic_repeated(spark: SparkSession, sf: str) -> DataFrame:
    clauses = S.clause_table(spark, COMPARED_TOPICS)
    rows = compare_topics(S.paper_index(spark, sf), clauses, repeat=True).by_topic
    return rows.withColumn("place", F.col("place").cast("bigint"))


# --- files ---------------------------------------------------------------------------

def q43_tsv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_folder(spark, "documents")
    columns = ENRICHED_DOCUMENTS.names
    docs_io.write_docs_tsv(S.enriched_papers(spark, sf).docs.select(*columns), path)
    return docs_io.read_docs_tsv(spark, path, ENRICHED_DOCUMENTS).na.fill("")


def q44_xml_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_folder(spark, "dump")
    wiki_io.write_wiki_dump(S.wiki(spark, sf), path)
    return wiki_io.read_wiki_dump(spark, path).select(
        "id", "title", F.coalesce("redirect.title", F.lit("")).alias("redirect_title"),
        F.trim("revision.text").alias("text"))


def q45_index_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return S.plain_paper_index(spark, sf).dictionary.select("field", "term", "df", "cf")


def q45_postings(spark: SparkSession, sf: str) -> DataFrame:
    return S.plain_paper_index(spark, sf).postings.select(
        "field", "term", "doc_id", "tf", "doc_len", F.array_join("positions", ";").alias("positions"))


def q45_keys(spark: SparkSession, sf: str) -> DataFrame:
    return S.plain_paper_index(spark, sf).key_postings.select("field", "term", "doc_id", "tf")


def q45_stats(spark: SparkSession, sf: str) -> DataFrame:
    return S.plain_paper_index(spark, sf).stats.withColumn("avg_len", F.round("avg_len", 6))


def q45_docs(spark: SparkSession, sf: str) -> DataFrame:
    return S.plain_paper_index(spark, sf).docs.select(
        "doc_id", "title", "link", "publisher", _joined("merged_keys").alias("merged_keys"))


def q46_page_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Pages written and read one to a line."""
    path = scratch_folder(spark, "page_lines")
    pages_io.write_page_lines(S.table(spark, sf, "pages"), path, "html")
    return pages_io.read_page_lines(spark, path)


def q46_page_files(spark: SparkSession, sf: str) -> DataFrame:
    """Pages written and read one to a file."""
    path = scratch_folder(spark, "page_files")
    pages_io.write_page_files(S.table(spark, sf, "pages"), path, "page_id", "html")
    return pages_io.read_page_files(spark, path).select("value")


# --- streams ---------------------------------------------------------------------------

def s01_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Pages arrive in two parts; the second run reads only the second part."""
    folder = scratch_folder(spark, "stream")
    source, out, checkpoint = (f"{folder}/{name}" for name in ("source", "out", "checkpoint"))
    stored = S.paper_pages(spark, sf)
    for part in (F.col("page_id") % 2 == 0, F.col("page_id") % 2 == 1):
        pages_io.write_page_lines(stored.filter(part), source, "html")
        extract_incremental(spark, source, out, checkpoint)
    found = spark.read.parquet(out)
    return found.withColumns({c: _joined(c) for c in ("ieee_keys", "author_keys")})


def s02_frontier_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Links of pages arriving in two parts, each link once."""
    folder = scratch_folder(spark, "stream")
    source, visited, checkpoint = (f"{folder}/{n}" for n in ("source", "visited", "checkpoint"))
    stored = S.table(spark, sf, "pages")
    for part in (F.col("page_id") % 2 == 0, F.col("page_id") % 2 == 1):
        stored.filter(part).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(stored.schema).parquet(source)
        refresh_frontier_stream(arriving, visited, checkpoint, S.LINK_PATTERN, S.LINK_BASE)
    return visited_table(spark, visited).select("url", "page_id")


def s03_seeded_frontier(spark: SparkSession, sf: str) -> DataFrame:
    """As before, with links known before the stream began."""
    folder = scratch_folder(spark, "stream")
    source, visited, checkpoint = (f"{folder}/{n}" for n in ("source", "visited", "checkpoint"))
    stored = S.table(spark, sf, "pages")
    seed = materialise(_known_links(spark, sf), "known_links")
    stored.write.parquet(source)
    arriving = spark.readStream.schema(stored.schema).parquet(source)
    refresh_frontier_stream(arriving, visited, checkpoint, S.LINK_PATTERN, S.LINK_BASE, seed=seed)
    return visited_table(spark, visited).select("url", "page_id")


QUERIES = {name: f for name, f in globals().items()
           if name[:1] in "qs" and name[1:3].isdigit() and callable(f)}
