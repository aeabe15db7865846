"""Counts among the hits, and the frames a user looks at."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from litsearch.fixed_values import DEFAULT_FIELD
from litsearch.functions.text import normalise_topic
from litsearch.operators.joins import asked_rows, few_values, fits_broadcast, lookup_join
from litsearch.operators.search import placed_terms
from litsearch.sources.index_store import Index

SHOWN = ("title", "link", "merged_keys", "combined_topics", "author")
SHOWN_BY_KEYS = ("title", "link", "ieee_keys", "author")


def topic_documents(index: Index, hits: DataFrame, clauses: DataFrame,
                    fields: tuple[str, ...] | None = None) -> DataFrame:
    """Ranked hits that hold an asked topic as a whole key: ``query_id, topic, doc_id, occurrences, rank``.

    A topic counts in every column the query names, or in ``fields`` when given.
    Keys of list columns are looked up in the index, so only the folders of asked
    topics are read; of a text column the whole value is the key, and only the
    columns named are read.
    """
    asked = clauses.select("query_id", normalise_topic(F.trim("value")).alias("topic")).distinct()
    if fields is None:
        named = clauses.select("query_id", F.coalesce("field", F.lit(DEFAULT_FIELD)).alias("field"))
        wanted = asked.join(named.distinct(), "query_id")
    else:
        wanted = asked.withColumn("field", F.explode(F.array(*map(F.lit, fields))))
    known = {f.name: f.dataType.typeName() for f in index.docs.schema.fields}
    # at most one row per column of the index
    columns = {r.field for r in wanted.filter(F.col("field").isin(list(known)))
               .select("field").distinct().collect()}
    texts = sorted(c for c in columns if known[c] == "string")
    # one blank at the end of a key does not count
    keys = wanted.select("query_id", "topic", "field", F.explode(
        F.array("topic", F.concat("topic", F.lit(" ")))).alias("term"))
    terms, on = placed_terms(keys, index.buckets)
    found = lookup_join(index.key_postings, terms, on).select("query_id", "topic", "doc_id", "tf")
    if texts:
        # only the hits' columns are cut into values
        texts_of = index.docs.select("doc_id", *texts)
        found_ids = hits.select("doc_id").distinct()
        if fits_broadcast(found_ids):
            texts_of = asked_rows(texts_of, "doc_id", few_values(found_ids, "doc_id"))
            found_ids = F.broadcast(found_ids)
        values = (texts_of.join(found_ids, "doc_id", "left_semi").select("doc_id", F.explode(F.array(*[
                      F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in texts
                  ])).alias("e"))
                  .select("doc_id", "e.field", normalise_topic(F.col("e.value")).alias("topic")))
        whole = lookup_join(values, wanted, ["field", "topic"])
        found = found.unionByName(whole.select(
            "query_id", "topic", "doc_id", F.lit(1).cast("bigint").alias("tf")))
    # the join and the grouping share one shuffle by (query_id, doc_id)
    return (found.join(hits.select("query_id", "doc_id", "rank"), ["query_id", "doc_id"])
            .groupBy("query_id", "doc_id", "topic")
            .agg(F.sum("tf").alias("occurrences"), F.min("rank").alias("rank"))
            .select("query_id", "topic", "doc_id", "occurrences", "rank"))


def topic_counts(topic_docs: DataFrame, distinct: bool = True) -> DataFrame:
    """``query_id, topic, n_docs``: different documents, or every occurrence."""
    n = F.count(F.lit(1)) if distinct else F.sum("occurrences")
    return topic_docs.groupBy("query_id", "topic").agg(n.alias("n_docs"))


def statistics(counts: DataFrame) -> DataFrame:
    """Topics of each query, most frequent first, with their ``place``."""
    order = W.partitionBy("query_id").orderBy(F.desc("n_docs"), "topic")
    return (counts.withColumn("place", F.row_number().over(order))
            .orderBy("query_id", "place"))


def clause_counts(clause_hits: DataFrame, hits: DataFrame) -> DataFrame:
    """How many of the hits each clause of a query matched."""
    matched = clause_hits.join(hits.select("query_id", "doc_id"), ["query_id", "doc_id"])
    return (matched.groupBy("query_id", "doc_id", "clause_id").agg(F.lit(1).alias("one"))
            .groupBy("query_id", "clause_id").agg(F.count(F.lit(1)).alias("n_docs")))


def results_by_clause(clause_hits: DataFrame, hits: DataFrame) -> DataFrame:
    """Ranked hits under each clause they matched: ``query_id, clause_id, doc_id, rank``."""
    return (clause_hits.select("query_id", "clause_id", "doc_id")
            .join(hits.select("query_id", "doc_id", "rank"), ["query_id", "doc_id"])
            .groupBy("query_id", "doc_id", "clause_id").agg(F.min("rank").alias("rank"))
            .select("query_id", "clause_id", "doc_id", "rank"))


def results_by_topic(topic_docs: DataFrame, counts: DataFrame, repeat: bool = False) -> DataFrame:
    """Documents in topic order, and by ``rank`` inside a topic: ``query_id, place, topic, doc_id, rank``.

    A document is listed once, under its most frequent topic; with ``repeat``
    under each of its topics.
    """
    order = W.partitionBy("query_id").orderBy(F.desc("n_docs"), "topic")
    # one row per asked topic
    places = counts.select("query_id", "topic", F.row_number().over(order).alias("place"))
    rows = lookup_join(topic_docs.select("query_id", "topic", "doc_id", "rank"), places,
                       ["query_id", "topic"])
    if repeat:
        return rows.select("query_id", "place", "topic", "doc_id", "rank")
    return (rows.groupBy("query_id", "doc_id").agg(F.min(F.struct("place", "topic", "rank")).alias("first"))
            .select("query_id", "first.place", "first.topic", "doc_id", "first.rank"))


def show_documents(rows: DataFrame, docs: DataFrame,
                   columns: tuple[str, ...] = SHOWN) -> DataFrame:
    """Add the columns to display; only those are read from the store.

    ``rows`` are measured first: pass a stored table rather than a long plan.
    """
    shown = docs.select("doc_id", *columns)
    if fits_broadcast(rows):
        shown = asked_rows(shown, "doc_id", few_values(rows, "doc_id"))
        return shown.join(F.broadcast(rows), "doc_id")
    return rows.join(shown, "doc_id")


def results_by_score(ranked: DataFrame, docs: DataFrame,
                     columns: tuple[str, ...] = SHOWN) -> DataFrame:
    """Hits in score order with what is shown of a document."""
    return show_documents(ranked, docs, columns).orderBy("query_id", "rank")
