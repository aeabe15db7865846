"""The whole enrichment: documents and a wiki in, documents with topics out."""

from dataclasses import dataclass

from pyspark.sql import DataFrame

from litsearch.operators.topics import (
    attach_topics, combine_topics, distinct_keys, explode_keys, match_wiki_pages, topic_dictionary,
)
from litsearch.sources.scratch import materialise


@dataclass(frozen=True)
class Enriched:
    docs: DataFrame
    dictionary: DataFrame


def build_dictionary(docs: DataFrame, wiki: DataFrame, column: str) -> DataFrame:
    """Key → topics for all keys of one column, written once.

    Keys and dictionary are stored because each is measured and then joined; the
    wiki is read once and its text is not shuffled.
    """
    keys = materialise(distinct_keys(docs, column), "keys")
    return materialise(topic_dictionary(match_wiki_pages(wiki, keys)), "dictionary")


def enrich_corpus(docs: DataFrame, wiki: DataFrame, column: str = "author_keys",
                  stored: bool = False) -> Enriched:
    """Documents with ``combined_topics`` from the keys of ``column``.

    Documents are used three times, so they are written first unless they are ``stored``.
    """
    docs = docs if stored else materialise(docs, "documents")
    dictionary = build_dictionary(docs, wiki, column)
    topics = attach_topics(explode_keys(docs, column), dictionary)
    return Enriched(combine_topics(docs, topics), dictionary)
