"""Searches with everything a user looks at."""

from dataclasses import dataclass

from pyspark.sql import DataFrame

from litsearch.fixed_values import DEFAULT_FIELD
from litsearch.operators.facets import (
    clause_counts, results_by_clause, results_by_topic, statistics, topic_counts, topic_documents,
)
from litsearch.operators.search import all_clause_hits, boolean_search, rank_bm25, search
from litsearch.sources.index_store import Index
from litsearch.sources.scratch import materialise


@dataclass(frozen=True)
class Comparison:
    """Ranked hits, the topics among them, and the documents by topic."""

    hits: DataFrame
    counts: DataFrame
    by_topic: DataFrame


def ranked_hits(index: Index, clauses: DataFrame, n: int | None = None,
                default_field: str = DEFAULT_FIELD, rest_field: str | None = None) -> DataFrame:
    """Ranked hits, the best ``n`` or all, stored: every frame shown starts from them."""
    return materialise(search(index, clauses, n, default_field, rest_field), "hits")


def compare_topics(index: Index, clauses: DataFrame, n: int | None = None,
                   distinct: bool = True, fields: tuple[str, ...] | None = None,
                   default_field: str = DEFAULT_FIELD, rest_field: str | None = None,
                   repeat: bool = False) -> Comparison:
    """Which of the asked topics is most frequent among the hits of each query.

    Hits are found by word, topics are counted by whole key, over all hits unless ``n``
    is given. What is used more than once is stored.
    """
    hits = ranked_hits(index, clauses, n, default_field, rest_field)
    found = materialise(topic_documents(index, hits, clauses, fields), "topic_documents")
    counts = materialise(topic_counts(found, distinct), "topic_counts")
    return Comparison(hits, statistics(counts), results_by_topic(found, counts, repeat))


def compare_clauses(index: Index, clauses: DataFrame, n: int | None = None,
                    default_field: str = DEFAULT_FIELD) -> tuple[DataFrame, DataFrame]:
    """Ranked hits of plain searches, and how many of them each clause matched."""
    found, hits = _clause_answers(index, clauses, n, default_field)
    return hits, clause_counts(found, hits)


def documents_by_clause(index: Index, clauses: DataFrame, n: int | None = None,
                        default_field: str = DEFAULT_FIELD) -> DataFrame:
    """Documents of plain searches under each clause they matched, best first."""
    return results_by_clause(*_clause_answers(index, clauses, n, default_field))


def _clause_answers(index: Index, clauses: DataFrame, n: int | None,
                    default_field: str) -> tuple[DataFrame, DataFrame]:
    found = materialise(all_clause_hits(index, clauses, default_field), "clause_hits")
    return found, materialise(rank_bm25(boolean_search(found, clauses), n), "hits")
